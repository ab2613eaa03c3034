"""Operator 6: information-theoretic sanitisation, in DataFrame functions only.

Base spans (e-mail, IP, card, phone) are the protected entities. The corpus tells which other terms reveal them: of the distinct texts that hold a term, in how many
does it stand within NEAR words of the entity (on either side, up to the next match of the entity's kind, however long the words are)? A term discloses an entity if it does so in at least
SUPPORT texts, in at least SHARE of the texts that hold the term (the chance to name the entity from the term; half a text is added to them), and with at least BITS bits of pointwise mutual
information. Such terms are spans of kind "term" in every text that holds them, and are generalised in sanitised text as entities are.

A term is a word of four characters or more (WORD) between boundaries (EDGE), the same wherever it is counted; A-Z count as a-z. Counts cover all documents, by distinct text, so that copies count once.
What is paired is bounded by mentions times 2 * NEAR words. The texts are read three times: for the entities and the words around them, for the counts of the terms that may disclose (if there are any), and for the
spans. Tables of terms and of texts with terms are broadcast only up to BROADCAST_ROWS rows (common.py) and joined by key otherwise.

Null texts are empty. Repeated rows get equal results, an empty table an empty result; extra columns, of whatever name, are kept by `sanitise`. Matches that fail a
kind's test are dropped and not tried again. Overlapping base spans of different kinds all stay; a term span that touches a base span is left out. Very long texts are read whole.
Offsets count code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from korbwerk.llm.common import shielded, small, table
from korbwerk.plans.checkpoint import materialise

# A match may begin where the last one ended or where no longer match could have begun; with possessive repeats this keeps scans linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without these has no valid match.
HINTS = {"email": r"@[A-Za-z0-9-]++\.", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
KINDS = (*PATTERNS, "term")
NEAR = 6
SUPPORT, SHARE, BITS = 2, 0.5, 6.0
WORD = r"\p{L}[\p{L}\p{N}'-]{3,}+"
EDGE = r"[\p{L}\p{N}'-]"
TERM = f"(?<!{EDGE}){WORD}"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEP = 256
SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def folded(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True if the digits pass the Luhn test."""
    each = F.transform(F.split(F.reverse(number), ""), lambda x, i: F.when(i % 2 == 0, x.cast("int")).when(x.cast("int") < 5, x.cast("int") * 2).otherwise(x.cast("int") * 2 - 9))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda x: F.ltrim(x, F.lit("0")))
        return F.forall(parts, lambda x: (F.length(x) <= 3) & (F.coalesce(x.try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.length(digits(value)).between(12, 19) & F.coalesce(F.when(F.length(digits(value)).between(12, 19), luhn(digits(value))), F.lit(False))
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


def before(lengths: Column) -> Column:
    """For each length the sum of those before it; in steps, so that long arrays take no quadratic time."""

    def running(xs: Column) -> Column:
        return F.aggregate(xs, F.struct(F.lit(0).alias("s"), F.array().cast("array<int>").alias("a")), lambda acc, x: F.struct((acc["s"] + x).alias("s"), F.concat(acc["a"], F.array(acc["s"])).alias("a")))

    steps = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / STEP).cast("int")), lambda k: running(F.slice(lengths, k * STEP + 1, F.lit(STEP))))
    bases = running(F.transform(steps, lambda s: s["s"]))["a"]
    return F.flatten(F.zip_with(steps, bases, lambda s, b: F.transform(s["a"], lambda x: x + b)))


def placed(kind: str, found: str, gaps: str) -> Column:
    """Spans of the matches in column `found`, between the strings of column `gaps`."""
    at = before(F.zip_with(F.col(found), F.slice(F.col(gaps), F.lit(1), F.size(found)), lambda m, g: F.length(m) + F.length(g)))
    starts = F.zip_with(at, F.slice(F.col(gaps), F.lit(1), F.size(found)), lambda a, g: a + F.length(g))
    spans = F.zip_with(starts, F.col(found), lambda s, m: F.struct(s.cast("int").alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (s + F.length(m)).cast("int").alias("end"), F.lit(kind).alias("kind"), m.alias("value")))
    return F.when(F.size(found) > 0, F.filter(spans, lambda s: valid(kind, s["value"]))).otherwise(F.array().cast(SPAN))


def with_base(docs: DataFrame, text: str = "text", near: int = 0) -> DataFrame:
    """docs with `_p_text` (null: empty), `_p_<kind>` (spans of each kind), `_p_base` (all, in order) and, with `near`, `_p_near` (entities and the words around them)."""
    out = docs.withColumn("_p_text", F.coalesce(F.col(text).cast("string"), F.lit("")))
    none = F.array().cast("array<string>")
    out = out.withColumns({f"_p_m_{k}": F.when(F.col("_p_text").rlike(HINTS[k]), F.regexp_extract_all("_p_text", F.lit(p), F.lit(0))).otherwise(none) for k, p in PATTERNS.items()})
    out = out.withColumns({f"_p_g_{k}": F.when(F.size(f"_p_m_{k}") > 0, F.split("_p_text", p, -1)).otherwise(none) for k, p in PATTERNS.items()})
    out = out.withColumns({f"_p_{k}": placed(k, f"_p_m_{k}", f"_p_g_{k}") for k in PATTERNS})
    if near:
        out = out.withColumn("_p_near", F.concat(*(around(k, f"_p_m_{k}", f"_p_g_{k}", near) for k in PATTERNS)))
    out = out.drop(*(f"_p_{x}_{k}" for x in "mg" for k in PATTERNS))
    return out.withColumn("_p_base", F.array_sort(F.concat(*(F.col(f"_p_{k}") for k in PATTERNS))))


def entity(kind: str, value: Column) -> Column:
    """One name for all spellings of an entity."""
    return F.concat(F.lit(f"{kind}:"), digits(value) if kind in ("card", "phone") else F.lower(value))


def terms_in(text: Column) -> Column:
    return F.regexp_extract_all(folded(text), F.lit(TERM), F.lit(0))


def around(kind: str, found: str, gaps: str, near: int) -> Column:
    """Entities of the valid matches in column `found`, each with the distinct terms next to it in the gaps on both sides."""

    def whole(gap: Column, i: Column) -> Column:
        # a word that goes on in a match is that longer word, and one that began there isn't this gap's
        end = F.when(gap.rlike(f"{EDGE}$"), F.regexp_extract(F.coalesce(F.get(found, i), F.lit("")), f"^{EDGE}*", 0)).otherwise(F.lit(""))
        return F.concat(F.right(F.coalesce(F.get(found, i - 1), F.lit("")), F.lit(1)), gap, end)

    words = F.transform(gaps, lambda g, i: terms_in(whole(g, i)))
    ends = F.transform(words, lambda w: F.struct(F.slice(w, 1, near).alias("first"), F.reverse(F.slice(F.reverse(w), 1, near)).alias("last")))
    each = F.transform(found, lambda m, i: F.struct(valid(kind, m).alias("valid"), entity(kind, m).alias("entity"), F.array_distinct(F.concat(F.get(ends, i)["last"], F.get(ends, i + 1)["first"])).alias("terms")))
    kept = F.transform(F.filter(each, lambda x: x["valid"]), lambda x: F.struct(x["entity"].alias("entity"), x["terms"].alias("terms")))
    return F.when(F.size(found) > 0, kept).otherwise(F.array().cast("array<struct<entity:string,terms:array<string>>>"))


def disclosing_terms(docs: DataFrame, near: int = NEAR, support: int = SUPPORT, share: float = SHARE, bits: float = BITS) -> tuple[DataFrame, DataFrame | None]:
    """term, entity and the counts behind the verdict, for every pair beyond all three thresholds; and the texts (h) that hold a candidate term, None if there is no candidate. docs: with text."""
    texts = materialise(with_base(docs.select("text"), near=near).select(F.xxhash64("_p_text").alias("h"), F.when(F.size("_p_near") > 0, F.col("_p_near")).alias("near")))
    mentions = texts.where("near is not null").select("h", F.inline("near"))
    pairs = mentions.select("h", "entity", F.explode("terms").alias("term")).distinct().groupBy("term", "entity").agg(F.count("*").alias("n_both")).where(F.col("n_both") >= support)
    # a term stands in at least the texts in which it is near any entity; most common words fall by that bound and needn't be counted in the whole corpus
    near_any = mentions.select("h", F.explode("terms").alias("term")).distinct().groupBy("term").agg(F.count("*").alias("n_near"))
    pairs = materialise(pairs.join(near_any, "term").where(F.col("n_both") >= (F.col("n_near") + 0.5) * share).drop("n_near"))
    held = None if pairs.isEmpty() else materialise(holding(docs, pairs.select("term").distinct()))
    entities = mentions.select("h", "entity").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    terms = (pairs.select("term").withColumn("h", F.lit(0)) if held is None else held).groupBy("term").agg(F.count("*").alias("n_term"))
    total = texts.agg(F.count_distinct("h").alias("n_texts"))
    counted = pairs.join(terms, "term").join(entities, "entity").crossJoin(F.broadcast(total))  # total: one row
    counted = counted.withColumn("share", F.col("n_both") / (F.col("n_term") + 0.5)).withColumn("bits", F.log2(F.col("n_both").cast("double") * F.col("n_texts") / F.col("n_term") / F.col("n_entity")))
    return counted.where((F.col("share") >= share) & (F.col("bits") >= bits)), held


def holding(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Distinct (h, term) of the texts that hold one of the terms."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = docs.select(F.xxhash64(text).alias("h"), F.explode(F.array_distinct(terms_in(text))).alias("term"))
    return words.join(small(materialise(terms)), "term", "left_semi").distinct()


def with_terms(docs: DataFrame) -> DataFrame:
    """docs with the columns of with_base(), and `_p_words`: a pattern of the disclosing terms in the text, or null."""
    pairs, held = disclosing_terms(docs)
    base = with_base(docs)
    if held is None:
        return base.withColumn("_p_words", F.lit(None).cast("string"))
    flagged = small(materialise(pairs.select("term").distinct()))
    by_text = materialise(held.join(flagged, "term", "left_semi").groupBy(F.col("h").alias("_p_h")).agg(F.array_join(F.array_sort(F.collect_set("term")), "|").alias("_p_words")))
    return base.join(small(by_text), F.xxhash64("_p_text") == F.col("_p_h"), "left").drop("_p_h")


def term_pattern() -> Column:
    return F.concat(F.lit(f"(?i)(?<!{EDGE})(?:"), F.col("_p_words"), F.lit(f")(?!{EDGE})"))


def with_spans(docs: DataFrame) -> DataFrame:
    """docs with the columns of with_base(), and `_p_spans`: base and term spans in order."""
    none = F.array().cast("array<string>")
    out = with_terms(docs)
    out = out.withColumn("_p_m_term", F.when(F.col("_p_words").isNotNull(), F.regexp_extract_all("_p_text", term_pattern(), F.lit(0))).otherwise(none))
    out = out.withColumn("_p_g_term", F.when(F.size("_p_m_term") > 0, F.split("_p_text", term_pattern(), F.lit(-1))).otherwise(none))
    out = out.withColumn("_p_term", placed("term", "_p_m_term", "_p_g_term")).drop("_p_m_term", "_p_g_term")
    apart = F.filter("_p_term", lambda t: ~F.exists("_p_base", lambda b: (t["start"] < b["end"]) & (b["start"] < t["end"])))
    return out.withColumn("_p_spans", F.when(F.size("_p_term") > 0, F.array_sort(F.concat("_p_base", apart))).otherwise(F.col("_p_base")))


def listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans, base_sha256, spans and n_term of every document."""
    found = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    n = [F.size(f"_p_{k}").cast("long").alias(f"n_{k}") for k in PATTERNS]
    return found.select("doc_id", *n, F.sha2(listed("_p_base").cast("binary"), 256).alias("base_sha256"), listed("_p_spans").alias("spans"), F.size(F.filter("_p_spans", lambda s: s["kind"] == "term")).cast("long").alias("n_term"))


def apart(spans: str) -> Column:
    """The spans without overlaps: one that overlaps an earlier one is taken into it."""
    kind = "struct<start:int,end:int,kind:string>"
    slim = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))

    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))))
        return F.when((F.size(done) > 0) & (s["start"] < F.coalesce(F.get(done, F.size(done) - 1)["end"], F.lit(0))), longer).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(slim, F.array().cast(f"array<{kind}>"), add)


def sanitise(docs: DataFrame) -> DataFrame:
    """docs with entities and disclosing terms generalised to the name of their kind, each span of `with_spans` once, and n_chars (if there) made new; a null text stays null."""
    return shielded(docs, "_p_", _sanitise)


def _sanitise(docs: DataFrame) -> DataFrame:
    names = docs.columns
    out = with_spans(docs).withColumn("_p_apart", F.when(F.size("_p_spans") > 0, apart("_p_spans")))
    before = lambda i: F.coalesce(F.get("_p_apart", i - 1)["end"], F.lit(0))
    shown = F.transform("_p_apart", lambda s, i: F.concat(F.substring(F.col("_p_text"), before(i) + 1, s["start"] - before(i)), F.lit("["), F.upper(s["kind"]), F.lit("]")))
    tail = F.substring(F.col("_p_text"), F.element_at("_p_apart", -1)["end"] + 1, F.length("_p_text"))
    out = out.withColumn("text", F.when(F.col("text").isNull() | F.col("_p_apart").isNull(), F.col("text").cast("string")).otherwise(F.concat(F.array_join(shown, ""), tail)))
    return (out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out).select(*names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
