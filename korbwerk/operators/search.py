"""Ranked search, suggestions, facets and highlights over listings (Q-1 to Q-11, A16, A17, O4, O5, F14, F15)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from korbwerk.functions.text import blank, email_domain, subsequence_pattern

# Latin letters with marks and the letters that decomposition leaves of them.
MARKED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿāăąćĉċčďēĕėęěĝğġģĥĩīĭįĵķĺļľńņňōŏőŕŗřśŝşšţťũūŭůűųŵŷźżž"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyaaaccccdeeeeegggghiiiijklllnnnooorrrssssttuuuuuuwyzzz"
#: Characters of a description that are searched.
DESCRIPTION = 1800


def normalise(c: Column) -> Column:
    """Q-1: lower case without marks; all but letters, digits, @, dot and hyphen become one space."""
    plain = F.regexp_replace(F.translate(F.lower(blank(c)), MARKED, PLAIN), r"[\x{300}-\x{36f}]", "")
    return F.trim(F.regexp_replace(F.regexp_replace(plain, r"[^a-z0-9@.\s-]+", " "), r"\s+", " "))


def place_of(text: Column, part: Column) -> Column:
    """Place of the first occurrence, from 0."""
    return F.call_function("locate", part, text) - 1


def field_score(field: Column, token: Column) -> Column:
    """Q-4: 110 for the whole field; else by the first word that equals (95) or begins with the token (80); else by its place, for tokens of 3 or more."""
    first = F.get(F.filter(F.split(field, " "), lambda w: F.startswith(w, token)), F.lit(0))
    place = place_of(field, token)
    return (
        F.when(field == token, 110).when(first == token, 95).when(first.isNotNull(), 80)
        .when((F.length(token) > 2) & F.contains(field, token), F.lit(100) - F.least(place, F.lit(40))).otherwise(0)
    )


def token_score(fields: Column, description: Column, token: Column) -> Column:
    """Q-5: the best field; a description that holds a token of 4 or more counts 28 where no field does."""
    best = F.coalesce(F.array_max(F.transform(fields, lambda f: field_score(f, token))), F.lit(0))
    return F.when((best == 0) & (F.length(token) >= 4) & F.contains(description, token), 28).otherwise(best)


def search_score(fields: Column, description: Column, query: str | Column) -> Column:
    """Q-6: sum over the query's tokens, null if one is not found; 0 for an empty query. fields and description: normalised."""
    q = normalise(F.lit(query) if isinstance(query, str) else query)
    scores = F.transform(F.filter(F.split(q, " "), lambda t: t != ""), lambda t: token_score(fields, description, t))
    return F.when(F.forall(scores, lambda s: s > 0), F.aggregate(scores, F.lit(0), lambda a, s: a + s))


def searchable(df: DataFrame, fields: list[str], description: str | None = None) -> DataFrame:
    """Q-3: df with `_fields` (normalised, blanks dropped) and `_text`. Keep this table: it doesn't depend on the query."""
    text = normalise(F.substring(blank(F.col(description)), 1, DESCRIPTION)) if description else F.lit("")
    return df.withColumn("_fields", F.filter(F.array(*(normalise(F.col(f)) for f in fields)), lambda x: x != "")).withColumn("_text", text)


def search(df: DataFrame, query: str) -> DataFrame:
    """Q-6, Q-7: matching rows with `score`. df: from searchable()."""
    return df.withColumn("score", search_score(F.col("_fields"), F.col("_text"), query)).where("score is not null").drop("_fields", "_text")


def match_count(df: DataFrame, query: str) -> DataFrame:
    """Q-7: how many rows match; all for an empty query. df: from searchable()."""
    return df.agg(F.count_if(search_score(F.col("_fields"), F.col("_text"), query).isNotNull()).alias("n"))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of a value that is computed once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def highlights(text: Column, query: str | Column) -> Column:
    """Q-10: ranges of characters (from 0, `to` exclusive) that hold a token of the query, in order; ranges that touch are one.

    Tokens are looked for in the text without blanks and marks, so a token may run over a gap.
    """
    q = normalise(F.lit(query) if isinstance(query, str) else query)
    numbered = F.transform(F.regexp_extract_all(blank(text), F.lit("(?s)."), F.lit(0)), lambda c, i: F.struct(i.alias("at"), normalise(c).alias("c")))

    def places(token: Column, kept: Column, joined: Column) -> Column:
        last = F.length(joined) - F.length(token)
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        found = F.filter(starts, lambda p: F.substring(joined, p + 1, F.length(token)) == token)
        return F.transform(found, lambda p: F.struct(F.get(kept, p)["at"].alias("from"), (F.get(kept, p + F.length(token) - 1)["at"] + 1).alias("to")))

    def all_places(kept: Column) -> Column:
        joined = F.array_join(F.transform(kept, lambda x: x["c"]), "")
        return _once(joined, lambda j: F.flatten(F.transform(F.filter(F.split(q, " "), lambda t: t != ""), lambda t: places(t, kept, j))))

    # else the text is normalised again for each of its characters
    ranges = F.array_sort(_once(F.filter(numbered, lambda x: x["c"] != ""), all_places))

    def join(done: Column, r: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        longer = F.struct(last["from"].alias("from"), F.greatest(last["to"], r["to"]).alias("to"))
        return F.when((F.size(done) == 0) | (r["from"] > last["to"]), F.concat(done, F.array(r))).otherwise(F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer)))

    return F.aggregate(ranges, F.array().cast("array<struct<from:int,to:int>>"), join)


def application_filter(df: DataFrame, query: str = "", status: str = "", ae_only: bool = False, email_only: bool = False) -> DataFrame:
    """F15, Q-11: applications of one state, of one type, with an address, and with the query in company, city, address or reference."""
    text = F.lower(F.concat_ws(" ", *(blank(F.col(c)) for c in ("nama_perusahaan", "posisi_kota", "alamat_email_bewerbung", "referenznummer"))))
    tests = [(ae_only, F.col("beruf_typ") == "ae"), (email_only, blank(F.col("alamat_email_bewerbung")) != ""), (bool(status), F.col("bewerbung_status") == status), (bool(query.strip()), F.contains(text, F.lit(query.strip().lower())))]
    for wanted, test in tests:
        df = df.where(test) if wanted else df
    return df


def suggestions(df: DataFrame, kinds: dict[str, Column], ordinal: str = "ordinal") -> DataFrame:
    """Type, norm, value (the first in input order) and n for every distinct normalised value of each kind."""
    pairs = F.array(*(F.struct(F.lit(k).alias("type"), blank(c.cast("string")).alias("value")) for k, c in kinds.items()))
    rows = df.select(F.col(ordinal).alias("_o"), F.explode(pairs).alias("p")).select("_o", "p.type", "p.value").withColumn("norm", normalise(F.col("value"))).where("value <> '' and norm <> ''")
    return rows.groupBy("type", "norm").agg(F.min_by("value", "_o").alias("value"), F.count("*").alias("n"))


def suggestion_score(norm: Column, query: str) -> Column:
    """Q-8 without the count: whole, begin, inside, begin of a word, subsequence."""
    q = normalise(F.lit(query))
    word = F.exists(F.split(norm, " "), lambda w: F.startswith(w, q))
    return (
        F.when(norm == q, 200).when(F.startswith(norm, q), F.lit(150) - F.least(F.length(norm) - F.length(q), F.lit(30)))
        .when(F.contains(norm, q), F.lit(120) - place_of(norm, q)).when(word, 90).when((F.length(q) >= 2) & F.rlike(norm, subsequence_pattern(q)), 50).otherwise(0)
    )


def suggest(index: DataFrame, query: str, per_kind: int = 5, most: int = 18) -> DataFrame:
    """O5, Q-8: the best suggestions of each kind, and `most` in all, by score, count and name."""
    scored = index.withColumn("score", suggestion_score(F.col("norm"), query) + F.least(F.col("n"), F.lit(20)).cast("int")).where("score > 0")
    order = [F.desc("score"), F.desc("n"), F.col("value")]
    best = scored.withColumn("rank", F.row_number().over(Window.partitionBy("type").orderBy(*order))).where(F.col("rank") <= per_kind)
    return best.orderBy("type", "rank").limit(most)


def facets(df: DataFrame, columns: list[str], lists: list[str] | None = None) -> DataFrame:
    """Column, value and n of every facet value; list columns count each of their values. One scan."""
    pairs = [F.array(F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value"))) for c in columns]
    pairs += [_each(c) for c in lists or []]
    rows = df.select(F.explode(F.concat(*pairs)).alias("p")).select("p.facet", "p.value").where("value is not null and value <> ''")
    return rows.groupBy("facet", "value").agg(F.count("*").alias("n"))


def _each(name: str) -> Column:
    return F.transform(F.coalesce(F.col(name), F.array().cast("array<string>")), lambda x: F.struct(F.lit(name).alias("facet"), x.alias("value")))


def sources_of(explicit: Column, category: Column, *links: Column) -> Column:
    """Q-9, Q12: keys of the boards that a listing comes from."""
    linked = F.lit(False)
    for link in links:
        linked = linked | (blank(link) != "")
    prefix = F.regexp_replace(F.lower(blank(category)), "_(ae|dpa|si|dv|fi)(_20[0-9]{2})?$", "")
    return F.when(blank(explicit) != "", F.array(F.lower(explicit))).when(linked, F.array(F.lit("arbeitsagentur"))).when(prefix != "", F.array(prefix)).otherwise(F.array().cast("array<string>"))


def viewer_filter(df: DataFrame, **wanted: object) -> DataFrame:
    """rows that meet all given conditions: category, portal, job_type, has_email, manual, year ("unknown" too), month."""
    tests = {
        "category": lambda v: F.col("category_id") == v, "portal": lambda v: F.array_contains("sources", v), "job_type": lambda v: F.col("beruf_typ").isin(*v) if isinstance(v, list | tuple) else F.col("beruf_typ") == v,
        "has_email": lambda v: (blank(F.col("alamat_email_bewerbung")) != "") == F.lit(v), "manual": lambda v: F.col("butuh_manual") == v,
        "year": lambda v: F.col("tahun_mulai").isNull() if v == "unknown" else F.col("tahun_mulai") == v, "month": lambda v: F.col("bulan_mulai") == v,
    }
    for key, value in wanted.items():
        if value is not None:
            df = df.where(tests[key](value))
    return df


def domain_facet(df: DataFrame, email: str) -> DataFrame:
    """Q-2, A16."""
    return df.groupBy(email_domain(F.col(email)).alias("domain")).agg(F.count("*").alias("n")).where("domain <> ''")
