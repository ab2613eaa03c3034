"""Operator 10: quality rules with adaptive thresholds.

Each text gets a few measures, for each word: symbols, words in repeated 5-word windows, words equal to the word before, characters; and repeated lines for each line. Counts are
smoothed (half a case more, one word or line more), so that texts without any case still spread by their length; fences are set on logarithms. A text is judged by the lower bound of its
count (NOISE standard deviations of a count below it), so that a few chance cases in a short text reject nothing.

A mergeable quantile sketch of each measure per language and source gives its quartiles: counts of logarithmic bins of width BIN (a DDSketch; relative error BIN / 2). It is
built in partial aggregates on the map side, merges exactly by adding counts, and doesn't depend on order, so two runs agree. A fence lies REACH times the quartile distance outside the quartiles (Tukey's far
fences). Nothing else decides: there is no fixed cutoff and no slack. The quartiles of a group of n documents are pooled with those of its language, which weigh as PRIOR
documents, and those in turn with all documents': the quartiles of a few documents are uncertain by a good part of their distance, so small groups lean on their language and
large ones on themselves, without a switch at any size. A document is rejected where a measure lies beyond its group's fence.
Quartiles are the outer edges of their bins, so a group without any spread has fences as wide as the sketch is exact.
Fences replace fixed cutoffs and are joined to the documents by language and source. `base_failed` holds the two fixed rules of the contract.

Null text: no words, n_words 0, base_failed; such texts don't enter the sketches. Null language or source is a group like any other. Repeated rows count as often as they stand there. Ties at a fence are kept.
An empty table gives an empty result. Extra columns, of whatever name, are kept by `filter_documents` and ignored by `score_documents`. Very long texts are measured whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from korbwerk.llm.common import shielded, slices, small, split_codes, sums, table, words_of
from korbwerk.plans.checkpoint import materialise

WINDOW = 5
BIN, REACH, PRIOR, NOISE = 0.02, 3.0, 50.0, 2.0
MARKS = b"#*$%&|<>"
KINDS = ("r_symbols", "r_dup_lines", "r_repeat", "r_adjacent", "r_word_len")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_adjacent", "n_lines")


def repeated_words(offsets: np.ndarray, codes: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """For each text, the words that lie in a window of `width` words which the text has twice or more."""
    n = len(codes)
    out = np.zeros(n, bool)
    if n < width:
        return sums(offsets, out)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    start = np.flatnonzero(text[: n - width + 1] == text[width - 1 :])
    key = text[start].astype(np.uint64)
    mix = np.uint64(0x9E3779B97F4A7C15)
    for d in range(width):
        key = (key ^ codes[start + d].astype(np.uint64)) * mix
        key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    first, second = start[order][:-1][same], start[order][1:][same]
    equal = text[first] == text[second]  # the hash proposes, the words decide
    for d in range(width):
        equal &= codes[first + d] == codes[second + d]
    twice = np.zeros(n, bool)
    twice[first[equal]] = twice[second[equal]] = True
    at = np.flatnonzero(twice)
    for d in range(width):
        out[at + d] = True
    return sums(offsets, out)


def line_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    r"""For each text, the lines (between \n) that hold a word, and those of them that equal an earlier line."""
    offsets, codes, lines = split_codes(pc.split_pattern(texts, "\n"))
    blank = np.array([not x.strip(b" \t\n\r\x0b\x0c") for x in lines.cast(pa.binary()).to_pylist()], bool)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((codes, text))
    repeat = np.zeros(len(codes), bool)
    repeat[order[1:]] = (text[order][1:] == text[order][:-1]) & (codes[order][1:] == codes[order][:-1])
    return sums(offsets, ~blank[codes]), sums(offsets, repeat & ~blank[codes])


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS of each text."""
    texts = pc.fill_null(texts, "")
    offsets, codes, words = words_of(texts, fold=False)
    lengths = np.array([len(w.decode()) for w in words], np.int64)
    symbols = sum(pc.count_substring(texts, chr(m)).to_numpy(zero_copy_only=False).astype(np.int64) for m in MARKS)
    again = np.zeros(len(codes), bool)
    again[1:] = codes[1:] == codes[:-1]
    again[offsets[:-1][np.diff(offsets) > 0]] = False
    lines, repeated = line_counts(texts)
    return {"n_words": np.diff(offsets), "word_chars": sums(offsets, lengths[codes]), "n_symbols": symbols, "n_dup_lines": repeated, "n_repeat_words": repeated_words(offsets, codes), "n_adjacent": sums(offsets, again), "n_lines": lines}


def measured(docs: DataFrame) -> DataFrame:
    """The documents with their counts, all columns kept; ours are named `_q_*`."""
    names = docs.columns
    at = names.index("text")
    schema = StructType([*docs.schema, *(StructField(f"_q_{c}", LongType()) for c in COUNTS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            counts = measure(batch.column(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(counts[c], pa.int64()) for c in COUNTS)], [*names, *(f"_q_{c}" for c in COUNTS)])

    return docs.mapInArrow(run, schema)


def measures() -> dict[str, tuple[Column, Column]]:
    """Of each measure, the logarithm that enters the sketch and the one that is held against the upper fence; the latter null if nothing speaks against the text."""
    words = F.col("_q_n_words").cast("double")

    def smoothed(count: str, of: Column) -> tuple[Column, Column]:
        lower = F.col(count) - F.sqrt(count) * NOISE
        return F.log((F.col(count) + 0.5) / (of + 1)), F.when(lower > 0, F.log((lower + 0.5) / (of + 1)))

    length = F.log(F.col("_q_word_chars") / F.greatest(words, F.lit(1.0)))
    lines = F.col("_q_n_lines").cast("double")
    return {"r_symbols": smoothed("_q_n_symbols", words), "r_dup_lines": smoothed("_q_n_dup_lines", lines), "r_repeat": smoothed("_q_n_repeat_words", words), "r_adjacent": smoothed("_q_n_adjacent", words), "r_word_len": (length, length)}


def sketches(rows: DataFrame) -> DataFrame:
    """lang, source, kind, bin and n: how many documents of the group have the measure in that bin. rows: with `_q_*`, lang and source; those without words don't count."""
    each = F.array(*(F.struct(F.lit(i).alias("kind"), F.floor(x / BIN).cast("int").alias("bin")) for i, (x, _) in enumerate(measures().values())))
    return rows.where("_q_n_words > 0").select("lang", "source", F.inline(each)).groupBy("lang", "source", "kind", "bin").agg(F.count("*").alias("n"))


def quartiles(bins: DataFrame, *by: str) -> DataFrame:
    """n (documents) and q (the lower edge of the lower quartile's bin, the upper edge of the upper one's) of each group and kind."""
    merged = bins.groupBy(*by, "kind", "bin").agg(F.sum("n").alias("n"))
    own = Window.partitionBy(*by, "kind")
    ranked = merged.withColumns({"upto": F.sum("n").over(own.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)), "total": F.sum("n").over(own)})
    return ranked.groupBy(*by, "kind").agg(F.max("total").alias("n"), F.array(*((F.min(F.when(F.col("upto") * 4 >= F.col("total") * i, F.col("bin"))) + edge) * BIN for i, edge in ((1, 0), (3, 1)))).alias("q"))


def pooled(own: str, parent: str) -> Column:
    """Quartiles of a group, with its parent's as PRIOR documents."""
    return F.zip_with(f"{own}.q", parent, lambda x, y: (x * F.col(f"{own}.n") + y * PRIOR) / (F.col(f"{own}.n") + PRIOR))


def fences(rows: DataFrame) -> DataFrame:
    """lang, source and, for each measure, the lowest and highest logarithm that is kept."""
    bins = materialise(sketches(rows))
    group, lang, all_ = quartiles(bins, "lang", "source").alias("g"), quartiles(bins, "lang").alias("l"), quartiles(bins).alias("a")
    by_lang = lang.join(F.broadcast(all_), F.col("l.kind") == F.col("a.kind")).select(F.col("l.lang").alias("lang"), F.col("l.kind").alias("kind"), pooled("l", "a.q").alias("q")).alias("p")  # all_: a row for each measure
    found = group.join(by_lang, F.col("g.lang").eqNullSafe(F.col("p.lang")) & (F.col("g.kind") == F.col("p.kind"))).select("g.lang", "g.source", "g.kind", pooled("g", "p.q").alias("q"))
    width = (F.col("q")[1] - F.col("q")[0]) * REACH
    sides = {"low": F.col("q")[0] - width, "high": F.col("q")[1] + width}
    return found.groupBy("lang", "source").agg(*(F.max(F.when(F.col("kind") == i, x)).alias(f"{k}_{side}") for i, k in enumerate(KINDS) for side, x in sides.items()))


def base_failed() -> Column:
    """The two fixed rules."""
    return (F.col("_q_n_words") < 10) | (F.col("_q_n_repeat_words") * 100 > F.col("_q_n_words") * 20)


def judged(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """rows with `_q_failed` and `_q_kept`. limits: materialised, a row for each group; broadcast if they are few, so that texts don't move."""
    limits = small(limits.select(F.col("lang").alias("_q_lang"), F.col("source").alias("_q_source"), *(F.col(f"{k}_{s}").alias(f"_q_{k}_{s}") for k in KINDS for s in ("low", "high"))))
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("_q_lang")) & F.col("source").eqNullSafe(F.col("_q_source")), "left")
    inside = F.lit(True)
    for k, (_, x) in measures().items():
        inside = inside & ~F.coalesce(x > F.col(f"_q_{k}_high") + 1e-9, F.lit(False))
    low = F.coalesce(measures()["r_word_len"][0] < F.col("_q_r_word_len_low") - 1e-9, F.lit(False))
    return joined.withColumn("_q_failed", base_failed()).withColumn("_q_kept", ~F.col("_q_failed") & inside & ~low)


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every document."""
    counts = materialise(measured(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text", "lang", "source")).drop("text"))
    return judged(counts, materialise(fences(counts))).select("doc_id", *(F.col(f"_q_{c}").alias(c) for c in COUNTS[:5]), F.col("_q_failed").alias("base_failed"), F.col("_q_kept").alias("kept"), F.col("_q_n_adjacent").alias("n_adjacent"))


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with their columns. Texts aren't stored in between: the counts are made once for the fences and again for the filter."""

    def run(rows: DataFrame) -> DataFrame:
        limits = materialise(fences(measured(rows.select("text", "lang", "source"))))
        return judged(measured(rows), limits).where("_q_kept").select(*rows.columns)

    return shielded(docs, "_q_", run)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
