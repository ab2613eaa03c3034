"""Operator 13: document fingerprints by consistent weighted sampling.

A text is a set of terms (words, A-Z in lower case) with weights (how often each stands there). Each of SAMPLES samples draws, from a hash of term and sample number alone, two gamma variables r and c and
a uniform b for every term; a term of weight w gets t = floor(ln w / r + b), y = exp(r (t - b)) and a = c / (y exp(r)), and the sample is the term and t of the smallest a. Two texts share a sample with a
probability of their generalised Jaccard similarity, sum of smaller weights by sum of larger ones. A fingerprint holds 16 bits of each sample, so the share of equal ones is that similarity to about
sqrt(J (1 - J) / SAMPLES); another 1/65535 of chance agreement is below that.

All that is drawn for a term and weight depends on these alone, so it is computed once for the distinct ones of a chunk of texts: a table of longs whose high bits order as a does and whose low 16 bits are the
sample's. A text's fingerprint is the least entry of its rows.

`likeness_of_neighbours` puts documents in order of doc_id by one shuffle over ranges, in which each task sees its documents and their successors side by side; only the last document of a task waits for the first of the
next one, and those few rows are joined by task number. Keys of ranges end with a row number, so even a doc_id that a third of all rows has is split.

Null texts are empty. A text without words has the fingerprint of zeros, which is like itself only. Null ids come first; rows of equal id are in the order of their texts' hashes, and equal ones in any order, which
changes no result. Repeated rows count each. A single document is its own successor. Very long texts are handled alone. An empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from korbwerk.llm.common import slices, table, words_of
from korbwerk.plans.checkpoint import materialise

SAMPLES = 128
#: Rows of the table of drawn values that are computed, and of those gathered, at once. CHUNK_BYTES of text give a table of some 130 MB at most, but for a longer text.
CHUNK_BYTES = 1 << 20
TABLE_ROWS, GATHER_ROWS = 256, 2048
U64 = np.uint64
LOW = U64(0xFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """Well mixed bits of each number, in place."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> U64(shift)
        x *= U64(factor)
    x ^= x >> U64(31)
    return x


def uniform(bits: np.ndarray, shift: int) -> np.ndarray:
    """Numbers in (0, 1) from 23 of the bits."""
    out = ((bits >> U64(shift)) & U64(0x7FFFFF)).astype(np.float32)
    out += np.float32(0.5)
    out *= np.float32(2.0**-23)
    return out


def sample_table(hashes: np.ndarray, weights: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """For each term and weight, and each sample: a in the high bits, and 16 bits of (term, t), never 0, in the low ones."""
    out = np.empty((len(hashes), samples), U64)
    steps = [np.arange(3 * k, 3 * k + 3, dtype=U64) * U64(0x9E3779B97F4A7C15) for k in range(1, samples + 1)]
    first, second, third = (np.array([x[i] for x in steps], U64)[None, :] for i in range(3))
    logs = np.log(weights).astype(np.float32)
    for at in range(0, len(hashes), TABLE_ROWS):  # as much as stays in a core's cache
        h, log_w = hashes[at : at + TABLE_ROWS, None], logs[at : at + TABLE_ROWS, None]
        x = mix(h + first)
        r = np.log(uniform(x, 41) * uniform(x, 18))  # of the opposite sign
        x = mix(h + second)
        c = np.log(uniform(x, 41) * uniform(x, 18))
        name = mix(h + third)
        b = uniform(name, 41)
        t = np.floor(b - log_w / r)
        b -= t
        b -= np.float32(1)
        b *= r
        a = np.exp(-b, out=b)
        a *= -c
        np.maximum(a, np.finfo(np.float32).tiny, out=a)
        name += t.astype(np.int64).view(U64) * U64(0xD1B54A32D192ED03)
        name *= U64(0xBF58476D1CE4E5B9)
        name >>= U64(48)
        np.maximum(name, U64(1), out=name)
        np.left_shift(a.view(np.uint32), U64(16), out=out[at : at + TABLE_ROWS], dtype=U64)
        out[at : at + TABLE_ROWS] |= name
    return out


def fingerprints(texts: pa.Array, samples: int = SAMPLES) -> np.ndarray:
    """One row of `samples` 16-bit numbers for each text."""
    from xxhash import xxh64_intdigest

    offsets, codes, words = words_of(texts)
    out = np.zeros((len(offsets) - 1, samples), np.uint16)
    if not len(codes):
        return out
    hashes = np.fromiter(map(xxh64_intdigest, words), U64, len(words))
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    own, weight = np.unique(doc * len(words) + codes, return_counts=True)
    doc, code = own // len(words), own % len(words)
    most = int(weight.max()) + 1
    distinct, row = np.unique(code * most + weight, return_inverse=True)
    values = sample_table(hashes[distinct // most], (distinct % most).astype(np.float64), samples)
    least = np.full((len(out), samples), ~U64(0))
    for at in range(0, len(row), GATHER_ROWS):
        of = doc[at : at + GATHER_ROWS]
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        # a text that goes on meets its own minimum
        least[of[first]] = np.minimum(least[of[first]], np.minimum.reduceat(values[row[at : at + GATHER_ROWS]], first, axis=0))
    held = np.unique(doc)
    out[held] = (least[held] & LOW).astype(np.uint16)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples, row by row."""
    return (a == b).mean(axis=1)


def as_bytes(prints: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in prints.astype(">u2")]


def spliced(text: str, following: str) -> str:
    """text with its last half (rounded down) replaced by the first as many characters of the one that follows, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


FIELDS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.binary()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
RESULT = "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def compare(ids: list[int | None], texts: list[str], following: list[str], samples: int) -> pa.RecordBatch:
    """Results of documents and their successors."""
    edited = [spliced(a, b) for a, b in zip(texts, following, strict=True)]
    # successors are mostly documents of the batch, so equal texts are done once
    all_texts = pa.array(texts + following + edited, pa.large_string()).dictionary_encode()
    prints = fingerprints(all_texts.dictionary.cast(pa.string()), samples)[all_texts.indices.to_numpy()]
    own, other, changed = prints[: len(texts)], prints[len(texts) : 2 * len(texts)], prints[2 * len(texts) :]
    shas = [hashlib.sha256(t.encode()).digest() for t in edited]
    columns = [ids, [len(t) for t in texts], shas, as_bytes(own), as_bytes(changed), likeness(own, changed), likeness(own, other)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, FIELDS, strict=True)], schema=pa.schema(FIELDS))


def pair_up(batches: Iterator[pa.RecordBatch], samples: int = SAMPLES) -> Iterator[pa.RecordBatch]:
    """Results of a task's documents, in order, but for the last. Also the first and the last document themselves, marked by `edge`: 0 and 1. batches: task, doc_id, text."""
    last: tuple[int | None, str] | None = None
    task = None

    def edge(kind: int, own: tuple[int | None, str]) -> pa.RecordBatch:
        fields = [pa.array([own[0]] if n == "doc_id" else [None], t) for n, t in FIELDS]
        return pa.RecordBatch.from_arrays([*fields, pa.array([kind], pa.int32()), pa.array([task], pa.int32()), pa.array([own[1]])], [n for n, _ in FIELDS] + ["edge", "task", "text"])

    for batch in slices(batches, text=2, most=CHUNK_BYTES):
        ids, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        if last is None:
            task = batch.column(0)[0].as_py()
            yield edge(0, (ids[0], texts[0]))
        else:
            ids, texts = [last[0], *ids], [last[1], *texts]
        last = ids[-1], texts[-1]
        if len(ids) > 1:
            rows = compare(ids[:-1], texts[:-1], texts[1:], samples)
            empty = [pa.nulls(rows.num_rows, t) for t in (pa.int32(), pa.int32(), pa.string())]
            yield pa.RecordBatch.from_arrays([*rows.columns, *empty], [*rows.schema.names, "edge", "task", "text"])
    if last is not None:
        yield edge(1, last)


def finish(batches: Iterator[pa.RecordBatch], samples: int = SAMPLES) -> Iterator[pa.RecordBatch]:
    """Results of documents with the successor beside them: doc_id, text, following."""
    for batch in slices(batches, most=CHUNK_BYTES):
        yield compare(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), samples)


def likeness_of_neighbours(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of each document and its edited text, and how like they are to each other and to the next document's. docs: doc_id and text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keys = [F.asc_nulls_first("doc_id"), F.xxhash64("text"), F.col("row")]
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    found = materialise(dealt.select(F.spark_partition_id().alias("task"), "doc_id", "text").mapInArrow(lambda b: pair_up(b, samples), RESULT + ", edge int, task int, text string"))
    firsts, lasts = found.where("edge = 0"), found.where("edge = 1")
    # one number for each task: the next task that has documents, and after the last one the first
    order = firsts.select("task").withColumn("then", F.coalesce(F.lead("task").over(Window.orderBy("task")), F.min("task").over(Window.partitionBy(F.lit(0)))))
    ends = lasts.select("doc_id", "text", "task").join(order, "task").join(firsts.select(F.col("task").alias("then"), F.col("text").alias("following")), "then").select("doc_id", "text", "following")
    whole = found.where("edge is null").drop("edge", "task", "text").unionByName(ends.mapInArrow(lambda b: finish(b, samples), RESULT))
    return whole.withColumns({c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")})


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return likeness_of_neighbours(table(spark, sf_dir, "documents"))
