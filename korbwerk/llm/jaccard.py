"""Near copies by Jaccard similarity of their shingles, for the pipeline's near-duplicate stage.

A fingerprint of 64 bits can't reach a similarity of 0.8: texts that similar lie up to 18 bits apart (README), and an index over so many bits compares nearly all with all. So
candidates beyond operator 9's three bits, which the stage takes first (simhash.py), come from MinHash: each text goes into BANDS buckets, each named by ROWS minima of its shingles, and texts that share a bucket are compared exactly. Two texts of
similarity 0.8 share none with a probability of (1 - 0.8^4)^24 = 3e-6, more similar ones with less; nothing else is left out. Buckets with the same members are compared once.
A bucket of more than HOT texts is dealt again by further minima, which keep a pair together by the same odds.

Within a bucket each text looks for texts of its similarity among those that no component has reached yet, so what leaves it is one link for each text at most, never all pairs.
Identity of shingles is by 64-bit hashes. Texts without words are equal to each other; a text of fewer words than a shingle is one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from korbwerk.llm.common import slices, small, words_of
from korbwerk.plans.checkpoint import materialise

WIDTH, SIMILARITY = 5, 0.8
ROWS, BANDS = 4, 24
HOT = 2000
#: Times that crowded buckets are dealt again.
DEALS = 3
U64 = np.uint64
MIX = U64(0x9E3779B97F4A7C15)


def shingles(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingles of each text, as hashes."""
    from xxhash import xxh64_intdigest

    offsets, codes, words = words_of(texts)
    each = np.fromiter((xxh64_intdigest(w) for w in words), U64, len(words))[codes]
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        n = max(b - a - width + 1, 1)
        key = np.zeros(n, U64)
        for d in range(min(width, b - a)):
            key = (key ^ each[a + d : a + d + n]) * MIX
            key ^= key >> U64(29)
        out.append(np.unique(key))
    return out


def buckets(sets: list[np.ndarray], deal: int = 0) -> np.ndarray:
    """For each set the names of its BANDS buckets."""
    start = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    flat = np.concatenate(sets)
    factors = np.random.default_rng(deal).integers(0, 1 << 63, ROWS * BANDS, dtype=U64) * U64(2) + U64(1)
    out = np.zeros((len(sets), BANDS), U64)
    for i, factor in enumerate(factors):
        band = out[:, i // ROWS]
        band ^= np.minimum.reduceat(flat * factor, start) + U64(i // ROWS)
        band *= MIX
        band ^= band >> U64(29)
    return out


def near(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """A link (set, first set of its component) for each set that isn't the first."""
    sizes = np.array([len(s) for s in sets])
    number = np.unique(np.concatenate(sets), return_inverse=True)[1]
    own = np.split(number, np.cumsum(sizes)[:-1])
    holders = np.repeat(np.arange(len(sets)), sizes)[np.argsort(number, kind="stable")]
    begin = np.concatenate([[0], np.cumsum(np.bincount(number))])
    reached, links = np.zeros(len(sets), bool), []
    for first in range(len(sets)):
        if reached[first]:
            continue
        reached[first], todo = True, [first]
        while todo and not reached.all():
            i = todo.pop()
            a, n = begin[own[i]], begin[own[i] + 1] - begin[own[i]]
            at = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
            both = np.bincount(holders[at], minlength=len(sets))
            # the tolerance is for the product only: counts are integers
            found = np.flatnonzero(~reached & (both >= similarity * (sizes + sizes[i] - both) - 1e-9))
            reached[found] = True
            links += [(j, first) for j in found.tolist()]
            todo += found.tolist()
    return links


def by_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.xxhash64(F.col("text").cast("string")).alias("h"), F.col("text").cast("string").alias("text"))


def banded(texts: DataFrame, width: int, deal: int = 0) -> DataFrame:
    """Distinct h, within (the bucket that is dealt again, or 0) and bucket. texts: h, text, and then within."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys = np.stack([batch.column(0).to_numpy(), batch.column(2).to_numpy()], axis=1)
            at = np.unique(keys, axis=0, return_index=True)[1]
            found = buckets(shingles(batch.column(1).take(pa.array(at)), width), deal)
            found = (found ^ keys[at, 1].view(U64)[:, None]) * MIX
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(keys[at, 0], BANDS)), pa.array(found.reshape(-1).view(np.int64))], ["h", "bucket"])

    return texts.mapInArrow(run, "h long, bucket long").distinct()


def find_links(docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY, hot: int = HOT, known: DataFrame | None = None) -> DataFrame:
    """Links (a, b) between hashes of texts, whose components are those of all pairs of that similarity. docs: with text. known: node and root of texts that links join already; buckets of one component alone aren't compared, and those links aren't found again."""
    texts = by_text(docs)
    bands = materialise(banded(texts.withColumn("within", F.lit(0).cast("long")), width))
    links = None
    for deal in range(DEALS + 1):
        shared = bands.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor("h").alias("x"), F.bit_xor(F.xxhash64("h")).alias("y")).where("n > 1")
        once = materialise(shared.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("n", "bucket"))
        members = materialise(spanning(bands.join(once, "bucket").select("h", "bucket", "n"), known))
        last = deal == DEALS
        own = compared(texts, members if last else members.where(F.col("n") <= hot), width, similarity)
        links = own if links is None else links.unionByName(own)
        crowded = members.where(F.col("n") > hot)
        if last or crowded.isEmpty():
            return links
        again = held(texts, crowded).join(crowded.withColumnRenamed("bucket", "within"), "h").select("h", "text", "within")
        bands = materialise(banded(again, width, deal + 1))


def spanning(members: DataFrame, known: DataFrame | None) -> DataFrame:
    """Members of buckets that hold texts of several components."""
    if known is None:
        return members
    rooted = materialise(members.join(small(known), F.col("h") == F.col("node"), "left").select("h", "bucket", "n", F.coalesce("root", "h").alias("root")))
    several = rooted.groupBy("bucket").agg((F.min("root") < F.max("root")).alias("several")).where("several").select("bucket")
    return rooted.join(several, "bucket", "left_semi").select("h", "bucket", "n")


def held(texts: DataFrame, members: DataFrame) -> DataFrame:
    """The texts of members, one row for each."""
    return texts.join(small(materialise(members.select("h").distinct())), "h", "left_semi").groupBy("h").agg(F.first("text").alias("text"))


def compared(texts: DataFrame, members: DataFrame, width: int, similarity: float) -> DataFrame:
    """Links (a, b) within buckets. members: h and bucket."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in shingles(batch.column(1), width)], pa.binary())], ["h", "s"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, ids, own = None, [], []

        def solve() -> pa.RecordBatch:
            found = near(own, similarity) if len(own) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([ids[i] for i, _ in found], pa.int64()), pa.array([ids[j] for _, j in found], pa.int64())], ["a", "b"])

        for batch in batches:
            for b, h, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if b != bucket:
                    yield solve()
                    bucket, ids, own = b, [], []
                ids.append(h)
                own.append(np.frombuffer(s, U64))
        yield solve()

    held_sets = held(texts, members).mapInArrow(sets, "h long, s binary")
    return members.select("bucket", "h").join(held_sets, "h").select("bucket", "h", "s").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "a long, b long")
