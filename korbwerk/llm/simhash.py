"""Operator 9: SimHash near-dedup over a Gray-order hierarchical index.

Each text gets a 64-bit fingerprint; fingerprints link at BITS or fewer differing bits, and a component is all that links reach. Equal fingerprints form one
class. Classes meet in buckets: the 64 bits are cut into blocks, and with BITS + k blocks two linked fingerprints agree in some k of them, so a class goes into
one bucket for every choice of k blocks. More classes get more blocks, hence longer keys; a bucket of more than HOT classes is dealt again by the same
argument over the bits that its key leaves free. This loses no link.

Within a partition the buckets' fingerprints are sorted by Gray rank, so that neighbours differ in few bits. Runs of FAN neighbours (of one bucket) form a node that
keeps the bits they share as a mask and a pattern; runs of nodes form upper nodes. A pair of nodes is dropped as a whole if their shared bits already
differ in more than BITS places, accepted as a whole if they can't differ in more, skipped if both lie in one component, and else split into its
children. What leaves a partition is at most one link for each fingerprint in it, never all pairs of a group. Components then grow by star contraction over those links
(large and small stars in turn), each round checkpointed.

Null texts are empty and, like all texts without words, have fingerprint zero, which links like any other. Ties don't matter: a component is named by its smallest
doc_id; null ids don't count (a component of null ids has a null id). Repeated rows get equal results. An empty table gives an empty result; extra columns are kept by `deduplicate`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from korbwerk.llm import jaccard
from korbwerk.llm.common import shielded, slices, small, table, words_of
from korbwerk.plans.checkpoint import materialise

WIDTH, SEED, BITS = 3, 42, 3
FAN, CHUNK = 8, 8192
HOT = 20_000
#: Texts of one fingerprint that are compared with each other.
MET = 1000
#: Times that crowded buckets are dealt again. After that a bucket shares 44 bits at least, so it can't hold more than 2^20 fingerprints.
DEALS = 3
#: Classes up to which so many blocks do.
BLOCKS = ((1 << 21, 4), (1 << 31, 5), (1 << 62, 6))
U64 = np.uint64


def fingerprints(texts: pa.Array, width: int = WIDTH, seed: int = SEED) -> np.ndarray:
    """SimHash of each text over its shingles, repeats included."""
    from xxhash import xxh64_intdigest

    offsets, codes, words = words_of(texts)
    out = np.zeros(len(offsets) - 1, U64)
    if not len(codes):
        return out
    lengths = np.fromiter(map(len, words), np.int64, len(words))[codes]
    begin = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    end = begin + lengths
    buffer = b" ".join([words[c] for c in codes.tolist()])
    sizes = np.diff(offsets)
    held = np.flatnonzero(sizes)
    counts = np.maximum(sizes[held] - width + 1, 1)  # shingles of each text
    first = np.repeat(offsets[:-1][held], counts) + np.arange(counts.sum()) - np.repeat(np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    last = np.minimum(first + width, np.repeat(offsets[1:][held], counts)) - 1
    hashes = np.fromiter((xxh64_intdigest(buffer[a:b], seed) for a, b in zip(begin[first].tolist(), end[last].tolist(), strict=True)), U64, len(first))
    at = 0
    for i, n in zip(held.tolist(), counts.tolist(), strict=True):
        ones = np.zeros(64, np.int64)
        for j in range(at, at + n, 1 << 15):
            bits = np.unpackbits(hashes[j : min(j + (1 << 15), at + n)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            ones += bits.sum(axis=0, dtype=np.uint16)
        out[i] = np.packbits(ones * 2 > n).view(">u8")[0]
        at += n
    return out


def fingerprinted(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, `h` (a hash of the text) and fp (the fingerprint as a long) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fingerprints(batch.column(1), width).view(np.int64))], ["doc_id", "h", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("h")).mapInArrow(run, "doc_id long, h long, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each code in the Gray order."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> U64(s))
    return x


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def masks(blocks: int, bits: int = BITS) -> list[int]:
    """For each choice of blocks - bits blocks, their bits."""
    ends = [64 * i // blocks for i in range(blocks + 1)]
    own = [(1 << ends[i + 1]) - (1 << ends[i]) for i in range(blocks)]
    return [sum(own[i] for i in chosen) for chosen in combinations(range(blocks), blocks - bits)]


def finer(mask: int, bits: int = BITS) -> list[int]:
    """The mask with each of bits + 1 blocks of the bits that it leaves free."""
    free = [i for i in range(64) if not mask >> i & 1]
    return [mask | sum(1 << free[j] for j in range(len(free) * k // (bits + 1), len(free) * (k + 1) // (bits + 1))) for k in range(bits + 1)]


class Forest:
    """Trees over buckets of distinct fingerprints, one below the other: items are level 0."""

    def __init__(self, items: np.ndarray, buckets: np.ndarray, bits: int = BITS):
        order = np.lexsort((gray_rank(items), buckets))
        self.items, self.bits = items[order], bits
        self.parent = np.arange(len(items))  # of components, by item; a parent is the component's smallest item
        bucket, pattern = buckets[order], self.items
        mask = np.full(len(items), ~U64(0))
        span = np.arange(len(items) + 1)
        self.levels = [(mask, pattern, span, span)]
        while len(bucket) and (bucket[1:] == bucket[:-1]).any():
            new = np.concatenate([[True], bucket[1:] != bucket[:-1]])
            place = np.arange(len(bucket)) - np.maximum.accumulate(np.where(new, np.arange(len(bucket)), 0))
            start = np.flatnonzero(place % FAN == 0)
            differ = np.bitwise_or.reduceat(pattern, start) ^ np.bitwise_and.reduceat(pattern, start)
            mask = np.bitwise_and.reduceat(mask, start) & ~differ
            pattern, bucket = pattern[start] & mask, bucket[start]
            children = np.concatenate([start, [len(span) - 1]])
            span = span[children]
            self.levels.append((mask, pattern, children, span))
        self.version, self.uniform = 0, {}

    def labels(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest component under each node."""
        if self.uniform.get(level, (None,))[0] != self.version:
            start = self.levels[level][3][:-1]
            self.uniform[level] = (self.version, np.minimum.reduceat(self.parent, start), np.maximum.reduceat(self.parent, start))
        return self.uniform[level][1:]

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.parent[a], self.parent[b]
            apart = x != y
            if not apart.any():
                return
            self.version += 1
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.parent, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.parent[self.parent]
                if (up == self.parent).all():
                    break
                self.parent = up

    def join(self) -> None:
        """Finds the components within each bucket."""
        top = len(self.levels) - 1
        nodes = np.arange(len(self.levels[top][0]))
        stack = [(top, nodes[i : i + CHUNK], nodes[i : i + CHUNK]) for i in range(0, len(nodes), CHUNK)] if top else []
        while stack:
            level, a, b = stack.pop()
            low, high = self.labels(level)
            apart = ~((low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b]))
            a, b = a[apart], b[apart]
            children = self.levels[level][2]
            n, m = children[a + 1] - children[a], children[b + 1] - children[b]
            of = np.repeat(np.arange(len(a)), n * m)
            within = np.arange(len(of)) - np.repeat(np.cumsum(n * m) - n * m, n * m)
            x, y = children[a][of] + within // m[of], children[b][of] + within % m[of]
            own = x <= y if level > 1 else x < y
            x, y = x[own | (a != b)[of]], y[own | (a != b)[of]]
            mask, pattern, _, span = self.levels[level - 1]
            both, differ = mask[x] & mask[y], pattern[x] ^ pattern[y]
            near = np.bitwise_count(differ & both) <= self.bits
            x, y, both, differ = x[near], y[near], both[near], differ[near]
            sure = np.bitwise_count(~both | differ) <= self.bits
            if sure.any():
                ends = [(span[v[sure]], span[v[sure] + 1]) for v in (x, y)]
                head = ends[0][0]
                for begin, end in ends:
                    size = end - begin
                    each = np.repeat(begin, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                    self.union(np.repeat(head, size), each)
            if level > 1:
                x, y = x[~sure], y[~sure]
                stack += [(level - 1, x[i : i + CHUNK], y[i : i + CHUNK]) for i in range(0, len(x), CHUNK)]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """One link for each item that isn't its component's first."""
        at = np.flatnonzero(self.parent != np.arange(len(self.parent)))
        return self.items[at], self.items[self.parent[at]]


def linked(batches: Iterator[pa.RecordBatch], bits: int = BITS) -> Iterator[pa.RecordBatch]:
    """Links (a, b) within buckets. batches: mask, value and fp, those of a bucket together."""
    held: list[np.ndarray] = []

    def solve(rows: np.ndarray) -> pa.RecordBatch:
        bucket = np.concatenate([[0], np.cumsum((rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1]))])
        forest = Forest(rows[:, 2].astype(np.int64).view(U64), bucket, bits)
        forest.join()
        a, b = forest.links()
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(np.stack([c.to_numpy() for c in batch.columns], axis=1))
        if sum(map(len, held)) >= 1 << 17:
            rows = np.concatenate(held)
            # the last bucket may go on
            cut = np.flatnonzero((rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1]))
            if len(cut):
                yield solve(rows[: cut[-1] + 1])
                rows = rows[cut[-1] + 1 :]
            held = [rows]
    if held and len(rows := np.concatenate(held)):
        yield solve(rows)


def find_links(classes: DataFrame, bits: int = BITS, hot: int = HOT) -> DataFrame:
    """Links (a, b) between fingerprints whose components are those of all links. classes: distinct fp."""
    n = classes.count()
    found = masks(next(b for most, b in BLOCKS if n <= most) + bits - BITS, bits)
    level = classes.select("fp", F.explode(F.array(*(F.lit(signed(m)) for m in found))).alias("mask"))
    links = None
    for deal in range(DEALS + 1):
        level = level.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp")
        crowded = materialise(level.groupBy("mask", "value").count().where(F.col("count") > hot).select("mask", "value")) if deal < DEALS else None
        some = crowded is not None and not crowded.isEmpty()
        calm = level.join(crowded, ["mask", "value"], "left_anti") if some else level
        own = calm.repartition("mask", "value").sortWithinPartitions("mask", "value").mapInArrow(lambda batches: linked(batches, bits), "a long, b long")
        links = own if links is None else links.unionByName(own)
        if not some:
            break
        options = F.create_map(*(x for m in found for x in (F.lit(signed(m)), F.array(*(F.lit(signed(y)) for y in finer(m, bits))))))
        level = materialise(level.join(crowded, ["mask", "value"], "left_semi").select("fp", F.explode(options[F.col("mask")]).alias("mask")).distinct())
        found = sorted({y for m in found for y in finer(m, bits)})
    return links


def components(links: DataFrame) -> DataFrame:
    """node and root of every linked node: the root is the smallest node that links reach."""
    edges = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: larger neighbours move to the smallest neighbour
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours move to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = materialise(small)
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def with_components(rows: DataFrame) -> DataFrame:
    """doc_id, h, fp, root (a fingerprint that stands for the component) and component_id. rows: doc_id, h and fp, materialised."""
    classes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(find_links(classes.select("fp")))
    linked_classes = classes.join(found, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = linked_classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked_classes.join(names, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp")


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id of every document."""
    found = with_components(materialise(fingerprinted(docs)))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, width: int = WIDTH, similarity: float | None = None) -> DataFrame:
    """The document of each component that gives it its name (of equal ids the one whose text hashes lowest), with its columns. With `similarity`, texts of that Jaccard similarity of their shingles or more link: those with near fingerprints (of WIDTH words) that an exact comparison confirms, and those that the fingerprints don't reach (see jaccard.py).

    Which rows go is found on numbers alone: doc_id and a hash of the text. Up to BROADCAST_ROWS such keys are broadcast; beyond that the texts are dealt once, by key. Only texts that stand there more than
    once with one doc_id move for their own sake: of such rows any one stays.
    """
    return shielded(docs, "_s_", lambda rows: _deduplicate(rows, width, similarity))


def met_texts(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """bucket and h: hashes of texts whose fingerprints are near, some links of which join each component. At most some MET texts of one fingerprint stand in a bucket, and the first of each such part in one of their own."""
    texts = materialise(fingerprinted(docs, width).select("h", "fp").distinct())
    classes = materialise(texts.groupBy("fp").agg(F.count("*").alias("n"), F.min("h").alias("of")))
    found = find_links(classes.select("fp"))
    crowd = classes.where("n > 1").select("fp", F.ceil(F.col("n") / MET).alias("parts"))
    parted = texts.join(crowd, "fp").select("h", F.col("fp"), F.pmod(F.xxhash64("h"), "parts").alias("part"))
    firsts = parted.groupBy("fp", "part").agg(F.min("h").alias("h")).select(F.xxhash64("fp", F.lit("firsts")).alias("bucket"), "h")
    own = classes.select("fp", "of")
    apart = found.select(F.xxhash64("a", "b", F.lit("link")).alias("bucket"), F.explode(F.array("a", "b")).alias("fp")).join(own, "fp").select("bucket", F.col("of").alias("h"))
    return parted.select(F.xxhash64("fp", "part").alias("bucket"), "h").unionByName(firsts).unionByName(apart)


def _deduplicate(docs: DataFrame, width: int, similarity: float | None) -> DataFrame:
    if similarity is None:
        found = with_components(materialise(fingerprinted(docs, width))).select("doc_id", "h", "root")
    else:
        ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("h"))
        near = materialise(jaccard.compared(jaccard.by_text(docs), materialise(met_texts(docs)), width, similarity))
        known = components(near)
        roots = components(near.unionByName(jaccard.find_links(docs, width, similarity, known=known)))
        found = ids.join(small(roots), F.col("h") == F.col("node"), "left").select("doc_id", "h", F.coalesce("root", "h").alias("root"))
    keys = found.groupBy("root", "doc_id", "h").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id").alias("i"), F.col("h").alias("t")))
    winners = keys.groupBy("root").agg(first.alias("w"), F.count("*").alias("k"), F.max("n").alias("most")).where("k > 1 or most > 1").select("root", "w")
    # only components of several rows have anything to drop
    touched = materialise(keys.join(winners, "root").select(F.col("doc_id").alias("_s_id"), F.col("h").alias("_s_h"), "n", (F.col("doc_id").eqNullSafe(F.col("w.i")) & (F.col("h") == F.col("w.t"))).alias("wins")))
    rows = docs.withColumns({"_s_own": F.xxhash64(F.col("text").cast("string")), "_s_key": F.col("doc_id").cast("long")})
    same = F.col("_s_key").eqNullSafe(F.col("_s_id")) & (F.col("_s_own") == F.col("_s_h"))
    once = rows.join(small(touched.where("not wins or n > 1").select("_s_id", "_s_h")), same, "left_anti").select(*docs.columns)
    again = small(touched.where("wins and n > 1").select("_s_id", "_s_h"))
    return once.unionByName(rows.join(again, same, "left_semi").dropDuplicates(["_s_key", "_s_own"]).select(*docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
