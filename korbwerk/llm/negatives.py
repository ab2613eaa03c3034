"""Operator 12: hard negatives by orthogonal PCA rotation.

For each anchor the best rows of its own label are its positives; for each positive, the hard negatives are the best rows of other labels whose score lies between a share of the positive's score and that
score itself. A score is the inner product of vectors whose components were made whole numbers.

All vectors are turned by one orthogonal matrix, the eigenvectors of the second moments of all rows, largest first. That leaves inner products as they are and puts most of them into the leading components.
A task goes through its rows tile by tile: it multiplies the leading components of a tile with those of all anchors of a block, adds the product of the residual norms and a slack for rounding, and drops what can't
reach the anchor's present threshold; what is left gets the next components, and so on. Survivors are verified by the product of the whole numbers. So the rotation saves work and decides nothing.

Anchors are searched in blocks of bounded bytes, chosen by a hash; a block is broadcast and meets all rows, which are read where they lie and never shuffled. Thresholds come first from a sixteenth of the rows,
so that a task returns few rows for each anchor, whatever the number of tasks. What a task holds is bounded by a block and a tile.

Rows with a null id, label or vector, or with a null or non-finite component (or one beyond a float) take no part. Repeated rows count each: exact copies of an anchor (same id, label and vector) are other rows
and may be its positives; each copy of an anchor gives its rows again. Among equal scores the smaller id comes first. Vectors of different lengths are filled up with zeros. Scores beyond a long count as
the nearest long. An empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from korbwerk.llm.common import table
from korbwerk.plans.checkpoint import ensure_checkpoint_dir, materialise

POSITIVES, NEGATIVES = 5, 5
#: A negative's score is at least this share of the positive's, in percent, and at most all of it.
LOW, HIGH = 80, 100
SCALE = 256.0
#: Bytes of the vectors of one block of anchors.
BLOCK_BYTES = 16 << 20
#: Anchors of one block at most.
BLOCK_ANCHORS = 20_000
#: Rows and anchors of one matrix product; rows of the first one, which has no thresholds yet.
TILE_ROWS, TILE_ANCHORS, FIRST_ROWS = 1024, 2048, 64
#: One of so many rows gives the first thresholds.
SEED = 16
#: Shares of the components after which candidates are dropped.
STAGES = (0.25, 0.5, 0.75)
LARGEST = 3.4028234663852886e38
I64 = np.iinfo(np.int64)


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, vector and a hash of it (`h`), of the rows that take part."""
    # -0.0 becomes 0.0, so that equal vectors have equal hashes
    doubles = F.transform(F.col(vector), lambda x: x.cast("double") + F.lit(0.0))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), doubles.alias("vector")).withColumn("h", F.xxhash64("vector"))
    # NaN is above every number
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) <= F.lit(LARGEST))))


def whole(vectors: pa.Array, dims: int) -> np.ndarray:
    """floor(SCALE * x) of each component, as doubles; short vectors are filled up with zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    offsets = vectors.offsets.to_numpy().astype(np.int64)
    flat = np.floor(vectors.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]] * SCALE)
    sizes = np.diff(offsets)
    if (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact inner products of rows a[i] and b[j] of whole numbers, as longs."""
    largest = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    out = np.empty(len(i), np.int64)
    for s in range(0, len(i), 1 << 14):
        x, y = a[i[s : s + (1 << 14)]], b[j[s : s + (1 << 14)]]
        if largest < 2**53 and largest * largest * a.shape[1] < 2**62:
            out[s : s + len(x)] = np.einsum("ij,ij->i", x.astype(np.int64), y.astype(np.int64))
        else:  # whole numbers of any size
            out[s : s + len(x)] = [min(max(sum(int(u) * int(v) for u, v in zip(p, q, strict=True)), I64.min), I64.max) for p, q in zip(x, y, strict=True)]
    return out


class Rotated:
    """Vectors of whole numbers, turned, with the norms of what each stage leaves out."""

    def __init__(self, numbers: np.ndarray, turn: np.ndarray):
        self.numbers, self.turned = numbers, numbers @ turn
        dims = numbers.shape[1]
        self.ends = sorted({min(max(round(dims * s), 1), dims) for s in STAGES} | {dims}) if dims else [0]
        squares = np.cumsum((self.turned**2)[:, ::-1], axis=1)[:, ::-1]  # of this and all later components
        self.rest = np.stack([np.sqrt(squares[:, e]) if e < dims else np.zeros(len(numbers)) for e in self.ends], axis=1)
        self.norm = np.sqrt((numbers**2).sum(axis=1))


class Best:
    """The best `k` rows of each slot. A slot belongs to an anchor and takes scores from `low` to `high`; slots are sorted by anchor, and every anchor has one at least."""

    def __init__(self, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        self.k, self.low, self.high, self.n = k, low.copy(), high, len(anchor)
        self.start = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(anchor) else np.zeros(0, np.int64)
        self.count = np.diff(np.concatenate([self.start, [len(anchor)]]))
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.limits()

    def limits(self) -> None:
        """Scores that an anchor's slots may still take."""
        self.least = np.minimum.reduceat(self.low, self.start) if self.n else self.low
        self.most = np.maximum.reduceat(self.high, self.start) if self.n else self.high

    def add(self, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        n = self.count[anchor]
        slot = np.repeat(self.start[anchor], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        score, ids = np.repeat(score, n), np.repeat(ids, n)
        fits = (score >= self.low[slot]) & (score <= self.high[slot])
        if not fits.any():
            return
        slot, score, ids = (np.concatenate([a, b[fits]]) for a, b in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, ~score, slot))  # ~score falls as score rises, without overflow
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.concatenate([first, [len(slot)]])))
        kept = place < self.k
        self.slot, self.score, self.id = slot[kept], score[kept], ids[kept]
        full = place[kept] == self.k - 1
        self.low[self.slot[full]] = np.maximum(self.low[self.slot[full]], self.score[full])
        self.limits()


def search_tile(rows: Rotated, anchors: Rotated, best: Best, r: slice, a: slice) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a row and an anchor, of a tile, whose score may still count."""
    slack = 1e-11 * max(rows.numbers.shape[1], 1) * rows.norm[r, None] * anchors.norm[None, a] + 1e-6
    least, most = best.least[a].astype(float)[None, :], best.most[a].astype(float)[None, :]
    begin, partial = 0, 0.0
    for stage, end in enumerate(rows.ends):
        partial = partial + rows.turned[r, begin:end] @ anchors.turned[a, begin:end].T
        reach = rows.rest[r, stage, None] * anchors.rest[None, a, stage] + slack
        near = (partial + reach >= least) & (partial - reach <= most)
        i, j = np.nonzero(near)
        if end == rows.ends[-1] or len(i) * 8 < near.size:
            break
        begin = end
    return follow(rows, anchors, best, i + r.start, j + a.start, partial[i, j] if len(i) else np.zeros(0), stage)


def follow(rows: Rotated, anchors: Rotated, best: Best, i: np.ndarray, j: np.ndarray, partial: np.ndarray, stage: int) -> tuple[np.ndarray, np.ndarray]:
    """The later stages, for the few pairs that are left."""
    for s in range(stage + 1, len(rows.ends)):
        if not len(i):
            break
        span = slice(rows.ends[s - 1], rows.ends[s])
        partial = partial + np.einsum("ij,ij->i", rows.turned[i, span], anchors.turned[j, span])
        reach = rows.rest[i, s] * anchors.rest[j, s] + 1e-11 * rows.numbers.shape[1] * rows.norm[i] * anchors.norm[j] + 1e-6
        near = (partial + reach >= best.least[j]) & (partial - reach <= best.most[j])
        i, j, partial = i[near], j[near], partial[near]
    return i, j


def search_block(batches: Iterator[pa.RecordBatch], block: dict, best: Best, same: bool) -> Iterator[pa.RecordBatch]:
    """The best rows of a task for each slot. block: ids, labels (sorted), marks (hashes) and numbers of the anchors, and the turn. same: rows of the anchor's label but its exact copies, or rows of other labels."""
    ids, labels, dims, first = block["ids"], block["labels"], block["turn"].shape[0], True
    anchors = Rotated(block["numbers"], block["turn"])
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            size = FIRST_ROWS if first else TILE_ROWS
            own, own_labels = batch.column(0)[at : at + size].to_numpy(), batch.column(1)[at : at + size].to_numpy()
            order = np.argsort(own_labels, kind="stable")
            marks = batch.column(3)[at : at + size].to_numpy()[order]
            rows = Rotated(whole(batch.column(2)[at : at + size], dims)[order], block["turn"])
            own, own_labels = own[order], own_labels[order]
            at, first = at + size, False
            bounds = np.flatnonzero(np.concatenate([[True], own_labels[1:] != own_labels[:-1], [True]]))
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                low, high = np.searchsorted(labels, own_labels[s], "left"), np.searchsorted(labels, own_labels[s], "right")
                for begin, end in [(low, high)] if same else [(0, low), (high, len(labels))]:
                    for t in range(int(begin), int(end), TILE_ANCHORS):
                        i, j = search_tile(rows, anchors, best, slice(s, e), slice(t, min(t + TILE_ANCHORS, int(end))))
                        if same and len(i):
                            other = (own[i] != ids[j]) | (marks[i] != block["marks"][j])
                            i, j = i[other], j[other]
                        if len(i):
                            best.add(j, products(rows.numbers, anchors.numbers, i, j), own[i])
    yield pa.RecordBatch.from_arrays([pa.array(best.slot), pa.array(best.score), pa.array(best.id)], ["slot", "score", "id"])


def turn_of(rows: DataFrame, dims: int) -> np.ndarray:
    """Eigenvectors of the rows' second moments, of the largest first: sums of every task, added up by position; dims * dims numbers reach the driver."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = whole(batch.column(0), dims)
            x /= max(np.abs(x).max(initial=0), 1.0)  # each batch to its own scale: any sums give a right turn
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims, dtype=np.int32)), pa.array(total.ravel())], ["at", "x"])

    found = rows.select("vector").mapInArrow(moments, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).toArrow()
    matrix = np.zeros(dims * dims)
    matrix[found.column("at").to_numpy()] = found.column("x").to_numpy()
    return np.ascontiguousarray(np.linalg.eigh(matrix.reshape(dims, dims))[1][:, ::-1])


def best_rows(rows: DataFrame, block: dict, slots: tuple[np.ndarray, np.ndarray, np.ndarray], k: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """slot, score and id of the best k rows of each slot of a block, best first. First a part of the rows is searched for thresholds, then all rows."""
    sc, (anchor, low, high) = rows.sparkSession.sparkContext, slots
    shared = sc.broadcast(block)

    def run(part: DataFrame, least: np.ndarray) -> tuple[np.ndarray, ...]:
        own = sc.broadcast((anchor, least, high))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from search_block(batches, shared.value, Best(*own.value, k), same)

        place = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
        found = part.mapInArrow(search, "slot long, score long, id long").withColumn("place", F.row_number().over(place)).where(F.col("place") <= k).toArrow().sort_by([("slot", "ascending"), ("place", "ascending")])
        own.unpersist()
        return tuple(found.column(c).to_numpy() for c in ("slot", "score", "id", "place"))

    seeds = rows.where(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(SEED)) == 0).coalesce(max(1, rows.rdd.getNumPartitions() // SEED))
    slot, score, _, place = run(seeds, low)
    least = low.copy()
    least[slot[place == k]] = np.maximum(least[slot[place == k]], score[place == k])
    slot, score, ids, _ = run(rows, least)
    shared.unpersist()
    return slot, score, ids


def add_copies(n: int, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, block: dict, k: int) -> list[list[tuple[int, int]]]:
    """(score, id) of the best k rows of each of n anchors, with the exact copies of the anchor itself."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for a, s, i in zip(slot.tolist(), score.tolist(), ids.tolist(), strict=True):
        out[a].append((s, i))
    many = np.flatnonzero(block["copies"] > 1)
    own = products(block["numbers"], block["numbers"], many, many)
    for a, s in zip(many.tolist(), own.tolist(), strict=True):
        out[a] = sorted(out[a] + [(s, int(block["ids"][a]))] * min(int(block["copies"][a]) - 1, k), key=lambda x: (-x[0], x[1]))[:k]
    return out


def mine_block(rows: DataFrame, block: dict, positives: int, negatives: int, low: int, high: int) -> pa.Table:
    """All results of one block of anchors."""
    n = len(block["ids"])
    none = np.full(n, I64.min), np.full(n, I64.max)
    found = add_copies(n, *best_rows(rows, block, (np.arange(n), *none), positives, True), block, positives)
    # one slot for each different score of an anchor's positives; an anchor without positives takes nothing
    anchor, floor, ceiling = [], [], []
    for a, own in enumerate(found):
        for s in dict.fromkeys(s for s, _ in own) or (None,):
            anchor.append(a)
            floor.append(max(-(-low * s // 100), I64.min) if s is not None else I64.max)
            ceiling.append(min(max(high * s // 100, I64.min), I64.max) if s is not None else I64.min)
    slots = tuple(np.array(x, np.int64) for x in (anchor, floor, ceiling))
    slot, score, ids = best_rows(rows, block, slots, negatives, False)
    begin, end = np.searchsorted(slot, np.arange(len(anchor)), "left").tolist(), np.searchsorted(slot, np.arange(len(anchor)), "right").tolist()
    out: list[list[int]] = [[] for _ in range(7)]
    score_list, id_list, at = score.tolist(), ids.tolist(), 0
    for a, own in enumerate(found):
        of = {s: at + x for x, s in enumerate(dict.fromkeys(s for s, _ in own))}
        at += max(len(of), 1)
        for s, i in own:
            for place, r in enumerate(range(begin[of[s]], end[of[s]])):
                for c, v in zip(out, (block["copies"][a], block["ids"][a], i, place + 1, id_list[r], s, score_list[r]), strict=True):
                    c.append(int(v))
    return pa.table([pa.array(c, pa.int64()) for c in out], ["copies", "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])


def repeated(rows: DataFrame, times: str, at_once: int = 1 << 16) -> DataFrame:
    """Each row as often as a column says, without that column."""
    some = rows.withColumn("_from", F.explode(F.sequence(F.lit(1), F.col(times), F.lit(at_once))))
    return some.withColumn("_at", F.explode(F.sequence(F.lit(1), F.least(F.col(times) - F.col("_from") + 1, F.lit(at_once))))).drop("_from", "_at", times)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score. rows: of `usable`, perhaps with other labels."""
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/negatives-{uuid4().hex}"
    # copies of an anchor are folded before anything is shuffled
    anchors = materialise(rows.where(is_anchor).groupBy("vec_id", "label", "h", "vector").agg(F.count("*").alias("copies")))
    size = rows.agg(F.max(F.size("vector")).alias("dims")).first()
    dims, n = size["dims"] or 0, anchors.count()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n:
        return spark.createDataFrame([], schema)
    turn = turn_of(rows, dims) if dims else np.zeros((0, 0))
    blocks = ceil(max(n * dims * 16 / BLOCK_BYTES, n / BLOCK_ANCHORS))
    for b in range(blocks):
        part = anchors.where(F.pmod(F.xxhash64("vec_id", "label", "h"), F.lit(blocks)) == b).toArrow()
        if not part.num_rows:
            continue
        order = np.argsort(part.column("label").to_numpy(), kind="stable")
        block = {"ids": part.column("vec_id").to_numpy()[order], "labels": part.column("label").to_numpy()[order], "copies": part.column("copies").to_numpy()[order], "marks": part.column("h").to_numpy()[order], "numbers": whole(part.column("vector"), dims)[order], "turn": turn}
        found = mine_block(rows, block, positives, negatives, low, high)
        repeated(spark.createDataFrame(found), "copies").withColumn("rank", F.col("rank").cast("int")).write.mode("append").parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings"))
    relabelled = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(relabelled, F.col("vec_id") % 100 == 0)


ORACLE_SQL = """WITH r AS (SELECT row_number() OVER () AS i, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.i AS anchor, a.vec_id AS anchor_id, a.label AS own, r.i, r.vec_id, r.label, list_dot_product(a.v, r.v)::BIGINT AS score FROM r a JOIN r ON a.i <> r.i WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE label = own QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, (row_number() OVER (PARTITION BY p.anchor, p.i ORDER BY s.score DESC, s.vec_id))::INT AS rank, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND s.label <> p.own AND 80 * p.score <= 100 * s.score AND s.score <= p.score QUALIFY rank <= 5"""
