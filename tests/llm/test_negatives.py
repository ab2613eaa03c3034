"""Operator 12 against all products, in small blocks, with ties, copies and odd vectors."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from korbwerk.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, h string"


def by_hand(rows, every=100, k=5, m=5):
    live = []
    for at, (i, v, label) in enumerate(rows):
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        live.append((at, i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for at, i, label, v in live:
        if i % every:
            continue
        score = lambda w: sum(a * b for a, b in zip(v, w, strict=False))  # noqa: E731, B023
        others = sorted((-score(w), j, lab == label) for t, j, lab, w in live if t != at)
        for s, j, _ in [o for o in others if o[2]][:k]:
            hard = [(-x, o) for x, o, same in others if not same and 80 * -s <= 100 * -x <= 100 * -s][:m]
            out += [(i, j, r + 1, o, -s, x) for r, (x, o) in enumerate(hard)]
    return sorted(out)


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "y") for i, v, label in rows], SCHEMA)


def run(spark, rows, every=100, parts=3):
    own = negatives.usable(table_of(spark, rows).repartition(parts))
    own = own.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return sorted(tuple(r) for r in negatives.mine(own, F.col("vec_id") % every == 0).collect())


def vectors(n, dims, seed, spread=1.0):
    pick = np.random.default_rng(seed)
    base = pick.normal(size=(6, dims))
    out = base[pick.integers(0, 6, n)] * spread + pick.normal(size=(n, dims)) * np.linspace(1, 0.05, dims)
    return [[float(x) for x in v] for v in out.astype(np.float32)]


def test_equals_all_products_in_blocks_and_tiles(spark, monkeypatch):
    for name, value in (("BLOCK_ANCHORS", 7), ("TILE_ROWS", 50), ("TILE_ANCHORS", 3), ("FIRST_ROWS", 8)):
        monkeypatch.setattr(negatives, name, value)
    pick = random.Random(1)
    rows = [(i, v, pick.randrange(10)) for i, v in enumerate(vectors(900, 12, 1))]
    got = run(spark, rows, 20)
    assert got == by_hand(rows, 20) and len(got) > 100


def test_ties_copies_nulls_and_odd_vectors(spark):
    pick = random.Random(2)
    rows = [(i, [float(pick.choice([0.0, 0.25, 0.5, -0.25])) for _ in range(3)], pick.randrange(3)) for i in range(160)]
    rows += [(0, [0.5, 0.25, 0.25], 1)] * 3 + [(100, [0.5, 0.5, 0.5], 2), (100, [0.5, 0.5, 0.5], 1), (100, [0.5, 0.5], 2), (-100, [1.0, 0.0, 0.0], -3), (200, [], 1), (300, [-0.0, 0.0, 0.0], 1), (300, [0.0, 0.0, 0.0], 1)]
    rows += [(None, [9.0, 9.0, 9.0], 1), (400, None, 1), (500, [1.0, None, 1.0], 1), (600, [float("nan"), 1.0, 1.0], 1), (700, [float("inf"), 0.0, 0.0], 1), (800, [1.0, 1.0, 1.0], None)]
    got = run(spark, rows)
    assert got == by_hand(rows)
    assert len(got) > len(set(got))  # copies of an anchor give their rows again


def test_large_components_are_multiplied_exactly(spark):
    pick = random.Random(3)
    rows = [(i, [float(np.float32(pick.uniform(-3e5, 3e5))) for _ in range(4)], pick.randrange(2)) for i in range(120)]
    got = run(spark, rows, 10)
    assert got == by_hand(rows, 10) and max(r[4] for r in got) > 2**53
    huge = [(i, [3e38 * (1 if i % 2 else -1), 1.0], i % 3) for i in range(12)]
    assert all(abs(r[4]) <= 2**63 for r in run(spark, huge, 1))


@pytest.mark.parametrize("rows", [[], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 2)], [(0, None, None)], [(3, [1.0], 1)]])
def test_nothing_to_find(spark, rows):
    assert run(spark, rows) == []


def test_rotation_drops_most_candidates_early():
    pick = np.random.default_rng(4)
    numbers = np.floor(256 * pick.normal(size=(2000, 32)) * np.geomspace(1, 0.01, 32))
    turn = np.linalg.eigh(numbers.T @ numbers)[1][:, ::-1]
    rows = negatives.Rotated(numbers, turn)
    slots = np.arange(50), np.partition(numbers[:50] @ numbers.T, -6, axis=1)[:, -6].astype(np.int64), np.full(50, negatives.I64.max)
    i, j = negatives.search_tile(rows, negatives.Rotated(numbers[:50], turn), negatives.Best(*slots, 5), slice(0, 2000), slice(0, 50))
    want = {(a, b) for b in range(50) for a in range(2000) if numbers[a] @ numbers[b] >= slots[1][b]}
    assert want <= set(zip(i.tolist(), j.tolist(), strict=True)) and len(i) < 1.01 * len(want) + 5
    assert np.abs(turn.T @ turn - np.eye(32)).max() < 1e-12


def test_copies_are_given_again_in_steps(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 7)], "x string, n long")
    assert sorted(r.x for r in negatives.repeated(rows, "n", 3).collect()) == ["a"] + ["b"] * 7
