"""Rounds of contraction, components and the fold, against the sequential filter."""

import random

import pytest

from korbwerk.operators import dedup

SCHEMA = "ordinal long, _ref string, _near string, _cross string"


def sequential(rows):
    taken, out = set(), set()
    for ordinal, *keys in sorted(rows):
        own = {(i, k) for i, k in enumerate(keys) if k is not None}
        if not own & taken:
            taken |= own
            out.add(ordinal)
    return out


def run(spark, rows, **kw):
    got = [r.ordinal for r in dedup.greedy(spark.createDataFrame(rows, SCHEMA), **kw).collect()]
    assert len(got) == len(set(got))
    return set(got)


def shapes():
    pick = random.Random(1)
    yield "random", [(i, *(f"{pick.randrange(60)}" if pick.random() < 0.6 else None for _ in range(3))) for i in pick.sample(range(1000), 150)]
    yield "hot key", [(i, "hot" if pick.random() < 0.7 else None, f"{pick.randrange(30)}", None) for i in range(150)]
    yield "two before each", [(i, f"a{i // 2}", f"b{(i + 1) // 2}", f"c{i // 3}") for i in range(80)]
    yield "grid", [(i, f"{i % 9}", f"{i // 9}", f"{(i % 9) - i // 9}") for i in range(81)]
    yield "no keys", [(i, None, None, None) for i in range(5)]


@pytest.mark.parametrize(("name", "rows"), list(shapes()))
def test_equals_the_sequential_filter(spark, name, rows):
    assert run(spark, rows) == sequential(rows)
    assert run(spark, rows, fold_rows=20) == sequential(rows)


def test_rounds_alone_and_fold_alone_agree(spark, monkeypatch):
    rows = dict(shapes())["random"]
    monkeypatch.setattr(dedup, "ROUNDS", 1)
    assert run(spark, rows, fold_rows=3) == sequential(rows)
    monkeypatch.setattr(dedup, "ROUNDS", 2)
    assert run(spark, rows, fold_rows=0) == sequential(rows)


def test_a_chain_takes_few_rounds(spark, monkeypatch):
    """10,000 rows, each of which collides with the one before it alone."""
    n, rounds = 10_000, []
    kept = dedup.materialise
    monkeypatch.setattr(dedup, "materialise", lambda df: rounds.append(1) or kept(df))
    rows = [(i, f"k{i // 2}", f"l{(i + 1) // 2}", None) for i in range(n)]
    assert run(spark, rows, fold_rows=0) == set(range(0, n, 2))
    assert len(rounds) <= 20


def test_no_rows(spark):
    assert run(spark, []) == set()


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 102), (104, 102), (7, 7), (200, 3)]
    got = {r.node: r.root for r in dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {n for n, r in got.items() if r == 0} == set(range(1, 61)) | {200} and {n for n, r in got.items() if r == 100} == {102, 104}
