"""Operator 13: similarity of signatures against generalised Jaccard, neighbours against plain order."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from korbwerk.llm import weighted_fingerprint as wf

SCHEMA = "doc_id long, text string, row long, task int, edge int"


def words(text):
    return Counter("".join(c.lower() if c.isascii() else c for c in text).encode().split())


def jaccard(a, b):
    a, b = words(a), words(b)
    return (sum((a & b).values()) / sum((a | b).values())) if a | b else 1.0


def test_collisions_follow_generalised_jaccard():
    pick = random.Random(1)
    names = [f"w{i}" for i in range(60)]
    texts = [" ".join(pick.choices(names, weights=[1 / (i + 1) for i in range(60)], k=pick.randrange(5, 400))) for _ in range(60)]
    prints = wf.fingerprints(pa.array(texts), 8192)
    gaps = [float((prints[i] == prints[j]).mean()) - jaccard(texts[i], texts[j]) for i in range(60) for j in range(i)]
    # sqrt(J (1 - J) / 8192) is 0.006 at most; pairs share their draws, so the mean has about that error too
    assert abs(np.mean(gaps)) < 0.004 and np.abs(gaps).max() < 0.03


def test_samples_are_consistent_in_the_weight():
    """A larger weight keeps the samples that the smaller one has, in the share that Jaccard gives."""
    hashes = np.arange(1, 2, dtype=np.uint64)
    for w in (2, 3, 10):
        a, b = (wf.sample_table(np.repeat(hashes, 1), np.array([float(x)]), 20_000)[0] & wf.LOW for x in (1, w))
        assert abs(float((a == b).mean()) - 1 / w) < 0.015


def test_equal_texts_whatever_the_chunk(monkeypatch):
    pick = random.Random(2)
    texts = [" ".join(pick.choices("abcdefghij", k=pick.randrange(50))) for _ in range(200)] + ["", "  ", "A b", "a B"]
    whole = wf.fingerprints(pa.array(texts))
    monkeypatch.setattr(wf, "TABLE_ROWS", 7)
    monkeypatch.setattr(wf, "GATHER_ROWS", 5)
    assert (wf.fingerprints(pa.array(texts[::-1]))[::-1] == whole).all()
    assert not whole[-4:-2].any() and whole[:150].any(axis=1).sum() > 140 and (whole[-1] == whole[-2]).all()


def by_hand(rows):
    texts = [t or "" for _, t in rows]
    out = []
    for k, (i, _) in enumerate(rows):
        text, following = texts[k], texts[(k + 1) % len(rows)]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = (wf.fingerprints(pa.array([x]))[0] for x in (text, edited, following))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), a.astype(">u2").tobytes().hex(), b.astype(">u2").tobytes().hex(), float((a == b).mean()), float((a == c).mean())))
    return sorted(out, key=str)


def run(spark, rows, parts):
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], SCHEMA)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        return sorted((tuple(r) for r in wf.likeness_of_neighbours(docs.repartition(3)).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_neighbours_over_many_tasks(spark):
    pick = random.Random(3)
    rows = [(i * 3 - 20, None if i % 11 == 0 else "".join(pick.choices("ab \U0001f600é\n", k=pick.randrange(60)))) for i in range(80)]
    mixed = rows[:]
    pick.shuffle(mixed)
    for parts in (1, 7, 60):
        assert run(spark, mixed, parts) == by_hand(rows)


def test_nulls_copies_and_few_rows(spark):
    assert run(spark, [], 4) == []
    assert run(spark, [(5, "abcd ef")], 4) == by_hand([(5, "abcd ef")])
    hot = [(None, "first one")] + [(7, "the same text here")] * 60 + [(9, "z last")]
    assert run(spark, hot, 8) == by_hand(hot)


def test_very_long_text(spark):
    long = " ".join(f"w{i % 1000}" for i in range(900_000))
    rows = [(1, long), (2, "kurz " * 10), (3, "")]
    assert run(spark, rows, 4) == by_hand(rows)
