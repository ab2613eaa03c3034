"""Operator 11 against plain counting, on odd tables and with tiny chunks."""

import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from korbwerk.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def by_hand(rows, documents=10, best=10):
    n, docs, groups = Counter(), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = ["".join(c.lower() if c.isascii() else c for c in t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        n.update((lang, source, t) for t in terms)
        docs.update((lang, t) for t in set(terms))
    kept = defaultdict(list)
    for (lang, t), k in docs.items():
        if k >= documents:
            kept[lang].append(t)
    out = []
    for lang, source in groups:
        terms, sources = kept[lang], [s for g, s in groups if g == lang]
        v, sums = len(terms), {s: sum(n[lang, s, t] for t in kept[lang]) for s in sources}
        p = {s: {t: 1 + 10**9 * (n[lang, s, t] + 2) // (sums[s] + 2 * v) for t in terms} for s in sources}
        q = {t: 1 + 10**9 * (sum(n[lang, s, t] for s in sources) + 2) // (sum(sums.values()) + 2 * v) for t in terms}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        pairs = sorted((-sum(f(p[source][t], p[s][t]) for t in terms), s.encode(), s) for s in sources if s != source)
        out += [(lang, source, "pair", s, -x, i + 1) for i, (x, _, s) in enumerate(pairs)]
        marks = sorted((-f(p[source][t], q[t]), t.encode(), t) for t in terms if n[lang, source, t] and p[source][t] > q[t])
        out += [(lang, source, "term", t, -x, i + 1) for i, (x, _, t) in enumerate(marks[:best])]
    return sorted(out)


def rows_of(n, seed):
    import random

    pick = random.Random(seed)
    words = ["Straße", "straße", "a", "B", "b", "c_d", "été", "ÉTÉ", "日本", "x9y", "tail", "\U0001f600", "Mix", "mIX"]
    out = []
    for i in range(n):
        text = None if i % 17 == 0 else "" if i % 19 == 0 else " ".join(pick.choices(words, weights=range(1, 15), k=pick.randrange(40)))
        out.append((text, pick.choice(["de", "en", None, ""]), pick.choice(["s1", "s1", "s1", "s1", "s2", "S", None, "é"])))
    return out + [("9 ... _", "leer", "a"), (None, "leer", "b"), ("once", "leer", None)]


def run(spark, rows, **kw):
    docs = spark.createDataFrame([(i if i % 5 else None, *r, 0) for i, r in enumerate(rows)], SCHEMA)
    return sorted(tuple(r) for r in divergence.audit(docs.repartition(3), **kw).collect())


def test_counts_pairs_and_terms(spark):
    rows = rows_of(400, 1)
    got = run(spark, rows)
    assert got == by_hand(rows)
    assert ("leer", "a", "pair", "", 0, 1) in got and {r[2] for r in got} == {"pair", "term"}


def test_small_chunks_and_hot_terms_give_the_same(spark, monkeypatch):
    # workers are forked with the module as it is pickled, so functions get the small constants
    rows = rows_of(200, 2) + [("hot " * 50, "en", f"s{i % 40}") for i in range(200)]
    monkeypatch.setattr(divergence, "CHUNK_ROWS", 30)
    monkeypatch.setattr(divergence, "CHUNK_PAIRS", 20)
    assert run(spark, rows, documents=3, best=4) == by_hand(rows, 3, 4)


def test_chunks_end_with_a_term(monkeypatch):
    monkeypatch.setattr(divergence, "CHUNK_ROWS", 5)
    rows = [("l", f"s{i}", t, 1, 1) for t in "abcd" for i in range(7)]
    table = pa.Table.from_pylist([dict(zip(divergence.COUNTS.names, r, strict=True)) for r in rows], schema=divergence.COUNTS)
    chunks = list(divergence.whole_terms(iter(table.to_batches(max_chunksize=3))))
    assert sum(c.num_rows for c in chunks) == 28
    seen = [t for c in chunks for t in set(c.column("term").to_pylist())]
    assert len(chunks) > 1 and len(seen) == len(set(seen))


def test_hot_term_is_added_up_before_its_chunk_is_whole(monkeypatch):
    monkeypatch.setattr(divergence, "CHUNK_ROWS", 10)
    table = pa.Table.from_pylist([{"lang": "l", "source": f"s{i % 2}", "term": "hot", "n": 1, "docs": 1} for i in range(100)], schema=divergence.COUNTS)
    kept = pa.Table.from_batches(list(divergence.keep_terms(iter(table.to_batches(max_chunksize=4)))))
    assert sorted(zip(kept.column("source").to_pylist(), kept.column("n").to_pylist(), kept.column("lang_n").to_pylist(), strict=True)) == [("s0", 50, 100), ("s1", 50, 100)]


@pytest.mark.parametrize("rows", [[], [(None, None, None)], [("one", "en", "a")]])
def test_empty_tables_and_lone_groups(spark, rows):
    assert run(spark, rows) == []


def test_very_long_text_and_other_columns(spark):
    long = "Wort été " * 700_000  # above 6 MB
    docs = spark.createDataFrame([(1, long, "de", "a", "x")] + [(i, "wort", "de", "b", "y") for i in range(12)], "doc_id long, text string, lang string, source string, term string")
    got = {tuple(r) for r in divergence.audit(docs).collect()}
    assert got == set(by_hand([(long, "de", "a")] + [("wort", "de", "b")] * 12))


def test_joins_by_key_give_the_same(spark, monkeypatch):
    from korbwerk.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    rows = rows_of(150, 3)
    assert run(spark, rows) == by_hand(rows)
