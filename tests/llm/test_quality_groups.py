"""Operator 10: fences follow the spread of a document's own group, and are what the plain computation gives."""

import math
import random
from collections import defaultdict

from korbwerk.llm import quality
from tests.llm.test_text_operators import DOCS, ODD


def _text(rng, n=60, symbols=0, again=0, longer=0, lines=0):
    words, again = [f"w{rng.randint(10000, 99999)}" + "x" * longer for _ in range(n)], min(again, n - 1)
    words[:symbols] = ["#" + w for w in words[:symbols]]
    for i in range(n - again, n):
        words[i] = words[n - again - 1]
    return "\n".join([" ".join(words), *(["one line more"] * lines)])


def _measures(text):
    words = [w for w in (text or "").translate({c: 32 for c in range(9, 14)}).split(" ") if w]
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\r\x0b\x0c")]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(5)}
    counts = [sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(twice), sum(a == b for a, b in zip(words, words[1:], strict=False))]
    of = [len(words), len(lines), len(words), len(words)]
    return len(words), counts[2], [*((math.log((c + 0.5) / (n + 1)), math.log((c - 2 * c**0.5 + 0.5) / (n + 1)) if c > 4 else -99) for c, n in zip(counts, of, strict=True)), [math.log(sum(map(len, words)) / len(words)) if words else 0] * 2]


def _quartiles(values):
    bins = sorted(math.floor(v / quality.BIN) for v in values)
    return [(bins[math.ceil(len(bins) * i / 4) - 1] + edge) * quality.BIN for i, edge in ((1, 0), (3, 1))]


def _pooled(values, parent):
    return [(len(values) * x + quality.PRIOR * y) / (len(values) + quality.PRIOR) for x, y in zip(_quartiles(values), parent, strict=True)]


def _kept(rows):
    found = [_measures(r[1]) for r in rows]
    groups, langs, everything = defaultdict(list), defaultdict(list), []
    for r, (n, _, x) in zip(rows, found, strict=True):
        if n:
            groups[r[2], r[3]].append(x)
            langs[r[2]].append(x)
            everything.append(x)
    out = []
    for r, (n, repeated, x) in zip(rows, found, strict=True):
        good = n >= 10 and 100 * repeated <= 20 * n
        for k, (value, judged) in enumerate(x):
            if good:
                column = lambda xs, k=k: [y[k][0] for y in xs]
                low, high = _pooled(column(groups[r[2], r[3]]), _pooled(column(langs[r[2]]), _quartiles(column(everything))))
                good = not judged > high + 3 * (high - low) + 1e-9 and not (k == 4 and value < low - 3 * (high - low) - 1e-9)
        out.append(good)
    return out


def test_kept_is_brute_force_s(spark):
    rng = random.Random(21)
    texts = [*ODD, *(_text(rng, rng.randint(5, 60), *(rng.choice((0, 0, 0, rng.randint(0, 20))) for _ in range(4))) for _ in range(400))]
    rows = [(i if i % 9 else None, t, rng.choice(("en", "de", None)), rng.choice(("a", "a", "a", "b", None)), 1, 0.5) for i, t in enumerate(texts)]
    rows += rows[-30:]
    docs = spark.createDataFrame(rows, DOCS)
    want = sorted((str(r[0]), k) for r, k in zip(rows, _kept(rows), strict=True))
    assert 50 < sum(k for _, k in want) < len(rows) - 50
    for _ in range(2):  # no part of it is random
        assert sorted((str(r.doc_id), r.kept) for r in quality.score_documents(docs.repartition(3)).collect()) == want
    named = docs.withColumnRenamed("score", "_q_kept")
    got = quality.filter_documents(named)
    assert got.columns == named.columns and sorted(str(r.doc_id) for r in got.collect()) == sorted(i for i, k in want if k)


def test_groups_of_different_spread_judge_a_text_differently(spark):
    rng = random.Random(13)
    kinds = {"symbols": 25, "again": 12, "longer": 3}
    rows, probes = [], {}
    for kind, value in kinds.items():
        for source in ("even", "wide"):
            for i in range(300):
                much = rng.randint(0, value) if source == "wide" and i % 3 else 0
                rows.append((len(rows), _text(rng, rng.randint(50, 70), **{kind: much}), kind, source, 1, 0.5))
            probes[kind, source] = len(rows)
            rows.append((len(rows), _text(rng, **{kind: value}), kind, source, 1, 0.5))
    kept = {r.doc_id: r.kept for r in quality.score_documents(spark.createDataFrame(rows, DOCS)).collect()}
    assert [k for k in ("symbols", "longer") if not kept[probes[k, "wide"]]] == []
    assert [k for k in ("symbols", "longer") if kept[probes[k, "even"]]] == []


def test_fences_are_broadcast_and_texts_do_not_move(spark):
    docs = spark.createDataFrame([(i, f"some words of a text that is number {i} here", "en", f"s{i % 3}", 1, 0.5) for i in range(30)], DOCS)
    plan = quality.filter_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
