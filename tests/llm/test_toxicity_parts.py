"""Operator 4 part by part, against plain Python."""

import math
import random

import numpy as np
import pyarrow as pa

from korbwerk.llm import toxicity
from tests.llm.test_text_operators import ODD, docs_of

LEXICON, STEMS = {"zark": 5.0, "blip": 2.5, "idiot": 4.0}, {"grum": 3.0, "blipp": 4.5}


def _features(text):
    words = [w for w in (text or "").translate({c: 32 for c in range(9, 14)}).split(" ") if w]
    n = len(words)
    if not n:
        return [0.0] * len(toxicity.FEATURES)

    def weight(core):
        return max([LEXICON.get(core, 0.0), *(STEMS.get(core[:k], 0.0) for k in toxicity.STEMS if len(core) > k)])

    cores = [toxicity.term(w) for w in words]
    odd = [any(c.isalpha() for c in x) and not x.isalpha() and not "".join(c for c in x if c not in "-'’").isalpha() for x in cores]
    plain = ["".join(c for c in x.translate(toxicity.DISGUISES) if c.isalpha()) for x in cores]
    weights = [weight(x) for x in cores]
    hits = [i for i in range(n) if weights[i] > 0]
    toxic = [i for i in range(n) if weights[i] > 0 or odd[i] and weight(plain[i]) > 0]
    second = [i for i in range(n) if cores[i] in toxicity.SECOND]
    near = sum(any(abs(i - j) <= toxicity.NEAR for j in second) for i in toxic)
    letters = [sum(c.isalpha() for c in w) for w in words]
    upper = [sum(c.isupper() for c in w) for w in words]
    marks = [w.count("!") + w.count("?") for w in words]
    strong = sum(x >= math.log(toxicity.STRONG) for x in weights)
    stretched = sum(len(x) > 3 and any(x[i] == x[i + 1] == x[i + 2] for i in range(len(x) - 2)) for x in cores)
    return [
        math.log1p(n), len(hits) / n, len(hits), len({words[i] for i in toxic}), sum(weights) / n, sum(weights), strong / n, strong, near / n, near, sum(upper) / max(sum(letters), 1),
        sum(a > 2 and a == b for a, b in zip(letters, upper, strict=True)) / n, sum(marks) / n, sum(len(w) - a - m for w, a, m in zip(words, letters, marks, strict=True)) / n, sum(odd) / n,
        sum(o and weight(p) > 0 for o, p in zip(odd, plain, strict=True)), stretched / n,
    ]


def test_features_are_those_of_a_plain_loop():
    rng = random.Random(31)
    parts = ["zark", "ZARK!", "z4rk", "bl1p", "blip,", "blippy", "grumpf", "you", "Your", "dich", "word", "noooo", "WHAT?!", "a", "...", "don't", "é", "1d10t", "\n", "\t", "x" * 300]
    texts = [*ODD, *(" ".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(200))]
    got = toxicity.Features(LEXICON, STEMS, cached=500)(pa.array(texts))
    np.testing.assert_allclose(got, [_features(t) for t in texts], atol=1e-9)


def _fit(x, y, trees):
    """Boosting with every cut of every feature tried by a loop."""
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    score, model = np.full(len(y), math.log(share / (1 - share))), []
    cuts = []
    for j in range(x.shape[1]):
        own = x[x[:, j] > x[:, j].min(), j]
        cuts.append([x[:, j].min(), *np.unique(np.quantile(own, np.linspace(0, 1, toxicity.BINS)))[:-1]] if len(own) else [])
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)

        def grow(own, depth):
            best = (1e-6, None, None)
            for j, of in enumerate(cuts):
                for c in of if depth and len(own) >= 2 * toxicity.LEAF else ():
                    left, right = own[x[own, j] <= c], own[x[own, j] > c]
                    if min(len(left), len(right)) >= toxicity.LEAF:
                        gain = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, right)) - g[own].sum() ** 2 / (h[own].sum() + 1)
                        if gain > best[0] + 1e-12:
                            best = (gain, j, c)
            _, j, c = best
            if j is None:
                return toxicity.RATE * g[own].sum() / (h[own].sum() + 1)
            return j, c, grow(own[x[own, j] <= c], depth - 1), grow(own[x[own, j] > c], depth - 1)

        model.append(grow(np.arange(len(y)), toxicity.DEPTH))
        score = score + [value(model[-1], r) for r in x]
    return share, model


def value(node, row):
    while isinstance(node, tuple):
        node = node[2] if row[node[0]] <= node[1] else node[3]
    return node


def test_trees_are_those_of_an_exhaustive_search():
    rng = np.random.default_rng(32)
    x = np.round(rng.normal(size=(90, 3)), 1)
    x[:, 2] = rng.integers(0, 2, 90)
    y = (x[:, 0] * x[:, 1] + 0.3 * rng.normal(size=90) > 0).astype(float)
    share, model = _fit(x, y, 4)
    want = math.log(share / (1 - share)) + np.array([sum(value(t, r) for t in model) for r in x])
    np.testing.assert_allclose(toxicity.fit_trees(x, y, 4).raw(x), want, atol=1e-9)


def test_calibration_is_the_isotonic_regression():
    rng = np.random.default_rng(33)
    raw = np.sort(rng.normal(size=60))
    y = (rng.random(60) < 1 / (1 + np.exp(-2 * raw))).astype(float)
    at, knots = toxicity.fit_isotonic(raw, y)
    v = np.concatenate([[0], y, [1]])  # a case of each class at the ends
    n = len(v)
    best = [max(min(v[a : b + 1].mean() for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
    assert (np.diff(knots) > 0).all() and (np.diff(at) > 0).all()
    np.testing.assert_allclose(np.unique(np.round(best, 9)), np.round(knots, 9))


def test_repeated_documents_do_not_pass_the_bound_on_training_rows(spark):
    docs = docs_of(spark, ["b text", "other"]).withColumnRenamed("score", "toxic")
    copies = docs.unionByName(docs).unionByName(docs)
    labels = spark.createDataFrame([(0, 1), (0, 1), (1, 0), (None, 1), (1, 7)], "doc_id long, toxic int")
    rows = toxicity.training_rows(copies, labels, 5).collect()
    assert len(rows) <= 3
    model = toxicity.fit(copies, labels)
    scored = toxicity.score_documents(copies, model).collect()
    assert len(scored) == 6 and len({(r.doc_id, r.score) for r in scored}) == 2
    empty = toxicity.fit(docs.limit(0), labels)
    assert empty.trees is None and toxicity.score_documents(docs.limit(0), empty).count() == 0
