"""Near copies by similarity, against brute force."""

import random

import corpus_pipeline
from korbwerk.llm import jaccard, simhash
from tests.llm.test_text_operators import ODD, docs_of


def _set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))}


def _roots(texts):
    sets, root = [_set(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    return root


def _near_copies(rng):
    texts = []
    for _ in range(30):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(60, 160))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = "other"
            texts.append(" ".join(copy))
    return texts


def test_near_copies_are_brute_force_s(spark):
    texts = [*ODD, *_near_copies(random.Random(11))]
    want = sorted(set(_roots(texts)))
    docs = docs_of(spark, texts)
    assert sorted(r.doc_id for r in simhash.deduplicate(docs, 5, 0.8).collect()) == want
    assert simhash.deduplicate(docs).count() > len(want)  # three bits don't reach them
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == want


def test_crowded_buckets_are_dealt_again(spark):
    rng = random.Random(12)
    texts = _near_copies(rng)[:40]
    root = _roots(texts)
    links = jaccard.find_links(docs_of(spark, texts), hot=2).collect()
    names = {r.h: i for i, r in enumerate(jaccard.by_text(docs_of(spark, texts)).collect())}
    found = list(range(len(texts)))
    for r in links:
        a, b = found[names[r.a]], found[names[r.b]]
        found = [min(a, b) if x in (a, b) else x for x in found]
    distinct = [i for i in range(len(texts)) if texts[i] not in texts[i + 1 :]]
    assert len({found[i] for i in distinct}) == len(set(root))


def test_the_stage_goes_through_fingerprints(spark, monkeypatch):
    texts = [*ODD, *_near_copies(random.Random(11)), *("same words " * 40 + f"{x} " for x in range(9))]
    docs, root = docs_of(spark, texts), _roots(texts)
    monkeypatch.setattr(simhash, "MET", 3)
    met = simhash.met_texts(docs).collect()
    of = {r.h: r.doc_id for r in simhash.fingerprinted(docs).collect()}
    links = simhash.jaccard.compared(jaccard.by_text(docs), simhash.met_texts(docs), 5, 0.8).collect()
    # what fingerprints and the exact comparison find are links of brute force, among them groups of several fingerprints
    assert met and links and all(root[of[r.a]] == root[of[r.b]] for r in links)
    # texts beyond three bits are left to the shingles, whose buckets of one known component aren't compared again
    known = simhash.components(spark.createDataFrame(links))
    more = jaccard.find_links(docs, known=known)
    assert more.count() < jaccard.find_links(docs).count()
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == sorted(set(root))
    monkeypatch.setattr(simhash.jaccard, "find_links", lambda docs, *_, **__: docs.selectExpr("doc_id as a", "doc_id as b").limit(0))
    alone = corpus_pipeline.near_duplicates(spark, docs, "").count()
    assert len(set(root)) < alone < len(set(texts))
