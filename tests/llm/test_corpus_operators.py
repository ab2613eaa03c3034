"""Operators 1, 2, 4, 6 and 9 on small tables, against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

from korbwerk.llm import perspectives, pii, simhash, suffix_tree, toxicity
from tests.llm.test_text_operators import ODD, docs_of


def _tree(docs, depth):
    """Scores of the model in plain dictionaries."""
    s = suffix_tree
    rows = [(zlib.crc32(str(i).encode()) % 10 == 0 and i is not None, (t or "").encode().lower().split() + [s.END]) for i, t in docs]
    c, g = Counter(), defaultdict(Counter)
    for held_out, w in rows:
        if not held_out:
            c.update(w)
            for d in range(1, depth + 1):
                for k in range(d, len(w)):
                    g[tuple(w[k - d : k])][w[k]] += 1
    n, v = sum(c.values()), len(c)
    once, twice = sum(x == 1 for x in c.values()), sum(x == 2 for x in c.values())
    d0 = min(max(once / max(once + 2 * twice, 1), 0.05), 0.95)
    retained = {}

    def p(context, w):
        if not context:
            return 2 ** (-round(-math.log2((c[w] - d0) / n if c[w] else d0 * v / n) * s.STEP) / s.STEP)
        if context not in retained:
            return p(context[1:], w)
        listed, back, total = retained[context]
        return max(listed.get(w, 0) - s.DISCOUNT, 0) / total + back * p(context[1:], w)

    for d in range(1, depth + 1):
        new = {}
        for context, x in g.items():
            total, listed = sum(x.values()), {w: k for w, k in x.items() if k >= s.MIN_SYMBOL}
            if len(context) == d and total >= s.MIN_CONTEXT and listed:
                gain = sum(k * (math.log2((k - s.DISCOUNT) / total) - math.log2(p(context[1:], w))) for w, k in listed.items())
                if gain > s.COST_BITS * (len(listed) + 1):
                    new[context] = (listed, max(1 - (sum(listed.values()) - s.DISCOUNT * len(listed)) / total, 1e-6), total)
        retained |= new
    out = []
    for held_out, w in rows:
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w) if n else 0
        score = sum(math.log10(p(tuple(w[max(k - depth, 0) : k]), x)) for k, x in enumerate(w)) if n else 0
        out.append((held_out, len(w), sum(c[x] > 0 for x in w), n, base, score))
    return out, retained


def _same_scores(rows, want, ids):
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), r.score) for r in rows)
    want = sorted((str(i), *w[:4], round(w[4], 4), w[5]) for i, w in zip(ids, want, strict=True))
    assert [x[:5] for x in got] == [x[:5] for x in want]
    np.testing.assert_allclose([x[5:] for x in got], [x[5:] for x in want], rtol=2e-3)


def test_suffix_tree(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    phrase = " ".join(rng.choices(words, k=12))
    texts = [*ODD, *(" ".join(rng.choices(words, k=rng.randint(0, 30))) + (f" {phrase}" if i % 3 else "") for i in range(120)), *["left mid one yes", "right mid one no"] * 15]
    monkeypatch.setattr(suffix_tree, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(suffix_tree, "BUCKET_TOKENS", 500)
    for depth, hot in ((3, 8), (5, 2), (4, 1 << 19)):  # of frequent contexts on all levels, on some, and on none
        want, retained = _tree(list(enumerate(texts)), depth)
        assert {1, 2, 3} <= {len(c) for c in retained}
        monkeypatch.setattr(suffix_tree, "HOT_CONTEXT", hot)
        _same_scores(suffix_tree.score_documents(docs_of(spark, texts), depth).collect(), want, range(len(texts)))
    assert spark.sql("SHOW TABLES").count() == 0


def test_blocks_lie_in_the_checkpoint_folder(spark):
    kept = suffix_tree.keep_by_block(spark.range(20).selectExpr("id as block", "cast('x' as binary) as payload"))
    folder = f"{spark.sparkContext.getCheckpointDir()}/{kept}"
    assert all(f.startswith(folder.replace("file:///", "file:/")) or f.startswith(folder) for f in (f.replace("file:///", "file:/") for f in spark.table(kept).inputFiles()))
    assert "Exchange" not in spark.table(kept).groupBy("block").count()._jdf.queryExecution().executedPlan().toString()
    suffix_tree.forget(spark, kept)
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert not spark.catalog.tableExists(kept) and not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def test_suffix_tree_of_repeated_rows_null_ids_and_no_rows(spark):
    rows = [(None, "a b c a b c"), (None, None), *[(7, "a b c d")] * 6, *[(10, "b c d")] * 3, (3, "x")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 0.5) for i, t in rows], "doc_id long, text string, lang string, payload string, block long, score double")
    _same_scores(suffix_tree.score_documents(docs).collect(), _tree(rows, suffix_tree.DEPTH)[0], [i for i, _ in rows])
    assert suffix_tree.score_documents(docs_of(spark, [])).count() == 0
    alone = suffix_tree.score_documents(docs.where("doc_id = 7").limit(1)).collect()
    assert [(r.n_tokens, r.train_tokens) for r in alone] == [(5, 5)]


def test_perspectives(spark):
    rows = [(1, 0, "system", "be"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, "ann", "é!"), (2, 0, "system", "alone"), (None, None, " ", "x"), (3, 0, "ann", "a"), (3, 300, "ann", "b")]
    got = {(r.conv_id, r.perspective, r.part): r for r in perspectives.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert set(got) == {(1, "ann", 0), (1, "bob", 0), (None, "unknown", -1), (3, "ann", 0), (3, "ann", 1)}
    ann = got[1, "ann", 0]
    assert [ann.rendered[int(a) : int(b)] for a, b in (x.split(":") for x in ann.mask.split(","))] == ["hi<|end|>", "é!<|end|>"]
    assert "user name=bob" in ann.rendered and "<|turn|>system\nbe" in ann.rendered and ann.n_chars == len(ann.rendered)


def test_toxicity(spark):
    rng = random.Random(5)
    words = [f"word{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=40)) + (" you idiot grumblar loser" if i % 7 == 0 else "") for i in range(800)]
    labels = spark.createDataFrame([(i, int(i % 7 == 0), 1) for i in range(800)], "doc_id long, toxic int, quality int")
    docs = docs_of(spark, [*texts, None, ""])
    rows = toxicity.score_documents(docs, toxicity.fit(docs, labels)).collect()
    assert len(rows) == 802 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    judged = [(r.predicted, int(r.doc_id % 7 == 0)) for r in rows if r.held_out and r.doc_id < 800]
    assert sum(a == b for a, b in judged) >= 0.98 * len(judged)
    assert {r.score for r in toxicity.score_documents(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {0.0}


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(d):
    return sum((int(c) * (1 + i % 2) - 9 * (int(c) * (1 + i % 2) > 9)) for i, c in enumerate(reversed(d))) % 10 == 0


def _base(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(d) <= 19 and _luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def test_pii(spark):
    rng = random.Random(6)
    parts = ["a", "b.c", "@", "x@y.de", "_", ".", "1", "12", "255", "256", "1.2.3.4", "+", "+4", "-", " ", "(", "4111111111111111", "\n", "é", "😀", "0"]
    texts = [*ODD, "a@b.c " * 700, "9" * 3000, *("".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(400))]
    for r in pii.score_documents(docs_of(spark, texts)).collect():
        assert [s for s in r.spans.split(",") if s and not s.startswith("term")] == _base(texts[r.doc_id])
        assert r.n_email + r.n_ip + r.n_card + r.n_phone == len(_base(texts[r.doc_id]))
    # a rare name that stands beside one address in several texts discloses it; common words don't
    texts = [f"number {i} please ask Grumblefax about it at grum@example.org today" for i in range(5)] + [f"please ask number {i} about it today" for i in range(400)] + ["we saw Grumblefax again"]
    rows = {r.doc_id: r for r in pii.score_documents(docs_of(spark, texts)).collect()}
    assert rows[405].spans == "term:7:17" and rows[0].spans.count("term") == 1 and rows[100].spans == ""
    clean = {r.doc_id: r.text for r in pii.sanitise(docs_of(spark, [*texts, None]).withColumnRenamed("score", "_p_text")).collect()}
    assert clean[405] == "we saw [TERM] again" and clean[0] == "number 0 please ask [TERM] about it at [EMAIL] today" and clean[406] is None
    assert pii.score_documents(docs_of(spark, [])).count() == pii.sanitise(docs_of(spark, [])).count() == 0


def _terms(texts):
    """Disclosing terms, by plain counting over distinct texts."""
    import regex

    edge = r"[\p{L}\p{N}'-]"
    word = regex.compile(rf"(?<!{edge})\p{{L}}[\p{{L}}\p{{N}}'-]{{3,}}+")
    near, holds = defaultdict(set), defaultdict(set)
    for n, text in enumerate(set(texts)):
        words = [(m.start(), m.end(), "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[0])) for m in word.finditer(text)]
        for _, _, w in words:
            holds[w].add(n)
        valid = set(_base(text))
        for kind, pattern in PATTERNS.items():
            at = [m for m in re.finditer(pattern, text)]
            for i, m in enumerate(at):
                if f"{kind}:{m.start()}:{m.end()}" not in valid:
                    continue
                left, right = at[i - 1].end() if i else 0, at[i + 1].start() if i + 1 < len(at) else len(text)
                own = [w for a, _, w in words if left <= a < m.start()][-pii.NEAR :] + [w for a, _, w in words if m.end() <= a < right][: pii.NEAR]
                name = kind + ":" + (re.sub("[^0-9]", "", m[0]) if kind in ("card", "phone") else m[0].lower())
                for w in own:
                    near[w, name].add(n)
                near[None, name].add(n)
    out = set()
    for (w, name), own in near.items():
        if w and len(own) >= pii.SUPPORT and len(own) / (len(holds[w]) + 0.5) >= pii.SHARE and math.log2(len(own) * len(set(texts)) / len(holds[w]) / len(near[None, name])) >= 1:
            out.add((w, name))
    return out


def test_disclosing_terms_are_brute_force_s(spark):
    rng = random.Random(16)
    names = [f"name{chr(97 + i)}x" for i in range(8)]
    entities = ["anna@x.de", "10.1.2.3", "+49 30 1234567", "4111 1111 1111 1111", "999.1.2.3", "bob-b@y.org"]
    parts = [*names, "word" + "y" * 170, "this", "that's", "Über-all", "row", "7", ",", "é", "Namea", "x1", "@", "name"]
    texts = ["".join(rng.choice((x, x + " ", x + " ")) for x in rng.choices([*parts, *entities], k=rng.randint(1, 14))) for _ in range(300)]
    texts += [f"{names[i]} wrote to {entities[i % 3]} {j}" for i in range(4) for j in range(3)] + [f"nothing in text {i}" for i in range(200)]
    texts += [f"row 7grumble {entities[0]} {i}" for i in range(4)] + ["a grumble here", f"farnamex {'w' * 170} {entities[5]}", f"farnamex {'v' * 170} {entities[5]}"]
    pairs, _ = pii.disclosing_terms(docs_of(spark, texts), bits=1)
    want = _terms(texts)
    assert {(r.term, r.entity) for r in pairs.collect()} == want and len(want) > 3
    assert "grumble" not in {w for w, _ in want} and ("farnamex", "email:bob-b@y.org") in want


def test_a_sanitised_text_has_each_span_once(spark):
    texts = [f"email zorbus: q@b.de {i}" for i in range(4)] + [f"other text {i}" for i in range(300)] + ["4111111111111111@x.de and +4111111111111 ok 1.2.3.4"]
    clean = {r.doc_id: r.text for r in pii.sanitise(docs_of(spark, texts)).collect()}
    assert clean[0] == "[TERM] [TERM]: [EMAIL] 0" and clean[304] == "[EMAIL] and [PHONE] ok [IP]"


def test_simhash(spark, monkeypatch):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(80)]
    texts = [*ODD]
    for _ in range(25):
        base = rng.choices(words, k=rng.randint(1, 60))
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            if rng.random() < 0.7:
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))

    def fp(t):
        w = (t or "").encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(len(w) - 2, 1))] if w else []
        return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))

    fps = [fp(t) for t in texts]
    for hot in (simhash.HOT, 2):  # 2: crowded buckets are dealt again
        monkeypatch.setattr(simhash, "HOT", hot)
        monkeypatch.setattr(simhash.find_links, "__defaults__", (simhash.BITS, hot))
        rows = {r.doc_id: r for r in simhash.score_documents(docs_of(spark, texts)).collect()}
        root = list(range(len(fps)))
        for i in range(len(fps)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= 3:
                    a, b = root[i], root[j]
                    root = [min(a, b) if x in (a, b) else x for x in root]
        assert all(rows[i].fingerprint == f"{x:016x}" and rows[i].component_id == root[i] for i, x in enumerate(fps))
    kept = [r.doc_id for r in simhash.deduplicate(docs_of(spark, texts)).collect()]
    assert sorted(kept) == sorted(set(root))


def test_forest_is_brute_force_on_dense_groups():
    rng = np.random.default_rng(8)
    items = np.unique(np.concatenate([rng.integers(0, 1 << 63, 300).astype(np.uint64), *(np.uint64(c) ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)) for c in rng.integers(0, 1 << 63, 3))]))
    forest = simhash.Forest(items, np.zeros(len(items), np.int64))
    forest.join()
    near = np.bitwise_count(forest.items[:, None] ^ forest.items[None, :]) <= 3
    label = np.arange(len(items))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            break
        label = new
    assert (label == forest.parent).all()
