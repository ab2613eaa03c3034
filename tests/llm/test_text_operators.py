"""Operators 3, 5, 7, 8 and 10 on small tables with nulls, empty and odd texts."""

import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from korbwerk.llm import bpe, decontaminate, quality, token_counts, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double"
ODD = [None, "", " ", "\n\n", "a", "A  b\tc\x0bd", "é\u0301 ß İ Σ", "x" * 5000, "\x1c \x85\u2028\u00a0", "<|endoftext|> a <|startoftext|>", "don't 's 12 ²ª"]


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en" if i % 2 else None, "s", 1, 0.5) for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    parts = ["a", "B", "'s", " ", "  ", "\n", "é", "Σ", "12", "!?", "日本", "\u0301", "the", " of", "\u00a0", "<|endoftext|>"]
    return ODD + ["".join(rng.choices(parts, k=rng.randint(0, 20))) for _ in range(300)]


def test_token_counts_are_the_library_s(spark, texts):
    path = token_counts.tokenizer_path(token_counts.TOKENIZER)
    tokenizer = token_counts.load_tokenizer(path)
    rows = token_counts.count_tokens(docs_of(spark, texts), path, frequent=10, cached=50).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(tokenizer.encode(text, add_special_tokens=False).ids))
        assert r.over_limit == (r.n_tokens > 1024)


def test_bpe_is_the_library_s(spark, texts):
    path = token_counts.tokenizer_path(bpe.TOKENIZER)
    tokenizer = token_counts.load_tokenizer(path)
    for r in bpe.encode(docs_of(spark, texts), path).collect():
        ids = tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded == tokenizer.decode(ids, skip_special_tokens=False)
    r = bpe.encode(docs_of(spark, ["ab cd"]), path, with_ids=False).first()
    assert r.ids_sha256 == hashlib.sha256(np.array(tokenizer.encode("ab cd").ids, "<u4").tobytes()).hexdigest()


def test_forced_cuts_lie_only_where_no_token_goes():
    model = bpe.ForcedBoundaryBpe(token_counts.tokenizer_path(bpe.TOKENIZER))
    for word in ("hello", "zqxjw", "ÃŁÃŁ"):
        assert "".join(model.cut(word)) == word
    assert all(x[-1] + y[0] not in model.inside for x, y in [(a, b) for w in ("qzxqj", "jqvz") for a, b in zip(model.cut(w), model.cut(w)[1:], strict=False)])


def test_decontamination_is_brute_force_s(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 3, 13, 14, 30])))) for i in range(12)] + [(98, None), (99, "--")]
    texts = [*ODD, *(" ".join(rng.choices(words, k=40)) for _ in range(40)), *(f"{' '.join(rng.choices(words, k=5))} {t.upper() if t else ''}, {' '.join(rng.choices(words, k=60))}" for _, t in items)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for block in (decontaminate.BLOCK_BYTES, 60):  # one block, and several
        found = decontaminate.find_hits(docs_of(spark, texts).select("doc_id", "text"), benchmark, block_bytes=block)
        rows = found.select("doc_id", "_d_n_words", decontaminate.n_hit().alias("n"), "_d_items", decontaminate.contaminated().alias("c")).collect()
        for r in rows:
            n_words, n_hit, n_items, digest, bad = decontaminate.brute_force(texts[r.doc_id], items)
            assert (r._d_n_words, r.n, len(r._d_items), r.c) == (n_words, n_hit, n_items, bad)
            assert hashlib.sha256(",".join(r._d_items).encode()).hexdigest() == digest
    assert decontaminate.remove_contaminated(docs_of(spark, texts), benchmark.limit(0)).count() == len(texts)
    assert decontaminate.score_documents(docs_of(spark, []), benchmark).count() == 0


def test_items_of_common_words_and_equal_words(spark):
    items = [(i, " ".join(["the"] * n)) for i, n in enumerate((1, 2, 12, 13, 40))] + [(7, "the a " * 20), (8, "a")]
    texts = ["the " * 30, "the a " * 9, "a the", "the " * 12 + "x " + "the " * 13, "b", ""]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(spark, texts).withColumnRenamed("score", "_d_hit")
    for r in decontaminate.score_documents(docs, benchmark).collect():
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == decontaminate.brute_force(texts[r.doc_id], items)
    assert {r.doc_id for r in decontaminate.remove_contaminated(docs, benchmark).collect()} == {4, 5}


def test_url_filter(spark):
    urls = [None, "", "no scheme", "HTTP://WWW.Example.com/en/a", "http://a.example.com/en/x", "http://example.com/en", "https://x.net/es/", "http://evilnet/es/", "http://x.net/free-win", "http://x.org/free", "http://x.org/casinoid", "http://x.org/casino?x=1", "a://b?c/d#e", "://", "http://x.org/freewin-free"]
    pages = spark.createDataFrame([*enumerate(urls), (None, "http://x.org/XXX")], "page_id long, url string").withColumn("host", F.lit("other"))
    rows = url_filter.filter_urls(pages).collect()
    got = {r.page_id: r for r in rows}
    assert [got[i].verdict for i in (0, 3, 4, 6, 8, 9, 10, 11, None)] == ["allow", "allow", "block", "block", "block", "allow", "allow", "block", "block"]
    assert (got[3].host, got[3].path, got[3].rule) == ("www.example.com", "/en/a", "www.example.com/en/")
    assert got[5].rule == "com/" and got[7].rule is None
    con = duckdb.connect()
    con.register("pages", pa.table({"page_id": [*range(len(urls)), None], "url": pa.array([*urls, "http://x.org/XXX"], pa.string())}))
    cols = ("page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft", "weight")
    expected = sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({url_filter.ORACLE_SQL})").fetchall(), key=str)
    assert expected == sorted((tuple(getattr(r, c) for c in cols) for r in rows), key=str)
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


def test_url_vocabulary_from_a_table(spark):
    terms = spark.createDataFrame([("Red", 1), ("red", 2), ("blue", 1), ("green", 1), ("grey", 5), (None, 3), ("none", None)], "term string, weight int")
    urls = ["a://x/red", "a://x/blue", "a://x/blue-blue", "a://x/blue/green", "a://x/grey", "a://x/none"]
    pages = spark.createDataFrame(list(enumerate(urls)) * 2, "page_id long, url string")
    rows = url_filter.filter_urls(pages, terms, limit=2).collect()
    assert sorted((r.page_id, r.verdict, r.weight) for r in rows) == sorted([(0, "block", 2), (1, "allow", 1), (2, "allow", 1), (3, "block", 2), (4, "block", 5), (5, "allow", 0)] * 2)
    with pytest.raises(ValueError):
        url_filter.read_vocabulary(terms, 2)


def test_token_counts_move_no_pieces_and_bound_their_caches_in_bytes(spark):
    docs = docs_of(spark, ["one two two three three three", *ODD])
    assert token_counts.frequent_pieces(docs, 2) == ["three", "two"]
    path = token_counts.tokenizer_path(token_counts.TOKENIZER)
    plan = token_counts.count_tokens(docs, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    lengths = token_counts.Lengths(token_counts.load_tokenizer(path), {"a": 1}, 1000)
    lengths.many(pa.array(["x" * 900 + " b c"]))
    lengths.trim()
    assert lengths.held == 0 and lengths.known == {"a": 1}
    model = bpe.ForcedBoundaryBpe(token_counts.tokenizer_path(bpe.TOKENIZER), 1000)
    model.encode(pa.array(["ab " + "c" * 900]))
    model.trim()
    assert not model.known


@pytest.mark.parametrize("operate", [lambda d: token_counts.count_tokens(d, token_counts.tokenizer_path(token_counts.TOKENIZER)), lambda d: bpe.encode(d, token_counts.tokenizer_path(bpe.TOKENIZER), with_ids=False), quality.score_documents])
def test_null_ids_repeated_rows_and_empty_tables(spark, operate):
    rows = [(None, "a b", "en", "s", 1, 0.5), (None, None, None, None, None, None), (3, "a b", "en", "s", 1, 0.5), (3, "a b", "en", "s", 1, 0.5)]
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("score", "n_tokens")
    got = [tuple(r)[1:] for r in operate(docs).collect()]
    assert len(got) == 4 and len(set(map(str, got))) == 2
    assert operate(docs.limit(0)).count() == 0


def _measures(text):
    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\n\r\x0b\x0c"):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(hit)


def test_quality_measures_and_fences(spark):
    rng = random.Random(3)
    texts = [*ODD, *("\n".join(" ".join(rng.choices("ab#c", k=rng.randint(0, 8))) for _ in range(rng.randint(0, 6))) for _ in range(100))]
    rows = {r.doc_id: r for r in quality.score_documents(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        want = _measures(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.kept and r.base_failed)
    clean = [" ".join(f"word{rng.randint(0, 9999)}" for _ in range(60)) for _ in range(400)]
    junk = [" | ".join(f"word{rng.randint(0, 9999)}" for _ in range(40)) for _ in range(30)]
    kept = {r.doc_id for r in quality.filter_documents(docs_of(spark, clean + junk)).collect()}
    assert kept == set(range(400))
    assert quality.filter_documents(docs_of(spark, [])).count() == 0
