"""Search and suggestions by index against the scan, on texts of all shapes."""

import random

from pyspark.sql import functions as F

from korbwerk.operators import search
from korbwerk.operators.index import SearchIndex, SuggestionIndex

QUERIES = ["köln", "k", "ko", "ln", "aa", "fach it", "it it", "", " ,; ", "ab-c", "informatik", "x.y", "büro k", "nichts", "e", "sub"]


def texts(spark, n=120):
    pick = random.Random(5)
    words = ["Köln", "ko", "köln-aa", "Fachinformatiker", "it", "IT", "ab-c.x.y", "aaa", "e", "Büro", "k", "submarine", "s_u_b"]
    rows = [(i, *(" ".join(pick.choices(words, k=pick.randrange(4))) or None for _ in range(3))) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a string, b string, d string")


def test_index_equals_the_scan(spark, tmp_path):
    rows = search.searchable(texts(spark), ["a", "b"], "d")
    index = SearchIndex(spark, str(tmp_path / "i"), "id", 8)
    index.add(0, rows.where("id < 70"))
    index.add(1, rows.where("id >= 70"))
    for q in QUERIES:
        want = {(r.id, r.score) for r in search.search(rows, q).select("id", "score").collect()}
        assert {(r.id, r.score) for r in index.search(q).collect()} == want, q
    assert index.match_count("ko").first().n == search.match_count(rows, "ko").first().n
    plan = index.search("köln")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(gram,kol)" in plan


def test_suggestions_equal_the_scan(spark, tmp_path):
    pick = random.Random(6)
    values = ["".join(pick.choices("abc ", k=pick.randrange(1, 9))) for _ in range(60)] + ["b" * 90 + "xz"]
    rows = spark.createDataFrame([(i, pick.choice(values), pick.choice(["Ring", "Rand", "Rot", "Rost", "Rabe", "ra", "Ruhr", "abra", "bar"])) for i in range(900)], "ordinal long, v string, w string")
    all_values = search.suggestions(rows, {"v": F.col("v"), "w": F.col("w")})
    index = SuggestionIndex(spark, str(tmp_path / "s"), buckets=8)
    index.build(all_values)
    kept = 0
    for q in ("a", "ab", "bc", "r", "R", "rö", "c a", "abcabca", "xz", "", "zzz"):
        kept += index.kept(q.lower()) is not None
        got = [(r.type, r.norm, r.n, r.score, r["rank"]) for r in index.suggest(q).collect()]
        assert got == [(r.type, r.norm, r.n, r.score, r["rank"]) for r in search.suggest(all_values, q).collect()], q
    assert kept >= 1
