"""Sheet tabs, status files, fetched sites and highlights."""

import pytest
from pyspark.sql import functions as F

from korbwerk.operators.search import highlights
from korbwerk.sources import api, sinks


class Tab:
    def __init__(self):
        self.rows, self.calls = [["old"]], []

    def clear(self):
        self.rows = []

    def append_rows(self, values, value_input_option):
        self.calls.append((len(values), value_input_option))
        self.rows += values


def test_a_tab_is_cleared_and_filled_in_blocks(spark, monkeypatch):
    tab, rows = Tab(), spark.range(7).select("id", F.when(F.col("id") > 2, "=x").alias("v")).coalesce(1)
    assert sinks.write_tab(rows, tab, block=3) == 7
    assert tab.rows[:2] == [["id", "v"], [0, ""]] and len(tab.rows) == 8 and tab.rows[-1] == [6, "=x"]
    assert tab.calls == [(3, "RAW"), (3, "RAW"), (2, "RAW")]
    assert sinks.write_tab(rows.limit(0), tab) == 0 and tab.rows == [["id", "v"]]
    monkeypatch.setattr(sinks, "SHEET_CELLS", 10)
    with pytest.raises(ValueError):
        sinks.write_tab(rows, tab)
    assert tab.rows == [["id", "v"]]


def test_status(spark, tmp_path):
    path = str(tmp_path / "status")
    sinks.write_status(spark, path, "running", 1, 3, 2, "x=y", "now", "R-1")
    assert {r.name: r.value for r in sinks.read_status(spark, path).collect()} == {"state": "running", "updated_utc": "now", "progress": "1/3 (33.3%)", "workers": "2", "target": "x=y", "last_ref": "R-1"}
    sinks.write_status(spark, path, "done", 0, 0, 2, "x", "now")
    assert {r.name: r.value for r in sinks.read_status(spark, path).collect()}["progress"] == "0/0 (0.0%)"


def test_sites_are_fetched_once_and_not_if_cached(spark, tmp_path):
    (tmp_path / "a.html").write_text("<title>T</title><meta name='description' content='about'><p>mail hr@firma.de or x@firma.de</p>" + "y" * 4000)
    url = f"file://{tmp_path}/a.html"
    urls = spark.createDataFrame([(url,), (url,), (None,), (f"file://{tmp_path}/none",), ("file:///cached",)], "url string")
    rows = {r.url: r for r in api.fetch_sites(urls, spark.createDataFrame([("file:///cached",)], "url string"), interval=0).collect()}
    assert len(rows) == 2 and rows[url].ok and rows[url].title == "T" and rows[url].meta_description == "about"
    assert rows[url].emails == ["hr@firma.de", "x@firma.de"] and len(rows[url].text_sample) == 3000 and rows[url].error == ""
    bad = rows[f"file://{tmp_path}/none"]
    assert not bad.ok and bad.error and not bad.emails


def test_counted_while_written(spark, tmp_path):
    rows = spark.range(1000)
    assert sinks.counted(rows, F.col("id") % 4 == 0, lambda r: sinks.write_json(r, str(tmp_path / "a"))) == (250, 1000)
    assert sinks.counted(rows.where("id < 0"), F.col("id") % 4 == 0, lambda r: sinks.write_json(r, str(tmp_path / "b"))) == (0, 0)
    assert spark.read.json(str(tmp_path / "a")).count() == 1000


def test_a_large_category_is_split(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id as ordinal", "case when id < 18000 then 'hot' when id < 19999 then 'b' end as category_id", "map(id, 'x') as m")
    # partitions as small as these are put together otherwise
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_by_category(rows, str(tmp_path / "c"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "c" / "category_id=hot").glob("part-*"))) > 1
    found = {r.category_id: r.n for r in spark.read.json(str(tmp_path / "c")).groupBy("category_id").agg(F.count("*").alias("n")).collect()}
    assert found == {"hot": 18000, "b": 1999, None: 1}


def test_no_more_is_read_than_is_kept(tmp_path):
    page = tmp_path / "page.html"
    page.write_text("ä" * 30 + "🙂" * 10)
    assert api.fetch(page.as_uri(), {}, 0, 0, most=7) == "ä" * 7
    assert api.fetch(page.as_uri(), {}, 0, 0, most=16) == "ä" * 16  # 64 bytes end inside a character
    assert api.fetch(page.as_uri(), {}, 0, 0, most=40) == api.fetch(page.as_uri(), {}, 0, 0) == page.read_text()


def test_last_records(spark):
    rows = spark.createDataFrame([(0, '{"id": 1, "v": "a"}'), (2, '{"id": 1, "v": "b"}'), (1, '{"id": 1}'), (3, "no json"), (4, None), (5, '{"v": 1}')], "ordinal long, payload string")
    assert [(r.id, r.payload) for r in api.last_records(rows).collect()] == [("1", '{"id": 1, "v": "b"}')]


def test_highlights(spark):
    cases = [("M\u00fcller GmbH", "muller", [(0, 6)]), ("ananas", "ana", [(0, 5)]), ("abab", "ab", [(0, 4)]), ("a b", "ab", [(0, 3)]), ("ab", "abc", []), ("", "a", []), (None, "a", []), ("ab", "", []), ("x ring y key", "key ring", [(2, 6), (9, 12)])]
    rows = spark.createDataFrame([(i, t, q) for i, (t, q, _) in enumerate(cases)], "i int, t string, q string")
    got = {r.i: [(x["from"], x["to"]) for x in r.h] for r in rows.select("i", highlights(F.col("t"), F.col("q")).alias("h")).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(cases)}


def test_highlights_normalise_a_text_once(spark):
    rows = spark.createDataFrame([("Ä-b🙂 c\n" * 300,)], "t string").select(highlights(F.col("t"), "a-b c, zz").alias("h"))
    # once for the text, once for the query: as many for each place of a token, long texts take the square of their length
    assert rows._jdf.queryExecution().analyzed().toString().count("translate(") <= 2
    assert [(x["from"], x["to"]) for x in rows.first().h] == [p for i in range(300) for p in ((7 * i, 7 * i + 3), (7 * i + 5, 7 * i + 6))]


def test_readers_of_an_alias_always_find_a_whole_snapshot(spark, tmp_path):
    import pytest
    from pyspark.sql import functions as F

    from korbwerk.sources import sinks

    at, rows = str(tmp_path), spark.range(5).withColumn("x", F.lit(1))
    sinks.publish(rows, at, "snap", "1")
    held = sinks.read_alias(spark, at, "snap")
    sinks.publish(rows.withColumn("x", F.lit(2)), at, "snap", "1")  # the same stamp
    assert held.agg(F.sum("x")).first()[0] == 5 and sinks.read_alias(spark, at, "snap").agg(F.sum("x")).first()[0] == 10
    with pytest.raises(Exception):  # noqa: B017, PT011  fails while it writes
        sinks.publish(rows.withColumn("x", F.raise_error(F.lit("lost"))), at, "snap", "2")
    (tmp_path / "snap.alias" / "abc.draft").write_text("/nowhere")
    assert sinks.read_alias(spark, at, "snap").count() == 5
    for n in range(3, 13):
        sinks.publish(rows.limit(1), at, "snap", str(n))
    assert sinks.read_alias(spark, at, "snap").count() == 1 and sinks._pointers(spark, at, "snap")[2] == list(range(1, 13))
