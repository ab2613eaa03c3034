"""The paged API source, over files."""

import json

from korbwerk.sources.api import PagedApi, first_shard


def test_pages(spark, tmp_path):
    for page in (1, 2):
        (tmp_path / f"{page}.json").write_text(json.dumps({"maxErgebnisse": 3, "ergebnisliste": [{"referenznummer": f"{page}-{i}", "firma": "ä"} for i in range(3 - page)]}))
    spark.dataSource.register(PagedApi)
    rows = spark.read.format("paged_api").options(url=f"file://{tmp_path}/{{page}}.json", pages=3, interval=0, retries=0).load().collect()
    assert sorted((r.page, r.referenznummer) for r in rows if not r.error) == [(1, "1-0"), (1, "1-1"), (2, "2-0")]
    assert [r.page for r in rows if r.error] == [3] and rows[0].total == 3
    both = spark.createDataFrame([("a", 1), ("a", 0), ("b", 2)], "k string, shard int")
    assert {r.k: r.shard for r in first_shard(both, "k", "shard").collect()} == {"a": 0, "b": 2}
