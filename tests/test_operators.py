"""Duplicates, merges, enrichment, ranking, audit and search on small listings."""

import random

from pyspark.sql import functions as F

from korbwerk.operators import audit, dedup, enrich, merge, ranking, search
from korbwerk.schema import conform
from korbwerk.sources import readers, sinks
from korbwerk.streaming import ingest


def listings(spark, rows):
    """Rows in order as conformed listings with their ordinal."""
    names = sorted({k for r in rows for k in r} | {"referenznummer", "category_id"})
    df = spark.createDataFrame([(f"{i:09d}", *(r.get(n) for n in names)) for i, r in enumerate(rows)], "scraped_at string, " + ", ".join(f"{n} string" for n in names))
    return conform(df).withColumn("ordinal", F.col("scraped_at").cast("long")).withColumn("scraped_at", F.lit(""))


FULL = {"nama_perusahaan": "Foo GmbH", "jenis_ausbildung": "Fachinformatiker", "posisi_kota": "Aachen", "alamat_detail": "Weg 1, 52062 Aachen"}


def test_phases(spark):
    rows = [
        {"referenznummer": "1", "category_id": "fachinformatiker_ae", "detail_deskripsi": "long text"}, {"referenznummer": " 1 ", "category_id": "fachinformatiker_dpa", "detail_deskripsi": "x"},
        {"referenznummer": "2", "category_id": "a"}, {"referenznummer": "2", "category_id": "a", "detail_deskripsi": "more"},
        {"detail_deskripsi": "same", "category_id": "a"}, {"detail_deskripsi": "same", "category_id": "a"},
        {"referenznummer": "7", **FULL}, {"referenznummer": "8", "detail_deskripsi": "longer", **FULL},
    ]
    kept, stats = dedup.deduplicate(listings(spark, rows))
    assert sorted(r.ordinal for r in kept.collect()) == [1, 3, 4, 7]
    s = stats.first()
    assert (s.input_total, s.removed_by_refnr_cross_category, s.removed_by_refnr_within_category, s.removed_by_secondary_key, s.removed_by_near_duplicate, s.output_total) == (8, 1, 1, 1, 1, 4)
    again, more = dedup.deduplicate(kept)
    assert again.count() == 4 and more.first().output_total == 4


def test_greedy_is_the_sequential_filter(spark):
    rng = random.Random(1)
    batch = []
    for b in range(60):
        for i in range(14):
            batch.append((b * 100 + i, *(f"{b}-{rng.randint(0, 5)}" if rng.random() < 0.8 else None for _ in range(3))))
    want, seen = set(), [set(), set(), set()]
    for o, *keys in batch:
        if not any(k is not None and k in s for k, s in zip(keys, seen, strict=True)):
            want.add(o)
            for k, s in zip(keys, seen, strict=True):
                s.add(k)
    got = dedup.greedy(spark.createDataFrame(batch, "ordinal long, _ref string, _near string, _cross string"))
    assert {r.ordinal for r in got.collect()} == want
    # h, i, j: i falls to h, so j, which only collides with i, is accepted
    chain = spark.createDataFrame([(0, None, "n", "c0"), (1, None, "n", "c1"), (2, None, "m", "c1")], "ordinal long, _ref string, _near string, _cross string")
    assert {r.ordinal for r in dedup.greedy(chain).collect()} == {0, 2}


def test_filter_against_master(spark):
    master = listings(spark, [{"referenznummer": "M1", "link_bewerbung": "https://jobs.example.org/0a1b2c3d-1111-2222-3333-444455556666", **FULL}])
    new = listings(spark, [{"referenznummer": "M1"}, {"referenznummer": "N1", "link_bewerbung": "http://x.org/?id=0a1b2c3d-1111-2222-3333-444455556666&y"}, {"referenznummer": "N2", **FULL}, {"referenznummer": "N3", "nama_perusahaan": "Bar"}])
    unique, marked = dedup.filter_against(new, master)
    assert [r.referenznummer for r in unique.collect()] == ["N3"]
    assert {r.referenznummer: r.duplicate_of_refnr for r in marked.collect()} == {"M1": "M1", "N1": "", "N2": ""}


def test_all_sources(spark):
    rows = [{"referenznummer": "B1", **FULL}, {"referenznummer": "AD-1", "sumber_data": "ausbildung_de", **FULL}, {"referenznummer": "AD-2", "sumber_data": "ausbildung_de", "nama_perusahaan": "Q"}, {"referenznummer": "AD-3", "sumber_data": "other"}]
    result, stats = dedup.deduplicate_all(listings(spark, rows))
    assert sorted(r.referenznummer for r in result.collect()) == ["AD-2", "AD-3", "B1"]
    assert (stats.first().removed_by_cross_source, stats.first().output_total) == (1, 3)


def test_enrichment(spark):
    rows = [
        {"link_bewerbung": "https://firma.example.de/job", "ba_job_url": "https://www.arbeitsagentur.de/x", "link_website_perusahaan": "https://www.firma.example.de", "jenis_ausbildung": "Ausbildung Fachinformatiker Systemintegration", "detail_deskripsi": "Beginn: 01.08.2026", "kontak_penanggung_jawab": "1.8.2026"},
        {"link_bewerbung": "https://www.arbeitsagentur.de/x", "ba_job_url": "https://www.arbeitsagentur.de/x", "link_website_perusahaan": "https://sub.stepstone.de/y"},
        {"link_website_perusahaan": "keine"},
    ]
    got = enrich.enrich(listings(spark, rows)).orderBy("ordinal").collect()
    assert [r.bewerbung_sumber for r in got] == ["externe", "ba_portal", "none"]
    assert [r.website_type for r in got] == ["company", "partner_portal", "empty"]
    assert (got[0].beruf_typ, got[0].tanggal_mulai, got[0].kontak_penanggung_jawab, got[0].kelengkapan_score) == ("si", "2026-08-01", "", 33)
    flow = enrich.with_workflow(enrich.enrich(listings(spark, rows)), spark.createDataFrame([("", "terkirim", " ")], "referenznummer string, status_lamaran string, prioritas string")).orderBy("ordinal").collect()
    assert [r.cara_apply for r in flow] == ["portal", "ba_portal", "tidak_jelas"] and {r.status_lamaran for r in flow} == {"terkirim"}
    assert [len(r) for r in (sinks.export_rows(enrich.with_workflow(enrich.enrich(listings(spark, rows)))).first(),)] == [24]


def test_ranking_and_audit(spark):
    rows = [{"nama_perusahaan": "Foo GmbH", "alamat_email_bewerbung": ""}, {"nama_perusahaan": "FOO AG", "alamat_email_bewerbung": "a@b.de"}, {"nama_perusahaan": " "}, {"referenznummer": "9"}]
    best = ranking.best_per_company(listings(spark, rows))
    assert sorted(r.ordinal for r in best.collect()) == [1, 2, 3]
    u = audit.uniqueness(best).first()
    assert (u.input_total, u.unique_companies, u.skipped_duplicates, u.companies_with_multiple_listings) == (4, 3, 1, 1)
    long = {r.field: (r.n_filled, r.pct) for r in audit.completeness(listings(spark, rows), ["nama_perusahaan", "kelengkapan_score"]).collect()}
    assert long["nama_perusahaan"] == (2, 50.0) and long["kelengkapan_score"] == (0, 0.0)


def test_merges(spark):
    stored = spark.createDataFrame([("a", "x", "draft"), ("b", "y", "")], "k string, v string, s string")
    fresh = spark.createDataFrame([("a", "x2", "new"), ("b", "y2", "new"), ("c", "z", "new")], "k string, v string, s string")
    assert sorted(map(tuple, merge.upsert_state(stored, fresh, "k", ["s"]).collect())) == [("a", "x2", "draft"), ("b", "y2", "new"), ("c", "z", "new")]
    more = spark.createDataFrame([(0, "a", "q", ""), (1, "d", "1", ""), (2, "d", "2", "")], "ordinal long, k string, v string, s string")
    assert {r.k: r.v for r in merge.append_new(stored, more, "k").collect()} == {"a": "x", "b": "y", "d": "1"}
    assert {r.k: r.v for r in merge.fill_from(stored.withColumn("v", F.lit("")), fresh, "k", ["v"]).collect()} == {"a": "x2", "b": "y2"}


def test_search(spark):
    df = search.searchable(spark.createDataFrame([(0, "Müller Software"), (1, "Softwarehaus"), (2, "Nosoft"), (3, "x")], "ordinal long, name string"), ["name"])
    assert {r.ordinal: r.score for r in search.search(df, "soft").collect()} == {0: 80, 1: 80, 2: 98}
    assert {r.ordinal for r in search.search(df, "muller soft").collect()} == {0} and search.search(df, "").count() == 4
    index = search.suggestions(df, {"name": F.col("name")})
    assert [r.value for r in search.suggest(index, "soft", 1).collect()] == ["Softwarehaus"]


def test_sources_and_sinks(spark, tmp_path):
    import json

    for name, ref in (("a.json", "1"), ("b.json", "2")):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text(json.dumps([{"referenznummer": ref, "category_id": "c", "gaji": None}]))
    rows, files = readers.newest_exports(spark, str(tmp_path / "in"))
    assert files.count() == 1 and rows.count() == 1 and rows.first().gaji == ""
    (tmp_path / "o.csv").write_bytes("﻿id_referensi,status_lamaran,prioritas\n1,terkirim,\n1,draft,\n2,,\n".encode())
    assert [tuple(r) for r in readers.read_overrides(spark, str(tmp_path / "o.csv")).collect()] == [("1", "draft", "")]
    sinks.publish(rows, str(tmp_path), "snap", "2026-01-01")
    assert sinks.read_alias(spark, str(tmp_path), "snap").count() == 1


def test_streaming(spark, tmp_path):
    def push(rows):
        spark.createDataFrame(rows, "ordinal long, k string, v string").coalesce(1).write.mode("append").parquet(str(tmp_path / "land"))

    def run():
        def fold(known, batch):
            return merge.append_new(known if known is not None else batch.limit(0), batch, "k")

        ingest.ingest(spark, str(tmp_path / "land"), spark.createDataFrame([], "ordinal long, k string, v string").schema, str(tmp_path / "m"), str(tmp_path / "c"), fold).awaitTermination()

    push([(0, "a", "1"), (1, "a", "2")])
    run()
    push([(0, "a", "3"), (1, "b", "4")])
    run()
    assert {r.k: r.v for r in spark.read.parquet(str(tmp_path / "m" / "v=1")).collect()} == {"a": "1", "b": "4"}


def test_progress(spark):
    from korbwerk.operators import progress

    rows = spark.createDataFrame([("fachinformatiker_ae_2026",), ("stepstone_de_dpa",), ("karriere_sw_ae",), ("foo_bar",)], "category_id string")
    assert {(r.source, r.n, r.n_ae, r.n_dpa) for r in progress.totals(rows).collect()} == {("fachinformatiker", 1, 1, 0), ("stepstone_de", 1, 0, 1), ("karriere_suedwestfalen_de", 1, 1, 0), ("foo", 1, 0, 0), (None, 4, 2, 1)}
    log = spark.createDataFrame([("l", 0, "2026-01-01 10:00:00 x 10/100 details"), ("l", 1, "noise"), ("l", 2, "2026-01-01 10:01:00 x 20/100 details")], "log string, ordinal long, value string")
    assert progress.eta(log, 20, 100).first().minutes == 8.0
    v = spark.sql("""select parse_json('{"categories": {"a": {"n": 1}}}') m, parse_json('{"categories": [{"n": 2}, {"n": 3}]}') l, parse_json('{}') e""")
    assert tuple(v.select(*(F.size(progress.categories_of(F.col(c))) for c in "mle")).first()) == (1, 2, 0)
    assert [tuple(r) for r in spark.range(1).select(progress.share(F.lit(1), F.lit(3)), progress.share(F.lit(1), F.lit(0))).collect()] == [("33.3%", "—")]


def test_both_first_phases_read_the_listings_once(spark, tmp_path):
    from pyspark.sql import functions as F

    frame = listings(spark, [{"referenznummer": "a"}, {"referenznummer": "a "}, {"referenznummer": ""}, {"referenznummer": " "}, {"referenznummer": "", "posisi_kota": "x"}])
    reads = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda x: reads.add(1) or x)
    kept, stats = dedup.deduplicate(frame.withColumn("scraped_at", seen.asNondeterministic()("scraped_at")))
    assert kept.count() == 3 and stats.first().removed_by_secondary_key == 1 and stats.first().removed_by_refnr_within_category == 1
    assert reads.value <= 2 * 5
