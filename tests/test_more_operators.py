"""Filters, readers and text functions that no registered query shows."""

import json

from pyspark.sql import functions as F

from korbwerk.functions import classify, dates, extract, text
from korbwerk.operators import enrich, merge, ranking, research, search
from korbwerk.schema import conform
from korbwerk.sources import api, portals, sinks


def one(spark, *columns):
    return spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first()


def test_entities_and_markup(spark):
    cases = {
        "&lt;p&gt;a &amp;amp; b&lt;/p&gt;c": "a & b\nc", "<ul><li>x</li><li>y <b>z</b></li></ul>": "- x\n- y z", "a<br/>b<!-- c --><h2>d</h2>e": "a\nbd\ne", "&#228;&#xDF;&#128512;&#0;&bogus;": "äß😀�&bogus;", "3 < 4 &uuml;": "3 < 4 ü", "": "",
    }
    assert list(one(spark, *(text.strip_html(F.lit(k)) for k in cases))) == list(cases.values())
    assert one(spark, text.strip_html(F.lit(None).cast("string")))[0] == ""


def test_urls(spark):
    got = one(spark, *(text.inline_url(F.lit(u)) for u in ("https://s.de/a--1.html?x=1", "https://s.de/a--1-inline.html", "https://s.de/a/", None)))
    assert list(got) == ["https://s.de/a--1-inline.html", "https://s.de/a--1-inline.html", "https://s.de/a-inline.html", "-inline.html"]
    assert api.page_url("https://s.de/j?b=&page=1&a=2&a=3#x", 4, {"a": "9", "rsearch": "2"}) == "https://s.de/j?b=&page=4&a=2&rsearch=2"


def test_dates_stand_between_word_boundaries(spark):
    got = one(spark, *(dates.text_start(F.lit(x)) for x in ("Los geht es.01.09.2026", "A01.09.2026", "01.09.20261", "x 31.12.2027.", "am 32.01.2026")))
    assert [r and r["date"] for r in got] == ["2026-09-01", None, None, "2027-12-31", None]


def test_filters_on_titles_and_hints(spark):
    rows = [("x_dpa", "Daten und Prozesse", "", True, False), ("x_dpa", "Fachinformatiker Daten- und Prozessanalyse", "", True, True), ("x_ae", "Fachinformatiker Anwendungsentwicklung", "daten im prozess", False, False), ("x_ae", "Fachinformatiker", "", False, True), ("x_dv", "Fachinformatiker", "digitale Vernetzung", True, True), ("x_si", "Werkstudent", "", True, False)]
    df = spark.createDataFrame(rows, "c string, t string, d string, words boolean, strict boolean")
    for r in df.select("*", classify.fits_by_words(F.col("c"), F.col("t"), F.col("d")).alias("w"), classify.fits_strictly(F.col("c"), F.col("t"), F.col("d"), parity=False).alias("s")).collect():
        assert (r.w, r.s) == (r.words, r.strict), r
    page = "x" * 500 + '<b>Digitale</b>  <a href="/j/1">Vernetzung</a>' + "y" * 900
    hint = portals.card_hint(F.lit(page), F.lit("/j/1"))
    got = one(spark, F.length(hint), portals.card_hint(F.lit(page), F.lit("/j/2")), classify.hint_fits(F.lit("Digitale Vernetzung"), "dv"), classify.hint_fits(F.lit("Daten"), "dpa"), portals.real_key(F.lit("0123456789abcdee")), portals.real_key(F.lit("0123456789abcdef")), portals.real_key(F.lit("0123")))
    assert list(got) == [240, "", True, False, True, False, False]
    kept, dropped = portals.fitting_stubs(spark.createDataFrame([("Anwendungsentwicklung",), ("Systemintegration",), (None,)], "title string"), "ae")
    assert (kept.count(), dropped.first()[0]) == (1, 2)
    assert portals.fitting_stubs(kept, None)[1].first()[0] == 0


def test_a_company_s_description(spark):
    long = "Wir entwickeln seit vielen Jahren Software für Menschen"
    cases = {
        f"\n** {long}\nund mehr\n\nnicht das": f"{long}\nund mehr", f"{long}. Wir bieten Obst\nweiter": long, "Foo. Wir bieten Obst": "", "Als Fachinformatiker bei uns\nAls Fachinformatiker: unser Unternehmen, Benefits": "Als Fachinformatiker: unser Unternehmen",
        f"{long}\nDeine Aufgaben\nviele": long, "": "", "Starte jetzt": "",
    }
    got = one(spark, *(extract.company_description(F.lit(k)) for k in cases))
    assert list(got)[:3] == list(cases.values())[:3] and list(got)[4:] == list(cases.values())[4:]


def test_research_parts(spark):
    t = "Unser Motto: gemeinsam mehr erreichen.\nWir programmieren\nObst"
    got = one(spark, extract.motto(F.lit(t)), extract.projects(F.lit(t)), extract.projects(F.lit("Obst")), extract.culture(F.lit(""), F.lit(""), F.lit("Bonn")), extract.culture(F.lit("a" * 700), F.lit("b"), F.lit("")))
    assert got[0] == "gemeinsam mehr erreichen" and got[1] == "Wir programmieren" and got[2] == extract.NO_PROJECTS and "Bonn" in got[3] and got[4] == "a" * 500
    record = F.struct(*(F.lit("x" * 500).alias(k) for k in research.COMPANION))
    parts = one(spark, research.companion(record))[0]
    assert parts.branche == "Bidang: " + "x" * 500 and len(parts.projekte) == len("Proyek/fokus kerja: ") + 400


def test_stored_rows_are_read_again(spark):
    rows = [("1", "Dein Profil\n- Neugier\n\nVergütung: 1.000 € pro Monat", "https://www.arbeitsagentur.de/x", "Abitur nötig", "alt", ""), ("2", "nichts", " https://foo.example/a ", "", "900 €", ""), ("3", "", "https://foo.example/b", None, None, "ba_portal")]
    df = conform(spark.createDataFrame(rows, "referenznummer string, detail_deskripsi string, link_bewerbung string, persyaratan string, gaji string, bewerbung_sumber string"))
    got = {r.referenznummer: r for r in enrich.reparse(df).collect()}
    assert got["1"].persyaratan.endswith("\nAbitur nötig") and got["1"].gaji == "1.000 € pro Monat" and got["1"].link_bewerbung == got["1"].ba_job_url and got["1"].link_bewerbung_externe == ""
    assert got["2"].gaji == "900 €" and got["2"].link_bewerbung_externe == "https://foo.example/a" and got["2"].bewerbung_sumber == "externe"
    assert got["3"].link_bewerbung_externe == "" and got["3"].persyaratan == ""


def test_details_or_cards(spark):
    cards = spark.createDataFrame([("a", "1", "Karte AG", "Bonn"), ("b", "2", "Stub", None), ("c", None, "Ohne", "Köln")], "id string, ref string, nama_perusahaan string, posisi_kota string")
    details = spark.createDataFrame([("1", "", "lang", "Detail GmbH")], "ref string, posisi_kota string, detail_deskripsi string, nama_perusahaan string")
    got = {r.referenznummer: r for r in portals.detail_or_card(cards, details, "ref", portals.PORTALS["backinjob_de"]).collect()}
    assert {k: (r.nama_perusahaan, r.posisi_kota, r.detail_deskripsi, r.sumber_data) for k, r in got.items()} == {"BIJ-a": ("Detail GmbH", "Bonn", "lang", "backinjob_de"), "BIJ-b": ("Stub", "", "", "backinjob_de"), "BIJ-c": ("Ohne", "Köln", "", "backinjob_de")}


def test_lookups_and_orders(spark):
    rows = [("1", "Zwickau", "ae", 10, "pending", "a@b.de", 0), ("2", "Zürich", "si", 30, "sent", "", 1), (None, None, "ae", None, "sent", "", 2)]
    df = spark.createDataFrame([(*r, "Foo") for r in rows], "referenznummer string, posisi_kota string, beruf_typ string, kelengkapan_score int, bewerbung_status string, alamat_email_bewerbung string, ordinal int, nama_perusahaan string")
    order = lambda mode: [r.ordinal for r in df.orderBy(*ranking.viewer_order(mode)).collect()]
    assert [order(m) for m in ("city", "score-desc", "score-asc", "spec-priority", "other")] == [[2, 1, 0], [1, 0, 2], [2, 0, 1], [0, 2, 1], [0, 1, 2]]
    assert merge.of_refs(df, ["2", "9"]).count() == 1 and merge.of_refs(df, []).count() == 0
    assert [r.is_enriched for r in merge.flag_known(df, df.where("referenznummer = '1'")).orderBy("ordinal").collect()] == [True, False, False]
    count = lambda **k: search.application_filter(df, **k).count()
    assert [count(), count(query=" ZÜR"), count(query="foo", status="sent"), count(ae_only=True), count(email_only=True)] == [3, 1, 2, 2, 1]


def test_the_spreadsheet_export_begins_with_a_mark(spark, tmp_path):
    df = conform(spark.createDataFrame([("1", 'a "b"')], "referenznummer string, nama_perusahaan string")).withColumns({c: F.lit("x") for c in ("cara_apply", "ringkasan_1_baris", "butuh_manual", "status_lamaran", "prioritas")})
    sinks.write_excel(df, str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert part.read_bytes().startswith(b"\xef\xbb\xbfid_referensi,kategori,") and b'"a ""b"""' in part.read_bytes()


def test_details_come_in_order_with_errors_and_pages_stop_at_the_total(spark, tmp_path):
    for ref in ("MQ==", "Mg=="):
        (tmp_path / ref).write_text(json.dumps({"ref": ref}))
    refs = spark.createDataFrame([(0, "2"), (1, "9"), (2, "1"), (3, "2"), (4, None)], "ordinal int, referenznummer string")
    got = api.fetch_details(refs, f"file://{tmp_path}/{{id}}", parallel=2, interval=0, retries=0).orderBy("ordinal").collect()
    assert [(r.ordinal, r.referenznummer, r.payload is not None, r.error is not None) for r in got] == [(0, "2", True, False), (1, "9", False, True), (2, "1", True, False)]
    for page in (1, 2, 3):
        (tmp_path / f"{page}.json").write_text(json.dumps({"maxErgebnisse": 3, "ergebnisliste": [{"referenznummer": str(page)}]}))
    spark.dataSource.register(api.PagedApi)
    rows = spark.read.format("paged_api").options(url=f"file://{tmp_path}/{{page}}.json", pages=9, size=2, stop_at_total="true", parallel=2, interval=0, retries=0).load().collect()
    assert sorted(r.page for r in rows) == [1, 2] and not any(r.error for r in rows)
