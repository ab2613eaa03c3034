"""Portal pages and API details."""

import json
import os

import pytest
from pyspark.sql import functions as F

from korbwerk.functions.extract import contact_section
from korbwerk.plans import registry
from korbwerk.sources.portal_rules import RULES, parse_by_rules, parse_sources
from korbwerk.sources.portals import PORTALS, parse_details, parse_pages

SF = "/root/testdata/sf0.001"
JOB = {
    "@type": ["JobPosting"], "title": "Ausbildung Fachinformatiker Anwendungsentwicklung", "description": "<p>Das erwartet dich</p><ul><li>Code</li></ul>\n<p>Dein Profil</p><p>Neugier</p><p>Wir bieten</p><p>Obst</p>",
    "jobLocation": [{"address": {"addressLocality": "Aachen", "streetAddress": "Weg 1", "postalCode": "52062"}, "geo": {"latitude": 50.7, "longitude": 6.1}}],
    "hiringOrganization": {"name": "Foo GmbH"}, "baseSalary": {"minValue": 900, "maxValue": 1100, "currency": "EUR"}, "jobStartDate": "2026-08-01T00:00", "identifier": {"value": "77"},
}


def page(job, body=""):
    return f'<html><script type="application/ld+json">not json</script><script type="application/ld+json">{json.dumps({"@graph": [job]})}</script><main>{body}</main></html>'


def test_pages(spark):
    body = '<a href="mailto:x@ausbildung.de">x</a><a href="mailto:jobs%40foo.example">m</a><a href="https://foo.example/a">Jetzt bewerben</a>'
    rows = [("https://www.ausbildung.de/stellen/x", page(JOB, body), "ausbildung_de_ae"), ("https://www.ausbildung.de/stellen/y/", page({**JOB, "title": "Praktikum IT"}), "c"), ("https://www.ausbildung.de/stellen/z/", "", None)]
    got = {r.referenznummer: r for r in parse_pages(spark.createDataFrame(rows, "url string, html string, category_id string"), PORTALS["ausbildung_de"]).collect()}
    assert set(got) == {"AD-77", "AD-z"}
    r = got["AD-77"]
    assert (r.nama_perusahaan, r.posisi_kota, r.alamat_detail, r.titik_data_di_peta) == ("Foo GmbH", "Aachen", "Weg 1, 52062 Aachen", "50.7,6.1")
    assert (r.alamat_email_bewerbung, r.link_bewerbung, r.persyaratan, r.apa_yang_ditawarkan) == ("jobs@foo.example", "https://foo.example/a", "Dein Profil\nNeugier", "Wir bieten\nObst")
    assert (r.beruf_typ, r.tanggal_mulai, r.gaji) == ("ae", "2026-08-01", "900.0 - 1100.0 EUR")


def test_a_number_in_a_companys_name_is_no_postcode(spark):
    lines = {"a": "<p>Beispiel 20029 GmbH</p><p>Weg 3, 12345 Kleinstadt</p>", "b": "<p>Foo GmbH, Weg 3, 12345 SEELOW</p>", "c": "<p>Verein 20029 e. V.</p>", "d": "<p>Postfach 12345</p>"}
    rows = [(f"https://www.ausbildung.de/stellen/{k}", f"<main>{v}</main>", "c") for k, v in lines.items()]
    got = {r.referenznummer: r.alamat_detail for r in parse_pages(spark.createDataFrame(rows, "url string, html string, category_id string"), PORTALS["ausbildung_de"], keep_all=True).collect()}
    assert got == {"AD-a": "Weg 3, 12345 Kleinstadt", "AD-b": "Foo GmbH, Weg 3, 12345 SEELOW", "AD-c": "", "AD-d": "Postfach 12345"}


def test_details(spark):
    detail = {
        "referenznummer": "1-S", "firma": "Foo", "stellenangebotsBeschreibung": "Dein Profil\n- Neugier\n\nKontakt: Frau Muster\njobs@foo.example", "hauptberuf": "Fachinformatiker Systemintegration", "alleBerufe": ["Fachinformatiker Systemintegration", "X"],
        "ausbildungsart": "BERUFSAUSBILDUNG", "ausbildungsverguetungJahr1": 1100.5, "geforderterBildungsabschluss": "HAUPTSCHULABSCHLUSS", "category_id": "c", "eintrittsdatum": "2027-09-01",
        "stellenlokationen": [{"breite": 1.5, "laenge": 2.5, "adresse": {"strasse": "Weg", "hausnummer": "1", "plz": "5", "ort": "Y"}}],
    }
    schema = "referenznummer string, firma string, stellenangebotsBeschreibung string, externeURL string, allianzpartnerUrl string, eintrittsdatum string, ausbildungsart string, hauptberuf string, alleBerufe array<string>, geforderterBildungsabschluss string, verguetungsangabe string, ausbildungsverguetungJahr1 double, ausbildungsverguetungJahr2 double, ausbildungsverguetungJahr3 double, category_id string, stellenlokationen array<struct<breite:double,laenge:double,adresse:struct<strasse:string,hausnummer:string,plz:string,ort:string>>>"
    r = parse_details(spark.read.schema(schema).json(spark.sparkContext.parallelize([json.dumps(detail)]))).first()
    assert (r.gaji, r.alamat_detail, r.titik_data_di_peta, r.jenis_ausbildung) == ("Jahr 1: 1100 EUR/Monat", "Weg 1, 5 Y", "1.5,2.5", "Berufsausbildung | Fachinformatiker Systemintegration | X")
    assert r.persyaratan == "Dein Profil\n- Neugier\nHauptschulabschluss" and r.alamat_email_bewerbung == "jobs@foo.example" and r.kontak_penanggung_jawab == "Kontakt: Frau Muster\njobs@foo.example"
    assert (r.beruf_typ, r.tanggal_mulai) == ("si", "2027-09-01")


def ruled(spark, source, rows):
    frame = spark.createDataFrame(rows, "url string, html string, category_id string")
    return {r.referenznummer: r for r in parse_by_rules(frame, RULES[source]).collect()}


def test_rules_of_two_portals_that_share_them(spark):
    body = "<p>Ausbildungsbeginn: 1.9.2027</p><p>Vergütung</p><p>1. Ausbildungsjahr 1.000 €</p><p>Bewerbungsadresse:</p><p>Frau Muster</p><p>Weg 1</p><p>Ort</p><p>Land</p><p>hr@foo.example</p><p>zu weit</p>"
    job = {**JOB, "jobStartDate": " ", "description": "<p>Deine Aufgaben</p><p>Code und Anschreiben</p>", "hiringOrganization": {"name": "A &amp; B", "sameAs": "https://www.ausbildungsstellen.de/x", "url": "foo.example"}}
    firm = '<script type="application/ld+json">{"@type": "Organization", "url": "nichts", "sameAs": ["ftp://x", "https://org.example "], "description": "<p>Wir</p>"}</script>'
    r = ruled(spark, "ausbildungsstellen_de", [("https://www.ausbildungsstellen.de/a", firm + page(job, body), None)])["ASD-77"]
    assert (r.tanggal_mulai, r.gaji, r.dokumen_yang_harus_dipenuhi, r.link_website_perusahaan) == ("2027-09-01", "1. Ausbildungsjahr: 1.000 €", "Anschreiben", "https://org.example")
    assert r.kontak_penanggung_jawab == "Bewerbungsadresse:\nFrau Muster\nWeg 1\nOrt\nLand\nhr@foo.example" and (r.nama_perusahaan, r.alamat_email_bewerbung, r.deskripsi_perusahaan) == ("A & B", "hr@foo.example", "Wir")
    assert (r.jenis_ausbildung, r.alamat_detail, r.titik_data_di_peta) == ("Ausbildung Fachinformatiker Anwendungsentwicklung", "Weg 1 52062 Aachen", "")
    assert set(ruled(spark, "ausbildungsmarkt_de", [("u", page(job), None), (None, None, None)])) == {"ABM-77", "ABM-"}


def test_filters_of_portals(spark):
    data = {**JOB, "identifier": {}, "title": "Ausbildung Fachinformatiker Daten- und Prozessanalyse"}
    rows = [("https://a.example/viewjob?jk=000000000000000a", page(JOB), "x_ae"), ("https://a.example/viewjob?jk=000000000000000b", page(data), "x_ae"), ("https://a.example/viewjob?jk=000000000000000c", page(data), "x_dpa"), ("https://a.example/viewjob?jk=000000000000000d", page({**JOB, "title": "Praktikum"}), "x")]
    assert set(ruled(spark, "indeed_de", rows)) == {"INDEED-000000000000000a", "INDEED-000000000000000c", "INDEED-000000000000000d"}
    rows = [("https://a.example/?id=1", page(JOB), "x_ae"), ("https://a.example/?id=2", page(data), "x_ae"), ("https://a.example/?id=3", page(data), "x_dpa"), ("https://a.example/?id=4", page({**JOB, "title": "Praktikum"}), "x")]
    assert set(ruled(spark, "meinestadt_de", rows)) == {"MSD-1", "MSD-3"}


def test_contact_section(spark):
    texts = ["Start\nDein Kontakt\nFrau Muster\nTel\nDein Profil\nNeugier", "Hier\n0241 123456 oder x@y.example\nKontakt und noch sehr viele andere Wörter dazu", None, "\n".join(["Kontakt", *(f"z{i}" for i in range(20))])]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(contact_section(F.col("t"), "(?i)dein profil")).collect()]
    assert got == ["Dein Kontakt\nFrau Muster\nTel", "0241 123456 oder x@y.example", "", "\n".join(["Kontakt", *(f"z{i}" for i in range(12))])]


def test_pages_of_all_portals_are_read_once(spark):
    if not os.path.isdir(SF):
        pytest.skip("no driver tables")
    plan = registry.QUERIES["listing_by_rules"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Union" not in plan


def test_each_page_by_its_own_portals_rules(spark):
    body = '<p>Foo e.V.</p><p>Dein Kontakt: Frau Muster</p><p>Gehalt 900 €</p><a href="mailto:x@stepstone.de">x</a><a href="mailto:x@azubi.de">y</a><p>hr@foo.example</p>'
    rows = [(f"https://a.example/{s}", page({**JOB, "description": "<p>DEINE VORTEILE</p><p>Obst</p>"}, body), None, s) for s in ("azubi_de", "stepstone_de", "meinestadt_de", "elsewhere", None)]
    frame = spark.createDataFrame(rows, "url string, html string, category_id string, source string")
    portals = [RULES[s] for s in ("azubi_de", "stepstone_de", "meinestadt_de")]
    together = sorted(map(tuple, parse_sources(frame, portals, keep_all=True).collect()))
    alone = sorted(tuple(r) for p in portals for r in parse_by_rules(frame.where(F.col("source") == p.source).drop("source"), p, keep_all=True).collect())
    assert together == alone and len(together) == 3
    assert [r.alamat_email_bewerbung for r in parse_sources(frame, portals, keep_all=True).orderBy("sumber_data").collect()] == ["x@stepstone.de", "x@stepstone.de", "x@azubi.de"]
