"""Portal pages and API details read into listings end to end, each with the SQL for the same rows.

The driver's tables hold no portal pages, so each document becomes one: its number decides the portal, the shape of the structured data and what the page holds, its text is the list of tasks. The page is built and parsed
by Spark; the SQL states what a reader of the page finds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from korbwerk.plans.queries import register, table
from korbwerk.schema import DETAIL_URL
from korbwerk.sources.portal_rules import RULES, parse_sources
from korbwerk.sources.portals import PORTALS, parse_details, parse_pages

#: The portals whose rules differ; the others differ from the first in names alone, and each portal has a plan of its own, which takes seconds to compile.
_PORTALS = [PORTALS[p] for p in ("ausbildung_de", "azubi_de", "indeed_de", "meinestadt_de", "stepstone_de")]
_N = len(_PORTALS)


def _of_portal(value) -> str:
    """A value of the row's portal, in the SQL of both engines."""
    # runs of five numbers share a portal, so that each portal meets all other cases
    return "CASE " + " ".join(f"WHEN i % {5 * _N} < {5 * k + 5} THEN '{value(p)}'" for k, p in enumerate(_PORTALS)) + " END"


_TEXT = "'Text ' || regexp_replace(substr(coalesce(text, ''), 1, 80), '[^A-Za-z]+', '_'{})"
_UUID = "'0a1b2c3d-1111-2222-3333-' || lpad(CAST(i AS STRING), 12, '0')"
_HEX = "lpad(lower(hex(i)), 16, '0')"
#: Each portal's pages have addresses of their own; other numbers than a third of them hold a UUID where the portal looks for one.
_PART = f"CASE WHEN source = 'indeed_de' THEN 'viewjob?jk=' || {_HEX} WHEN source = 'stepstone_de' THEN 'stellen--Koch--' || i || '-inline.html' WHEN i % 3 = 1 THEN 'stelle/' || {_UUID} || '?x=1' ELSE 'stellen/job-' || i || '/#y' END"
_PLACE = """'"geo": {' || CASE WHEN i % 5 = 0 THEN '"latitude": 50.5, "longitude": ' || (i % 90) || '.25' ELSE '' END || '}, "address": {' || CASE WHEN i % 5 = 4 THEN '' ELSE '"addressLocality": "Ort ' || (i % 9) || '", "postalCode": "' || lpad(CAST(i AS STRING), 5, '0') || '"'
|| CASE WHEN i % 3 = 1 THEN '' ELSE ', "streetAddress": "Weg ' || i || '"' END END || '}'"""
_PAY = """CASE i % 6 WHEN 0 THEN ', "baseSalary": {"currency": "EUR", "value": {"minValue": 900, "maxValue": 1100}}' WHEN 4 THEN ', "baseSalary": {"minValue": 1, "maxValue": 1}' ELSE '' END"""
_JOB = f"""'{{"@type": ' || CASE WHEN i % 4 = 3 THEN '["Thing", "JobPosting"]' ELSE '"JobPosting"' END || ', "title": "Ausbildung Koch ' || i || '", "description": "<p>Deine Aufgaben</p><p>' || task || '</p><p>Dein Profil</p><p>Neugier &amp; Mut</p><p>Wir bieten</p><p>Obst</p>"'
|| CASE WHEN i % 3 = 0 THEN ', "identifier": {{"value": "ID' || i || '"}}, "jobStartDate": "2026-09-01T08:00"' ELSE '' END || CASE WHEN i % 7 = 2 THEN '' ELSE ', "hiringOrganization": {{"name": "Foo ' || i || '", "sameAs": "https://foo.example"}}' END
|| ', "jobLocation": ' || CASE WHEN i % 2 = 0 THEN '{{' || place || '}}' ELSE '[{{' || place || '}}]' END || {_PAY} || '}}'"""
_DATA = """CASE i % 4 WHEN 0 THEN ld || job || '</script>' WHEN 1 THEN ld || '[{"@type": "BreadcrumbList"}, ' || job || ']</script>'
WHEN 2 THEN ld || '{"@graph": [' || job || ', {"@type": "Organization", "name": "Org ' || i || '", "url": "https://org.example/' || i || '"}]}</script>' ELSE ld || '{oops</script>' || ld || job || '</script>' END"""
_LINKS = """CASE i % 5 WHEN 0 THEN '<a href="https://ats.example/1">Jetzt bewerben</a><a class="x" href="https://ats.example/direktbewerbung/' || i || '">hier</a>' WHEN 1 THEN '<a href="https://ats.example/2">Jetzt bewerben</a><a href="https://www.' || domain || '/apply/' || i || '">Apply now</a>'
WHEN 2 THEN '<a href="https://www.' || domain || '/start">Start</a><a href="https://ats.example/3?i=' || i || '">Zum <b>Bewerben</b></a>' WHEN 3 THEN '<a href="#top">Bewerben</a><a href="' || url || '">Bewerben</a>' ELSE '' END
|| CASE i % 4 WHEN 1 THEN '<a href="mailto:hr%2Bjobs@firma.example?subject=x">Mail</a>' WHEN 2 THEN '<p>Mail an info' || i || '@firma.example</p>' WHEN 3 THEN '<a href="mailto:service@' || domain || '">Mail</a>' ELSE '' END"""
_MAIN = """'<h1>Stelle</h1>' || CASE WHEN i % 7 = 2 THEN '<p>Beispiel ' || i || ' GmbH</p>' ELSE '' END || CASE WHEN i % 5 = 4 THEN '<p>- Kleinstadt</p><p>Weg 3, 12345 Kleinstadt</p>' ELSE '' END
|| CASE i % 6 WHEN 1 THEN '<p>1. Jahr</p><p>1.000 €</p><p>2. Jahr 1.100 €</p>' WHEN 2 THEN '<p>Gehalt: 1.200 € bis 1.300 € und 1.200€</p>' WHEN 3 THEN '<p>Preis 5 €</p>' ELSE '' END || CASE WHEN i % 4 = 1 THEN '<p>Dein Kontakt: Frau Muster</p>' ELSE '' END"""
_COLUMNS = ("referenznummer", "sumber_data", "nama_perusahaan", "titik_data_di_peta", "posisi_kota", "alamat_detail", "detail_deskripsi", "gaji", "persyaratan", "jenis_ausbildung", "apa_yang_ditawarkan", "link_website_perusahaan", "alamat_email_bewerbung", "link_bewerbung", "kontak_penanggung_jawab", "tanggal_mulai")


def portal_pages(docs: DataFrame, task: str = _TEXT.format(""), job: str = _JOB, more: str = "''") -> DataFrame:
    """url, html, category_id and source of one page for each document; task, job and more: SQL of its list of tasks, its structured data and what ends its main text."""
    steps = [
        f"*, doc_id AS i, {task} AS task", f"*, {_of_portal(lambda p: p.source)} AS source_, {_of_portal(lambda p: p.domain)} AS domain", "* EXCEPT (source, source_), source_ AS source",
        f"""*, 'https://www.' || domain || '/' || {_PART} AS url, {_PLACE} AS place, '<script type="application/ld+json">' AS ld""", f"*, {job} AS job",
        f"url, source, '' AS category_id, '<html>' || {_DATA} || '<main>' || {_MAIN} || {_LINKS} || {more} || '</main></html>' AS html",
    ]
    return reduce(lambda df, s: df.selectExpr(*_split(s)), steps, docs)


def _split(select: str) -> list[str]:
    """Expressions of a select list: commas outside brackets and quotes part them."""
    out, depth, quoted, begin = [], 0, False, 0
    for at, c in enumerate(select):
        quoted ^= c == "'"
        depth += 0 if quoted else (c in "([") - (c in ")]")
        if c == "," and not quoted and not depth:
            out.append(select[begin:at])
            begin = at + 1
    return [*out, select[begin:]]


_FOUND = f"""WITH d AS (SELECT doc_id AS i, {_TEXT.format(", 'g'")} AS task, {_of_portal(lambda p: p.source)} AS source, {_of_portal(lambda p: p.prefix)} AS prefix, {_of_portal(lambda p: p.domain)} AS domain FROM documents),
p AS (SELECT *, prefix || CASE WHEN i % 3 = 0 THEN 'ID' || i WHEN source = 'indeed_de' THEN printf('%016x', i) WHEN source = 'stepstone_de' THEN i::VARCHAR WHEN i % 3 = 1 THEN '0a1b2c3d-1111-2222-3333-' || printf('%012d', i) ELSE 'job-' || i END AS referenznummer FROM d)
SELECT referenznummer, source AS sumber_data, CASE WHEN i % 4 = 2 THEN 'Org ' || i WHEN i % 7 = 2 THEN 'Beispiel ' || i || ' GmbH' ELSE 'Foo ' || i END AS nama_perusahaan, CASE WHEN i % 5 = 0 THEN '50.5,' || (i % 90) || '.25' ELSE '' END AS titik_data_di_peta,
CASE WHEN i % 5 = 4 THEN 'Kleinstadt' ELSE 'Ort ' || (i % 9) END AS posisi_kota, CASE WHEN i % 5 = 4 THEN 'Weg 3, 12345 Kleinstadt' ELSE CASE WHEN i % 3 = 1 THEN '' ELSE 'Weg ' || i || ', ' END || CASE WHEN i < 100000 THEN printf('%05d', i) ELSE substr(i::VARCHAR, 1, 5) END || ' Ort ' || (i % 9) END AS alamat_detail,
'Ausbildung Koch ' || i || chr(10) || chr(10) || 'Deine Aufgaben' || chr(10) || task || chr(10) || chr(10) || 'Dein Profil' || chr(10) || 'Neugier & Mut' || chr(10) || chr(10) || 'Wir bieten' || chr(10) || 'Obst' AS detail_deskripsi,
CASE i % 6 WHEN 0 THEN '900.0 - 1100.0 EUR' WHEN 1 THEN '1. Jahr: 1.000 €' || chr(10) || '2. Jahr: 1.100 €' WHEN 2 THEN '1.200 €, 1.300 €' WHEN 3 THEN CASE WHEN source = 'azubi_de' THEN '' ELSE '5 €' END WHEN 4 THEN CASE WHEN source = 'meinestadt_de' THEN '1.0 - 1.0 EUR' ELSE '' END ELSE '' END AS gaji,
'Dein Profil' || chr(10) || 'Neugier & Mut' AS persyaratan, 'Ausbildung | Koch ' || i AS jenis_ausbildung, 'Wir bieten' || chr(10) || 'Obst' AS apa_yang_ditawarkan,
CASE WHEN i % 4 = 2 THEN 'https://org.example/' || i WHEN i % 7 = 2 THEN '' ELSE 'https://foo.example' END AS link_website_perusahaan, CASE i % 4 WHEN 1 THEN 'hr+jobs@firma.example' WHEN 2 THEN 'info' || i || '@firma.example' ELSE '' END AS alamat_email_bewerbung,
CASE i % 5 WHEN 0 THEN 'https://ats.example/direktbewerbung/' || i WHEN 1 THEN 'https://www.' || domain || '/apply/' || i WHEN 2 THEN 'https://ats.example/3?i=' || i ELSE '' END AS link_bewerbung,
CASE WHEN i % 4 = 1 THEN 'Dein Kontakt: Frau Muster' ELSE '' END AS kontak_penanggung_jawab, CASE WHEN i % 3 = 0 THEN '2026-09-01' ELSE '' END AS tanggal_mulai FROM p"""


@register(_FOUND)
def listing_of_page(spark, sf_dir):
    """2.11, E11, E13 to E17, E19, E34, E35, E38, E42, E44, E45, P16, P17: the listings of five portals' pages."""
    pages = portal_pages(table(spark, sf_dir, "documents"))
    each = [parse_pages(pages.where(F.col("source") == p.source), p, keep_all=True).select(*_COLUMNS) for p in _PORTALS]
    return reduce(DataFrame.unionByName, each)


#: What the pages hold besides, for the rules of single portals: a day on which work begins, another salary, papers to send.
_MORE = "CASE i % 4 WHEN 2 THEN '<p>Ausbildungsbeginn: 1.8.2027</p>' WHEN 3 THEN '<p>Einstieg ab 15.09.2026</p>' ELSE '' END || CASE WHEN i % 6 = 5 THEN '<p>Vergütung im Jahr: 777 €</p>' ELSE '' END"
_PAPERS = _JOB.replace("<p>Obst</p>\"'", "<p>Obst</p>' || CASE WHEN i % 5 = 2 THEN '<p>Zeugnis und Lebenslauf</p>' ELSE '' END || '\"'")
_RULED = (*_COLUMNS, "dokumen_yang_harus_dipenuhi")
_LINES = "CASE i % 5 WHEN 0 THEN 'Jetzt bewerben' || chr(10) || 'hier' || chr(10) WHEN 1 THEN 'Jetzt bewerben' || chr(10) || 'Apply now' || chr(10) WHEN 2 THEN 'Start' || chr(10) || 'Zum' || chr(10) || 'Bewerben' || chr(10) WHEN 3 THEN 'Bewerben' || chr(10) || 'Bewerben' || chr(10) ELSE '' END"
_BY_RULES = f"""WITH d AS (SELECT doc_id AS i, 'Text ' || sha256(coalesce(text, '')) AS task, {_of_portal(lambda p: p.source)} AS source, {_of_portal(lambda p: p.prefix)} AS prefix, {_of_portal(lambda p: p.domain)} AS domain FROM documents),
p AS (SELECT *, CASE WHEN source = 'indeed_de' THEN printf('%016x', i) WHEN i % 3 = 0 THEN 'ID' || i WHEN source = 'stepstone_de' THEN i::VARCHAR WHEN i % 3 = 1 THEN '0a1b2c3d-1111-2222-3333-' || printf('%012d', i) ELSE 'job-' || i END AS id, source = 'meinestadt_de' AS city, source IN ('indeed_de', 'meinestadt_de') AS alone,
CASE WHEN i % 5 = 2 THEN 'Zeugnis und Lebenslauf' ELSE '' END AS papers, CASE WHEN i < 100000 THEN printf('%05d', i) ELSE substr(i::VARCHAR, 1, 5) END AS code FROM d), q AS (SELECT *, 'Wir bieten' || chr(10) || 'Obst' || CASE WHEN city AND papers <> '' THEN chr(10) || papers ELSE '' END AS offers FROM p)
SELECT prefix || id AS referenznummer, source AS sumber_data, CASE WHEN i % 4 = 2 AND NOT alone THEN 'Org ' || i WHEN i % 7 = 2 THEN 'Beispiel ' || i || ' GmbH' ELSE 'Foo ' || i END AS nama_perusahaan, CASE WHEN i % 5 = 0 AND source IN ('indeed_de', 'stepstone_de') THEN '50.5,' || (i % 90) || '.25' ELSE '' END AS titik_data_di_peta,
CASE WHEN i % 5 <> 4 THEN 'Ort ' || (i % 9) WHEN city THEN 'Kleinstadt' ELSE '' END AS posisi_kota, CASE WHEN i % 5 <> 4 THEN CASE WHEN i % 3 = 1 THEN '' ELSE 'Weg ' || i || ' ' END || code || ' Ort ' || (i % 9) WHEN NOT city THEN '' WHEN i % 7 = 2 AND i BETWEEN 10000 AND 99999 THEN 'Beispiel ' || i || ' GmbH' ELSE 'Weg 3, 12345 Kleinstadt' END AS alamat_detail,
'Ausbildung Koch ' || i || chr(10) || chr(10) || 'Deine Aufgaben' || chr(10) || task || chr(10) || chr(10) || 'Dein Profil' || chr(10) || 'Neugier & Mut' || chr(10) || chr(10) || offers AS detail_deskripsi,
CASE i % 6 WHEN 0 THEN '900.0 - 1100.0 EUR' WHEN 1 THEN CASE WHEN alone THEN '1.000 €, 1.100 €' WHEN source = 'stepstone_de' THEN '' ELSE '1. Jahr: 1.000 €' || chr(10) || '2. Jahr: 1.100 €' END WHEN 4 THEN CASE WHEN alone THEN '1.0 - 1.0 EUR' ELSE '' END WHEN 5 THEN '777 €' WHEN 2 THEN CASE WHEN source = 'azubi_de' THEN '' ELSE '1.200 €, 1.300 €' END ELSE CASE WHEN source IN ('azubi_de', 'stepstone_de') THEN '' ELSE '5 €' END END AS gaji,
'Dein Profil' || chr(10) || 'Neugier & Mut' AS persyaratan, CASE WHEN city THEN 'Ausbildung Koch ' ELSE 'Ausbildung | Koch ' END || i AS jenis_ausbildung, offers AS apa_yang_ditawarkan, CASE WHEN i % 7 <> 2 THEN 'https://foo.example' WHEN i % 4 = 2 AND NOT alone THEN 'https://org.example/' || i ELSE '' END AS link_website_perusahaan,
CASE WHEN i % 4 = 1 THEN 'hr+jobs@firma.example' WHEN i % 4 = 2 AND source NOT IN ('ausbildung_de', 'stepstone_de') THEN 'info' || i || '@firma.example' ELSE '' END AS alamat_email_bewerbung,
CASE i % 5 WHEN 0 THEN 'https://ats.example/direktbewerbung/' || i WHEN 1 THEN 'https://www.' || domain || '/apply/' || i WHEN 2 THEN 'https://ats.example/3?i=' || i ELSE '' END AS link_bewerbung,
CASE WHEN i % 4 <> 1 THEN '' WHEN city THEN 'Dein Kontakt: Frau Muster' || chr(10) || {_LINES} || 'Mail' || CASE WHEN i % 6 = 5 THEN chr(10) || 'Vergütung im Jahr: 777 €' ELSE '' END ELSE 'Dein Kontakt: Frau Muster' END AS kontak_penanggung_jawab,
CASE WHEN NOT city THEN '' WHEN i % 3 = 0 THEN '2026-09-01' WHEN i % 4 = 2 THEN '2027-08-01' WHEN i % 4 = 3 THEN '2026-09-15' ELSE '' END AS tanggal_mulai, CASE WHEN papers = '' THEN '' WHEN city THEN 'Lebenslauf, Zeugnis' ELSE papers END AS dokumen_yang_harus_dipenuhi FROM q"""


@register(_BY_RULES)
def listing_by_rules(spark, sf_dir):
    """2.11, E15, E34 to E41: the listings that each portal's own rules find in its pages."""
    pages = portal_pages(table(spark, sf_dir, "documents"), "'Text ' || sha2(coalesce(text, ''), 256)", _PAPERS, _MORE)
    return parse_sources(pages, [RULES[p.source] for p in _PORTALS], keep_all=True).select(*_RULED)


#: An API detail for each document: fields and text by its number.
_DETAIL_TEXT = """CASE i % 3 WHEN 0 THEN 'Wir sind eine Firma mit Herz ' || i || '.\n\n' ELSE '' END || CASE i % 4 WHEN 0 THEN 'Dein Profil\n- Neugier ' || i || '\n- Mut\n\n' ELSE '' END || CASE i % 5 WHEN 1 THEN 'Benefits\n* Obst\n\n' ELSE '' END
|| CASE i % 6 WHEN 1 THEN 'Das Gehalt beträgt 1.' || (100 + i % 800) || ' € im Monat.\n\n' ELSE '' END || CASE i % 7 WHEN 2 THEN 'Lebenslauf und anderes\n- Foto\n\n' ELSE '' END || CASE i % 4 WHEN 1 THEN 'Ansprechpartner: Herr Muster\nTel. folgt\nbewerbung' || i || '@firma.example\nNicht mehr\n' WHEN 2 THEN 'Post an info@firma.example und noch eine allgemeine Adresse für alle anderen Fragen. Karriere: talent' || i || '@firma.example' ELSE '' END"""
_DETAILS = f"""SELECT i, CAST(i AS STRING) || '-S' AS referenznummer, 'c' AS category_id, 'Firma ' || (i % 50) AS firma, {{text}} AS t, CASE WHEN i % 3 = 1 THEN i + 0.5 END AS j1, CASE WHEN i % 6 = 1 THEN i + 1.5 END AS j2, CASE i % 4 WHEN 0 THEN 'NACH_TARIF' WHEN 1 THEN 'KEINE_ANGABEN' END AS code,
CASE i % 6 WHEN 0 THEN 'HAUPTSCHULABSCHLUSS' WHEN 1 THEN 'NICHT_RELEVANT' WHEN 2 THEN 'EIN_ANDERER_ABSCHLUSS' END AS degree, CASE i % 3 WHEN 0 THEN 'DUALE_AUSBILDUNG' END AS kind, CASE WHEN i % 5 <> 0 THEN 'Beruf ' || (i % 5) END AS main, CASE i % 4 WHEN 0 THEN 'www.firma.example' WHEN 1 THEN 'http://firma.example' END AS site FROM {{docs}}"""


def api_details(docs: DataFrame) -> DataFrame:
    """Details as the API's JSON reads."""
    text = _DETAIL_TEXT.replace("\n|| CASE", " || CASE")
    rows = docs.selectExpr("doc_id AS i").createOrReplaceTempView("_korbwerk_details") or docs.sparkSession.sql(_DETAILS.format(text=text.replace("\n", "\\n"), docs="_korbwerk_details"))
    place = F.struct(F.lit(50.5).alias("breite"), F.when(F.col("i") % 2 == 0, F.lit(7.25)).alias("laenge"), F.struct(F.lit("Weg").alias("strasse"), F.when(F.col("i") % 3 == 0, F.col("i").cast("string")).alias("hausnummer"), F.lit("52062").alias("plz"), F.lit("Aachen").alias("ort")).alias("adresse"))
    none = F.lit(None).cast("double")
    return rows.select(
        "referenznummer", "category_id", "firma", F.col("t").alias("stellenangebotsBeschreibung"), F.array(place).alias("stellenlokationen"), F.col("j1").cast("double").alias("ausbildungsverguetungJahr1"), F.col("j2").cast("double").alias("ausbildungsverguetungJahr2"), none.alias("ausbildungsverguetungJahr3"),
        F.col("code").alias("verguetungsangabe"), F.col("degree").alias("geforderterBildungsabschluss"), F.col("kind").alias("ausbildungsart"), F.col("main").alias("hauptberuf"), F.array(F.lit("Beruf 1"), F.lit("Koch")).alias("alleBerufe"), F.col("site").alias("allianzpartnerUrl"),
        F.lit("https://extern.example").alias("externeURL"), F.lit("2027-09-01").alias("eintrittsdatum"),
    )


_DETAIL_SQL = f"""WITH d AS (SELECT doc_id AS i FROM documents)
SELECT i || '-S' AS referenznummer, CASE WHEN i % 2 = 0 THEN '50.5,7.25' ELSE '' END AS titik_data_di_peta, 'Weg' || CASE WHEN i % 3 = 0 THEN ' ' || i ELSE '' END || ', 52062 Aachen' AS alamat_detail,
CASE WHEN i % 3 = 1 THEN 'Jahr 1: ' || round_even(i + 0.5, 0)::BIGINT || ' EUR/Monat' || CASE WHEN i % 6 = 1 THEN ' | Jahr 2: ' || round_even(i + 1.5, 0)::BIGINT || ' EUR/Monat' ELSE '' END WHEN i % 4 = 0 THEN 'Nach Tarif' ELSE '' END AS gaji,
concat_ws(chr(10), CASE WHEN i % 4 = 0 THEN 'Dein Profil' || chr(10) || '- Neugier ' || i || chr(10) || '- Mut' END, CASE i % 6 WHEN 0 THEN 'Hauptschulabschluss' WHEN 2 THEN 'Ein Anderer Abschluss' END) AS persyaratan,
concat_ws(' | ', CASE WHEN i % 3 = 0 THEN 'Duale Ausbildung' END, CASE WHEN i % 5 > 0 THEN 'Beruf ' || (i % 5) END, CASE WHEN i % 5 <> 1 THEN 'Beruf 1' END, 'Koch') AS jenis_ausbildung,
CASE i % 4 WHEN 0 THEN 'https://www.firma.example' WHEN 1 THEN 'http://firma.example' ELSE '' END AS link_website_perusahaan, CASE i % 4 WHEN 1 THEN 'bewerbung' || i || '@firma.example' WHEN 2 THEN 'talent' || i || '@firma.example' ELSE '' END AS alamat_email_bewerbung,
CASE WHEN i % 4 = 1 THEN 'Ansprechpartner: Herr Muster' || chr(10) || 'Tel. folgt' || chr(10) || 'bewerbung' || i || '@firma.example' ELSE '' END AS kontak_penanggung_jawab, '{DETAIL_URL}' || i || '-S' AS ba_job_url, '2027-09-01' AS tanggal_mulai FROM d"""


@register(_DETAIL_SQL)
def listing_of_detail(spark, sf_dir):
    """2.11, S8, P16 to P21, E6, E9: listings of API details."""
    found = parse_details(api_details(table(spark, sf_dir, "documents")))
    return found.select("referenznummer", "titik_data_di_peta", "alamat_detail", "gaji", "persyaratan", "jenis_ausbildung", "link_website_perusahaan", "alamat_email_bewerbung", "kontak_penanggung_jawab", "ba_job_url", "tanggal_mulai")
