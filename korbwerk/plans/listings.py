"""Queries of the flagship: one table of listings, and the operators over it end to end, each with the SQL for the same rows.

The driver's tables hold no listings, so `documents` stands for them: a document is a listing's description, and its number decides the other columns, with all the cases that the operators tell apart
(blank and repeated references, companies, cities, links, sources, titles of each kind). The expressions of COLUMNS read the same in Spark and in the SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from korbwerk.functions import classify
from korbwerk.functions.text import LEGAL_FORMS
from korbwerk.operators import audit, dedup, enrich, progress, ranking
from korbwerk.plans.checkpoint import materialise
from korbwerk.plans.queries import register, table
from korbwerk.schema import CATEGORY_PRIORITY, JOB_TYPES, LISTING, PARTNER_DOMAINS, PORTAL_MARKERS, SCORE_FIELDS

_TEXT = "CAST({} AS STRING)".format
_PUBLIC = "https://www.arbeitsagentur.de/jobsuche/jobdetail/"
COLUMNS = {
    "ordinal": "doc_id",
    "referenznummer": f"CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 50 = 3 THEN 'AD-' || {_TEXT('doc_id')} WHEN doc_id % 5 = 1 THEN 'AD-' || {_TEXT('doc_id - doc_id % 2')} WHEN doc_id % 5 = 2 THEN 'MAD-' || {_TEXT('doc_id')} ELSE ' R-' || {_TEXT('doc_id - doc_id % 4')} END",
    "category_id": "CASE doc_id % 6 WHEN 0 THEN 'fachinformatiker_ae_2026' WHEN 1 THEN 'fachinformatiker_dpa' WHEN 2 THEN 'fachinformatiker_ae' WHEN 3 THEN 'azubiyo_de_ae' WHEN 4 THEN 'backinjob_si' ELSE 'no_such_category' END",
    "nama_perusahaan": f"CASE WHEN doc_id % 11 = 0 THEN '' ELSE 'Firma ' || {_TEXT('doc_id - doc_id % 40')} || CASE WHEN doc_id % 2 = 0 THEN ' GmbH' ELSE ' GmbH & Co. KG' END END",
    "posisi_kota": "CASE WHEN doc_id % 9 = 0 THEN '' WHEN doc_id % 3 = 0 THEN ' Bonn' WHEN doc_id % 3 = 1 THEN 'Zwickau' ELSE 'aachen ' END",
    "alamat_detail": f"CASE WHEN doc_id % 4 = 3 THEN '' ELSE 'Weg 1, ' || {_TEXT('10000 + doc_id % 2')} || ' Ort' END",
    "detail_deskripsi": "coalesce(text, '')",
    "jenis_ausbildung": "CASE doc_id % 10 WHEN 0 THEN 'Ausbildung Fachinformatiker Anwendungsentwicklung' WHEN 1 THEN 'Fachinformatiker Systemintegration' WHEN 2 THEN 'Werkstudent IT' WHEN 3 THEN 'Duales Studium Informatik' WHEN 4 THEN 'Kaufmann im Handel' WHEN 5 THEN 'Fachinformatiker Daten- und Prozessanalyse' WHEN 6 THEN 'Ausbildung Fachinformatiker (Vollzeit)' WHEN 7 THEN 'Fachinformatiker Teilzeit' WHEN 8 THEN 'Junior Web Entwickler' ELSE 'Fachinformatik digitale Vernetzung' END",
    "beruf_typ": "CASE doc_id % 9 WHEN 0 THEN 'ae' WHEN 1 THEN 'dpa' WHEN 2 THEN 'si' WHEN 3 THEN 'skip' WHEN 4 THEN ' AE' ELSE 'fi_other' END",
    "link_website_perusahaan": "CASE doc_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'https://www.arbeitsagentur.de/x' WHEN 2 THEN 'https://jobs.stepstone.de/y' WHEN 3 THEN 'firma.de' WHEN 4 THEN 'https://stepstone.de.example.org' ELSE ' https://www.firma.de/ ' END",
    "alamat_email_bewerbung": "CASE WHEN doc_id % 4 = 1 THEN 'hr@firma.de' WHEN doc_id % 4 = 2 THEN ' ' ELSE '' END",
    "link_bewerbung": f"CASE WHEN doc_id % 12 = 5 THEN 'https://jobs.example.org/' || {_TEXT('doc_id - doc_id % 30')} WHEN doc_id % 12 = 6 THEN ' {_PUBLIC}' || {_TEXT('doc_id')} ELSE '' END",
    "link_bewerbung_externe": f"CASE WHEN doc_id % 20 = 4 THEN 'https://jobs.example.org/' || {_TEXT('doc_id - doc_id % 30')} || '/apply' ELSE '' END",
    "kontak_penanggung_jawab": "CASE WHEN doc_id % 6 = 2 THEN ' 01.08.2026' WHEN doc_id % 6 = 4 THEN 'Frau Muster' ELSE '' END",
    "ba_job_url": f"CASE WHEN doc_id % 5 IN (0, 3, 4) AND doc_id % 8 <> 0 THEN '{_PUBLIC}' || {_TEXT('doc_id')} ELSE '' END",
    "sumber_data": "CASE doc_id % 5 WHEN 1 THEN 'ausbildung_de' WHEN 2 THEN 'Meine_Ausbildung_de ' ELSE 'arbeitsagentur' END",
    "ausbildung_de_url": f"CASE WHEN doc_id % 5 = 1 THEN 'https://jobs.example.org/' || {_TEXT('doc_id - doc_id % 30')} || '?ref=1' ELSE '' END",
    "kelengkapan_score": "CAST((doc_id * 7) % 101 AS INT)",
    "scraped_at": "CASE WHEN doc_id % 2 = 0 THEN '2026-06-01T00:00:00' ELSE '2026-06-02T00:00:00' END",
}
KINDS = {"string": "STRING", "boolean": "BOOLEAN", "integer": "INT"}
COLUMNS |= {f.name: "''" if f.dataType.typeName() == "string" else "false" if f.dataType.typeName() == "boolean" else "CAST(NULL AS INT)" for f in LISTING if f.name not in COLUMNS}
LISTINGS = "l AS (SELECT " + ", ".join(f"{x} AS {c}" for c, x in COLUMNS.items()) + " FROM documents)"


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(*(f"{x} AS {c}" for c, x in COLUMNS.items()))


def strip(x: str) -> str:
    return rf"regexp_replace(coalesce({x}, ''), '^[\s\x0b\p{{Z}}]+|[\s\x0b\p{{Z}}]+$', '', 'g')"


def low(x: str) -> str:
    return f"lower({strip(x)})"


def letters(x: str) -> str:
    return f"regexp_replace(lower({x}), '[^a-z0-9]+', '', 'g')"


_PRIORITY = "CASE category_id " + " ".join(f"WHEN '{c}' THEN {p}" for c, p in CATEGORY_PRIORITY.items()) + " ELSE 0 END"
_BOTH = "lower(jenis_ausbildung || ' ' || substr(detail_deskripsi, 1, 120))"
_FAMILY = f"CASE WHEN contains({_BOTH}, 'daten') AND contains({_BOTH}, 'prozess') THEN 'dpa' WHEN contains({_BOTH}, 'anwendungsentwicklung') THEN 'ae' ELSE {letters('substr(CASE WHEN length(jenis_ausbildung) > 0 THEN jenis_ausbildung ELSE detail_deskripsi END, 1, 80)')} END"
_NEAR = [low(c) for c in ("nama_perusahaan", "jenis_ausbildung", "posisi_kota", "alamat_detail")]
#: Listings with their keys: r (reference), sec (hash), near, cross_ (null where parts lack), prio.
KEYED = f"""{LISTINGS}, k AS (SELECT *, {strip('referenznummer')} AS r, {_PRIORITY} AS prio,
sha256({_NEAR[0]} || '|' || {_NEAR[1]} || '|' || {_NEAR[2]} || '|' || regexp_extract(alamat_detail, '\\b(\\d{{5}})\\b', 1) || '|' || lower({strip('substr(detail_deskripsi, 1, 200)')})) AS sec,
CASE WHEN {' AND '.join(f"{x} <> ''" for x in _NEAR)} THEN {" || chr(1) || ".join(_NEAR)} END AS near,
CASE WHEN {letters('nama_perusahaan')} <> '' AND {low('posisi_kota')} <> '' THEN {letters('nama_perusahaan')} || chr(1) || {low('posisi_kota')} || chr(1) || {_FAMILY} END AS cross_,
{low('sumber_data')} IN ('ausbildung_de', 'meine_ausbildung_de') AS third, {low('sumber_data')} NOT IN ('ausbildung_de', 'meine_ausbildung_de') AND NOT regexp_matches({strip('referenznummer')}, '^(AD-|MAD-)') AS pub FROM l)"""
_ORDER = "prio DESC, length(detail_deskripsi) DESC, scraped_at DESC, ordinal"


def collapse(name: str, source: str) -> str:
    """CTEs name_a (all rows, by reference or hash), name_b (winners, by near key) and name (what is kept)."""
    return f"""{name}_a AS (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY kk) AS n, min(category_id) OVER (PARTITION BY kk) <> max(category_id) OVER (PARTITION BY kk) AS cats
FROM (SELECT *, CASE WHEN r <> '' THEN 'r' || r ELSE 'h' || sec END AS kk FROM {source}) WINDOW w AS (PARTITION BY kk ORDER BY {_ORDER})),
{name}_b AS (SELECT *, row_number() OVER (PARTITION BY near ORDER BY {_ORDER}) AS nr, count(*) OVER (PARTITION BY near) AS nn, min(r) OVER (PARTITION BY near) <> max(r) OVER (PARTITION BY near) AS refs FROM {name}_a WHERE rn = 1),
{name} AS (SELECT * EXCLUDE (kk, rn, n, cats, nr, nn, refs) FROM {name}_b WHERE near IS NULL OR NOT (nn > 1 AND refs) OR nr = 1)"""


def removed(name: str) -> str:
    """The counts of a collapse, by reason."""
    return f"""(SELECT count(*) FILTER (rn > 1 AND r <> '' AND cats) AS removed_by_refnr_cross_category, count(*) FILTER (rn > 1 AND r <> '' AND NOT cats) AS removed_by_refnr_within_category,
count(*) FILTER (rn > 1 AND r = '') AS removed_by_secondary_key, (SELECT count(*) FROM {name}_b WHERE near IS NOT NULL AND nn > 1 AND refs AND nr > 1) AS removed_by_near_duplicate FROM {name}_a)"""


def tokens(source: str) -> str:
    links = f"list_concat([{', '.join(low(c) for c in dedup.TOKEN_LINKS)}], flatten(list_transform([{', '.join(low(c) for c in dedup.TOKEN_LINKS)}], lambda x: regexp_extract_all(x, '{dedup.UUID}'))))"
    return f"(SELECT DISTINCT token FROM (SELECT unnest({links}) AS token FROM {source}) WHERE length(token) > 8)"


def against(name: str, new: str, master: str) -> str:
    """CTEs of the order-dependent filter: name_open (what no key of the master rejects) and name (ordinals of what is accepted), a fold over the rows in order."""
    links = " OR ".join(f"contains({low(c)}, token)" for c in dedup.LINKS)
    return f"""{name}_open AS (SELECT * FROM {new} n WHERE NOT EXISTS (SELECT 1 FROM {master} m WHERE m.r <> '' AND m.r = n.r) AND NOT EXISTS (SELECT 1 FROM {master} m WHERE m.near = n.near)
AND NOT EXISTS (SELECT 1 FROM {master} m WHERE m.cross_ = n.cross_) AND NOT EXISTS (SELECT 1 FROM {tokens(master)} WHERE {links})),
{name} AS (SELECT unnest(list_reduce(list({{'k': list_filter([CASE WHEN r <> '' THEN 'r' || r END, 'n' || near, 'c' || cross_], lambda x: x IS NOT NULL), 'ok': [ordinal]}} ORDER BY ordinal),
lambda a, b: CASE WHEN list_has_any(a.k, b.k) THEN a ELSE {{'k': list_concat(a.k, b.k), 'ok': list_concat(a.ok, b.ok)}} END).ok) AS ordinal FROM {name}_open)"""


_REASONS = "removed_by_refnr_cross_category, removed_by_refnr_within_category, removed_by_secondary_key, removed_by_near_duplicate"
_SUM = " + ".join(_REASONS.split(", "))


@register(f"WITH {KEYED}, {collapse('d', 'k')} SELECT ordinal, referenznummer, category_id FROM d")
def listing_dedup(spark, sf_dir):
    """What is left of all listings after the three phases."""
    return dedup.deduplicate(listings(spark, sf_dir))[0].select("ordinal", "referenznummer", "category_id")


@register(f"WITH {KEYED}, {collapse('d', 'k')}, s AS {removed('d')} SELECT (SELECT count(*) FROM k) AS input_total, {_REASONS}, (SELECT count(*) FROM d) AS output_total FROM s")
def listing_dedup_stats(spark, sf_dir):
    """Rows removed by each phase."""
    return dedup.deduplicate(listings(spark, sf_dir))[1]


@register(f"WITH {KEYED}, {collapse('d', 'k')}, n AS (SELECT sumber_data, count(*) AS n_before, count(*) FILTER (EXISTS (SELECT 1 FROM d WHERE d.ordinal = k.ordinal)) AS n_after FROM k GROUP BY 1) SELECT trim(sumber_data) AS source, n_before, n_after, n_before - n_after AS n_removed FROM n")
def dedup_stats_by_source(spark, sf_dir):
    """Listings by source before and after the three phases."""
    rows = listings(spark, sf_dir)
    counts = dedup.counts_before_after(rows, dedup.deduplicate(rows)[0], "sumber_data")
    return counts.select(F.trim("sumber_data").alias("source"), "n_before", "n_after", (F.col("n_before") - F.col("n_after")).alias("n_removed"))


@register(f"WITH {LISTINGS}, c AS (SELECT split_part(category_id, '_', 1) AS first, ends_with(category_id, '_ae') OR category_id = 'fachinformatiker_ae_2026' AS ae, ends_with(category_id, '_dpa') AS dpa, category_id FROM l), s AS (SELECT CASE WHEN starts_with(category_id, 'azubiyo_de') THEN 'azubiyo_de' WHEN starts_with(category_id, 'backinjob_') THEN 'backinjob_de' ELSE first END AS source, ae, dpa FROM c) SELECT source, count(*) AS n, count(*) FILTER (ae) AS n_ae, count(*) FILTER (dpa) AS n_dpa, grouping(source)::INT AS overall FROM s GROUP BY GROUPING SETS ((source), ())")
def listing_totals(spark, sf_dir):
    """Listings by source and over all, with those of both job families."""
    return progress.totals(listings(spark, sf_dir)).withColumn("overall", F.col("overall").cast("int"))


_SPLIT = f"{KEYED}, p AS (SELECT * FROM k WHERE pub), t AS (SELECT * FROM k WHERE third)"


@register(f"WITH {_SPLIT}, {against('ok', 't', 'p')} SELECT t.ordinal, ok.ordinal IS NOT NULL AS is_unique, CASE WHEN ok.ordinal IS NOT NULL THEN duplicate_of_refnr ELSE coalesce((SELECT min(r) FROM p WHERE p.r <> '' AND p.r = t.r), '') END AS duplicate_of_refnr, ok.ordinal IS NULL AS is_duplicate FROM t LEFT JOIN ok USING (ordinal)")
def listing_merge(spark, sf_dir):
    """Listings of the two boards against the public ones, in order; both results."""
    rows = listings(spark, sf_dir)
    unique, marked = dedup.filter_against(rows.where(dedup.third_party()), rows.where(dedup.public_family()))
    both = unique.withColumn("is_unique", F.lit(True)).unionByName(marked.withColumn("is_unique", F.lit(False)))
    return both.select("ordinal", "is_unique", "duplicate_of_refnr", F.col("is_duplicate_of_arbeitsagentur").alias("is_duplicate"))


@register(f"WITH {_SPLIT}, {against('ok', 't', 'p')} SELECT category_id, count(*) AS scraped, count(*) FILTER (ok.ordinal IS NULL) AS cross_duplicates, count(ok.ordinal) AS unique_new FROM t LEFT JOIN ok USING (ordinal) GROUP BY category_id")
def listing_merge_matrix(spark, sf_dir):
    """That filter's results by category."""
    rows = listings(spark, sf_dir)
    new = rows.where(dedup.third_party())
    return dedup.category_matrix(new, dedup.filter_against(new, rows.where(dedup.public_family()))[0])


@register(f"""WITH {_SPLIT}, f AS (SELECT t.ordinal, EXISTS (SELECT 1 FROM p WHERE p.near = t.near) OR EXISTS (SELECT 1 FROM p WHERE p.cross_ = t.cross_)
OR EXISTS (SELECT 1 FROM {tokens('p')} WHERE contains({low("CASE WHEN t.ausbildung_de_url <> '' THEN t.ausbildung_de_url ELSE t.ba_job_url END")}, token)) AS is_duplicate,
(SELECT arg_min(m.referenznummer, m.ordinal) FROM k m WHERE m.near = t.near OR m.cross_ = t.cross_) AS ref FROM t) SELECT ordinal, is_duplicate, CASE WHEN is_duplicate THEN coalesce(ref, '') ELSE '' END AS duplicate_of_refnr FROM f""")
def listing_marks(spark, sf_dir):
    """Listings of the two boards marked against all listings, with the first that they repeat."""
    rows = listings(spark, sf_dir)
    return dedup.mark_duplicates(rows.where(dedup.third_party()), rows).select("ordinal", F.col("is_duplicate_of_arbeitsagentur").alias("is_duplicate"), "duplicate_of_refnr")


_BATCH = f"{_SPLIT}, {collapse('d', 'p')}, {against('ok', 't', 'd')}, u AS (SELECT t.* FROM t JOIN ok USING (ordinal)), {collapse('b', 'u')}"


@register(f"WITH {_BATCH} SELECT ordinal, sumber_data FROM d UNION ALL SELECT ordinal, sumber_data FROM b UNION ALL SELECT ordinal, sumber_data FROM k WHERE NOT pub AND NOT third")
def listing_batch(spark, sf_dir):
    """The batch over all sources."""
    return dedup.deduplicate_all(listings(spark, sf_dir))[0].select("ordinal", "sumber_data")


@register(f"""WITH {_BATCH}, s AS (SELECT {', '.join(f'sum({x})::BIGINT AS {x}' for x in _REASONS.split(', '))} FROM (SELECT * FROM {removed('d')} UNION ALL SELECT * FROM {removed('b')})),
c AS (SELECT (SELECT count(*) FROM k) AS input_total, *, (SELECT count(*) FROM t) - (SELECT count(*) FROM ok) AS removed_by_cross_source FROM s) SELECT *, input_total - ({_SUM} + removed_by_cross_source) AS output_total FROM c""")
def listing_batch_stats(spark, sf_dir):
    """That batch's counts."""
    return dedup.deduplicate_all(listings(spark, sf_dir))[1]


_STEM = letters(f"regexp_replace(regexp_replace(regexp_replace({low('nama_perusahaan')}, '(?i)\\b(?:{LEGAL_FORMS})\\b\\.?', ' ', 'g'), '(?i)\\b(?:{LEGAL_FORMS})\\b\\.?', ' ', 'g'), '(?i)\\b(?:{LEGAL_FORMS})\\b\\.?', ' ', 'g')")
_BEST = f"""{LISTINGS}, b AS (SELECT *, CASE WHEN {_STEM} = '' THEN '__unknown__:' || referenznummer ELSE {_STEM} END AS company FROM l),
w AS (SELECT *, count(*) OVER (PARTITION BY company@BY) AS n_listings, row_number() OVER (PARTITION BY company@BY ORDER BY (beruf_typ = 'ae')::INT DESC, ({strip('alamat_email_bewerbung')} <> '')::INT DESC, kelengkapan_score DESC, ordinal) AS rn FROM b)"""


@register(f"WITH {_BEST.replace('@BY', '')} SELECT ordinal, nama_perusahaan, n_listings FROM w WHERE rn = 1")
def listing_best_of_company(spark, sf_dir):
    """The best listing of each company."""
    return ranking.best_per_company(listings(spark, sf_dir)).select("ordinal", "nama_perusahaan", "n_listings")


@register(f"WITH {_BEST.replace('@BY', ', ' + low('posisi_kota'))} SELECT ordinal, nama_perusahaan, n_listings FROM w WHERE rn = 1")
def listing_best_of_company_and_city(spark, sf_dir):
    """W5, A11's second key."""
    return ranking.best_per_company(listings(spark, sf_dir), by_city=True).select("ordinal", "nama_perusahaan", "n_listings")


@register(f"WITH {_BEST.replace('@BY', '')} SELECT sum(n_listings)::BIGINT AS input_total, count(*) AS unique_companies, sum(n_listings - 1)::BIGINT AS skipped_duplicates, count(*) FILTER (n_listings > 1) AS companies_with_multiple_listings FROM w WHERE rn = 1")
def company_uniqueness(spark, sf_dir):
    """A11."""
    return audit.uniqueness(ranking.best_per_company(listings(spark, sf_dir)))


_KIND = "CASE doc_id % 4 WHEN 0 THEN '4' WHEN 1 THEN '' WHEN 2 THEN ' 4x' WHEN 3 THEN '1' END"
_TYPES = f"coalesce(list_position([{', '.join(repr(t) for t in JOB_TYPES)}], {low('beruf_typ')}), {len(JOB_TYPES) + 1})"


@register(f"""WITH {LISTINGS}, o AS (SELECT l.*, {_KIND.replace('doc_id', 'ordinal')} AS angebotsart FROM l) SELECT ordinal, row_number() OVER (ORDER BY CASE WHEN angebotsart IN ('', '4') THEN 0 ELSE 1 END, {_TYPES}, -kelengkapan_score, lower(posisi_kota), lower(nama_perusahaan), referenznummer, ordinal) AS place FROM o QUALIFY place <= 200""")
def listing_order(spark, sf_dir):
    """O1, O2, F1: the first 200 listings in the canonical order, with their places."""
    rows = listings(spark, sf_dir).withColumn("angebotsart", F.expr(_KIND.replace("doc_id", "ordinal")))
    order = [c.alias(f"o{i}") for i, c in enumerate([*ranking.canonical_order(rows), F.col("ordinal")])]
    first = rows.select("ordinal", F.struct(*order).alias("o")).orderBy("o").limit(200)
    return first.select("ordinal", F.row_number().over(Window.orderBy("o")).cast("long").alias("place"))  # 200 rows


_PILOT = "SELECT ordinal FROM l WHERE trim(alamat_email_bewerbung) <> '' AND beruf_typ = 'ae' ORDER BY kelengkapan_score DESC, ordinal LIMIT 25"


@register(f"WITH {LISTINGS} {_PILOT}")
def listing_pilot(spark, sf_dir):
    """The 25 best listings of one type with an address."""
    return ranking.pilot(listings(spark, sf_dir), "ae", 25).select("ordinal")


def marks(x: str, names: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), '{m}')" for m in names) + ")"


def hostname(x: str) -> str:
    return rf"regexp_replace(lower(regexp_extract({strip(x)}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '')"


def site_type(x: str) -> str:
    partner = " OR ".join(f"{hostname(x)} = '{d}' OR ends_with({hostname(x)}, '.{d}')" for d in PARTNER_DOMAINS)
    return f"CASE WHEN {strip(x)} = '' THEN 'empty' WHEN {marks(x, PORTAL_MARKERS)} THEN 'ba_portal' WHEN {hostname(x)} = '' THEN 'empty' WHEN {partner} THEN 'partner_portal' ELSE 'company' END"


_LEAD, _ALL, _T = "lower(jenis_ausbildung || ' ' || substr(detail_deskripsi, 1, 1200))", "lower(jenis_ausbildung || ' ' || detail_deskripsi || ' ' || category_id)", strip("jenis_ausbildung")


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, '(?i){pattern}')"


# The patterns with a negative lookahead are told apart by two tests, which is the same where a text holds the word once at most, as here.
_WORDS = "(praktikum|trainee|werkstudent|werkstudierend|minijob|ferienjob)"
_HOURS = rf"({has(_LEAD, r'\b(vollzeit|teilzeit)\b')} AND NOT {has(_LEAD, r'\b(vollzeit|teilzeit)\b[\s\S]{0,40}\bausbildung\b')})"
_JOBS = rf"""({has(_LEAD, r'\b(junior|senior|lead|principal)\s+.{0,30}\b(developer|entwickler|engineer)\b|\bfullstack\s+developer\b|\bpraktikum\s+im\s+bereich\b')}
OR ({has(_LEAD, r'\bsoftware\s+entwickler\b')} AND NOT {has(_LEAD, r'\bsoftware\s+entwickler\b[\s\S]{0,80}\bausbildung\b')}) OR ({has(_LEAD, r'\bbefristet\b')} AND NOT {has(_LEAD, r'\bbefristet\b[\s\S]{0,60}\bausbildung\b')}))"""
_SAYS, _TEACHES = has(_T, r"\bausbildung\b"), has(_LEAD, r"\bausbildung\b")
_EXEMPT = rf"({_SAYS} AND NOT {has(_T, rf'^\s*{_WORDS}\b')} AND (({_HOURS} AND {_TEACHES}) OR NOT {has(_T, rf'\b{_WORDS}\b')}))"
_SKIPPED = rf"(NOT {_EXEMPT} AND ({has(_T, rf'^\s*{_WORDS}\b')} OR ({has(_LEAD, rf'\b{_WORDS}\b')} AND NOT {_SAYS}) OR {_JOBS} OR ({_HOURS} AND NOT {_TEACHES})))"
_BY_TEXT = " ".join(f"WHEN {has(_ALL, p)} THEN '{k}'" for k, p in (("dpa", r"daten.{0,40}prozess|prozess.{0,40}daten|daten-\s*und\s*prozessanalyse|\bdpa\b"), ("ae", r"anwendungs[\s-]?entwicklung"), ("si", "systemintegration"), ("dv", r"digitale\s+vernetzung")))
_BY_CATEGORY = "WHEN ends_with(category_id, '_dpa') THEN 'dpa' WHEN ends_with(category_id, '_ae') OR ends_with(category_id, '_ae_2026') THEN 'ae' WHEN ends_with(category_id, '_si') THEN 'si' WHEN ends_with(category_id, '_dv') THEN 'dv'"
_TYPE = rf"""CASE WHEN {_SKIPPED} THEN 'skip' WHEN contains(lower({_T}), 'duales studium') OR {has(_LEAD, r'duales?\s+studium|dual\s+studier|verbundstudium|ausbildung\s*\+\s*b\.?\s*sc|ausbildung\s*\+\s*bachelor')} THEN 'dual'
WHEN NOT {has(_ALL, r'fachinformatiker(?:in|/|-)?|fachinformatik\b')} AND NOT contains(category_id, 'fachinformatiker') THEN 'non_fi' {_BY_TEXT} {_BY_CATEGORY} ELSE 'fi_other' END"""


@register(f"WITH {LISTINGS} SELECT ordinal, {_TYPE} AS job_type, {_TYPE} IN ('ae', 'dpa', 'si', 'dv') AS is_target FROM l")
def listing_types(spark, sf_dir):
    """The type of each listing, from its whole title, description and category."""
    kind = classify.job_type(F.col("jenis_ausbildung"), F.col("detail_deskripsi"), F.col("category_id"), parity=False)
    return listings(spark, sf_dir).select("ordinal", kind.alias("job_type")).withColumn("is_target", classify.target(F.col("job_type")))


_FILLED = " + ".join(f"({strip(c)} <> '')::INT" for c in SCORE_FIELDS)
_ENRICHED = f"""e1 AS (SELECT * REPLACE (CASE WHEN link_bewerbung_externe <> '' THEN link_bewerbung_externe WHEN link_bewerbung <> '' AND {strip('link_bewerbung')} <> {strip('ba_job_url')} AND NOT {marks('link_bewerbung', PORTAL_MARKERS)} THEN link_bewerbung ELSE '' END AS link_bewerbung_externe) FROM l),
e2 AS (SELECT * REPLACE (CASE WHEN {strip('link_bewerbung_externe')} <> '' THEN {strip('link_bewerbung_externe')} WHEN {strip('ba_job_url')} <> '' THEN {strip('ba_job_url')} ELSE '' END AS link_bewerbung_efektif) FROM e1),
e3 AS (SELECT * REPLACE (link_bewerbung_efektif AS link_bewerbung, CASE WHEN {strip('link_bewerbung_externe')} <> '' THEN 'externe' WHEN link_bewerbung_efektif <> '' THEN 'ba_portal' ELSE 'none' END AS bewerbung_sumber, {site_type('link_website_perusahaan')} AS website_type) FROM e2),
e AS (SELECT * REPLACE (CASE WHEN website_type = 'company' THEN {strip('link_website_perusahaan')} ELSE '' END AS link_website_perusahaan_resmi, round(({_FILLED}) * 100 / 15)::INT AS kelengkapan_score, {_TYPE} AS beruf_typ,
CASE WHEN regexp_matches({strip('kontak_penanggung_jawab')}, '^\\d{{1,2}}\\.\\d{{1,2}}\\.(20\\d{{2}})$') THEN '' ELSE kontak_penanggung_jawab END AS kontak_penanggung_jawab) FROM e3)"""
_SHOWN = "ordinal, link_bewerbung, link_bewerbung_externe, link_bewerbung_efektif, bewerbung_sumber, website_type, link_website_perusahaan_resmi, kelengkapan_score, beruf_typ, kontak_penanggung_jawab"


@register(f"WITH {LISTINGS}, {_ENRICHED} SELECT {_SHOWN} FROM e")
def listing_enriched(spark, sf_dir):
    """The derived columns of every listing."""
    return enrich.enrich(listings(spark, sf_dir)).select(*_SHOWN.split(", "))


_WORKFLOW = f"""w AS (SELECT *, CASE WHEN {strip('alamat_email_bewerbung')} <> '' THEN 'email' WHEN link_bewerbung_efektif <> '' THEN CASE WHEN {marks('link_bewerbung_efektif', PORTAL_MARKERS)} THEN 'ba_portal' ELSE 'portal' END WHEN {strip('ba_job_url')} <> '' THEN 'ba_portal' ELSE 'tidak_jelas' END AS cara_apply FROM e),
v AS (SELECT *, concat_ws(' | ', nullif({strip('nama_perusahaan')}, ''), nullif({strip("CASE WHEN jenis_ausbildung <> '' THEN jenis_ausbildung ELSE category_id END")}, ''), nullif({strip('posisi_kota')}, '')) AS ringkasan_1_baris,
CASE WHEN cara_apply = 'tidak_jelas' OR kelengkapan_score < 50 OR (cara_apply = 'ba_portal' AND {strip('alamat_email_bewerbung')} = '') THEN 'ya' ELSE 'tidak' END AS butuh_manual,
CASE WHEN {strip('alamat_email_bewerbung')} <> '' AND kelengkapan_score >= 60 THEN 'tinggi' WHEN cara_apply IN ('email', 'portal') AND kelengkapan_score >= 50 THEN 'sedang' ELSE 'rendah' END AS suggested,
EXISTS (SELECT 1 FROM labels WHERE doc_id = ordinal AND quality = 1) AS good FROM w)"""


@register(f"""WITH {LISTINGS}, {_ENRICHED}, {_WORKFLOW} SELECT ordinal, ringkasan_1_baris, cara_apply, butuh_manual, CASE WHEN good THEN 'draft' ELSE 'belum' END AS status_lamaran, suggested AS prioritas,
{strip('alamat_email_bewerbung')} <> '' AND ({strip('kontak_penanggung_jawab')} <> '' OR kelengkapan_score >= 55) AND cara_apply <> 'tidak_jelas' AS high FROM v""")
def listing_workflow(spark, sf_dir):
    """How to apply for each listing; labels stand for states that somebody has set."""
    own = enrich.enrich(listings(spark, sf_dir)).withColumn("referenznummer", F.col("ordinal").cast("string"))
    given = table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").cast("string").alias("referenznummer"), F.lit("draft").alias("status_lamaran"), F.lit(" ").alias("prioritas")).distinct()
    rows = enrich.with_workflow(own, given)
    high = materialise(enrich.high_priority(rows).select(F.col("ordinal").alias("_high")))
    return rows.join(high, F.col("ordinal") == F.col("_high"), "left").select("ordinal", "ringkasan_1_baris", "cara_apply", "butuh_manual", "status_lamaran", "prioritas", F.col("_high").isNotNull().alias("high"))


@register(f"""WITH {LISTINGS}, {_ENRICHED} SELECT count(*) AS total, count(*) FILTER ({strip('link_bewerbung_externe')} <> '') AS with_external, count(*) FILTER ({strip('ba_job_url')} <> '') AS with_portal, count(*) FILTER ({strip('alamat_email_bewerbung')} <> '') AS with_email,
count(*) FILTER (link_website_perusahaan_resmi <> '') AS with_site, count(*) FILTER ({strip('link_bewerbung_externe')} <> '' AND {strip('ba_job_url')} <> '') AS with_both FROM e""")
def listing_link_coverage(spark, sf_dir):
    """How many listings have which way to apply."""
    return audit.link_coverage(enrich.enrich(listings(spark, sf_dir)))


@register(f"WITH {LISTINGS}, {_ENRICHED} SELECT website_type, beruf_typ, count(*) AS n FROM e GROUP BY ALL")
def listing_value_counts(spark, sf_dir):
    """Listings by kind of site and type."""
    return audit.value_counts(enrich.enrich(listings(spark, sf_dir)), "website_type", "beruf_typ")


@register(f"WITH {LISTINGS}, {_ENRICHED}, {_WORKFLOW} SELECT CASE WHEN good THEN 'researched' ELSE 'pending' END AS bewerbung_status, count(*) AS n, count(*) FILTER (kontak_penanggung_jawab <> '') AS with_contact, count(*) FILTER (cara_apply = 'portal') AS portal_only FROM v GROUP BY 1")
def listing_pilot_stats(spark, sf_dir):
    """States of applications."""
    rows = enrich.with_workflow(enrich.enrich(listings(spark, sf_dir)))
    good = table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("ordinal"), F.lit("researched").alias("bewerbung_status")).distinct()
    found = rows.join(good, "ordinal", "left").select("bewerbung_status", F.struct(F.col("kontak_penanggung_jawab").alias("name"), F.lit("").alias("email")).alias("ansprechpartner"), (F.col("cara_apply") == "portal").alias("portal_only"))
    return audit.application_stats(found)


_CHOSEN = f"CASE WHEN ends_with(category_id, '_dpa') THEN {has(_ALL_T := 'lower(jenis_ausbildung || chr(32) || detail_deskripsi)', 'daten.{0,30}prozess|prozess.{0,30}daten')} OR contains({_ALL_T}, 'daten- und prozessanalyse') OR contains({_ALL_T}, 'daten und prozessanalyse') OR contains({_ALL_T}, 'daten und prozesanalyse') WHEN ends_with(category_id, '_ae') THEN NOT {has(_ALL_T, 'daten.{0,30}prozess|prozess.{0,30}daten')} AND contains({_ALL_T}, 'anwendungsentwicklung') ELSE true END"
_STRICT = f"""CASE WHEN job_type IN ('skip', 'dual', 'non_fi') THEN false WHEN ends_with(category_id, '_ae') THEN job_type NOT IN ('dpa', 'si', 'dv') WHEN ends_with(category_id, '_si') THEN job_type NOT IN ('dpa', 'ae', 'dv')
WHEN ends_with(category_id, '_dpa') THEN job_type IN ('dpa', 'fi_other') AND contains(t, 'daten') AND contains(t, 'prozes') WHEN ends_with(category_id, '_dv') THEN job_type IN ('dv', 'fi_other') AND contains(t, 'digitale vernetz') ELSE true END"""


@register(f"WITH {LISTINGS}, j AS (SELECT ordinal, category_id, {_ALL_T} AS t, {_TYPE} AS job_type, {_CHOSEN} AS by_words FROM l) SELECT ordinal, by_words, {_STRICT} AS strict FROM j")
def listing_expected(spark, sf_dir):
    """which listings fit the job that their category asks for."""
    title, text, category = (F.col(c) for c in ("jenis_ausbildung", "detail_deskripsi", "category_id"))
    return listings(spark, sf_dir).select("ordinal", classify.fits_by_words(category, title, text).alias("by_words"), classify.fits_strictly(category, title, text, parity=False).alias("strict"))
