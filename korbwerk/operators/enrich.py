"""Derived columns of listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korbwerk.functions import extract
from korbwerk.functions.classify import job_type
from korbwerk.functions.dates import date_only, start_date
from korbwerk.functions.text import blank, filled, first_filled, host, lines, ustrip
from korbwerk.schema import DETAIL_URL, PARTNER_DOMAINS, PORTAL_MARKERS, SCORE_FIELDS


def on_portal(url: Column) -> Column:
    """True for addresses of the public job portal."""
    lower = F.lower(blank(url))
    out = F.lit(False)
    for marker in PORTAL_MARKERS:
        out = out | F.contains(lower, F.lit(marker))
    return out


def on_partner(url: Column) -> Column:
    h = host(url)
    out = h.isin(*PARTNER_DOMAINS)
    for domain in PARTNER_DOMAINS:
        out = out | F.endswith(h, F.lit(f".{domain}"))
    return out


def website_type(url: Column) -> Column:
    """P4."""
    return F.when(~filled(url), "empty").when(on_portal(url), "ba_portal").when(host(url) == "", "empty").when(on_partner(url), "partner_portal").otherwise("company")


def score(fields: list[Column]) -> Column:
    """Share of filled fields in percent."""
    n = F.lit(0)
    for f in fields:
        n = n + F.when(f, 1).otherwise(0)
    return F.round(n * 100 / len(fields)).cast("int")


def enrich(listings: DataFrame, parity: bool = False) -> DataFrame:
    """P1 to P9 in their order. parity: a stored start date is lost where nothing new is found (Q4), and category parts count anywhere (Q17)."""
    have = set(listings.columns)
    df = listings.withColumns({c: F.lit(None).cast("string") for c in ("eintrittsdatum", "tanggal_mulai") if c not in have}).withColumns({c: F.lit(None).cast("int") for c in ("tahun_mulai", "bulan_mulai") if c not in have})
    link, portal = blank(F.col("link_bewerbung")), blank(F.col("ba_job_url"))
    own = (link != "") & (ustrip(link) != ustrip(portal)) & ~on_portal(link)
    df = df.withColumn("link_bewerbung_externe", F.when(blank(F.col("link_bewerbung_externe")) != "", F.col("link_bewerbung_externe")).when(own, link).otherwise(""))
    df = df.withColumn("link_bewerbung_efektif", F.when(filled(F.col("link_bewerbung_externe")), ustrip(F.col("link_bewerbung_externe"))).when(filled(portal), ustrip(portal)).otherwise(""))
    df = df.withColumn("link_bewerbung", F.col("link_bewerbung_efektif"))
    df = df.withColumn("bewerbung_sumber", F.when(filled(F.col("link_bewerbung_externe")), "externe").when(filled(F.col("link_bewerbung_efektif")), "ba_portal").otherwise("none"))
    df = df.withColumn("website_type", website_type(F.col("link_website_perusahaan")))
    df = df.withColumn("link_website_perusahaan_resmi", F.when(F.col("website_type") == "company", ustrip(F.col("link_website_perusahaan"))).otherwise(""))
    df = df.withColumn("kelengkapan_score", score([filled(F.col(c)) for c in SCORE_FIELDS]))
    df = df.withColumn("beruf_typ", job_type(F.col("jenis_ausbildung"), F.col("detail_deskripsi"), F.col("category_id"), parity))
    df = df.withColumn("ausbildung_specialization", F.col("beruf_typ"))
    df = df.withColumn("kontak_penanggung_jawab", F.when(date_only(F.col("kontak_penanggung_jawab")), "").otherwise(blank(F.col("kontak_penanggung_jawab"))))
    texts = [F.col(c) for c in ("detail_deskripsi", "deskripsi_perusahaan", "persyaratan", "apa_yang_ditawarkan", "jenis_ausbildung")]
    df = df.withColumn("_start", start_date(F.col("eintrittsdatum"), texts, F.col("category_id")))
    keep = F.col("_start").isNull() & F.lit(not parity)
    parts = {"tahun_mulai": "year", "bulan_mulai": "month", "tanggal_mulai": "date"}
    df = df.withColumns({c: F.when(keep, F.col(c)).otherwise(F.col("_start")[p]) for c, p in parts.items()})
    return df.withColumn("tanggal_mulai", blank(F.col("tanggal_mulai"))).drop("_start")


def summary(company: Column, title: Column, category: Column, city: Column) -> Column:
    """P11."""
    role = F.when(blank(title) != "", title).otherwise(category)
    return F.concat_ws(" | ", *(F.when(filled(c), ustrip(c)) for c in (company, role, city)))


def route(email: Column, effective: Column, link: Column, portal: Column) -> Column:
    """How to apply."""
    to = F.when(blank(effective) != "", effective).otherwise(blank(link))
    return F.when(filled(email), "email").when(filled(to), F.when(on_portal(to), "ba_portal").otherwise("portal")).when(filled(portal), "ba_portal").otherwise("tidak_jelas")


def manual(how: Column, points: Column, email: Column) -> Column:
    """Whether somebody must look."""
    return F.when((how == "tidak_jelas") | (F.coalesce(points, F.lit(0)) < 50) | ((how == "ba_portal") & ~filled(email)), "ya").otherwise("tidak")


def priority(how: Column, points: Column, email: Column) -> Column:
    """P14."""
    s = F.coalesce(points, F.lit(0))
    return F.when(filled(email) & (s >= 60), "tinggi").when(how.isin("email", "portal") & (s >= 50), "sedang").otherwise("rendah")


def with_workflow(listings: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Summary, route, manual, priority and status; overrides (referenznummer, status_lamaran, prioritas) win where they aren't blank."""
    email, points = F.col("alamat_email_bewerbung"), F.col("kelengkapan_score")
    df = listings.withColumn("ringkasan_1_baris", summary(F.col("nama_perusahaan"), F.col("jenis_ausbildung"), F.col("category_id"), F.col("posisi_kota")))
    df = df.withColumn("cara_apply", route(email, F.col("link_bewerbung_efektif"), F.col("link_bewerbung"), F.col("ba_job_url")))
    df = df.withColumn("butuh_manual", manual(F.col("cara_apply"), points, email)).withColumn("_suggested", priority(F.col("cara_apply"), points, email))
    if overrides is None:
        return df.withColumn("status_lamaran", F.lit("belum")).withColumn("prioritas", F.col("_suggested")).drop("_suggested")
    given = overrides.select(F.col("referenznummer").alias("_ref"), F.col("status_lamaran").alias("_status"), F.col("prioritas").alias("_priority"))
    df = df.join(given, F.col("referenznummer") == F.col("_ref"), "left")
    df = df.withColumn("status_lamaran", first_filled(F.col("_status"), F.lit("belum"))).withColumn("prioritas", first_filled(F.col("_priority"), F.col("_suggested")))
    return df.drop("_ref", "_status", "_priority", "_suggested")


def reparse(listings: DataFrame) -> DataFrame:
    """Stored listings of the public portal read again: fields out of the description, the stored degree kept, salary by text before the stored one, an external link only if it is one."""
    text, stored = F.col("detail_deskripsi"), F.col("link_bewerbung_externe")
    given = F.when(blank(stored) != "", stored).otherwise(blank(F.col("link_bewerbung")))
    portal = F.concat(F.lit(DETAIL_URL), blank(F.col("referenznummer")))
    known = F.when(blank(F.col("ba_job_url")) != "", F.col("ba_job_url")).otherwise(portal)
    external = F.when((ustrip(given) == ustrip(known)) | on_portal(given) | (blank(F.col("bewerbung_sumber")) == "ba_portal"), "").otherwise(ustrip(given))
    degree = F.coalesce(F.get(F.filter(lines(F.col("persyaratan")), lambda x: F.lower(x).rlike("abschluss|abitur")), F.lit(0)), F.lit(""))
    section = extract.requirements(text)
    parsed = listings.withColumns({
        "link_bewerbung_externe": external, "link_bewerbung": external, "persyaratan": F.when((degree != "") & ~F.contains(section, degree), F.concat_ws("\n", F.nullif(section, F.lit("")), degree)).otherwise(section),
        "gaji": first_filled(extract.salary(text), F.col("gaji")), "deskripsi_perusahaan": extract.company_description(text), "apa_yang_ditawarkan": extract.offers(text), "alamat_email_bewerbung": extract.application_email(text),
        "kontak_penanggung_jawab": extract.contact(text), "dokumen_yang_harus_dipenuhi": extract.documents(text), "ba_job_url": portal, "sumber_data": F.lit("arbeitsagentur"),
    })
    return enrich(parsed).select(*listings.columns)


def high_priority(df: DataFrame) -> DataFrame:
    """F2."""
    good = filled(F.col("kontak_penanggung_jawab")) | (F.coalesce("kelengkapan_score", F.lit(0)) >= 55)
    return df.where(filled(F.col("alamat_email_bewerbung")) & good & (F.col("cara_apply") != "tidak_jelas"))


def needs_review(df: DataFrame) -> DataFrame:
    """F3."""
    return df.where(F.col("butuh_manual") == "ya")


def bucket(points: Column) -> Column:
    """P43."""
    return F.when(points >= 75, "high").when(points >= 50, "mid").otherwise("low")


# Sources by category, for labels of old audits.
LEGACY_SOURCES = {
    "fachinformatiker_ae": "arbeitsagentur", "fachinformatiker_ae_2026": "arbeitsagentur", "fachinformatiker_dpa": "arbeitsagentur", "ausbildung_de_ae": "ausbildung_de",
    "ausbildung_de_dpa": "ausbildung_de", "meine_ausbildung_ae": "meine_ausbildung_de", "meine_ausbildung_dpa": "meine_ausbildung_de",
}


def legacy_source(source: Column, category: Column) -> Column:
    """The label that old audits give."""
    s = F.lower(ustrip(source))
    table = F.create_map(*(F.lit(x) for pair in LEGACY_SOURCES.items() for x in pair))
    by_name = F.when(F.contains(s, F.lit("meine")), "meine_ausbildung_de").when(F.contains(s, F.lit("ausbildung")) & F.contains(s, F.lit("de")), "ausbildung_de").when(s.isin("arbeitsagentur", "ba"), "arbeitsagentur")
    return F.coalesce(F.when(s != "", by_name), table[blank(category)], F.lit("unknown"))
