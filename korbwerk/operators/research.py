"""Research fragments and application documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korbwerk.functions.extract import contact_person, culture, industry, motto, projects
from korbwerk.functions.text import blank, clean_email, email_domain, filled, first_filled, html_description, html_title, or_null, url_key, urls, ustrip
from korbwerk.operators.audit import contact_gaps
from korbwerk.operators.enrich import on_partner, on_portal, website_type
from korbwerk.operators.merge import upsert_state

# States of an application, mail hosts that are nobody's site.
STATES = ("pending", "researched", "draft_ready", "previewed", "sent", "replied_accepted", "replied_rejected")
FREE_MAIL = ("gmail.com", "yahoo.com", "hotmail.com", "outlook.com")


def state(c: Column) -> Column:
    """P40."""
    return F.when(c.isin(*STATES), c).otherwise("pending")


def company_site(official: Column, site: Column, email: Column) -> Column:
    """The official site, a site of a company, the mail's domain."""
    own = [F.when(filled(u) & ~on_portal(u) & (website_type(u) == "company"), ustrip(u)) for u in (official, site)]
    domain = email_domain(clean_email(blank(email)))
    return F.coalesce(*own, F.when((domain != "") & ~domain.isin(*FREE_MAIL), F.concat(F.lit("https://www."), domain)), F.lit(""))


def portal_only(how: Column, email: Column, text: Column) -> Column:
    """A, or B and C."""
    t = F.lower(blank(text))
    return ((how == "portal") & ~filled(email)) | (F.contains(t, F.lit("bewirb dich")) & F.contains(t, F.lit("online")))


def action_link(links: list[Column], texts: list[Column], site: Column) -> Column:
    """The first candidate that is neither the site nor on the public portal or a partner board."""
    found = F.concat(F.array(*(or_null(x) for x in links)), *(urls(t) for t in texts))
    good = F.filter(found, lambda u: u.isNotNull() & ~on_portal(u) & ~on_partner(u) & (url_key(u) != url_key(site)))
    return F.coalesce(F.get(good, F.lit(0)), F.lit(""))


def fragments(listings: DataFrame, sites: DataFrame, residence: str = "") -> DataFrame:
    """Research structs. listings: with with_workflow(); sites: url and html of fetched pages, at most one row for each url."""
    listing = listings.withColumn("_site", company_site(F.col("link_website_perusahaan_resmi"), F.col("link_website_perusahaan"), F.col("alamat_email_bewerbung")))
    page = sites.select(F.col("url").alias("_url"), html_title(F.col("html")).alias("_title"), html_description(F.col("html")).alias("_about"))
    joined = listing.join(page, F.col("_site") == F.col("_url"), "left")
    texts = [F.col(c) for c in ("detail_deskripsi", "kontak_penanggung_jawab", "deskripsi_perusahaan", "dokumen_yang_harus_dipenuhi")]
    joined = joined.withColumn("ansprechpartner", contact_person(texts, F.col("alamat_email_bewerbung"), F.col("kontak_penanggung_jawab")))
    p = F.col("ansprechpartner")
    joined = joined.withColumn("kontakt_luecken", contact_gaps(F.col("kontak_penanggung_jawab"), F.col("alamat_email_bewerbung"), F.lit(""), p["name"], p["email"], p["telefon"]))
    place, home = F.col("posisi_kota"), F.lit(residence)
    relevance = F.concat(blank(F.col("nama_perusahaan")), F.lit(" bietet eine Ausbildung in Anwendungsentwicklung. Wohnort "), home, F.lit(". Standort "), blank(place), F.lit("."))
    about = F.struct(
        industry(F.col("detail_deskripsi")).alias("branche"), culture(F.col("deskripsi_perusahaan"), F.col("apa_yang_ditawarkan"), place).alias("kultur"), motto(F.col("detail_deskripsi")).alias("motto"), projects(F.col("detail_deskripsi")).alias("projekte"),
        F.substring(relevance, 1, 600).alias("relevanz_profil"), first_filled(F.col("_about"), F.col("_title")).alias("website_insights"), F.col("_site").alias("website"),
    )
    return joined.withColumn("firmen_recherche", about).withColumn("portal_only", portal_only(F.col("cara_apply"), F.col("alamat_email_bewerbung"), F.col("detail_deskripsi"))).drop("_site", "_url", "_title", "_about")


# What stands before each part of a research record in its companion.
COMPANION = {"branche": ("Bidang: ", None), "kultur": ("Budaya perusahaan berdasarkan deskripsi lowongan: ", 400), "motto": ("", None), "projekte": ("Proyek/fokus kerja: ", 400), "website_insights": ("", None), "relevanz_profil": ("Relevansi: ", 400)}


def companion(record: Column) -> Column:
    """D3: the structured companion of a research struct: its parts, cut and introduced in the second language."""
    return F.struct(*(F.concat(F.lit(lead), F.substring(blank(record[k]), 1, most) if most else blank(record[k])).alias(k) for k, (lead, most) in COMPANION.items()))


def start_hint(year: Column, month: Column) -> Column:
    """P38."""
    return F.when(year.isNotNull() & month.isNotNull(), F.format_string("%02d.%d", month, year)).when(year.isNotNull(), year.cast("string")).otherwise("nächstmöglichen Zeitpunkt")


def greeting(title: Column, name: Column) -> Column:
    """P39."""
    return F.when(filled(name) & (title == "Frau"), F.concat(F.lit("Sehr geehrte Frau "), name)).when(filled(name) & (title == "Herr"), F.concat(F.lit("Sehr geehrter Herr "), name)).otherwise("Sehr geehrte Damen und Herren")


def documents(rows: DataFrame, templates: dict[str, str], profile: DataFrame) -> DataFrame:
    """Each template with {field} filled from the row and the profile (one row; missing profile: an error, so nothing is sent unsigned), and the state moved on."""
    if profile.limit(2).count() != 1:
        raise ValueError("the profile needs exactly one row")
    own = profile.select(*(F.col(c).alias(f"profile_{c}") for c in profile.columns))
    df = rows.crossJoin(F.broadcast(own))  # one row
    names = [c for c, t in df.dtypes if t in ("string", "int", "bigint")]

    def render(template: str) -> Column:
        out = F.lit(template)
        for n in names:
            if f"{{{n}}}" in template:
                out = F.replace(out, F.lit(f"{{{n}}}"), blank(F.col(n).cast("string")))
        return out

    ready = F.when(F.col("bewerbung_status").isin("pending", "researched"), "draft_ready").otherwise(F.col("bewerbung_status"))
    return df.withColumn("bewerbung_docs", F.struct(*(render(t).alias(k) for k, t in templates.items()))).withColumn("bewerbung_status", ready).drop(*own.columns)


def process(stored: DataFrame, listings: DataFrame, sites: DataFrame, templates: dict[str, str], profile: DataFrame) -> DataFrame:
    """Listings that aren't done are researched and documented, and merged into the store."""
    todo = listings.join(stored.where(F.col("bewerbung_status").isin("researched", "draft_ready")).select("referenznummer"), "referenznummer", "left_anti")
    fresh = documents(fragments(todo, sites).withColumn("bewerbung_status", F.lit("researched")), templates, profile)
    return upsert_state(stored, fresh.select(*[c for c in stored.columns if c in fresh.columns]), "referenznummer", ["sent_at", "reply_at"] if {"sent_at", "reply_at"} <= set(stored.columns) else [])
