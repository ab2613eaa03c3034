"""Listings out of portal pages and API details (E11 to E17, E30, E41 to E45, E47; section 2.11): one function and a spec for each portal."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korbwerk.functions import extract
from korbwerk.functions.classify import skipped, title_fits
from korbwerk.functions.text import EMAIL, bind, blank, filled, first_filled, html_text, main_text, or_null, sections, strip_html, ustrip
from korbwerk.operators.enrich import enrich
from korbwerk.schema import DETAIL_URL, LISTING_COLUMNS, conform

# Words that begin the sections of a portal page, by section, in order of trial.
SECTIONS = {
    "tasks": ("das erwartet dich", "deine aufgaben", "das lernst du"),
    "requirements": ("das solltest du mitbringen", "dein profil", "voraussetzungen", "das bringst du mit"),
    "offers": ("darauf kannst du dich freuen", "das bieten wir", "wir bieten"),
    "documents": ("bewerbungsunterlagen", "unterlagen", "lebenslauf", "zeugnis"),
    "contact": ("ansprechpartner", "dein kontakt", "bei fragen"),
}
#: Five digits before a legal form are part of a company's name.
POSTCODE = r"\b\d{5}\b(?!\s+(?:(?:g?GmbH|mbH|UG|AG|KG|SE|OHG)\b|e\.\s?V\.))"
UUID = r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"


@dataclass(frozen=True)
class Portal:
    """What makes one portal's pages differ from another's."""

    source: str
    prefix: str
    domain: str
    ids: tuple[str, ...] = (UUID,)
    direct: str = "direktbewerbung"
    pay_word: str | None = None
    placeholder_salary: bool = False
    sections: dict[str, tuple[str, ...]] = field(default_factory=lambda: SECTIONS)


# Id prefixes and own domains of the portals.
PORTALS = {
    p.source: p
    for p in (
        Portal("ausbildung_de", "AD-", "ausbildung.de"), Portal("meine_ausbildung_de", "MAD-", "meine-ausbildung-in-deutschland.de"), Portal("ausbildung_nrw", "NRW-", "ausbildung.nrw"),
        Portal("ausbildungsstellen_de", "ASD-", "ausbildungsstellen.de"), Portal("ausbildungsmarkt_de", "ABM-", "ausbildungsmarkt.de"), Portal("azubi_de", "AZDE-", "azubi.de", pay_word="(?i)gehalt|verg.tung"),
        Portal("azubiyo_de", "AZUB-", "azubiyo.de"), Portal("backinjob_de", "BIJ-", "backinjob.de"), Portal("indeed_de", "INDEED-", "indeed.com", ids=("jk=([0-9a-f]{16})",)),
        Portal("karriere_suedwestfalen_de", "KSW-", "karriere-suedwestfalen.de"), Portal("meinestadt_de", "MSD-", "meinestadt.de", placeholder_salary=True), Portal("stepstone_de", "STEP-", "stepstone.de", ids=(r"--(\d+)-inline",)),
        Portal("aubi_plus_de", "AUBI-", "aubi-plus.de"), Portal("wir_sind_bund_de", "WSB-", "wir-sind-bund.de"),
    )
}


def ld_blocks(html: Column) -> Column:
    """Texts of a page's JSON-LD blocks."""
    return F.regexp_extract_all(blank(html), F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))


def ld_objects(blocks: Column) -> Column:
    """Objects of JSON texts, in order: of arrays their elements, of graphs their nodes too; text that isn't JSON is skipped."""

    def each(x: Column) -> Column:
        nodes = lambda flat: F.concat(flat, F.flatten(F.transform(flat, lambda y: F.coalesce(F.try_variant_get(y, '$["@graph"]', "array<variant>"), F.array().cast("array<variant>")))))
        return bind(F.try_parse_json(x), lambda v: bind(F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v)), nodes))

    return F.filter(F.flatten(F.transform(blocks, each)), lambda v: v.isNotNull())


def types_of(objects: Column) -> Column:
    """Arrays of the @types of objects."""
    return F.transform(objects, lambda v: F.coalesce(F.try_variant_get(v, '$["@type"]', "array<string>"), F.array(F.try_variant_get(v, '$["@type"]', "string"))))


def of_type(objects: Column, kinds: Column, *types: str) -> Column:
    """The first object whose @type is, or holds, the first of these types that there is. kinds: types_of() the objects."""
    at = lambda kind: F.array_position(F.transform(kinds, lambda each: F.array_contains(each, kind)), True).cast("int")
    return F.coalesce(*(F.get(objects, at(t) - 1) for t in types))


def pick(v: Column, *paths: str, kind: str = "string") -> Column:
    """The first path that the object has; for text, blank if there is none."""
    found = F.coalesce(*(F.try_variant_get(v, p, kind) for p in paths))
    return blank(found) if kind == "string" else found


def either(path: str) -> tuple[str, str]:
    """A path in the job's location, which is an object or a list."""
    return f"$.jobLocation.{path}", f"$.jobLocation[0].{path}"


def page_id(job: Column, url: Column, portal: Portal) -> Column:
    """Identifier, id in the URL, last part of its path."""
    in_url = [F.regexp_extract(blank(url), p, 1 if "(" in p.replace("(?i)", "") else 0) for p in portal.ids]
    return first_filled(pick(job, "$.identifier.value"), *in_url, F.regexp_extract(F.regexp_replace(blank(url), r"[?#].*$|/+$", ""), r"([^/]+)/*$", 1), url)


def anchors(html: Column) -> Column:
    """Structs of href and text of a page's links."""
    p = r"(?is)<a[^>]+href=[\"']([^\"']+)[\"'][^>]*>(.*?)</a>"
    return F.transform(F.regexp_extract_all(blank(html), F.lit(p), F.lit(0)), lambda a: F.struct(ustrip(F.regexp_extract(a, p, 1)).alias("href"), F.lower(html_text(F.regexp_extract(a, p, 2))).alias("text")))


def apply_link(found: Column, url: Column, direct_mark: Column, domain: Column) -> Column:
    """A direct application, else a link that says so (on the portal's domain first)."""
    real = F.filter(found, lambda a: (a["href"] != "") & ~F.startswith(a["href"], F.lit("#")) & (a["href"] != blank(url)))
    direct = F.filter(real, lambda a: F.contains(a["href"], direct_mark))
    said = F.filter(real, lambda a: a["text"].rlike("bewerben|apply"))
    own = F.filter(said, lambda a: F.contains(a["href"], domain))
    return F.coalesce(F.get(direct, F.lit(0))["href"], F.get(own, F.lit(0))["href"], F.get(said, F.lit(0))["href"], F.lit(""))


def page_email(found: Column, texts: list[Column], domain: Column) -> Column:
    """A mailto link, else an address in the texts; never one of the portal."""
    mails = F.transform(F.filter(found, lambda a: F.startswith(a["href"], F.lit("mailto:"))), lambda a: ustrip(F.try_url_decode(F.regexp_extract(a["href"], r"^mailto:([^?]*)", 1))))
    foreign = lambda e: (blank(e) != "") & ~F.contains(F.lower(e), domain)
    # the pattern is slow in long words
    in_texts = F.array(*(F.when(F.contains(t, F.lit("@")), F.regexp_extract(t, EMAIL, 0)) for t in texts))
    return F.coalesce(F.get(F.filter(mails, foreign), F.lit(0)), F.get(F.filter(in_texts, foreign), F.lit(0)), F.lit(""))


def parse_pages(pages: DataFrame, portal: Portal, keep_all: bool = False) -> DataFrame:
    """2.11, E47: listings of a portal's pages (url, html, category_id), enriched. Pages of anything but apprenticeships are dropped (F4, F6) unless `keep_all`."""
    df = pages.select(F.col("url"), F.col("html"), F.coalesce("category_id", F.lit("")).alias("category_id"), main_text(F.col("html")).alias("main"), ld_objects(ld_blocks(F.col("html"))).alias("objects"), anchors(F.col("html")).alias("anchors"))
    df = df.withColumn("kinds", types_of(F.col("objects"))).withColumns({"job": of_type(F.col("objects"), F.col("kinds"), "JobPosting"), "firm": of_type(F.col("objects"), F.col("kinds"), "Corporation", "Organization")})
    job, main = F.col("job"), F.col("main")
    df = df.withColumn("body", strip_html(pick(job, "$.description")))
    df = df.withColumn("parts", sections(F.when(F.col("body") != "", F.col("body")).otherwise(main), portal.sections))
    part = {k: blank(F.col("parts")[k]) for k in portal.sections}
    title = html_text(pick(job, "$.title"))
    composed = F.concat_ws("\n\n", *(or_null(x) for x in (title, part["tasks"], part["requirements"], part["offers"])))
    if not keep_all:
        lead = F.lower(F.concat_ws(" ", title, F.substring(first_filled(F.col("body"), main), 1, 1200)))
        df = df.where(~skipped(lead, title))
    money = [pick(job, f"$.baseSalary.{v}", f"$.baseSalary.value.{v}", kind="double") for v in ("minValue", "maxValue")]
    listings = df.select(
        F.concat(F.lit(portal.prefix), page_id(job, F.col("url"), portal)).alias("referenznummer"), "category_id",
        first_filled(pick(F.col("firm"), "$.name"), pick(job, "$.hiringOrganization.name"), extract.company_line(main)).alias("nama_perusahaan"),
        extract.coordinates(pick(job, *either("geo.latitude"), kind="double"), pick(job, *either("geo.longitude"), kind="double")).alias("titik_data_di_peta"),
        first_filled(pick(job, *either("address.addressLocality")), extract.city_line(main)).alias("posisi_kota"),
        first_filled(extract.address(pick(job, *either("address.streetAddress")), F.lit(""), pick(job, *either("address.postalCode")), pick(job, *either("address.addressLocality"))), extract.first_line(main, POSTCODE)).alias("alamat_detail"),
        first_filled(composed, main).alias("detail_deskripsi"), extract.portal_salary(main, part["offers"], *money, F.try_variant_get(job, "$.baseSalary.currency", "string"), portal.pay_word, portal.placeholder_salary).alias("gaji"),
        part["requirements"].alias("persyaratan"), F.when(title != "", F.concat(F.lit("Ausbildung | "), ustrip(F.replace(title, F.lit("Ausbildung "), F.lit(""))))).otherwise("").alias("jenis_ausbildung"),
        part["offers"].alias("apa_yang_ditawarkan"), first_filled(pick(F.col("firm"), "$.url", "$.sameAs", "$.sameAs[0]"), pick(job, "$.hiringOrganization.sameAs", "$.hiringOrganization.url")).alias("link_website_perusahaan"),
        page_email(F.col("anchors"), [F.col("body"), main], F.lit(portal.domain)).alias("alamat_email_bewerbung"), apply_link(F.col("anchors"), F.col("url"), F.lit(portal.direct), F.lit(portal.domain)).alias("link_bewerbung"),
        first_filled(part["contact"], extract.first_line(main, "(?i)ansprechpartner|dein kontakt")).alias("kontak_penanggung_jawab"),
        first_filled(part["documents"], extract.from_line(main, extract.any_of(portal.sections["documents"]))).alias("dokumen_yang_harus_dipenuhi"),
        F.lit(portal.source).alias("sumber_data"), F.col("url").alias("ausbildung_de_url"), F.substring(pick(job, "$.jobStartDate", "$.startDate"), 1, 10).alias("eintrittsdatum"),
    )
    return conform(enrich(with_start(listings)))


def with_start(listings: DataFrame) -> DataFrame:
    """Conformed listings that keep the start date that was read."""
    kept = listings.withColumn("tanggal_mulai", F.col("eintrittsdatum"))
    return conform(kept).withColumn("eintrittsdatum", F.col("tanggal_mulai")).withColumn("tanggal_mulai", F.lit(""))


def parse_details(details: DataFrame) -> DataFrame:
    """2.11, P16 to P22: listings out of API details (one row each, as its JSON reads, with category_id)."""
    where, text = F.get("stellenlokationen", F.lit(0)), F.col("stellenangebotsBeschreibung")
    listings = details.select(
        F.col("referenznummer"), F.col("category_id"), F.col("firma").alias("nama_perusahaan"), extract.coordinates(where["breite"], where["laenge"]).alias("titik_data_di_peta"), where["adresse"]["ort"].alias("posisi_kota"),
        extract.address(where["adresse"]["strasse"], where["adresse"]["hausnummer"], where["adresse"]["plz"], where["adresse"]["ort"]).alias("alamat_detail"), text.alias("detail_deskripsi"),
        first_filled(extract.yearly_salary([F.col(f"ausbildungsverguetungJahr{i}") for i in (1, 2, 3)], F.col("verguetungsangabe")), extract.salary(text)).alias("gaji"),
        extract.requirement_lines(text, F.col("geforderterBildungsabschluss")).alias("persyaratan"), extract.job_title(F.col("ausbildungsart"), F.col("hauptberuf"), F.col("alleBerufe")).alias("jenis_ausbildung"),
        extract.company_description(text).alias("deskripsi_perusahaan"), extract.offers(text).alias("apa_yang_ditawarkan"), extract.website(F.col("allianzpartnerUrl")).alias("link_website_perusahaan"), extract.application_email(text).alias("alamat_email_bewerbung"), F.col("externeURL").alias("link_bewerbung"),
        extract.contact(text).alias("kontak_penanggung_jawab"), extract.documents(text).alias("dokumen_yang_harus_dipenuhi"), F.concat(F.lit(DETAIL_URL), "referenznummer").alias("ba_job_url"), F.lit("arbeitsagentur").alias("sumber_data"), F.col("eintrittsdatum"),
    )
    return conform(enrich(with_start(listings)))


def search_cards(pages: DataFrame, block: str, fields: dict[str, str]) -> DataFrame:
    """One row for each block of a result page that a pattern finds, with a field for each pattern's first group."""
    cards = pages.select("url", F.explode(F.regexp_extract_all(blank(F.col("html")), F.lit(block), F.lit(0))).alias("card"))
    return cards.select("url", *(html_text(F.regexp_extract("card", p, 1)).alias(k) for k, p in fields.items()))


def company_tree(rows: DataFrame) -> DataFrame:
    """1.1: one row for each apprenticeship of each company, with the first address there is."""
    each = rows.select(F.col("id").alias("company_id"), "name", "address", F.explode("apprenticeships").alias("a"))
    place = F.coalesce(F.get("a.addresses", F.lit(0)), F.col("address"))
    return each.select("company_id", F.col("name").alias("nama_perusahaan"), F.col("a.id").alias("apprenticeship_id"), F.col("a.apprenticeship.name").alias("jenis_ausbildung"), place["city"].alias("posisi_kota"), extract.address(place["street"], F.lit(""), place["zip"], place["city"]).alias("alamat_detail"))


def detail_or_card(cards: DataFrame, details: DataFrame, key: str, portal: Portal) -> DataFrame:
    """A listing for each card (or stub) of a search: its detail where there is one, blanks filled from the card, else the card alone; id and source are the portal's.

    cards: `key`, `id` and any canonical columns; details: `key` (at most one row for each) and listings.
    """
    side = details.select(F.col(key).alias("_key"), F.lit(True).alias("_found"), *(F.col(c).alias(f"_detail_{c}") for c in LISTING_COLUMNS if c in details.columns))
    joined = cards.join(side, F.col(key) == F.col("_key"), "left")
    out = {}
    for c in LISTING_COLUMNS:
        own, detail = c in cards.columns, c in details.columns
        if own or detail:
            card = F.col(c) if own else F.lit(None)
            out[c] = F.when(filled(F.col(f"_detail_{c}").cast("string")), F.col(f"_detail_{c}")).otherwise(card) if detail else card
    rows = joined.select("id", *(v.alias(k) for k, v in out.items()))
    named = rows.withColumns({"referenznummer": F.concat(F.lit(portal.prefix), F.col("id").cast("string")), "sumber_data": F.lit(portal.source)})
    return conform(enrich(conform(named)))


def card_hint(html: Column, href: Column) -> Column:
    """F8: the text within 400 characters around a link's first place, 240 characters at most; blank if it isn't there."""
    at = F.call_function("locate", href, blank(html))
    begin = F.greatest(at - 400, F.lit(1))
    around = F.substring(blank(html), begin, at - begin + 400)
    text = F.trim(F.regexp_replace(F.regexp_replace(around, "(?s)<[^>]+>", " "), r"\s+", " "))
    return F.when(at > 0, F.substring(text, 1, 240)).otherwise("")


# Ids that pages show as placeholders.
PLACEHOLDERS = ("abcdef0123456789", "789abcdef0123456", "123456789abcdef0", "456789abcdef0123", "0123456789abcdef", "fedcba9876543210")


def real_key(c: Column) -> Column:
    """an id of 16 hexadecimal digits that isn't a placeholder."""
    return blank(c).rlike("^[a-f0-9]{16}$") & ~blank(c).isin(*PLACEHOLDERS)


def fitting_stubs(stubs: DataFrame, kind: str | None) -> tuple[DataFrame, DataFrame]:
    """stubs whose title fits, and one row with the number of those dropped."""
    if not kind:
        return stubs, stubs.limit(0).agg(F.count("*").alias("dropped"))
    fits = F.coalesce(title_fits(F.col("title"), kind), F.lit(False))
    return stubs.where(fits), stubs.agg(F.count_if(~fits).alias("dropped"))
