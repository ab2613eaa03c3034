"""Pages of each portal by that portal's own rules (F4, F5, F18, E15, E34 to E41, E46, E47; section 2.11). `portals.parse_pages` reads what any portal may hold; `parse_by_rules` gives what the portal's own rules find and leaves the rest blank."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korbwerk.functions import extract
from korbwerk.functions.classify import fits_by_words, fits_strictly, skipped
from korbwerk.functions.text import bind, blank, first_filled, fold, holds_any, main_text, normalise_space, or_null, or_null_once, sections, strip_html, ustrip
from korbwerk.operators.enrich import enrich
from korbwerk.schema import conform
from korbwerk.sources.portals import SECTIONS, UUID, anchors, apply_link, either, ld_blocks, ld_objects, of_type, page_email, pick, types_of, with_start

# Words that begin the sections of portal pages, by section, in order of trial.
CONTACT = ("ansprechpartner", "dein kontakt", "kontakt")
PROFILE = ("das zeichnet dich aus", "das solltest du mitbringen", "dein profil", "voraussetzungen", "das bringst du mit")
BENEFITS = ("deine vorteile", "deine benefits", "darauf kannst du dich freuen", "das bieten wir", "wir bieten")
AZUBI_SECTIONS = {
    "tasks": ("deine aufgaben", "das erwartet dich", "das lernst du", "dein einstieg"), "requirements": ("einleitung", *PROFILE), "offers": ("vergütung", *BENEFITS), "documents": SECTIONS["documents"], "contact": CONTACT,
}
INDEED_SECTIONS = {
    "tasks": ("deine perspektive", "das erwartet dich", "deine aufgaben", "das lernst du", "dein einstieg", "aufgaben", "stellenbeschreibung"), "requirements": (*PROFILE, "anforderungen", "qualifikation"),
    "offers": (*BENEFITS, "benefits", "leistungen"), "documents": SECTIONS["documents"], "contact": CONTACT,
}
STEPSTONE_SECTIONS = {
    "tasks": ("deine perspektive", "das erwartet dich", "deine aufgaben", "das lernst du", "dein einstieg", "aufgaben"), "requirements": (*PROFILE, "anforderungen"), "offers": (*BENEFITS, "benefits"), "documents": SECTIONS["documents"], "contact": CONTACT,
}
STELLEN_SECTIONS = {
    "tasks": ("hier sorgst du", "das erwartet dich", "deine aufgaben", "das lernst du", "dein einstieg", "aufgaben:"), "requirements": ("hiermit bringst du", *PROFILE), "offers": ("was wir für dich", *BENEFITS),
    "documents": SECTIONS["documents"], "contact": (*CONTACT, "bewerbungsadresse"),
}
MEINESTADT_SECTIONS = {
    "tasks": ("das wird dein job", "das erwartet dich", "deine aufgaben", "das lernst du", "dein einstieg", "aufgaben:", "stellenbeschreibung"),
    "requirements": ("das bringst du mit", "das solltest du mitbringen", "dein profil", "voraussetzungen", "gewünschte fähigkeiten", "persönliche fähigkeiten"),
    "offers": ("darum lohnt es sich", "deine vorteile", "deine benefits", "unsere leistungen", "das bieten wir", "wir bieten"), "contact": ("kontakt", "ansprechpartner", "dein kontakt"),
}
GROUP_LINE = "GmbH| AG| KG| SE|Group"
# Where texts state the start of an apprenticeship.
BEGIN_DAY = r"(?iu)Ausbildungsbeginn[:\s]+(\d{1,2}\.\d{1,2}\.20(?:26|27))"
BEGIN_ISO = r"(?iu)Ausbildungsbeginn[^:]*:\s*(\d{1,2}\.\d{1,2}\.\d{4}|\d{4}-\d{2}-\d{2})"
ANY_DAY = r"(\d{1,2}\.\d{1,2}\.20(?:26|27))"


@dataclass(frozen=True)
class Rules:
    """What makes one portal's pages differ from another's.

    ids: patterns of ids in addresses, looked for before the identifier of the structured data if `address_first`. direct: what the address of a direct application holds. pay_word, pay_block, pay_years, pay_amount, pay_body, placeholder_salary: as
    portal_salary() takes them. sections: words that begin them. employers: whether the page's organization counts beside the job's employer. company: pattern of a line with a company's name. any_site: the employer's site counts whatever it is, not only
    foreign ones that begin with http. mail_in_main, line_address, geo: whether the main text is searched for an address to write to, a line with a postcode stands for a missing address, coordinates are read. plain_title: a title that begins with the
    word isn't given it again. contact: a line of the main text, `contact_lines` after it. named_documents: the documents that texts name, instead of the text from the first that does.
    start_keys: dates of the structured data (`start_cut`: their first ten characters), then of start_texts (patterns of main text, body and title), as ISO dates if `start_iso`. fits: the filter of pages: "skip" (F4), "words" (F18), "strict" (F4 and F5), or none.
    """

    source: str
    prefix: str
    domain: str
    ids: tuple[str, ...] = (UUID,)
    address_first: bool = False
    direct: str = "direktbewerbung"
    pay_word: str | None = None
    pay_block: str | None = None
    pay_years: str | None = extract.YEAR_SALARY
    pay_amount: str = extract.AMOUNT
    pay_body: bool = False
    placeholder_salary: bool = False
    sections: dict[str, tuple[str, ...]] = field(default_factory=lambda: SECTIONS)
    employers: bool = True
    company: str = extract.COMPANY_LINE
    any_site: bool = False
    mail_in_main: bool = True
    line_address: bool = False
    geo: bool = False
    plain_title: bool = False
    contact: str = "(?iu)ansprechpartner|dein kontakt"
    contact_lines: int = 0
    named_documents: bool = False
    start_keys: tuple[str, ...] = ("jobStartDate",)
    start_cut: bool = False
    start_texts: tuple[str, ...] = ()
    start_iso: bool = False
    fits: str | None = "skip"


# Rules that two portals share.
_STELLEN = {
    "sections": STELLEN_SECTIONS, "pay_word": "(?iu)vergütung", "pay_years": r"(?iu)((?:1\.|2\.|3\.|4\.)\s*(?:Ausbildungs)?jahr)\s*\n?\s*([\d.,]+\s*€)", "plain_title": True, "contact": "(?iu)ansprechpartner|dein kontakt|bewerbungsadresse", "contact_lines": 5,
    "named_documents": True, "start_keys": ("jobStartDate", "startDate"), "start_cut": True, "start_texts": (BEGIN_DAY,), "start_iso": True,
}
# Id prefixes, own domains and rules of seven portals.
RULES = {
    p.source: p
    for p in (
        Rules("ausbildung_de", "AD-", "ausbildung.de", any_site=True, mail_in_main=False, start_keys=(), fits=None), Rules("ausbildungsstellen_de", "ASD-", "ausbildungsstellen.de", **_STELLEN), Rules("ausbildungsmarkt_de", "ABM-", "ausbildungsmarkt.de", **_STELLEN),
        Rules("azubi_de", "AZDE-", "azubi.de", pay_block=r"(?iu)Vergütung[^:]*:\s*([^\n]+(?:\n[^\n]+){0,3})", pay_body=True, sections=AZUBI_SECTIONS, start_keys=("jobStartDate", "startDate"), start_texts=(BEGIN_ISO,)),
        Rules("indeed_de", "INDEED-", "indeed.com", ids=("jk=([0-9a-f]{16})",), address_first=True, sections=INDEED_SECTIONS, employers=False, company=GROUP_LINE, geo=True, placeholder_salary=True, pay_years=None, pay_amount=r"[\d.,]+\s*€(?:\s*[-–]\s*[\d.,]+\s*€)?", fits="words"),
        Rules("meinestadt_de", "MSD-", "meinestadt.de", ids=(r"[?&]id=(\d+)",), address_first=True, pay_years=None, pay_amount=r"(?i)[\d.,]+\s*€(?:\s*/\s*(?:Monat|Jahr|Stunde))?", placeholder_salary=True, sections=MEINESTADT_SECTIONS, employers=False,
            company=r"GmbH| AG| KG| SE| e\.V", line_address=True, plain_title=True, contact="(?iu)ansprechpartner|kontakt|personalabteilung", contact_lines=7, named_documents=True, start_keys=("jobStartDate", "startDate"), start_cut=True, start_texts=(ANY_DAY,), start_iso=True, fits="strict"),
        Rules("stepstone_de", "STEP-", "stepstone.de", ids=(r"--(\d+)-inline",), sections=STEPSTONE_SECTIONS, company=GROUP_LINE, mail_in_main=False, geo=True, pay_word="(?iu)gehalt|vergütung", pay_years=None),
    )
}


def by_rules(portals: Sequence[Rules], names: str, use: Callable[..., Column]) -> Column:
    """use(values of these rules) of the portal that a row's `source` names. Portals with the same values share one expression, and only the row's own is computed."""
    groups: dict[str, tuple[list, list[str]]] = {}
    for p in portals:
        values = [getattr(p, n) for n in names.split()]
        groups.setdefault(repr(values), (values, []))[1].append(p.source)
    each = [(use(*values), sources) for values, sources in groups.values()]
    return each[0][0] if len(each) == 1 else F.coalesce(*(F.when(F.col("source").isin(*sources), c) for c, sources in each))


def page_id(job: Column, url: Column, ids: tuple[str, ...], address_first: bool) -> Column:
    """Identifier and id in the URL, in the portal's order, then the last part of its path."""
    in_url = [F.regexp_extract(blank(url), p, 1 if "(" in p.replace("(?i)", "") else 0) for p in ids]
    given = [pick(job, "$.identifier.value")]
    return first_filled(*(in_url + given if address_first else given + in_url), F.regexp_extract(F.regexp_replace(blank(url), r"[?#].*$|/+$", ""), r"([^/]+)/*$", 1), url)


def employer_site(job: Column, firm: Column, domain: Column, employers: bool, any_site: bool) -> Column:
    """The site of the job's employer, then of the page's organization, a string or a list; the portal's own pages and what isn't an address don't count, unless any site does."""
    owners = [(job, "$.hiringOrganization.sameAs"), (job, "$.hiringOrganization.url"), *([(firm, "$.url"), (firm, "$.sameAs")] if employers else [])]
    if any_site:
        return first_filled(*(pick(v, p) for v, p in owners))
    good = lambda u: F.startswith(u, F.lit("http")) & ~F.contains(u, domain)
    found = [F.get(F.filter(F.coalesce(F.try_variant_get(v, p, "array<string>"), F.array(pick(v, p))), good), F.lit(0)) for v, p in owners]
    return ustrip(F.coalesce(*(or_null_once(x) for x in found)))


def start_of_page(job: Column, main: Column, body: Column, title: Column, start_keys: tuple[str, ...], start_cut: bool, start_texts: tuple[str, ...], start_iso: bool) -> Column:
    """Dates of the structured data, then those that texts state."""
    given = first_filled(*(ustrip(pick(job, f"$.{k}")) for k in start_keys)) if start_keys else F.lit("")
    stated = F.coalesce(*(or_null_once(F.regexp_extract(t, p, 1)) for t in (main, body, title) for p in start_texts), F.lit(""))
    if start_iso:
        day = r"^(\d{1,2})\.(\d{1,2})\.(20\d{2})$"
        iso = lambda t: F.when(t.rlike(day), F.format_string("%s-%02d-%02d", F.regexp_extract(t, day, 3), F.regexp_extract(t, day, 2).try_cast("int"), F.regexp_extract(t, day, 1).try_cast("int"))).otherwise(t)
        stated = bind(stated, iso)
    return F.coalesce(or_null(F.substring(given, 1, 10) if start_cut else given), or_null_once(stated), F.lit(""))


def page_fits(category: Column, title: Column, body: Column, main: Column, fits: str | None) -> Column:
    """the portal's filter of pages."""
    text = F.concat_ws(" ", body, main)
    wanted = ~skipped(F.lower(F.concat_ws(" ", title, F.substring(text, 1, 1200))), title)
    if fits == "words":
        return fits_by_words(category, title, text)
    return wanted & fits_strictly(category, title, text) if fits == "strict" else wanted if fits else F.lit(True)


def ruled_listings(pages: DataFrame, portals: Sequence[Rules], keep_all: bool = False) -> DataFrame:
    """Listings of portals' pages (url, html, category_id, and source if there are several portals) before they are enriched, all in one pass: a page is read once, and only by its own portal's rules. Pages that the portal's filter doesn't want (F4, F5, F18) are dropped unless `keep_all`."""

    def ruled(names: str, use: Callable[..., Column]) -> Column:
        return by_rules(portals, names, use)

    source = F.col("source") if len(portals) > 1 else F.lit(portals[0].source)
    df = pages.select(F.col("url"), source.alias("source"), F.coalesce("category_id", F.lit("")).alias("category_id"), main_text(F.col("html")).alias("main"), ld_objects(ld_blocks(F.col("html"))).alias("objects"), anchors(F.col("html")).alias("anchors"))
    objects, kinds = F.col("objects"), F.col("kinds")
    df = df.withColumn("kinds", types_of(objects)).withColumns({"job": of_type(objects, kinds, "JobPosting"), "firm": ruled("any_site", lambda any_site: of_type(objects, kinds, *(("Corporation", "Organization") if any_site else ("Organization", "Corporation"))))})
    job, firm, main, body, anchor, domain = F.col("job"), F.col("firm"), F.col("main"), F.col("body"), F.col("anchors"), ruled("domain", F.lit)
    # one expression cleans all texts of the structured data: as one for each, plans take minutes to compile
    raw = {
        "body": pick(job, "$.description"), "title": pick(job, "$.title"), "firm_name": pick(firm, "$.name"), "employer": pick(job, "$.hiringOrganization.name"),
        "about": ruled("employers", lambda employers: pick(firm, "$.description") if employers else pick(job, "$.hiringOrganization.description")),
        **{k: pick(job, *either(f"address.{k}")) for k in ("streetAddress", "postalCode", "addressLocality", "addressRegion")},
    }
    df = df.withColumn("clean", F.transform(F.array(*raw.values()), strip_html)).withColumns({k: F.get("clean", F.lit(i)) for i, k in enumerate(raw)})
    title = F.col("title")
    if not keep_all:
        df = df.where(ruled("fits", lambda fits: page_fits(F.col("category_id"), title, body, main, fits)))
    df = df.withColumn("parts", ruled("sections", lambda words: sections(F.when(body != "", body).otherwise(main), words)))
    # a section that the portal's rules don't have is null
    df = df.withColumns({f"{k}_part": blank(F.try_element_at(F.col("parts"), F.lit(k))) for k in SECTIONS})
    part = {k: F.col(f"{k}_part") for k in SECTIONS}
    df = df.withColumn("composed", first_filled(F.concat_ws("\n\n", *(or_null(x) for x in (title, part["tasks"], part["requirements"], part["offers"]))), body))
    composed, offers = F.col("composed"), part["offers"]
    money = [F.coalesce(*(pick(job, f"$.baseSalary.{at}{v}", kind="double") for at in ("value.", ""))) for v in ("minValue", "maxValue")]
    currency = F.coalesce(*(F.try_variant_get(job, f"$.baseSalary.{at}currency", "string") for at in ("value.", "")))
    place = [F.col(k) for k in ("streetAddress", "postalCode", "addressLocality", "addressRegion")]
    city = lambda line_address: F.coalesce(or_null(place[2]), or_null_once(extract.city_line(main)), F.lit("")) if line_address else place[2]
    named = lambda parts: normalise_space(F.concat_ws(" ", *(or_null(x) for x in parts)))
    whole = lambda line_address: F.coalesce(or_null_once(named(place[:3])), or_null_once(extract.first_line(main, r"\b\d{5}\b")), city(True)) if line_address else named(place)
    spoken = lambda contact, more: extract.line_block(main, contact, more) if more else normalise_space(extract.first_line(main, contact))
    papers = lambda named_documents, words: extract.named_documents(F.concat_ws("\n", composed, offers)) if named_documents else F.when(bind(fold(F.concat_ws("\n", composed, offers)), lambda t: holds_any(t, words["documents"])), F.coalesce(*(or_null_once(extract.from_line(t, extract.any_of(words["documents"]))) for t in (composed, offers)), F.lit(""))).otherwise("")
    titled = F.concat(F.lit("Ausbildung | "), ustrip(F.replace(title, F.lit("Ausbildung "), F.lit(""))))
    company = lambda employers, words: F.coalesce(*(or_null(F.col(c)) for c in (("firm_name", "employer") if employers else ("employer",))), or_null_once(extract.company_line(main, words)), F.lit(""))
    pay = lambda word, block, years, amount, in_body, placeholder: extract.portal_salary(main, offers, *money, currency, word, placeholder, years, amount, block, body if in_body else None)
    return df.select(
        F.concat(ruled("prefix", F.lit), ruled("ids address_first", lambda ids, address_first: page_id(job, F.col("url"), ids, address_first))).alias("referenznummer"), "category_id", ruled("employers company", company).alias("nama_perusahaan"),
        ruled("geo", lambda geo: extract.coordinates(pick(job, *either("geo.latitude"), kind="double"), pick(job, *either("geo.longitude"), kind="double")) if geo else F.lit("")).alias("titik_data_di_peta"),
        ruled("line_address", city).alias("posisi_kota"), ruled("line_address", whole).alias("alamat_detail"), composed.alias("detail_deskripsi"), ruled("pay_word pay_block pay_years pay_amount pay_body placeholder_salary", pay).alias("gaji"), part["requirements"].alias("persyaratan"),
        F.when(title == "", "").when(F.startswith(F.lower(title), F.lit("ausbildung")) & ruled("plain_title", F.lit), title).otherwise(titled).alias("jenis_ausbildung"), F.col("about").alias("deskripsi_perusahaan"), offers.alias("apa_yang_ditawarkan"),
        ruled("employers any_site", lambda employers, any_site: employer_site(job, firm, domain, employers, any_site)).alias("link_website_perusahaan"), ruled("mail_in_main", lambda in_main: page_email(anchor, [composed, offers, *([main] if in_main else [])], domain)).alias("alamat_email_bewerbung"),
        apply_link(anchor, F.col("url"), ruled("direct", F.lit), domain).alias("link_bewerbung"), F.coalesce(or_null(part["contact"]), or_null_once(ruled("contact contact_lines", spoken)), F.lit("")).alias("kontak_penanggung_jawab"),
        F.coalesce(or_null(part["documents"]), or_null_once(ruled("named_documents sections", papers)), F.lit("")).alias("dokumen_yang_harus_dipenuhi"), F.col("source").alias("sumber_data"), F.col("url").alias("ausbildung_de_url"),
        ruled("start_keys start_cut start_texts start_iso", lambda *rules: start_of_page(job, main, body, title, *rules)).alias("eintrittsdatum"),
    )


def parse_by_rules(pages: DataFrame, portal: Rules, keep_all: bool = False) -> DataFrame:
    """2.11, E47: listings of a portal's pages, enriched. Null pages, addresses and categories count as blank."""
    return conform(enrich(with_start(ruled_listings(pages, [portal], keep_all))))


def parse_sources(pages: DataFrame, portals: Sequence[Rules], keep_all: bool = False) -> DataFrame:
    """The same for pages of several portals (with `source`), read and enriched together: pages of other sources are left out."""
    wanted = pages.where(F.col("source").isin(*(p.source for p in portals)))
    return conform(enrich(with_start(ruled_listings(wanted, portals, keep_all))))
