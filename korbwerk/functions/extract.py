"""Fields out of free text (E5 to E10, E24 to E26, E29, E32 to E40) and formats of structured fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from korbwerk.functions.text import EMAIL, bind, blank, clean_email, distinct_by, emails, filled, first_filled, lines, normalise_space, or_null, or_null_once, phones, section, ustrip

# Words that begin a section, in lower case.
REQUIREMENTS = ("voraussetzung", "anforderung", "du verfügst", "du bringst", "das bringst du", "wir erwarten", "profil", "qualifikation", "hast du das zeug", "so hast du gute chancen", "zugangsvoraussetzung", "dein profil")
OFFERS = ("wir bieten", "das bieten", "das solltest du", "benefits", "vergütung", "gehalt", "ausbildungsvergütung", "urlaub", "weiterbildung", "was wir bieten")
DOCUMENTS = ("unterlagen", "bewerbungsunterlagen", "lebenslauf", "zeugnis", "anschreiben", "motivationsschreiben", "bescheinigungen", "sende uns", "bewirb dich", "deine bewerbung")
CONTACTS = ("ansprechpartner", "kontakt", "bei fragen", "personalabteilung", "noch fragen", "rückfragen")
# The stricter phone pattern of contact blocks, salary patterns in order of trial, patterns of sentences about documents, roles in order of trial.
CONTACT_PHONE = r"(?:\+49|0)[\s./-]?(?:\(?\d{2,5}\)?[\s./-]?)?\d[\d\s./-]{5,}\d"
SALARIES = (
    r"(?iu)(?:gehalt|vergütung|einstiegsgehalt|ausbildungsvergütung)[^.:\n]{0,50}?(\d[\d.,\s]*)\s*(?:€|eur)",
    r"(?iu)(\d{1,2}\.\s*(?:lj|jahr|lehrjahr))[^.\n]{0,30}?(\d[\d.,\s]*)\s*€",
    r"(?iu)(\d[\d.,]+)\s*€\s*(?:pro\s+monat|/monat|brutto)",
    r"(?iu)gehalt\s*\([^)]+\)[^.\n]{0,80}",
)
DOCUMENT_SENTENCES = (
    r"(?ius)(?:sende|schick|reiche).{0,60}(?:lebenslauf|zeugnis|unterlagen)[^.]{0,120}\.",
    r"(?ius)bewirb dich[^.]{0,120}(?:lebenslauf|zeugnis|unterlagen)[^.]{0,120}\.",
)
ROLES = (
    r"(?iu)Ansprechpartner(?:in)?(?:\s+für[^\n.]{0,60})?", r"(?iu)Ausbildungs(?:leiter(?:in)?|beauftragte(?:r)?)", r"(?iu)Personal(?:abteilung|referent(?:in)?)", r"(?iu)Recruiting(?:-Team)?", r"(?iu)\bHR\b",
)
YEAR_SALARY = r"(?iu)((?:1\.|2\.|3\.|4\.)\s*Jahr)\s*\n?\s*([\d.,]+\s*€)"
# Labels of school degrees.
DEGREES = {
    "ALLGEMEINE_HOCHSCHULREIFE": "Abitur / Allgemeine Hochschulreife", "MITTLERE_REIFE_MITTLERER_BILDUNGSABSCHLUSS": "Mittlere Reife / Realschulabschluss", "HAUPTSCHULABSCHLUSS": "Hauptschulabschluss",
    "OHNE_ABSCHLUSS": "Ohne Abschlussanforderung", "NICHT_RELEVANT": "Nicht angegeben",
}


def any_of(words: tuple[str, ...]) -> str:
    """A pattern that finds one of the words, in any case."""
    return "(?iu)" + "|".join(rf"\Q{w}\E" for w in words)


def first_match(c: Column, patterns: tuple[str, ...]) -> Column:
    """The first pattern's match that isn't blank."""
    return first_filled(*(ustrip(F.regexp_extract(blank(c), p, 0)) for p in patterns))


def requirements(c: Column) -> Column:
    """E5."""
    return section(c, any_of(REQUIREMENTS), 12)


def offers(c: Column) -> Column:
    """E5."""
    return section(c, any_of(OFFERS), 12)


def documents(c: Column) -> Column:
    """The section, else a sentence."""
    return first_filled(section(c, any_of(DOCUMENTS), 8), first_match(c, DOCUMENT_SENTENCES))


def contact(c: Column) -> Column:
    """Lines from the first that names a contact; ends at a blank line, with a line that holds an address or a number, or after three lines; else the first number."""
    marker, reach = any_of(CONTACTS), rf"{EMAIL}|{CONTACT_PHONE}"
    start = F.struct(F.lit(False).alias("on"), F.lit(False).alias("done"), F.array().cast("array<string>").alias("kept"))

    def step(a: Column, raw: Column) -> Column:
        line = ustrip(raw)
        hit = line.rlike(marker)
        inside = a["on"] & ~hit
        stop = inside & ((line == "") | line.rlike(reach) | (F.size(a["kept"]) >= 3))
        take = ~a["done"] & (hit | (inside & (line != "") & (line.rlike(reach) | (F.size(a["kept"]) < 3))))
        return F.struct((a["on"] | hit).alias("on"), (a["done"] | stop).alias("done"), F.when(take, F.concat(a["kept"], F.array(line))).otherwise(a["kept"]).alias("kept"))

    block = F.array_join(F.aggregate(lines(c), start, step, lambda a: a["kept"]), "\n")
    return first_filled(block, F.regexp_extract(blank(c), CONTACT_PHONE, 0))


def application_email(c: Column) -> Column:
    """The first address with a word about jobs within 40 characters of its first place, else the first."""
    t = blank(c)
    found = F.regexp_extract_all(t, F.lit(EMAIL), F.lit(0))

    def near(e: Column) -> Column:
        at = F.call_function("locate", F.lower(e), F.lower(t))
        begin = F.greatest(at - 40, F.lit(1))
        return F.lower(F.substring(t, begin, at - begin + F.length(e) + 40)).rlike("bewerb|karriere|job|ausbildung|hr")

    return F.coalesce(F.get(F.filter(found, near), F.lit(0)), F.get(found, F.lit(0)), F.lit(""))


# An amount, what a company's name holds, documents that portals name.
AMOUNT = r"[\d.,]+\s*€"
COMPANY_LINE = "GmbH| AG| KG| SE"
NAMED_DOCUMENTS = ("lebenslauf", "zeugnis", "anschreiben", "bewerbungsunterlagen")


def salary(c: Column) -> Column:
    """E10."""
    return first_match(c, SALARIES)


def portal_salary(main: Column, offer: Column, low: Column, high: Column, currency: Column, pay_word: str | None = None, placeholder: bool = False, years: str | None = YEAR_SALARY, amount: str = AMOUNT, block: str | None = None, body: Column | None = None) -> Column:
    """Salaries by year (pattern `years`, in main, and before it in body and offer where a body is given), else up to six amounts (of texts with `pay_word`, if given) or what `block` finds instead, else the range of structured data. placeholder: a range of 1 to 1 counts."""
    both = F.concat_ws("\n", *([or_null(body)] if body is not None else []), or_null(offer), or_null(main))
    t = both if body is not None else blank(main)
    paid = lambda names: F.array_join(F.zip_with(names, F.regexp_extract_all(t, F.lit(years), F.lit(2)), lambda a, b: F.concat(a, F.lit(": "), b)), "\n")
    yearly = bind(F.regexp_extract_all(t, F.lit(years), F.lit(1)), lambda names: F.when(F.size(names) > 0, paid(names)).otherwise("")) if years else F.lit("")
    if block:
        listed = normalise_space(F.regexp_extract(both, block, 1))
    else:
        unique = distinct_by(F.regexp_extract_all(both, F.lit(amount), F.lit(0)), lambda x: F.replace(x, F.lit(" "), F.lit("")))
        listed = F.array_join(F.slice(unique, 1, 6), ", ")
        listed = F.when(both.rlike(pay_word), listed).otherwise("") if pay_word else listed
    real = (low != 0) & (high != 0) & (F.lit(placeholder) | ~((low == 1) & (high == 1)))
    ranged = F.when(real, F.concat(low.cast("string"), F.lit(" - "), high.cast("string"), F.lit(" "), F.coalesce(currency, F.lit("EUR"))))
    return F.coalesce(or_null_once(yearly), or_null_once(listed), or_null(ranged), F.lit(""))


def salutation(c: Column) -> Column:
    """Struct of anrede and name: the first line with Frau or Herr and a name, else the first such place with one or two names."""
    t = blank(c)
    two = r"(Frau|Herr)\s+([A-ZÄÖÜ][a-zäöüß\-]+(?:\s+[A-ZÄÖÜ][a-zäöüß\-]+)?)"
    inside = r"(?m)\b(Frau|Herr)[ \t]+([A-ZÄÖÜ][a-zäöüß\-]+)"
    p = F.when(t.rlike(inside), F.struct(F.regexp_extract(t, inside, 1).alias("anrede"), F.regexp_extract(t, inside, 2).alias("name")))
    return F.coalesce(p, F.struct(F.regexp_extract(t, two, 1).alias("anrede"), F.regexp_extract(t, two, 2).alias("name")))


def role(c: Column) -> Column:
    """E25."""
    return F.substring(first_match(c, ROLES), 1, 80)


def contact_person(texts: list[Column], apply_email: Column, note: Column) -> Column:
    """Name, anrede, rolle, email (another than the application's, if there is one), telefon, beschreibung."""
    t = F.concat_ws("\n", *(blank(x) for x in texts))
    found, own = emails(t), clean_email(ustrip(apply_email))
    mail = F.coalesce(F.get(F.filter(found, lambda e: F.lower(e) != F.lower(own)), F.lit(0)), F.get(found, F.lit(0)), own)
    who = salutation(t)
    return F.struct(
        who["name"].alias("name"), who["anrede"].alias("anrede"), role(t).alias("rolle"), mail.alias("email"), F.coalesce(F.get(phones(t), F.lit(0)), F.lit("")).alias("telefon"), F.substring(blank(note), 1, 300).alias("beschreibung"),
    )


def first_line(c: Column, pattern: str, most: int | None = None) -> Column:
    """The first (of `most`) lines that fits a pattern, stripped."""
    each = F.slice(lines(c), 1, most) if most else lines(c)
    return F.coalesce(F.get(F.filter(F.transform(each, ustrip), lambda x: x.rlike(pattern)), F.lit(0)), F.lit(""))


def from_line(c: Column, pattern: str) -> Column:
    """The text from the first line that fits a pattern."""
    rest = lambda each, at: F.when(at > 0, normalise_space(F.array_join(F.slice(each, F.greatest(at, F.lit(1)), F.size(each)), "\n"))).otherwise("")
    return bind(lines(c), lambda each: bind(F.array_position(F.transform(each, lambda x: x.rlike(pattern)), True).cast("int"), lambda at: rest(each, at)))


def line_block(c: Column, pattern: str, more: int) -> Column:
    """The first line that fits a pattern, and those of the next `more` lines that aren't blank."""
    block = lambda each, at: F.when(at > 0, F.array_join(F.filter(F.slice(each, F.greatest(at, F.lit(1)), F.lit(more + 1)), lambda x: x != ""), "\n")).otherwise("")
    return bind(F.transform(lines(c), ustrip), lambda each: bind(F.array_position(F.transform(each, lambda x: x.rlike(pattern)), True).cast("int"), lambda at: block(each, at)))


def contact_section(c: Column, markers: str, most: int = 13) -> Column:
    """From the first line of less than 40 characters with "kontakt" to the next line that begins a section, `most` lines at most; without one, the first line with an address or a telephone number."""
    each = F.filter(F.transform(lines(c), lambda x: normalise_space(x)), lambda x: x != "")
    head = lambda x: F.lower(x).contains("kontakt") & (F.length(x) < 40)
    begin = F.array_position(F.transform(each, head), True).cast("int")
    rest = F.slice(each, F.greatest(begin, F.lit(1)), F.lit(most))
    stop = F.array_position(F.transform(rest, lambda x: x.rlike(markers) & ~head(x)), True).cast("int")
    block = F.array_join(F.when(stop > 0, F.slice(rest, F.lit(1), F.greatest(stop - 1, F.lit(0)))).otherwise(rest), "\n")
    reached = F.get(F.filter(each, lambda x: x.rlike(EMAIL) | (F.size(phones(x)) > 0)), F.lit(0))
    return F.when(begin > 0, block).otherwise(F.coalesce(reached, F.lit("")))


def named_documents(c: Column) -> Column:
    """Which documents a text names."""
    t = F.lower(blank(c))
    return F.array_join(F.filter(F.array(*(F.when(F.contains(t, F.lit(d)), F.lit(d.capitalize())) for d in NAMED_DOCUMENTS)), lambda x: x.isNotNull()), ", ")


def company_line(c: Column, words: str = COMPANY_LINE) -> Column:
    """E34."""
    return first_line(c, words)


def city_line(c: Column) -> Column:
    """The city after the first short line of a list among the first 25."""
    return F.regexp_replace(first_line(c, r"^- .{1,77}$", 25), "^- ", "")


def headline(c: Column) -> Column:
    """Struct of title, company and city out of "title bei company in city" in the first five lines."""
    p = r"(?iu)^(.+?)\s+bei\s+(.+?)\s+in\s+(.+)$"
    line = first_line(c, p, 5)
    return F.struct(*(F.regexp_extract(line, p, i).alias(n) for i, n in ((1, "title"), (2, "company"), (3, "city"))))


def result_count(c: Column) -> Column:
    """The total in "1 bis 25 von 1.234"."""
    return F.replace(F.regexp_extract(blank(c), r"(?iu)\d+\s*(?:bis|-)\s*\d+\s*von\s*([\d.]+)", 1), F.lit("."), F.lit("")).try_cast("int")


def title_case(c: Column) -> Column:
    return F.initcap(F.lower(F.replace(blank(c), F.lit("_"), F.lit(" "))))


def coordinates(lat: Column, lon: Column) -> Column:
    """P17."""
    return F.when(lat.isNull() | lon.isNull(), "").otherwise(F.concat(lat.cast("string"), F.lit(","), lon.cast("string")))


def address(street: Column, number: Column, code: Column, city: Column) -> Column:
    """P16."""
    return F.concat_ws(", ", or_null(ustrip(F.concat_ws(" ", or_null(street), or_null(number)))), or_null(ustrip(F.concat_ws(" ", or_null(code), or_null(city)))))


def yearly_salary(years: list[Column], code: Column) -> Column:
    """Amounts of the years (half to even), else the code in words."""
    parts = [F.when(y.isNotNull(), F.concat(F.lit(f"Jahr {i}: "), F.bround(y, 0).cast("bigint").cast("string"), F.lit(" EUR/Monat"))) for i, y in enumerate(years, 1)]
    return first_filled(F.concat_ws(" | ", *parts), F.when(blank(code) != "KEINE_ANGABEN", title_case(code)))


def degree(code: Column) -> Column:
    """Label of a degree; blank for none."""
    table = F.create_map(*(F.lit(x) for pair in DEGREES.items() for x in pair))
    label = F.coalesce(table[blank(code)], title_case(code))
    return F.when(label == "Nicht angegeben", "").otherwise(label)


def requirement_lines(text: Column, code: Column) -> Column:
    """The section and the degree."""
    return F.concat_ws("\n", or_null(requirements(text)), or_null(degree(code)))


def job_title(kind: Column, main: Column, jobs: Column) -> Column:
    """P20: kind, main job and other jobs, each once."""
    parts = F.concat(F.array(F.when(filled(kind), title_case(kind)), F.when(filled(main), main)), F.coalesce(jobs, F.array().cast("array<string>")))
    return F.array_join(F.array_distinct(F.filter(parts, lambda x: x.isNotNull())), " | ")


def website(c: Column) -> Column:
    """P21."""
    u = blank(c)
    return F.when((u != "") & ~F.startswith(u, F.lit("http")), F.concat(F.lit("https://"), u)).otherwise(u)


# Industries by words of the description, in order of trial.
INDUSTRIES = (
    (("verwaltung", "behörde", "öffentlicher dienst"), "Öffentlicher Dienst / IT-Digitalisierung"), (("gesundheit", "klinik", "krankenhaus"), "Gesundheitswesen / IT"), (("handel", "einzelhandel"), "Handel / IT"),
)


def industry(c: Column) -> Column:
    """E29."""
    t = F.lower(F.substring(blank(c), 1, 2000))
    return F.coalesce(*(F.when(t.rlike("|".join(words)), F.lit(label)) for words, label in INDUSTRIES), F.lit("Informationstechnologie / Softwareentwicklung"))


# Headings that end a company's description, begins of lines about the job, words that speak of a company.
HEADING = (
    r"(?iu)(?:^|\n)\s*(?:#{1,6}\s*)?(?:aufgaben|deine?\s+(?:aufgaben|to\s*dos|ausbildung|profil)|das\s+lernst|voraussetzungen|zugangsvoraussetzung|ihre?\s+aufgaben|unsere?\s+aufgaben|gut zu wissen)\b"
)
JOB_BEGINS = ("als fachinformatiker", "in deiner ausbildung", "starte ", "dein profil", "fachinformatiker (m/w/d)", "ausbildung fachinformatiker")
COMPANY_WORDS = ("wir sind", "unser unternehmen", "über uns", "willkommen bei", " wurde ", " gegründet", "mit sitz in", "als familienunternehmen", "als spezialisierte")


def before_markers(c: Column) -> Column:
    """The text before the first word that begins a section, without punctuation at its ends."""
    return F.regexp_replace(F.split(c, any_of((*REQUIREMENTS, *OFFERS)), 2)[0], r"^[ .,;:-]+|[ .,;:-]+$", "")


def company_description(c: Column) -> Column:
    """Up to six lines of the first paragraph, before any heading or word of a section, that aren't about the job; else a line of it that speaks of the company; else the first line."""
    marked = any_of((*REQUIREMENTS, *OFFERS))
    about_job = lambda x: F.lower(x).rlike("^(?:" + "|".join(rf"\Q{w}\E" for w in JOB_BEGINS) + ")")
    head = F.split(blank(c), HEADING, 2)[0]
    text = F.when(head == "", blank(c)).otherwise(head)
    start = F.struct(F.lit(False).alias("done"), F.array().cast("array<string>").alias("kept"))

    def step(a: Column, raw: Column) -> Column:
        line = ustrip(raw)
        bare = F.regexp_replace(F.regexp_replace(line, r"^\*+\s*", ""), r"^#+\s*", "")
        marker = bare.rlike(marked)
        stop = a["done"] | ((line == "") & (F.size(a["kept"]) > 0)) | ((line != "") & (bare.rlike(HEADING) | marker))
        cut = before_markers(bare)
        take = ~a["done"] & (line != "") & ~bare.rlike(HEADING) & (~marker | (F.length(cut) > 40))
        return F.struct(stop.alias("done"), F.when(take, F.concat(a["kept"], F.array(F.when(marker, cut).otherwise(bare)))).otherwise(a["kept"]).alias("kept"))

    blocks = F.aggregate(lines(text), start, step, lambda a: a["kept"])
    intro = F.array_join(F.filter(F.slice(blocks, 1, 6), lambda x: ~about_job(x)), "\n")
    speaks = F.get(F.filter(blocks, lambda x: x.rlike(any_of(COMPANY_WORDS))), F.lit(0))
    first = ustrip(F.get(lines(c), F.lit(0)))
    lead = F.when(~about_job(first) & (F.length(before_markers(first)) > 40), before_markers(first))
    return first_filled(intro, F.when(speaks.isNotNull(), before_markers(speaks)), lead)


# Words of lines about projects, patterns of mottos, texts where nothing is found.
PROJECT_WORDS = ("entwickl", "software", "digital", "programm", "it-")
MOTTOS = (r"(?i)(?:unser motto|unsere mission|wir stehen für)[:\s]+([^\n.]{10,120})", r"(?i)(?:vision)[:\s]+([^\n.]{10,120})")
NO_PROJECTS = "Softwareentwicklung und digitale Lösungen laut Stellenbeschreibung."


def motto(c: Column) -> Column:
    """E29."""
    return first_filled(*(ustrip(F.regexp_extract(F.substring(blank(c), 1, 2000), p, 1)) for p in MOTTOS))


def projects(c: Column) -> Column:
    """The lines that speak of projects, 600 characters at most."""
    found = F.filter(lines(F.substring(blank(c), 1, 2000)), lambda x: F.lower(x).rlike("|".join(PROJECT_WORDS)))
    return first_filled(F.substring(ustrip(F.array_join(F.transform(found, ustrip), " ")), 1, 600), F.lit(NO_PROJECTS))


def culture(about: Column, offer: Column, city: Column) -> Column:
    """What the company says of itself, else of its offer, else a sentence; 500 characters at most."""
    plain = F.concat(F.lit("Ausbildungsbetrieb in "), blank(city), F.lit(" mit Fokus auf Fachinformatiker Anwendungsentwicklung."))
    said, offered = F.substring(blank(about), 1, 600), F.substring(blank(offer), 1, 400)
    return F.substring(F.when(said != "", said).when(offered != "", offered).otherwise(plain), 1, 500)
