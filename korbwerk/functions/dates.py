"""Start dates in German text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from korbwerk.functions.text import blank, ustrip

# The years that count, month names in order of trial, words that announce a deadline.
YEARS = "20(?:26|27)"
MONTHS = (("januar", 1), ("februar", 2), ("märz", 3), ("maerz", 3), ("april", 4), ("mai", 5), ("juni", 6), ("juli", 7), ("august", 8), ("september", 9), ("oktober", 10), ("november", 11), ("dezember", 12))
DEADLINES = ("bewerbungsschluss", "bewerbungsfrist", "bewerbungsende", "einsendeschluss", "bewerbung bis", "bewirb dich bis")
DAY = rf"(\d{{1,2}})\.(\d{{1,2}})\.({YEARS})"
# What stands before a start date, in order of trial.
LEADS = (
    r"(?:ausbildungsbeginn|ausbildungsstart|eintrittsdatum|beginn|start)[\s:]*(?:ist\s+(?:der\s+)?|am\s+|zum\s+)?",
    r"zum\s+",
    r"(?:ausbildungsbeginn|ausbildungsstart)[:\s]+",
    r"ausbildungsplatz[^.\n]{0,80}?",
)
START = "struct<year:int,month:int,date:string>"


def _start(year: Column, month: Column, date: Column) -> Column:
    return F.struct(year.cast("int").alias("year"), month.cast("int").alias("month"), date.cast("string").alias("date"))


def _day(day: Column, month: Column, year: Column) -> Column:
    """A struct for a valid day and month, else null."""
    d, m, y = (c.try_cast("int") for c in (day, month, year))
    return F.when(m.between(1, 12) & d.between(1, 31), _start(y, m, F.format_string("%04d-%02d-%02d", y, m, d)))


def iso_start(c: Column) -> Column:
    """Year, month and text of an ISO date of the years that count, else null."""
    p, t = rf"^({YEARS})-(\d{{2}})-(\d{{2}})$", ustrip(c)
    return F.when(t.rlike(p), _start(F.regexp_extract(t, p, 1).try_cast("int"), F.regexp_extract(t, p, 2).try_cast("int"), t))


def text_start(c: Column) -> Column:
    """Start of one text, null if it names none. A text without a year that counts is not searched further, nor one without a day or a month's name for those."""
    t = blank(c)
    announced = []
    for lead in LEADS:
        p = rf"(?i){lead}{DAY}"
        announced.append(F.when(t.rlike(p), _day(*(F.regexp_extract(t, p, i) for i in (1, 2, 3)))))
    begin = r"(?iu)(?:ausbildungsbeginn|ausbildungsstart|beginn|start|ab|zum)\s+(?:[\w\x{c0}-\x{24f}]+\s+){0,4}"
    months = []
    for name, number in MONTHS:
        p = rf"{begin}{name}\s+({YEARS})\b"
        months.append(F.when(t.rlike(p), _start(F.regexp_extract(t, p, 1).try_cast("int"), F.lit(number), F.lit(None))))
    any_month = rf"{begin}(?:{'|'.join(n for n, _ in MONTHS)})\s+{YEARS}\b"
    # dates with 70 characters before and 40 after; matches are looked for within lookarounds, so that contexts may overlap
    around = F.regexp_extract_all(t, F.lit(rf"\b{DAY}\b"), F.lit(0))
    pieces = F.split(t, rf"\b{DAY}\b", -1)
    dated = F.zip_with(around, F.sequence(F.lit(0), F.greatest(F.size(around) - 1, F.lit(0))), lambda d, i: F.struct(d.alias("d"), F.concat(F.right(F.get(pieces, i), F.lit(70)), d, F.substring(F.get(pieces, i + 1), 1, 40)).alias("near")))
    calm = F.filter(dated, lambda x: x["d"].isNotNull() & ~F.lower(x["near"]).rlike("|".join(DEADLINES)))
    starts = F.filter(F.transform(calm, lambda x: _day(*(F.regexp_extract(x["d"], DAY, i) for i in (1, 2, 3)))), lambda x: x.isNotNull())
    years = []
    for p in (rf"(?i)\bab\s+({YEARS})\b", rf"(?iu)(?:für\s+(?:das\s+)?ausbildungsjahr|ausbildungsjahr)\s+({YEARS})\b"):
        years.append(F.when(t.rlike(p), _start(F.regexp_extract(t, p, 1).try_cast("int"), F.lit(None), F.lit(None))))
    dayed = t.rlike(DAY)
    found = F.coalesce(F.when(dayed, F.coalesce(*announced)), F.when(t.rlike(any_month), F.coalesce(*months)), F.when(dayed, F.get(starts, F.lit(0))), *years)
    return F.when(t.rlike(YEARS), found).otherwise(F.lit(None).cast(START))


def category_start(c: Column) -> Column:
    """The year at a category's end, else null."""
    year = F.regexp_extract(blank(c), r"_(2027|2026)$", 1).try_cast("int")
    return F.when(year.isNotNull(), _start(year, F.lit(None), F.lit(None)))


def start_date(iso: Column, texts: list[Column], category: Column) -> Column:
    """The ISO field, else the first text that names a year, else the category."""
    return F.coalesce(iso_start(iso), *(text_start(t) for t in texts), category_start(category), F.lit(None).cast(START))


def date_only(c: Column) -> Column:
    """A text that is nothing but a date."""
    return ustrip(c).rlike(r"^\d{1,2}\.\d{1,2}\.(20\d{2})$")


def german_date(c: Column) -> Column:
    """ISO date of "1. August 2026"; a month that isn't known is taken as the eighth."""
    p = r"(?iu)(\d{1,2})\.\s*([a-zäöü]+)\s+(20\d{2})"
    names = F.create_map(*(F.lit(x) for pair in MONTHS for x in pair))
    month = F.coalesce(names[F.lower(F.regexp_extract(blank(c), p, 2))], F.lit(8))
    return F.when(blank(c).rlike(p), F.format_string("%s-%02d-%02d", F.regexp_extract(c, p, 3), month, F.regexp_extract(c, p, 1).try_cast("int"))).otherwise("")
