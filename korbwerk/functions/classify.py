"""Job types of listings (C1 to C6) and the filters that use them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from korbwerk.functions.text import blank, company_key, ustrip
from korbwerk.schema import TARGET_TYPES

# Patterns of the classifier.
TRAINEE = r"(?iu)fachinformatiker(?:in|/|-)?|fachinformatik\b"
APPRENTICE = r"(?iu)\bausbildung\b"
DUAL = r"(?iu)duales?\s+studium|dual\s+studier|verbundstudium|ausbildung\s*\+\s*b\.?\s*sc|ausbildung\s*\+\s*bachelor"
SKIP_START = r"(?iu)^\s*(praktikum|trainee|werkstudent|werkstudierend|minijob|ferienjob)\b"
SKIP_WORD = r"(?iu)\b(praktikum|trainee|werkstudent|werkstudierend|minijob|ferienjob)\b"
SKIP_HOURS = r"(?iu)\b(vollzeit|teilzeit)\b(?![\s\S]{0,40}\bausbildung\b)"
SKIP_JOB = (
    r"(?iu)\b(junior|senior|lead|principal)\s+.{0,30}\b(developer|entwickler|engineer)\b|\bfullstack\s+developer\b|\bsoftware\s+entwickler\b(?![\s\S]{0,80}\bausbildung\b)"
    r"|\bpraktikum\s+im\s+bereich\b|\bbefristet\b(?![\s\S]{0,60}\bausbildung\b)"
)
TYPE_PATTERNS = {
    "dpa": r"(?iu)daten.{0,40}prozess|prozess.{0,40}daten|daten-\s*und\s*prozessanalyse|\bdpa\b",
    "ae": r"(?iu)anwendungs[\s-]?entwicklung",
    "si": r"(?iu)systemintegration",
    "dv": r"(?iu)digitale\s+vernetzung",
}
LEAD = 1200


def skipped(text: Column, title: Column) -> Column:
    """Not an apprenticeship. text: title and the description's begin in lower case."""
    says, hours = title.rlike(APPRENTICE), text.rlike(SKIP_HOURS)
    exempt = says & ~title.rlike(SKIP_START) & ((hours & text.rlike(APPRENTICE)) | ~title.rlike(SKIP_WORD))
    return ~exempt & (title.rlike(SKIP_START) | (text.rlike(SKIP_WORD) & ~says) | text.rlike(SKIP_JOB) | (hours & ~text.rlike(APPRENTICE)))


def dual(text: Column, title: Column) -> Column:
    """C3."""
    return F.contains(F.lower(title), F.lit("duales studium")) | text.rlike(DUAL)


def type_of_text(text: Column) -> Column:
    """C4: dpa, ae, si, dv or null."""
    return F.coalesce(*(F.when(text.rlike(p), F.lit(k)) for k, p in TYPE_PATTERNS.items()))


def type_of_category(category: Column, parity: bool = True) -> Column:
    """By parts of the category's name. parity: a part anywhere counts (Q17); else only at the end."""
    c = F.lower(blank(category))

    def has(*names: str) -> Column:
        out = F.lit(False)
        for n in names:
            out = out | (F.contains(c, F.lit(n)) if parity else F.endswith(c, F.lit(f"_{n}")))
        return out

    return (
        F.when(has("dpa"), "dpa").when(has("ae", "ae_2026"), "ae").when(has("si"), "si").when(has("dv"), "dv").when(F.contains(c, F.lit("systemintegration")), "si")
        .when(c.rlike("digitale[_-]vernetzung"), "dv").when(F.contains(c, F.lit("anwendungsentwicklung")), "ae").when(F.contains(c, F.lit("daten")) & F.contains(c, F.lit("prozess")), "dpa")
    )


def job_type(title: Column, description: Column, category: Column, parity: bool = True) -> Column:
    """Skip, dual, non_fi, then ae, dpa, si or dv, else fi_other; the first that fits."""
    t, d, c = blank(title), blank(description), blank(category)
    lead = F.lower(F.concat_ws(" ", t, F.substring(d, 1, LEAD)))
    everything = F.lower(F.concat_ws(" ", t, d, c))
    return (
        F.when(skipped(lead, ustrip(title)), "skip").when(dual(lead, ustrip(title)), "dual")
        .when(~everything.rlike(TRAINEE) & ~F.contains(F.lower(c), F.lit("fachinformatiker")), "non_fi")
        .otherwise(F.coalesce(type_of_text(everything), type_of_category(category, parity), F.lit("fi_other")))
    )


def target(c: Column) -> Column:
    """F13."""
    return F.lower(ustrip(c)).isin(*TARGET_TYPES)


def job_family(title: Column, description: Column) -> Column:
    """Key for the same job on different boards."""
    both = F.lower(F.concat_ws(" ", blank(title), F.substring(blank(description), 1, 120)))
    name = F.when(F.length(blank(title)) > 0, blank(title)).otherwise(blank(description))
    return F.when(F.contains(both, F.lit("daten")) & F.contains(both, F.lit("prozess")), "dpa").when(F.contains(both, F.lit("anwendungsentwicklung")), "ae").otherwise(company_key(F.substring(name, 1, 80)))


def apprenticeship(kind: Column) -> Column:
    """offer kind 4, or none given."""
    text = kind.cast("string")
    return F.coalesce(text, F.lit("")).isin("") | F.coalesce(F.trim(text).try_cast("int") == 4, F.lit(False))


def title_fits(title: Column, kind: str) -> Column:
    """title filter for ae or dpa; any other kind lets all pass."""
    t = F.lower(blank(title))
    if kind == "dpa":
        return t.rlike(TYPE_PATTERNS["dpa"])
    return (t.rlike(TYPE_PATTERNS["ae"]) & ~(F.contains(t, F.lit("daten")) & F.contains(t, F.lit("prozess")))) if kind == "ae" else F.lit(True)


# Words that stand for data and process analysis in keyword filters.
DATA_PROCESS = r"(?u)daten.{0,30}prozess|prozess.{0,30}daten"
DATA_PROCESS_PHRASES = ("daten- und prozessanalyse", "daten und prozessanalyse", "daten und prozesanalyse")


def _blob(*parts: Column) -> Column:
    return F.lower(F.concat_ws(" ", *(blank(p) for p in parts)))


def fits_by_words(category: Column, title: Column, description: Column) -> Column:
    """keyword filter by the category's ending; other categories pass."""
    t, c = _blob(title, description), blank(category)
    data = t.rlike(DATA_PROCESS)
    phrase = F.lit(False)
    for p in DATA_PROCESS_PHRASES:
        phrase = phrase | F.contains(t, F.lit(p))
    return F.when(F.endswith(c, F.lit("_dpa")), data | phrase).when(F.endswith(c, F.lit("_ae")), ~data & F.contains(t, F.lit("anwendungsentwicklung"))).otherwise(True)


def hint_fits(hint: Column, kind: str) -> Column:
    """F8: whether the text around a link speaks of dpa or dv; other kinds pass."""
    t = F.lower(blank(hint))
    tests = {"dpa": F.contains(t, F.lit("daten")) & F.contains(t, F.lit("prozes")), "dv": F.contains(t, F.lit("digitale vernetz"))}
    return tests.get(kind, F.lit(True))


def fits_strictly(category: Column, title: Column, description: Column, hint: Column | None = None, parity: bool = True) -> Column:
    """the type must not contradict the category's ending; dpa and dv need their words too, in title, description or the card's hint."""
    kind, c = job_type(title, description, category, parity), blank(category)
    t = _blob(title, description, *([hint] if hint is not None else []))
    ends = lambda x: F.endswith(c, F.lit(x))
    return (
        F.when(kind.isin("skip", "dual", "non_fi"), False).when(ends("_ae"), ~kind.isin("dpa", "si", "dv")).when(ends("_si"), ~kind.isin("dpa", "ae", "dv"))
        .when(ends("_dpa"), kind.isin("dpa", "fi_other") & hint_fits(t, "dpa")).when(ends("_dv"), kind.isin("dv", "fi_other") & hint_fits(t, "dv")).otherwise(True)
    )
