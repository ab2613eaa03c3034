"""Column functions for text: cleaning, extraction, keys. No Python on the executors."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as strip() of a Unicode string sees it; trim() leaves no-break spaces.
SPACES = "".join(map(chr, (*range(9, 14), 32, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
# Patterns of addresses and phone numbers in free text.
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
#: The same matches in linear time: a match begins where the last one ended or where no longer one could have begun.
EMAILS = r"(?:\G|(?<![a-zA-Z0-9._%+-]))[a-zA-Z0-9._%+-]++@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PHONE = r"(?:\+49|0)[\s\d/()-]{6,20}\d"
URL = r"https?://[^\s<>\"')\]]+"
SCRAPE_SUFFIXES = ("LinkedIn", "linkedin", "XING", "xing")


def blank(c: Column) -> Column:
    """Null as the empty text."""
    return F.coalesce(c, F.lit(""))


def ustrip(c: Column) -> Column:
    """Text without white space at its ends."""
    # trimmed, as a pattern would be tried at each character
    return F.trim(blank(c), F.lit(SPACES))


def filled(c: Column) -> Column:
    """P10: text that isn't blank."""
    return F.length(ustrip(c)) > 0


def filled_number(c: Column) -> Column:
    """P10 for numbers: 0 counts as empty."""
    return F.coalesce(c != 0, F.lit(False))


def or_null(c: Column) -> Column:
    """Null for a blank text."""
    return F.when(filled(c), c)


def or_null_once(c: Column) -> Column:
    """or_null() that computes c once: for what is dear."""
    return F.get(F.filter(F.array(c), filled), F.lit(0))


def first_filled(*columns: Column) -> Column:
    """The first text that isn't blank, else blank."""
    return F.coalesce(*(or_null(c) for c in columns), F.lit(""))


def lines(c: Column) -> Column:
    """Lines of a text, whatever ends them."""
    return F.split(blank(c), r"\R")


def normalise_space(c: Column) -> Column:
    """One space for blanks, stripped lines, no blank lines."""
    each = F.transform(F.split(F.regexp_replace(F.regexp_replace(blank(c), r"\r\n?", "\n"), r"[ \t\x{a0}]+", " "), "\n"), ustrip)
    return F.array_join(F.filter(each, lambda x: x != ""), "\n")


#: Characters that patterns in any case ("(?iu)") take for a letter of German words though they have another lower case, and those letters.
ALIKE = ("ſ\u212aıİẞ", "skiiß")


def fold(c: Column) -> Column:
    """Lower case in which a German word stands wherever a pattern in any case finds it."""
    alike = (F.length(c) != F.octet_length(c)) & holds_any(c, tuple(ALIKE[0]))
    return F.lower(F.when(alike, F.translate(c, *ALIKE)).otherwise(c))


def holds_any(folded: Column, words: tuple[str, ...]) -> Column:
    """Whether folded text holds one of the words (in lower case), which takes a fraction of a pattern's time."""
    return reduce(lambda a, b: a | b, (F.contains(folded, F.lit(w)) for w in words))


def bind(c: Column, use: Callable[[Column], Column]) -> Column:
    """use(c), where c is computed once, however often it is used."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


#: A character of HTML by number or by name.
CHARACTER = r"&(?:#(?:[xX][0-9a-fA-F]{1,6}|[0-9]{1,7})|[A-Za-z][A-Za-z0-9]{0,31});"


def named_characters() -> Column:
    """Map of the names of HTML 4 (and apos) to their characters; folded to one literal."""
    return F.from_json(F.lit(json.dumps({name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"})), "map<string,string>")


def unescape(c: Column) -> Column:
    """Text with the named and numbered characters of HTML resolved, once. Other names than those of HTML 4 stay."""

    def numbered(digits: Column) -> Column:
        code = F.when(F.lower(digits).startswith("x"), F.conv(F.substring(digits, F.lit(2), F.length(digits)), 16, 10)).otherwise(digits).try_cast("int")
        valid = lambda n: n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
        return bind(code, lambda n: F.when(valid(n), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")).otherwise("\ufffd"))

    def char(m: Column) -> Column:
        named = F.coalesce(F.try_element_at(named_characters(), F.regexp_replace(m, "[&;]", "")), m)
        return F.when(F.startswith(m, F.lit("&#")), numbered(F.regexp_replace(m, "[&#;]", ""))).otherwise(named)

    def resolve(t: Column) -> Column:
        found = F.concat(F.transform(F.regexp_extract_all(t, F.lit(CHARACTER), F.lit(0)), char), F.array(F.lit("")))
        return F.array_join(F.zip_with(F.split(t, CHARACTER, -1), found, lambda a, b: F.concat(a, b)), "")

    return bind(blank(c), lambda t: F.when(F.contains(t, F.lit("&")), resolve(t)).otherwise(t))


def strip_html(c: Column) -> Column:
    """Lines of an HTML fragment: characters resolved, list items as "- ", a line's end after br, p and headings, no tags or comments."""

    def bare(out: Column) -> Column:
        for pattern, to in ((r"(?s)<!--.*?-->", ""), (r"(?i)<li\b[^>]*>", "\n- "), (r"(?i)<br\s*/?>|</p\s*>|</h[1-6]>", "\n"), (r"(?s)</?[A-Za-z!][^>]*>", "")):
            out = F.regexp_replace(out, pattern, to)
        return out

    marked = lambda t: normalise_space(unescape(bind(unescape(t), lambda u: F.when(F.contains(u, F.lit("<")), bare(u)).otherwise(u))))
    # most fields of structured data are plain words
    return bind(blank(c), lambda t: F.when(t.rlike(r"[<&\r\n\t\x{a0}]|  "), marked(t)).otherwise(ustrip(t)))


def html_text(c: Column) -> Column:
    """Text of a page without scripts, styles and tags, blanks squeezed."""
    out = blank(c)
    for pattern in (r"(?is)<script.*?>.*?</script>", r"(?is)<style.*?>.*?</style>", r"(?is)<[^>]+>", r"\s+"):
        out = F.regexp_replace(out, pattern, " ")
    return F.trim(out)


def html_title(c: Column) -> Column:
    """Title of a page, 200 characters at most."""
    return F.substring(html_text(F.regexp_extract(blank(c), r"(?is)<title[^>]*>(.*?)</title>", 1)), 1, 200)


def html_description(c: Column) -> Column:
    """Description of a page with the attributes in either order, 500 characters at most."""
    name_first = F.regexp_extract(blank(c), r"(?is)<meta[^>]+name=[\"']description[\"'][^>]+content=[\"'](.*?)[\"']", 1)
    name_last = F.regexp_extract(blank(c), r"(?is)<meta[^>]+content=[\"'](.*?)[\"'][^>]+name=[\"']description[\"']", 1)
    return F.substring(html_text(F.coalesce(F.nullif(name_first, F.lit("")), name_last)), 1, 500)


def main_text(c: Column) -> Column:
    """The main element of a page as lines of text."""
    body = bind(F.regexp_extract(blank(c), r"(?is)<main[^>]*>(.*?)</main>", 1), lambda t: F.when(t == "", blank(c)).otherwise(t))
    return normalise_space(F.regexp_replace(F.regexp_replace(body, r"(?is)<(script|style)[^>]*>.*?</\1>", "\n"), r"(?s)<[^>]+>", "\n"))


def links(c: Column) -> Column:
    """Distinct targets of a page's links, without their queries."""
    return F.array_distinct(F.transform(F.regexp_extract_all(blank(c), F.lit(r"(?i)href=[\"']([^\"'#?]+)"), F.lit(1)), lambda x: F.trim(x)))


def clean_email(c: Column) -> Column:
    out = F.regexp_replace(F.trim(c), r"[.,;)]+$", "")
    for suffix in SCRAPE_SUFFIXES:
        out = F.when(F.endswith(out, F.lit(suffix)), F.substring(out, F.lit(1), F.length(out) - len(suffix))).otherwise(out)
    return out


def distinct_by(values: Column, key) -> Column:
    """The first value for each key, in order. The index of a key's first place is looked up, not searched pair by pair, by position in the list of keys."""
    firsts = lambda v, keys: F.transform(F.array_distinct(keys), lambda k: F.get(v, (F.array_position(keys, k) - 1).cast("int")))
    return bind(values, lambda v: bind(F.transform(v, key), lambda keys: firsts(v, keys)))


def emails(c: Column) -> Column:
    """E-mail addresses of a text, the first of each spelling."""
    found = F.when(F.contains(blank(c), F.lit("@")), F.regexp_extract_all(blank(c), F.lit(EMAILS), F.lit(0))).otherwise(F.array().cast("array<string>"))
    return distinct_by(F.transform(found, clean_email), F.lower)


def phones(c: Column) -> Column:
    """Phone numbers of a text with single blanks, each once."""
    return F.array_distinct(F.transform(F.regexp_extract_all(blank(c), F.lit(PHONE), F.lit(0)), lambda x: F.regexp_replace(F.trim(x), r"\s+", " ")))


def urls(c: Column) -> Column:
    """URLs of a text without punctuation at the end, the first of each canonical form."""
    return distinct_by(F.transform(F.regexp_extract_all(blank(c), F.lit(URL), F.lit(0)), lambda x: F.regexp_replace(x, r"[.,;)]+$", "")), url_key)


def email_domain(c: Column) -> Column:
    """Q-2."""
    return F.lower(F.regexp_extract(blank(c), r"@([^@\s]+)", 1))


def normalise_url(c: Column) -> Column:
    """A URL with a scheme."""
    u = ustrip(c)
    return F.when(u == "", "").when(F.startswith(u, F.lit("//")), F.concat(F.lit("https:"), u)).when(u.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), u).otherwise(F.concat(F.lit("https://"), u))


def url_key(c: Column) -> Column:
    """P25: scheme, host without www. and path without a slash at the end; no query, no fragment."""
    u = normalise_url(c)
    host = F.regexp_replace(F.lower(F.regexp_extract(u, r"^[^:/]+://([^/?#]*)", 1)), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(u, r"^[^:/]+://[^/?#]*([^?#]*)", 1), "/+$", "")
    return F.when(u == "", "").otherwise(F.concat(F.lower(F.regexp_extract(u, r"^([^:/]+)://", 1)), F.lit("://"), host, path))


def inline_url(c: Column) -> Column:
    """A detail's URL without its query, ending in -inline.html."""
    u = F.regexp_replace(F.substring_index(blank(c), "?", 1), "/+$", "")
    return F.when(F.contains(u, F.lit("-inline.html")) & F.endswith(u, F.lit(".html")), u).when(F.endswith(u, F.lit(".html")), F.replace(u, F.lit(".html"), F.lit("-inline.html"))).otherwise(F.concat(u, F.lit("-inline.html")))


def host(c: Column) -> Column:
    """Host (with port) of a URL without www., blank if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(ustrip(c), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), r"^www\.", "")


def markdown_text(c: Column) -> Column:
    """Text of Markdown."""
    out = blank(c)
    for pattern, to in ((r"(?m)^#{1,6}\s+", ""), (r"\*\*([^*]+)\*\*", "$1"), (r"\*([^*]+)\*", "$1"), (r"`([^`]+)`", "$1"), (r"\[([^\]]+)\]\([^)]+\)", "$1"), (r"(?m)^\s*[-*+]\s+", ""), (r"\s+", " ")):
        out = F.regexp_replace(out, pattern, to)
    return F.trim(out)


def excerpt(c: Column, most: int = 280) -> Column:
    """The begin of a text, with an ellipsis if it is cut."""
    return F.when(F.length(c) > most, F.concat(F.rtrim(F.substring(c, 1, most)), F.lit("…"))).otherwise(c)


def slug(c: Column) -> Column:
    """A name as part of a URL."""
    out = F.regexp_replace(F.regexp_replace(F.lower(blank(c)), r"[&.]", ""), "/", "-")
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.regexp_replace(F.regexp_replace(out, "[^a-z0-9]+", "-"), "^-+|-+$", "")


def file_slug(c: Column) -> Column:
    """A name as part of a file's name."""
    out = F.regexp_replace(F.lower(ustrip(c)), r"(?U)[^\w\s-]", "")
    out = F.substring(F.regexp_replace(out, r"(?U)[\s/]+", "_"), 1, 80)
    return F.when(out == "", "tanpa_kota").otherwise(out)


def company_key(c: Column) -> Column:
    """Letters a-z and digits of a name; umlauts vanish (Q9)."""
    return F.regexp_replace(F.lower(blank(c)), "[^a-z0-9]+", "")


# Legal forms that don't tell companies apart.
LEGAL_FORMS = r"gmbh\s*&\s*co\.?\s*kg|b\.?\s*v\.?\s*&?\s*co\.?\s*kg|g\.?\s*m\.?\s*b\.?\s*h\.?|gmbh|mbh|ag|kg|ohg|gbr|eg|se|ug|co\.?\s*kg|e\.?\s*k\.?|kdoer"


def company_stem(c: Column) -> Column:
    """P32 of a name without its legal form, stripped up to three times."""
    out = F.lower(ustrip(c))
    for _ in range(3):
        out = F.regexp_replace(out, rf"(?iU)\b(?:{LEGAL_FORMS})\b\.?", " ")
    return company_key(out)


def postcode(c: Column) -> Column:
    """The first token of five digits."""
    return F.regexp_extract(blank(c), r"\b(\d{5})\b", 1)


def subsequence_pattern(query: Column) -> Column:
    """Q-8: a pattern that finds the characters of the query in order."""
    return F.array_join(F.transform(F.split(query, ""), lambda x: F.concat(F.lit(r"\Q"), x, F.lit(r"\E"))), ".*")


def section(c: Column, marker: str, most: int = 8, bullet: str = r"^\s*[-*•]") -> Column:
    """E5: lines from the first that holds a marker; markers are always kept; ends at a blank line after the first, at a heading, or after `most` lines at one that isn't a bullet."""
    start = F.struct(F.lit(False).alias("on"), F.lit(False).alias("done"), F.array().cast("array<string>").alias("kept"))

    def step(a: Column, line: Column) -> Column:
        hit, stripped = line.rlike(marker), F.trim(line)
        stop = a["on"] & ~hit & (((stripped == "") & (F.size(a["kept"]) > 1)) | F.startswith(stripped, F.lit("#")) | ((F.size(a["kept"]) >= most) & ~line.rlike(bullet)))
        take = ~a["done"] & (hit | (a["on"] & ~stop & (stripped != "")))
        return F.struct((a["on"] | hit).alias("on"), (a["done"] | stop).alias("done"), F.when(take, F.concat(a["kept"], F.array(stripped))).otherwise(a["kept"]).alias("kept"))

    return F.array_join(F.aggregate(lines(c), start, step, lambda a: a["kept"]), "\n")


def sections(c: Column, markers: dict[str, str] | dict[str, tuple[str, ...]]) -> Column:
    """A map of section to text: a marker line begins its section (the first marker that fits names it: a pattern, or words in any case), other lines go on with it; lines before any are dropped."""
    by_words = all(isinstance(m, tuple) for m in markers.values())
    fits = holds_any if by_words else Column.rlike
    marks = F.transform(lines(fold(blank(c)) if by_words else c), lambda line: F.coalesce(*(F.when(fits(line, m), F.lit(k)) for k, m in markers.items()), F.lit(None).cast("string")))

    def runs(text: Column, names: Column, begins: Column) -> Column:
        end = lambda j: F.coalesce(F.get(begins, j + 1), F.size(text))
        return F.transform(begins, lambda b, j: F.struct(F.get(names, b).alias("k"), F.array_join(F.filter(F.slice(text, b + 1, end(j) - b), lambda x: x != ""), "\n").alias("v")))

    # each line is looked at once, and copied once, however many lines and sections there are
    at = lambda names: F.filter(F.transform(names, lambda m, i: F.when(m.isNotNull(), i)), lambda i: i.isNotNull())
    found = bind(F.transform(lines(c), lambda x: F.trim(x)), lambda text: bind(marks, lambda names: bind(at(names), lambda begins: runs(text, names, begins))))
    return bind(found, lambda rows: F.map_from_entries(F.array(*(F.struct(F.lit(k), F.array_join(F.transform(F.filter(rows, _in(k)), lambda r: r["v"]), "\n")) for k in markers))))


def _in(key: str):
    return lambda row: (row["k"] == key) & (row["v"] != "")
