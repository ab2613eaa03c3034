"""Text, date and classification functions, branch by branch."""

import pytest
from pyspark.sql import functions as F

from korbwerk.functions import classify, dates, extract, text


def values(spark, rows, column):
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], "i int, a string, b string, c string" if isinstance(rows[0], tuple) else "i int, a string")
    return [r[0] for r in df.select(column.alias("v"), "i").orderBy("i").select("v").collect()]


def test_cleaning(spark):
    a = F.col("a")
    assert values(spark, [None, "  x ", " y ", "z"], text.ustrip(a)) == ["", "x", "y", "z"]
    assert values(spark, [None, "  ", "x"], text.filled(a)) == [False, False, True]
    assert values(spark, ["a  b\r\n\r c d \n\n", None], text.normalise_space(a)) == ["a b\nc d", ""]
    assert values(spark, ["<script>x</script><p>a &amp; b</p><STYLE>q</STYLE>c", None], text.html_text(a)) == ["a &amp; b c", ""]
    assert values(spark, ["# T\n**b** *i* `c` [l](u)\n- x"], text.markdown_text(a)) == ["T b i c l x"]


def test_lists(spark):
    a = F.col("a")
    assert values(spark, ["a@b.de, A@B.de; x@y.deLinkedIn.", None], text.emails(a)) == [["a@b.de", "x@y.de"], []]
    assert values(spark, ["Tel 0241  12345 67 oder 0241 12345 67!"], text.phones(a)) == [["0241 12345 67"]]
    assert values(spark, ["https://www.a.de/x?q=1, http://b.de/y). https://a.de/x/"], text.urls(a)) == [["https://www.a.de/x?q=1", "http://b.de/y"]]


def test_keys(spark):
    a = F.col("a")
    assert values(spark, ["//A.de/x/", "www.a.de/x?y#z", "HTTPS://www.A.de", ""], text.url_key(a)) == ["https://a.de/x", "https://a.de/x", "https://a.de", ""]
    assert values(spark, ["Müller & Söhne GmbH & Co. KG", "Foo AG", None], text.company_stem(a)) == ["mllershne", "foo", ""]
    assert values(spark, ["Größe & Co./Bau", " "], text.slug(a)) == ["groesse-co-bau", ""]
    assert values(spark, ["Köln/Bonn (West)", "  ", None], text.file_slug(a)) == ["kölnbonn_west", "tanpa_kota", "tanpa_kota"]
    assert values(spark, ["Weg 1, 52062 Aachen", "123456"], text.postcode(a)) == ["52062", ""]


def test_sections(spark):
    a = F.col("a")
    body = "vor\nAnforderungen:\n- eins\n- zwei\n\nnach\nWir bieten\nGeld"
    assert values(spark, [body], text.section(a, "Anforderungen")) == ["Anforderungen:\n- eins\n- zwei"]
    got = values(spark, [body], text.sections(a, {"req": "Anforderungen", "offer": "bieten"}))[0]
    assert got == {"req": "Anforderungen:\n- eins\n- zwei\nnach", "offer": "Wir bieten\nGeld"}


@pytest.mark.parametrize(
    ("line", "want"),
    [
        ("Ausbildungsbeginn: 01.08.2026", (2026, 8, "2026-08-01")), ("zum 1.9.2027 gesucht", (2027, 9, "2027-09-01")), ("Beginn ab dem August 2026", (2026, 8, None)), ("ab 2027", (2027, None, None)),
        ("für das Ausbildungsjahr 2026", (2026, None, None)), ("Bewerbungsschluss: 31.03.2026", None), ("Stichtag 15.08.2026", (2026, 8, "2026-08-15")), ("Beginn: 41.08.2026", None), ("zum 01.08.2025", None), (None, None),
        ("Bewerbungsfrist 01.02.2026." + " x" * 60 + " am 03.09.2026", (2026, 9, "2026-09-03")),
    ],
)
def test_dates(spark, line, want):
    got = values(spark, [line], dates.text_start(F.col("a")))[0]
    assert (tuple(got) if got else None) == want


def test_other_dates(spark):
    a = F.col("a")
    assert [tuple(x) if x else None for x in values(spark, ["2026-08-01", "2025-08-01", " 2027-13-99 ", ""], dates.iso_start(a))] == [(2026, 8, "2026-08-01"), None, (2027, 13, "2027-13-99"), None]
    assert [tuple(x) if x else None for x in values(spark, ["x_ae_2026", "x_2027", "x"], dates.category_start(a))] == [(2026, None, None), (2027, None, None), None]
    assert values(spark, [" 1.8.2026 ", "Herr X 1.8.2026"], dates.date_only(a)) == [True, False]
    assert values(spark, ["1. September 2026", "3. Foo 2026", "x"], dates.german_date(a)) == ["2026-09-01", "2026-08-03", ""]


@pytest.mark.parametrize(
    ("row", "want"),
    [
        (("Praktikum IT", "", ""), "skip"), (("Ausbildung Fachinformatiker Anwendungsentwicklung", "", ""), "ae"), (("Ausbildung Fachinformatiker Daten- und Prozessanalyse Anwendungsentwicklung", "", ""), "dpa"),
        (("Duales Studium Informatik", "", ""), "dual"), (("Ausbildung Koch", "", ""), "non_fi"), (("Ausbildung Fachinformatiker", "", "x_si"), "si"), (("Ausbildung Fachinformatiker", "", "x"), "fi_other"),
        (("Senior Java Developer", "", ""), "skip"), (("Fachinformatiker Vollzeit", "", "y"), "skip"), (("Fachinformatiker Vollzeit", "in Ausbildung", "y"), "fi_other"), ((None, None, None), "non_fi"),
        (("Ausbildung Fachinformatiker", "", "wir_sind_bund_fi"), "si"),
    ],
)
def test_job_types(spark, row, want):
    assert values(spark, [row], classify.job_type(F.col("a"), F.col("b"), F.col("c"))) == [want]


def test_job_type_without_parity(spark):
    assert values(spark, [("Ausbildung Fachinformatiker", "", "wir_sind_bund_fi")], classify.job_type(F.col("a"), F.col("b"), F.col("c"), parity=False)) == ["fi_other"]
    assert values(spark, [None, "", "4", "1", "x"], classify.apprenticeship(F.col("a"))) == [True, True, True, False, False]


def test_characters_are_resolved_once(spark):
    from pyspark.sql import functions as F

    from korbwerk.functions.text import strip_html, unescape

    t = "a &amp; b &lt;x&gt; &#65;&#x41; &auml;&Auml; &nosuch; &hearts; &apos; &amp;lt; &#38;lt; &#0; &#xD800; & plain &;"
    rows = spark.createDataFrame([(t,), ("",), (None,), ("&amp;",)], "t string")
    assert [r.u for r in rows.select(unescape(F.col("t")).alias("u")).collect()] == ["a & b <x> AA äÄ &nosuch; ♥ ' &lt; &lt; � � & plain &;", "", "", "&"]
    # the input is computed once
    plan = spark.range(1).select(strip_html(F.concat(F.lit("marked"), F.col("id").cast("string"))).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("marked") == 1


def test_trimming_and_folding_as_patterns_do(spark):
    # every character of the first plane, at the ends of a text and as a letter of a word
    chars = [chr(i) for i in range(1, 0x10000) if not 0xD800 <= i < 0xE000]
    df = spark.createDataFrame([(x,) for x in chars], "x string")
    space = r"[\s\h\x{85}\x{2028}\x{2029}]"
    text_ = F.concat("x", F.lit("a"), "x", F.lit("b"), "x")
    assert df.where(text.ustrip(text_) != F.regexp_replace(text_, f"^{space}+|{space}+$", "")).count() == 0
    letters = "abcdefghijklmnopqrstuvwxyzäöüß"
    word = F.concat("x", F.lit("z"))
    fits = [text.holds_any(text.fold(word), (w + "z",)) != word.rlike(rf"(?iu)\Q{w}z\E") for w in letters]
    assert df.where(F.array_contains(F.array(*fits), True)).count() == 0


def test_sections_by_words_as_by_patterns(spark):
    words = {"t": ("deine aufgaben", "aufgaben"), "o": ("wir bieten", "vergütung"), "n": ("nie",)}
    bodies = ["Start\n Deine AUFGABEN \n\n a\nb\nWIR BIETEN\nObst\nDie Aufgaben\nc \nVERGÜTUNG\nviel", "aufgaben", "nichts", "", None]
    by_words, by_patterns = (values(spark, bodies, text.sections(F.col("a"), m)) for m in (words, {k: extract.any_of(w) for k, w in words.items()}))
    assert by_words == by_patterns and by_words[0] == {"t": "Deine AUFGABEN\na\nb\nDie Aufgaben\nc", "o": "WIR BIETEN\nObst\nVERGÜTUNG\nviel", "n": ""}
