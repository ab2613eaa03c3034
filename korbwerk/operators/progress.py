"""Progress of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from korbwerk.functions.text import blank

# Sources by the begin of a category.
SOURCES = {
    "fachinformatiker": "fachinformatiker", "ausbildung_de": "ausbildung_de", "meine_ausbildung": "meine_ausbildung", "ausbildung_nrw": "ausbildung_nrw", "azubiyo_de": "azubiyo_de", "azubi_de": "azubi_de",
    "stepstone_de": "stepstone_de", "indeed_de": "indeed_de", "ausbildungsstellen_": "ausbildungsstellen_de", "ausbildungsmarkt_": "ausbildungsmarkt_de", "meinestadt_": "meinestadt_de", "backinjob_": "backinjob_de",
    "karriere_sw_": "karriere_suedwestfalen_de", "aubi_plus_": "aubi_plus_de", "wir_sind_bund_": "wir_sind_bund_de",
}


def source_key(category: Column) -> Column:
    """The source that a category belongs to; else its first part."""
    c = blank(category)
    return F.coalesce(*(F.when(F.startswith(c, F.lit(p)), F.lit(s)) for p, s in SOURCES.items()), F.substring_index(c, "_", 1))


def is_ae(category: Column) -> Column:
    """P37."""
    c = blank(category)
    return F.endswith(c, F.lit("_ae")) | (c == "fachinformatiker_ae_2026")


def is_dpa(category: Column) -> Column:
    """P37."""
    return F.endswith(blank(category), F.lit("_dpa"))


def share(done: Column, total: Column) -> Column:
    """Percent with one digit, a dash where there is nothing to do."""
    return F.when(total > 0, F.concat(F.format_string("%.1f", F.bround(done * 100 / total, 1)), F.lit("%"))).otherwise("—")


def totals(df: DataFrame) -> DataFrame:
    """Listings by source and over all, with those of both job families, as grouping sets in one pass."""
    c = F.col("category_id")
    rows = df.select(source_key(c).alias("source"), is_ae(c).alias("ae"), (is_dpa(c) & ~is_ae(c)).alias("dpa"))
    return rows.groupingSets([[F.col("source")], []], "source").agg(F.count("*").alias("n"), F.count_if("ae").alias("n_ae"), F.count_if("dpa").alias("n_dpa"), F.grouping("source").alias("overall"))


def eta(log: DataFrame, done: int, total: int) -> DataFrame:
    """Time left by the last two progress lines of each log (log, ordinal, value): minutes, or null where the lines don't tell."""
    p = r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}).*?(\d+)/(\d+) details"
    lines = log.select("log", "ordinal", F.try_to_timestamp(F.regexp_extract("value", p, 1)).alias("t"), F.regexp_extract("value", p, 2).try_cast("long").alias("n")).where("n is not null")
    # the last two lines of each log by a partial aggregate; only those are put in order
    last = lines.groupBy("log").agg(F.max_by(F.struct("t", "n"), "ordinal").alias("b"), F.max("ordinal").alias("o"))
    before = lines.join(last.select("log", "o"), "log").where("ordinal < o").groupBy("log").agg(F.max_by(F.struct("t", "n"), "ordinal").alias("a"))
    both = last.join(before, "log")
    seconds = F.unix_timestamp("b.t") - F.unix_timestamp("a.t")
    gained = F.col("b.n") - F.col("a.n")
    return both.select("log", F.when((seconds > 0) & (gained > 0), F.lit(total - done) * seconds / gained / 60).alias("minutes"))


def categories_of(progress: Column) -> Column:
    """The categories of a progress record (VARIANT), which are a list or a map of objects."""
    return F.coalesce(F.try_variant_get(progress, "$.categories", "array<variant>"), F.map_values(F.try_variant_get(progress, "$.categories", "map<string,variant>")), F.array().cast("array<variant>"))


def sizes(arrays: dict[str, Column]) -> list[Column]:
    """Lengths of list columns, 0 for null."""
    return [F.coalesce(F.size(c), F.lit(0)).alias(k) for k, c in arrays.items()]


def changes(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Difference of each row's value to the row before under the same key."""
    return df.withColumn("delta", F.col(value) - F.lag(value).over(Window.partitionBy(key).orderBy(order)))
