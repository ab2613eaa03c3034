"""Completeness and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korbwerk.functions.text import blank, filled, filled_number, ustrip


def is_filled(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    return filled(F.col(name)) if kind == "string" else F.coalesce(F.col(name), F.lit(False)) if kind == "boolean" else filled_number(F.col(name)) if kind in ("int", "bigint", "double", "float", "smallint", "tinyint") else F.col(name).isNotNull()


def completeness(df: DataFrame, fields: list[str], by: list[str] | None = None) -> DataFrame:
    """For each group and field the rows, the filled rows and their share in percent (one digit, half to even). One pass, then a small unpivot."""
    wide = df.groupBy(*(by or [])).agg(F.count("*").alias("n_rows"), *(F.count_if(is_filled(df, f)).alias(f) for f in fields))
    long = wide.unpivot([*(by or []), "n_rows"], fields, "field", "n_filled")
    return long.withColumn("pct", F.when(F.col("n_rows") > 0, F.bround(F.col("n_filled") * 100 / F.col("n_rows"), 1)).otherwise(F.lit(0.0)))


def completeness_sets(df: DataFrame, fields: list[str], by: list[str]) -> DataFrame:
    """Completeness for each value of each column in `by` and for all rows, as grouping sets in one pass. `grp` names the column (or "all"), `val` its value."""
    counts = [F.count("*").alias("n_rows"), *(F.count_if(F.col(f"_f_{f}")).alias(f) for f in fields)]
    flagged = df.select(*by, *(is_filled(df, f).alias(f"_f_{f}") for f in fields))
    grouped = flagged.groupingSets([*([F.col(b)] for b in by), []], *by).agg(*counts, F.grouping_id(*by).alias("_g"))
    top = (1 << len(by)) - 1
    grp, val = F.lit("all"), F.lit(None).cast("string")
    for i, b in enumerate(by):
        own = F.col("_g") == top - (1 << (len(by) - 1 - i))
        grp, val = F.when(own, b).otherwise(grp), F.when(own, F.col(b).cast("string")).otherwise(val)
    wide = grouped.select(grp.alias("grp"), val.alias("val"), "n_rows", *fields)
    return wide.unpivot(["grp", "val", "n_rows"], fields, "field", "n_filled").withColumn("pct", F.bround(F.col("n_filled") * 100 / F.col("n_rows"), 1))


def mean_completeness(long: DataFrame, by: list[str]) -> DataFrame:
    """A4: mean of the (rounded) shares of a group's fields."""
    return long.groupBy(*by).agg(F.bround(F.avg("pct"), 1).alias("mean_pct"))


def link_coverage(df: DataFrame) -> DataFrame:
    """How many listings have which way to apply."""
    external, portal, email = filled(F.col("link_bewerbung_externe")), filled(F.col("ba_job_url")), filled(F.col("alamat_email_bewerbung"))
    site = filled(F.col("link_website_perusahaan_resmi"))
    return df.agg(F.count("*").alias("total"), F.count_if(external).alias("with_external"), F.count_if(portal).alias("with_portal"), F.count_if(email).alias("with_email"), F.count_if(site).alias("with_site"), F.count_if(external & portal).alias("with_both"))


def uniqueness(best: DataFrame) -> DataFrame:
    """From best_per_company(): listings, companies, skipped listings, companies with several."""
    return best.agg(F.coalesce(F.sum("n_listings"), F.lit(0)).alias("input_total"), F.count("*").alias("unique_companies"), F.coalesce(F.sum(F.col("n_listings") - 1), F.lit(0)).alias("skipped_duplicates"), F.count_if(F.col("n_listings") > 1).alias("companies_with_multiple_listings"))


def success(df: DataFrame, by: list[str]) -> DataFrame:
    """Totals of progress rows and the share of successes, null where nothing was tried."""
    sums = df.groupBy(*by).agg(*(F.sum(c).alias(c) for c in ("scraped", "failed", "skipped")))
    return sums.withColumn("success_rate", F.try_divide(F.col("scraped"), F.col("scraped") + F.col("failed") + F.col("skipped")))


def application_stats(df: DataFrame) -> DataFrame:
    """Applications by state, those with a contact and those of portals only. df: bewerbung_status, ansprechpartner (name, email), portal_only."""
    state = F.coalesce("bewerbung_status", F.lit("pending")).alias("bewerbung_status")
    reached = (blank(F.col("ansprechpartner.name")) != "") | (blank(F.col("ansprechpartner.email")) != "")
    return df.groupBy(state).agg(F.count("*").alias("n"), F.count_if(reached).alias("with_contact"), F.count_if(F.coalesce("portal_only", F.lit(False))).alias("portal_only"))


def run_state(done: Column, total: Column, running: Column) -> Column:
    """A19."""
    return F.when(running, "RUNNING").when((total > 0) & (done >= total), "DONE").when(done > 0, "PARTIAL").otherwise("IDLE")


def contact_gaps(name: Column, email: Column, phone: Column, found_name: Column, found_email: Column, found_phone: Column) -> Column:
    """Which parts of a contact were missing, found, and are still missing."""
    parts = (("name", name, found_name), ("email", email, found_email), ("telefon", phone, found_phone))

    def those(test) -> Column:
        return F.filter(F.array(*(F.when(test(a, b), F.lit(k)) for k, a, b in parts)), lambda x: x.isNotNull())

    return F.struct(those(lambda a, b: ~filled(a)).alias("fehlend_vorher"), those(lambda a, b: ~filled(a) & filled(b)).alias("gefunden"), those(lambda a, b: ~filled(a) & ~filled(b)).alias("noch_fehlend"))


def value_counts(df: DataFrame, *by: str) -> DataFrame:
    """Rows by value, blanks as "unknown"."""
    return df.groupBy(*(F.when(ustrip(F.col(b).cast("string")) == "", "unknown").otherwise(blank(F.col(b).cast("string"))).alias(b) for b in by)).agg(F.count("*").alias("n"))
