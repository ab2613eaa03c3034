"""Orders, best of groups and top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from korbwerk.functions.classify import apprenticeship
from korbwerk.functions.text import blank, company_stem, filled, ustrip
from korbwerk.schema import JOB_TYPES, lookup


def type_rank(c: Column) -> Column:
    """Place of a job type; 9 for any other."""
    return lookup({t: i + 1 for i, t in enumerate(JOB_TYPES)}, F.lower(ustrip(c)), len(JOB_TYPES) + 1)


def canonical_order(df: DataFrame) -> list[Column]:
    """O1: apprenticeships first, then job type, score from high to low, city, company, reference."""
    kind = apprenticeship(F.col("angebotsart")) if "angebotsart" in df.columns else F.lit(True)
    return [F.when(kind, 0).otherwise(1), type_rank(F.col("beruf_typ")), -F.coalesce(F.col("kelengkapan_score"), F.lit(0)), F.lower(blank(F.col("posisi_kota"))), F.lower(blank(F.col("nama_perusahaan"))), blank(F.col("referenznummer"))]


def best_per_company(df: DataFrame, by_city: bool = False) -> DataFrame:
    """The best listing of each company (or company and city): target type, e-mail, score, first. Listings without a company stand alone. Adds `n_listings`."""
    stem = company_stem(F.col("nama_perusahaan"))
    key = F.when(stem == "", F.concat(F.lit("__unknown__:"), blank(F.col("referenznummer")))).otherwise(stem)
    key = F.struct(key, F.lower(ustrip(F.col("posisi_kota")))) if by_city else key
    order = F.struct((F.col("beruf_typ") == "ae").cast("int"), filled(F.col("alamat_email_bewerbung")).cast("int"), F.coalesce("kelengkapan_score", F.lit(0)), -F.col("ordinal"))
    best = df.groupBy(key.alias("_key")).agg(F.max_by("ordinal", order).alias("ordinal"), F.count("*").alias("n_listings"))
    return df.join(best.drop("_key"), "ordinal").select(*df.columns, "n_listings")


def top_per_group(df: DataFrame, group: list[str], order: list[Column], most: int) -> DataFrame:
    """The first `most` rows of each group, with their place `rank`. The limit by place lets Spark cut each task's groups before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= most)


def viewer_order(mode: str, query: bool = False) -> list[Column]:
    """Sort columns of the viewer: relevance first if there is a query; by type, score, city or company, the latter two as German dictionaries sort; then input order."""
    score = F.coalesce("kelengkapan_score", F.lit(0))
    modes = {
        "spec-priority": [type_rank(F.col("beruf_typ")), -score], "score-desc": [-score], "score-asc": [score], "city": [F.collate(blank(F.col("posisi_kota")), "de")], "company": [F.collate(blank(F.col("nama_perusahaan")), "de")],
    }
    return [*([F.desc("score")] if query else []), *modes.get(mode, []), F.col("ordinal")]


def pilot(df: DataFrame, kind: str | None, most: int) -> DataFrame:
    """Listings with an e-mail, of one type, best scores first."""
    rows = df.where(filled(F.col("alamat_email_bewerbung")))
    rows = rows.where(F.col("beruf_typ") == kind) if kind else rows
    return rows.orderBy(F.desc("kelengkapan_score"), "ordinal").limit(most)
