"""Sources (S1 to S6, S11, S15, S17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from korbwerk.functions.text import blank, filled, ustrip
from korbwerk.schema import LISTING, conform


def read_listings(spark: SparkSession, path: str, strict: bool = True, schema: StructType = LISTING) -> DataFrame:
    """JSON arrays of listings. Not strict: what can't be read is left out."""
    return conform(spark.read.option("multiLine", True).option("mode", "FAILFAST" if strict else "DROPMALFORMED").schema(schema).json(path))


def newest_exports(spark: SparkSession, path: str, schema: StructType = LISTING) -> tuple[DataFrame, DataFrame]:
    """Of each category the newest export file, and the table of files (category, path). A file's category is that of its first row, else its name. Adds `ordinal`."""
    rows = spark.read.option("multiLine", True).option("mode", "DROPMALFORMED").schema(schema).json(path).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_modification_time").alias("_time"), F.monotonically_increasing_id().alias("_row"))
    first = rows.groupBy("_file").agg(F.min_by("category_id", "_row").alias("_c"), F.max("_time").alias("_time"))
    stem = F.regexp_extract("_file", r"([^/]+?)(?:\.[^./]*)?$", 1)
    named = first.select("_file", "_time", F.when(filled(F.col("_c")), F.col("_c")).otherwise(stem).alias("category_id"))
    files = named.groupBy("category_id").agg(F.max_by("_file", F.struct("_time", "_file")).alias("path"))
    kept = rows.join(files.select(F.col("path").alias("_file")), "_file", "left_semi")
    return conform(kept).withColumn("ordinal", F.monotonically_increasing_id()), files


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Edited workflow columns of an export, the last row of each id; rows without an edit are left out. A byte order mark is no part of the first name."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    raw = raw.toDF(*(c.lstrip("﻿") for c in raw.columns)).withColumn("_row", F.monotonically_increasing_id())
    rows = raw.select(ustrip(F.col("id_referensi")).alias("referenznummer"), ustrip(F.col("status_lamaran")).alias("status_lamaran"), ustrip(F.col("prioritas")).alias("prioritas"), "_row")
    last = rows.where("referenznummer <> '' and (status_lamaran <> '' or prioritas <> '')").groupBy("referenznummer").agg(F.max_by(F.struct("status_lamaran", "prioritas"), "_row").alias("v"))
    return last.select("referenznummer", "v.*")


def first_existing(spark: SparkSession, *paths: str) -> str | None:
    """The first path that is there, on whatever store Spark reads."""
    jvm = spark.sparkContext._jvm
    for p in paths:
        at = jvm.org.apache.hadoop.fs.Path(p)
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return p
    return None


def categories(rows: DataFrame) -> DataFrame:
    """Categories that aren't marked as duplicates, the first of each id."""
    own = rows.where(blank(F.col("duplicate_of")) == "")
    return own.groupBy("id").agg(F.min_by(F.struct(*own.columns), "ordinal").alias("_row")).select("_row.*")


def failed_urls(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Distinct URLs that log lines report as failed, in order of the log."""
    found = spark.read.text(path).select(F.regexp_extract("value", pattern, 1).alias("url"), F.monotonically_increasing_id().alias("ordinal")).where("url <> ''")
    return found.groupBy("url").agg(F.min("ordinal").alias("ordinal"))


def detail_address(ref: Column) -> Column:
    """The part of a detail URL that names a listing."""
    return F.base64(F.encode(ref, "UTF-8"))
