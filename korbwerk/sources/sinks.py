"""Sinks (K1 to K10, K12, K14)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Protocol
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from korbwerk.functions.text import blank, file_slug
from korbwerk.schema import EXPORT_COLUMNS, JOB_TYPES, LISTING_COLUMNS

#: Cells that a spreadsheet holds at most.
SHEET_CELLS = 10_000_000


class Tab(Protocol):
    """A tab of a spreadsheet, as a client library gives it."""

    def clear(self) -> object: ...

    def append_rows(self, values: list[list], value_input_option: str) -> object: ...


def text_or_blank(c: Column, kind: str) -> Column:
    """A value as export text: null, 0 and false are blank."""
    if kind in ("int", "bigint"):
        return F.when(F.coalesce(c, F.lit(0)) == 0, "").otherwise(c.cast("string"))
    return F.when(F.coalesce(c, F.lit(False)), "True").otherwise("") if kind == "boolean" else blank(c.cast("string"))


def export_rows(df: DataFrame) -> DataFrame:
    """K7: the columns of the workflow export under their headers."""
    kinds = dict(df.dtypes)
    return df.select(*(text_or_blank(F.col(c), kinds[c]).alias(h) for c, h in EXPORT_COLUMNS))


def write_excel(df: DataFrame, path: str) -> None:
    """K7: the workflow export as CSV that spreadsheets read: one file whose first character, in the first header, is the byte order mark."""
    rows = export_rows(df)
    rows.withColumnRenamed(rows.columns[0], f"\ufeff{rows.columns[0]}").coalesce(1).write.mode("overwrite").options(header=True, escape='"', emptyValue="").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """K1: one JSON object a line, in the canonical columns if it has them."""
    own = set(df.columns)
    (df.select(*LISTING_COLUMNS) if own.issuperset(LISTING_COLUMNS) else df).write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """K2: CSV with a header; blanks stay blank."""
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def write_by_category(df: DataFrame, path: str) -> None:
    """K4: one folder for each category. Ranges split a category that holds many rows; few rows give few files."""
    spread = [c for c, t in df.dtypes if "map<" not in t and "variant" not in t]
    df.repartitionByRange("category_id", F.xxhash64(*spread)).write.mode("overwrite").partitionBy("category_id").json(path)


def write_by_city(df: DataFrame, path: str) -> None:
    """K6: one folder for each city's slug; cities of one slug share it."""
    rows = export_rows(df).withColumn("city", file_slug(F.col("kota")))
    rows.write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').partitionBy("city").csv(path)


def write_by_type(df: DataFrame, path: str) -> None:
    """K5, Q8: one folder for each job type, empty ones too; types that aren't known go to fi_other."""
    kind = F.when(F.col("beruf_typ").isin(*JOB_TYPES), F.col("beruf_typ")).otherwise("fi_other")
    for t in JOB_TYPES:
        write_csv(export_rows(df.where(kind == t)), f"{path}/{t}")


def _pointers(spark: SparkSession, folder: str, name: str):
    """File system, path class and numbers of an alias's pointers, in order."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    home = at(f"{folder}/{name}.alias")
    fs = home.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(home)] if fs.exists(home) else []
    return fs, at, sorted(int(n) for n in names if n.isdigit())


def publish(df: DataFrame, folder: str, name: str, stamp: str) -> str:
    """K3: writes a snapshot `name_stamp` and then points the alias `name` at it.

    A pointer is a small file with a number, put in place by a rename; readers follow the largest number, so between two publishes they always find a whole snapshot, and one that fails before its pointer is there changes nothing.
    A stamp that was published already gets a folder of its own, beside the one that readers may still use.
    """
    spark = df.sparkSession
    fs, at, numbers = _pointers(spark, folder, name)
    number = numbers[-1] + 1 if numbers else 1
    target = f"{folder}/{name}_{stamp}"
    target = f"{target}-{number}" if fs.exists(at(target)) else target
    df.write.mode("overwrite").parquet(target)
    draft = at(f"{folder}/{name}.alias/{uuid4().hex}.draft")
    stream = fs.create(draft, True)
    stream.write(bytearray(target.encode()))
    stream.close()
    final = lambda n: at(f"{folder}/{name}.alias/{n}")
    while fs.exists(final(number)):  # another publish took it
        number += 1
    if not fs.rename(draft, final(number)):
        raise OSError(f"could not point {name} at {target}")
    return target


def read_alias(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The snapshot that an alias points at."""
    fs, at, numbers = _pointers(spark, folder, name)
    stream = fs.open(at(f"{folder}/{name}.alias/{numbers[-1]}"))
    try:
        return spark.read.parquet(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def write_tab(df: DataFrame, tab: Tab, block: int = 5000) -> int:
    """K8: a tab cleared and filled with a header and the rows, unparsed, nulls blank; `block` rows at a time, so the driver holds no more than a partition. More than SHEET_CELLS cells are an error, before anything is cleared."""
    n = df.count()
    if (n + 1) * len(df.columns) > SHEET_CELLS:
        raise ValueError(f"{n} rows don't fit in a tab")
    tab.clear()
    held: list[list] = [df.columns]
    for row in df.toLocalIterator():
        held.append(["" if v is None else v for v in row])
        if len(held) >= block:
            tab.append_rows(held, value_input_option="RAW")
            held = []
    if held:
        tab.append_rows(held, value_input_option="RAW")
    return n


def counted(df: DataFrame, done: Column, write: Callable[[DataFrame], None]) -> tuple[int, int]:
    """How many of the rows that `write` writes are done, and how many there are, observed while they are written: no second pass."""
    seen = Observation()
    write(df.observe(seen, F.count_if(done).alias("done"), F.count("*").alias("total")))
    return seen.get["done"], seen.get["total"]


def write_status(spark: SparkSession, path: str, state: str, done: int, total: int, workers: int, target: str, at: str, last: str = "") -> None:
    """The state of a run as lines `name=value` in one small file, on whatever store Spark writes."""
    share = 100 * done / total if total else 0.0
    said = [f"state={state}", f"updated_utc={at}", f"progress={done}/{total} ({share:.1f}%)", f"workers={workers}", f"target={target}", *([f"last_ref={last}"] if last else [])]
    spark.createDataFrame([(line,) for line in said], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """The lines of write_status() as name and value."""
    at = F.locate("=", "value")
    return spark.read.text(path).select(F.substring("value", F.lit(1), at - 1).alias("name"), F.substring("value", at + 1, F.length("value")).alias("value"))


def upsert_progress(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """K9: progress rows by category, fresh ones instead of stored ones, and a row `total` that sums them."""
    rows = stored.where("category_id <> 'total'").join(fresh.select("category_id"), "category_id", "left_anti").unionByName(fresh.select(*stored.columns))
    sums = [c for c, t in stored.dtypes if t in ("int", "bigint")]
    total = rows.agg(*(F.sum(c).cast(dict(stored.dtypes)[c]).alias(c) for c in sums)).select(*(F.col(c) if c in sums else F.lit("total" if c == "category_id" else None).cast(dict(stored.dtypes)[c]).alias(c) for c in stored.columns))
    return rows.unionByName(total)


def reference_index(df: DataFrame) -> DataFrame:
    """Reference to company and city, as a table keyed by reference; at most one row each."""
    return df.groupBy("referenznummer").agg(F.min_by(F.struct("nama_perusahaan", "posisi_kota"), "ordinal").alias("v")).select("referenznummer", "v.*")


def markdown(df: DataFrame, columns: list[str], most: int = 1000) -> str:
    """A small report table as Markdown. `most` bounds what a report prints."""
    rows = df.select(*(F.col(c).cast("string") for c in columns)).limit(most).collect()
    return reduce(lambda a, r: a + "| " + " | ".join(x or "" for x in r) + " |\n", rows, "| " + " | ".join(columns) + " |\n|" + "-|" * len(columns) + "\n")
