"""Merging snapshots, state and caches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korbwerk.functions.text import blank, filled


def latest(df: DataFrame, keys: list[str], order: Column | str) -> DataFrame:
    """The row of each key with the highest order, by a partial aggregate."""
    c = F.col(order) if isinstance(order, str) else order
    return df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), c).alias("_row")).select("_row.*")


def append_new(current: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """The current rows and those of `more` whose key they don't have, the first of each key."""
    fresh = more.join(current.select(key).distinct(), key, "left_anti")
    first = fresh.groupBy(key).agg(F.min_by(F.struct(*fresh.columns), "ordinal").alias("_row")).select("_row.*")
    return current.unionByName(first.select(*current.columns))


def upsert_state(stored: DataFrame, fresh: DataFrame, key: str, state: list[str]) -> DataFrame:
    """Fresh rows win, but a stored state that isn't blank stays; rows that are only stored stay."""
    old = stored.select(*(F.col(c).alias(f"_old_{c}") for c in stored.columns))
    joined = fresh.withColumn("_fresh", F.lit(True)).join(old, F.col(key) == F.col(f"_old_{key}"), "full_outer")
    out = []
    for c in stored.columns:
        new, was = (F.col(c) if c in fresh.columns else F.lit(None)), F.col(f"_old_{c}")
        kept = F.when(filled(was.cast("string")), was).otherwise(new) if c in state else F.when(F.col("_fresh"), new).otherwise(was)
        out.append(kept.alias(c))
    return joined.select(*out)


def refresh_source(master: DataFrame, run: DataFrame, of_source: Column) -> DataFrame:
    """All rows of the source go, the run's rows come."""
    return master.where(~F.coalesce(of_source, F.lit(False))).unionByName(run.select(*master.columns))


def fill_from(df: DataFrame, cards: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Blanks are filled from the card of the same key."""
    side = cards.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_card_{c}") for c in columns))
    joined = df.join(side, F.col(key) == F.col("_key"), "left")
    return joined.withColumns({c: F.when(filled(F.col(c)), F.col(c)).otherwise(blank(F.col(f"_card_{c}"))) for c in columns}).select(*df.columns)


def override(df: DataFrame, values: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Values that aren't blank replace the row's own."""
    side = values.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_own_{c}") for c in columns))
    joined = df.join(side, F.col(key) == F.col("_key"), "left")
    return joined.withColumns({c: F.coalesce(F.when(filled(F.col(f"_own_{c}").cast("string")), F.col(f"_own_{c}")), F.col(c)) for c in columns}).select(*df.columns)


def pending(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Wanted rows that aren't done."""
    return wanted.join(done.select(key).distinct(), key, "left_anti")


def of_refs(df: DataFrame, refs: list[str]) -> DataFrame:
    """the rows of the given references."""
    return df.where(F.col("referenznummer").isin(*refs)) if refs else df.limit(0)


def flag_known(df: DataFrame, index: DataFrame, key: str = "referenznummer") -> DataFrame:
    """Df with `is_enriched`: whether the index has the row's key."""
    known = index.select(F.col(key).alias("_key"), F.lit(True).alias("_is")).where("_key is not null").distinct()
    return df.join(known, F.col(key) == F.col("_key"), "left").withColumn("is_enriched", F.coalesce("_is", F.lit(False))).drop("_key", "_is")
