"""The master kept by batches: the ordered filter (J1, J2, J4) as a stream, the shared merge of a source's run (J11), refresh of a source (J12), and winners of duplicate groups kept as they change."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from korbwerk.functions.text import blank, ustrip
from korbwerk.operators import dedup
from korbwerk.plans.checkpoint import materialise
from korbwerk.streaming.deltas import BUCKETS, Deltas


def key_rows(keyed: DataFrame) -> DataFrame:
    """ordinal and k for each key of each row. keyed: of dedup.with_keys."""
    pairs = F.array(*(F.when(F.col(f"_{k}").isNotNull(), F.concat(F.lit(f"{k}:"), F.col(f"_{k}"))) for k in dedup.KEYS))
    return keyed.select("ordinal", F.explode(F.array_compact(pairs)).alias("k"))


class Master:
    """Accepted rows, their keys and the tokens of their links, each as a table of deltas under `path`.

    A batch is filtered against the keys' buckets that its own keys fall into; the accepted rows of earlier batches aren't read. (A row is accepted by all of its keys together, so no grouping by one key can
    hold the filter's state; the key sets are looked up first, then the batch is filtered in order, then the accepted rows' keys are added.) Every table reads the state before the batch, so a batch that
    runs again gives the same rows, whatever it had written.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, links: bool = False):
        self.links = links
        self.rows, self.keys, self.tokens = Deltas(spark, f"{path}/rows", "ordinal", buckets), Deltas(spark, f"{path}/keys", "k", buckets), Deltas(spark, f"{path}/tokens", "token", buckets)

    def unseen(self, batch: int, new: DataFrame) -> DataFrame:
        """Rows with their keys, but for those one of whose keys (or, with `links`, one of whose links) the master has."""
        keyed = materialise(dedup.with_keys(new))
        flat = key_rows(keyed)
        known = self.keys.read(before=batch, buckets=self.keys.touched(flat))
        if known is not None:
            keyed = keyed.join(flat.join(known.select("k").distinct(), "k", "left_semi").select("ordinal").distinct(), "ordinal", "left_anti")
        tokens = self.tokens.read(before=batch) if self.links else None
        return keyed.join(dedup.holds_token(keyed, tokens.select("token").distinct()), "ordinal", "left_anti") if tokens is not None else keyed

    def merge(self, batch: int, new: DataFrame, finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """Adds the batch's rows that neither the master nor an accepted earlier row has, after `finish` (columns that are derived), and gives them."""
        left = materialise(self.unseen(batch, new))
        accepted = materialise(left.join(dedup.greedy(left), "ordinal", "left_semi"))
        self.keys.append(batch, key_rows(accepted).select("k").distinct())
        if self.links:
            self.tokens.append(batch, dedup.url_tokens(accepted))
        unique = accepted.select(*new.columns)
        unique = materialise(finish(unique)) if finish else unique
        self.rows.append(batch, unique)
        return unique

    def snapshot(self) -> DataFrame | None:
        rows = self.rows.read()
        return rows.drop("v") if rows is not None else None

    def compact(self) -> None:
        for table in (self.rows, self.keys, self.tokens):
            table.compact()


def run_of_source(batch: int, run: DataFrame, master: Master, enrich: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """A source's run: duplicates within it go, then what the master has, the rest is enriched and added. Gives the added rows."""
    own, _ = dedup.deduplicate(run)
    return master.merge(batch, own, enrich)


def ingest_runs(spark: SparkSession, landing: str, schema: StructType, path: str, checkpoint: str, enrich: Callable[[DataFrame], DataFrame] | None = None, links: bool = True, source: str = "parquet", files: int | None = None) -> StreamingQuery:
    """J11 as a stream: landing files are read once each, `files` in a batch, and merged into the master under `path`. Stops when all that is there has been read; a restart goes on."""

    def step(run: DataFrame, number: int) -> None:
        run_of_source(number, run, Master(run.sparkSession, path, links=links), enrich)

    stream = spark.readStream.schema(schema).format(source)
    stream = stream.option("maxFilesPerTrigger", files) if files else stream
    return stream.load(landing).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Winners:
    """W1 to W4 and A8, kept as rows come: what `dedup.deduplicate` keeps of all rows so far, from the groups that a batch touches.

    `best` has for each reference (or hash, where there is no reference) its winner, with the size of its group and the least and largest category; `near` has these winners by their near key; `kept` has for
    each winner so far whether it is still one and is kept. Only orders, ordinals and keys are stored. A batch reads the buckets of its own keys, and of the near keys of winners that came or went.
    """

    ORDER = "struct<p:int,n:int,t:string,o:bigint>"

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.best, self.near, self.kept = (Deltas(spark, f"{path}/{name}", key, buckets) for name, key in (("best", "k"), ("near", ("near", "k")), ("kept", "ordinal")))

    def add(self, batch: int, rows: DataFrame, priorities: dict[str, int] | None = None) -> None:
        ref = ustrip(F.col("referenznummer"))
        own = rows.select(F.when(ref != "", F.concat(F.lit("r:"), ref)).otherwise(F.concat(F.lit("h:"), dedup.secondary_key())).alias("k"), dedup.rank(priorities).cast(self.ORDER).alias("order"), F.coalesce(dedup.near_key(), F.lit("")).alias("near"), ref.alias("ref"), blank(F.col("category_id")).alias("category"))
        fresh = own.groupBy("k").agg(F.max(F.struct("order", "near", "ref")).alias("w"), F.count("*").alias("size"), F.min("category").alias("low"), F.max("category").alias("high"))
        fresh = materialise(fresh.select("k", "w.*", "size", "low", "high"))
        stored = self.best.read(before=batch, buckets=self.best.touched(fresh), newest=True)
        before = stored.drop("v").join(fresh.select("k"), "k", "left_semi") if stored is not None else fresh.limit(0)
        before = materialise(before)
        after = before.unionByName(fresh).groupBy("k").agg(F.max(F.struct("order", "near", "ref")).alias("w"), F.sum("size").alias("size"), F.min("low").alias("low"), F.max("high").alias("high"))
        after = materialise(after.select("k", "w.*", "size", "low", "high"))
        # winners that went, and those that came
        old = before.select("k", F.col("order").alias("_order"), F.col("near").alias("_near"), F.col("ref").alias("_ref"))
        moved = after.join(old, "k", "left").where(F.col("_order").isNull() | (F.col("_order") != F.col("order")))
        came = moved.select("near", "k", "order", "ref", F.lit(False).alias("gone"))
        went = moved.where("_order is not null and _near <> near").select(F.col("_near").alias("near"), "k", F.col("_order").alias("order"), F.col("_ref").alias("ref"), F.lit(True).alias("gone"))
        change = materialise(came.unionByName(went))
        status = self._status(batch, change)
        lost = moved.where("_order is not null").select(F.col("_order.o").alias("o"))
        out = status.unionByName(lost.select((-F.col("o")).alias("ordinal"), F.lit(False).alias("kept"), F.lit(None).cast("string").alias("near")))
        self.kept.append(batch, materialise(out))
        self.near.append(batch, change.where("near <> ''"))
        self.best.append(batch, after)

    def _status(self, batch: int, change: DataFrame) -> DataFrame:
        """ordinal, kept and near of all winners in near groups that changed."""
        stored = self.near.read(before=batch, buckets=self.near.touched(change.where("near <> ''")), newest=True)
        members = change
        if stored is not None:
            others = stored.drop("v").join(change.select("near").where("near <> ''").distinct(), "near", "left_semi").join(change.select("near", "k"), ["near", "k"], "left_anti")
            members = members.unionByName(others.select(*change.columns))
        members = materialise(members.where("not gone"))
        groups = members.where("near <> ''").groupBy("near").agg(F.max("order").alias("top"), F.count("*").alias("n"), (F.min("ref") != F.max("ref")).alias("refs")).where("n > 1 and refs").select(F.col("near").alias("_near"), "top")
        return members.join(groups, F.col("near") == F.col("_near"), "left").select((-F.col("order.o")).alias("ordinal"), (F.col("top").isNull() | (F.col("top") == F.col("order"))).alias("kept"), "near")

    def ordinals(self) -> DataFrame:
        """Ordinals of the rows that are kept."""
        return self.kept.read(newest=True).where("kept").select("ordinal")

    def stats(self) -> DataFrame:
        """One row of counts, as dedup.deduplicate gives it."""
        best, kept = self.best.read(newest=True), self.kept.read(newest=True)
        by_ref, more = F.col("k").startswith("r:"), F.col("size") - 1
        cross = F.col("low") != F.col("high")
        parts = {
            "input_total": F.col("size"), "removed_by_refnr_cross_category": F.when(by_ref & cross, more), "removed_by_refnr_within_category": F.when(by_ref & ~cross, more), "removed_by_secondary_key": F.when(~by_ref, more),
            "removed_by_near_duplicate": F.lit(0).cast("long"),
        }
        counts = best.select(*(x.cast("long").alias(c) for c, x in parts.items())).unionByName(
            kept.where("not kept and near is not null").select(*(F.lit(1 if c == "removed_by_near_duplicate" else 0).cast("long").alias(c) for c in parts))
        )
        total = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in parts))
        removed = reduce(lambda a, b: a + b, (F.col(c) for c in parts if c.startswith("removed")))
        return total.withColumn("output_total", F.col("input_total") - removed)
