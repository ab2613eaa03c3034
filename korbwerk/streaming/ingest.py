"""Incremental ingest of landing files (J7, J11): Structured Streaming with a merge for each micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from korbwerk.sources.readers import first_existing


def ingest(spark: SparkSession, landing: str, schema: StructType, master: str, checkpoint: str, merge: Callable[[DataFrame | None, DataFrame], DataFrame], source: str = "parquet") -> StreamingQuery:
    """Reads new landing files once each and merges them into the master.

    Every batch writes a new version of the master, `master/v=<batch>`, and reads the one before, so a batch that runs again after a failure gives the same version. Stops when all files that are there have been read.
    """

    def step(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        known = first_existing(session, *(f"{master}/v={n}" for n in range(number - 1, -1, -1)))
        merge(session.read.parquet(known) if known else None, batch).write.mode("overwrite").parquet(f"{master}/v={number}")

    stream = spark.readStream.schema(schema).format(source).load(landing)
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, by: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Counts of events in tumbling windows; events later than `late` are dropped by the watermark."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), by, "n")


def first_seen(events: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """The first event of each key within the watermark's reach."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
