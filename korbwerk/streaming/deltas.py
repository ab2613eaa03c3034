"""Tables that grow by batches: deltas by key bucket under numbered manifests, merged when they are read.

A batch writes its rows to a folder of its own and then a manifest that names all folders of the table. Readers take the newest manifest, so they see whole batches only; a batch that runs again after a failure
overwrites its folder, and does nothing once its manifest is there. What a batch writes follows the batch, not the table. Rows lie by a hash of their key in `bucket` folders, so a batch that knows its keys reads
the buckets of those alone. `compact` writes all that is valid to one folder; folders that no kept manifest names are removed then.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from korbwerk.plans.checkpoint import remove

BUCKETS = 64
#: Manifests that stay when a table is compacted, the new one included: readers may still use them.
KEPT_MANIFESTS = 2


class Deltas:
    """A table of rows with key columns. Batches are numbered and come in order."""

    def __init__(self, spark: SparkSession, path: str, key: str | Iterable[str], buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path, [key] if isinstance(key, str) else list(key), buckets
        jvm = spark.sparkContext._jvm
        self._at = jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key[0]), F.lit(self.buckets)).cast("int")

    def names(self) -> list[str]:
        """Names of all manifests, in order: batch, then 0 for what the batch wrote and 1 for what a compaction after it wrote."""
        folder = self._at(f"{self.path}/manifests")
        return sorted(n for s in self._fs.listStatus(folder) if (n := s.getPath().getName()).endswith(".json")) if self._fs.exists(folder) else []

    def manifest(self, before: int | None = None) -> dict | None:
        """The newest manifest, or the newest of a batch before a given one."""
        names = [n for n in self.names() if before is None or int(n.split("-")[0]) < before]
        return self._load(names[-1]) if names else None

    def _load(self, name: str) -> dict:
        stream = self._fs.open(self._at(f"{self.path}/manifests/{name}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, name: str, content: dict) -> None:
        """A reader sees the manifest whole or not at all."""
        draft, final = self._at(f"{self.path}/manifests/{name}.draft"), self._at(f"{self.path}/manifests/{name}")
        stream = self._fs.create(draft, True)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        if not self._fs.rename(draft, final):
            raise OSError(f"could not commit {name} of {self.path}")

    def _write(self, folder: str, rows: DataFrame) -> None:
        # ranges split a bucket that holds many rows; few rows give few files
        rows.withColumn("bucket", self.bucket()).repartitionByRange("bucket", F.xxhash64(*rows.columns)).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/{folder}")

    def append(self, batch: int, rows: DataFrame, gone: dict[str, str] | None = None, mark: dict | None = None) -> None:
        """Adds a batch's rows. gone: values of columns; rows of earlier batches that have all of them go (J12). mark: what the manifest says besides, committed with the rows."""
        name = f"{batch:012d}-0.json"
        if name in self.names():
            return
        known = self.manifest(batch) or {"parts": [], "gone": []}
        self._write(f"delta={batch}", rows)
        self._commit(name, {"schema": json.loads(rows.schema.json()), "parts": [*known["parts"], [batch, f"delta={batch}"]], "gone": [*known["gone"], *([[batch, gone]] if gone else [])], "mark": mark})

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of the rows' keys."""
        return sorted(r.bucket for r in rows.select(self.bucket().alias("bucket")).distinct().collect())

    def read(self, before: int | None = None, buckets: list[int] | None = None, newest: bool = False) -> DataFrame | None:
        """Valid rows, with `v` (the batch), of some buckets or all. newest: of each key only the rows of its last batch."""
        found = self.manifest(before)
        if not found:
            return None
        rows, schema = None, StructType.fromJson(found["schema"]).add("bucket", IntegerType())
        for v, folder in found["parts"]:
            part = self.spark.read.schema(schema).option("basePath", f"{self.path}/data/{folder}").parquet(f"{self.path}/data/{folder}").withColumn("v", F.lit(v).cast("long"))
            rows = part if rows is None else rows.unionByName(part)
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(*buckets))
        for v, values in found["gone"]:
            same = F.lit(True)
            for c, value in values.items():
                same = same & F.col(c).eqNullSafe(F.lit(value))
            rows = rows.where(~same | (F.col("v") >= v))
        rows = rows.drop("bucket")
        if newest:
            last = rows.groupBy(*(F.col(c).alias(f"_{c}") for c in self.key)).agg(F.max("v").alias("_v"))
            same = F.col("v") == F.col("_v")
            for c in self.key:
                same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
            rows = rows.join(last, same, "left_semi")
        return rows

    def compact(self, newest: bool = False, drop: str | None = None) -> None:
        """Writes all valid rows to one folder. newest: of each key its last rows only, and without those for which `drop` is true then."""
        names = self.names()
        if not names or names[-1].endswith("-1.json"):
            return
        batch = int(names[-1].split("-")[0])
        found, rows = self._load(names[-1]), self.read(newest=newest)
        rows = rows.where(f"not ({drop})") if drop else rows
        self._write(f"base={batch}", rows.drop("v"))
        self._commit(f"{batch:012d}-1.json", {"schema": found["schema"], "parts": [[batch, f"base={batch}"]], "gone": [], "mark": found.get("mark")})
        names = self.names()
        kept = {folder for n in names[-KEPT_MANIFESTS:] for _, folder in self._load(n)["parts"]}
        for n in names[:-KEPT_MANIFESTS]:
            for _, folder in self._load(n)["parts"]:
                if folder not in kept:
                    remove(self.spark, f"{self.path}/data/{folder}")
            remove(self.spark, f"{self.path}/manifests/{n}")
