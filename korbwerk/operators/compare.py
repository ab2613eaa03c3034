"""Two snapshots of a table compared by digests of key buckets.

A snapshot's rows lie by a hash of their key in `bucket` folders. Beside each row stand a hash of its content and which fields are filled; each bucket's counts and the sum and exclusive or of its hashes
are kept apart, so counts before and after read no row at all, and changes read the hashes of those buckets alone whose sums differ. Sums don't depend on the order of rows. Equal hashes of 64 bits count as equal content.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, MapType, StructType, VariantType

from korbwerk.operators.audit import is_filled

BUCKETS = 64
_DIGESTS = "bucket int, grp string, n long, total decimal(38,0), mixed long, filled array<long>"


def content_hash(df: DataFrame) -> Column:
    """A hash of all columns of a row. Hashes pass over nulls, so where a null stands is hashed too; nested values are hashed as JSON that names theirs."""
    parts = []
    for f in df.schema:
        value = F.col(f"`{f.name}`")
        nested = isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))
        parts += [value.isNull(), F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"}) if nested else value]
    return F.xxhash64(*parts)


class Snapshots:
    """Named snapshots of one table under a folder that all executors share. group: the column that counts are kept by; fields: those whose filled values are counted.

    Nulls are keys and groups like any others, keys may repeat, and a snapshot may be empty. All snapshots that are compared have the same key, group, fields and number of buckets.
    """

    def __init__(self, spark: SparkSession, path: str, key: str | Iterable[str], group: str, fields: Sequence[str] = (), buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.group, self.fields, self.buckets = spark, path, [key] if isinstance(key, str) else list(key), group, list(fields), buckets

    def write(self, name: str, rows: DataFrame) -> None:
        """Writes rows, then their digests; a snapshot without digests isn't there."""
        keys = F.struct(*(F.col(k) for k in self.key))
        flags = F.array(*(is_filled(rows, f) for f in self.fields)) if self.fields else F.array().cast("array<boolean>")
        kept = rows.select(
            F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int").alias("bucket"), keys.alias("key"), F.col(self.group).cast("string").alias("grp"), content_hash(rows).alias("hash"), flags.alias("filled"), F.struct(*rows.columns).alias("row")
        )
        # ranges split a bucket that holds many rows
        kept.repartitionByRange("bucket", "hash").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}/rows")
        self.spark.createDataFrame([(kept.drop("bucket").schema.json(),)], "value string").write.mode("overwrite").text(f"{self.path}/{name}/schema")
        counts = F.array(*(F.count_if(F.get("filled", F.lit(i))) for i in range(len(self.fields)))) if self.fields else F.array().cast("array<long>")
        sums = [F.count("*").alias("n"), F.sum(F.col("hash").cast("decimal(28,0)")).alias("total"), F.bit_xor("hash").alias("mixed"), counts.alias("filled")]
        self._rows(name).groupBy("bucket", "grp").agg(*sums).write.mode("overwrite").parquet(f"{self.path}/{name}/digests")

    def _rows(self, name: str) -> DataFrame:
        schema = StructType.fromJson(json.loads(self.spark.read.text(f"{self.path}/{name}/schema").first()[0])).add("bucket", IntegerType())
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}/rows")

    def _digests(self, name: str, after: bool) -> DataFrame:
        return self.spark.read.schema(_DIGESTS).parquet(f"{self.path}/{name}/digests").withColumn("after", F.lit(after))

    def read(self, name: str) -> DataFrame:
        """The rows as they were written."""
        return self._rows(name).select("row.*")

    def counts(self, before: str, after: str, by_group: bool = True) -> DataFrame:
        """Rows, filled rows and their share (percent, one digit, half to even) of each field, before and after; of each group that either has, or of all rows. Reads digests only."""
        both = self._digests(before, False).unionByName(self._digests(after, True))
        sides = (("before", ~F.col("after")), ("after", F.col("after")))
        sums = [F.coalesce(F.sum(F.when(of, F.col("n"))), F.lit(0)).cast("long").alias(f"n_{side}") for side, of in sides]
        sums += [F.coalesce(F.sum(F.when(of, F.get("filled", F.lit(i)))), F.lit(0)).cast("long").alias(f"f{i}_{side}") for i in range(len(self.fields)) for side, of in sides]
        wide = both.groupBy(*(["grp"] if by_group else [])).agg(*sums)
        each = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), *(F.col(f"f{i}_{side}").alias(f"filled_{side}") for side, _ in sides)) for i, f in enumerate(self.fields)))).alias("x")
        long = wide.select(*([F.col("grp").alias(self.group)] if by_group else []), "n_before", "n_after", each).select(*([self.group] if by_group else []), "n_before", "n_after", "x.*")
        return long.withColumns({f"pct_{side}": F.when(F.col(f"n_{side}") > 0, F.bround(F.col(f"filled_{side}") * 100 / F.col(f"n_{side}"), 1)).otherwise(F.lit(0.0)) for side, _ in sides})

    def differing(self, before: str, after: str) -> list[int]:
        """Buckets whose rows aren't the same."""
        both = self._digests(before, False).unionByName(self._digests(after, True))
        sign = F.when(F.col("after"), F.lit(1)).otherwise(F.lit(-1))
        sums = both.groupBy("bucket").agg(F.sum(F.col("n") * sign).alias("n"), F.sum(F.when(F.col("after"), F.col("total")).otherwise(-F.col("total"))).alias("total"), F.bit_xor("mixed").alias("mixed"))
        return sorted(r.bucket for r in sums.where((F.col("n") != 0) | (F.col("total") != 0) | (F.col("mixed") != 0)).select("bucket").collect())

    def changes(self, before: str, after: str) -> DataFrame:
        """The key columns and `change` of each key whose rows differ: added, removed, or changed (a key's rows are compared as a bag). Reads keys and hashes of differing buckets only."""
        buckets = self.differing(before, after)
        sides = [self._rows(name).where(F.col("bucket").isin(*buckets) if buckets else F.lit(False)).select("key", "hash", F.lit(sign).alias("sign")) for name, sign in ((before, -1), (after, 1))]
        signed = F.col("hash").cast("decimal(28,0)") * F.col("sign")
        sums = [F.count_if(F.col("sign") < 0).alias("n_before"), F.count_if(F.col("sign") > 0).alias("n_after"), F.sum(signed.cast("decimal(28,0)")).alias("total"), F.bit_xor("hash").alias("mixed")]
        per_key = sides[0].unionByName(sides[1]).groupBy("key").agg(*sums)
        unlike = (F.col("n_before") != F.col("n_after")) | (F.col("total") != 0) | (F.col("mixed") != 0)
        kind = F.when(F.col("n_before") == 0, "added").when(F.col("n_after") == 0, "removed").otherwise("changed")
        return per_key.where(unlike).select("key.*", kind.alias("change"))
