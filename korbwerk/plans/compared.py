"""Queries of two snapshots compared by digests, each with the SQL that joins them in full."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from korbwerk.operators.compare import Snapshots
from korbwerk.plans.exchange import through
from korbwerk.plans.listings import LISTINGS, listings, strip
from korbwerk.plans.queries import register

FIELDS = ("alamat_email_bewerbung", "posisi_kota", "alamat_detail", "ba_job_url")
#: What a later run finds: other rows, new addresses, another category.
_BEFORE, _AFTER = "ordinal % 10 <> 9", "ordinal % 10 <> 8"
_CHANGED = {"alamat_email_bewerbung": "CASE WHEN ordinal % 7 = 3 THEN 'neu@firma.de' ELSE alamat_email_bewerbung END", "category_id": "CASE WHEN ordinal % 13 = 5 THEN 'new_category' ELSE category_id END"}
_SIDES = f"""WITH {LISTINGS}, b AS (SELECT * FROM l WHERE {_BEFORE}), a AS (SELECT * REPLACE ({', '.join(f'{x} AS {c}' for c, x in _CHANGED.items())}) FROM l WHERE {_AFTER})"""


def compared(spark: SparkSession, sf_dir: str, use: Callable[[Snapshots], DataFrame]) -> DataFrame:
    """What `use` finds in the snapshots "before" and "after"."""

    def both(folder: str) -> DataFrame:
        rows, snapshots = listings(spark, sf_dir), Snapshots(spark, folder, "ordinal", "category_id", FIELDS)
        snapshots.write("before", rows.where(_BEFORE))
        snapshots.write("after", rows.where(_AFTER).withColumns({c: F.expr(x) for c, x in _CHANGED.items()}))
        return use(snapshots)

    return through(spark, both)


def _counts(side: str, by: str) -> str:
    fields = " UNION ALL ".join(f"SELECT {by}'{f}' AS field, count(*) AS n, count(*) FILTER ({strip(f)} <> '') AS filled FROM {side}{' GROUP BY category_id' if by else ''}" for f in FIELDS)
    return f"(SELECT *, CASE WHEN n > 0 THEN round_even(filled * 100 / n, 1) ELSE 0 END AS pct FROM ({fields}))"


_PAIR = ", ".join(f"coalesce({s}.{c}, 0) AS {n}_{w}" for s, w in (("x", "before"), ("y", "after")) for c, n in (("n", "n"), ("filled", "filled"), ("pct", "pct")))


@register(f"{_SIDES} SELECT category_id, field, {_PAIR} FROM {_counts('b', 'category_id, ')} x FULL JOIN {_counts('a', 'category_id, ')} y USING (category_id, field)")
def snapshot_counts(spark, sf_dir):
    """Rows and filled fields of each category that is there before or after."""
    return compared(spark, sf_dir, lambda s: s.counts("before", "after"))


@register(f"{_SIDES} SELECT field, {_PAIR} FROM {_counts('b', '')} x FULL JOIN {_counts('a', '')} y USING (field)")
def snapshot_fields(spark, sf_dir):
    """Filled rows, all rows and percent of each field, before and after."""
    return compared(spark, sf_dir, lambda s: s.counts("before", "after", by_group=False))


@register(f"""{_SIDES} SELECT ordinal, CASE WHEN b.ordinal IS NULL THEN 'added' WHEN a.ordinal IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM b FULL JOIN a USING (ordinal) WHERE b.ordinal IS NULL OR a.ordinal IS NULL OR b.alamat_email_bewerbung IS DISTINCT FROM a.alamat_email_bewerbung OR b.category_id IS DISTINCT FROM a.category_id""")
def snapshot_changes(spark, sf_dir):
    """Listings that are added, removed or changed."""
    return compared(spark, sf_dir, lambda s: s.changes("before", "after"))
