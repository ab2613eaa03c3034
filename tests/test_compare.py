"""Snapshots compared by digests."""

from korbwerk.operators.compare import Snapshots

SCHEMA = "k string, g string, a string, b string, tags array<string>, bucket int"


def made(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_changes_and_counts(spark, tmp_path):
    rows = [(f"k{i}", "x" if i % 2 else None, "v", " ", None, i) for i in range(200)]
    s = Snapshots(spark, str(tmp_path / "s"), "k", "g", ["a", "b"], buckets=64)
    s.write("1", made(spark, rows))
    later = [*rows[:3], ("k3", "x", None, "v", None, 3), ("k4", None, "v", " ", [None, "t"], 4), *rows[6:], ("n", "y", "v", "w", [], 0)]
    s.write("2", made(spark, later))
    assert {(r.k, r.change) for r in s.changes("1", "2").collect()} == {("k3", "changed"), ("k4", "changed"), ("k5", "removed"), ("n", "added")}
    got = {(r.g, r.field): (r.n_before, r.n_after, r.filled_before, r.filled_after, r.pct_after) for r in s.counts("1", "2").collect()}
    assert got == {("x", "a"): (100, 99, 100, 98, 99.0), ("x", "b"): (100, 99, 0, 1, 1.0), (None, "a"): (100, 100, 100, 100, 100.0), (None, "b"): (100, 100, 0, 0, 0.0), ("y", "a"): (0, 1, 0, 1, 100.0), ("y", "b"): (0, 1, 0, 1, 100.0)}
    assert {r.field: (r.filled_before, r.filled_after) for r in s.counts("1", "2", by_group=False).collect()} == {"a": (200, 199), "b": (0, 2)}
    assert sorted(map(tuple, s.read("2").collect()), key=str) == sorted(map(tuple, made(spark, later).collect()), key=str)


def test_only_differing_buckets_are_read(spark, tmp_path):
    rows = [(f"k{i}", "x", "v", "w", None, i) for i in range(500)]
    s = Snapshots(spark, str(tmp_path / "s"), "k", "g", buckets=64)
    s.write("1", made(spark, rows))
    s.write("2", made(spark, [*rows[1:], ("k0", "x", "other", "w", None, 0)]))
    s.write("3", made(spark, rows[::-1]))
    assert len(s.differing("1", "2")) == 1 and s.differing("1", "3") == [] and s.changes("1", "3").count() == 0
    changes = s.changes("1", "2")
    assert [tuple(r) for r in changes.collect()] == [("k0", "changed")]
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.count("FileScan parquet") == plan.count("PartitionFilters: [isnotnull(bucket#")
    assert "row:" not in plan  # the rows themselves stay unread


def test_null_and_repeated_keys_and_empty_snapshots(spark, tmp_path):
    s = Snapshots(spark, str(tmp_path / "s"), "k", "g", ["a"])
    s.write("none", made(spark, []))
    s.write("1", made(spark, [(None, "x", "v", None, None, 0), (None, "x", "v", None, None, 0), ("d", "x", "v", "w", None, 0), ("m", "x", None, "v", None, 0)]))
    s.write("2", made(spark, [(None, "x", "v", None, None, 0), ("d", "x", "v", "w", None, 0), ("d", "x", "v", "w", None, 0), ("m", "x", "v", None, None, 0)]))
    assert {(r.k, r.change) for r in s.changes("1", "2").collect()} == {(None, "changed"), ("d", "changed"), ("m", "changed")}
    assert {(r.k, r.change) for r in s.changes("none", "2").collect()} == {(None, "added"), ("d", "added"), ("m", "added")}
    assert {r.change for r in s.changes("2", "none").collect()} == {"removed"} and s.changes("none", "none").count() == 0 and s.read("none").count() == 0
    assert [(r.n_before, r.n_after, r.pct_before) for r in s.counts("none", "2").collect()] == [(0, 4, 0.0)]
