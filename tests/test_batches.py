"""Deltas, the master by batches, the stream of runs and winners that are kept, against the same operators over all rows."""

import os
import random

import pytest

from korbwerk.operators import dedup
from korbwerk.streaming.deltas import Deltas
from korbwerk.streaming.master import Master, Winners, ingest_runs
from tests.test_operators import FULL, listings

N = 90


def some_rows(seed, n=N):
    pick = random.Random(seed)
    out = []
    for i in range(n):
        row = {"referenznummer": pick.choice(["", "", f"R{pick.randrange(25)}"]), "nama_perusahaan": f"Firma {pick.randrange(6)}", "jenis_ausbildung": pick.choice(["Koch", "Maler", ""]), "posisi_kota": pick.choice(["Bonn", "Ulm", ""])}
        row |= {"alamat_detail": pick.choice(["A 1", "B 2", ""]), "detail_deskripsi": "x" * pick.randrange(4), "category_id": pick.choice(["azubi_de_ae", "stepstone_de_dpa", ""]), "link_bewerbung": f"https://jobs.example.org/{pick.randrange(20)}/apply"}
        out.append(row)
    return out


def files_below(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_deltas_prune_buckets_and_keep_versions(spark, tmp_path):
    t = Deltas(spark, str(tmp_path / "t"), "k", 8)
    rows = lambda *r: spark.createDataFrame(list(r), "k string, x int")
    assert t.read() is None
    t.append(0, rows(*((f"k{i}", i) for i in range(100))))
    before = files_below(tmp_path)
    t.append(1, rows(("k3", 300), ("new", 1), (None, 7)))
    assert len(set(files_below(tmp_path)) - set(before)) <= 3  # a batch writes its own rows
    t.append(1, rows(("k4", 1)))  # comes again: nothing happens
    assert t.read().count() == 103 and t.read(before=1).count() == 100
    newest = {r.k: (r.x, r.v) for r in t.read(newest=True).collect()}
    assert len(newest) == 102 and newest["k3"] == (300, 1) and newest["k4"] == (4, 0) and newest[None] == (7, 1)
    one = t.read(buckets=t.touched(rows(("k3", 0))))
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().executedPlan().toString() and 2 <= one.count() < 40
    t.append(2, rows(("again", 9)), gone={"x": "7"})
    assert t.read().where("x = 7 and k is null").count() == 0 and t.read().where("x = 7").count() == 0 and t.read(before=2).where("x = 7").count() == 2
    t.compact(newest=True)
    assert {r.k: r.x for r in t.read().collect()}["k3"] == 300 and t.read().count() == 101 and len(t.manifest()["parts"]) == 1
    t.append(3, rows())
    t.append(4, rows(("z", 1)))
    t.compact()
    assert t.read().count() == 102 and len(t.names()) == 2
    assert not os.path.exists(tmp_path / "t" / "data" / "delta=0")


def test_a_draft_or_a_folder_without_manifest_is_not_seen(spark, tmp_path):
    t = Deltas(spark, str(tmp_path / "t"), "k")
    t.append(0, spark.createDataFrame([("a", 1)], "k string, x int"))
    t._write("delta=1", spark.createDataFrame([("lost", 1)], "k string, x int"))
    (tmp_path / "t" / "manifests" / "000000000001-0.json.draft").write_text("{")
    assert [r.k for r in t.read().collect()] == ["a"]
    t.append(1, spark.createDataFrame([("b", 1)], "k string, x int"))
    assert sorted(r.k for r in t.read().collect()) == ["a", "b"]


@pytest.mark.parametrize("cuts", [(1, 60)])
def test_batches_filter_as_one(spark, tmp_path, cuts):
    rows = listings(spark, some_rows(1))
    want = {r.ordinal for r in dedup.greedy(dedup.with_keys(rows)).collect()}
    bounds = [0, *cuts, N]
    for batch in range(3):
        master = Master(spark, str(tmp_path / "m"), 8)  # a new one each time, as after a restart
        part = rows.where(f"ordinal >= {bounds[batch]} and ordinal < {bounds[batch + 1]}")
        if batch == 1:  # fails after its keys were written, and runs again
            left = master.unseen(batch, part)
            master.keys.append(batch, __import__("korbwerk.streaming.master", fromlist=["key_rows"]).key_rows(left.join(dedup.greedy(left), "ordinal", "left_semi")).select("k").distinct())
        master.merge(batch, part)
    assert {r.ordinal for r in Master(spark, str(tmp_path / "m"), 8).snapshot().collect()} == want


def test_links_reject_what_holds_a_token(spark, tmp_path):
    token = "https://jobs.example.org/0a1b2c3d-1111-2222-3333-444455556666"
    rows = listings(spark, [{"referenznummer": "1", "link_bewerbung": token}, {"referenznummer": "2", "link_bewerbung": "http://x.org/?id=0a1b2c3d-1111-2222-3333-444455556666"}, {"referenznummer": "3", **FULL}])
    master = Master(spark, str(tmp_path / "m"), 8, links=True)
    master.merge(0, rows.where("ordinal = 0"))
    assert [r.referenznummer for r in master.merge(1, rows.where("ordinal > 0")).collect()] == ["3"]


def test_runs_come_as_a_stream_with_a_restart(spark, tmp_path):
    rows = listings(spark, some_rows(2))
    land, at, state = (str(tmp_path / x) for x in ("land", "m", "c"))

    def push(low, high):
        rows.where(f"ordinal >= {low} and ordinal < {high}").coalesce(1).write.mode("append").parquet(land)

    def run():
        ingest_runs(spark, land, rows.schema, at, state, enrich=lambda df: df.withColumn("catatan", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("neu")) if "catatan" in df.columns else df, links=False, files=1).awaitTermination()

    push(0, 40)
    run()
    push(40, 60)
    push(60, N)
    run()
    run()  # nothing new
    want, known = set(), None
    for low, high in ((0, 40), (40, 60), (60, N)):
        own = dedup.deduplicate(rows.where(f"ordinal >= {low} and ordinal < {high}"))[0].collect()
        part = spark.createDataFrame(own, rows.schema)
        keyed = dedup.with_keys(part)
        if known is not None:
            for k in dedup.KEYS:
                keyed = keyed.join(known.where(f"_{k} is not null").select(f"_{k}").distinct(), f"_{k}", "left_anti")
        now = keyed.join(dedup.greedy(keyed), "ordinal", "left_semi").select(*keyed.columns)
        now = spark.createDataFrame(now.collect(), now.schema)
        want |= {r.ordinal for r in now.collect()}
        known = now if known is None else known.unionByName(now)
    assert {r.ordinal for r in Master(spark, at).snapshot().collect()} == want


def test_winners_kept_equal_the_full_run(spark, tmp_path):
    rows = listings(spark, some_rows(3))
    winners = Winners(spark, str(tmp_path / "w"), 8)
    for batch, (low, high) in enumerate(((0, 25), (25, 50), (50, 50), (50, N))):
        winners.add(batch, rows.where(f"ordinal >= {low} and ordinal < {high}"))
        if batch == 1:
            winners.best.compact(newest=True)
            winners.kept.compact(newest=True)
            winners.near.compact(newest=True, drop="gone")
        kept, stats = dedup.deduplicate(rows.where(f"ordinal < {high}"))
        assert {r.ordinal for r in winners.ordinals().collect()} == {r.ordinal for r in kept.collect()}
        assert winners.stats().first().asDict() == stats.first().asDict()
