"""Queries of sources, sinks, runs and applications, each with the SQL for the same rows. What a sink writes goes to a folder of its own beside the checkpoints, is read again and removed."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from korbwerk.functions import text
from korbwerk.operators import audit, enrich, progress, research, search
from korbwerk.plans.checkpoint import ensure_checkpoint_dir, materialise, remove
from korbwerk.plans.listings import LISTINGS, listings
from korbwerk.plans.queries import register, table
from korbwerk.schema import JOB_TYPES
from korbwerk.sources import api, readers, sinks


def through(spark: SparkSession, use: Callable[[str], DataFrame]) -> DataFrame:
    """What `use` reads from a folder that all executors share, once it has written there."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/exchange-{uuid4().hex}"
    try:
        return materialise(use(folder))
    finally:
        remove(spark, folder)


@register("SELECT c_custkey, c_name, c_acctbal FROM customer")
def snapshot_alias(spark, sf_dir):
    """K3: customers through two snapshots; the alias points at the later one."""

    def use(folder: str) -> DataFrame:
        rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
        sinks.publish(rows.withColumn("c_name", F.lit("old")), folder, "customers", "1")
        sinks.publish(rows, folder, "customers", "2")
        return sinks.read_alias(spark, folder, "customers")

    return through(spark, use)


@register(f"WITH {LISTINGS} SELECT ordinal, referenznummer, posisi_kota, detail_deskripsi, kelengkapan_score FROM l")
def json_export(spark, sf_dir):
    """K1: listings as JSON lines, texts with all their characters."""

    def use(folder: str) -> DataFrame:
        rows = listings(spark, sf_dir).select("ordinal", "referenznummer", "posisi_kota", "detail_deskripsi", "kelengkapan_score")
        sinks.write_json(rows, folder)
        return spark.read.schema(rows.schema).json(folder)

    return through(spark, use)


@register("SELECT doc_id, 'say \"' || lang || '\", or ' || source AS said, CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'x' END AS mark FROM documents")
def csv_export(spark, sf_dir):
    """K2: quotes, commas and blanks through CSV."""

    def use(folder: str) -> DataFrame:
        rows = table(spark, sf_dir, "documents").selectExpr("doc_id", "'say \"' || lang || '\", or ' || source as said", "case when doc_id % 3 = 0 then '' else 'x' end as mark")
        sinks.write_csv(rows, folder)
        return spark.read.options(header=True, escape='"', emptyValue="").schema(rows.schema).csv(folder).fillna("", ["mark"])

    return through(spark, use)


@register(f"WITH {LISTINGS} SELECT category_id, count(*) AS n, sum(ordinal)::BIGINT AS ordinals FROM l GROUP BY 1")
def export_by_category(spark, sf_dir):
    """K4: a folder for each category, read with the folders' names as values."""

    def use(folder: str) -> DataFrame:
        sinks.write_by_category(listings(spark, sf_dir).select("ordinal", "category_id", "detail_deskripsi"), folder)
        return spark.read.json(folder).groupBy("category_id").agg(F.count("*").alias("n"), F.sum("ordinal").alias("ordinals"))

    return through(spark, use)


_KIND = f"CASE WHEN beruf_typ IN ({', '.join(f"'{t}'" for t in JOB_TYPES)}) THEN beruf_typ ELSE 'fi_other' END"


def _workflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_workflow(listings(spark, sf_dir).withColumn("referenznummer", F.col("ordinal").cast("string")))


@register(f"WITH {LISTINGS} SELECT {_KIND} AS kind, count(*) AS n, count(DISTINCT ordinal) AS n_ids, count(*) FILTER (kelengkapan_score <> 0) AS n_scored FROM l GROUP BY 1")
def export_by_type(spark, sf_dir):
    """K5, K7: the workflow export in a folder for each job type; a score of 0 is blank."""

    def use(folder: str) -> DataFrame:
        sinks.write_by_type(_workflow(spark, sf_dir), folder)
        rows = spark.read.options(header=True, escape='"', multiLine=True, recursiveFileLookup=True).csv(folder).withColumn("kind", F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1))
        return rows.groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("id_referensi").alias("n_ids"), F.count("skor_kelengkapan").alias("n_scored"))

    return through(spark, use)


@register(f"WITH {LISTINGS} SELECT referenznummer, arg_min(nama_perusahaan, ordinal) AS nama_perusahaan, arg_min(posisi_kota, ordinal) AS posisi_kota FROM l GROUP BY 1")
def reference_index(spark, sf_dir):
    """The first company and city of each reference."""
    return sinks.reference_index(listings(spark, sf_dir))


@register("SELECT c_custkey::VARCHAR AS referenznummer, CASE WHEN c_custkey % 3 = 0 THEN 'sent' ELSE '' END AS status_lamaran, CASE WHEN c_custkey % 5 = 0 THEN 'high' ELSE '' END AS prioritas FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 5 = 0")
def read_overrides(spark, sf_dir):
    """Edits of an export that stands there twice, with a byte order mark; the last row of each id counts."""

    def use(folder: str) -> DataFrame:
        own = table(spark, sf_dir, "customer").selectExpr("c_custkey", "' ' || c_custkey as id_referensi", "case when c_custkey % 3 = 0 then 'sent ' else '' end as status_lamaran", "case when c_custkey % 5 = 0 then 'high' else '' end as prioritas")
        twice = own.withColumn("status_lamaran", F.lit("old")).withColumn("n", F.lit(0)).where("c_custkey % 3 = 0 or c_custkey % 5 = 0").unionByName(own.withColumn("n", F.lit(1)))
        # one file, so that the order of its rows is that of the file
        sinks.write_csv(twice.orderBy("n", "c_custkey").coalesce(1).select(F.col("id_referensi").alias("﻿id_referensi"), "status_lamaran", "prioritas"), folder)
        return readers.read_overrides(spark, folder).fillna("")

    return through(spark, use)


@register("SELECT DISTINCT url FROM pages")
def failed_urls(spark, sf_dir):
    """The URLs that lines of a log report, each once."""

    def use(folder: str) -> DataFrame:
        table(spark, sf_dir, "pages").select(F.explode(F.array(F.concat(F.lit("ERROR failed: "), "url", F.lit(" (timeout)")), F.lit("INFO ok"))).alias("value")).write.text(folder)
        return readers.failed_urls(spark, folder, r"^ERROR failed: (\S+) \(").select("url")

    return through(spark, use)


@register("SELECT user_id AS id, min(event_id) AS ordinal FROM events WHERE event_type <> 'error' GROUP BY 1")
def first_categories(spark, sf_dir):
    """Of each id the first row that isn't marked; errors stand for marks."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.col("event_id").alias("ordinal"), F.when(F.col("event_type") == "error", "other").alias("duplicate_of"))
    return readers.categories(rows).select("id", "ordinal")


@register("SELECT user_id, min(event_type) AS event_type FROM events GROUP BY 1")
def first_of_shards(spark, sf_dir):
    """Users that several searches (event types) found stay with the first search."""
    return api.first_shard(table(spark, sf_dir, "events").select("user_id", "event_type"), "user_id", "event_type")


@register("SELECT user_id::VARCHAR AS id, arg_max(event_type, event_id) AS kind FROM events GROUP BY 1")
def last_records(spark, sf_dir):
    """The last record of each id."""
    records = table(spark, sf_dir, "events").select(F.col("event_id").alias("ordinal"), F.to_json(F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind"))).alias("payload"))
    return api.last_records(records).select("id", F.get_json_object("payload", "$.kind").alias("kind"))


_RUNS = "SELECT c_mktsegment AS category_id, count(*) AS total, count(*) FILTER (c_acctbal > 0) AS scraped FROM customer GROUP BY 1"


@register(f"""WITH r AS ({_RUNS}), k AS (SELECT category_id, CASE WHEN category_id < 'F' THEN total ELSE 2 * total END AS total, CASE WHEN category_id < 'F' THEN scraped ELSE 0 END AS scraped FROM r)
SELECT * FROM k UNION ALL SELECT 'total', sum(total)::BIGINT, sum(scraped)::BIGINT FROM k""")
def progress_upsert(spark, sf_dir):
    """K9: stored progress, refreshed for the first segments, with a new total."""
    runs = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("category_id")).agg(F.count("*").alias("total"), F.count_if(F.col("c_acctbal") > 0).alias("scraped"))
    stored = runs.select("category_id", (F.col("total") * 2).alias("total"), F.lit(0).cast("long").alias("scraped"))
    stored = stored.unionByName(spark.createDataFrame([("total", 1, 1)], stored.schema))
    return sinks.upsert_progress(stored, runs.where("category_id < 'F'"))


@register("""SELECT user_id, CASE WHEN max(event_id) % 4 = 0 THEN 'RUNNING' WHEN count(*) FILTER (value > 20) >= count(*) THEN 'DONE' WHEN count(*) FILTER (value > 20) > 0 THEN 'PARTIAL' ELSE 'IDLE' END AS state,
printf('%.1f', round_even(count(*) FILTER (value > 20) * 100 / count(*), 1)) || '%' AS pct FROM events GROUP BY 1""")
def run_states(spark, sf_dir):
    """Users as runs, their events of some value as what is done."""
    runs = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("total"), F.count_if(F.col("value") > 20).alias("done"), (F.max("event_id") % 4 == 0).alias("running"))
    return runs.select("user_id", audit.run_state(F.col("done"), F.col("total"), F.col("running")).alias("state"), progress.share(F.col("done"), F.col("total")).alias("pct"))


@register("SELECT 'state' AS name, 'running' AS value UNION ALL SELECT 'updated_utc', '2026-01-01T00:00:00Z' UNION ALL SELECT 'progress', d || '/' || n || printf(' (%.1f%%)', 100 * d / n) FROM (SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS d FROM orders) UNION ALL SELECT 'workers', '4' UNION ALL SELECT 'target', 'orders'")
def run_status(spark, sf_dir):
    """The status file of a run that exports the orders, counted while they are written."""

    def use(folder: str) -> DataFrame:
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
        done, total = sinks.counted(orders, F.col("o_orderstatus") == "F", lambda rows: sinks.write_csv(rows, f"{folder}/rows"))
        sinks.write_status(spark, f"{folder}/status", "running", done, total, 4, "orders", "2026-01-01T00:00:00Z")
        return sinks.read_status(spark, f"{folder}/status")

    return through(spark, use)


_KEPT = "list_filter(range(1, length(p_name) + 1), lambda i: regexp_matches(substr(p_name, i, 1), '[A-Za-z0-9@.-]'))"


@register(f"""WITH a AS (SELECT p_partkey, p_name, {_KEPT} AS kept FROM part), s AS (SELECT *, lower(array_to_string(list_transform(kept, lambda i: substr(p_name, i, 1)), '')) AS joined FROM a),
c AS (SELECT p_partkey, unnest(t.w) AS token, joined, kept FROM s, (SELECT ['dwi', 'ing'] AS w) t), m AS (SELECT p_partkey, unnest(range(1, length(joined) - length(token) + 2)) AS p, token, joined, kept FROM c),
r AS (SELECT DISTINCT p_partkey, unnest(range(kept[p] - 1, kept[p + length(token) - 1])) AS x FROM m WHERE substr(joined, p, length(token)) = token)
SELECT p_partkey, string_agg(x::VARCHAR, ',' ORDER BY x) AS marked FROM r GROUP BY 1""")
def search_highlights(spark, sf_dir):
    """Q-10: the characters of parts' names that two tokens mark; one of them runs over a gap."""
    ranges = search.highlights(F.col("p_name"), "ING, dwi")
    marked = F.flatten(F.transform(ranges, lambda r: F.sequence(r["from"], r["to"] - 1)))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(marked.cast("array<string>"), ",").alias("marked")).where("marked <> ''")


@register("SELECT count(*) FILTER (contains(lower(p_name), 'ring') OR contains(lower(p_type), 'ring')) AS n FROM part")
def search_count(spark, sf_dir):
    """Q-7: how many parts match a token."""
    return search.match_count(search.searchable(table(spark, sf_dir, "part"), ["p_name", "p_type"]), "ring")


@register(f"WITH {LISTINGS} SELECT domain, count(*) AS n FROM (SELECT lower(regexp_extract(alamat_email_bewerbung, '@([^@\\s]+)', 1)) AS domain FROM l) WHERE domain <> '' GROUP BY 1")
def email_domains(spark, sf_dir):
    """Q-2, A16."""
    return search.domain_facet(listings(spark, sf_dir), "alamat_email_bewerbung")


@register(f"WITH {LISTINGS} SELECT ordinal, nama_perusahaan FROM l WHERE beruf_typ = 'ae' AND trim(alamat_email_bewerbung) <> '' AND contains(lower(nama_perusahaan || ' ' || posisi_kota || ' ' || alamat_email_bewerbung || ' ' || referenznummer), 'gmbh &')")
def applications_found(spark, sf_dir):
    """F15, Q-11: applications of one type, with an address and with the query's words in one of four columns."""
    rows = listings(spark, sf_dir).withColumn("bewerbung_status", F.lit("pending"))
    return search.application_filter(rows, " GmbH & ", "pending", ae_only=True, email_only=True).select("ordinal", "nama_perusahaan")


@register("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'nächstmöglichen Zeitpunkt' WHEN o_orderkey % 3 = 1 THEN year(o_orderdate)::VARCHAR ELSE printf('%02d.%d', month(o_orderdate), year(o_orderdate)) END AS start,
CASE WHEN o_orderkey % 4 = 0 THEN 'Sehr geehrte Frau ' || o_custkey WHEN o_orderkey % 4 = 1 THEN 'Sehr geehrter Herr ' || o_custkey ELSE 'Sehr geehrte Damen und Herren' END AS greeting FROM orders""")
def letter_parts(spark, sf_dir):
    """How a letter names the start and greets; orders give dates and names."""
    kind = F.col("o_orderkey")
    year, month = F.when(kind % 3 > 0, F.year("o_orderdate")), F.when(kind % 3 > 1, F.month("o_orderdate"))
    title, name = F.element_at(F.array(F.lit("Frau"), F.lit("Herr"), F.lit("Frau"), F.lit("")), (kind % 4 + 1).cast("int")), F.when(kind % 4 == 2, " ").otherwise(F.col("o_custkey").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", research.start_hint(year, month).alias("start"), research.greeting(title, name).alias("greeting"))


@register(f"""WITH {LISTINGS} SELECT ordinal, regexp_extract(alamat_detail, '\\b(\\d{{5}})\\b', 1) AS postcode, trim(regexp_replace(lower(nama_perusahaan), '[^a-z0-9]+', '-', 'g'), '-') AS slug, lower(regexp_replace(regexp_extract(trim(link_bewerbung), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^www\\.', '')) AS host FROM l""")
def listing_parts(spark, sf_dir):
    """Postcode, slug and host of listings."""
    return listings(spark, sf_dir).select("ordinal", text.postcode(F.col("alamat_detail")).alias("postcode"), text.slug(F.col("nama_perusahaan")).alias("slug"), text.host(F.col("link_bewerbung")).alias("host"))
