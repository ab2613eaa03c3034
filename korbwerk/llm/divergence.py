"""Operator 11: source divergence audit by DuckDB over shards of terms.

How far the sources of a language are from each other, and which terms mark a source. Documents are cut into terms where they are read, and counted for each language, source and term before anything is
shuffled. The counts are dealt by a hash of language and term, so that a term's counts of all sources meet in one shard. There DuckDB adds them up, keeps the terms that stand in enough documents of their
language, and in a second pass gives, chunk by chunk of whole terms: for each pair of sources the sum over terms that both have; for each source how many terms stand in it how often; and each source's
best terms. Spark adds the sums up and ranks.

A term that only one source of a pair has (or none) adds what depends on its count alone, so such terms are summed from the counts of counts and never visited pair by pair: work follows the sources that
a term really has. All arithmetic is on whole numbers.

Null text, language and source are ''. Every language and source that occurs is there, even without a term. Repeated rows count each; ties in rank go by the item's UTF-8. Very long texts are cut into
terms alone, one at a time. An empty table gives no rows; other columns aren't read. The result has a row for each ordered pair of sources of a language, as the contract wants: the number of sources of a
language should be one whose square can be written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from korbwerk.llm.common import fold_ascii, slices, small, table, words_of
from korbwerk.plans.checkpoint import materialise

#: Documents of its language in which a kept term stands, at least; best terms that are listed for each source.
DOCUMENTS, BEST = 10, 10
SCALE = 1_000_000_000
#: Rows of counts that one call of DuckDB gets, and pairs of sources that it sums at once.
CHUNK_ROWS, CHUNK_PAIRS = 500_000, 1_000_000
#: Every byte that is no part of a term becomes a blank, A-Z lower case; bytes of other characters stay.
TERM_BYTES = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
KEPT = "lang string, source string, term string, n long, lang_n long, first boolean"
PARTIAL = "kind string, lang string, source string, item string, n long, value long"


def connection():
    import duckdb

    con = duckdb.connect(config={"threads": 1, "temp_directory": ""})
    con.execute("CREATE MACRO share(n, total, v) AS (1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v))::BIGINT")
    con.execute("CREATE MACRO apart(p, q) AS ((p - q) * (p - q)) // (p + q)")
    return con


def ask(con, sql: str, rows: pa.Table) -> pa.Table | None:
    """What a statement over `rows` gives."""
    con.register("rows", rows)
    try:
        # a CREATE gives no relation
        return found.to_arrow_table() if (found := con.sql(sql)) is not None else None
    finally:
        con.unregister("rows")


def term_counts(batch: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents of every language, source and term of a batch of (lang, source, text), and one row without a term for each language and source."""
    langs, sources = (batch.column(i).dictionary_encode() for i in (0, 1))
    pair = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy(zero_copy_only=False)
    own, group = np.unique(pair, return_inverse=True)
    offsets, codes, words = words_of(fold_ascii(batch.column(2), TERM_BYTES), fold=False)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    width = max(len(words), 1)
    in_doc, n = np.unique(doc * width + codes, return_counts=True)
    keys, at = np.unique(group[in_doc // width] * width + in_doc % width, return_inverse=True)
    total, docs = np.bincount(at, n, len(keys)).astype(np.int64), np.bincount(at, minlength=len(keys))
    of = np.concatenate([own[keys // width], own])
    terms = pa.array([words[i] for i in (keys % width).tolist()] + [b""] * len(own), pa.binary()).cast(pa.string())
    zeros = np.zeros(len(own), np.int64)
    return pa.Table.from_arrays([langs.dictionary.take(pa.array(of // len(sources.dictionary))), sources.dictionary.take(pa.array(of % len(sources.dictionary))), terms, pa.array(np.concatenate([total, zeros])), pa.array(np.concatenate([docs.astype(np.int64), zeros]))], schema=COUNTS)


SUMMED = "SELECT lang, source, term, sum(n)::BIGINT AS n, sum(docs)::BIGINT AS docs FROM rows GROUP BY ALL"


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's documents, added up as long as they fit into two chunks."""
    con, held, size = connection(), [], 0
    for batch in slices(batches, text=2):
        held.append(term_counts(batch))
        size += held[-1].num_rows
        if size >= 2 * CHUNK_ROWS:
            held = [ask(con, SUMMED, pa.concat_tables(held)).cast(COUNTS)]
            if (size := held[0].num_rows) >= CHUNK_ROWS:
                yield from held[0].to_batches(max_chunksize=1 << 16)
                held, size = [], 0
    if held:
        yield from ask(con, SUMMED, pa.concat_tables(held)).cast(COUNTS).to_batches(max_chunksize=1 << 16)


def whole_terms(batches: Iterator[pa.RecordBatch], shrink=None) -> Iterator[pa.Table]:
    """Chunks of sorted rows that end where a term does. shrink: adds up the rows of a term that alone fills a chunk."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < CHUNK_ROWS:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        last = [rows.column(c)[-1] for c in ("lang", "term")]
        same = pc.and_(pc.equal(rows.column("lang"), last[0]), pc.equal(rows.column("term"), last[1]))
        cut = rows.num_rows - pc.sum(same).as_py()
        if cut:
            yield rows.slice(0, cut)
        rest = rows.slice(cut)
        if shrink and rest.num_rows > CHUNK_ROWS // 2:
            rest = shrink(rest)
        held = rest.to_batches()
    if held:
        yield pa.Table.from_batches(held)


def keep_terms(batches: Iterator[pa.RecordBatch], documents: int = DOCUMENTS) -> Iterator[pa.RecordBatch]:
    """The counts of terms that stand in `documents` documents of their language, with the language's own count; `first` marks one row of each term. Rows without a term pass."""
    con = connection()
    for rows in whole_terms(batches, lambda rest: ask(con, SUMMED, rest).cast(COUNTS)):
        yield from ask(con, f"""SELECT lang, source, term, n, coalesce(sum(n) OVER of_term, 0)::BIGINT AS lang_n, row_number() OVER (PARTITION BY lang, term ORDER BY source) = 1 AS first FROM ({SUMMED})
            WHERE true WINDOW of_term AS (PARTITION BY lang, term) QUALIFY term = '' OR sum(docs) OVER of_term >= {documents}""", rows).to_batches(max_chunksize=1 << 16)  # fmt: skip


def compare_shard(batches: Iterator[pa.RecordBatch], best: int = BEST) -> Iterator[pa.RecordBatch]:
    """Partial results of a shard: kind `both` (pair sums over common terms), `alone` (terms of a source with count n) and `term` (best terms)."""
    con = connection()
    for rows in whole_terms(batches):
        con.execute("DROP TABLE IF EXISTS shares")
        ask(con, "CREATE TABLE shares AS SELECT lang, source, term, n, share(n, total, v) AS p, share(0, total, v) AS z, share(lang_n, lang_total, v) AS q FROM rows", rows)
        n_pairs = con.sql("SELECT coalesce(sum(k * k), 0)::BIGINT FROM (SELECT count(DISTINCT source) AS k FROM shares GROUP BY lang)").fetchall()[0][0]
        parts = n_pairs // CHUNK_PAIRS + 1
        asked = [f"""SELECT 'both' AS kind, lang, a.source AS source, b.source AS item, 0::BIGINT AS n, sum(apart(a.p, b.p) - apart(a.p, b.z) - apart(a.z, b.p) + apart(a.z, b.z))::BIGINT AS value
            FROM shares a JOIN shares b USING (lang, term) WHERE a.source < b.source AND hash(a.source) % {parts} = {i} GROUP BY ALL""" for i in range(parts)]  # fmt: skip
        asked.append("SELECT 'alone' AS kind, lang, source, '' AS item, n, count(*)::BIGINT AS value FROM shares GROUP BY ALL")
        asked.append(f"""SELECT 'term' AS kind, lang, source, term AS item, n, apart(p, q) AS value FROM shares WHERE n > 0 AND p > q
            QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY apart(p, q) DESC, term) <= {best}""")  # fmt: skip
        for sql in asked:
            yield from con.sql(sql).to_arrow_table().to_batches(max_chunksize=1 << 16)


def share(n: Column | str, total: str, v: str) -> Column:
    """p of the contract for a count."""
    count = F.col(n) if isinstance(n, str) else n
    return F.call_function("div", (count + F.lit(2)).cast("decimal(19,0)") * F.lit(SCALE), (F.col(total) + F.lit(2) * F.col(v)).cast("decimal(20,0)")) + F.lit(1)


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, documents: int = DOCUMENTS, best: int = BEST) -> DataFrame:
    """lang, source, part, item, value and rank: `pair` rows for each other source of the language, `term` rows for the source's best terms. docs: text, lang and source."""
    own = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    counts = docs.select(*own).mapInArrow(count_terms, "lang string, source string, term string, n long, docs long")
    kept = materialise(counts.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(lambda b: keep_terms(b, documents), KEPT))
    by_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum((F.col("first") & (F.col("term") != "")).cast("long")).alias("heads"))
    by_lang = by_group.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("heads").alias("v"))
    groups = materialise(by_group.join(by_lang, "lang").select("lang", "source", "total", "lang_total", "v"))
    joined = kept.where("term <> ''").join(small(groups), ["lang", "source"]).select("lang", "source", "term", "n", "lang_n", "total", "lang_total", "v")
    partial = materialise(joined.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(lambda b: compare_shard(b, best), PARTIAL))

    zero = F.lit(0).cast("long")
    sides = groups.select("lang", "source", "total", "v", F.when(F.col("v") > 0, share(zero, "total", "v")).alias("z"))
    pairs = sides.join(sides.select("lang", F.col("source").alias("item"), F.col("z").alias("item_z")), "lang").where("source <> item")
    none = F.coalesce(apart(F.col("z"), F.col("item_z")), zero)
    base = pairs.select("lang", "source", "item", (F.col("v") * none).alias("value"))
    often = partial.where("kind = 'alone'").groupBy("lang", "source", "n").agg(F.sum("value").alias("terms"))
    alone = pairs.join(often, ["lang", "source"]).select("lang", "source", "item", (F.col("terms") * (apart(share("n", "total", "v"), F.col("item_z")) - none)).alias("value")).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = partial.where("kind = 'both'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    one_way = materialise(alone.unionByName(both))
    other_way = one_way.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    summed = base.unionByName(one_way).unionByName(other_way).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = summed.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    terms = partial.where("kind = 'term'").select("lang", "source", "item", "value").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).withColumn("part", F.lit("term"))
    return ranked.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT i, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY 1, 2 HAVING count(DISTINCT i) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, k.lang_n, count(t.i) AS n FROM g JOIN k USING (lang) LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.term = k.term GROUP BY ALL),
s AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER w + 2 * count(*) OVER w) AS p, 1 + (1000000000::HUGEINT * (lang_n + 2)) // (sum(lang_n) OVER w + 2 * count(*) OVER w) AS q FROM c WINDOW w AS (PARTITION BY lang, source)),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(v, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS v FROM s x JOIN s y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) e ON e.lang = a.lang AND e.source = a.source AND e.item = b.source),
terms AS (SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM s WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM pairs
UNION ALL SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM terms) WHERE rank <= 10"""
