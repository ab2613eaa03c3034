"""Queries of tables that grow by batches, each with the SQL that has all rows at once. A table goes to a folder of its own beside the checkpoints, is read again and removed."""

from __future__ import annotations

from pyspark.sql import functions as F

from korbwerk.operators import search
from korbwerk.operators.index import SearchIndex, SuggestionIndex
from korbwerk.plans.exchange import through
from korbwerk.plans.listings import KEYED, LISTINGS, _REASONS, collapse, listings, removed
from korbwerk.plans.queries import _scored, register, table
from korbwerk.streaming.deltas import Deltas
from korbwerk.streaming.discovery import Discovery
from korbwerk.streaming.master import Master, Winners

BATCHES = 3


def batch_of(df, batch: int):
    return df.where(F.col("ordinal") % BATCHES == batch)


@register(f"""WITH {KEYED}, f AS (SELECT unnest(list_reduce(list({{'k': list_filter([CASE WHEN r <> '' THEN 'r' || r END, 'n' || near, 'c' || cross_], lambda x: x IS NOT NULL), 'ok': [ordinal]}} ORDER BY ordinal % {BATCHES}, ordinal),
lambda a, b: CASE WHEN list_has_any(a.k, b.k) THEN a ELSE {{'k': list_concat(a.k, b.k), 'ok': list_concat(a.ok, b.ok)}} END).ok) AS ordinal FROM k) SELECT ordinal, referenznummer, ordinal % {BATCHES} AS batch FROM f JOIN l USING (ordinal)""")
def listing_batches_merged(spark, sf_dir):
    """Listings that come in three batches, filtered in order against the keys of the master; the second batch comes twice, and the master is compacted before the third."""

    def use(folder: str):
        rows, master = listings(spark, sf_dir), Master(spark, folder)
        for batch in (0, 1, 1, 2):
            master.merge(batch, batch_of(rows, batch))
            if batch == 1:
                master.compact()
        return master.snapshot().select("ordinal", "referenznummer", (F.col("ordinal") % BATCHES).alias("batch"))

    return through(spark, use)


@register(f"WITH {KEYED}, {collapse('d', 'k')} SELECT ordinal FROM d")
def listing_winners_kept(spark, sf_dir):
    """What the three phases leave of listings that come in three batches, kept as they come."""

    def use(folder: str):
        winners = Winners(spark, folder)
        for batch in range(BATCHES):
            winners.add(batch, batch_of(listings(spark, sf_dir), batch))
        return winners.ordinals()

    return through(spark, use)


@register(f"WITH {KEYED}, {collapse('d', 'k')}, s AS {removed('d')} SELECT (SELECT count(*) FROM k) AS input_total, {_REASONS}, (SELECT count(*) FROM d) AS output_total FROM s")
def listing_winners_stats(spark, sf_dir):
    """The same batches' counts by phase."""

    def use(folder: str):
        winners = Winners(spark, folder)
        for batch in range(BATCHES):
            winners.add(batch, batch_of(listings(spark, sf_dir), batch))
        return winners.stats()

    return through(spark, use)


@register(f"""WITH {LISTINGS} SELECT ordinal, sumber_data, ordinal % 2 AS run FROM l WHERE sumber_data <> 'ausbildung_de' OR ordinal % 2 = 1""")
def listing_source_refreshed(spark, sf_dir):
    """Half of all listings come first, then the other half of one source replaces its rows, then the rest of the others; read through the deltas."""

    def use(folder: str):
        rows, master = listings(spark, sf_dir).withColumn("run", F.col("ordinal") % 2), Deltas(spark, folder, "ordinal")
        one = F.col("sumber_data") == "ausbildung_de"
        master.append(0, rows.where("run = 0"))
        master.append(1, rows.where((F.col("run") == 1) & one), gone={"sumber_data": "ausbildung_de"})
        master.append(2, rows.where((F.col("run") == 1) & ~one))
        return master.read().select("ordinal", "sumber_data", "run")

    return through(spark, use)




def _part_scores(*tokens: str) -> str:
    scores = ", ".join(f"greatest({_scored('lower(p_name)', t)}, {_scored('lower(p_type)', t)}) AS s{i}" for i, t in enumerate(tokens))
    found = [f"s{i}" for i in range(len(tokens))]
    return f"SELECT p_partkey, ({' + '.join(found)})::INT AS score FROM (SELECT p_partkey, {scores} FROM part) WHERE {' AND '.join(f'{s} > 0' for s in found)}"


_QUERIES = {"Ring": ("ring",), " É  idg": ("e", "idg"), "ed, ST": ("ed", "st"), "anodized": ("anodized",)}


@register(" UNION ALL ".join(f"SELECT {i} AS query, * FROM ({_part_scores(*tokens)})" for i, tokens in enumerate(_QUERIES.values())))
def search_by_index(spark, sf_dir):
    """Q-3 to Q-6: parts for four queries, from the postings of their grams; the parts come in two batches."""

    def use(folder: str):
        rows, index = search.searchable(table(spark, sf_dir, "part"), ["p_name", "p_type"]), SearchIndex(spark, folder, "p_partkey")
        index.add(0, rows.where("p_partkey % 2 = 0"))
        index.add(1, rows.where("p_partkey % 2 = 1"))
        found = [index.search(q).withColumn("query", F.lit(i)) for i, q in enumerate(_QUERIES)]
        return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3]).select("query", "p_partkey", "score")

    return through(spark, use)


_SUGGESTED = """SELECT type, norm, n, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY type ORDER BY score DESC, n DESC, value) AS rank
FROM (SELECT *, (CASE WHEN norm = '{q}' THEN 200 WHEN starts_with(norm, '{q}') THEN 150 - least(length(norm) - {n}, 30) WHEN contains(norm, '{q}') THEN 120 - (strpos(norm, '{q}') - 1) WHEN {n} >= 2 AND regexp_matches(norm, '{p}') THEN 50 ELSE 0 END + least(n, 20))::INT AS score, n AS k FROM i) WHERE score > 0) WHERE rank <= 5"""


@register("""WITH i AS (SELECT 'type' AS type, lower(p_type) AS norm, arg_min(p_type, p_partkey) AS value, count(*) AS n FROM part GROUP BY 2 UNION ALL
SELECT 'brand', trim(regexp_replace(lower(p_brand), '[^a-z0-9@.\\s-]+', ' ', 'g')), arg_min(p_brand, p_partkey), count(*) FROM part GROUP BY 2) """
    + " UNION ALL ".join(f"SELECT {k} AS query, * FROM ({_SUGGESTED.format(q=q, n=len(q), p='.*'.join(q))})" for k, q in enumerate(("b", "br", "polished"))))
def suggest_by_index(spark, sf_dir):
    """A17, O5, Q-8: suggestions for short queries (kept, where nothing else can come in) and for a longer one (of all values)."""

    def use(folder: str):
        index = SuggestionIndex(spark, folder)
        index.build(search.suggestions(table(spark, sf_dir, "part"), {"type": F.col("p_type"), "brand": F.col("p_brand")}, "p_partkey"))
        found = [index.suggest(q).select(F.lit(k).alias("query"), "type", "norm", "n", "score", "rank") for k, q in enumerate(("b", "br", "Polished"))]
        return found[0].unionByName(found[1]).unionByName(found[2])

    return through(spark, use)


#: Links of a result page.
PAGE_LINKS = 2000


@register(f"""WITH p AS (SELECT o_custkey, o_orderkey // {PAGE_LINKS} + 1 AS page FROM orders), f AS (SELECT o_custkey, min(page) AS page FROM p GROUP BY 1),
n AS (SELECT page, f.n IS NULL AS stale FROM (SELECT DISTINCT page FROM p) LEFT JOIN (SELECT page, count(*) AS n FROM f GROUP BY 1) f USING (page)),
e AS (SELECT min(page) AS last FROM (SELECT page, stale AND lag(stale) OVER (ORDER BY page) AS ended FROM n) WHERE ended)
SELECT o_custkey::VARCHAR AS id, page::INT AS page FROM f, e WHERE last IS NULL OR page <= last""")
def pages_discovered(spark, sf_dir):
    """Customers that result pages of orders link to, page after page until two in a row name no new one."""

    def use(folder: str):
        links = F.concat(F.lit('<a href="/kunde/'), "o_custkey", F.lit('">')).alias("value")
        rows = table(spark, sf_dir, "orders").select(links, (F.floor(F.col("o_orderkey") / PAGE_LINKS) + 1).cast("int").alias("page"))
        # dealt by page, so that each page is one file, whatever the order of the orders
        rows.repartition("page").write.partitionBy("page").text(f"{folder}/site")
        last = rows.agg(F.max("page")).first()[0]
        found = Discovery(spark, f"{folder}/ids", stagnant=2).run(f"{folder}/site/page={{page}}", r'href="/kunde/([^"]+)"', last, f"{folder}/checkpoint", ahead="32")
        return found.select("id", "page")

    return through(spark, use)
