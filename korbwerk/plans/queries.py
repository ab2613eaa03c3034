"""Queries over the driver's tables, one or more for each operator family, and the SQL for the same rows.

The tables hold no listings, so each operator runs on columns of the same shape: documents are descriptions, customers and suppliers companies, orders and events runs and states.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from korbwerk.functions import dates, text
from korbwerk.operators import audit, dedup, enrich, merge, ranking, search

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(sql: str | None = None):
    def keep(f):
        if f.__name__ in QUERIES:
            raise ValueError(f"{f.__name__} is registered already")
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


@register("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'O')::INT DESC, o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1")
def best_per_group(spark, sf_dir):
    """The best order of each customer."""
    order = F.struct((F.col("o_orderstatus") == "O").cast("int"), "o_totalprice", -F.col("o_orderkey"))
    return merge.latest(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice"), ["o_custkey"], order).select("o_custkey", "o_orderkey", "o_totalprice")


@register("SELECT c_nationkey, c_custkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer) WHERE rank <= 5")
def grouped_topk(spark, sf_dir):
    """Five best customers of each nation."""
    return ranking.top_per_group(table(spark, sf_dir, "customer"), ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")], 5).select("c_nationkey", "c_custkey", "rank")


_COMPLETE = "SELECT CASE WHEN o_orderpriority LIKE '1%' THEN '' ELSE o_orderpriority END AS prio, o_orderstatus AS status, CASE WHEN o_totalprice > 150000 THEN o_totalprice ELSE 0 END AS price FROM orders"


def _gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority").like("1%"), "").otherwise(F.col("o_orderpriority")).alias("prio"), F.col("o_orderstatus").alias("status"), F.when(F.col("o_totalprice") > 150000, F.col("o_totalprice")).otherwise(0.0).alias("price"))


@register(f"""WITH b AS ({_COMPLETE}), w AS (SELECT status, count(*) AS n_rows, count(*) FILTER (trim(prio) <> '') AS prio, count(*) FILTER (price <> 0) AS price FROM b GROUP BY status),
l AS (SELECT status, n_rows, 'prio' AS field, prio AS n_filled FROM w UNION ALL SELECT status, n_rows, 'price', price FROM w) SELECT *, round_even(n_filled * 100 / n_rows, 1) AS pct FROM l""")
def field_completeness_long(spark, sf_dir):
    """A3: filled shares by status."""
    return audit.completeness(_gappy(spark, sf_dir), ["prio", "price"], ["status"])


@register("""WITH b AS (SELECT d.lang, d.source, (trim(coalesce(text, '')) <> '') AS f1, l.doc_id IS NOT NULL AS f2 FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)),
w AS (SELECT CASE WHEN grouping(lang) = 0 THEN 'lang' WHEN grouping(source) = 0 THEN 'source' ELSE 'all' END AS grp, coalesce(CASE WHEN grouping(lang) = 0 THEN lang END, CASE WHEN grouping(source) = 0 THEN source END) AS val, count(*) AS n_rows, count(*) FILTER (f1) AS text, count(*) FILTER (f2) AS labelled
FROM b GROUP BY GROUPING SETS ((lang), (source), ())) SELECT grp, val, n_rows, 'text' AS field, text AS n_filled FROM w UNION ALL SELECT grp, val, n_rows, 'labelled', labelled FROM w""")
def completeness_by_group(spark, sf_dir):
    """Filled fields by language, by source and over all, in one pass."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("labelled")).distinct()
    docs = table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    return audit.completeness_sets(docs, ["text", "labelled"], ["lang", "source"]).drop("pct")


@register(f"""WITH b AS ({_COMPLETE}), w AS (SELECT status, round_even(count(*) FILTER (trim(prio) <> '') * 100 / count(*), 1) AS a, round_even(count(*) FILTER (price <> 0) * 100 / count(*), 1) AS c FROM b GROUP BY status) SELECT status, round_even((a + c) / 2, 1) AS mean_pct FROM w""")
def mean_completeness(spark, sf_dir):
    """A4."""
    return audit.mean_completeness(field_completeness_long(spark, sf_dir), ["status"])


@register("""SELECT c_custkey, CASE WHEN c_acctbal >= 7500 THEN 'high' WHEN c_acctbal >= 5000 THEN 'mid' ELSE 'low' END AS bucket,
CASE WHEN c_mktsegment = 'BUILDING' AND s >= 60 THEN 'tinggi' WHEN how IN ('email', 'portal') AND s >= 50 THEN 'sedang' ELSE 'rendah' END AS prio, CASE WHEN how = 'tidak_jelas' OR s < 50 OR (how = 'ba_portal' AND c_mktsegment <> 'BUILDING') THEN 'ya' ELSE 'tidak' END AS manual
FROM (SELECT *, floor(c_acctbal / 100)::INT AS s, CASE WHEN c_mktsegment = 'BUILDING' THEN 'email' WHEN c_mktsegment = 'MACHINERY' THEN 'portal' WHEN c_mktsegment = 'FURNITURE' THEN 'ba_portal' ELSE 'tidak_jelas' END AS how FROM customer)""")
def bucket_priority(spark, sf_dir):
    """Route, priority, manual review and bucket of customers, whose segment stands for what they can be reached by."""
    c = table(spark, sf_dir, "customer")
    email = F.when(F.col("c_mktsegment") == "BUILDING", "a@b.de").otherwise("")
    link = F.when(F.col("c_mktsegment") == "MACHINERY", "https://jobs.example.org").otherwise("")
    portal = F.when(F.col("c_mktsegment") == "FURNITURE", "https://portal.example.org").otherwise("")
    s, how = F.floor(F.col("c_acctbal") / 100).cast("int"), enrich.route(email, link, link, portal)
    return c.select("c_custkey", enrich.bucket(F.col("c_acctbal") / 100).alias("bucket"), enrich.priority(how, s, email).alias("prio"), enrich.manual(how, s, email).alias("manual"))


@register("SELECT c_mktsegment, CASE c_mktsegment WHEN 'BUILDING' THEN 4 WHEN 'MACHINERY' THEN 3 ELSE 0 END AS prio, count(*) AS n FROM customer GROUP BY ALL")
def category_rank_lookup(spark, sf_dir):
    """Priorities from a small mapping."""
    from korbwerk.schema import category_priority

    return table(spark, sf_dir, "customer").groupBy("c_mktsegment", category_priority(F.col("c_mktsegment"), {"BUILDING": 4, "MACHINERY": 3}).alias("prio")).agg(F.count("*").alias("n"))


@register("SELECT c_custkey, coalesce(nullif(s, ''), c_mktsegment) AS c_mktsegment FROM customer LEFT JOIN (SELECT o_custkey, CASE WHEN max(o_totalprice) > 300000 THEN 'VIP' ELSE '' END AS s FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def override_join(spark, sf_dir):
    """Values of a second table win where they aren't blank."""
    values = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.when(F.max("o_totalprice") > 300000, "VIP").otherwise("").alias("c_mktsegment"))
    return merge.override(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), values, "c_custkey", ["c_mktsegment"])


@register("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def anti_join_master(spark, sf_dir):
    """J1 phase A, U2, F12: customers without a large order."""
    large = table(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return merge.pending(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), large, "c_custkey")


@register("SELECT DISTINCT page_id AS ordinal FROM pages JOIN (SELECT DISTINCT regexp_extract(url, '://([^/?#]+)', 1) AS token FROM pages) ON contains(lower(url), lower(token)) WHERE length(token) > 8")
def substring_theta_join(spark, sf_dir):
    """Pages whose URL contains a host of any page; the join runs by key on pieces of the strings."""
    pages = table(spark, sf_dir, "pages")
    tokens = pages.select(F.lower(F.regexp_extract("url", "://([^/?#]+)", 1)).alias("token")).where("length(token) > 8").distinct()
    new = pages.select(F.col("page_id").alias("ordinal"), F.col("url").alias("link_bewerbung"), F.lit("").alias("ba_job_url"), F.lit("").alias("link_bewerbung_externe"))
    return dedup.holds_token(new, tokens)


@register("""WITH k AS (SELECT doc_id, list_filter(['t' || sha256(lower(trim(text))), 'l' || n_chars || '|' || source], lambda x: x IS NOT NULL) AS k FROM documents)
SELECT unnest(list_reduce(list({'k': k, 'ok': [doc_id]} ORDER BY doc_id), lambda a, b: CASE WHEN list_has_any(a.k, b.k) THEN a ELSE {'k': list_concat(a.k, b.k), 'ok': list_concat(a.ok, b.ok)} END).ok) AS ordinal FROM k""")
def greedy_merge(spark, sf_dir):
    """J1 phase B: documents accepted in order of id, where no accepted one before has the same text, or the same length and source."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ordinal"), F.sha2(F.lower(F.trim("text")).cast("binary"), 256).alias("_ref"), F.concat(F.col("n_chars").cast("string"), F.lit("|"), F.col("source")).alias("_cross"))
    return dedup.greedy(docs, ("_ref", "_cross"))


@register("SELECT doc_id, list_aggregate(list_distinct(list_transform(regexp_extract_all(text, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}'), lambda x: lower(x))), 'count') AS n_emails FROM documents WHERE regexp_matches(text, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}')")
def emails_distinct(spark, sf_dir):
    """E22, W6."""
    return table(spark, sf_dir, "documents").select("doc_id", F.size(text.emails(F.col("text"))).cast("long").alias("n_emails")).where("n_emails > 0")


@register("SELECT doc_id, len(list_distinct(list_transform(regexp_extract_all(text, '(?:\\+49|0)[\\s\\d/()-]{6,20}\\d'), lambda x: regexp_replace(trim(x), '\\s+', ' ', 'g')))) AS n_phones FROM documents WHERE regexp_matches(text, '(?:\\+49|0)[\\s\\d/()-]{6,20}\\d')")
def phones_distinct(spark, sf_dir):
    """E23."""
    docs = table(spark, sf_dir, "documents").where(F.col("text").rlike(text.PHONE))
    return docs.select("doc_id", F.size(text.phones(F.col("text"))).cast("long").alias("n_phones"))


@register("""SELECT url_key, count(*) AS n, min(page_id) AS first_page FROM (SELECT page_id, lower(regexp_extract(url, '^([^:/]+)://', 1)) || '://' || regexp_replace(lower(regexp_extract(url, '^[^:/]+://([^/?#]*)', 1)), '^www\\.', '') || regexp_replace(regexp_extract(url, '^[^:/]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS url_key FROM pages) GROUP BY 1""")
def url_canonical(spark, sf_dir):
    """Canonical URLs of pages."""
    return table(spark, sf_dir, "pages").groupBy(text.url_key(F.col("url")).alias("url_key")).agg(F.count("*").alias("n"), F.min("page_id").alias("first_page"))


_STRIP = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '(?is)<script.*?>.*?</script>', ' ', 'g'), '(?is)<style.*?>.*?</style>', ' ', 'g'), '(?is)<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"


@register(f"SELECT page_id, length(t) AS n_chars, sha256(t) AS digest FROM (SELECT page_id, {_STRIP.format('html')} AS t FROM pages)")
def html_text(spark, sf_dir):
    """E19."""
    t = text.html_text(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", t.alias("t")).select("page_id", F.length("t").cast("long").alias("n_chars"), F.sha2(F.col("t").cast("binary"), 256).alias("digest"))


@register("SELECT page_id, substr(" + _STRIP.format("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)") + ", 1, 200) AS title FROM pages")
def html_title(spark, sf_dir):
    """E20."""
    return table(spark, sf_dir, "pages").select("page_id", text.html_title(F.col("html")).alias("title"))


@register("""SELECT doc_id, length(t) AS n_chars, sha256(t) AS digest FROM (SELECT doc_id, array_to_string(list_filter(list_transform(string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)), lambda x: trim(regexp_replace(x, '[ \\t\u00a0]+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS t FROM documents)""")
def line_normalise(spark, sf_dir):
    """E21."""
    return table(spark, sf_dir, "documents").select("doc_id", text.normalise_space(F.col("text")).alias("t")).select("doc_id", F.length("t").cast("long").alias("n_chars"), F.sha2(F.col("t").cast("binary"), 256).alias("digest"))


_LINES = r"regexp_split_to_array(text, '\r\n|[\n\x0b\x0c\r\x{85}\x{2028}\x{2029}]')"


@register(f"""WITH l AS (SELECT doc_id, unnest({_LINES}) AS line, generate_subscripts({_LINES}, 1) AS i FROM documents WHERE text IS NOT NULL),
m AS (SELECT doc_id, trim(line) AS t, i, last_value(CASE WHEN starts_with(line, 'E') THEN 'e' WHEN starts_with(line, 'T') THEN 't' END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i) AS mk FROM l)
SELECT doc_id, coalesce(length(string_agg(t, chr(10) ORDER BY i) FILTER (mk = 'e' AND t <> '')), 0) AS n_e, coalesce(length(string_agg(t, chr(10) ORDER BY i) FILTER (mk = 't' AND t <> '')), 0) AS n_t FROM m GROUP BY doc_id""")
def section_split(spark, sf_dir):
    """Lines of documents by the last line that begins with a capital E or T."""
    s = text.sections(F.col("text"), {"e": "^E", "t": "^T"})
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", s.alias("s")).select("doc_id", F.length(F.col("s")["e"]).cast("long").alias("n_e"), F.length(F.col("s")["t"]).cast("long").alias("n_t"))


_STOP = r"a.on AND NOT b.hit AND ((b.t = '' AND len(a.kept) > 1) OR starts_with(b.t, '#') OR (len(a.kept) >= 3 AND NOT b.bullet))"


@register(rf"""SELECT doc_id, sha256(array_to_string(list_reduce(list_transform({_LINES}, lambda x: {{'on': false, 'done': false, 'kept': []::VARCHAR[], 't': trim(x), 'hit': ends_with(x, '.'), 'bullet': regexp_matches(x, '^[\s\x0b]*[-*•]')}}),
lambda a, b: {{'on': a.on OR b.hit, 'done': a.done OR ({_STOP}), 'kept': CASE WHEN NOT a.done AND (b.hit OR (a.on AND NOT ({_STOP}) AND b.t <> '')) THEN list_append(a.kept, b.t) ELSE a.kept END, 't': '', 'hit': false, 'bullet': false}},
{{'on': false, 'done': false, 'kept': []::VARCHAR[], 't': '', 'hit': false, 'bullet': false}}).kept, chr(10))) AS digest FROM documents WHERE text IS NOT NULL""")
def marker_capture(spark, sf_dir):
    """E5: lines from the first that ends with a full stop, by the rules of a section of three lines."""
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.sha2(text.section(F.col("text"), r"\.$", 3).cast("binary"), 256).alias("digest"))


#: Names of characters that the pages may hold; the ampersand comes last.
_NAMES = (
    "lt gt quot apos nbsp shy auml ouml uuml Auml Ouml Uuml szlig euro sect copy reg deg middot bull hellip ndash mdash lsquo rsquo sbquo ldquo rdquo bdquo laquo raquo trade "
    "eacute egrave ecirc agrave acirc ccedil ocirc ntilde times amp"
).split()
_ENTITY = "t"
for _name in _NAMES:
    _ENTITY = f"replace({_ENTITY}, '&{_name};', '{html5[_name + ';'].replace(chr(39), chr(39) * 2)}')"


@register(rf"""WITH a AS (SELECT page_id, html AS t FROM pages), b AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace({_ENTITY}, '(?s)<!--.*?-->', '', 'g'), '(?i)<li\b[^>]*>', chr(10) || '- ', 'g'), '(?i)<br\s*/?>|</p\s*>|</h[1-6]>', chr(10), 'g'), '(?s)</?[A-Za-z!][^>]*>', '', 'g') AS t FROM a),
c AS (SELECT page_id, {_ENTITY} AS t FROM b), d AS (SELECT page_id, array_to_string(list_filter(list_transform(string_split(replace(replace(t, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)), lambda x: regexp_replace(regexp_replace(x, '[ \t\x{{a0}}]+', ' ', 'g'), '^[\s\x0b\p{{Z}}]+|[\s\x0b\p{{Z}}]+$', '', 'g')), lambda x: x <> ''), chr(10)) AS t FROM c)
SELECT page_id, length(t) AS n_chars, sha256(t) AS digest FROM d""")
def html_lines(spark, sf_dir):
    """Pages as lines of text, with their characters resolved."""
    return table(spark, sf_dir, "pages").select("page_id", text.strip_html(F.col("html")).alias("t")).select("page_id", F.length("t").cast("long").alias("n_chars"), F.sha2(F.col("t").cast("binary"), 256).alias("digest"))


@register("SELECT event_id, json_extract_string(props, '$.k') AS v, '' AS missing FROM events")
def json_variant_pick(spark, sf_dir):
    """The first path that a JSON object has."""
    from korbwerk.sources import portals

    v = portals.ld_objects(F.array("props"))[0]
    return table(spark, sf_dir, "events").select("event_id", v.alias("v")).select("event_id", portals.pick(F.col("v"), "$.nothing", "$.k").alias("v"), portals.pick(F.col("v"), "$.nothing").alias("missing"))


@register("""WITH o AS (SELECT o_orderkey, o_orderkey % 7 AS c, extract(month FROM o_orderdate)::INT AS m, strftime(o_orderdate, '2026-%m-%d') AS d FROM orders)
SELECT o_orderkey, CASE WHEN c IN (0, 1, 5) THEN 2026 WHEN c IN (2, 4) THEN 2027 END AS year, CASE WHEN c IN (0, 1, 5) THEN m WHEN c = 2 THEN 9 END AS month, CASE WHEN c IN (0, 1, 5) THEN d END AS date FROM o""")
def date_extract(spark, sf_dir):
    """Start dates of order dates in an ISO field, announced in a text, by a month's name in the second text, before a deadline, only in the category, after a full stop, and glued to letters."""
    day, c = F.concat(F.date_format("o_orderdate", "dd.MM."), F.lit("2026")), F.col("o_orderkey") % 7
    iso = F.when(c == 0, F.date_format("o_orderdate", "'2026-'MM-dd")).otherwise("")
    first = F.when(c == 1, F.concat(F.lit("Wir freuen uns.\nBeginn: "), day)).when(c == 3, F.concat(F.lit("Bewerbungsschluss ist am "), day)).when(c == 5, F.concat(F.lit("Los geht es."), day)).when(c == 6, F.concat(F.lit("Nummer A"), day)).otherwise("")
    second = F.when(c == 2, F.lit("Ausbildungsstart ist im September 2027")).otherwise("")
    start = dates.start_date(iso, [first, second], F.when(c == 4, "azubiyo_2027").otherwise("azubiyo"))
    return table(spark, sf_dir, "orders").select("o_orderkey", start.alias("s")).select("o_orderkey", "s.*")


def _scored(field: str, token: str) -> str:
    """SQL of one token's score in one field."""
    words = f"list_filter(string_split({field}, ' '), lambda w: starts_with(w, '{token}'))"
    return f"(CASE WHEN {field} = '{token}' THEN 110 WHEN {words}[1] = '{token}' THEN 95 WHEN len({words}) > 0 THEN 80 WHEN length('{token}') > 2 AND contains({field}, '{token}') THEN 100 - least(strpos({field}, '{token}') - 1, 40) ELSE 0 END)"


@register(f"WITH b AS (SELECT p_partkey, greatest({_scored('lower(p_name)', 'ring')}, {_scored('lower(p_type)', 'ring')})::INT AS score FROM part) SELECT * FROM b WHERE score > 0")
def search_ranked(spark, sf_dir):
    """Q-3 to Q-6: parts for one token, in two fields."""
    return search.search(search.searchable(table(spark, sf_dir, "part"), ["p_name", "p_type"]), "Ring").select("p_partkey", F.col("score").cast("int").alias("score"))


@register(f"WITH b AS (SELECT p_partkey, greatest({_scored('lower(p_name)', 'e')}, {_scored('lower(p_type)', 'e')}) AS s1, greatest({_scored('lower(p_name)', 'idg')}, {_scored('lower(p_type)', 'idg')}) AS s2 FROM part) SELECT p_partkey, (s1 + s2)::INT AS score FROM b WHERE s1 > 0 AND s2 > 0")
def search_tokens(spark, sf_dir):
    """Q-5, Q-6: parts for two tokens, both of which must be found; a short one only at a word's begin."""
    return search.search(search.searchable(table(spark, sf_dir, "part"), ["p_name", "p_type"]), " É  idg").select("p_partkey", F.col("score").cast("int").alias("score"))


@register(f"SELECT count(*) FILTER (greatest({_scored('lower(p_name)', 'red')}, {_scored('lower(p_type)', 'red')}) > 0) AS n, (SELECT count(*) FROM part) AS n_all FROM part")
def search_count_empty(spark, sf_dir):
    """Q-7: how many parts match a query, and an empty one."""
    rows = search.searchable(table(spark, sf_dir, "part"), ["p_name", "p_type"])
    return search.match_count(rows, "red").crossJoin(search.match_count(rows, " ").withColumnRenamed("n", "n_all"))  # one row each


@register("SELECT 'segment' AS type, lower(c_mktsegment) AS norm, arg_min(c_mktsegment, c_custkey) AS value, count(*) AS n FROM customer GROUP BY 2")
def suggest_index(spark, sf_dir):
    """A17."""
    return search.suggestions(table(spark, sf_dir, "customer"), {"segment": F.col("c_mktsegment")}, "c_custkey")


@register("""WITH i AS (SELECT 'type' AS type, lower(p_type) AS norm, arg_min(p_type, p_partkey) AS value, count(*) AS n FROM part GROUP BY 2 UNION ALL
SELECT 'brand', trim(regexp_replace(lower(p_brand), '[^a-z0-9@.\\s-]+', ' ', 'g')), arg_min(p_brand, p_partkey), count(*) FROM part GROUP BY 2),
s AS (SELECT *, (CASE WHEN norm = 'br' THEN 200 WHEN starts_with(norm, 'br') THEN 150 - least(length(norm) - 2, 30) WHEN contains(norm, 'br') THEN 120 - (strpos(norm, 'br') - 1) WHEN regexp_matches(norm, ' br') THEN 90 WHEN regexp_matches(norm, 'b.*r') THEN 50 ELSE 0 END + least(n, 20))::INT AS score FROM i),
r AS (SELECT type, norm, n, score, row_number() OVER (PARTITION BY type ORDER BY score DESC, n DESC, value) AS rank FROM s WHERE score > 0) SELECT * FROM r WHERE rank <= 5 ORDER BY type, rank LIMIT 18""")
def suggest_topk(spark, sf_dir):
    """O5, Q-8."""
    index = search.suggestions(table(spark, sf_dir, "part"), {"type": F.col("p_type"), "brand": F.col("p_brand")}, "p_partkey")
    return search.suggest(index, "br").select("type", "norm", "n", "score", "rank")


@register("SELECT 'lang' AS facet, lang AS value, count(*) AS n FROM documents GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY 2")
def facets(spark, sf_dir):
    """A16."""
    return search.facets(table(spark, sf_dir, "documents"), ["lang", "source"])


@register("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1")
def newest_snapshot(spark, sf_dir):
    """The latest event of each user."""
    return merge.latest(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts"), ["user_id"], F.struct("ts", "event_id")).drop("ts")


@register("""WITH e AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS state FROM events GROUP BY 1) SELECT coalesce(c_custkey, user_id) AS c_custkey, c_name, coalesce(nullif(state, ''), CASE WHEN c_custkey IS NOT NULL THEN 'pending' END) AS state FROM customer FULL JOIN e ON c_custkey = user_id""")
def upsert_state(spark, sf_dir):
    """Stored states of users stay, customers' rows are refreshed."""
    e = table(spark, sf_dir, "events")
    stored = e.groupBy(F.col("user_id").alias("c_custkey")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("state")).select("c_custkey", F.lit(None).cast("string").alias("c_name"), "state")
    fresh = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.lit("pending").alias("state"))
    return merge.upsert_state(stored, fresh, "c_custkey", ["state"])


@register("SELECT c_custkey, list_filter(['name', CASE WHEN c_acctbal < 0 THEN 'email' END, CASE WHEN c_nationkey > 12 THEN 'telefon' END], lambda x: x IS NOT NULL)[1] AS first_gap FROM customer")
def contact_gaps(spark, sf_dir):
    """A18."""
    g = audit.contact_gaps(F.lit(""), F.when(F.col("c_acctbal") >= 0, "a@b.de"), F.when(F.col("c_nationkey") <= 12, "0123"), F.lit(""), F.lit(""), F.lit(""))
    return table(spark, sf_dir, "customer").select("c_custkey", g.alias("g")).select("c_custkey", F.get("g.fehlend_vorher", F.lit(0)).alias("first_gap"))


@register("SELECT l_returnflag, l_linestatus, sum(n) AS scraped, sum(f) AS failed, sum(k) AS skipped, sum(n) / (sum(n) + sum(f) + sum(k)) AS success_rate FROM (SELECT l_returnflag, l_linestatus, (l_quantity > 10)::INT AS n, (l_quantity <= 5)::INT AS f, (l_quantity > 5 AND l_quantity <= 10)::INT AS k FROM lineitem) GROUP BY ALL")
def success_rate(spark, sf_dir):
    """A14, A21."""
    q = F.col("l_quantity")
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", (q > 10).cast("int").alias("scraped"), (q <= 5).cast("int").alias("failed"), ((q > 5) & (q <= 10)).cast("int").alias("skipped"))
    return audit.success(rows, ["l_returnflag", "l_linestatus"])


@register("SELECT c_custkey, lower(regexp_replace(c_name, '[^A-Za-z0-9]+', '', 'g')) AS company_key, trim(regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM customer")
def keys_and_slugs(spark, sf_dir):
    """P30, P32."""
    return table(spark, sf_dir, "customer").select("c_custkey", text.company_key(F.col("c_name")).alias("company_key"), text.slug(F.col("c_name")).alias("slug"))


@register("SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def value_counts(spark, sf_dir):
    """A1, A2, O3: customers by nation; the nations' table is small enough for Spark to broadcast by its size."""
    joined = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return audit.value_counts(joined, "n_name")


@register("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_windows_stream(spark, sf_dir):
    """Structured Streaming over the events file: tumbling windows, all input read once, the complete result of the last micro-batch."""
    from uuid import uuid4

    from korbwerk.plans.checkpoint import ensure_checkpoint_dir, remove
    from korbwerk.streaming import ingest

    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/events-{uuid4().hex}"
    events = spark.readStream.schema(table(spark, sf_dir, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = ingest.windowed_counts(events, "ts", "event_type")
    counts.writeStream.outputMode("complete").foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{folder}/out")).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    remove(spark, f"{folder}/state")
    return spark.read.parquet(f"{folder}/out").select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n")


@register("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 2 = 1 UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0")
def cache_union(spark, sf_dir):
    """Current rows and the cached ones that they don't have; odd customers are current, all are cached."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_custkey").alias("ordinal"))
    return merge.append_new(rows.where("c_custkey % 2 = 1"), rows, "c_custkey").drop("ordinal")


@register("SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN 'run' ELSE 'master' END AS origin FROM customer WHERE c_nationkey <> 3 OR c_custkey % 2 = 0")
def source_refresh(spark, sf_dir):
    """Rows of one nation vanish, those of this run come."""
    master = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.lit("master").alias("origin"))
    run = master.where("c_nationkey = 3 and c_custkey % 2 = 0").withColumn("origin", F.lit("run"))
    return merge.refresh_source(master, run, F.col("c_nationkey") == 3).drop("c_nationkey")


@register("SELECT event_id, user_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS delta FROM events")
def last_delta(spark, sf_dir):
    """W9."""
    from korbwerk.operators import progress

    return progress.changes(table(spark, sf_dir, "events"), "user_id", "event_id", "value").select("event_id", "user_id", "delta")


@register("SELECT DISTINCT user_id FROM events WHERE event_type = (SELECT min(event_type) FROM events) AND user_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def resume_pending(spark, sf_dir):
    """Users of one event type without a finished order."""
    events = table(spark, sf_dir, "events")
    first = events.agg(F.min("event_type").alias("event_type"))
    users = events.join(F.broadcast(first), "event_type", "left_semi").select("user_id").distinct()  # one row
    return merge.pending(users, table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("user_id")), "user_id")
