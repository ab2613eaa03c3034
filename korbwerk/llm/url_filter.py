"""Operator 5: weighted URL vocabulary.

An Aho-Corasick automaton finds weighted terms in a URL; a hit counts only between boundaries (neither neighbour is a letter or digit), and each term once. A weight of LIMIT
in all rejects the URL: one strict term has it alone, soft terms add up to it. The vocabulary is a parameter: weights by term, or a table of them. Allow and block rules (a host with its subdomains, and a path prefix) go first: the longest
rule that fits decides. Every row is judged alone: no shuffle, and the automaton has the size of the vocabulary.

Null or a URL without "://": host and path are empty, no rule fits, and the vocabulary decides over what there is (null has no hits: allow). Ties,
repeated rows and extra columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from korbwerk.llm.common import table

#: Weighted terms in two classes. A URL falls at LIMIT, summed over distinct terms: one strict term, or as many soft terms as it takes.
LIMIT, STRICT, SOFT = 2, 2, 1
STRICT_TERMS = (
    "adultfriend", "bestiality", "bukkake", "casino", "casinos", "crackz", "deepfakes", "escort", "escorts", "fakeid", "hentai", "jackpot", "keygen", "keygens", "malware", "milf", "onlinecasino", "pharmacyonline",
    "phishing", "porn", "porno", "pornos", "ransomware", "serialz", "spam", "spyware", "stripclub", "torrentz", "viagra", "warez", "xnxx", "xvideos", "xxx",
)
SOFT_TERMS = (
    "ads", "adult", "affiliate", "bet", "bets", "betting", "bonus", "cheap", "cheats", "click", "clickbait", "coupon", "coupons", "crack", "cracked", "dating", "deal", "deals", "discount", "download", "downloads", "forex", "free", "gamble",
    "gambling", "hack", "hacks", "hookup", "hot", "loan", "loans", "lottery", "nude", "nudes", "payday", "pills", "poker", "popup", "prize", "prizes", "promo", "referral", "replica", "replicas", "sex", "sexy", "singles", "slots",
    "torrent", "torrents", "unlimited", "voucher", "win", "winner", "winners", "xxl",
)
VOCABULARY = {t: STRICT for t in STRICT_TERMS} | {t: SOFT for t in SOFT_TERMS}
#: Terms that a vocabulary from a table may have: it is sent to all tasks.
VOCABULARY_ROWS = 1_000_000
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
SCHEMA = "page_id long, host string, path string, rule string, verdict string, n_strict int, n_soft int, weight int"

_FOLD = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z in lower case) and path of a URL."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((i for i in (rest.find(c) for c in "?#") if i >= 0), default=len(rest))
    host, slash, path = rest[:end].partition("/")
    return host.translate(_FOLD), slash + path


def pick_rule(host: str, path: str, rules: Sequence[tuple[str, str]]) -> tuple[str | None, str | None]:
    """The longest rule that fits, and its verdict."""
    best: tuple[str | None, str | None] = (None, None)
    for rule, verdict in rules:
        at = rule.index("/")
        if (host == rule[:at] or host.endswith("." + rule[:at])) and path.startswith(rule[at:]) and (best[0] is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best


class Vocabulary:
    """Weighted terms in one automaton."""

    def __init__(self, terms: Mapping[str, int]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for term, weight in terms.items():
            self.automaton.add_word(term.translate(_FOLD), (weight, len(term)))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def hits(self, url: str | None) -> list[int]:
        """The weights of the different terms between boundaries."""
        if not url or self.empty:
            return []
        text = url.translate(_FOLD)
        found = {}
        for last, (weight, size) in self.automaton.iter(text):
            first = last - size
            if not (first >= 0 and text[first].isalnum()) and not (last + 1 < len(text) and text[last + 1].isalnum()):
                found[text[first + 1 : last + 1]] = weight
        return list(found.values())


def read_vocabulary(terms: DataFrame, most: int = VOCABULARY_ROWS) -> dict[str, int]:
    """Term and weight from a table; of equal terms the largest weight. Null and empty terms are left out; more than `most` terms are an error, as they are sent to every task."""
    rows = terms.select(F.col("term").cast("string").alias("term"), F.col("weight").cast("int").alias("weight")).where("term <> '' and weight is not null").groupBy("term").agg(F.max("weight").alias("weight")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} terms")
    return {r["term"]: r["weight"] for r in rows}


def filter_urls(pages: DataFrame, vocabulary: Mapping[str, int] | DataFrame = VOCABULARY, limit: int = LIMIT, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, n_strict, n_soft and weight of every page. vocabulary: weights by term, or a table of term and weight; a term is strict if it weighs `limit` alone."""
    terms = read_vocabulary(vocabulary) if isinstance(vocabulary, DataFrame) else dict(vocabulary)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Vocabulary(terms)
        for batch in batches:
            out = []
            for url in batch.column(1).to_pylist():
                host, path = split_url(url)
                rule, verdict = pick_rule(host, path, rules)
                hits = automaton.hits(url)
                strict, weight = sum(w >= limit for w in hits), sum(hits)
                out.append((host, path, rule, verdict or ("block" if weight >= limit else "allow"), strict, len(hits) - strict, weight))
            kinds = [pa.string()] * 4 + [pa.int32()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds))], ["page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft", "weight"])

    return pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url").mapInArrow(judge, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def _sql_hits(terms: Sequence[str]) -> str:
    return " + ".join(f"regexp_matches(u, '(^|[^\\p{{L}}\\p{{N}}]){t}($|[^\\p{{L}}\\p{{N}}])')::INT" for t in terms)


def _sql() -> str:
    fits = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'" for h, p in ((r[: r.index("/")], r[r.index("/") :]) for r, _ in sorted(RULES, key=lambda r: -len(r[0]))))
    verdicts = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in RULES)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
    WITH a AS (SELECT page_id, translate(coalesce(url, ''), '{upper}', '{lower}') AS u,
                      CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest FROM pages),
    b AS (SELECT page_id, u, translate(regexp_extract(rest, '^[^/]*'), '{upper}', '{lower}') AS host,
                 CASE WHEN contains(rest, '/') THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path FROM a),
    c AS (SELECT *, CASE {fits} END AS rule, ({_sql_hits(STRICT_TERMS)})::INT AS n_strict, ({_sql_hits(SOFT_TERMS)})::INT AS n_soft FROM b)
    SELECT page_id, host, path, rule, CASE rule {verdicts} ELSE CASE WHEN {STRICT} * n_strict + {SOFT} * n_soft >= {LIMIT} THEN 'block' ELSE 'allow' END END AS verdict, n_strict, n_soft, ({STRICT} * n_strict + {SOFT} * n_soft)::INT AS weight FROM c"""


ORACLE_SQL = _sql()
