"""A paged JSON API as a Spark source, and fetching behind a cache (S7 to S10, S13, S14, S19); discovery page after page is in streaming/discovery.py.

    spark.dataSource.register(PagedApi)
    spark.read.format("paged_api").options(url="https://host/jobs", query="x", size=25, pages=40).load()

Each page is a partition, so the number of tasks that run bounds the number of requests at once; each task waits `interval` seconds before a request and tries again, with growing waits, after
answers that say so. With `stop_at_total` the first page is asked while planning and tells how many pages there are; `parallel` is how many tasks run at once, so that the interval holds for all of them. A page that can't be had is a row with its error, so that one failure doesn't end the run.
"""

from __future__ import annotations

import json
import time
from codecs import getincrementaldecoder
from collections.abc import Iterator
from urllib.error import HTTPError, URLError
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit
from urllib.request import Request, urlopen

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from korbwerk.functions.text import emails, host, html_description, html_text, html_title, phones

# Pauses and limits of the public API, answers after which a request is tried again.
INTERVAL, TIMEOUT, RETRIES, BACKOFF, PAGE_SIZE = 0.3, 30, 3, 2.0, 25
AGAIN = (429, 500, 502, 503, 504)
# How much of a fetched page is read, and what is kept of it.
PAGE_CHARS, SAMPLE_CHARS, PAGE_EMAILS, PAGE_PHONES = 500_000, 3000, 5, 3


def fetch(url: str, headers: dict[str, str], interval: float = INTERVAL, retries: int = RETRIES, backoff: float = BACKOFF, most: int | None = None) -> str:
    """The text behind a URL, or its first `most` characters; no more is read than they can take."""
    for attempt in range(retries + 1):
        time.sleep(interval)
        try:
            with urlopen(Request(url, headers=headers), timeout=TIMEOUT) as answer:  # noqa: S310
                data = answer.read() if most is None else answer.read(4 * most)
                # a character that the end cuts is left out
                return getincrementaldecoder("utf-8")().decode(data, final=most is None or len(data) < 4 * most)[:most]
        except (HTTPError, URLError, TimeoutError) as e:
            if attempt == retries or (isinstance(e, HTTPError) and e.code not in AGAIN):
                raise
            time.sleep(backoff**attempt)
    raise AssertionError


class Page(InputPartition):
    def __init__(self, number: int):
        self.number = number


class PagedApiReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        o = self.options
        pages, first = int(o.get("pages", "1")), None
        if o.get("stop_at_total", "").lower() == "true":
            # The first page tells how many there are
            first = json.loads(self.ask(1, float(o.get("interval", INTERVAL)))).get("maxErgebnisse")
        return [Page(i) for i in range(1, (pages if first is None else min(pages, -(-int(first) // int(o.get("size", PAGE_SIZE))))) + 1)]

    def ask(self, page: int, interval: float) -> str:
        o = self.options
        asked = {"was": o.get("query", ""), "angebotsart": o.get("kind", ""), "page": page, "size": o.get("size", str(PAGE_SIZE))}
        url = o["url"].format(**asked) if "{" in o["url"] else f"{o['url']}?{urlencode({k: v for k, v in asked.items() if v != ''})}"
        return fetch(url, {"X-API-Key": o["key"]} if "key" in o else {}, interval, int(o.get("retries", RETRIES)), float(o.get("backoff", BACKOFF)))

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        o = self.options
        try:
            # `parallel` tasks that each wait that much longer keep the interval between all requests
            found = json.loads(self.ask(partition.number, float(o.get("interval", INTERVAL)) * int(o.get("parallel", "1"))))
            for i, row in enumerate(found.get("ergebnisliste") or []):
                yield partition.number, i, found.get("maxErgebnisse"), row.get("referenznummer"), json.dumps(row, ensure_ascii=False), None
        except (HTTPError, URLError, TimeoutError, ValueError) as e:
            yield partition.number, 0, None, None, None, str(e)[:500]


class PagedApi(DataSource):
    """Rows of all pages, in page order: page, place, total, referenznummer, payload (JSON), error."""

    @classmethod
    def name(cls) -> str:
        return "paged_api"

    def schema(self) -> str:
        return "page int, place int, total long, referenznummer string, payload string, error string"

    def reader(self, schema) -> DataSourceReader:
        return PagedApiReader(dict(self.options))


def fetch_details(refs: DataFrame, url: str, headers: dict[str, str] | None = None, parallel: int = 1, interval: float = INTERVAL, retries: int = RETRIES, backoff: float = BACKOFF) -> DataFrame:
    """Ordinal, referenznummer, payload and error of each reference, by `parallel` tasks; `{id}` in the URL is the reference in base64. A reference that stands there twice is asked once, at its first place; order by ordinal."""
    wanted = refs.where("referenznummer is not null").groupBy("referenznummer").agg(F.min("ordinal").cast("long").alias("ordinal")).select("ordinal", "referenznummer")

    def run(batches: Iterator) -> Iterator:
        from base64 import b64encode

        for batch in batches:
            payloads, errors = [], []
            for ref in batch["referenznummer"]:
                try:
                    payloads.append(fetch(url.replace("{id}", b64encode(ref.encode()).decode()), headers or {}, interval * parallel, retries, backoff))
                    errors.append(None)
                except (HTTPError, URLError, TimeoutError, ValueError) as e:
                    payloads.append(None)
                    errors.append(str(e)[:500])
            yield batch.assign(payload=payloads, error=errors)

    return wanted.repartition(parallel).mapInPandas(run, "ordinal long, referenznummer string, payload string, error string")


def page_url(url: str, page: int, defaults: dict[str, str] | None = None) -> str:
    """A search URL for one page: its query with the page set and the defaults that it lacks."""
    parts = urlsplit(url)
    query = dict(reversed(parse_qsl(parts.query, keep_blank_values=True)))  # of a name that stands there twice, the first
    asked = {k: query[k] for k, _ in parse_qsl(parts.query, keep_blank_values=True)} | {"page": str(page)}
    return urlunsplit(parts._replace(query=urlencode({**asked, **{k: v for k, v in (defaults or {}).items() if k not in asked}}), fragment=""))


def first_shard(rows: DataFrame, key: str, shard: str) -> DataFrame:
    """Rows of several searches, of each key that of the first search."""
    return rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), shard).alias("_row")).select("_row.*")


def fetch_sites(urls: DataFrame, cache: DataFrame, headers: dict[str, str] | None = None, parallel: int = 1, interval: float = INTERVAL, retries: int = 0) -> DataFrame:
    """Sites that the cache lacks, each fetched once: url, ok, title, meta_description, text_sample, emails, phones, error. Append the result to the cache.

    urls, cache: with `url`. All URLs of a host are fetched by one task, one after the other, so the interval holds for each host.
    """
    missing = urls.select("url").where("url is not null").distinct().join(cache.select("url"), "url", "left_anti")

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            pages, errors = [], []
            for url in batch["url"]:
                try:
                    pages.append(fetch(url, headers or {}, interval, retries, most=PAGE_CHARS))
                    errors.append("")
                except (HTTPError, URLError, TimeoutError, ValueError) as e:
                    pages.append(None)
                    errors.append(str(e)[:200])
            yield batch.assign(html=pages, error=errors)

    pages = missing.repartition(parallel, host(F.col("url"))).mapInPandas(run, "url string, html string, error string")
    read = pages.select("url", "html", "error", html_text(F.col("html")).alias("_text"))
    return read.select(
        "url", F.col("html").isNotNull().alias("ok"), html_title(F.col("html")).alias("title"), html_description(F.col("html")).alias("meta_description"), F.substring("_text", 1, SAMPLE_CHARS).alias("text_sample"),
        F.slice(emails(F.col("_text")), 1, PAGE_EMAILS).alias("emails"), F.slice(phones(F.col("_text")), 1, PAGE_PHONES).alias("phones"), "error",
    )


def last_records(records: DataFrame, path: str = "$.id") -> DataFrame:
    """Of JSON records that were caught while a page was scrolled (ordinal, payload) the last one of each id; without an id they are left out."""
    keyed = records.select(F.get_json_object("payload", path).alias("id"), "ordinal", "payload").where("id is not null")
    return keyed.groupBy("id").agg(F.max_by("payload", "ordinal").alias("payload"))
