"""Discovery of listings page after page, as a stream.

Result pages are read by `ahead` tasks at a time, at first a page by each. A batch has half as many pages as were read before it, if that is more, so that the number of batches, and with it
what they look up again, grows with the logarithm of the pages. The stream's offsets are page numbers. Ids go to a table of deltas by key bucket, and a batch looks
its own ids up in their buckets, so no task and no driver holds the ids that are known. Where the pages end, how many are stale and how many ids are known stands in the table's manifest, which is
committed with the batch's ids: a run that fails goes on at the pages of the batch that failed, and reads none before them again. A page that can't be had fails its batch.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from korbwerk.plans.checkpoint import materialise
from korbwerk.sources.api import BACKOFF, INTERVAL, RETRIES, fetch
from korbwerk.streaming.deltas import Deltas

#: Tasks of a batch, and its pages at least. Less than a batch is read beyond the last page that counts.
AHEAD = 8
#: Pages of a batch at most: the driver gets a row for each.
BATCH_PAGES = 1 << 14
#: Before the first page: pages that were read, the last that counts, stale ones before it, ids, and whether the pages have ended.
NOTHING = {"read": 0, "page": 0, "idle": 0, "known": 0, "ended": False}


def store(path: str):
    """A file system, and the path on it. Hadoop's `file:/x` is pyarrow's `file:///x`."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", path)) if urlsplit(path).scheme else (fs.LocalFileSystem(), path)


def files_of(path: str) -> Iterator[tuple[str, str]]:
    """Names and texts of the files in a folder, in order; hidden ones aren't read."""
    from pyarrow import fs

    system, at = store(path)
    for found in sorted(system.get_file_info(fs.FileSelector(at)), key=lambda f: f.base_name):
        if found.is_file and not found.base_name.startswith(("_", ".")):
            with system.open_input_stream(found.path) as stream:
                yield found.base_name, stream.read().decode()


def newest_mark(state: str) -> dict:
    """What the newest manifest says of the pages."""
    try:
        last = max((x for x in files_of(f"{state}/manifests") if x[0].endswith(".json")), default=None)
    except FileNotFoundError:
        last = None
    return json.loads(last[1])["mark"] if last else NOTHING


@dataclass
class Pages(InputPartition):
    """Pages that one task reads, one after another."""

    first: int
    last: int


class ResultPagesReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.options = options
        self.ahead = int(options.get("ahead", AHEAD))

    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self) -> dict:
        mark = newest_mark(self.options["state"])
        ahead = 0 if mark["ended"] else max(self.ahead, min(mark["read"] // 2, BATCH_PAGES))
        return {"page": min(mark["read"] + ahead, max(int(self.options["pages"]), mark["read"]))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        each = -(-(end["page"] - start["page"]) // self.ahead) or 1
        return [Pages(i, min(i + each - 1, end["page"])) for i in range(start["page"] + 1, end["page"] + 1, each)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for number in range(partition.first, partition.last + 1):
            yield from self.named(number)

    def named(self, number: int) -> Iterator[tuple]:
        o = self.options
        url = o["url"].replace("{page}", str(number))
        if urlsplit(url).scheme in ("http", "https"):
            text = fetch(url, {}, float(o.get("interval", INTERVAL)) * int(o.get("parallel", "1")), int(o.get("retries", RETRIES)), float(o.get("backoff", BACKOFF)))
        else:
            text = "".join(t for _, t in files_of(url))
        ids = dict.fromkeys(re.findall(o["pattern"], text))
        # a page without ids says so
        yield from ((number, i, x) for i, x in enumerate(ids or [None]))


class ResultPages(DataSource):
    """Ids that result pages name: page, place, id. Options: url with {page} (or a folder of saved files), pattern with one group (the id), pages (at most), state (the table of ids), ahead (tasks), interval, parallel, retries, backoff."""

    @classmethod
    def name(cls) -> str:
        return "result_pages"

    def schema(self) -> str:
        return "page int, place int, id string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ResultPagesReader(dict(self.options))


class Discovery:
    """Ids that a site's result pages name, each at its first page and place, in a table of deltas at `state`.

    Pages end after `pages`, at one without ids, at the last of `stagnant` in a row without a new one, or when `expected` ids are known; what later pages of the same batch name doesn't count.
    """

    def __init__(self, spark: SparkSession, state: str, stagnant: int = 1, expected: int | None = None):
        self.spark, self.state, self.stagnant, self.expected = spark, state, stagnant, expected
        self.ids = Deltas(spark, state, "id")

    def add(self, rows: DataFrame, batch: int) -> None:
        """A batch of pages. One that runs again gives the same, whatever it had written."""
        rows = materialise(rows)
        first = rows.where("id is not null").groupBy("id").agg(F.min(F.struct("page", "place")).alias("at")).select("id", "at.page", "at.place")
        known = self.ids.read(before=batch, buckets=self.ids.touched(first))
        fresh = materialise(first if known is None else first.join(known.select("id"), "id", "left_anti"))
        pages = rows.groupBy("page").agg(F.count("id").alias("named")).join(fresh.groupBy("page").agg(F.count("*").alias("fresh")), "page", "left").orderBy("page")
        mark = (self.ids.manifest(batch) or {}).get("mark") or NOTHING
        for page in pages.collect():  # BATCH_PAGES rows at most
            if mark["ended"]:
                mark = {**mark, "read": page.page}
                continue
            idle, total = 0 if page.fresh else mark["idle"] + 1, mark["known"] + (page.fresh or 0)
            mark = {"read": page.page, "page": page.page, "idle": idle, "known": total, "ended": not page.named or idle >= self.stagnant or (self.expected is not None and total >= self.expected)}
        self.ids.append(batch, fresh.where(F.col("page") <= mark["page"]), mark=mark)

    def start(self, url: str, pattern: str, pages: int, checkpoint: str, **options: str) -> StreamingQuery:
        self.spark.dataSource.register(ResultPages)
        read = self.spark.readStream.format("result_pages").options(url=url, pattern=pattern, pages=str(pages), state=self.state, **options).load()
        return read.writeStream.foreachBatch(self.add).option("checkpointLocation", checkpoint).start()

    def run(self, url: str, pattern: str, pages: int, checkpoint: str, **options: str) -> DataFrame | None:
        """Reads on until the pages end: id, page and place."""
        query = self.start(url, pattern, pages, checkpoint, **options)
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        found = self.ids.read()
        return None if found is None else found.select("id", "page", "place")
