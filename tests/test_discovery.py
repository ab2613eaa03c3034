"""Result pages as a stream."""

import json

import pytest
from pyspark.errors import StreamingQueryException

from korbwerk.streaming.discovery import Discovery

PATTERN = r'href="/job/([^"]+)"'


def site(folder, pages):
    for i, ids in enumerate(pages, 1):
        page = folder / f"page={i}"
        page.mkdir(parents=True, exist_ok=True)
        (page / "part.txt").write_text("".join(f'<a href="/job/{x}">ä</a>\n' for x in ids))
        (page / "_SUCCESS").write_text('<a href="/job/hidden">')


def discover(spark, home, pages, ahead="2", **ends):
    found = Discovery(spark, f"{home}/ids", **ends)
    return found, found.run(f"{home}/site/page={{page}}", PATTERN, pages, f"{home}/checkpoint", ahead=ahead)


def ids(rows):
    return sorted((r.id, r.page, r.place) for r in rows.collect())


STALE = [["b", "a", "a"], ["a"], ["c"], ["c", "a"], ["b"], ["d"]]


@pytest.mark.parametrize(
    ("pages", "most", "ends", "want", "last"),
    [
        (STALE, 6, {}, "ab", 2),
        (STALE, 6, {"stagnant": 2}, "abc", 5),
        (STALE, 6, {"stagnant": 9}, "abcd", 6),
        (STALE, 1, {}, "ab", 1),
        (STALE, 6, {"expected": 2}, "ab", 1),
        ([["a"], [], ["b"]], 3, {"stagnant": 9}, "a", 2),
    ],
)
def test_where_pages_end(spark, tmp_path, pages, most, ends, want, last):
    site(tmp_path / "site", pages)
    found, rows = discover(spark, tmp_path, most, **ends)
    assert "".join(x for x, _, _ in ids(rows)) == want
    assert found.ids.manifest()["mark"]["page"] == last


def test_goes_on_where_it_failed(spark, tmp_path):
    site(tmp_path / "site", [["a", "b"], ["c"]])
    with pytest.raises(StreamingQueryException):
        discover(spark, tmp_path, 5)
    site(tmp_path / "site", [["x"], ["x"], ["c", "d"], ["e", "a"], ["f"]])  # pages 1 and 2 aren't read again
    found, rows = discover(spark, tmp_path, 5)
    assert ids(rows) == [("a", 1, 0), ("b", 1, 1), ("c", 2, 0), ("d", 3, 1), ("e", 4, 0), ("f", 5, 0)]
    # a batch that runs again changes nothing
    found.add(spark.createDataFrame([(5, 0, "f"), (5, 1, "z")], "page int, place int, id string"), 2)
    assert len(ids(found.ids.read())) == 6
    # nor does another run, and compacting keeps what the manifest says
    found.ids.compact()
    assert ids(discover(spark, tmp_path, 5)[1]) == ids(rows)
    assert json.loads(json.dumps(found.ids.manifest()["mark"])) == {"read": 5, "page": 5, "idle": 0, "known": 6, "ended": False}


def test_batches_grow_with_the_pages_that_were_read(spark, tmp_path):
    site(tmp_path / "site", [[f"{i}", f"{i - 1}"] for i in range(1, 31)])
    found, rows = discover(spark, tmp_path, 30)
    assert ids(rows) == sorted([("0", 1, 1), *((f"{i}", i, 0) for i in range(1, 31))])
    assert [found.ids.manifest(n + 1)["mark"]["read"] for n in range(len(found.ids.names()))] == [2, 4, 6, 9, 13, 19, 28, 30]
