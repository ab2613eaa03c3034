"""Links that contain a token, by pieces behind a filter."""

import random

from korbwerk.operators import dedup


def shuffled(spark) -> int:
    """Rows that all stages so far have shuffled."""
    sc = spark.sparkContext
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._gateway.jvm.double, 0), sc._gateway.jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def frames(spark, links, tokens):
    new = spark.createDataFrame([(i, x, "", None) for i, x in enumerate(links)], "ordinal long, link_bewerbung string, ba_job_url string, link_bewerbung_externe string")
    return new, spark.createDataFrame([(t,) for t in tokens], "token string")


def test_hardly_a_row_is_shuffled(spark):
    draw = random.Random(7)
    ids = [f"{draw.getrandbits(128):032x}" for _ in range(20_000)]
    links = [f"https://www.example.com/jobs/detail/{x}?from=list" for x in ids]
    tokens = [*ids[:50], "https://www.example.com/jobs/detail/none", *(f"{draw.getrandbits(128):032x}" for _ in range(200))]
    new, wanted = frames(spark, links, tokens)
    before = shuffled(spark)
    found = {r.ordinal for r in dedup.holds_token(new, wanted).collect()}
    assert found == set(range(50))
    # some 70 pieces a link were shuffled without the filters; what is left are pieces of tokens, three places in the filter for each, and links where a rare piece meets
    assert shuffled(spark) - before < 2 * len(links)


def test_against_all_pairs(spark):
    draw = random.Random(3)
    word = lambda n: "".join(draw.choice("abc/") for _ in range(n))
    links = [None, "", "short", "x" * 3000 + "needle-needle", *(word(draw.randint(5, 60)) for _ in range(300))]
    tokens = ["needle-needle", *{word(draw.randint(9, 12)) for _ in range(200)}, *(x[3:15] for x in links[10:40] if len(x) > 16)]
    new, wanted = frames(spark, links, tokens)
    assert {r.ordinal for r in dedup.holds_token(new, wanted).collect()} == {i for i, x in enumerate(links) if x and any(t in x for t in tokens)}


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(dedup, "MOST_BITS", 64)
    new, wanted = frames(spark, [f"https://a.de/{i:09d}/" for i in range(200)], [f"/{i:09d}/" for i in range(0, 400, 3)])
    assert {r.ordinal for r in dedup.holds_token(new, wanted).collect()} == set(range(0, 200, 3))


def test_no_tokens(spark):
    new, wanted = frames(spark, ["https://a.de/000000001"], [])
    assert dedup.holds_token(new, wanted).count() == 0
