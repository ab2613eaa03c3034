"""Operator 3: benchmark rows without an id."""

import hashlib

from korbwerk.llm import decontaminate
from tests.llm.test_text_operators import docs_of


def test_an_item_without_an_id_contaminates(spark):
    own, named = " ".join(f"a{i}" for i in range(20)), " ".join(f"b{i}" for i in range(20))
    benchmark = spark.createDataFrame([(None, own), (7, named), (None, None)], "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.score_documents(docs_of(spark, [own, named, f"{own} {named}", "clean"]), benchmark).collect()}
    assert [(rows[i].n_hit, rows[i].n_items, rows[i].contaminated) for i in range(4)] == [(20, 0, True), (20, 1, True), (40, 1, True), (0, 0, False)]
    assert rows[0].items_sha256 == hashlib.sha256(b"").hexdigest() and rows[2].items_sha256 == hashlib.sha256(b"7").hexdigest()
    assert [r.doc_id for r in decontaminate.remove_contaminated(docs_of(spark, [own, named, "clean"]), benchmark).collect()] == [2]
