"""The pipeline on a small corpus: what each stage must drop, change and keep."""

import random

import corpus_pipeline
from korbwerk.llm import bpe
from korbwerk.llm.token_counts import load_tokenizer, tokenizer_path


def test_pipeline(spark, tmp_path):
    rng = random.Random(9)
    text = lambda n=60: " ".join(f"word{rng.randint(0, 9999)}" for _ in range(n))
    clean = [text() for _ in range(40)]
    item = text(20)
    docs = {i: t for i, t in enumerate(clean)}
    docs |= {100: clean[0], 101: clean[1] + " more", 102: "too short", 103: " | ".join(text(40).split()), 104: f"{text(20)} {item} {text(20)}", 105: f"{text(30)} write to some.body@example.org now", 106: None, 107: text(400) + " " + item}
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(range(2, 40)) | {0, 105} <= set(rows)
    assert not {100, 102, 103, 104, 106} & set(rows) and 107 in rows  # 20 of 420 words: less than a twentieth
    tokenizer = load_tokenizer(tokenizer_path(bpe.TOKENIZER))
    assert rows[5].ids == tokenizer.encode(clean[5]).ids
    assert "example" not in rows[105].decoded and "email</w>" in rows[105].decoded
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "sanitisation", "encoding"]


def test_stages_on_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in (s for s in corpus_pipeline.STAGES if s[0] != "decontamination"):
        assert stage(spark, docs, "").count() == 0
