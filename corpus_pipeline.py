"""The corpus pipeline: five stages, each one of the training-data operators, over `documents`.

Each stage takes what its predecessor kept, as rows of `documents`: quality rules drop rejected documents, near-duplicate groups keep one document, contaminated
documents go, personal data is generalised in the text, and what remains is encoded.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from korbwerk.llm import bpe, decontaminate, jaccard, pii, quality, simhash
from korbwerk.llm.common import table
from korbwerk.llm.token_counts import tokenizer_path
from korbwerk.plans.checkpoint import ensure_checkpoint_dir, remove

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs.select(*COLUMNS), jaccard.WIDTH, jaccard.SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def sanitisation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitise(docs.select(*COLUMNS))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, tokenizer_path(bpe.TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("sanitisation", sanitisation),
    ("encoding", encoding),
]

#: SQL expresses neither the quantile sketches nor the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What each stage returns is written to the shared checkpoint folder and read again; a stage's folder goes when the next one is written."""
    ensure_checkpoint_dir(spark)
    folder, before = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid4().hex}", None
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{name}"
    return docs
