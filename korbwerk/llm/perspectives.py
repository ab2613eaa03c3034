"""Operator 2: multi-party perspective rotation, in DataFrame functions only.

For every participant of a conversation the dialogue is rendered with that speaker as the assistant and all others as named users; system turns stay system turns
and are nobody's perspective. The loss mask is a list of code-point spans (end exclusive) of the rendered text: each of the assistant's texts with its end mark.

A conversation is rendered in parts of PART_TURNS consecutive turn numbers, each one row, so that one endless conversation is spread over many tasks; a
dialogue of fewer turns is one part, and the parts of a longer one follow each other (spans count from the part's begin; system turns stand only where they were said). With
part_turns=None every dialogue is one part, however long. Turns that share a number stand in order of speaker and text and are never parted.

The marks of a turn can't be forged: in texts and names `<|` is written `<\\|` (and `<\\` is `<\\\\`, so that this can be undone), and line ends in names are spaces.

Null or blank role: the speaker is "unknown". Null text is empty. Null turn: number -1. Null conv_id is a conversation like any other. Repeated rows are repeated turns.
A conversation of system turns only, or an empty table, gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from korbwerk.llm.common import table

PART_TURNS = 256
SYSTEM, UNKNOWN = "system", "unknown"
BEGIN, END = "<|turn|>", "<|end|>"


def escaped(x: Column) -> Column:
    return F.replace(F.replace(x, F.lit("<\\"), F.lit("<\\\\")), F.lit("<|"), F.lit("<\\|"))


def head(speaker: Column, perspective: Column) -> Column:
    who = F.when(speaker == SYSTEM, F.lit(SYSTEM)).when(speaker == perspective, F.lit("assistant")).otherwise(F.concat(F.lit("user name="), escaped(F.translate(speaker, "\r\n", "  "))))
    return F.concat(F.lit(BEGIN), who, F.lit("\n"))


def spans(turns: Column) -> Column:
    """begin:end of each masked stretch. turns: structs of head, body (text and end mark) and target."""
    ends = F.aggregate(
        turns,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("found")),
        lambda a, t: F.struct(
            (a["at"] + F.length(t["head"]) + F.length(t["body"]) + 1).alias("at"),
            F.when(t["target"], F.concat(a["found"], F.array(F.concat((a["at"] + F.length(t["head"])).cast("string"), F.lit(":"), (a["at"] + F.length(t["head"]) + F.length(t["body"])).cast("string"))))).otherwise(a["found"]).alias("found"),
        ),
        lambda a: a["found"],
    )
    return F.array_join(ends, ",")


def rotate(conversations: DataFrame, part_turns: int | None = PART_TURNS) -> DataFrame:
    """conv_id, perspective, part, n_turns, n_target, rendered, n_chars and mask of every participant's view."""
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(F.nullif(F.trim(F.col("role").cast("string")), F.lit("")), F.lit(UNKNOWN)).alias("speaker"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    people = turns.where(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective")).distinct()
    parts = turns.groupBy("conv_id", (F.floor(F.col("turn") / part_turns) if part_turns else F.lit(0)).cast("long").alias("part")).agg(F.sort_array(F.collect_list(F.struct("turn", "speaker", "text"))).alias("turns"))
    views = parts.join(people, F.col("conv_id").eqNullSafe(F.col("of")))
    shown = views.select(
        "conv_id", "perspective", "part",
        F.transform("turns", lambda t: F.struct(head(t["speaker"], F.col("perspective")).alias("head"), F.concat(escaped(t["text"]), F.lit(END)).alias("body"), (t["speaker"] == F.col("perspective")).alias("target"))).alias("turns"),
    )
    rendered = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit("\n"))), "")
    return shown.select(
        "conv_id", "perspective", "part", F.size("turns").cast("long").alias("n_turns"), F.size(F.filter("turns", lambda t: t["target"])).cast("long").alias("n_target"), rendered.alias("rendered"), spans(F.col("turns")).alias("mask"),
    ).withColumn("n_chars", F.length("rendered").cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))


def _sql_escaped(x: str) -> str:
    return f"replace(replace({x}, '<\\', '<\\\\'), '<|', '<\\|')"


ORACLE_SQL = f"""
WITH t AS (SELECT conv_id, coalesce(turn, -1) AS turn, floor(coalesce(turn, -1) / {PART_TURNS}.0)::BIGINT AS part, coalesce(nullif(trim(role), ''), '{UNKNOWN}') AS speaker, coalesce(text, '') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> '{SYSTEM}'),
r AS (SELECT t.conv_id, perspective, part, row_number() OVER (PARTITION BY t.conv_id, perspective, part ORDER BY turn, speaker, text) AS i, speaker = perspective AS target,
      '{BEGIN}' || CASE WHEN speaker = '{SYSTEM}' THEN '{SYSTEM}' WHEN speaker = perspective THEN 'assistant' ELSE 'user name=' || {_sql_escaped("translate(speaker, chr(13) || chr(10), '  ')")} END || chr(10) AS head, {_sql_escaped("text")} || '{END}' AS body
      FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
s AS (SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, part ORDER BY i) - length(body) - 1 AS pos FROM r)
SELECT conv_id, perspective, part, count(*) AS n_turns, count(*) FILTER (target) AS n_target, string_agg(head || body || chr(10), '' ORDER BY i) AS rendered,
       coalesce(string_agg(pos::BIGINT || ':' || (pos + length(body))::BIGINT, ',' ORDER BY i) FILTER (target), '') AS mask, sum(length(head) + length(body) + 1)::BIGINT AS n_chars
FROM s GROUP BY ALL"""
