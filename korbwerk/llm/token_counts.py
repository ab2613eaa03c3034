"""Operator 7: token counts with a two-tier lookup.

Text is cut where a single space stands between two other non-space characters: the byte-level pre-tokeniser always starts a pre-token at such a
space, so the token count of a text is the sum over its pieces (a piece holds one word and what is attached to it). Tier one is a compact table of the token
lengths of the most frequent pieces, broadcast to all tasks; it has FREQUENT entries at most. Tier two is a cache in each Python worker, kept from task to task and emptied at CACHE_BYTES
(common.py); pieces that are in neither go to the tokenizers library. No piece is a shuffle key anywhere. The table comes from a heavy-hitter sketch of REPORTED pieces over all texts: one
sketch leaves each task, sketches are merged in GROUPS groups by task number, and the driver merges those. The table only saves work: the counts don't depend on it.

A text that contains the string of an added token goes to the library whole. Null and empty texts have 0 bytes and 0 tokens. Rows are
independent: repeated rows give repeated results, an empty table an empty result, extra columns are ignored.
"""

from __future__ import annotations

import heapq
import os
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from korbwerk.llm.common import CACHE_BYTES, for_worker, slices, split_codes, sums, table

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
FREQUENT, REPORTED, LONGEST, GROUPS = 50_000, 10_000, 48, 512
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel units
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


#: A space between two characters that aren't white space. What Python calls white space holds all that the pre-tokeniser does.
CUT = re.compile(r"(?<=\S) (?=\S)")


def plain(piece: str) -> bool:
    """True if spaces on both sides of the piece are cuts."""
    return piece != "" and not piece[0].isspace() and not piece[-1].isspace()


class Lengths:
    """Token lengths of pieces: known[x] is that of a space and x, first[x] that of x at a text's start."""

    def __init__(self, tokenizer, seed: dict[str, int], cached: int = CACHE_BYTES):
        self.tokenizer, self.seed, self.cached = tokenizer, seed, cached
        self.known, self.first, self.held = dict(seed), {"": 0}, 0

    def trim(self) -> None:
        """Empties the caches if they hold more bytes than they may."""
        if self.held > self.cached:
            self.known, self.first, self.held = dict(self.seed), {"": 0}, 0

    def _add(self, to: dict[str, int], words: Iterable[str], before: str) -> None:
        missing = [w for w in words if w not in to]
        self.held += sum(map(len, missing)) + 120 * len(missing)
        for i in range(0, len(missing), 4096):
            part = missing[i : i + 4096]
            to.update((w, len(e.ids)) for w, e in zip(part, self.tokenizer.encode_batch_fast([before + w for w in part], add_special_tokens=False), strict=True))

    def one(self, text: str) -> int:
        """Tokens of a text that has white space at the ends of pieces."""
        # such pieces are not kept: between two spaces they would hide that those are no cuts
        head, *rest = CUT.split(text)
        own: dict[str, int] = {}
        odd = [x for x in rest if not plain(x)]
        self._add(own, odd, " ")
        self._add(self.known, [x for x in rest if plain(x)], " ")
        start: dict[str, int] = {}
        self._add(start, [head], "")
        return start[head] + sum(own[x] if x in own else self.known[x] for x in rest)

    def many(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        offsets, codes, words = split_codes(pc.split_pattern(texts, " "))
        words = words.to_pylist()
        found = list(map(self.known.get, words))
        new = [i for i, n in enumerate(found) if n is None]
        self._add(self.known, [words[i] for i in new if plain(words[i])], " ")
        odd = np.zeros(len(words), bool)
        for i in new:
            if (n := self.known.get(words[i])) is None:
                odd[i] = True
            found[i] = n or 0
        lengths = np.array(found, np.int64)[codes]
        heads = [words[c] for c in codes[offsets[:-1]].tolist()]
        self._add(self.first, [x for x in heads if plain(x)], "")
        lengths[offsets[:-1]] = [self.first.get(x, 0) for x in heads]
        out, slow = sums(offsets, lengths), sums(offsets, odd[codes])
        for i in np.flatnonzero(slow).tolist():
            if text := texts[i].as_py():
                out[i] = self.one(text)
        return out


def largest(counts: dict[str, int], most: int) -> dict[str, int]:
    """The `most` largest counts; of equal ones those of the first strings."""
    return dict(heapq.nsmallest(most, counts.items(), key=lambda x: (-x[1], x[0])))


def sketched(counts: dict[str, int]) -> list[pa.Array]:
    return [pa.array([list(counts)], pa.list_(pa.string())), pa.array([list(counts.values())], pa.list_(pa.int64()))]


def merged(sketches: Iterable[tuple[list[str], list[int]]], most: int) -> dict[str, int]:
    total: Counter[str] = Counter()
    for pieces, n in sketches:
        total.update(dict(zip(pieces, n, strict=True)))
    return largest(total, most)


def frequent_pieces(docs: DataFrame, frequent: int = FREQUENT, reported: int = REPORTED) -> list[str]:
    """The most frequent pieces over all texts; `frequent` at most."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in slices(batches, 0):
            _, codes, words = split_codes(pc.split_pattern(pc.fill_null(batch.column(0), ""), " "))
            for x, n in zip(words.to_pylist(), np.bincount(codes, minlength=len(words)).tolist(), strict=True):
                if n > 1 or x in counts:
                    counts[x] = counts.get(x, 0) + n
            if len(counts) > 8 * reported:
                counts = largest(counts, 4 * reported)
        top = largest({x: n for x, n in counts.items() if len(x) <= LONGEST and plain(x)}, reported)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % GROUPS]), *sketched(top)], ["part", "pieces", "n"])

    def merge(key: tuple, sketches: pa.Table) -> pa.Table:
        return pa.Table.from_arrays(sketched(merged(zip(sketches["pieces"].to_pylist(), sketches["n"].to_pylist(), strict=True), 4 * reported)), ["pieces", "n"])

    sketches = docs.selectExpr("cast(text as string) text").mapInArrow(report, "part long, pieces array<string>, n array<long>")
    rows = sketches.groupBy("part").applyInArrow(merge, "pieces array<string>, n array<long>").collect()  # GROUPS sketches at most
    return list(merged(((r["pieces"], r["n"]) for r in rows), frequent))


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, frequent: int = FREQUENT, cached: int = CACHE_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document."""
    tokenizer = load_tokenizer(path)
    words = frequent_pieces(docs, frequent)
    lengths = {w: len(e.ids) for w, e in zip(words, tokenizer.encode_batch([" " + w for w in words], add_special_tokens=False), strict=True)}
    tier_one, name = docs.sparkSession.sparkContext.broadcast(lengths), uuid4().hex

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = for_worker("token lengths", name, lambda: Lengths(load_tokenizer(path), tier_one.value, cached))
        tok = lengths.tokenizer
        added = [t.content for t in tok.get_added_tokens_decoder().values()]
        for batch in slices(batches):
            column = pc.fill_null(batch.column(1), "")
            n_tokens = lengths.many(column)
            for i in {i for a in added for i in np.flatnonzero(pc.match_substring(column, a).to_numpy(zero_copy_only=False)).tolist()}:
                n_tokens[i] = len(tok.encode(column[i].as_py(), add_special_tokens=False).ids)
            lengths.trim()
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.binary_length(column).cast(pa.int64()), pa.array(n_tokens), pa.array(n_tokens > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(count, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(TOKENIZER))
