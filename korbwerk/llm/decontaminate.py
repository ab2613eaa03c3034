"""Operator 3: benchmark decontamination by a prefix-filtered set join.

A document word is hit if it lies in an occurrence of a window: 13 consecutive words of a benchmark item, or a whole item of fewer words. The join asks for full
containment of a window, so a prefix of one token is enough: every window is indexed under its rarest word, the one that the documents hold least often (counted
over all of them, ties by the word). A document position is a candidate only where its word is such a prefix token; the positional bound (a window begins where the prefix's
place in it puts it, and of one word's windows only the distinct places and lengths are tried) and the length bound (the window ends inside the
document) drop candidates; a rolling hash finds the window among all that are indexed, so it doesn't matter how many windows share a word; and the whole window is compared word by
word. No document is shuffled.

The index is broadcast in blocks of BLOCK_BYTES of item text at most, about 12 bytes for each byte of text at worst (a window for every word, as numbers); further blocks are further passes over the documents, which
carry their hits along, so the benchmark's size isn't bounded by memory. Items are collected for this, one block at a time.

Null texts have no words and are never contaminated; items whose text is null or without words have no windows; items with the same words (or the same id) each count, and equal
ids count once in the digest. An item without an id hits and contaminates like any other, but isn't counted in n_items and the digest. Repeated documents get equal results. With an empty benchmark nothing is hit. Extra columns, of whatever name, are kept by
`remove_contaminated`. Very long texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from korbwerk.llm.common import fold_ascii, shielded, slices, split_codes, table

WINDOW = 13
BLOCK_BYTES = 8 << 20
U64 = np.uint64
FACTOR = U64(0x9E3779B97F4A7C15)
INVERSE = pow(int(FACTOR), -1, 1 << 64)
#: Word characters are a-z (A-Z folded), 0-9 and everything beyond ASCII.
_WORDS = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))


def benchmark_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORDS).split()


def text_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Where each text's words begin (and the end), codes of the words, and the words."""
    texts = pc.fill_null(texts, "")
    offsets, codes, words = split_codes(pc.ascii_split_whitespace(fold_ascii(texts, _WORDS)))
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    if empty >= 0:
        full = codes != empty
        counts = np.concatenate([[0], np.cumsum(full)])
        offsets, codes = counts[offsets], codes[full]
    return offsets, codes, words


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Items (id as a string or null, words) in blocks of about `block_bytes` of text; an item alone may be larger."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    block, held = [], 0
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = items.collect() if total <= block_bytes else items.toLocalIterator()
    for row in rows:
        if words := benchmark_words(row["text"]):
            block.append((row["item_id"], words))
            held += len(row["text"])
            if held >= block_bytes:
                yield block
                block, held = [], 0
    if block:
        yield block


def word_counts(docs: DataFrame, words: list[bytes]) -> np.ndarray:
    """How often the documents hold each of these words."""
    wanted = docs.sparkSession.sparkContext.broadcast([w.decode() for w in words])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(wanted.value, pa.string())
        total = np.zeros(len(names) + 1, np.int64)
        for batch in slices(batches, 0):
            _, codes, found = text_words(batch.column(0))
            at = pc.fill_null(pc.index_in(found, names), len(names)).to_numpy(zero_copy_only=False)
            total += np.bincount(at, np.bincount(codes, minlength=len(found)), len(total)).astype(np.int64)
        at = np.flatnonzero(total[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["at", "n"])

    rows = docs.selectExpr("cast(text as string) text").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()  # a row for each word of the block at most
    counts = np.zeros(len(words), np.int64)
    counts[[r["at"] for r in rows]] = [r["n"] for r in rows]
    return counts


def rolled(codes: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any stretch of codes follows; codes below 0 stand in no window."""
    return np.concatenate([np.zeros(1, U64), np.cumsum(mixed(codes.astype(np.int64).astype(U64) + U64(1)) * powers[: len(codes)], dtype=U64)])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(31))) * FACTOR
    return x ^ (x >> U64(29))


def powers_of(factor: int, n: int) -> np.ndarray:
    out = np.full(n + 1, factor, U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


class Index:
    """The distinct windows of a block of items: words by number, each window as a stretch of `codes` with the place of its prefix token, by hash; and the items of each.

    `tries` has, for each word (from `begin` on), the distinct places and sizes of windows under it.
    """

    def __init__(self, block: list[tuple[str | None, list[bytes]]], words: list[bytes], counts: np.ndarray, width: int):
        number = {w: i for i, w in enumerate(words)}
        self.words = words
        self.items = sorted({i for i, _ in block if i is not None})
        rank = np.empty(len(words), np.int64)
        rank[np.lexsort((np.arange(len(words)), counts))] = np.arange(len(words))  # words are in order
        own = {x: i for i, x in enumerate(self.items)}
        self.codes = np.array([number[w] for _, ws in block for w in ws], np.int32)
        lengths = np.array([len(ws) for _, ws in block], np.int64)
        starts = np.cumsum(lengths) - lengths
        item = np.array([own.get(i, -1) for i, _ in block], np.int64)
        windows: list[tuple[np.ndarray, ...]] = []
        holds: list[tuple[np.ndarray, np.ndarray]] = []
        known = 0
        for size in np.unique(np.minimum(lengths, width)).tolist():
            of = np.flatnonzero(lengths == size if size < width else lengths >= width)
            n = lengths[of] - size + 1
            begin = np.repeat(starts[of], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            table = self.codes[begin[:, None] + np.arange(size)]
            _, first, place = np.unique(table, axis=0, return_index=True, return_inverse=True)
            windows.append((begin[first], np.full(len(first), size), rank[table[first]].argmin(axis=1)))
            pairs = np.unique(np.stack([place.reshape(-1) + known, np.repeat(item[of], n)]), axis=1)
            holds.append((pairs[0], pairs[1]))
            known += len(first)
        self.start, self.size, self.at = (np.concatenate([w[i] for w in windows]) if windows else np.zeros(0, np.int64) for i in range(3))
        window, held = (np.concatenate([h[i] for h in holds]) if holds else np.zeros(0, np.int64) for i in range(2))
        sums, inverse = rolled(self.codes, powers_of(int(FACTOR), len(self.codes))), powers_of(INVERSE, len(self.codes))
        hashes = (sums[self.start + self.size] - sums[self.start]) * inverse[self.start]
        hashes = mixed(hashes + self.size.astype(U64))
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.start, self.size, self.at = hashes[order], self.start[order], self.size[order], self.at[order]
        new = np.empty(known, np.int64)
        new[order] = np.arange(known)
        window, held = new[window][held >= 0], held[held >= 0]
        by = np.lexsort((held, window))
        self.held, self.held_from = held[by], np.searchsorted(window[by], np.arange(known + 1))
        prefix = self.codes[self.start + self.at]
        tries = np.unique(np.stack([prefix, self.at, self.size]), axis=1)
        self.tries, self.tries_from = tries[1:], np.searchsorted(tries[0], np.arange(len(words) + 1))

    def find(self, offsets: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, ...]:
        """text, begin and window of every occurrence. codes: numbers of the documents' words, -1 for others."""
        at = np.flatnonzero(codes >= 0)
        n = self.tries_from[codes[at] + 1] - self.tries_from[codes[at]]
        at, own, n = at[n > 0], self.tries_from[codes[at]][n > 0], n[n > 0]
        tried = np.repeat(own, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        begin, size = np.repeat(at, n) - self.tries[0][tried], self.tries[1][tried]
        text = np.repeat(np.searchsorted(offsets, at, "right") - 1, n)
        inside = (begin >= offsets[text]) & (begin + size <= offsets[text + 1])
        begin, size, text = begin[inside], size[inside], text[inside]
        sums, inverse = rolled(codes, powers_of(int(FACTOR), len(codes))), powers_of(INVERSE, len(codes))
        hashes = mixed((sums[begin + size] - sums[begin]) * inverse[begin] + size.astype(U64))
        low, high = np.searchsorted(self.hashes, hashes), np.searchsorted(self.hashes, hashes, "right")
        n = high - low
        begin, text = np.repeat(begin, n), np.repeat(text, n)
        window = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        good = np.zeros(len(window), bool)
        for size in np.unique(self.size[window]).tolist():
            own = np.flatnonzero(self.size[window] == size)
            steps = np.arange(size)
            good[own] = (codes[begin[own][:, None] + steps] == self.codes[self.start[window[own]][:, None] + steps]).all(axis=1)
        return text[good], begin[good], window[good]


def mark(docs: DataFrame, block: list[tuple[str | None, list[bytes]]], width: int, first: bool) -> DataFrame:
    """docs with `_d_n_words`, `_d_hit` (begin and end of hit stretches, one after the other) and `_d_items`, added to those of earlier blocks."""
    names = docs.columns if first else docs.columns[:-3]
    at = names.index("text")
    vocabulary = sorted({w for _, words in block for w in words})
    sent = docs.sparkSession.sparkContext.broadcast(Index(block, vocabulary, word_counts(docs, vocabulary) if block else np.zeros(0, np.int64), width))
    schema = StructType([*docs.schema.fields[: len(names)], StructField("_d_n_words", LongType()), StructField("_d_hit", ArrayType(LongType())), StructField("_d_items", ArrayType(StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        known = pa.array([w.decode() for w in index.words], pa.string())
        for batch in slices(batches, at):
            offsets, codes, words = text_words(batch.column(at))
            number = pc.fill_null(pc.index_in(words, known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            hits: list[list[int]] = [[] for _ in range(batch.num_rows)] if first else [x or [] for x in batch.column(len(names) + 1).to_pylist()]
            items: list[list[str]] = [[] for _ in range(batch.num_rows)] if first else [x or [] for x in batch.column(len(names) + 2).to_pylist()]
            if len(codes) and len(index.hashes):
                text, begin, window = index.find(offsets, number[codes])
                for t, b, n in zip(text.tolist(), (begin - offsets[text]).tolist(), index.size[window].tolist(), strict=True):
                    hits[t] += [b, b + n]
                for t, w in np.unique(np.stack([text, window]), axis=1).T.tolist():
                    items[t] += [index.items[i] for i in index.held[index.held_from[w] : index.held_from[w + 1]].tolist()]
            out = [joined(x) for x in hits]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(np.diff(offsets), pa.int64()), pa.array(out, pa.list_(pa.int64())), pa.array([sorted(set(x)) for x in items], pa.list_(pa.string()))], [*names, "_d_n_words", "_d_hit", "_d_items"])

    return docs.mapInArrow(run, schema)


def joined(ends: list[int]) -> list[int]:
    """Stretches (begin, end, begin, end, ...) in order and joined where they overlap or touch."""
    out: list[int] = []
    for begin, end in sorted(zip(ends[::2], ends[1::2], strict=True)):
        if out and begin <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [begin, end]
    return out


def find_hits(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs, all columns kept, with `_d_n_words`, `_d_hit` (stretches of hit words) and `_d_items`."""
    marked, first = docs, True
    for block in item_blocks(benchmark, block_bytes):
        marked, first = mark(marked, block, width, first), False
    return mark(docs, [], width, True) if first else marked


def n_hit():
    """Hit words, from the stretches."""
    return F.aggregate(F.transform("_d_hit", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, x: a + x)


def contaminated():
    return (n_hit() > 0) & (n_hit() * 20 >= F.col("_d_n_words"))


def score_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    found = find_hits(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text"), benchmark)
    return found.select("doc_id", F.col("_d_n_words").alias("n_words"), n_hit().alias("n_hit"), F.size("_d_items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "_d_items").cast("binary"), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that aren't contaminated, with their columns."""
    return shielded(docs, "_d_", lambda rows: find_hits(rows, benchmark).where(~contaminated()).select(*rows.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def brute_force(text: str | None, items: list[tuple[object, str | None]], width: int = WINDOW) -> tuple[int, int, int, str, bool]:
    """n_words, n_hit, n_items, items_sha256 and contaminated of one text, by comparing every window at every place."""
    words, hit, found = benchmark_words(text), set(), set()
    for item, own in items:
        parts = benchmark_words(own)
        size = min(width, len(parts))
        for i in range(len(parts) - size + 1 if size else 0):
            for j in range(len(words) - size + 1):
                if words[j : j + size] == parts[i : i + size]:
                    hit.update(range(j, j + size))
                    found.add(str(item))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)
