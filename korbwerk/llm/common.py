"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker handles at once; a longer text goes alone.
CHUNK_BYTES = 3 << 20
#: Bytes that a worker's cache holds before it is emptied.
CACHE_BYTES = 64 << 20
#: Rows up to which a table of a few numbers or short words is broadcast; it is joined by key beyond.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(rows: DataFrame) -> DataFrame:
    """rows, marked for broadcast if they are BROADCAST_ROWS at most. rows: materialised, of a few numbers or short words."""
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def shielded(docs: DataFrame, prefix: str, operate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """operate(docs), which names its own columns by `prefix`: columns of docs with such names are called otherwise meanwhile."""
    clash = {c: f"held_{uuid4().hex}" for c in docs.columns if c.lower().startswith(prefix)}
    return operate(docs.withColumnsRenamed(clash)).withColumnsRenamed({v: k for k, v in clash.items()}) if clash else operate(docs)


def for_worker[T](slot: str, name: str, make: Callable[[], T]) -> T:
    """What make() gives, kept for the life of a Python worker under a slot, as long as the name stays the same. (Our modules come anew with each task, so it's kept beside them.)"""
    kept = sys.modules.setdefault("_worker_state", types.ModuleType("_worker_state")).__dict__.setdefault("kept", {})
    if kept.get(slot, (None,))[0] != name:
        kept[slot] = (name, make())
    return kept[slot][1]


def slices(batches: Iterator[pa.RecordBatch], text: int = 1, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches into pieces of about `most` bytes in column `text`, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, n in enumerate(sizes.tolist()):
            if i > start and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)
    pa.default_memory_pool().release_unused()  # workers live on for other stages


def split_codes(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of lists of strings: where each list begins (and the end), a code for each string, and the string of each code."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    return offsets - offsets[0], flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), flat.dictionary


def words_of(texts: pa.Array, fold: bool = True) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words `[^\\x20\\x09-\\x0D]+` of texts, A-Z in lower case if `fold`: where each text's words begin (and the end), a code for each word, and the words."""
    folded = pc.fill_null(texts, "")
    if fold:
        folded = fold_ascii(folded)
    offsets, codes, words = split_codes(pc.ascii_split_whitespace(folded))
    names = words.cast(pa.binary()).to_pylist()
    if b"" in names:  # of white space at an end
        empty = names.index(b"")
        full = codes != empty
        counts = np.concatenate([[0], np.cumsum(full)])
        offsets, codes = counts[offsets], codes[full]
    return offsets, codes, names


_FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fold_ascii(texts: pa.Array, table: bytes = _FOLD) -> pa.Array:
    """Strings with every byte mapped; only ASCII may change, and to ASCII."""
    buffers = texts.buffers()
    if buffers[2] is None:
        return texts
    return pa.Array.from_buffers(texts.type, len(texts), [buffers[0], buffers[1], pa.py_buffer(buffers[2].to_pybytes().translate(table))], offset=texts.offset)


def sums(offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of `lengths` over each text's words."""
    total = np.concatenate([[0], np.cumsum(lengths)])
    return total[offsets[1:]] - total[offsets[:-1]]
