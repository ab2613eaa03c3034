"""Operator 8: BPE encoding and decoding with forced boundaries.

A vocabulary token is a string of byte symbols. If two symbols never stand side by side inside any token, no merge can ever join across
them, so a cut between them is certain: the fragments on both sides are encoded alone and their ids concatenated. (The library's normaliser
and pre-tokeniser decide what a word is; white space, which they drop, is a cut as well.) Fragments are short and repeat, so each Python worker keeps the model and a
cache of the words that it has encoded from task to task; the cache is emptied when it holds CACHE_BYTES (common.py). Decoding joins the token strings as the library does for a vocabulary without a decoder: by one space.

A text with the string of an added token goes to the library whole. Null and empty texts have no ids and decode to the empty text. Rows are independent: repeated
rows give repeated results, an empty table an empty result; extra columns are ignored by `encode` and kept by nobody. A very long text is handled alone and whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from itertools import pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from korbwerk.llm.common import CACHE_BYTES, for_worker, slices, table, words_of
from korbwerk.llm.token_counts import load_tokenizer, tokenizer_path

TOKENIZER = "word_bpe_49k.json"


#: Characters for which lower case, normal form C and white space are those of the library's normaliser.
SIMPLE = re.compile("[!-~\u00a1-\u00ff]+")


def byte_symbols() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the characters from U+0100 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class ForcedBoundaryBpe:
    """BPE of words whose last symbol carries the end-of-word suffix."""

    def __init__(self, path: str, cached: int = CACHE_BYTES):
        import regex
        from tokenizers.models import BPE

        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        model = parts["model"]
        self.tokenizer = load_tokenizer(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        #: One merges fragments that end a word, the other those before.
        self.ending = BPE(model["vocab"], merges, end_of_word_suffix=suffix)
        self.inner = BPE(model["vocab"], merges)
        cut = len(suffix)
        inside = {a + b for token in model["vocab"] for a, b in pairwise(token[:-cut] if cut and token.endswith(suffix) else token)}
        symbols = byte_symbols()
        self.inside, self.symbols = inside, symbols
        self.words_in = regex.compile(parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.cached = cached
        self.strings = pa.array([x for x, _ in sorted(self.tokenizer.get_vocab().items(), key=itemgetter(1))])
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    def trim(self) -> None:
        """Empties the cache if it holds more bytes than it may."""
        if self.held > self.cached:
            self.known, self.held = {}, 0

    def cut(self, symbols: str) -> list[str]:
        """Fragments between forced boundaries."""
        at = [i for i in range(1, len(symbols)) if symbols[i - 1 : i + 1] not in self.inside]
        return [symbols[a:b] for a, b in pairwise([0, *at, len(symbols)])]

    def piece(self, text: str) -> bytes:
        """Ids of a piece between white space."""
        if SIMPLE.fullmatch(text):
            words = [w.encode().decode("latin-1").translate(self.symbols) for w in self.words_in.findall(text.lower())]
        else:
            words = [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))]
        tokens = []
        for w in words:
            *before, last = self.cut(w)
            for x in before:
                tokens += self.inner.tokenize(x)
            tokens += self.ending.tokenize(last)
        return array("I", [t.id for t in tokens]).tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Of all texts: where each one's ids begin (and the end), and the ids."""
        texts = pc.fill_null(texts, "")
        offsets, codes, words = words_of(texts, fold=False)
        found = list(map(self.known.get, words))
        for i, x in enumerate(found):
            if x is None:
                found[i] = self.known[words[i]] = self.piece(words[i].decode())
                self.held += len(words[i]) + len(found[i]) + 160
        starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4)])
        begin, ids = gather(starts, np.frombuffer(b"".join(found), np.uint32), codes)
        begin = begin[offsets]
        # a text that holds the string of an added token is the library's
        odd = sorted({i for a in self.added for i in np.flatnonzero(pc.match_substring(texts, a).to_numpy(zero_copy_only=False)).tolist()})
        if odd:
            parts = [ids[a:b] for a, b in pairwise(begin.tolist())]
            for i in odd:
                parts[i] = np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
            begin, ids = np.concatenate([[0], np.cumsum([len(x) for x in parts])]), np.concatenate(parts)
        return begin, ids

    def decode(self, begin: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The texts of ids. The vocabulary has no decoder: token strings, joined by one space."""
        if self.tokenizer.decoder is not None:
            return pa.array([self.tokenizer.decode(ids[a:b].tolist(), skip_special_tokens=False) for a, b in pairwise(begin.tolist())], pa.string())
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(begin, pa.int32()), self.strings.take(pa.array(ids))), " ")


def gather(starts: np.ndarray, values: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists of the codes, one after the other: where each begins (and the end), and all values."""
    lengths = (starts[1:] - starts[:-1])[codes]
    begin = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(begin[-1]) + np.repeat(starts[:-1][codes] - begin[:-1], lengths)
    return begin, values[at]


def encode(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (array<int>) and decoded text of every document; without ids and text if not `with_ids`, but with their digests."""
    schema = "doc_id long, n_tokens long, " + ("ids array<int>, decoded string" if with_ids else "ids_sha256 string, decoded_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = for_worker("bpe", path, lambda: ForcedBoundaryBpe(path))
        for batch in slices(batches):
            begin, ids = bpe.encode(batch.column(1))
            decoded = bpe.decode(begin, ids)
            bpe.trim()
            n = pa.array(begin[1:] - begin[:-1], pa.int64())
            if with_ids:
                out = [pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(ids.astype(np.int32))), decoded]
            else:
                raw = memoryview(ids.astype("<u4").tobytes())
                out = [pa.array([hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in pairwise(begin.tolist())]), pa.array([hashlib.sha256(x).hexdigest() for x in decoded.cast(pa.binary()).to_pylist()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), n, *out], ["doc_id", "n_tokens", *(("ids", "decoded") if with_ids else ("ids_sha256", "decoded_sha256"))])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), tokenizer_path(TOKENIZER), with_ids=False)
