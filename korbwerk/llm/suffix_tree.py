"""Operator 1: language-model scoring by a probabilistic suffix tree over words.

Symbols are words and the end of a text. A context is the last 1 to `depth` words (DEPTH unless another bound is given); it is retained if it stands in the training
texts at least MIN_CONTEXT times and passes a divergence test: what its next-symbol counts gain in bits over the longest retained shorter context must exceed COST_BITS for the
context and for each symbol that it lists (those seen after it MIN_SYMBOL times or more). The next-symbol distribution of a retained context is discounted by DISCOUNT for each
symbol and smoothed with that of its longest retained suffix; the root is the discounted distribution of words, whose discounted mass goes to unknown words (one symbol, as in
the base). A text is scored from the state of the longest retained suffix of what was read. Probabilities of all V + 1 symbols sum to one in each state, up to the rounding of
what travels (STEP parts of a bit).

Nothing of the model is broadcast or collected but a few totals. Documents are cut into blocks of some megabytes, kept in a table that is bucketed by block, so that blocks never
move again: answers are dealt to them. First a block asks for the counts of its words, by hash; words get numbers, small for frequent ones, which are exact from then on. Then
each place of a text goes, as one window of `depth` words and a symbol, to the bucket of its shortest context that stands HOT_CONTEXT times at most. That bucket
holds the context's whole subtree: it tests all longer contexts at once and answers with the place's final probability. Contexts that are more frequent are not sent as places: for each of
their levels, blocks send distinct (context, symbol) pairs with counts, dealt by context and symbol, and get the totals back, so no context is too frequent for a task.
Counts are never cut by sampling: thresholds apply to totals over all training texts.

Null text is empty and has one token, the end. Null doc_id: not held out. Rows are independent but for the counts; repeated rows count as often as they stand there. Without training
texts, score is base_score. An empty table gives an empty result. A very long text is a block of its own. Extra columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from korbwerk.llm.common import slices, table, words_of
from korbwerk.plans.checkpoint import ensure_checkpoint_dir, materialise, remove

BLOCK_BYTES = 12 << 20
BUCKET_TOKENS = 1 << 20
HOT_CONTEXT = 1 << 19
DEPTH, MIN_CONTEXT, MIN_SYMBOL, DISCOUNT, COST_BITS = 4, 2, 2, 0.75, 6.0
#: Parts of a bit in which logarithms of probabilities travel.
STEP = 256
END = b"\n"
U64 = np.uint64
MIX = U64(0x9E3779B97F4A7C15)
REQUEST = "bucket long, block long, level int, payload binary"
ANSWER = "block long, kind int, bucket long, payload binary, context long, bits double, seen double, listed long, total double"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, each by byte planes and compressed."""
    codec, out = pa.Codec("zstd", 1), []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
        z = codec.compress(planes, asbytes=True)
        out += [struct.pack("<4sQQ", a.dtype.str.encode(), len(a), len(z)), z]
    return b"".join(out)


def unpack(raw: bytes) -> list[np.ndarray]:
    codec, out, at = pa.Codec("zstd", 1), [], 0
    while at < len(raw):
        kind, n, size = struct.unpack_from("<4sQQ", raw, at)
        dtype = np.dtype(kind.rstrip(b"\0").decode())
        at += 20
        planes = codec.decompress(raw[at : at + size], n * dtype.itemsize, asbytes=True) if n else b""
        out.append(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(dtype.itemsize, n).T).view(dtype).reshape(n))
        at += size
    return out


def slim(x: np.ndarray) -> np.ndarray:
    """Numbers in 32 bits where they fit."""
    return x.astype(np.uint32) if not len(x) or int(x.max()) < 1 << 32 else x.astype(U64)


def deltas(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x.dtype.type(0))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(31))) * MIX
    return x ^ (x >> U64(29))


def coded(p: np.ndarray) -> np.ndarray:
    """Probabilities as parts of bits."""
    return np.clip(np.rint(-np.log2(p) * STEP), 0, 65535).astype(np.uint16)


def decoded(q: np.ndarray) -> np.ndarray:
    return np.exp2(q.astype(float) / -STEP)


def pieces(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each bucket of a sorted column, and where it stands."""
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(bucket[a]), slice(a, b)


def blocks_of(docs: DataFrame) -> DataFrame:
    """block, n_tokens and payload: hashes of the block's words in order, the words of its texts as numbers into them (each text ends with END), and the texts' ids."""

    def block_of(batches: list[pa.RecordBatch], block: int) -> pa.RecordBatch:
        from xxhash import xxh64_intdigest

        batch = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
        offsets, codes, words = words_of(batch.column(1))
        hashes = np.array([xxh64_intdigest(w) for w in [*words, END]], U64)
        known, number = np.unique(hashes, return_inverse=True)
        ids = np.insert(number[codes], offsets[1:], number[-1]).astype(np.uint32)
        doc_id = batch.column(0)
        payload = pack(deltas(known), ids, number[-1:].astype(np.uint32), doc_id.fill_null(0).to_numpy(), doc_id.is_null().to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False))
        return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([len(ids)]), pa.array([payload], pa.binary())], ["block", "n_tokens", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in slices(batches, most=BLOCK_BYTES):
            n = batch.column(1).nbytes
            if held and size + n > BLOCK_BYTES:
                yield block_of(held, block)
                block, held, size = block + 1, [], 0
            held.append(batch)
            size += n
        if held:
            yield block_of(held, block)

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held_out")).mapInArrow(run, "block long, n_tokens long, payload binary")


class Words:
    """A block before its words have numbers."""

    def __init__(self, payload: bytes, bits: int):
        known, ids, end, self.doc_ids, self.null, self.held_out = unpack(payload)
        self.known, self.ids, self.end = np.cumsum(known, dtype=U64), ids.astype(np.int64), int(end[0])
        self.bucket = (self.known >> U64(64 - bits)).astype(np.int64)

    def ask(self) -> Iterator[tuple[int, int, bytes]]:
        ends = np.flatnonzero(self.ids == self.end)
        train = np.repeat(~self.held_out, np.diff(ends, prepend=-1))
        seen = np.bincount(self.ids[train], minlength=len(self.known))
        held = np.bincount(self.ids[~train], minlength=len(self.known))
        for bucket, s in pieces(self.bucket):
            yield bucket, 0, pack(deltas(self.known[s]), slim(seen[s]), slim(held[s]))

    def learned(self, answers: dict[int, bytes]) -> bytes:
        """The block with numbers for words, and their counts. Words are in order of their numbers."""
        parts = [unpack(answers[bucket]) for bucket, _ in pieces(self.bucket)]
        number, seen, every = (np.concatenate([p[i].astype(np.int64) for p in parts]) for i in range(3))
        order = np.argsort(number)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return pack(slim(deltas(number[order])), slim(seen[order]), slim(every[order]), slim(place[self.ids]), place[[self.end]], self.doc_ids, self.null, self.held_out)


class Level:
    """Places with a frequent context of one length, and the distinct (context, symbol) pairs at them.

    contexts: hashes; of: each place's context, as a number into them; total and size: how often each context stands in the training texts and in all; pair: each place's pair; seen and every: how often
    each pair stands in the training texts and in all.
    """

    def __init__(self, places: np.ndarray, contexts: np.ndarray, of: np.ndarray, total: np.ndarray, size: np.ndarray, symbol: np.ndarray):
        self.places, self.contexts, self.of, self.total, self.size = places, contexts, of, total, size
        pairs, self.first, self.pair = np.unique(of.astype(np.int64) << 32 | symbol, return_index=True, return_inverse=True)
        self.context, self.symbol = pairs >> 32, pairs & 0xFFFFFFFF
        self.seen, self.every = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)


class Block:
    """A block and what it knows of the model: `p` has each place's probability so far."""

    def __init__(self, payload: bytes, bits: int, depth: int, n: int, v: int, discount: float):
        number, count, every, ids, end, self.doc_ids, self.null, self.held_out = unpack(payload)
        self.number, self.count, self.every, self.ids = slim(np.cumsum(number, dtype=np.int64)), count.astype(np.int64), every.astype(np.int64), ids.astype(np.int32)
        self.shift, self.depth, self.n, self.v = U64(64 - bits), depth, n, v
        ends = np.flatnonzero(self.ids == end[0])
        sizes = np.diff(ends, prepend=-1)
        self.text = np.repeat(np.arange(len(ends), dtype=np.int32), sizes)
        self.before = (np.arange(len(self.ids)) - np.repeat(ends + 1 - sizes, sizes)).astype(np.int32)  # words before each place in its text
        self.train = ~self.held_out[self.text]
        p = decoded(coded(np.where(self.count > 0, self.count - discount, discount * max(v, 1)) / max(n, 1)))
        self.p = p[self.ids]
        self.levels: list[Level] = []

    def places(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places whose context of k words may be retained and whose shorter ones are frequent, and which of them have a frequent one. After k - 1 levels."""
        if k == 1:
            places = np.flatnonzero(self.before >= 1)
            places = places[self.count[self.ids[places - 1]] >= MIN_CONTEXT]
            return places, self.every[self.ids[places - 1]] > HOT_CONTEXT
        last = self.levels[k - 2]
        pair = np.full(len(self.ids) + 1, -1, np.int64)
        pair[last.places] = last.pair
        places = last.places[self.before[last.places] >= k]
        own = pair[places - 1]  # the pair that ends just before a place is that place's context
        asked = own >= 0
        kept = ~asked | (last.seen[own] >= MIN_CONTEXT)
        return places[kept], (asked & (last.every[own] > HOT_CONTEXT))[kept]

    def enter(self, k: int) -> Level:
        """The level of the frequent contexts of k words."""
        places, hot = self.places(k)
        places = places[hot]
        if k == 1:
            word = self.ids[places - 1]
            used, of = np.unique(word, return_inverse=True)
            contexts, total, size = mixed(self.number[used].astype(U64)), self.count[used], self.every[used]
        else:
            last = self.levels[k - 2]
            pair = np.full(len(self.ids), -1, np.int64)
            pair[last.places] = last.pair
            used, of = np.unique(pair[places - 1], return_inverse=True)
            contexts = mixed(mixed(last.contexts[last.context[used]]) + self.number[last.symbol[used]].astype(U64))
            total, size = last.seen[used], last.every[used]
        self.levels.append(Level(places, contexts, of.astype(np.int64), total, size, self.ids[places]))
        return self.levels[-1]

    def dealt(self, level: Level) -> Iterator[tuple[int, np.ndarray]]:
        """Buckets of the level's pairs, by context and symbol."""
        many = (level.size[level.context] // HOT_CONTEXT).astype(U64)
        key = mixed(level.contexts[level.context] + mixed(self.number[level.symbol].astype(U64)) % (many + U64(1)))
        bucket = (key >> self.shift).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        for b, s in pieces(bucket[order]):
            yield b, order[s]

    def ask_pairs(self, k: int) -> Iterator[tuple[int, int, bytes]]:
        level = self.enter(k)
        seen = np.bincount(level.pair, self.train[level.places], len(level.context)).astype(np.int64)
        held = np.bincount(level.pair, minlength=len(level.context)) - seen
        q = coded(self.p[level.places[level.first]])
        for bucket, own in self.dealt(level):
            context = level.context[own]
            edge = np.flatnonzero(np.diff(context, prepend=-1))
            length = np.diff(edge, append=len(context))
            yield bucket, k, pack(level.contexts[context[edge]], length.astype(np.uint32), slim(self.number[level.symbol[own]]), slim(seen[own]), slim(held[own]), q[own])

    def learn_pairs(self, k: int, answers: dict[int, bytes]) -> None:
        level = self.enter(k)
        for bucket, own in self.dealt(level):
            if bucket in answers:
                at, seen, every = unpack(answers[bucket])
                at = own[np.cumsum(at, dtype=np.int64)]
                level.seen[at], level.every[at] = seen, every

    def asked_contexts(self, level: Level) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(level.contexts)
        for bucket, s in pieces((level.contexts[order] >> self.shift).astype(np.int64)):
            yield bucket, order[s]

    def ask_contexts(self, k: int) -> Iterator[tuple[int, int, bytes]]:
        level = self.levels[k - 1]
        for bucket, own in self.asked_contexts(level):
            yield bucket, k, pack(deltas(level.contexts[own]))

    def learn_contexts(self, k: int, answers: dict[int, bytes]) -> None:
        """Takes the level into the probabilities: what is listed, and the rest by way of the suffix."""
        level = self.levels[k - 1]
        back = np.full(len(level.contexts), np.nan)
        for bucket, own in self.asked_contexts(level):
            if bucket in answers:
                back[own] = unpack(answers[bucket])[0]
        seen = level.seen[level.pair]
        held = ~np.isnan(back[level.of])
        at, of, seen = level.places[held], level.of[held], seen[held]
        self.p[at] = np.where(seen >= MIN_SYMBOL, seen - DISCOUNT, 0) / level.total[of] + back[of] * self.p[at]

    def windows(self) -> Iterator[tuple[int, int, np.ndarray, list[np.ndarray]]]:
        """bucket, length of the context that names it, places and their words before (the last first; 0 for none), of all places whose shortest context that isn't frequent may be retained."""
        for k in range(1, min(len(self.levels) + 1, self.depth) + 1):
            places, hot = self.places(k)
            places = places[~hot]
            words, there = [], np.ones(len(places), bool)
            for j in range(1, self.depth + 1):
                word = self.ids[np.maximum(places - j, 0)]
                there &= (self.before[places] >= j) & (self.count[word] >= MIN_CONTEXT)  # a longer context is no more frequent than any of its words
                words.append(np.where(there, self.number[word], self.number.dtype.type(0)))
            key = np.full(len(places), k, U64)
            for w in words[:k]:
                key = mixed(key + w.astype(U64))
            order = np.lexsort((words[min(k, self.depth - 1)], key))
            places, words = places[order], [w[order] for w in words]
            for bucket, s in pieces((key[order] >> self.shift).astype(np.int64)):
                yield bucket, k, places[s], [w[s] for w in words]

    def ask_windows(self) -> Iterator[tuple[int, int, bytes]]:
        for bucket, k, places, words in self.windows():
            yield bucket, k, pack(*map(slim, words), slim(self.number[self.ids[places]]), coded(self.p[places]), self.train[places])

    def scores(self, answers: dict[tuple[int, int], bytes]) -> pa.RecordBatch:
        texts = len(self.doc_ids)
        bits = -np.log2(self.p)
        for bucket, k, places, _ in self.windows() if self.n else ():
            bits[places] = unpack(answers[k, bucket])[0] / STEP
        known = np.bincount(self.text, self.count[self.ids] > 0, texts).astype(np.int64)
        base = np.bincount(self.text, np.log10((self.count + 0.1) / (self.n + 0.1 * (self.v + 1)))[self.ids], texts)
        score = np.bincount(self.text, bits, texts) * -np.log10(2) if self.n else base
        return pa.RecordBatch.from_arrays([pa.array(self.doc_ids, mask=self.null), pa.array(self.held_out), pa.array(np.bincount(self.text, minlength=texts).astype(np.int64)), pa.array(known), pa.array(np.full(texts, self.n)), pa.array(base), pa.array(score)], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def answers_of(rows: list[dict]) -> pa.Table:
    kinds = {"block": pa.int64(), "kind": pa.int32(), "bucket": pa.int64(), "payload": pa.binary(), "context": pa.int64(), "bits": pa.float64(), "seen": pa.float64(), "listed": pa.int64(), "total": pa.float64()}
    return pa.table({k: pa.array([r.get(k) for r in rows], t) for k, t in kinds.items()})


def add_words(bits: int):
    """A function that, of one bucket, gives numbers and totals for each block's words, and (without a block) the bucket's share of N, V, of words seen once and twice, and of frequent ones."""

    def run(key: tuple, requests: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        parts = [unpack(p.as_py()) for p in requests.column("payload")]
        keys, place = np.unique(np.concatenate([np.cumsum(p[0], dtype=U64) for p in parts]), return_inverse=True)
        seen, held = (np.bincount(place, np.concatenate([p[i] for p in parts]), len(keys)).astype(np.int64) for i in (1, 2))
        number = np.empty(len(keys), np.int64)
        number[np.lexsort((keys, -seen))] = (np.arange(len(keys)) << bits) + bucket + 1
        ends = np.cumsum([len(p[0]) for p in parts])[:-1]
        rows = [{"block": b.as_py(), "kind": 0, "bucket": bucket, "payload": pack(slim(number[p]), slim(seen[p]), slim((seen + held)[p]))} for b, p in zip(requests.column("block"), np.split(place, ends), strict=True)]
        return answers_of([*rows, {"kind": int((seen + held > HOT_CONTEXT).sum()), "bits": float((seen == 1).sum()), "seen": float((seen == 2).sum()), "listed": int((seen > 0).sum()), "total": float(seen.sum())}])

    return run


def add_pairs(key: tuple, requests: pa.Table) -> pa.Table:
    """Of one bucket: the totals of each block's pairs where there are two or more, and without a block what the test needs of each context, and (without a context) how many pairs are frequent."""
    level, bucket = requests.column("level")[0].as_py(), key[0].as_py()
    parts = [unpack(p.as_py()) for p in requests.column("payload")]
    context = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
    symbol, seen, held, q = (np.concatenate([p[i] for p in parts]) for i in (2, 3, 4, 5))
    names, number = np.unique(context, return_inverse=True)
    symbols, symbol = np.unique(symbol, return_inverse=True)
    pairs, first, place = np.unique(number << 32 | symbol, return_index=True, return_inverse=True)
    seen, held = (np.bincount(place, x, len(pairs)).astype(np.int64) for x in (seen, held))
    ends = np.cumsum([len(p[2]) for p in parts])[:-1]
    rows = [{"kind": 2 * level - 1, "listed": int((seen + held > HOT_CONTEXT).sum())}]
    for b, p in zip(requests.column("block"), np.split(place, ends), strict=True):
        at = np.flatnonzero((seen + held)[p] > 1)
        if len(at):
            rows.append({"block": b.as_py(), "kind": 2 * level - 1, "bucket": bucket, "payload": pack(deltas(at.astype(np.uint32)), slim(seen[p[at]]), slim((seen + held)[p[at]]))})
    of, listed = pairs >> 32, seen >= MIN_SYMBOL
    t = np.where(listed, seen, 1).astype(float)
    gain = np.bincount(of, np.where(listed, t * (np.log2(t - DISCOUNT + ~listed) + q[first] / STEP), 0), len(names))
    tests = {"context": pa.array(names.view(np.int64)), "bits": pa.array(gain), "seen": pa.array(np.bincount(of, np.where(listed, seen, 0), len(names))), "listed": pa.array(np.bincount(of, listed, len(names)).astype(np.int64)), "total": pa.array(np.bincount(of, seen, len(names)).astype(float))}
    out = answers_of(rows)
    nothing = {f.name: pa.nulls(len(names), f.type) for f in out.schema}
    return pa.concat_tables([out, pa.table(nothing | tests)])


def look_up(key: tuple, requests: pa.Table, retained: pa.Table) -> pa.Table:
    """Of one bucket: what share each asked context leaves for its suffix; none if it isn't retained."""
    have = retained.column("context").to_numpy().view(U64)
    order = np.argsort(have)
    have, back = have[order], retained.column("back").to_numpy()[order]
    rows = []
    for b, level, payload in zip(requests.column("block").to_pylist(), requests.column("level").to_pylist(), requests.column("payload"), strict=True):
        asked = np.cumsum(unpack(payload.as_py())[0], dtype=U64)
        at = np.minimum(np.searchsorted(have, asked), max(len(have) - 1, 0))
        found = have[at] == asked if len(have) else np.zeros(len(asked), bool)
        if found.any():
            rows.append({"block": b, "kind": 2 * level, "bucket": key[0].as_py(), "payload": pack(np.where(found, back[at], np.nan))})
    return answers_of(rows)


def grow(start: np.ndarray, words: list[np.ndarray], symbol: np.ndarray, p: np.ndarray, train: np.ndarray) -> np.ndarray:
    """The final probability at each window, from whole subtrees: all windows of a context are there, from its length `start` on."""
    order = np.lexsort(words[::-1])
    start, symbol, p, train = start[order], np.unique(symbol[order], return_inverse=True)[1], p[order], train[order]
    new, alive = np.zeros(len(order), bool), np.ones(len(order), bool)
    new[:1] = True
    for k, word in enumerate(words, 1):
        word = word[order]
        new[1:] |= word[1:] != word[:-1]
        alive &= word > 0
        at = np.flatnonzero(alive & (start <= k))
        of = np.cumsum(new)[at] - 1
        n = np.bincount(of, train[at])
        rare = n[of] < MIN_CONTEXT
        alive[at[rare]] = False  # a longer context is no more frequent
        at, of = at[~rare], of[~rare]
        pairs, first, pair = np.unique(of << 32 | symbol[at], return_index=True, return_inverse=True)
        seen = np.bincount(pair, train[at], len(pairs))
        context, listed = pairs >> 32, seen >= MIN_SYMBOL
        own, t = context[listed], seen[listed]
        gain = np.bincount(own, t * (np.log2(t - DISCOUNT) - np.log2(p[at[first[listed]]]) - np.log2(n[own])), len(n))
        kinds, mass = np.bincount(own, minlength=len(n)), np.bincount(own, t - DISCOUNT, len(n))
        back = np.maximum(1 - mass / np.maximum(n, 1), 1e-6)
        held = (gain > COST_BITS * (kinds + 1))[of]
        at, of, seen = at[held], of[held], seen[pair[held]]
        p[at] = np.where(seen >= MIN_SYMBOL, seen - DISCOUNT, 0) / n[of] + back[of] * p[at]
    out = np.empty(len(p))
    out[order] = p
    return out


def solve(key: tuple, requests: pa.Table) -> pa.Table:
    """Of one bucket: the final probabilities of each block's windows."""
    parts = [unpack(p.as_py()) for p in requests.column("payload")]
    levels, sizes = requests.column("level").to_pylist(), [len(p[0]) for p in parts]
    *words, symbol, q, train = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    q = coded(grow(np.repeat(levels, sizes), words, symbol, decoded(q), train))
    ends = np.cumsum(sizes)[:-1]
    return answers_of([{"block": b, "kind": -k, "bucket": key[0].as_py(), "payload": pack(x)} for b, k, x in zip(requests.column("block").to_pylist(), levels, np.split(q, ends), strict=True)])


def keep_by_block(blocks: DataFrame) -> str:
    """The name of a new table of the blocks, bucketed so that groupings by block find them in place. Its files lie in the checkpoint folder, under that name."""
    name, n = f"korbwerk_{uuid4().hex}", 2 * int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(blocks.sparkSession)
    blocks.write.bucketBy(n, "block").sortBy("block").option("path", f"{blocks.sparkSession.sparkContext.getCheckpointDir()}/{name}").saveAsTable(name)
    return name


def forget(spark: SparkSession, name: str) -> None:
    """Drops a table of blocks and its files."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    remove(spark, f"{spark.sparkContext.getCheckpointDir()}/{name}")


def told(left: pa.Table, right: pa.Table) -> tuple[int, bytes, dict[int, dict[int, bytes]]]:
    """A block's number and payload, and its answers by kind and bucket."""
    got: dict[int, dict[int, bytes]] = {}
    for kind, bucket, payload in zip(right.column("kind").to_pylist(), right.column("bucket").to_pylist(), right.column("payload").to_pylist(), strict=True):
        got.setdefault(kind, {})[bucket] = payload
    return left.column("block")[0].as_py(), left.column("payload")[0].as_py(), got


def requests_of(block: int, rows: Iterator[tuple[int, int, bytes]]) -> pa.Table:
    rows = list(rows)
    return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int64()), "block": pa.array([block] * len(rows), pa.int64()), "level": pa.array([r[1] for r in rows], pa.int32()), "payload": pa.array([r[2] for r in rows], pa.binary())})


def score_documents(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document. The result is written to the checkpoint folder; the tables of blocks are dropped."""
    spark, names = docs.sparkSession, []
    try:
        names.append(keep_by_block(blocks_of(docs)))
        raw = spark.table(names[0])
        tokens = raw.agg(F.sum("n_tokens")).first()[0] or 0
        bits = max(2, int(np.ceil(np.log2(max(tokens / BUCKET_TOKENS, 1)))))

        def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for b, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    yield from requests_of(b, Words(payload.as_py(), bits).ask()).to_batches()

        words = materialise(raw.select("block", "payload").mapInArrow(ask_words, REQUEST).groupBy("bucket").applyInArrow(add_words(bits), ANSWER))
        totals = words.where("block is null").agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("total", "listed", "bits", "seen", "kind"))).first()
        n, v, once, twice, frequent = (int(x) for x in totals)
        discount = min(max(once / max(once + 2 * twice, 1), 0.05), 0.95)

        def learn_words(left: pa.Table, right: pa.Table) -> pa.Table:
            b, payload, got = told(left, right)
            return pa.table({"block": pa.array([b]), "payload": pa.array([Words(payload, bits).learned(got[0])], pa.binary())})

        answers = words.where("block is not null").select("block", "kind", "bucket", "payload")
        names.append(keep_by_block(raw.select("block", "payload").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(learn_words, "block long, payload binary")))
        forget(spark, names.pop(0))
        blocks = spark.table(names[0]).select("block", "payload")

        def informed(answers: DataFrame, levels: int, ask: str, schema: str) -> DataFrame:
            """Each block with the answers that it has got on `levels` levels of frequent contexts, asked for `ask`."""

            def run(left: pa.Table, right: pa.Table) -> pa.Table:
                b, payload, got = told(left, right)
                block = Block(payload, bits, depth, n, v, discount)
                for k in range(1, levels + 1):
                    block.learn_pairs(k, got.get(2 * k - 1, {}))
                    if ask != "contexts" or k < levels:
                        block.learn_contexts(k, got.get(2 * k, {}))
                if ask == "scores":
                    return pa.Table.from_batches([block.scores({(-kind, bucket): x for kind, own in got.items() if kind < 0 for bucket, x in own.items()})])
                return requests_of(b, {"pairs": lambda: block.ask_pairs(levels + 1), "contexts": lambda: block.ask_contexts(levels), "windows": block.ask_windows}[ask]())

            return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)

        answers, level = answers.limit(0), 0
        while n and frequent and level < depth:
            found = materialise(informed(answers, level, "pairs", REQUEST).groupBy("bucket").applyInArrow(add_pairs, ANSWER))
            answers, level = answers.unionByName(found.where("block is not null").select("block", "kind", "bucket", "payload")), level + 1
            frequent = found.where("block is null and context is null").agg(F.sum("listed")).first()[0]
            tests = found.where("context is not null").groupBy("context").agg(F.sum("bits").alias("bits"), F.sum("seen").alias("seen"), F.sum("listed").alias("listed"), F.sum("total").alias("total"))
            retained = tests.where(F.col("total") >= MIN_CONTEXT).where(F.col("bits") - F.col("seen") * F.log2("total") > COST_BITS * (F.col("listed") + 1))
            back = F.greatest(1 - (F.col("seen") - F.col("listed") * DISCOUNT) / F.col("total"), F.lit(1e-6)).alias("back")
            bucket = F.shiftrightunsigned("context", 64 - bits).cast("long").alias("bucket")
            asked = informed(answers, level, "contexts", REQUEST)
            shares = asked.groupBy("bucket").cogroup(retained.select(bucket, "context", back).groupBy("bucket")).applyInArrow(look_up, ANSWER)
            answers = answers.unionByName(materialise(shares).select("block", "kind", "bucket", "payload"))
        if n:
            solved = informed(answers, level, "windows", REQUEST).groupBy("bucket").applyInArrow(solve, ANSWER)
            answers = answers.unionByName(solved.select("block", "kind", "bucket", "payload"))
        return materialise(informed(answers, level, "scores", SCORES))
    finally:
        for name in names:
            forget(spark, name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
