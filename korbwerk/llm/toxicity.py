"""Operator 4: toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Labels are learned from rows whose crc32(doc_id) mod 4 is not 2, split by that remainder so that no step is judged by what it has seen: 0 and 3 give the lexicon (terms
and word beginnings that toxic texts use far more often, with the logarithm of how much more, added to a short list of insults), 1 the trees; the calibration sees the scores that trees of one
half of those rows give the other half. Of all labelled rows, the TRAIN_ROWS of the lowest hash are used; this bound is the model's only sample. The features of a text are densities,
counts and weights of lexicon hits, hits near the second person, capitals, punctuation and disguised words, so the model is small and scores every row alone, without a shuffle.

Null and empty texts get the score of their (zero) features. Null doc_id: not held out, never a training row. A document with several labels counts once for each; of several texts
with one doc_id the first in order is the labelled one, so there are never more training rows than labels. Very long texts are read whole.
Without labelled rows, or with one class only, every score is the share of label 1 (0 without rows). Repeated rows get equal scores; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from korbwerk.llm.common import for_worker, slices, sums, table, words_of
from korbwerk.plans.checkpoint import materialise

TRAIN_ROWS = 30_000
THRESHOLD = 0.3
TREES, DEPTH, RATE, BINS, LEAF = 60, 3, 0.2, 32, 5
STEMS, LEXICON, LEAST, LIFT, STRONG = (3, 4, 5, 6, 7), 4000, 4, 8.0, 40.0
NEAR = 6
#: Bytes of word features that a worker keeps: some 400,000 words.
FEATURE_BYTES = 160 << 20
#: Insults and words of the second person that the lexicon begins with.
INSULTS = frozenset("idiot idiots moron morons stupid loser losers pathetic worthless scum trash garbage clown disgusting dumb fool ugly hate hateful vermin filth filthy jerk freak bastard idioten dumm abschaum versager imbécile crétin débile idiota estúpido estúpida imbécil basura asqueroso".split())
SECOND = frozenset("you your yours yourself u ur du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous votre vos tú ti tuyo usted ustedes vosotros".split())
DISGUISES = str.maketrans("013457@$!|", "oieastasii")
FEATURES = ("words", "hit_rate", "hits", "kinds", "weight_rate", "weight", "strong_rate", "strong", "near_rate", "near", "upper_rate", "shout_rate", "mark_rate", "punct_rate", "odd_rate", "odd_hits", "stretch_rate")


def term(word: str) -> str:
    """A word in lower case without punctuation around it."""
    return word.lower().strip("\"'.,;:!?()[]{}<>|/\\*#-_~`«»“”„’…")


class Features:
    """Dense features of texts; words are looked at once for each cache."""

    def __init__(self, lexicon: dict[str, float], stems: dict[str, float], cached: int = FEATURE_BYTES):
        self.lexicon, self.stems, self.cached = lexicon, stems, cached
        self.known: dict[bytes, tuple[float, ...]] = {}
        self.held = 0

    def weight(self, core: str) -> float:
        """The largest weight of the term and its beginnings."""
        return max([self.lexicon.get(core, 0.0), *(self.stems.get(core[:k], 0.0) for k in STEMS if len(core) > k)])

    def word(self, raw: bytes) -> tuple[float, ...]:
        """weight, strong, second person, letters, capitals, shouted, !?, other punctuation, disguised, disguised hit, stretched."""
        text = raw.decode()
        core = term(text)
        letters = sum(map(str.isalpha, text))
        capitals = sum(map(str.isupper, text))
        marks = text.count("!") + text.count("?")
        weight = self.weight(core)
        odd = not core.isalpha() and any(map(str.isalpha, core)) and not core.replace("-", "").replace("'", "").replace("’", "").isalpha()
        plain = "".join(c for c in core.translate(DISGUISES) if c.isalpha()) if odd else core
        stretched = len(core) > 3 and any(a == b == c for a, b, c in zip(core, core[1:], core[2:], strict=False))
        return (weight, weight >= np.log(STRONG), core in SECOND, letters, capitals, letters > 2 and capitals == letters, marks, len(text) - letters - marks, odd, odd and self.weight(plain) > 0, stretched)

    def __call__(self, texts: pa.Array) -> np.ndarray:
        offsets, codes, words = words_of(pc.fill_null(texts, ""), fold=False)
        if self.held > self.cached:
            self.known, self.held = {}, 0
        for w in words:
            if w not in self.known:
                self.known[w] = self.word(w)
                self.held += len(w) + 400
        n = np.diff(offsets).astype(float)
        if not len(codes):
            return np.zeros((len(n), len(FEATURES)))
        of = np.array([self.known[w] for w in words], float)[codes]
        hit = sums(offsets, of[:, 0] > 0).astype(float)
        weight, strong, second, letters, capitals, shouted, marks, punct, odd, odd_hit, stretched = (sums(offsets, of[:, i]).astype(float) for i in range(of.shape[1]))
        text = np.repeat(np.arange(len(n)), np.diff(offsets))
        toxic = np.flatnonzero((of[:, 0] > 0) | (of[:, 9] > 0))
        named = np.flatnonzero(of[:, 2])
        near, kinds = np.zeros(len(n)), np.zeros(len(n))
        if len(toxic):
            kinds = np.bincount(np.unique(np.stack([text[toxic], codes[toxic]]), axis=1)[0], minlength=len(n)).astype(float)
        if len(toxic) and len(named):
            right = np.searchsorted(named, toxic)
            close = np.zeros(len(toxic), bool)
            for at in (np.minimum(right, len(named) - 1), np.maximum(right - 1, 0)):
                close |= (np.abs(named[at] - toxic) <= NEAR) & (text[named[at]] == text[toxic])
            near = np.bincount(text[toxic[close]], minlength=len(n)).astype(float)
        per, letters = np.maximum(n, 1), np.maximum(letters, 1)
        return np.stack([np.log1p(n), hit / per, hit, kinds, weight / per, weight, strong / per, strong, near / per, near, capitals / letters, shouted / per, marks / per, punct / per, odd / per, odd_hit, stretched / per], axis=1)


@dataclass
class Trees:
    """Boosted trees of one depth: at each inner node a feature and a cut, at each leaf a value."""

    base: float
    cuts: list[np.ndarray]
    features: np.ndarray
    thresholds: np.ndarray
    leaves: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.features, self.thresholds, self.leaves, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            total += leaf[at - (2**DEPTH - 1)]
        return total


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Trees:
    """Logistic loss, histogram splits, Newton leaves."""
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    cuts = [np.unique(np.quantile(x[:, j][x[:, j] > x[:, j].min()], np.linspace(0, 1, BINS))) if (x[:, j] > x[:, j].min()).any() else np.zeros(0) for j in range(x.shape[1])]
    cuts = [np.concatenate([[x[:, j].min()], c[:-1]]) if len(c) else c for j, c in enumerate(cuts)]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") if len(c) else np.zeros(len(x), np.int64) for j, c in enumerate(cuts)], axis=1)
    model = Trees(float(np.log(share / (1 - share))), cuts, np.zeros((trees, 2**DEPTH - 1), np.int64), np.full((trees, 2**DEPTH - 1), np.inf), np.zeros((trees, 2**DEPTH)))
    score = np.full(len(x), model.base)
    for t in range(trees):
        p = sigmoid(score)
        g, h = y - p, p * (1 - p)
        at = np.zeros(len(x), np.int64)
        for node in range(2**DEPTH - 1):
            own = np.flatnonzero(at == node)
            best = (1e-6, 0, np.inf, None)
            for j, c in enumerate(cuts):
                if not len(c) or len(own) < 2 * LEAF:
                    continue
                b = binned[own, j]
                gs, hs, ns = (np.cumsum(np.bincount(b, w, len(c) + 1))[:-1] for w in (g[own], h[own], np.ones(len(own))))
                gt, ht = g[own].sum(), h[own].sum()
                gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                gain[(ns < LEAF) | (len(own) - ns < LEAF)] = -1
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], j, c[k], b <= k)
            _, model.features[t, node], model.thresholds[t, node], left = best
            at[own] = 2 * node + 1 + (0 if left is None else ~left)
        leaf = at - (2**DEPTH - 1)
        model.leaves[t] = RATE * np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + 1)
        score += model.leaves[t][leaf]
    return model


def fit_isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the isotonic regression of y (with one case of each class added at the ends), to be interpolated."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []
    for x, v in zip([raw.min() - 1, *raw[order], raw.max() + 1], [0.0, *y[order], 1.0], strict=True):
        blocks.append([x, v, 1.0])
        while len(blocks) > 1 and (blocks[-2][1] >= blocks[-1][1] or blocks[-2][0] == blocks[-1][0]):
            x2, v2, n2 = blocks.pop()
            x1, v1, n1 = blocks.pop()
            blocks.append([(x1 * n1 + x2 * n2) / (n1 + n2), (v1 * n1 + v2 * n2) / (n1 + n2), n1 + n2])
    return np.array([b[0] for b in blocks]), np.array([b[1] for b in blocks])


@dataclass
class Model:
    """What is sent to the tasks: lexicon, trees, calibration. Without trees every score is `share`."""

    lexicon: dict[str, float]
    stems: dict[str, float]
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray] | None
    share: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.share)
        raw = self.trees.raw(x)
        calibrated = np.interp(raw, *self.knots) if self.knots else sigmoid(raw)
        return 0.999 * calibrated + 0.001 * sigmoid(raw)  # the second term only orders what calibration makes equal


def remainder(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4, F.lit(0))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """text, toxic and remainder of labelled documents; at most `most` labels, those of the lowest hash."""
    chosen = labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col("toxic").cast("int").alias("toxic")).where("l_id is not null and toxic in (0, 1)").withColumn("r", remainder("l_id")).where("r <> 2")
    chosen = chosen.orderBy(F.xxhash64("l_id"), "l_id", "toxic").limit(most)
    return docs.select(F.col("doc_id").cast("long").alias("l_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "l_id").groupBy("l_id", "toxic", "r").agg(F.min("text").alias("text")).select("text", "toxic", "r")  # `most` rows at most


def learn_lexicon(rows: DataFrame, size: int = LEXICON) -> tuple[dict[str, float], dict[str, float]]:
    """Weights of terms and of word beginnings that toxic texts use at least LIFT times as often as others; `size` at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            found: dict[tuple[int, str], list[int]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own: Counter[tuple[int, str]] = Counter()
                for t, n in Counter(map(term, (text or "").split())).items():
                    own[-1, ""] += n
                    if 1 < len(t) < 40:
                        own[0, t] += n
                        for k in STEMS:
                            if len(t) > k:
                                own[k, t[:k]] += n
                for key, n in own.items():
                    row = found.setdefault(key, [0, 0, 0])
                    row[toxic] += n
                    row[2] += toxic
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.int32()), pa.array([k[1] for k in found]), *(pa.array([v[i] for v in found.values()], pa.int64()) for i in range(3))], ["kind", "term", "clean", "bad", "bad_texts"])

    counts = materialise(rows.select("text", "toxic").mapInArrow(count, "kind int, term string, clean long, bad long, bad_texts long").groupBy("kind", "term").agg(*(F.sum(c).alias(c) for c in ("clean", "bad", "bad_texts"))).where(f"bad_texts >= {LEAST}"))
    total = counts.where("kind = -1").first()
    if total is None:
        return dict.fromkeys(INSULTS, float(np.log(STRONG))), {}
    lift = (F.col("bad") / max(total["bad"], 1)) / ((F.col("clean") + 0.5) / max(total["clean"], 1))
    top = counts.where("kind >= 0").withColumn("lift", lift).where(F.col("lift") >= LIFT).orderBy(F.desc(F.col("bad_texts") * F.log("lift")), "kind", "term").limit(size).collect()
    weights = {kind: {r["term"]: float(np.log(r["lift"])) for r in top if (r["kind"] > 0) == kind} for kind in (False, True)}
    return dict.fromkeys(INSULTS, float(np.log(STRONG))) | weights[False], weights[True]


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Model:
    """The model, from at most `most` labelled rows."""
    rows = training_rows(docs, labels, most)
    lexicon, stems = learn_lexicon(rows.where("r <> 1"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(lexicon, stems)
        for batch in slices(batches, 0):
            x = features(batch.column(0))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], ["toxic", "x"])

    found = rows.where("r = 1").mapInArrow(describe, "toxic int, x array<double>").collect()  # `most` rows of a few numbers at most
    y = np.array([f["toxic"] for f in found], float)
    x = np.array([f["x"] for f in found]).reshape(len(found), len(FEATURES))
    if len(set(y)) < 2:
        return Model(lexicon, stems, None, None, float(y.mean()) if len(y) else 0.0)
    order = np.lexsort((*x.T, y))  # rows arrive in any order
    x, y = x[order], y[order]
    half = np.arange(len(y)) % 2 == 0
    raw = np.zeros(len(y))
    for own in (half, ~half):
        raw[~own] = fit_trees(x[own], y[own]).raw(x[~own]) if len(set(y[own])) == 2 else 0.0
    return Model(lexicon, stems, fit_trees(x, y), fit_isotonic(raw, y), float(y.mean()))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""

    name = uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = for_worker("toxicity", name, lambda: Features(model.lexicon, model.stems))
        for batch in slices(batches):
            score = np.clip(model.score(features(batch.column(1))), 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (remainder("doc_id") == 2).alias("held_out")).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))
