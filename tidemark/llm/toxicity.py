"""Toxicity: maximum-scoring segments over token log-odds, with extreme-value calibration.

Fit, from labelled training rows only, equal texts of one label counted once:
* token log-odds toxic against clean under a Dirichlet prior of ``PRIOR`` documents a class
  beside the number expected from the token's overall frequency, so that rare tokens are
  drawn to zero and unequal classes favour none; tokens are words and their 4- and 5-letter
  beginnings, counted once per document.  Tokens are known by one of ``BUCKETS`` hash
  buckets, so the model has one size whatever the corpus; none is dropped or cut off.
* a word scores the greatest log-odds of its tokens, at least 0, less ``DRIFT``, so that
  clean text drifts down.
* scale and K of the extreme-value law of clean documents' best segments, by maximum
  likelihood, and a logistic curve from what a document's segments say to a probability.
  Both see each row with the weights that the other rows give.

Score: Ruzzo and Tompa's linear scan finds all maximal segments of a whole text; each
gets the extreme-value score ``E = scale * S - ln(K n)``, and those whose best-segment
probability ``1 - exp(-exp(-E))`` is under ``SIGNIFICANT`` are the toxic passages.  The
best segment and the sum over all passages enter the probability.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import CACHE_ENTRIES, CACHE_KEY, fold, map_batches, materialise, process_cache, share_of, text_of

WORD = re.compile(r"[^\W\d_]+")
#: Labelled rows used for the calibration.
CALIBRATION_ROWS = 20_000
#: Both by leave-one-out over the training rows of sf0.01 and sf0.1.
PRIOR, DRIFT = 1.0, 2.0
SIGNIFICANT = 0.05
#: The least E of a passage.
LIMIT = -math.log(-math.log1p(-SIGNIFICANT))
#: Hash buckets of tokens (a power of two): 4 bytes each in the model.
BUCKETS = 1 << 21
#: Labels up to this size are broadcast; beyond it they are joined by a shuffle.
BROADCAST_BYTES = 16 << 20
PASSAGES = "array<struct<first: int, last: int, evidence: double>>"


def tokens_of(word: str) -> tuple[str, ...]:
    """The word and, marked by a star, its beginnings."""
    n = len(word)
    return (word, word[:4] + "*", word[:5] + "*") if n > 5 else (word, word[:4] + "*") if n > 4 else (word,)


def buckets_of(word: str) -> tuple[int, ...]:
    return tuple(xxhash.xxh3_64_intdigest(t.encode()) & (BUCKETS - 1) for t in tokens_of(word.lower()))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task (bucket, toxic documents, clean documents), summed again by the shuffle; bucket -1 counts documents."""
    known = process_cache("toxic-buckets")
    counts = np.zeros((2, BUCKETS), np.int32)
    docs = [0, 0]
    for batch in batches:
        for text, label in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
            found: set[int] = set()
            for w in set(WORD.findall(text)):
                keys = known.get(w)
                if keys is None:
                    keys = buckets_of(w)
                    if len(w) <= CACHE_KEY:
                        if len(known) >= CACHE_ENTRIES:
                            known.clear()
                        known[w] = keys
                found.update(keys)
            counts[1 if label else 0][np.fromiter(found, np.int64, len(found))] += 1
            docs[1 if label else 0] += 1
    some = np.flatnonzero(counts.any(axis=0))
    for at in range(0, len(some), 100_000):
        part = some[at : at + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(counts[1][part], pa.int64()), pa.array(counts[0][part], pa.int64())], names=["bucket", "toxic", "clean"])
    yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (-1, docs[1], docs[0])], names=["bucket", "toxic", "clean"])


def maximal_segments(places: list[int], weights: list[float], rest: float, gaps: list[float] | None = None) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, first, last token) of a sequence in which the given places have
    positive weights and every other token has weight ``rest`` < 0, or those before each place sum to ``gaps``.  Ruzzo and Tompa's algorithm over the positive places."""
    stack: list[tuple[float, float, int, int, int]] = []  # left sum, right sum, first, last, index of the nearest lower left sum
    total, before = 0.0, -1
    for i, (place, weight) in enumerate(zip(places, weights, strict=True)):
        total += rest * (place - before - 1) if gaps is None else gaps[i]
        left, first = total, place
        total += weight
        before = place
        right, last = total, place
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= right:
                stack.append((left, right, first, last, j))
                break
            left, first = stack[j][0], stack[j][2]
            del stack[j:]
    return [(r - le, a, b) for le, r, a, b, _ in stack]


class Lexicon:
    """Log-odds by bucket, 0 where not over 0; finds segments of a text."""

    def __init__(self, odds: np.ndarray):
        self.odds = odds
        self.known: dict[str, float] = {}

    def weight(self, word: str) -> float:
        w = self.known.get(word)
        if w is None:
            w = max(float(self.odds[b]) for b in buckets_of(word)) - DRIFT
            if len(word) <= CACHE_KEY:
                if len(self.known) >= CACHE_ENTRIES:
                    self.known.clear()
                self.known[word] = w
        return w

    def segments(self, text: str) -> tuple[int, list[tuple[float, int, int]]]:
        """The number of words, and the maximal segments as (score, first, last word)."""
        words = WORD.findall(text)
        known = self.known
        try:
            values = [known[w] for w in words]
        except KeyError:
            values = [self.weight(w) for w in words]
        places = [i for i, v in enumerate(values) if v > 0]
        if not places:
            return len(words), []
        sums = list(accumulate(values, initial=0.0))
        gaps = [sums[i] - sums[before + 1] for before, i in zip([-1, *places], places, strict=False)]
        return len(words), maximal_segments(places, [values[i] for i in places], -DRIFT, gaps)


def log_odds(y: np.ndarray, z: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Of tokens in y of n1 toxic and z of n0 clean documents, under the prior; 0 where not over 0 or never seen."""
    rate = (y + z) / max(n1 + n0, 1.0)
    odds = np.log((y + PRIOR) / (rate * n1 + PRIOR)) - np.log((z + PRIOR) / (rate * n0 + PRIOR))
    return np.maximum(odds, 0.0)


def fit_weights(counts: DataFrame) -> tuple[Lexicon, dict[int, Lexicon]]:
    """Log-odds of ``counts(bucket, toxic, clean)``, and by label those that the other rows give a row of it.

    Only buckets in some toxic document have log-odds over 0; at most ``BUCKETS`` rows reach the driver.
    """
    docs = counts.where("bucket = -1").agg(F.sum("toxic"), F.sum("clean")).first()
    d1, d0 = float(docs[0] or 0), float(docs[1] or 0)
    tables = np.zeros((3, BUCKETS), np.float32)
    if d1 and d0:
        got = counts.where("bucket >= 0 AND toxic > 0").select(F.col("bucket").cast("int"), F.col("toxic").cast("int"), F.col("clean").cast("int")).toArrow()
        at, y, z = (got[c].to_numpy().astype(np.float64 if c != "bucket" else np.int64) for c in ("bucket", "toxic", "clean"))
        tables[0][at] = log_odds(y, z, d1, d0)
        tables[1][at] = log_odds(y, np.maximum(z - 1, 0), d1, d0 - 1)  # for a clean row
        tables[2][at] = log_odds(np.maximum(y - 1, 0), z, d1 - 1, d0)  # for a toxic row
    full, clean, toxic = map(Lexicon, tables)
    return full, {0: clean, 1: toxic}


def _raw(lexicon: Lexicon):
    """Columns segments (their scores) and n_words of each text, for the calibration."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lexicon.segments(t) for t in batch["text"].to_pylist()]
            scores = pa.array([[s for s, _, _ in segments] for _, segments in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch["toxic"], scores, pa.array([n for n, _ in found], pa.int64())], names=["toxic", "segments", "n_words"])

    return run


def evidence(scores: list[float], n_words: int, k: float, scale: float) -> list[float]:
    """The extreme-value score of each segment."""
    floor = math.log(k * max(n_words, 1))
    return [scale * s - floor for s in scores]


def features(scores: list[float], n_words: int, k: float, scale: float) -> tuple[float, float, float]:
    """Of a document: its best segment's extreme-value score, its best raw score, and the sum over its toxic passages."""
    found = evidence(scores, n_words, k, scale)
    best = max(found, default=-math.log(k * max(n_words, 1)))
    return min(max(best, -20.0), 40.0) / 10, math.log1p(max(scores, default=0.0)), math.log1p(sum(e for e in found if e > LIMIT))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights (bias last) of a ridge-penalised logistic regression, by Newton steps."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)), a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    def __init__(self, lexicon: Lexicon, k: float, scale: float, weights: np.ndarray):
        self.lexicon, self.k, self.scale, self.weights = lexicon, k, scale, weights

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5, held_fold: int = 0) -> Model:
    """Learn from the labelled rows outside the held fold.

    Without both labels, or without rows, every score is the prior.  Null labels and null
    ids teach nothing; of rows with one text and label one is counted, however often an id
    occurs on either side.  Calibration takes at most about ``CALIBRATION_ROWS`` of them.
    """
    train = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(f"`{text_col}`").alias("text")).where(F.col("id").isNotNull() & (fold(folds, "id") != held_fold))
    given = labels.select(F.col(f"`{id_col}`").alias("id"), (F.col(f"`{label_col}`").cast("int") != 0).cast("int").alias("toxic")).where("toxic IS NOT NULL")
    small = given.count() * 32 <= BROADCAST_BYTES
    train = materialise(train.join(F.broadcast(given) if small else given, "id").dropDuplicates(["text", "toxic"]).select("text", "toxic"), "toxic-train")
    counts = map_batches(train, _count, "bucket long, toxic long, clean long").groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    lexicon, without = fit_weights(materialise(counts, "toxic-counts"))
    sample = share_of(train, CALIBRATION_ROWS, "text", "toxic")
    rows: list[tuple[int, list[float], int]] = []
    for label in (0, 1):
        got = map_batches(sample.where(F.col("toxic") == label), _raw(without[label]), "toxic int, segments array<double>, n_words long").toArrow()
        rows += zip(got["toxic"].to_pylist(), got["segments"].to_pylist(), got["n_words"].to_pylist(), strict=True)
    rows.sort()  # the same order in every run
    y = np.array([r[0] for r in rows], float)
    clean = [r for r in rows if not r[0]]
    k, scale = gumbel(np.array([max(r[1], default=0.0) for r in clean]), np.array([r[2] for r in clean], float))
    if not len(y) or y.min() == y.max():
        return Model(lexicon, k, scale, np.array([0.0, 0.0, 0.0, -3.0 if not len(y) or y.max() == 0 else 3.0]))
    return Model(lexicon, k, scale, logistic(np.array([features(s, n, k, scale) for _, s, n in rows]), y))


def gumbel(best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """(K, scale) of the extreme-value law of clean texts' best scores, P(S < x) = exp(-K n e^(-scale x)).

    By maximum likelihood, K in closed form for each scale and the scale by golden
    section; a text without a segment (0) is known to be under 0 only.  Fewer than ten
    texts with a segment tell too little: then K is 0.001 and the scale 1.
    """
    has = best > 0
    m = int(has.sum())
    if m < 10:
        return 1e-3, 1.0
    n = np.maximum(n, 1.0)
    k_of = lambda scale: m / np.sum(n * np.exp(-scale * best))
    likelihood = lambda t: m * (math.log(k_of(math.exp(t))) + t) - math.exp(t) * best[has].sum()
    low, high, ratio = math.log(0.02), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(80):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if likelihood(a) < likelihood(b):
            low = a
        else:
            high = b
    scale = math.exp((low + high) / 2)
    return float(k_of(scale)), scale


def _apply(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, passages = [], []
            for text in batch["text"].to_pylist():
                n, segments = model.lexicon.segments(text)
                scores = [s for s, _, _ in segments]
                x.append(features(scores, n, model.k, model.scale))
                found = [(a, b, e) for (_, a, b), e in zip(segments, evidence(scores, n, model.k, model.scale), strict=True) if e > LIMIT]
                if found:  # from words to characters
                    spans = [m.span() for m in WORD.finditer(text)]
                    found = [{"first": spans[a][0], "last": spans[b][1], "evidence": e} for a, b, e in found]
                passages.append(found)
            p = model.probability(np.array(x).reshape(len(x), 3))
            kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("evidence", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(p), pa.array(passages, kind)], names=["doc_id", "held_out", "score", "passages"])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_fold: int = 0) -> DataFrame:
    """``doc_id, held_out, score, passages`` for every row.

    ``passages`` are the spans of the text from ``first`` up to but without ``last``, in
    characters, that are toxic beyond chance, with their extreme-value scores.  Null text
    is empty: it has no passage and a low score.  Repeated rows are scored each, equal
    texts get equal scores, and a text of any length is read whole.  An empty table gives
    an empty result.  Columns other than the two named ones are not read.  Ids are integers.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), (fold(folds, f"`{id_col}`") == held_fold).alias("held_out"), text_of(f"`{text_col}`").alias("text"))
    return map_batches(rows, _apply(model), f"doc_id long, held_out boolean, score double, passages {PASSAGES}")
