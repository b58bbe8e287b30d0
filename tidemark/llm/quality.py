"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score(x) = sigmoid(w0 + sum w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i (v_if x_i)^2]),
so the pairwise interactions cost time linear in the features present.

Features of a text: its words hashed to ``BUCKETS`` (log counts, unit length), statistics
of its structure in soft bins, and its length as metadata.  Fitted with AdaGrad on a
bounded sample of labelled training rows (``SAMPLE_ROWS``); a feature vector has at most
``BUCKETS`` entries, so the sample is bounded in bytes as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import WordHasher, fold, map_batches, materialise, row_id, share_of, text_of, words_of

SAMPLE_ROWS = 8_000
#: Labels up to this size are broadcast; beyond it they are joined by a shuffle.
BROADCAST_BYTES = 16 << 20
BUCKETS, FACTORS, BINS = 1 << 13, 4, 8
EPOCHS, BATCH, RATE, DECAY = 20, 128, 0.1, 1e-5
STATISTICS = ("chars", "words", "word_length", "upper", "digits", "marks", "odd_ends", "distinct_words", "distinct_lines", "top_word", "line_length", "bars", "stops", "long_words", "non_ascii", "distinct_grams")
TABLE_UPPER = bytes(range(65, 91))
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,'-")


def statistics(data: bytes, words: list[bytes], hashes: np.ndarray) -> np.ndarray:
    """Structure of one text, each a bounded or logarithmic number; all 0 for an empty text."""
    n, m = len(data), len(words)
    if not m:
        return np.zeros(len(STATISTICS))
    share = lambda chars: (n - len(data.translate(None, chars))) / n
    lines = data.split(b"\n")
    distinct, counts = np.unique(hashes, return_counts=True)
    letters = sum(map(len, words))
    odd = sum(not (w[-1:].isalnum() or w[-1] in b".,;:" or w[-1] > 127) for w in words)
    grams = hashes[:-2] * np.uint64(3) + hashes[1:-1] * np.uint64(5) + hashes[2:] * np.uint64(7) if m > 2 else hashes
    return np.array(
        [
            np.log1p(n), np.log1p(m), letters / m, share(TABLE_UPPER), share(b"0123456789"), share(MARKS), odd / m,
            len(distinct) / m, len(set(lines)) / len(lines), counts.max() / m, np.log1p(n / len(lines)), share(b"|"), share(b"."),
            sum(len(w) > 20 for w in words) / m, sum(map((127).__lt__, data)) / n if not data.isascii() else 0.0, len(np.unique(grams)) / max(1, len(grams)),
        ]
    )


def vector(data: bytes, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket numbers, their weights, statistics) of a text."""
    words = words_of(data)
    hashes = hasher(words)
    buckets, counts = np.unique((hashes >> np.uint64(20)).astype(np.int64) % BUCKETS, return_counts=True)
    weight = np.log1p(counts)
    norm = np.sqrt((weight**2).sum())
    return buckets, weight / norm if norm else weight, statistics(data, words, hashes)


def soft_bins(stats: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The bin number of each statistic as a feature number behind the word buckets.  edges: (statistics, BINS - 1)."""
    where = (stats[:, None] > edges).sum(axis=1)
    return BUCKETS + np.arange(len(stats)) * BINS + where


class Machine:
    def __init__(self, edges: np.ndarray, bias: float, linear: np.ndarray, factors: np.ndarray):
        self.edges, self.bias, self.linear, self.factors = edges, bias, linear, factors

    def features(self, buckets, weights, stats) -> tuple[np.ndarray, np.ndarray]:
        extra = soft_bins(stats, self.edges)
        return np.concatenate([buckets, extra]), np.concatenate([weights, np.full(len(extra), 0.5)])

    def margin(self, i: np.ndarray, x: np.ndarray) -> float:
        vx = self.factors[i] * x[:, None]
        s = vx.sum(axis=0)
        return float(self.bias + self.linear[i] @ x + 0.5 * (s @ s - (vx * vx).sum()))


def train(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> Machine:
    """AdaGrad on the logistic loss.  With one class only, the machine returns that class's prior."""
    rng = np.random.default_rng(seed)
    n = BUCKETS + len(STATISTICS) * BINS
    stats = np.array([r[2] for r in rows]) if rows else np.zeros((1, len(STATISTICS)))
    edges = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T
    prior = float(np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99))
    machine = Machine(edges, float(np.log(prior / (1 - prior))), np.zeros(n), rng.normal(0, 0.02, (n, FACTORS)))
    if not len(labels) or labels.min() == labels.max():
        machine.factors[:] = 0
        return machine
    data = [machine.features(*r) for r in rows]
    g_bias, g_linear, g_factors = 1e-2, np.full(n, 1e-2), np.full((n, FACTORS), 1e-2)
    for _ in range(EPOCHS):
        order = rng.permutation(len(data))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            doc = np.repeat(np.arange(len(some)), [len(data[k][0]) for k in some])
            i = np.concatenate([data[k][0] for k in some])
            x = np.concatenate([data[k][1] for k in some])
            vx = machine.factors[i] * x[:, None]
            starts = np.concatenate([[0], np.cumsum([len(data[k][0]) for k in some])[:-1]])
            s = np.add.reduceat(vx, starts)
            margin = machine.bias + np.add.reduceat(machine.linear[i] * x, starts) + 0.5 * ((s * s).sum(1) - np.add.reduceat((vx * vx).sum(1), starts))
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[some]) / len(some)
            e = error[doc] * x
            grad_v = e[:, None] * (s[doc] - vx)
            grad_w = np.bincount(i, e, n) + DECAY * machine.linear
            total_v = np.column_stack([np.bincount(i, grad_v[:, f], n) for f in range(FACTORS)]) + DECAY * machine.factors
            g_bias += error.sum() ** 2
            g_linear += grad_w**2
            g_factors += total_v**2
            machine.bias -= RATE * error.sum() / np.sqrt(g_bias)
            machine.linear -= RATE * grad_w / np.sqrt(g_linear)
            machine.factors -= RATE * total_v / np.sqrt(g_factors)
    return machine


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher()
    for batch in batches:
        rows = [vector(t, hasher) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["label"], pa.array([r[0].tolist() for r in rows], pa.list_(pa.int32())), pa.array([r[1].tolist() for r in rows], pa.list_(pa.float32())), pa.array([r[2].tolist() for r in rows], pa.list_(pa.float64()))],
            names=["label", "buckets", "weights", "stats"],
        )


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 5, held_fold: int = 0) -> Machine:
    """Learn from at most about ``SAMPLE_ROWS`` labelled rows outside the held fold.

    The bound holds for rows of documents that have a label, however often an id occurs on
    either side.  Null labels and ids teach nothing.  ``docs`` must be a stable source.
    """
    given = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")).where(F.col("label").isNotNull() & F.col("id").isNotNull() & (fold(folds, "id") != held_fold))
    rows = docs.select(row_id(docs).alias("uid"), F.col(f"`{id_col}`").alias("id"), text_of(f"`{text_col}`").cast("binary").alias("text"))
    small = given.count() * 16 <= BROADCAST_BYTES
    matched = rows.select("uid", "id").join(F.broadcast(given) if small else given, "id")
    wanted = materialise(share_of(matched, SAMPLE_ROWS, "uid", "label").select("uid", "label"), "quality-sample")  # about SAMPLE_ROWS rows at most
    rows = rows.select("uid", "text").join(F.broadcast(wanted), "uid").select("label", "text")
    got = map_batches(rows, _vectors, "label int, buckets array<int>, weights array<float>, stats array<double>").toArrow().combine_chunks()
    if not len(got):
        return train([], np.zeros(0))
    columns = [_lists(got[c]) for c in ("buckets", "weights", "stats")]
    examples = list(zip(*columns, strict=True))
    labels_ = got["label"].to_numpy().astype(float)
    order = np.lexsort([labels_, [float(x[2][0]) for x in examples], [float(x[0].sum()) for x in examples]])  # the same order in every run
    return train([examples[i] for i in order], labels_[order])


def _lists(column) -> list[np.ndarray]:
    """The arrays of a list column, as views."""
    parts = []
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        values, cuts = chunk.values.to_numpy(), chunk.offsets.to_numpy()
        parts += [values[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
    return parts


def _apply(machine: Machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            margins = [machine.margin(*machine.features(*vector(t, hasher))) for t in batch["text"].to_pylist()]
            p = 1 / (1 + np.exp(-np.clip(np.array(margins, float), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(p, pa.float64())], names=["row", "score"])

    return run


def score(docs: DataFrame, machine: Machine, text_col: str = "text") -> DataFrame:
    """``row`` (a struct of all columns of ``docs``) and ``score`` for each row; null text is scored as empty."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    schema = docs.select(row.alias("row")).schema.add("score", "double")
    return map_batches(docs.select(row.alias("row"), text_of(f"`{text_col}`").cast("binary").alias("text")), _apply(machine), schema)
