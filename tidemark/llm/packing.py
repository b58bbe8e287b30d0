"""Best-fit packing with certified bin counts.

1. Documents become token pieces of at most ``capacity`` (written once to shared storage).
2. Pieces are dealt evenly to groups of about ``items`` pieces; each group runs best-fit
   decreasing and takes a lower bound from dual-feasible functions.  A group whose bin
   count equals its bound is certified.
3. A group with a gap releases its bins that have slack; a certified group releases only
   its least full bin, where rounding leaves space.  The released pieces are dealt to
   fewer groups and packed again, until one group holds the pool or ``rounds`` is reached.

A group never holds many more than ``items`` pieces, so memory is bounded at any size.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._bpe import WordEncoder
from ._shared import map_batches, materialise, row_id, text_of

END_ID = 1
PIECE_SCHEMA = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long, certified boolean, released boolean"


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and each bin's fill.  Ties go by the item's position.

    Open bins are kept by free space in a bit set, so the tightest bin that fits is found
    with one shift and one lowest-set-bit.
    """
    bins, offsets, fill = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    free: dict[int, list[int]] = {}
    mask = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        x = int(lengths[i])
        fits = mask >> x
        if fits:
            room = x + (fits & -fits).bit_length() - 1
            stack = free[room]
            b = stack.pop()
            if not stack:
                mask ^= 1 << room
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, capacity - room
        fill[b] += x
        if room > x:
            free.setdefault(room - x, []).append(b)
            mask |= 1 << (room - x)
    return bins, offsets, np.array(fill, np.int64)


def dff_lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by two families of dual-feasible functions.

    The first rounds items over ``capacity - t`` up to a full bin and items under ``t``
    down to nothing; the second is the k-step rounding of sizes in units of 1/(k+1).
    """
    if not len(lengths):
        return 0
    hist = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((hist * size).sum()) // capacity)
    count, mass = np.cumsum(hist), np.cumsum(hist * size)
    for t in range(1, capacity // 2 + 1):
        high = int(count[-1] - count[capacity - t])
        middle = int(mass[capacity - t] - mass[t - 1])
        best = max(best, high + -(-middle // capacity))
    for k in range(1, 33):
        scaled = (k + 1) * size
        whole = scaled % capacity == 0
        value = np.where(whole, size * k, (scaled // capacity) * capacity)  # in units of 1 / (k * capacity)
        best = max(best, -(-int((hist * value).sum()) // (k * capacity)))
    return best


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            rows: list[tuple] = []
            for uid, doc_id, text in zip(batch["uid"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = encoder.ids(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((uid, doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ("uid", "doc_id", "piece", "start", "length", "ids_crc32")
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=list(names))

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of each document; null or empty text has the end id alone."""
    rows = docs.select(row_id(docs).alias("uid"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return map_batches(rows, _pieces(tokenizer_path, capacity), PIECE_SCHEMA)


def _pack_group(capacity: int, number: int, final: bool):
    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["uid", "piece"], ignore_index=True)
        lengths = frame["length"].to_numpy(np.int64)
        bins, offsets, fill = best_fit_decreasing(lengths, capacity)
        certified = len(fill) == dff_lower_bound(lengths, capacity)
        slack = capacity - fill
        out = np.zeros(len(fill), bool)
        if not final:
            if not certified:
                out |= slack >= max(1, capacity // 64)
            out[np.argmax(slack)] |= slack.max() > 0
        frame["sequence_id"] = (np.int64(number) << np.int64(58)) + (np.int64(key[0]) << np.int64(28)) + bins
        frame["offset"], frame["certified"], frame["released"] = offsets, certified, out[bins]
        return frame[[x.split()[0] for x in PACKED_SCHEMA.split(", ")]]

    return run


def pack(pieces: DataFrame, capacity: int = 4096, items: int = 20_000, rounds: int = 4) -> DataFrame:
    """``pieces`` (see PIECE_SCHEMA) with ``sequence_id``, ``offset`` and ``certified``.

    ``certified``: the piece's group met its lower bound when its sequence was closed.
    Each piece of at most ``capacity`` tokens gets one place; sequences are gapless.  An
    empty input gives an empty result; equal pieces are packed as often as they occur.
    """
    pool = materialise(pieces, "pieces")
    done: list[DataFrame] = []
    for number in range(rounds):
        n = pool.count()
        groups = max(1, math.ceil(n / items))
        final = groups == 1 or number == rounds - 1
        dealt = pool.withColumn("group", F.pmod(F.xxhash64("uid", "piece", F.lit(number)), F.lit(groups)))
        packed = materialise(dealt.repartition(groups, "group").groupBy("group").applyInPandas(_pack_group(capacity, number, final), PACKED_SCHEMA), "packed")
        done.append(packed.where(~F.col("released")).drop("released", "uid"))
        if final:
            break
        pool = packed.where("released").select(*pieces.columns)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
