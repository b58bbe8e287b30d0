"""Benchmark decontamination: pigeonhole edit matching.

A test item within ``k`` edits of a passage shares with it, unchanged, one of any k + 1
pieces the item is cut into.  One automaton over all pieces finds exact piece hits in a
single scan of the whole text; around each hit Myers' bit-parallel distance decides.

Items and texts are compared lower-cased with every run of non-word characters as one
space, and a match covers whole words (both ends are spaces).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import map_batches, materialise, row_id, text_of

ERROR_RATE = 0.05
#: Items are matched in blocks of about so many characters: the automaton's size is bounded, any number of items is handled.
ITEM_CHARS = 4_000_000
GAPS = re.compile(r"\W+")


def normal(text: str) -> str:
    return f" {GAPS.sub(' ', text.lower()).strip()} "


def pieces_of(length: int, edits: int) -> list[tuple[int, int]]:
    """Borders of edits + 1 nearly equal pieces."""
    cuts = [i * length // (edits + 1) for i in range(edits + 2)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def myers(masks: dict[str, int], length: int, text: str) -> int:
    """The least edit distance of the pattern to any part of ``text``.  masks: bit i set where pattern[i] is the character."""
    ones = (1 << length) - 1
    high = 1 << (length - 1)
    up, down, score, best = ones, 0, length, length
    for c in text:
        eq = masks.get(c, 0)
        x = eq | down
        d0 = (((eq & up) + up) ^ up) | eq | down
        hp = down | (ones & ~(d0 | up))
        hn = up & d0
        if hp & high:
            score += 1
        elif hn & high:
            score -= 1
        hp = (hp << 1) & ones
        hn = (hn << 1) & ones
        up = hn | (ones & ~(x | hp | d0))
        down = hp & (x | d0)
        if score < best:
            best = score
            if not best:
                break
    return best


class Matcher:
    def __init__(self, items: list[tuple[int, str]], rate: float = ERROR_RATE):
        import ahocorasick

        self.items, self.automaton = [], ahocorasick.Automaton()
        found: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            pattern = normal(text or "")
            if pattern == "  ":
                continue
            edits = int(len(pattern) * rate)
            masks: dict[str, int] = {}
            for i, c in enumerate(pattern):
                masks[c] = masks.get(c, 0) | 1 << i
            for a, b in pieces_of(len(pattern), edits):
                found.setdefault(pattern[a:b], []).append((len(self.items), a))
            self.items.append((item_id, len(pattern), edits, masks))
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if found:
            self.automaton.make_automaton()
        self.any = bool(found)

    def hits(self, text: str) -> list[tuple[int, int]]:
        """(item id, edits) of every item that the text holds within its budget, by item id."""
        if not self.any:
            return []
        text = normal(text)
        starts: dict[int, set[int]] = {}
        for end, (n, places) in self.automaton.iter(text):
            for item, at in places:
                starts.setdefault(item, set()).add(end + 1 - n - at)
        out = []
        for item, where in starts.items():
            item_id, length, edits, masks = self.items[item]
            best, until = length, None
            spans: list[list[int]] = []
            for s in sorted(where):
                a, b = max(0, s - edits), s + length + edits
                if until is not None and a <= until:
                    spans[-1][1] = until = max(until, b)
                else:
                    spans.append([a, b])
                    until = b
            for a, b in spans:
                best = min(best, myers(masks, length, text[a:b]))
            if best <= edits:
                out.append((item_id, best))
        return sorted(out, key=lambda x: (x[0] is not None, x))


def _match(items: list[tuple[int, str]], rate: float, keep: list[str], all_rows: bool):
    """Columns ``keep`` and ``hits`` of each row, or only of rows with hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items, rate)
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32())]))
        for batch in batches:
            found = [[{"item_id": i, "edits": e} for i, e in matcher.hits(t)] for t in batch["text"].to_pylist()]
            out = pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(found, kind)], names=[*keep, "hits"])
            yield out if all_rows else out.filter(pa.array([bool(f) for f in found], pa.bool_()))

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", rate: float = ERROR_RATE) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``) and ``hits``, an array of (item_id, edits), for each row.

    Null or empty texts hold nothing, null or wordless items match nothing, repeated item
    ids are matched each, and a null item id is reported as null.  Items short enough to
    have no budget must occur unchanged.  Repeated rows get a row each.  Without rows, or
    without items, the result has as many rows as ``docs`` and no hits.  A text of any
    length is read whole.  Item ids are integers.

    Items up to ``ITEM_CHARS`` are matched in one pass over the texts.  More of them are
    dealt into blocks of that size; each block is a pass of its own that keeps only rows
    with hits, so neither the driver nor a task ever holds more than one block.  ``docs``
    must be a stable source then, for hits are joined back by the rows' places.
    """
    items = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("id"), F.col(f"`{item_text_col}`").alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-int(total) // ITEM_CHARS) or 1
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    text = text_of(f"`{text_col}`").alias("text")
    hit_type = "array<struct<item_id: bigint, edits: int>>"
    if blocks == 1:
        whole = docs.select(row.alias("row"), text)
        schema = whole.select("row", F.lit(None).cast(hit_type).alias("hits")).schema
        return map_batches(whole, _match(_block(items, 0, 1), rate, ["row"], True), schema)
    places = docs.select(row_id(docs).alias("uid"), text)
    found = None
    for k in range(blocks):
        one = materialise(map_batches(places, _match(_block(items, k, blocks), rate, ["uid"], False), f"uid long, hits {hit_type}"), "hits")
        found = one if found is None else found.unionByName(one)
    hits = found.groupBy("uid").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"))
    met = docs.select(row_id(docs).alias("uid"), row.alias("row")).join(hits, "uid", "left")
    return met.select("row", F.coalesce("hits", F.array().cast(hit_type)).alias("hits"))


def _block(items: DataFrame, k: int, blocks: int) -> list[tuple[int, str]]:
    return [(r[0], r[1]) for r in items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).orderBy("id", "text").collect()]
