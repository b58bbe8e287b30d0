"""Token counts by section: whole documents are encoded once and tokens mapped to spans.

A section is a span of a document's text.  Tokens come from one pass over the whole
document, so counts do not depend on how the text is cut.  Token byte spans (from the
ids' byte lengths) are joined to section spans by a merge of two sorted interval lists.

Rule for a token that crosses a border: it belongs to the section that holds its first
byte; ``n_crossing`` of that section counts it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import map_batches, process_cache, text_of

SCHEMA = "doc_id long, section int, start_char long, end_char long, n_tokens long, n_crossing long, doc_tokens long"


def load_encoding(path: str):
    """The byte-level encoding of a rank file and the byte length of each id."""
    import base64

    import public_tokenizers
    import tiktoken

    cache = process_cache(f"tiktoken:{path}")
    if not cache:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for piece, i in ranks.items():
            lengths[i] = len(piece)
        cache["encoding"] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        cache["lengths"] = lengths
    return cache["encoding"], cache["lengths"]


def attribute(starts: np.ndarray, ends: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and crossing tokens per section.  ``borders``: first byte of each section, ascending, the first 0."""
    first = np.searchsorted(borders, starts, "right") - 1
    last = np.searchsorted(borders, ends - 1, "right") - 1
    return np.bincount(first, minlength=len(borders)), np.bincount(first[last > first], minlength=len(borders))


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, lengths = load_encoding(path)
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            ids_of: list[int | None] = batch["doc_id"].to_pylist()
            texts = batch["text"].to_pylist()
            for doc_id, text in zip(ids_of, texts, strict=True):
                lines = text.split("\n")
                chars = np.array([len(x) + 1 for x in lines], np.int64)
                size = chars if text.isascii() else np.array([len(x.encode()) + 1 for x in lines], np.int64)
                borders, begin = np.cumsum(size) - size, np.cumsum(chars) - chars
                spans = np.cumsum(lengths[np.array(encoding.encode_ordinary(text), np.int64)]) if text else np.zeros(0, np.int64)
                starts = np.concatenate([np.zeros(1, np.int64), spans[:-1]]) if len(spans) else spans
                n, crossing = attribute(starts, spans, borders)
                for column, value in zip(out, ([doc_id] * len(lines), range(len(lines)), begin.tolist(), np.minimum(begin + chars, len(text)).tolist(), n.tolist(), crossing.tolist(), [len(spans)] * len(lines)), strict=True):
                    column.extend(value)
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)

    return run


def section_token_counts(docs: DataFrame, rank_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line of each document: its character span and the tokens that start in it.

    Lines tile the document: each runs up to and with its newline, so the counts of a
    document's lines add up to ``doc_tokens``.  Null or empty text has one section of no
    tokens.  Repeated rows are counted each.  ``docs`` columns other than the two named
    ones are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return map_batches(rows, _count(rank_path), SCHEMA)
