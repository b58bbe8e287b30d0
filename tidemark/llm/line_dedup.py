"""Line dedup: drop lines that many documents share.

Lines are exploded as 128-bit hashes of their normalised form, documents are counted
per hash with map-side partial sums, and lines over the threshold go.  Text never
enters the counting shuffle.  The list of frequent hashes is broadcast only when its
measured size is under ``BROADCAST_BYTES``; beyond that the join shuffles, where
adaptive execution may split a hot hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import SPACES, ascii_lower, materialise, row_id, text_of

BROADCAST_BYTES = 16 << 20


def line_key(line: Column) -> Column:
    """The normalised line: white space stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _hashes(line: Column) -> Column:
    key = line_key(line)
    return F.when(key != "", F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b")))


def dedup_lines(docs: DataFrame, text_col: str = "text", min_docs: int = 10) -> DataFrame:
    """All columns of ``docs`` in a struct ``row``, with ``n_lines``, ``n_dropped`` and ``kept`` (the text left).

    Every row is a document of its own: repeated rows count once each, a line repeated in
    one row counts once.  Null or empty text is one empty line, which stays.  Empty keys
    are never counted.  A document that loses all its lines keeps the empty text.
    ``docs`` must be a stable source (files or a written table), for rows are numbered
    by their place in it.
    """
    rows = docs.select(row_id(docs).alias("rid"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.split(text_of(text_col), "\n", -1).alias("lines"))
    keys = materialise(rows.select("rid", F.explode(F.array_distinct(F.transform("lines", _hashes))).alias("key")).where("key IS NOT NULL"), "line-keys")
    frequent = materialise(keys.groupBy("key").count().where(F.col("count") >= min_docs).select("key"), "frequent-lines")
    small = frequent.count() * 32 <= BROADCAST_BYTES
    dropped = keys.join(F.broadcast(frequent) if small else frequent, "key", "left_semi").groupBy("rid").agg(F.collect_set("key").alias("dropped"))
    joined = rows.join(dropped, "rid", "left")
    kept = F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.coalesce(F.array_contains(F.col("dropped"), _hashes(x)), F.lit(False))))
    return joined.select("row", F.size("lines").cast("long").alias("n_lines"), kept.alias("left")).select("row", "n_lines", (F.col("n_lines") - F.size("left")).alias("n_dropped"), F.array_join("left", "\n").alias("kept"))
