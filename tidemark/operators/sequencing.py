"""Reproducible numbers for delivered rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def file_row_num(df: DataFrame, file_col: str, order: Sequence[str | Column], coarse: Column | None = None) -> DataFrame:
    """Number the rows of each file from 1; ties must be broken by ``order``.

    ``coarse``: a value that never falls as ``order`` rises and has few values (the first
    characters of a hash).  With it no task sorts a whole file: rows are numbered within
    (file, coarse), and the counts of a file's earlier values are added.
    """
    if coarse is None:
        return df.withColumn("_file_row_num", F.row_number().over(Window.partitionBy(file_col).orderBy(*order)).cast("long"))
    rows = df.withColumn("_coarse", coarse)
    counts = rows.groupBy(F.col(file_col).alias("_f"), F.col("_coarse").alias("_c")).agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy("_f").orderBy("_c").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_rows")
    counts = counts.select("_f", "_c", before.alias("_earlier"))
    here = F.row_number().over(Window.partitionBy(file_col, "_coarse").orderBy(*order))
    met = rows.withColumn("_here", here).join(counts, F.col(file_col).eqNullSafe(F.col("_f")) & F.col("_coarse").eqNullSafe(F.col("_c")))
    return met.withColumn("_file_row_num", (F.col("_here") + F.col("_earlier")).cast("long")).drop("_coarse", "_here", "_f", "_c", "_earlier")


def ingest_seq(df: DataFrame, file_col: str, file_order: Sequence[str], row_order: Sequence[str | Column], base: int = 0, into: str = "_ingest_seq", coarse: Column | None = None) -> DataFrame:
    """Number all rows by (file order, row order) without sorting them in one place.

    Rows are numbered within their file and shifted by the rows of all earlier files.
    Only one count per file meets in a single task; rows never do, and with ``coarse``
    (see ``file_row_num``) not even those of one file.
    """
    numbered = file_row_num(df, file_col, row_order, coarse)
    counts = df.groupBy(file_col, *[c for c in file_order if c != file_col]).agg(F.count("*").alias("_rows"))
    running = F.sum("_rows").over(Window.orderBy(*file_order, file_col).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    starts = counts.select(F.col(file_col).alias("_file"), (running - F.col("_rows") + base).alias("_start"))
    joined = numbered.join(starts, numbered[file_col] == starts["_file"])
    return joined.withColumn(into, F.col("_start") + F.col("_file_row_num")).drop("_file", "_start")


def sequence_base(df: DataFrame, seq_col: str = "_ingest_seq") -> DataFrame:
    """One row: the highest number given so far, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(seq_col), F.lit(0)).cast("long").alias("base"))


def manifest_seq(delivery: Column, row_num: Column) -> Column:
    """A number from a manifest's delivery number and the row's place in its file."""
    return delivery.cast("long") * F.lit(1_000_000_000) + row_num.cast("long")
