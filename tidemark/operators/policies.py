"""Historisation other than type 2: last row, first row, every row, one state per delivery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..columns import DELETED, FULL, HASH, KEY, MODE, SEQ, TENANT
from .scd2 import assign_versions, deletion_events


def current_only(staged: DataFrame, soft: bool = False) -> DataFrame:
    """Type 1: the last row of each entity.  Deleted entities go, or stay flagged ``is_deleted``."""
    rows = staged.unionByName(deletion_events(staged))
    last = rows.withColumn("_n", F.row_number().over(Window.partitionBy(TENANT, KEY).orderBy(F.desc(SEQ)))).where("_n = 1").drop("_n")
    dead = F.col(HASH) == DELETED
    return last.withColumn("is_deleted", dead) if soft else last.where(~dead)


def insert_only(staged: DataFrame) -> DataFrame:
    """Type 0: the first row of each entity stays; changes and deletions are ignored."""
    w = Window.partitionBy(TENANT, KEY).orderBy(SEQ)
    return staged.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def append_only(staged: DataFrame) -> DataFrame:
    """Every delivered row, repeats included."""
    return staged


def snapshot(staged: DataFrame, date_col: str) -> DataFrame:
    """Each full delivery as a state of its own, under its delivery date."""
    return staged.where(F.col(MODE) == FULL).withColumn("snapshot_date", F.to_date(date_col))


def declarations_scd2(rows: DataFrame, key: Sequence[str], values: Sequence[str], load_col: str, seq_col: str, time_col: str) -> DataFrame:
    """Type 2 of declaration tables: each load is complete, so a missing declaration closes its version."""
    staged = rows.select(
        F.lit("meta").alias(TENANT),
        F.concat_ws("|", *key).alias(KEY),
        F.sha2(F.to_json(F.struct(*sorted(values))), 256).alias(HASH),
        F.col(seq_col).cast("long").alias(SEQ),
        F.col(time_col).alias("_ingest_ts"),
        F.col(load_col).cast("string").alias("_batch_id"),
        F.col(load_col).cast("string").alias("_source_file"),
        F.lit(FULL).alias(MODE),
        *[c for c in (*key, *values)],
    )
    return assign_versions(staged)
