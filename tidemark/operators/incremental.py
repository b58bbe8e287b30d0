"""Type 2 kept up by slices of new rows instead of a rebuild."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..columns import DELETED, HASH, KEY, SEQ, TENANT
from .scd2 import collapse, events, number_versions


def incremental_deletes(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Current entities that a full delivery does not hold."""
    return current.join(batch.select(TENANT, KEY).distinct(), [TENANT, KEY], "left_anti")


def merge_slice(versions: DataFrame, staged: DataFrame, from_seq: int) -> DataFrame:
    """``versions`` of all rows up to ``from_seq``, brought up to all of ``staged``.

    ``from_seq`` must be a file border.  Two rows per entity come from the past: its last
    delivered row, which decides what it is absent from and what a deletion carries, and
    its last version, which new rows are compared with.  Only entities' last versions can
    change (their end and flag); everything older is passed on as it is.
    """
    columns = staged.columns
    old = staged.where(F.col(SEQ) <= from_seq)
    last_row = old.withColumn("_n", F.row_number().over(Window.partitionBy(TENANT, KEY).orderBy(F.desc(SEQ)))).where("_n = 1").drop("_n")
    # the seeds of full files before the slice are not absent again: only new files count
    fresh = events(last_row.withColumn("_load_mode", F.lit("seed")).unionByName(staged.where(F.col(SEQ) > from_seq))).where(F.col(SEQ) > from_seq)
    w = Window.partitionBy(TENANT, KEY)
    last = versions.withColumn("_last", F.max("version_no").over(w)).where("version_no = _last").drop("_last")
    seed = last.select(*columns, F.col("version_no").alias("_base"), F.col("valid_from").alias("_from"))
    rows = fresh.withColumn("_base", F.lit(None).cast("int")).withColumn("_from", F.lit(None).cast(seed.schema["_from"].dataType))
    chain = number_versions(collapse(seed.unionByName(rows)))
    base = F.max("_base").over(w)
    chain = chain.withColumn("_b", F.coalesce(base, F.lit(0))).withColumn("_seeded", F.col("_b") > 0)
    number = F.when(F.col("_seeded"), F.col("_b") + F.col("version_no") - 1).otherwise(F.col("version_no")).cast("int")
    reason = F.when(F.col(HASH) == DELETED, "deleted").when(number == 1, "new").otherwise("changed")
    chain = chain.withColumn("version_no", number).withColumn("valid_from", F.coalesce("_from", "valid_from")).withColumn("_change_reason", reason).drop("_base", "_from", "_b", "_seeded")

    return versions.withColumn("_last", F.max("version_no").over(w)).where("version_no < _last").drop("_last").unionByName(chain.select(*versions.columns))
