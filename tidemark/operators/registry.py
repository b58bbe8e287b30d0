"""Headers seen per tenant, and how they differ from one to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .upsert import GREATEST, KEEP, LEAST, upsert


def fold(headers: DataFrame) -> DataFrame:
    """One row per (tenant_id, schema_ver) of ``headers(tenant_id, schema_ver, columns, seen, file)``."""
    first = F.min(F.struct("seen", "file", "columns"))
    grouped = headers.groupBy("tenant_id", "schema_ver").agg(first.alias("f"), F.max("seen").alias("last_seen"))
    return grouped.select("tenant_id", "schema_ver", F.col("f.columns").alias("columns"), F.size("f.columns").alias("column_count"), F.col("f.seen").alias("first_seen"), "last_seen", F.col("f.file").alias("first_file"))


def merge(registry: DataFrame, folded: DataFrame) -> DataFrame:
    """A known header only moves its last sight; a new one is added."""
    policies = {"columns": KEEP, "column_count": KEEP, "first_seen": LEAST, "last_seen": GREATEST, "first_file": KEEP}
    return upsert(registry, folded, ["tenant_id", "schema_ver"], policies)


def differences(registry: DataFrame) -> DataFrame:
    """Columns that came and went between consecutive headers of a tenant, in order of first sight."""
    w = Window.partitionBy("tenant_id").orderBy("first_seen", "schema_ver")
    rows = registry.withColumn("n", F.row_number().over(w)).withColumn("before", F.lag("columns").over(w)).where("before IS NOT NULL")
    return rows.select("tenant_id", "n", "schema_ver", F.array_sort(F.array_except("columns", "before")).alias("added"), F.array_sort(F.array_except("before", "columns")).alias("removed"))


def check_drift(header: list[str], known: list[str], key_columns: list[str], new_column: str = "accept", missing_key: str = "fail") -> str:
    """accept or quarantine; raises where the declared policy says fail."""
    if missing := sorted(set(key_columns) - set(header)):
        if missing_key == "fail":
            raise ValueError(f"business key not delivered: {missing}")
        return "quarantine"
    if new_column == "fail" and (new := sorted(set(header) - set(known))):
        raise ValueError(f"new columns: {new}")
    return "accept"
