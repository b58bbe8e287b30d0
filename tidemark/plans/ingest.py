"""From landed files to the bronze table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.projection import field
from ..operators.sequencing import file_row_num, ingest_seq, manifest_seq
from ..sources.landing import LandingFile
from ..sources.readers import bronze_rows


def ingest(spark: SparkSession, files: Sequence[LandingFile], source_system: str, batch_id: str, base: int = 0, manifest_column: str | None = None, **options) -> DataFrame:
    """Bronze rows of some files, numbered after ``base`` in delivery order.

    The ingest time is the file's time.  Rows of a file are ordered by fingerprint, then
    by raw text, which does not depend on how the file is read.  With ``manifest_column``
    the delivery's number comes from that field of its rows instead of the file's time.
    """
    rows = bronze_rows(spark, files, source_system, batch_id, **options)
    rows = rows.withColumn("_ingest_ts", F.col("_file_modified"))
    if manifest_column:
        numbered = file_row_num(rows, "_source_file", ["_row_hash", "_raw"], F.substring("_row_hash", 1, 2))
        delivery = field(manifest_column).try_cast("long")
        return numbered.withColumn("_ingest_seq", manifest_seq(delivery, F.col("_file_row_num"))).drop("_raw", "_file_order")
    return ingest_seq(rows, "_source_file", ["_file_order"], ["_row_hash", "_raw"], base, coarse=F.substring("_row_hash", 1, 2)).drop("_raw", "_file_order")


def headers(bronze: DataFrame) -> DataFrame:
    """``tenant_id, schema_ver, columns, seen, file`` of each file, columns from the payloads.

    A column that is null in all of a file's rows is not among its payload's keys.
    """
    keys = bronze.select("tenant_id", "_schema_ver", "_source_file", "_file_modified", F.explode(F.expr("json_object_keys(to_json(payload))")).alias("c"))
    grouped = keys.groupBy("tenant_id", "_schema_ver", "_source_file", "_file_modified").agg(F.array_sort(F.collect_set("c")).alias("columns"))
    return grouped.select("tenant_id", F.col("_schema_ver").alias("schema_ver"), "columns", F.col("_file_modified").alias("seen"), F.col("_source_file").alias("file"))
