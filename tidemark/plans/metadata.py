"""The layers' databases and tables, and the catalog that declarations seed."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..columns import OPEN_END
from ..functions.projection import MappingRow
from ..naming import LAYERS, place

CATALOG_SCHEMA = (
    "tenant string, source_column string, generic_column string, is_promoted boolean, is_business_key boolean, precedence int, "
    "target_type string, parse_format string, recorded_at timestamp_ntz, superseded_at timestamp_ntz"
)
TABLES = {
    "column_catalog": CATALOG_SCHEMA,
    "mapping_release": "mapping_ver int, released_at timestamp_ntz, description string, is_current boolean",
    "schema_registry": "tenant_id string, schema_ver string, columns array<string>, column_count int, first_seen timestamp_ntz, last_seen timestamp_ntz, first_file string",
    "tenant_state": "tenant_id string, last_ingest_seq bigint, last_built_seq bigint, last_ingest_ts timestamp_ntz, last_build_id string",
    "run_log": "run_id string, stream string, step string, rows_in bigint, rows_out bigint, started_at timestamp_ntz, ended_at timestamp_ntz",
}


def create_layers(spark: SparkSession, suffix: str = "") -> None:
    """Databases of all layers and the empty metadata tables; what exists stays."""
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {place(layer, suffix=suffix)}")
    for table, schema in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {place('meta', table, suffix=suffix)} ({schema}) USING parquet")


def drop_layers(spark: SparkSession, suffix: str) -> None:
    """Remove a developer's databases; the shared ones have no suffix and are refused."""
    if place("meta", suffix=suffix) == "meta":
        raise ValueError("only databases with a suffix may be dropped")
    for layer in LAYERS:
        spark.sql(f"DROP DATABASE IF EXISTS {place(layer, suffix=suffix)} CASCADE")


def catalog_rows(spark: SparkSession, rows: Iterable[MappingRow], recorded_at: datetime, superseded: dict[tuple[str, str], datetime] | None = None) -> DataFrame:
    """Mapping rows as catalog rows in force from ``recorded_at``; ``superseded`` closes some by (tenant, source column)."""
    end = datetime.fromisoformat(OPEN_END)
    data = [(r.tenant, r.source_column, r.generic_column, r.is_promoted, r.is_business_key, r.precedence, r.target_type, r.parse_format, recorded_at, (superseded or {}).get((r.tenant, r.source_column), end)) for r in rows]
    return spark.createDataFrame(data, CATALOG_SCHEMA)


def release_rows(spark: SparkSession, releases: Sequence[tuple[int, datetime, str]]) -> DataFrame:
    """Releases by number; the highest is current."""
    top = max((v for v, _, _ in releases), default=None)
    return spark.createDataFrame([(v, at, text, v == top) for v, at, text in releases], TABLES["mapping_release"])


def next_release(catalog: DataFrame, rows: Iterable[MappingRow], at: datetime) -> DataFrame:
    """The catalog after a new set of declarations: what changed or went is closed at ``at``, what is new opens there."""
    spark = catalog.sparkSession
    keys = [c for c in catalog.columns if c not in ("recorded_at", "superseded_at")]
    fresh = catalog_rows(spark, rows, at)
    end = F.lit(datetime.fromisoformat(OPEN_END)).cast("timestamp_ntz")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in keys]
    live, closed = catalog.where(F.col("superseded_at") == end), catalog.where(F.col("superseded_at") != end)
    kept = live.alias("a").join(fresh.alias("b"), same, "left_semi")
    gone = live.alias("a").join(fresh.alias("b"), same, "left_anti").withColumn("superseded_at", F.lit(at).cast("timestamp_ntz"))
    new = fresh.alias("b").join(live.alias("a"), same, "left_anti")
    return closed.unionByName(kept).unionByName(gone).unionByName(new)
