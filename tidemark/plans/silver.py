"""From bronze and a mapping release to versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..columns import KEY
from ..functions.projection import MappingRow, Projection
from ..functions.quality import cast_failures, row_status
from ..operators.reconcile import differences
from ..operators.scd2 import assign_versions

#: What every build stamps anew, so no comparison of builds looks at it.
VOLATILE = ("_build_id", "_committed_at")
_META = ("tenant_id", "payload", "_row_hash", "_ingest_seq", "_ingest_ts", "_batch_id", "_load_mode", "_source_file", "_schema_ver", "_corrupt_record")


def stage(bronze: DataFrame, rows: Sequence[MappingRow], grain: Sequence[str], tenant: str | None = None) -> DataFrame:
    """Bronze columns, typed generic columns and ``entity_key``; with ``tenant``, its rows by its own arm alone."""
    if tenant is not None:
        bronze = bronze.where(F.col("tenant_id") == tenant)
    return bronze.select(*[c for c in _META if c in bronze.columns], *Projection(rows, tenant).columns(grain))


def build(bronze: DataFrame, rows: Sequence[MappingRow], grain: Sequence[str], required: Sequence[str] = (), event_time: str | None = None, mapping_ver: int = 1, key_ver: int = 1, build_id: str = "", tenant: str | None = None) -> DataFrame:
    """The silver table of a mapping release: versions with cast failures, status and stamps.

    Quality is judged after versioning, so a deletion repeats what its carried row failed.
    """
    versions = assign_versions(stage(bronze, rows, grain, tenant), event_time)
    checks = Projection(rows, tenant).failures_of()
    failures = cast_failures(checks) if checks else F.array().cast("array<string>")
    out = versions.withColumn("_cast_failures", failures)
    corrupt = F.col("_corrupt_record") if "_corrupt_record" in out.columns else F.lit(None).cast("string")
    out = out.withColumn("_dq_status", row_status(corrupt, [F.col(c) for c in (KEY, *required)], F.col("_cast_failures")))
    stamps = {"_mapping_ver": F.lit(mapping_ver), "_key_ver": F.lit(key_ver), "_build_id": F.lit(build_id), "_committed_at": F.current_timestamp()}
    return out.withColumns(stamps)


def compare_builds(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one build has, without the stamps."""
    return differences(a, b, VOLATILE)
