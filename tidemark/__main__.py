"""``python -m tidemark --stream system__entity --config FOLDER --landing ROOT --store ROOT``: ingest what is pending and build."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config
from .columns import KEY
from .functions import quality
from .functions.projection import MappingRow, load_release, mapping_rows
from .naming import Stream
from .operators import policies, reconcile
from .operators.registry import check_drift
from .operators.sequencing import sequence_base
from .plans import ingest, silver
from .plans.storage import Store
from .sources import landing, readers


def check_headers(spark: SparkSession, files: Sequence[landing.LandingFile], rows: Sequence[MappingRow], entity: config.Entity) -> list[str]:
    """Files without their tenant's business key, whose rows the build quarantines; an error where the declaration says fail."""
    odd = []
    options = entity["landing.options"] or {}
    for path, header in readers.headers_of(spark, [f.path for f in files], **options).items():
        tenant = next(f.tenant for f in files if f.path == path)
        mine = [r for r in rows if r.tenant == tenant]
        keys = []
        for generic in entity["grain.business_key"]:
            spellings = [r.source_column for r in mine if r.generic_column == generic]
            keys += [next((s for s in spellings if s in header), spellings[0] if spellings else generic)]
        if check_drift(list(header), [r.source_column for r in mine], keys, entity["schema_evolution.new_column"], entity["schema_evolution.missing_business_key"]) == "quarantine":
            odd.append(path)
    return odd


def governed(out: DataFrame, entity: config.Entity) -> DataFrame:
    """The rows by the declared policy for rows that break a rule: marked, dropped, or an error."""
    policy = entity["quality.on_violation"]
    if "_dq_status" not in out.columns:
        return quality.apply_rules(out, quality.rule_violations([KEY, *entity["quality.required"]]), policy)
    if policy == "quarantine":
        return out
    broken = F.when(F.col("_dq_status") == quality.QUARANTINE, F.array(F.lit(quality.QUARANTINE))).otherwise(F.array().cast("array<string>"))
    return quality.apply_rules(out, broken, policy)


def run(spark: SparkSession, stream: Stream, config_folder: str, landing_root: str, store_root: str, build_id: str = "", release: int | None = None) -> dict[str, int]:
    """One stream: pending files to bronze, then its policy's table; row counts of both.

    ``release`` reads the mappings of that release from the store's ``meta`` tables
    instead of the CSV file beside the declaration.
    """
    entity = config.load_entities(Path(config_folder))[stream]
    store, table = Store(spark, store_root), f"bronze/{stream}"
    if release is None:
        rows = config.load_column_mapping(Path(config_folder, f"{stream}.csv"))
    else:
        rows = tuple(mapping_rows(load_release(store.read("meta/column_catalog"), store.read("meta/mapping_release"), release)))
    known, base = set(), 0
    if store.exists(table):
        bronze = store.read(table)
        known = {r[0] for r in bronze.select("_source_file").distinct().collect()}
        base = sequence_base(bronze).first()["base"]
    files = landing.discover(landing_root, landing.list_any(spark, landing_root), entity["landing.layout"], entity["landing.format"])
    todo = landing.pending(files, known)
    odd = check_headers(spark, todo, rows, entity)
    build_id = build_id or datetime.now(UTC).strftime("%Y%m%dT%H%M%S")
    if todo:
        store.append(ingest.ingest(spark, todo, stream.source_system, build_id, base, entity["sequencing.manifest_column"], **(entity["landing.options"] or {})), table)
    bronze = store.read(table)
    grain, kind = entity["grain.business_key"], entity["historisation"]
    if kind == "scd2":
        out = silver.build(bronze, rows, grain, entity["quality.required"], entity["event_time"], mapping_ver=release or 1, build_id=build_id)
    else:
        staged = silver.stage(bronze, rows, grain)
        how = {"current_only": policies.current_only, "insert_only": policies.insert_only, "append": policies.append_only, "snapshot": lambda s: policies.snapshot(s, "_ingest_ts")}
        out = how[kind](staged)
    out = governed(out, entity)
    whole = kind == "scd2" and entity["quality.on_violation"] == "quarantine"  # dropped versions leave gaps
    path = store.publish(out, f"silver_{stream}", cluster_by=["tenant_id", KEY], gate=reconcile.invariants if whole else None)
    return {"files": len(todo), "without_key": len(odd), "bronze": bronze.count(), "silver": spark.read.parquet(path).agg(F.count("*")).first()[0]}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tidemark")
    for name in ("stream", "config", "landing", "store"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--release", type=int)
    a = p.parse_args(argv)
    stream = Stream(a.stream)
    spark = SparkSession.builder.appName(f"tidemark {stream}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    print(run(spark, stream, a.config, a.landing, a.store, release=a.release))


if __name__ == "__main__":
    main()
