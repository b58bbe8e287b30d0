"""Files to versions: generator, readers, numbering, mapping, history, rebuild."""

import os
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import gold, reconcile, registry
from tidemark.plans import ingest, silver
from tidemark.plans.storage import Store
from tidemark.sources import generator, landing, readers


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing"))
    generator.write_deliveries(root)
    files = landing.discover(root, landing.list_folder(root), "<tenant>/<load_mode>")
    store = Store(spark, str(tmp_path_factory.mktemp("store")))
    store.append(ingest.ingest(spark, files, "erp", "b1"), "bronze")
    return store.read("bronze")


def test_generator_invariants(spark, bronze):
    assert bronze.agg(F.min("_ingest_seq"), F.max("_ingest_seq"), F.countDistinct("_ingest_seq")).first() == (1, bronze.count(), bronze.count())
    v = silver.build(bronze, generator.mapping(), ["object_id"], required=("level",), event_time=None)
    n, k = len(generator.TENANTS), generator.VANISHED
    assert v.where("_change_reason = 'deleted'").count() == n * k
    assert gold.current(v).count() == n * (generator.OBJECTS - k)
    assert reconcile.invariants(v).count() == 0 and reconcile.repeated_hashes(v).count() == 0
    deltas = bronze.where("_load_mode = 'delta'").count()
    assert v.where("_load_mode = 'delta'").count() < deltas


def test_registry_sees_the_new_column(spark, bronze):
    diffs = registry.differences(registry.fold(ingest.headers(bronze))).where("tenant_id = 'T1'").collect()
    assert any("EXTRA" in r.added for r in diffs)


def test_rebuilds(spark, bronze):
    rows = generator.mapping()
    a = silver.build(bronze, rows, ["object_id"], build_id="a")
    assert silver.compare_builds(a, silver.build(bronze, rows, ["object_id"], build_id="b")).first() == (0, 0)
    old = silver.build(bronze, [r for r in rows if r.generic_column != "title"], ["object_id"], mapping_ver=1)
    assert old.count() == a.count() and "title" not in old.columns
    one = silver.build(bronze, rows, ["object_id"], tenant="T2").select("entity_key", "version_no", "modified_ts", "title")
    assert one.exceptAll(a.where("tenant_id = 'T2'").select(*one.columns)).count() == 0


def test_wide_view(spark, bronze):
    v = silver.build(bronze, generator.mapping(), ["object_id"])
    wide = gold.tenant_wide(v, "T2", generator.mapping(), ["entity_key", "version_no"])
    assert wide.columns == ["entity_key", "version_no", "budget", "effort", "risk"]


def test_store_swaps_states(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    first = store.publish(spark.range(10).withColumn("k", F.col("id") % 3), "things", cluster_by=["k", "id"])
    store.publish(spark.table("things").where("id < 5"), "things")
    assert spark.table("things").count() == 5
    store.point("things", first)
    assert spark.table("things").count() == 10


def _file(tmp_path, name, text, mode="delta"):
    path = tmp_path / "T" / mode / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return landing.LandingFile(str(path), "T", mode, datetime(2026, 1, 1, tzinfo=UTC))


def test_malformed_rows(spark, tmp_path):
    bad = "a,b\n1,2\n3\n4,5,6\n"
    got = readers.read_delivery(spark, [_file(tmp_path, "d.csv", bad).path], ["a", "b"], "delta")
    assert [r[readers.CORRUPT] is not None for r in got.collect()] == [False, True, True]
    with pytest.raises(Exception):  # noqa: B017
        readers.read_delivery(spark, [_file(tmp_path, "f.csv", bad, "full").path], ["a", "b"], "full").collect()


def test_empty_cells_are_absent_from_the_payload(spark, tmp_path):
    f = _file(tmp_path, "e.csv", 'a,b\n1,\n2,""\n')
    rows = readers.bronze_rows(spark, [f], "s", "b").selectExpr("to_json(payload) j").collect()
    assert sorted(r.j for r in rows) == ['{"a":"1"}', '{"a":"2"}']


@pytest.mark.parametrize("name", ["a b.csv", "50%20.csv", "x#1.csv", "größe é.csv", "[1]{2}.csv", "q?*.csv"])
def test_rows_of_files_with_odd_names(spark, tmp_path, name):
    files = [_file(tmp_path, name, "a,b\n1,2\n3,4\n"), _file(tmp_path, "plain.csv", "a,b\n5,6\n")]
    rows = readers.bronze_rows(spark, files, "s", "b").collect()
    assert sorted((r._source_file, r.tenant_id) for r in rows) == sorted([(files[0].path, "T")] * 2 + [(files[1].path, "T")])


def test_rows_of_an_unlisted_file_are_an_error(spark, tmp_path, monkeypatch):
    f = _file(tmp_path, "e.csv", "a\n1\n")
    monkeypatch.setattr(readers, "file_uri", lambda spark, path: "file:/elsewhere.csv")
    with pytest.raises(Exception, match="unlisted file"):
        readers.bronze_rows(spark, [f], "s", "b").collect()


def test_published_states_are_found_again_and_gated(spark, tmp_path):
    store = Store(spark, str(tmp_path / "a store"))
    first = store.publish(spark.range(3), "numbers")
    second = store.publish(spark.range(5), "numbers")
    assert Store(spark, str(tmp_path / "a store")).current("numbers") == second
    store.point("numbers", first)
    assert store.current("numbers") == first and spark.table("numbers").count() == 3
    with pytest.raises(ValueError, match="2 rows break"):
        store.publish(spark.range(7), "numbers", gate=lambda df: df.where("id > 4"))
    assert store.current("numbers") == first
    with pytest.raises(LookupError):
        store.current("nothing")


def test_headers_differ_by_file(spark, tmp_path):
    a, b = _file(tmp_path, "1.csv", "x,y\n1,2\n"), _file(tmp_path, "2.csv", "y,x\n2,1\n")
    rows = readers.bronze_rows(spark, [a, b], "s", "b").collect()
    assert len({r._row_hash for r in rows}) == 1 and len({r._schema_ver for r in rows}) == 1


def test_listing_and_checksums(spark, tmp_path):
    f = _file(tmp_path, "c.csv", "a\n1\n")
    listed = landing.list_with_spark(spark, str(tmp_path), "*.csv")
    assert listed.count() == 1 and landing.with_checksum(spark, [f.path]).first().checksum
    assert [e.path for e in landing.list_folder(str(tmp_path))] == [os.path.join(f.path)]


def test_catalog_releases(spark):
    from tidemark.functions.projection import MappingRow, Projection, load_release, mapping_rows
    from tidemark.plans import metadata

    day = [datetime(2026, 1, d) for d in range(1, 5)]
    first = [MappingRow("T", "A", "a", is_business_key=True), MappingRow("T", "B", "b")]
    later = [first[0], MappingRow("T", "B", "bb"), MappingRow("T", "C", "c")]
    catalog = metadata.next_release(metadata.catalog_rows(spark, first, day[0]), later, day[2])
    releases = metadata.release_rows(spark, [(1, day[1], "one"), (2, day[3], "two")])
    assert [r.mapping_ver for r in releases.where("is_current").collect()] == [2]
    plans = [Projection(mapping_rows(load_release(catalog, releases, v))).names() for v in (1, 2)]
    assert plans == [["a", "b"], ["a", "bb", "c"]]
    assert catalog.count() == 4


def test_layers(spark):
    from tidemark.plans import metadata

    metadata.create_layers(spark, "t1")
    metadata.create_layers(spark, "t1")
    assert spark.table("meta_t1.column_catalog").count() == 0
    metadata.drop_layers(spark, "t1")
    with pytest.raises(ValueError):
        metadata.drop_layers(spark, " ")


def declared(tmp_path, **changes):
    import csv

    import yaml

    from tidemark.config import MAPPING_HEADER

    entity = {
        "source_system": "erp", "entity": "thing", "landing": {"volume": "v", "path": "p", "layout": "<tenant>/<load_mode>", "format": "csv"},
        "grain": {"business_key": ["object_id"], "tenant_column": "tenant_id"}, "historisation": "scd2", "sequencing": {"source": "file_mtime"},
        "schema_evolution": {"new_column": "accept", "missing_business_key": "fail"}, "quality": {"required": ["level"], "on_violation": "quarantine"},
    } | changes
    (tmp_path / "c").mkdir(exist_ok=True)
    (tmp_path / "c/erp__thing.yml").write_text(yaml.safe_dump(entity))
    with (tmp_path / "c/erp__thing.csv").open("w", newline="") as f:
        out = csv.writer(f)
        out.writerow(MAPPING_HEADER)
        out.writerows((r.tenant, r.source_column, r.generic_column or "", r.target_type, r.parse_format or "", r.precedence, str(r.is_business_key).lower(), str(r.is_promoted).lower()) for r in generator.mapping())


def ran(spark, tmp_path, **options):
    from tidemark.__main__ import run
    from tidemark.naming import Stream

    return run(spark, Stream("erp__thing"), str(tmp_path / "c"), str(tmp_path / "in"), str(tmp_path / "s"), **options)


def test_command_line_run(spark, tmp_path):
    declared(tmp_path)
    generator.write_deliveries(str(tmp_path / "in"))
    one = ran(spark, tmp_path)
    two = ran(spark, tmp_path)
    assert one["files"] == 9 and two == {**one, "files": 0} and one["silver"] >= 180
    assert spark.read.parquet(Store(spark, str(tmp_path / "s")).current("silver_erp__thing")).count() == one["silver"]


def test_command_line_obeys_declarations(spark, tmp_path):
    generator.write_deliveries(str(tmp_path / "in"))
    declared(tmp_path, schema_evolution={"new_column": "fail", "missing_business_key": "fail"})
    with pytest.raises(ValueError, match="EXTRA"):
        ran(spark, tmp_path)
    assert not (tmp_path / "s/bronze").exists()
    status = {"required": ["status"], "on_violation": "quarantine"}
    declared(tmp_path, quality=status, event_time="modified_ts")
    marked = ran(spark, tmp_path)
    table = spark.read.parquet(Store(spark, str(tmp_path / "s")).current("silver_erp__thing"))
    bad = table.where("_dq_status = 'quarantine'").count()
    assert bad == 0 or marked["silver"] > bad
    assert table.where("_change_reason <> 'deleted' AND valid_from <> modified_ts").count() == 0
    path = tmp_path / "in/T1/delta/keyless.csv"
    path.write_text("OTHER\nx\n")
    with pytest.raises(ValueError, match="business key"):
        ran(spark, tmp_path)
    declared(tmp_path, schema_evolution={"new_column": "accept", "missing_business_key": "quarantine"}, quality={**status, "on_violation": "drop"})
    dropped = ran(spark, tmp_path)
    assert (dropped["files"], dropped["without_key"], dropped["silver"]) == (1, 1, marked["silver"] - bad)
    declared(tmp_path, quality={**status, "on_violation": "fail"})
    with pytest.raises(Exception, match="rule violated"):
        ran(spark, tmp_path)
    declared(tmp_path, historisation="current_only", quality={**status, "on_violation": "drop"})
    assert 0 < ran(spark, tmp_path)["silver"] < dropped["silver"]


def test_command_line_manifest_and_release(spark, tmp_path):
    from tidemark.plans import metadata

    for n, name in ((2, "first.csv"), (1, "second.csv")):  # the manifest's order is not the files'
        path = tmp_path / f"in/T3/full/{name}"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(f"key,tier,delivery\nk1,L{n},{n}\n")
        os.utime(path, (1_700_000_000 - n, 1_700_000_000 - n))
    declared(tmp_path, sequencing={"source": "manifest", "manifest_column": "delivery"})
    store = Store(spark, str(tmp_path / "s"))
    store.append(metadata.catalog_rows(spark, generator.mapping(), datetime(2026, 1, 1)), "meta/column_catalog")
    store.append(metadata.release_rows(spark, [(1, datetime(2025, 1, 1), "none yet"), (2, datetime(2026, 2, 1), "two")]), "meta/mapping_release")
    assert ran(spark, tmp_path, release=2)["silver"] == 2
    rows = spark.read.parquet(store.current("silver_erp__thing")).orderBy("version_no").collect()
    assert [(r.level, r._ingest_seq // 10**9, r._mapping_ver) for r in rows] == [("L1", 1, 2), ("L2", 2, 2)]
    with pytest.raises(ValueError):
        ran(spark, tmp_path, release=1)
