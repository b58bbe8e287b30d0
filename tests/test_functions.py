"""Hashing, mapping, quality, declarations, names and landing."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import fingerprint, quality
from tidemark.functions.projection import MappingRow, Projection, field
from tidemark.naming import Stream, place
from tidemark.operators import registry, sequencing, upsert
from tidemark.sources import landing


@pytest.mark.parametrize("token", ["", "null", " N/A ", "na", "-", "#n/a", "(Null)", "none", None])
def test_null_tokens(spark, token):
    assert spark.createDataFrame([(token,)], "c string").select(fingerprint.cleaned(F.col("c")).alias("v")).first().v is None


def test_norm_keeps_case_and_tabs(spark):
    got = spark.createDataFrame([(" Ab ",), ("\tx",)], "c string").select(fingerprint.cleaned(F.col("c")).alias("v")).collect()
    assert [r.v for r in got] == ["Ab", "\tx"]


def test_hash_ignores_column_order_and_tells_null_from_text(spark):
    rows = spark.createDataFrame([(None, "x"), ("\\x00", "x"), ("N/A", "x")], "a string, `b``c` string")
    one, other = (rows.select(fingerprint.of_row(names).alias("h")).collect() for names in (["a", "b`c"], ["b`c", "a"]))
    assert one == other and one[0].h == one[2].h != one[1].h
    with pytest.raises(ValueError):
        fingerprint.canonical([])
    assert fingerprint.of_header(["b", "a"]) == fingerprint.of_header(["a", "b"])


ROWS = [
    MappingRow("T1", "K_NO", "key_id", precedence=1, is_business_key=True),
    MappingRow("T1", "K_NUMBER", "key_id", precedence=2, is_business_key=True),
    MappingRow("T2", "ID", "key_id", is_business_key=True),
    MappingRow("T1", "CHANGED_ON", "modified_ts", "TIMESTAMP", "dd.MM.yyyy"),
    MappingRow("T2", "CHANGED_ON", "modified_ts", "TIMESTAMP", "yyyy-MM-dd"),
]


def test_select_plan(spark):
    data = [("T1", '{"K_NO":"D1","CHANGED_ON":"31.12.2025"}'), ("T1", '{"K_NUMBER":"D2"}'), ("T2", '{"ID":"D1","CHANGED_ON":"2025-12-31"}'), ("T1", '{"OTHER":"x"}'), ("T9", '{"ID":"D1"}')]
    b = spark.createDataFrame(data, "tenant_id string, j string").select("tenant_id", F.parse_json("j").alias("payload"))
    columns = Projection(ROWS).columns(["key_id"])
    got = b.select(*columns).collect()
    assert b.select(*columns).columns == ["key_id", "modified_ts", "entity_key"]
    assert [r.key_id for r in got] == ["D1", "D2", "D1", None, None]
    assert got[0].modified_ts == got[2].modified_ts and got[0].entity_key != got[2].entity_key and got[3].entity_key is None
    one = b.where("tenant_id='T2'").select(*Projection(ROWS, "T2").columns(["key_id"]))
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE" not in plan and "CHANGED_ON" in plan and "K_NO" not in plan
    assert one.first() == got[2]
    nobody = b.select(*Projection(ROWS, "T7").columns(["key_id"]))
    assert nobody.dtypes == b.select(*columns).dtypes and not any(r.key_id or r.entity_key for r in nobody.collect())


def test_mapping_errors(spark):
    with pytest.raises(ValueError):
        field("a'b")
    with pytest.raises(ValueError):
        Projection([MappingRow("a", "x", "g", "INT"), MappingRow("b", "x", "g", "STRING")]).kind("g")
    with pytest.raises(ValueError):
        Projection([MappingRow("a", "x", "g", "INT); DROP")]).kind("g")
    assert Projection([MappingRow("a", "x", "g", "decimal(10, 2)")]).kind("g") == "DECIMAL(10, 2)"
    with pytest.raises(ValueError):
        Projection(ROWS).key(["other"])
    with pytest.raises(ValueError):
        Projection([]).text("g")
    quoted = Projection([MappingRow("O'Neil", "A", "g")]).text("g")
    assert spark.createDataFrame([("O'Neil", '{"A":"1"}')], "tenant_id string, j string").select("tenant_id", F.parse_json("j").alias("payload")).select(quoted.alias("v")).first().v == "1"


def test_quality(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, None, "x"), (5, None, None), (5, "bad", "x")], "typed int, corrupt string, need string").withColumn("raw", F.lit("7"))
    failures = quality.cast_failures({"typed": (F.col("typed"), F.col("raw"))})
    got = [r.s for r in df.select(quality.row_status(F.col("corrupt"), [F.col("need")], failures).alias("s")).collect()]
    assert got == ["ok", "warn", "quarantine", "quarantine"]
    rules = quality.rule_violations(["need"], {"need": ["x"]}, {"typed": (2, 4)})
    assert quality.apply_rules(df, rules, "drop").count() == 1
    assert quality.apply_rules(df, rules, "quarantine").where("_dq_status = 'quarantine'").count() == 3
    with pytest.raises(Exception, match="rule violated"):
        quality.apply_rules(df, rules, "fail").collect()


ENTITY = {
    "source_system": "erp",
    "entity": "work_order",
    "landing": {"volume": "in", "path": "wo", "layout": "<tenant>/<load_mode>", "format": "csv"},
    "grain": {"business_key": ["object_id"], "tenant_column": "tenant_id"},
    "historisation": "scd2",
    "sequencing": {"source": "file_mtime"},
    "schema_evolution": {"new_column": "accept", "missing_business_key": "fail"},
    "quality": {"required": ["object_id"], "on_violation": "quarantine"},
}


def test_entity_definition():
    assert config.parse_entity(ENTITY).stream == "erp__work_order" and config.parse_entity(ENTITY)["grain.business_key"] == ("object_id",)


@pytest.mark.parametrize(
    "change",
    [{"extra": 1}, {"historisation": "scd9"}, {"sequencing": {"source": "manifest"}}, {"grain": {"business_key": [], "tenant_column": "t"}}, {"landing": {"volume": "in"}}, {"entity": "Bad Name"}, {"quality": {"required": "x", "on_violation": "drop"}}],
)
def test_bad_entities(change):
    with pytest.raises(config.ConfigError):
        config.parse_entity(ENTITY | change)
    with pytest.raises(config.ConfigError):
        config.parse_entity({k: v for k, v in ENTITY.items() if k != "grain"})


def test_mapping_file(tmp_path):
    head = ",".join(config.MAPPING_HEADER)
    path = tmp_path / "m.csv"
    path.write_text(f"{head}\nT1,A,g,int,,1,true,TRUE\nT1,B,,,,2,false,false\n")
    a, b = config.load_column_mapping(path)
    assert (a.target_type, a.is_business_key, b.generic_column, b.target_type) == ("INT", True, None, "STRING")
    for bad in (f"{head}\n", "x\n1\n", f"{head}\nT1,A,g,,,1,true,true\nT1,A,h,,,1,true,true\n", f"{head}\nT1,A,g,,,x,true,true\n", f"{head}\nT1,A,g,,,1,yes,true\n", f"{head}\nT1,A\n"):
        path.write_text(bad)
        with pytest.raises(config.ConfigError):
            config.load_column_mapping(path)


def test_environment_and_folder(tmp_path):
    assert config.parse_environment({"name": "dev", "catalog": "c", "schema_suffix": "x"}, "dev")["schema_suffix"] == "x"
    with pytest.raises(config.ConfigError):
        config.parse_environment({"name": "dev", "catalog": "c"}, "prod")
    yaml = pytest.importorskip("yaml")
    (tmp_path / "a.yml").write_text(yaml.safe_dump(ENTITY))
    assert list(config.load_entities(tmp_path)) == [Stream("erp__work_order")]
    (tmp_path / "b.yml").write_text(yaml.safe_dump(ENTITY))
    with pytest.raises(config.ConfigError):
        config.load_entities(tmp_path)


def test_names():
    s = Stream("erp__work_order")
    assert (s, s.source_system, s.entity) == ("erp__work_order", "erp", "work_order")
    for bad in ("erp", "a__b__c", "A__b"):
        with pytest.raises(ValueError):
            Stream(bad)
    assert place("silver", s, suffix="_dev", catalog="cat") == "cat.silver_dev.erp__work_order" and place("gold", suffix=" ") == "gold"
    with pytest.raises(ValueError):
        place("iron")
    with pytest.raises(ValueError):
        place("gold", catalog="bad-name")


def at(minute):
    return datetime(2026, 1, 1, 0, minute, tzinfo=UTC)


def test_landing():
    entries = [landing.LandingEntry(f"/in/{p}", at(m)) for p, m in (("b/full/2.csv", 2), ("a/DELTA/1.csv", 1), ("a/full/0.csv", 2), ("a/full/readme.txt", 2))]
    files = landing.discover("/in", entries, "<tenant>/<load_mode>")
    assert [(f.tenant, f.load_mode) for f in files] == [("a", "delta"), ("a", "full"), ("b", "full")]
    assert [f.path for f in landing.pending(files, {files[0].path})] == ["/in/a/full/0.csv", "/in/b/full/2.csv"]
    assert landing.parse_layout("<load_mode>/<tenant>") == ("load_mode", "tenant")
    for bad in ("<tenant>", "<tenant>/<tenant>", "tenant/<load_mode>", "<tenant>/x"):
        with pytest.raises(ValueError):
            landing.parse_layout(bad)
    for path, when in (("/in/a/upsert/1.csv", 5), ("/in/a/1.csv", 5), ("/out/a/full/1.csv", 5), ("/in/a/full/9.csv", 2)):
        with pytest.raises(ValueError):
            landing.discover("/in", [*entries, landing.LandingEntry(path, at(when))], "<tenant>/<load_mode>")


def test_upserts(spark):
    t = spark.createDataFrame([("a", 1, 5, "x"), ("b", 2, 6, "y")], "k string, seq int, built int, note string")
    s = spark.createDataFrame([("b", 1, "z"), ("c", 9, "w")], "k string, seq int, note string")
    got = sorted(map(tuple, upsert.upsert(t, s, ["k"], {"seq": upsert.GREATEST, "note": upsert.KEEP}, {"built": 0}).collect()))
    assert got == [("a", 1, 5, "x"), ("b", 2, 6, "y"), ("c", 9, 0, "w")]
    assert sorted(map(tuple, upsert.update_only(t, s, ["k"]).collect())) == [("a", 1, 5, "x"), ("b", 1, 6, "z")]


def test_drift_policy():
    assert registry.check_drift(["id", "a", "new"], ["id", "a"], ["id"]) == "accept"
    assert registry.check_drift(["a"], ["id", "a"], ["id"], missing_key="quarantine") == "quarantine"
    with pytest.raises(ValueError):
        registry.check_drift(["a"], ["a"], ["id"])
    with pytest.raises(ValueError):
        registry.check_drift(["id", "new"], ["id"], ["id"], new_column="fail")


def test_numbering_is_contiguous_and_never_gathers_rows(spark):
    df = spark.range(1000).select(F.concat(F.lit("f"), (F.col("id") % 7).cast("string")).alias("file"), (F.col("id") % 7).alias("ord"), "id")
    got = sequencing.ingest_seq(df, "file", ["ord"], ["id"], base=10)
    seqs = [r._ingest_seq for r in got.orderBy("ord", "id").collect()]
    assert seqs == list(range(11, 1011))
