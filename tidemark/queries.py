"""The registered queries: one per operator, each with the same result as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import GONE
from .functions import cleaning, quality
from .functions import fingerprint as prints
from .functions.projection import Projection, field, load_release as catalog_at
from .operators import cdc, gold, incremental, policies, reconcile, registry, scd2, sequencing, upsert
from .plans import silver, storage
from .sources import landing
from .stages import (
    CUSTOMER_SQL,
    DELETED_SQL,
    ORDER_COLUMNS,
    ORDER_GRAIN,
    ORDER_MAPPING,
    ORDER_STAGED_SQL,
    ORDERS_SQL,
    STAGED_SQL,
    VERSIONS_SQL,
    customer_rows,
    event_rows,
    moment,
    order_bronze,
    order_rows,
    staged_events,
    table,
    versions_sql,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
STAMP = "'%Y-%m-%d %H:%M:%S'"


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def _versions(spark: SparkSession, sf: str, event_time: str | None = None) -> DataFrame:
    return scd2.assign_versions(staged_events(spark, sf), event_time)


# ---- landing, numbering -------------------------------------------------------------


def _files(spark: SparkSession, sf: str) -> DataFrame:
    rows = event_rows(spark, sf)
    return rows.groupBy("_source_file", "tenant_id", "_load_mode").agg(F.max("_ingest_ts").alias("modified_at"), F.count("*").alias("n_rows")).withColumnRenamed("_source_file", "path").withColumnRenamed("tenant_id", "tenant")


_FILES_SQL = STAGED_SQL + ", files AS (SELECT _source_file AS path, tenant_id AS tenant, _load_mode, max(_ingest_ts) AS modified_at, count(*) AS n_rows FROM staged GROUP BY ALL)"


@query(f"WITH {_FILES_SQL} SELECT path, tenant, _load_mode, row_number() OVER (PARTITION BY tenant ORDER BY modified_at, path)::INTEGER AS place FROM files")
def delivery_order(spark, sf):
    from pyspark.sql import Window

    files = _files(spark, sf)
    return files.select("path", "tenant", "_load_mode", F.row_number().over(Window.partitionBy("tenant").orderBy("modified_at", "path")).alias("place"))


@query(f"WITH {_FILES_SQL} SELECT tenant, count(*) AS n_files FROM (SELECT tenant, date_trunc('week', modified_at) AS w FROM files) GROUP BY tenant, w HAVING count(*) > 1")
def tied_deliveries(spark, sf):
    weekly = _files(spark, sf).withColumn("modified_at", F.date_trunc("week", "modified_at"))
    return landing.tied_deliveries(weekly).select("tenant", "n_files")


@query(f"WITH {_FILES_SQL} SELECT path, n_rows FROM files WHERE path NOT IN (SELECT path FROM files WHERE day(modified_at) <= 20)")
def pending_files(spark, sf):
    files = _files(spark, sf)
    return landing.pending_files(files, files.where(F.dayofmonth("modified_at") <= 20)).select("path", "n_rows")


@query(f"WITH {_FILES_SQL}, sums AS (SELECT path, sha256(path || n_rows) AS checksum FROM files) SELECT path FROM files WHERE NOT EXISTS (SELECT 1 FROM sums s WHERE s.path = files.path AND day(modified_at) <= 20 AND n_rows % 2 = 0)")
def pending_by_checksum(spark, sf):
    files = _files(spark, sf).withColumn("checksum", F.sha2(F.concat("path", F.col("n_rows").cast("string")), 256))
    ledger = files.where(F.dayofmonth("modified_at") <= 20).withColumn("checksum", F.when(F.col("n_rows") % 2 == 0, F.col("checksum")).otherwise("old"))
    return landing.pending_files(files, ledger, ("path", "checksum")).select("path")


@query(f"WITH {STAGED_SQL} SELECT tenant_id, _load_mode, count(*) AS n, sum(event_id) AS ids FROM staged GROUP BY ALL")
def bronze_union(spark, sf):
    rows = event_rows(spark, sf)
    parts = [rows.where(F.col("_load_mode") == m) for m in ("full", "delta")]
    return parts[0].unionByName(parts[1]).groupBy("tenant_id", "_load_mode").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query(f"WITH {STAGED_SQL} SELECT _ingest_seq, event_id, _source_file FROM staged")
def ingest_seq(spark, sf):
    return staged_events(spark, sf).select("_ingest_seq", "event_id", "_source_file")


@query(f"WITH {STAGED_SQL} SELECT event_id, row_number() OVER (PARTITION BY _source_file ORDER BY _row_hash, event_id) AS _file_row_num FROM staged")
def file_row_num(spark, sf):
    return sequencing.file_row_num(event_rows(spark, sf), "_source_file", ["_row_hash", "event_id"]).select("event_id", "_file_row_num")


@query(f"WITH {STAGED_SQL} SELECT coalesce(max(_ingest_seq), 0) AS base FROM staged")
def seq_base(spark, sf):
    return sequencing.sequence_base(staged_events(spark, sf))


@query(f"WITH {STAGED_SQL} SELECT event_id, day(_ingest_ts) * 1000000000 + row_number() OVER (PARTITION BY _source_file ORDER BY event_id) AS seq FROM staged")
def manifest_seq(spark, sf):
    rows = sequencing.file_row_num(event_rows(spark, sf), "_source_file", ["event_id"])
    return rows.select("event_id", sequencing.manifest_seq(F.dayofmonth("_ingest_ts"), F.col("_file_row_num")).alias("seq"))


@query(f"WITH {STAGED_SQL} SELECT _ingest_seq, tenant_id, bucket FROM staged WHERE _ingest_seq > 5000")
def incremental_slice(spark, sf):
    return storage.slice_after(staged_events(spark, sf), 5000).select("_ingest_seq", "tenant_id", "bucket")


@query(f"WITH {STAGED_SQL} SELECT _batch_id, count(*) AS n_rows, max(_ingest_seq) AS last_seq FROM staged GROUP BY _batch_id")
def bronze_append(spark, sf):
    """Two appends to a bronze folder, read back."""
    from uuid import uuid4

    from .workspace import shared_dir

    store = storage.Store(spark, f"{shared_dir(spark)}/bronze-{uuid4().hex}")
    rows = staged_events(spark, sf)
    for half in (F.col("_batch_id") <= "2024-01-15", F.col("_batch_id") > "2024-01-15"):
        store.append(rows.where(half), "events")
    return store.read("events").groupBy("_batch_id").agg(F.count("*").alias("n_rows"), F.max("_ingest_seq").alias("last_seq"))


# ---- fingerprints -------------------------------------------------------------------


@query(f"WITH {CUSTOMER_SQL} SELECT c_custkey, n_name, n_segment FROM normed")
def norm_tokens(spark, sf):
    return customer_rows(spark, sf).select("c_custkey", prints.cleaned(F.col("c_name")).alias("n_name"), prints.cleaned(F.col("c_mktsegment")).alias("n_segment"))


_CANON = "to_json({'c_mktsegment': coalesce(n_segment, chr(0)), 'c_name': coalesce(n_name, chr(0))})::VARCHAR"


@query(f"WITH {CUSTOMER_SQL} SELECT c_custkey, {_CANON} AS canon FROM normed")
def canon_json(spark, sf):
    return customer_rows(spark, sf).select("c_custkey", prints.canonical(["c_name", "c_mktsegment"]).alias("canon"))


@query(f"WITH {CUSTOMER_SQL} SELECT c_custkey, sha256({_CANON}) AS row_hash FROM normed")
def row_hash(spark, sf):
    return customer_rows(spark, sf).select("c_custkey", prints.of_row(["c_name", "c_mktsegment"]).alias("row_hash"))


@query("SELECT sha256('c_acctbal|c_custkey|c_mktsegment|c_name|c_nationkey') AS schema_ver, count(*) AS n FROM customer")
def schema_ver(spark, sf):
    c = table(spark, sf, "customer")
    return c.agg(F.count("*").alias("n")).select(F.lit(prints.of_header(c.columns)).alias("schema_ver"), "n")


# ---- payloads and mappings ----------------------------------------------------------


@query(f"WITH {ORDERS_SQL} SELECT o_orderkey, CASE WHEN tenant_id = 'P' THEN 3 ELSE 4 + (tenant_id = 'F')::INTEGER END AS n_keys, object_id FROM typed")
def payload_build(spark, sf):
    rows = order_rows(spark, sf)
    built = rows.select("o_orderkey", F.parse_json(F.to_json(F.struct(*ORDER_COLUMNS, F.col("amount_p").alias("amount")))).alias("payload"))
    keys = F.size(F.expr("json_object_keys(to_json(payload))"))
    return built.select("o_orderkey", keys.alias("n_keys"), F.coalesce(*[field(c) for c in ("K_NO", "K_NUMBER", "ID", "key")]).alias("object_id"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def payload_extract(spark, sf):
    rows = table(spark, sf, "events").select("event_id", F.parse_json("props").alias("payload"))
    return rows.select("event_id", field("k").alias("k"))


@query("SELECT event_id, user_id FROM events WHERE try_cast(json_extract_string(props, '$.k') AS INTEGER) > 50")
def payload_filter(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", F.parse_json("props").alias("payload"))
    return rows.where("try_variant_get(payload, '$.k', 'INT') > 50").select("event_id", "user_id")


@query(f"WITH {ORDERS_SQL} SELECT o_orderkey, object_id, raw_amount, priority FROM typed")
def map_raw(spark, sf):
    b = order_bronze(spark, sf)
    return b.select("o_orderkey", *[Projection(ORDER_MAPPING).text(g).alias(n) for g, n in (("object_id", "object_id"), ("amount", "raw_amount"), ("priority", "priority"))])


@query(f"WITH {ORDERS_SQL} SELECT o_orderkey, strftime(modified_ts, {STAMP}) AS modified_ts FROM typed")
def map_timestamp(spark, sf):
    return order_bronze(spark, sf).select("o_orderkey", moment(Projection(ORDER_MAPPING).value("modified_ts")).alias("modified_ts"))


@query(f"WITH {ORDERS_SQL} SELECT o_orderkey, amount FROM typed")
def map_cast(spark, sf):
    return order_bronze(spark, sf).select("o_orderkey", Projection(ORDER_MAPPING).value("amount").alias("amount"))


@query(f"WITH {ORDERS_SQL} SELECT o_orderkey, entity_key FROM typed")
def entity_key(spark, sf):
    return order_bronze(spark, sf).select("o_orderkey", Projection(ORDER_MAPPING).key(ORDER_GRAIN).alias("entity_key"))


@query(f"WITH {ORDERS_SQL} SELECT o_orderkey, amount, strftime(modified_ts, {STAMP}) AS modified_ts, object_id, priority, entity_key FROM typed")
def map_select(spark, sf):
    rows = order_bronze(spark, sf).select("o_orderkey", *Projection(ORDER_MAPPING).columns(ORDER_GRAIN))
    return rows.withColumn("modified_ts", moment("modified_ts"))


@query(f"WITH {ORDERS_SQL} SELECT o_orderkey, amount, entity_key FROM typed WHERE tenant_id = 'O'")
def map_select_one_tenant(spark, sf):
    return order_bronze(spark, sf).where("tenant_id = 'O'").select("o_orderkey", *Projection(ORDER_MAPPING, "O").columns(ORDER_GRAIN)).select("o_orderkey", "amount", "entity_key")


_CATALOG = [
    ("F", "K_NO", "object_id", True, 1, "2024-01-01", "9999-12-31"),
    ("F", "CENTS", "amount", True, 1, "2024-01-01", "2024-03-01"),
    ("F", "CENTS", "price", True, 1, "2024-03-01", "9999-12-31"),
    ("O", "ID", "object_id", True, 1, "2024-02-01", "9999-12-31"),
    ("O", "NOTE", None, False, 1, "2024-02-01", "9999-12-31"),
    ("P", "REMARK", None, False, 1, "2024-02-01", "2024-02-15"),
]
_RELEASES = [(1, "2024-01-15"), (2, "2024-02-10"), (3, "2024-04-01")]


def _catalog(spark):
    rows = spark.createDataFrame(_CATALOG, "tenant string, source_column string, generic_column string, is_promoted boolean, precedence int, recorded_at string, superseded_at string")
    return rows.withColumns({c: F.to_timestamp_ntz(c, F.lit("yyyy-MM-dd")) for c in ("recorded_at", "superseded_at")})


def _releases(spark):
    return spark.createDataFrame(_RELEASES, "mapping_ver int, released_at string").withColumn("released_at", F.to_timestamp_ntz("released_at", F.lit("yyyy-MM-dd")))


_null = lambda v: "NULL" if v is None else f"'{v}'"
_CATALOG_SQL = "catalog(tenant, source_column, generic_column, is_promoted, precedence, recorded_at, superseded_at) AS (VALUES " + ", ".join(f"('{t}', '{s}', {_null(g)}, {p}, {n}, TIMESTAMP '{a}', TIMESTAMP '{b}')" for t, s, g, p, n, a, b in _CATALOG) + ")"
_RELEASES_SQL = "releases(mapping_ver, released_at) AS (VALUES " + ", ".join(f"({v}, TIMESTAMP '{t}')" for v, t in _RELEASES) + ")"


@query(f"WITH {_CATALOG_SQL}, {_RELEASES_SQL} SELECT r.mapping_ver, tenant, source_column, generic_column FROM catalog c JOIN releases r ON c.recorded_at <= r.released_at AND c.superseded_at > r.released_at")
def load_release(spark, sf):
    catalog, releases = _catalog(spark), _releases(spark)
    parts = [catalog_at(catalog, releases, v).select(F.lit(v).alias("mapping_ver"), "tenant", "source_column", "generic_column") for v, _ in _RELEASES]
    return parts[0].union(parts[1]).union(parts[2])


@query(f"WITH {_CATALOG_SQL} SELECT tenant, source_column FROM catalog WHERE NOT is_promoted AND superseded_at > TIMESTAMP '2024-05-01'")
def catalog_unpromoted(spark, sf):
    return _catalog(spark).where(~F.col("is_promoted") & (F.col("superseded_at") > F.expr("TIMESTAMP_NTZ'2024-05-01 00:00:00'"))).select("tenant", "source_column")


@query(f"WITH {STAGED_SQL}, built AS (SELECT tenant_id, max(bucket % 3) AS v FROM staged GROUP BY tenant_id, entity_key), m AS (SELECT max(v) AS v FROM built) SELECT tenant_id, count(*) AS n_stale FROM built WHERE v < (SELECT v FROM m) GROUP BY tenant_id")
def stale_mapping(spark, sf):
    built = staged_events(spark, sf).groupBy("tenant_id", "entity_key").agg(F.max(F.col("bucket") % 3).alias("_mapping_ver"))
    latest = built.agg(F.max("_mapping_ver").alias("v"))
    return built.join(F.broadcast(latest), F.col("_mapping_ver") < F.col("v"), "left_semi").groupBy("tenant_id").agg(F.count("*").alias("n_stale"))


# ---- versions -----------------------------------------------------------------------


@query(f"WITH {DELETED_SQL} SELECT tenant_id, _source_file, lo, hi, strftime(ts, {STAMP}) AS ts, batch FROM files")
def full_file_bounds(spark, sf):
    return scd2.full_file_bounds(staged_events(spark, sf)).withColumn("ts", moment("ts"))


@query(f"WITH {STAGED_SQL} SELECT DISTINCT tenant_id, entity_key, _source_file FROM staged WHERE _load_mode = 'full'")
def present_in_full(spark, sf):
    return staged_events(spark, sf).where("_load_mode = 'full'").select("tenant_id", "entity_key", "_source_file").distinct()


@query(f"WITH {DELETED_SQL} SELECT tenant_id, entity_key, _row_hash, _ingest_seq, _batch_id, _source_file, _load_mode, bucket FROM tomb")
def deletion_events(spark, sf):
    return scd2.deletion_events(staged_events(spark, sf)).select("tenant_id", "entity_key", "_row_hash", "_ingest_seq", "_batch_id", "_source_file", "_load_mode", "bucket")


@query(f"WITH {STAGED_SQL} SELECT event_id, tenant_id FROM (SELECT *, lag(_row_hash) OVER (PARTITION BY tenant_id, entity_key ORDER BY _ingest_seq) AS p FROM staged) WHERE p IS NULL OR p <> _row_hash")
def noop_collapse(spark, sf):
    return scd2.collapse(staged_events(spark, sf)).select("event_id", "tenant_id")


_VERSION_COLUMNS = f"tenant_id, entity_key, version_no, strftime(valid_from, {STAMP}) AS valid_from, strftime(valid_to, {STAMP}) AS valid_to, is_current, _change_reason, bucket, _ingest_seq"


def _shown(versions: DataFrame) -> DataFrame:
    return versions.select("tenant_id", "entity_key", "version_no", moment("valid_from").alias("valid_from"), moment("valid_to").alias("valid_to"), "is_current", "_change_reason", "bucket", "_ingest_seq")


@query(f"WITH {VERSIONS_SQL} SELECT {_VERSION_COLUMNS} FROM versions")
def scd2_versions(spark, sf):
    return _shown(_versions(spark, sf))


@query(f"WITH {versions_sql('coalesce(modified_ts, _ingest_ts)')} SELECT {_VERSION_COLUMNS} FROM versions")
def scd2_event_time(spark, sf):
    return _shown(_versions(spark, sf, "modified_ts"))


_ORDER_VERSIONS_SQL = VERSIONS_SQL.replace(STAGED_SQL, ORDER_STAGED_SQL)


def _silver(spark, sf, **more):
    return silver.build(order_bronze(spark, sf), ORDER_MAPPING, ORDER_GRAIN, required=("priority",), **more)


@query(
    f"""WITH {_ORDER_VERSIONS_SQL} SELECT tenant_id, entity_key, object_id, amount, priority, version_no, strftime(valid_from, {STAMP}) AS valid_from,
    strftime(valid_to, {STAMP}) AS valid_to, is_current, _change_reason, CASE WHEN amount IS NULL THEN 'amount' ELSE '' END AS failures,
    CASE WHEN priority IS NULL THEN 'quarantine' WHEN amount IS NULL THEN 'warn' ELSE 'ok' END AS _dq_status, 7 AS _mapping_ver FROM versions"""
)
def silver_build(spark, sf):
    built = _silver(spark, sf, mapping_ver=7)
    return built.select("tenant_id", "entity_key", "object_id", "amount", "priority", "version_no", moment("valid_from").alias("valid_from"), moment("valid_to").alias("valid_to"), "is_current", "_change_reason", F.array_join("_cast_failures", ",").alias("failures"), "_dq_status", "_mapping_ver")


# ---- other policies -----------------------------------------------------------------


@query(f"WITH {DELETED_SQL}, a AS (SELECT * FROM staged UNION ALL SELECT * FROM tomb), n AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, entity_key ORDER BY _ingest_seq DESC) AS k FROM a) SELECT tenant_id, entity_key, bucket, _ingest_seq FROM n WHERE k = 1 AND _row_hash <> '__deleted__'")
def current_only(spark, sf):
    return policies.current_only(staged_events(spark, sf)).select("tenant_id", "entity_key", "bucket", "_ingest_seq")


@query(f"WITH {DELETED_SQL}, a AS (SELECT * FROM staged UNION ALL SELECT * FROM tomb), n AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, entity_key ORDER BY _ingest_seq DESC) AS k FROM a) SELECT tenant_id, entity_key, _row_hash = '__deleted__' AS is_deleted FROM n WHERE k = 1")
def current_only_soft(spark, sf):
    return policies.current_only(staged_events(spark, sf), soft=True).select("tenant_id", "entity_key", "is_deleted")


@query(f"WITH {STAGED_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, entity_key ORDER BY _ingest_seq) AS k FROM staged) SELECT tenant_id, entity_key, bucket, _ingest_seq FROM n WHERE k = 1")
def insert_only(spark, sf):
    return policies.insert_only(staged_events(spark, sf)).select("tenant_id", "entity_key", "bucket", "_ingest_seq")


@query(f"WITH {STAGED_SQL} SELECT tenant_id, count(*) AS n FROM staged GROUP BY tenant_id")
def append_policy(spark, sf):
    return policies.append_only(staged_events(spark, sf)).groupBy("tenant_id").agg(F.count("*").alias("n"))


@query(f"WITH {STAGED_SQL} SELECT tenant_id, strftime(_ingest_ts, '%Y-%m-%d') AS snapshot_date, count(*) AS n, count(DISTINCT entity_key) AS n_entities FROM staged WHERE _load_mode = 'full' GROUP BY ALL")
def snapshot_policy(spark, sf):
    rows = policies.snapshot(staged_events(spark, sf), "_ingest_ts")
    return rows.groupBy("tenant_id", F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot_date")).agg(F.count("*").alias("n"), F.countDistinct("entity_key").alias("n_entities"))


_META_ROWS = [(1, "a", "x"), (1, "b", "x"), (2, "a", "y"), (2, "b", "x"), (3, "a", "y"), (4, "a", "y"), (4, "b", "x")]
_META_EXPECTED = [("a", "x", 1, 1, 2, False, "new"), ("a", "y", 2, 2, None, True, "changed"), ("b", "x", 1, 1, 3, False, "new"), ("b", "x", 2, 3, 4, False, "deleted"), ("b", "x", 3, 4, None, True, "changed")]


@query(
    "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}', {n}, '2024-01-{a:02d} 00:00:00', '{f'2024-01-{b:02d} 00:00:00' if b else '9999-12-31 00:00:00'}', {c}, '{r}')" for k, v, n, a, b, c, r in _META_EXPECTED) + ") AS t(name, v, version_no, valid_from, valid_to, is_current, _change_reason)"
)
def meta_scd2(spark, sf):
    rows = spark.createDataFrame(_META_ROWS, "load int, name string, v string").withColumn("at", F.to_timestamp_ntz(F.concat(F.lit("2024-01-0"), F.col("load").cast("string")), F.lit("yyyy-MM-dd")))
    rows = sequencing.ingest_seq(rows, "load", ["load"], ["name"])
    versions = policies.declarations_scd2(rows, ["name"], ["v"], "load", "_ingest_seq", "at")
    return versions.select("name", "v", "version_no", moment("valid_from").alias("valid_from"), moment("valid_to").alias("valid_to"), "is_current", "_change_reason")


# ---- quality ------------------------------------------------------------------------


def _checked(spark, sf):
    staged = silver.stage(order_bronze(spark, sf), ORDER_MAPPING, ORDER_GRAIN)
    raw = Projection(ORDER_MAPPING).text("amount")
    return staged.withColumn("_cast_failures", quality.cast_failures({"amount": (F.col("amount"), raw)})).withColumn("raw_amount", raw)


@query(f"WITH {ORDERS_SQL} SELECT tenant_id, object_id, CASE WHEN amount IS NULL AND raw_amount IS NOT NULL THEN 'amount' ELSE '' END AS failures, count(*) AS n FROM typed GROUP BY ALL")
def cast_failures(spark, sf):
    rows = _checked(spark, sf).withColumn("failures", F.array_join("_cast_failures", ","))
    return rows.groupBy("tenant_id", "object_id", "failures").agg(F.count("*").alias("n"))


@query(f"WITH {ORDERS_SQL} SELECT tenant_id, CASE WHEN priority IS NULL THEN 'quarantine' WHEN amount IS NULL THEN 'warn' ELSE 'ok' END AS status, count(*) AS n FROM typed GROUP BY ALL")
def dq_status(spark, sf):
    rows = _checked(spark, sf).withColumn("status", quality.row_status(F.col("_corrupt_record"), [F.col("priority")], F.col("_cast_failures")))
    return rows.groupBy("tenant_id", "status").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '5-LOW') THEN 'domain:o_orderpriority' END, CASE WHEN o_totalprice < 1000 OR o_totalprice > 400000 THEN 'threshold:o_totalprice' END) AS violations FROM orders")
def dq_rules(spark, sf):
    found = quality.rule_violations(["o_orderkey"], {"o_orderpriority": ["1-URGENT", "2-HIGH", "5-LOW"]}, {"o_totalprice": (1000, 400000)})
    rows = quality.apply_rules(table(spark, sf, "orders"), found, "quarantine")
    return rows.select("o_orderkey", F.array_join("_violations", ",").alias("violations"))


@query(f"WITH {ORDERS_SQL} SELECT tenant_id, count(raw_amount) AS populated, count(*) FILTER (WHERE amount IS NULL AND raw_amount IS NOT NULL) AS failures, round(count(*) FILTER (WHERE amount IS NULL AND raw_amount IS NOT NULL) / nullif(count(raw_amount), 0), 6) AS rate FROM typed GROUP BY tenant_id")
def cast_quality(spark, sf):
    rows = _checked(spark, sf).groupBy("tenant_id").agg(F.count("raw_amount").alias("populated"), F.count_if(F.size("_cast_failures") > 0).alias("failures"))
    return rows.withColumn("rate", F.round(F.col("failures") / F.nullif(F.col("populated"), F.lit(0)), 6))


@query(
    """SELECT c_custkey, try_cast(replace(replace(CASE WHEN c_custkey % 5 = 0 THEN 'x' ELSE replace(printf('%.2f', c_acctbal), '.', ',') END, '.', ''), ',', '.') AS DECIMAL(18, 4))::DOUBLE AS balance,
    CASE WHEN c_custkey % 3 = 0 THEN true WHEN c_custkey % 3 = 1 THEN false END AS flag FROM customer"""
)
def cleaned_values(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    text = F.when(k % 5 == 0, "x").otherwise(F.replace(F.format_string("%.2f", "c_acctbal"), F.lit("."), F.lit(",")))
    flag = F.when(k % 3 == 0, "t").when(k % 3 == 1, "No").otherwise(F.lit(None))
    return c.select("c_custkey", cleaning.locale_number(text).cast("double").alias("balance"), cleaning.yes_or_no(F.when(flag == "No", "n").otherwise(flag)).alias("flag"))


# ---- gold ---------------------------------------------------------------------------


@query(f"WITH {VERSIONS_SQL} SELECT {_VERSION_COLUMNS} FROM versions WHERE is_current")
def gold_current(spark, sf):
    return _shown(gold.current(_versions(spark, sf)))


@query(f"WITH {_ORDER_VERSIONS_SQL} SELECT entity_key, version_no, strftime(valid_to, {STAMP}) AS valid_to, object_id AS owner_no FROM versions WHERE tenant_id = 'F'")
def gold_tenant_wide(spark, sf):
    wide = gold.tenant_wide(_silver(spark, sf), "F", ORDER_MAPPING, ["entity_key", "version_no", "valid_to"])
    return wide.withColumn("valid_to", moment("valid_to"))


@query(f"WITH {_ORDER_VERSIONS_SQL} SELECT tenant_id, _change_reason, count(*) AS n, max(version_no) AS top FROM versions GROUP BY ALL")
def gold_history(spark, sf):
    rows = gold.history(_silver(spark, sf))
    return rows.groupBy("tenant_id", "_change_reason").agg(F.count("*").alias("n"), F.max("version_no").alias("top"))


_AT = "2024-01-15 12:00:00"
_AT_SQL = f"TIMESTAMP '{_AT}' >= valid_from AND TIMESTAMP '{_AT}' < valid_to AND _change_reason <> 'deleted'"


@query(f"WITH {VERSIONS_SQL} SELECT {_VERSION_COLUMNS} FROM versions WHERE {_AT_SQL}")
def gold_asof(spark, sf):
    return _shown(gold.asof(_versions(spark, sf), F.expr(f"TIMESTAMP_NTZ'{_AT}'")))


@query(f"WITH {VERSIONS_SQL} SELECT tenant_id, count(*) AS n FROM versions WHERE {_AT_SQL} GROUP BY tenant_id")
def asof_counts(spark, sf):
    """Through the SQL table function."""
    _versions(spark, sf).createOrReplaceTempView("tidemark_versions")
    gold.create_asof_function(spark, "tidemark_asof", "tidemark_versions", {"tenant_id": "STRING", "entity_key": "STRING", "bucket": "BIGINT"})
    return spark.sql(f"SELECT tenant_id, count(*) AS n FROM tidemark_asof(TIMESTAMP_NTZ'{_AT}') GROUP BY tenant_id")


@query(f"WITH {VERSIONS_SQL} SELECT {_VERSION_COLUMNS} FROM versions v SEMI JOIN (SELECT tenant_id, entity_key FROM versions WHERE _change_reason = 'deleted') g USING (tenant_id, entity_key)")
def deleted_timelines(spark, sf):
    return _shown(gold.deleted_timelines(_versions(spark, sf)))


@query(f"WITH {VERSIONS_SQL} SELECT tenant_id, entity_key, max(version_no) AS versions FROM versions GROUP BY ALL ORDER BY versions DESC, tenant_id, entity_key LIMIT 20")
def top_versions(spark, sf):
    counts = _versions(spark, sf).groupBy("tenant_id", "entity_key").agg(F.max("version_no").alias("versions"))
    return counts.orderBy(F.desc("versions"), "tenant_id", "entity_key").limit(20)


# ---- encodings ----------------------------------------------------------------------


@query("SELECT c_mktsegment, count(*) AS n, string_agg(DISTINCT c_nationkey::VARCHAR, ',' ORDER BY c_nationkey::VARCHAR) AS nations FROM customer GROUP BY c_mktsegment")
def value_encodings(spark, sf):
    c = table(spark, sf, "customer").withColumn("k", F.col("c_nationkey").cast("string"))
    return c.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("k")), ",").alias("nations"))


@query("SELECT 'upper' AS kind, c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') UNION ALL SELECT 'nation', c_custkey FROM customer WHERE c_nationkey IN (1, 2)")
def encodings_in(spark, sf):
    c = table(spark, sf, "customer")
    a = c.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(F.lit("upper").alias("kind"), "c_custkey")
    return a.union(c.where(F.col("c_nationkey").isin(1, 2)).select(F.lit("nation"), "c_custkey"))


@query("SELECT event_type, json_extract_string(props, '$.k') AS k, count(*) AS n, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen FROM events GROUP BY ALL")
def encodings_by_tenant(spark, sf):
    e = table(spark, sf, "events").select("event_type", F.get_json_object("props", "$.k").alias("k"), "ts")
    return e.groupBy("event_type", "k").agg(F.count("*").alias("n"), moment(F.min("ts")).alias("first_seen"))


# ---- profiles and invariants --------------------------------------------------------


@query(f"WITH {STAGED_SQL} SELECT tenant_id, count(*) AS n, count(DISTINCT entity_key) AS entities, count(DISTINCT _source_file) AS files, count_if(_load_mode = 'full') AS full_rows, min(_ingest_seq) AS lo, max(_ingest_seq) AS hi FROM staged GROUP BY ALL")
def bronze_profile(spark, sf):
    staged_events(spark, sf).createOrReplaceTempView("tidemark_staged")
    return spark.sql("SELECT tenant_id, count(*) AS n, count(DISTINCT entity_key) AS entities, count(DISTINCT _source_file) AS files, count_if(_load_mode = 'full') AS full_rows, min(_ingest_seq) AS lo, max(_ingest_seq) AS hi FROM tidemark_staged GROUP BY ALL")


@query(f"WITH {VERSIONS_SQL} SELECT tenant_id, count(*) AS versions, count(DISTINCT entity_key) AS entities, count_if(is_current) AS current_rows, count_if(_change_reason = 'deleted') AS deletions, max(version_no) AS top FROM versions GROUP BY ALL")
def scd2_summary(spark, sf):
    v = _versions(spark, sf)
    return v.groupBy("tenant_id").agg(F.count("*").alias("versions"), F.countDistinct("entity_key").alias("entities"), F.count_if("is_current").alias("current_rows"), F.count_if(F.col("_change_reason") == GONE).alias("deletions"), F.max("version_no").alias("top"))


@query(f"WITH {VERSIONS_SQL}, g AS (SELECT tenant_id, entity_key, count_if(is_current) AS c, count_if(year(valid_to) = 9999) AS o, count(*) AS n, max(version_no) AS m FROM versions GROUP BY ALL) SELECT count(*) AS violations FROM g WHERE c > 1 OR o <> 1 OR n <> m")
def scd2_invariants(spark, sf):
    return reconcile.invariants(_versions(spark, sf)).agg(F.count("*").alias("violations"))


@query(f"WITH {VERSIONS_SQL} SELECT count(*) AS repeated FROM (SELECT _row_hash = lag(_row_hash) OVER (PARTITION BY tenant_id, entity_key ORDER BY version_no) AS same FROM versions) WHERE same")
def repeat_hashes(spark, sf):
    return reconcile.repeated_hashes(_versions(spark, sf)).agg(F.count("*").alias("repeated"))


@query(f"WITH {VERSIONS_SQL}, m AS (SELECT tenant_id, min(entity_key) AS entity_key FROM (SELECT tenant_id, entity_key FROM versions GROUP BY ALL HAVING count(*) > 1) GROUP BY tenant_id) SELECT {_VERSION_COLUMNS} FROM versions JOIN m USING (tenant_id, entity_key)")
def multi_version(spark, sf):
    v = _versions(spark, sf)
    several = v.groupBy("tenant_id", "entity_key").agg(F.count("*").alias("n")).where("n > 1").groupBy("tenant_id").agg(F.min("entity_key").alias("entity_key"))
    return _shown(v.join(several, ["tenant_id", "entity_key"]))


@query(f"WITH {STAGED_SQL} SELECT _batch_id, _load_mode, count(*) AS n_rows, count_if(same) AS n_noop, round(count_if(same) / count(*), 6) AS noop_share FROM (SELECT *, coalesce(lag(_row_hash) OVER (PARTITION BY tenant_id, entity_key ORDER BY _ingest_seq) = _row_hash, false) AS same FROM staged) GROUP BY ALL")
def noop_ratio(spark, sf):
    return reconcile.noop_ratio(staged_events(spark, sf), ["_batch_id", "_load_mode"])


@query(f"WITH {VERSIONS_SQL} SELECT tenant_id, CASE WHEN valid_from = valid_to THEN 'empty' ELSE 'inverted' END AS kind, count(*) AS n FROM versions WHERE valid_from >= valid_to GROUP BY ALL")
def interval_check(spark, sf):
    return reconcile.bad_intervals(_versions(spark, sf)).groupBy("tenant_id", "kind").agg(F.count("*").alias("n"))


@query(f"WITH {DELETED_SQL} SELECT s._batch_id, count(*) AS rows_in, count(DISTINCT s._source_file) AS files, coalesce(any_value(d.n), 0) AS deletions FROM staged s LEFT JOIN (SELECT _batch_id, count(*) AS n FROM tomb GROUP BY ALL) d USING (_batch_id) GROUP BY s._batch_id")
def run_log(spark, sf):
    s = staged_events(spark, sf)
    gone = scd2.deletion_events(s).groupBy("_batch_id").agg(F.count("*").alias("deletions"))
    log = s.groupBy("_batch_id").agg(F.count("*").alias("rows_in"), F.countDistinct("_source_file").alias("files"))
    return log.join(gone, "_batch_id", "left").na.fill(0, ["deletions"])


# ---- registry and cursors -----------------------------------------------------------


def _headers(spark, sf):
    """Headers as if each file's columns were the buckets that occur in it below 4."""
    rows = staged_events(spark, sf).where("bucket < 4")
    grouped = rows.groupBy("tenant_id", "_source_file").agg(F.array_sort(F.collect_set(F.concat(F.lit("c"), F.col("bucket").cast("string")))).alias("columns"), F.max("_ingest_ts").alias("seen"))
    return grouped.select("tenant_id", F.sha2(F.array_join("columns", "|"), 256).alias("schema_ver"), "columns", "seen", F.col("_source_file").alias("file"))


_HEADERS_SQL = STAGED_SQL + ", headers AS (SELECT tenant_id, sha256(array_to_string(columns, '|')) AS schema_ver, columns, seen, file FROM (SELECT tenant_id, _source_file AS file, list_sort(list(DISTINCT 'c' || bucket)) AS columns, max(_ingest_ts) AS seen FROM staged WHERE bucket < 4 GROUP BY ALL))"
_FOLD = "SELECT tenant_id, schema_ver, any_value(columns) AS columns, len(any_value(columns)) AS column_count, min(seen) AS first_seen, max(seen) AS last_seen, min_by(file, seen) AS first_file FROM {} GROUP BY tenant_id, schema_ver"


def _registry(df):
    return df.select("tenant_id", "schema_ver", F.array_join("columns", "|").alias("columns"), F.col("column_count").cast("long").alias("column_count"), moment("first_seen").alias("first_seen"), moment("last_seen").alias("last_seen"), "first_file")


_REGISTRY_SQL = f"SELECT tenant_id, schema_ver, array_to_string(columns, '|') AS columns, column_count, strftime(first_seen, {STAMP}) AS first_seen, strftime(last_seen, {STAMP}) AS last_seen, first_file FROM"


@query(f"WITH {_HEADERS_SQL}, f AS ({_FOLD.format('headers')}) {_REGISTRY_SQL} f")
def registry_fold(spark, sf):
    return _registry(registry.fold(_headers(spark, sf)))


@query(f"WITH {_HEADERS_SQL}, f AS ({_FOLD.format('headers')}) {_REGISTRY_SQL} f")
def registry_merge(spark, sf):
    """Two loads merged give the same registry as one."""
    h = _headers(spark, sf)
    border = F.expr("TIMESTAMP_NTZ'2024-01-12 00:00:00'")
    return _registry(registry.merge(registry.fold(h.where(F.col("seen") < border)), registry.fold(h.where(F.col("seen") >= border))))


@query(
    f"""WITH {_HEADERS_SQL}, f AS ({_FOLD.format('headers')}), n AS (
    SELECT *, row_number() OVER w AS n, lag(columns) OVER w AS before FROM f WINDOW w AS (PARTITION BY tenant_id ORDER BY first_seen, schema_ver))
    SELECT tenant_id, n::INTEGER AS n, schema_ver, array_to_string(list_sort(list_filter(columns, lambda x: NOT list_contains(before, x))), '|') AS added,
    array_to_string(list_sort(list_filter(before, lambda x: NOT list_contains(columns, x))), '|') AS removed FROM n WHERE before IS NOT NULL"""
)
def schema_diff(spark, sf):
    return registry.differences(registry.fold(_headers(spark, sf))).withColumn("added", F.array_join("added", "|")).withColumn("removed", F.array_join("removed", "|"))


def _cursors(df):
    return df.groupBy("tenant_id").agg(F.max("_ingest_seq").alias("last_ingest_seq"))


@query(f"WITH {STAGED_SQL} SELECT tenant_id, max(_ingest_seq) AS last_ingest_seq, CASE WHEN min(_ingest_seq) FILTER (WHERE _ingest_seq <= 3) IS NULL THEN 0 ELSE 41 END AS last_built_seq FROM staged GROUP BY tenant_id")
def state_merge(spark, sf):
    s = staged_events(spark, sf)
    target = _cursors(s.where("_ingest_seq <= 3")).withColumn("last_built_seq", F.lit(41).cast("long"))
    merged = upsert.upsert(target, _cursors(s), ["tenant_id"], {"last_ingest_seq": upsert.GREATEST}, {"last_built_seq": 0})
    return merged.select("tenant_id", "last_ingest_seq", "last_built_seq")


@query(f"WITH {STAGED_SQL} SELECT tenant_id, CASE WHEN tenant_id = 'click' THEN 7 ELSE max(_ingest_seq) END AS last_built_seq FROM staged GROUP BY tenant_id")
def build_cursor(spark, sf):
    s = staged_events(spark, sf)
    target = s.select("tenant_id").distinct().withColumn("last_built_seq", F.lit(7).cast("long"))
    taken = storage.watermark(s).where("tenant_id <> 'click'").select("tenant_id", F.col("last_ingest_seq").alias("last_built_seq"))
    return upsert.update_only(target, taken, ["tenant_id"])


# ---- change feeds -------------------------------------------------------------------


def _extracts(spark, sf):
    """Events as numbered extracts of each tenant, a day each."""
    rows = staged_events(spark, sf)
    return rows.select("tenant_id", "entity_key", F.col("bucket").cast("string").alias("attr"), F.dayofmonth("_ingest_ts").alias("extract_seq"), F.col("_load_mode").alias("load_mode"))


_FEED_KEYS = ["tenant_id", "entity_key"]


def _feed(spark, sf):
    """The feed of all tenants, each with full extracts of its own."""
    return cdc.change_feed(_extracts(spark, sf), _FEED_KEYS, ["attr"], within=["tenant_id"])


_FEED_SQL = STAGED_SQL + """, ex AS (SELECT tenant_id, entity_key, bucket::VARCHAR AS attr, day(_ingest_ts)::INTEGER AS extract_seq, _load_mode AS load_mode FROM staged),
fulls AS (SELECT DISTINCT tenant_id, extract_seq FROM ex WHERE load_mode = 'full'),
feed AS (SELECT tenant_id, entity_key, attr, extract_seq AS seq, 'UPSERT' AS op FROM ex UNION ALL
  SELECT DISTINCT k.tenant_id, k.entity_key, NULL, f.extract_seq, 'DELETE' FROM fulls f JOIN (SELECT DISTINCT tenant_id, entity_key, extract_seq FROM ex) k ON k.tenant_id = f.tenant_id AND k.extract_seq < f.extract_seq
  WHERE NOT EXISTS (SELECT 1 FROM ex e WHERE e.tenant_id = k.tenant_id AND e.entity_key = k.entity_key AND e.extract_seq = f.extract_seq))"""


@query(f"WITH {_FEED_SQL} SELECT tenant_id, entity_key, attr, seq, op FROM feed")
def change_feed(spark, sf):
    return _feed(spark, sf)


@query(f"WITH {DELETED_SQL} SELECT tenant_id, entity_key, _ingest_seq, _row_hash, 'UPSERT' AS op FROM staged UNION ALL SELECT tenant_id, entity_key, _ingest_seq, _row_hash, 'DELETE' FROM tomb")
def change_feed_staged(spark, sf):
    return cdc.staged_feed(staged_events(spark, sf)).select("tenant_id", "entity_key", "_ingest_seq", "_row_hash", "op")


@query(f"WITH {DELETED_SQL} SELECT op, _load_mode, count(*) AS n FROM (SELECT 'UPSERT' AS op, _load_mode FROM staged UNION ALL SELECT 'DELETE', _load_mode FROM tomb) GROUP BY ALL")
def change_feed_profile(spark, sf):
    return cdc.staged_feed(staged_events(spark, sf)).groupBy("op", "_load_mode").agg(F.count("*").alias("n"))


@query(f"WITH {_FEED_SQL} SELECT tenant_id, entity_key, seq, count(*) AS n FROM feed GROUP BY ALL HAVING count(*) > 1")
def cdc_dupes(spark, sf):
    return _feed(spark, sf).groupBy(*_FEED_KEYS, "seq").agg(F.count("*").alias("n")).where("n > 1")


@query(
    f"""WITH {_FEED_SQL}, once AS (SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY tenant_id, entity_key, seq ORDER BY op = 'DELETE' DESC, attr DESC) = 1),
    w AS (SELECT *, lag(op) OVER p AS pop, lag(attr) OVER p AS pattr FROM once WINDOW p AS (PARTITION BY tenant_id, entity_key ORDER BY seq)),
    c AS (SELECT * FROM w WHERE CASE WHEN pop IS NULL THEN op = 'UPSERT' ELSE op <> pop OR (op = 'UPSERT' AND attr <> pattr) END),
    r AS (SELECT *, lead(seq) OVER (PARTITION BY tenant_id, entity_key ORDER BY seq) AS e FROM c)
    SELECT tenant_id, entity_key, attr, seq AS "__START_AT", e AS "__END_AT" FROM r WHERE op = 'UPSERT'"""
)
def cdc_scd2(spark, sf):
    return cdc.apply_changes(_feed(spark, sf), _FEED_KEYS)


@query(f"WITH {_FEED_SQL}, l AS (SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY tenant_id, entity_key ORDER BY seq DESC, op = 'DELETE' DESC, attr DESC) = 1) SELECT tenant_id, entity_key, attr FROM l WHERE op = 'UPSERT'")
def cdc_scd1(spark, sf):
    return cdc.apply_changes(_feed(spark, sf), _FEED_KEYS, scd_type=1)


# ---- proofs -------------------------------------------------------------------------


@query("SELECT 0::BIGINT AS only_a, 0::BIGINT AS only_b")
def recon_except(spark, sf):
    """Two builds of one release, as sets and without the stamps."""
    return reconcile.differences(_silver(spark, sf, build_id="a"), _silver(spark, sf, build_id="b"), silver.VOLATILE, keep_repeats=False)


@query("SELECT 0::BIGINT AS only_a, 0::BIGINT AS only_b")
def recon_except_all(spark, sf):
    """Versions with derived deletions against the feed applied by keys: same live rows and borders."""
    staged = staged_events(spark, sf)
    versions = reconcile.live(scd2.assign_versions(staged)).select("tenant_id", "entity_key", "_row_hash", F.col("_ingest_seq").alias("__START_AT"))
    feed = cdc.staged_feed(staged).select("tenant_id", "entity_key", "_row_hash", F.col("_ingest_seq").alias("seq"), "op")
    return reconcile.differences(versions, cdc.apply_changes(feed, ["tenant_id", "entity_key"]).drop("__END_AT"))


@query(f"WITH {VERSIONS_SQL} SELECT tenant_id, entity_key, count(*) AS n_a, count_if(_row_hash <> '__deleted__') AS n_b FROM versions GROUP BY ALL HAVING count(*) <> count_if(_row_hash <> '__deleted__')")
def recon_counts(spark, sf):
    v = _versions(spark, sf)
    return reconcile.count_difference(v, reconcile.live(v), ["tenant_id", "entity_key"])


@query("SELECT 0::BIGINT AS n")
def recon_deleted(spark, sf):
    """Entities whose last version is a deletion but that are current all the same."""
    v = _versions(spark, sf)
    open_end = F.year("valid_to") == 9999
    gone = v.where((F.col("_change_reason") == GONE) & open_end).select("tenant_id", "entity_key")
    return gold.current(v).join(gone, ["tenant_id", "entity_key"], "left_semi").agg(F.count("*").alias("n"))


@query(f"WITH {_ORDER_VERSIONS_SQL} SELECT 2 AS release, count(*) AS versions, count(DISTINCT entity_key) AS entities, 5 AS n_generic FROM versions UNION ALL SELECT 1, count(*), count(DISTINCT entity_key), 4 FROM versions")
def rebuild_compare(spark, sf):
    """A release without a later column has the same versions and entities."""
    bronze = order_bronze(spark, sf)
    parts = []
    for release, rows in ((2, ORDER_MAPPING), (1, [r for r in ORDER_MAPPING if r.generic_column != "priority"])):
        built = silver.build(bronze, rows, ORDER_GRAIN, mapping_ver=release)
        n = len(Projection(rows).columns(ORDER_GRAIN))
        parts.append(built.agg(F.count("*").alias("versions"), F.countDistinct("entity_key").alias("entities")).select(F.lit(release).alias("release"), "versions", "entities", F.lit(n).alias("n_generic")))
    return parts[0].union(parts[1])


@query(
    f"""WITH {VERSIONS_SQL}, h AS (SELECT md5(tenant_id || '|' || entity_key || '|' || version_no || '|' || _change_reason) AS h FROM versions),
    p AS (SELECT h[1:3] AS p, md5(string_agg(h, ',' ORDER BY h)) AS d FROM h GROUP BY ALL) SELECT md5(string_agg(d, ',' ORDER BY p)) AS fingerprint FROM p"""
)
def fingerprint(spark, sf):
    return reconcile.fingerprint(_versions(spark, sf), ["tenant_id", "entity_key", "version_no", "_change_reason"])


# ---- late, incremental, in time -----------------------------------------------------


@query(f"WITH {ORDER_STAGED_SQL} SELECT event_id FROM (SELECT *, max(modified_ts) OVER (PARTITION BY tenant_id, entity_key ORDER BY _ingest_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM staged) WHERE modified_ts < reached")
def late_arrivals(spark, sf):
    staged = silver.stage(order_bronze(spark, sf).withColumn("payload", F.col("payload")), ORDER_MAPPING, ORDER_GRAIN)
    ids = order_bronze(spark, sf).select("_ingest_seq", F.col("o_orderkey").alias("event_id"))
    late = reconcile.late_arrivals(staged, "modified_ts").select("_ingest_seq")
    return late.join(ids, "_ingest_seq").select("event_id")


@query(f"WITH {VERSIONS_SQL} SELECT tenant_id, entity_key FROM versions WHERE is_current AND (tenant_id, entity_key) NOT IN (SELECT tenant_id, entity_key FROM staged WHERE _batch_id = '2024-01-29')")
def incremental_deletes(spark, sf):
    s = staged_events(spark, sf)
    return incremental.incremental_deletes(gold.current(scd2.assign_versions(s)).select("tenant_id", "entity_key"), s.where("_batch_id = '2024-01-29'"))


@query(f"WITH {VERSIONS_SQL} SELECT {_VERSION_COLUMNS} FROM versions")
def incremental_merge(spark, sf):
    """Versions up to the middle of the month brought up to date: the same as a rebuild."""
    s = staged_events(spark, sf)
    border = s.where("_batch_id <= '2024-01-16'").agg(F.max("_ingest_seq")).first()[0] or 0
    old = scd2.assign_versions(s.where(F.col("_ingest_seq") <= border))
    return _shown(incremental.merge_slice(old, s, border))


@query(
    f"""WITH {VERSIONS_SQL}, l AS (SELECT entity_key, tenant_id, event_id, modified_ts FROM staged),
    m AS (SELECT l.event_id, v.bucket FROM l JOIN versions v ON v.tenant_id = l.tenant_id AND v.entity_key = l.entity_key AND l.modified_ts >= v.valid_from AND l.modified_ts < v.valid_to)
    SELECT l.event_id, m.bucket AS state FROM l LEFT JOIN m USING (event_id)"""
)
def pit_join(spark, sf):
    """Every event against the versions of its entity."""
    s = staged_events(spark, sf)
    right = scd2.assign_versions(s).where("valid_from < valid_to").select("tenant_id", "entity_key", "valid_from", "valid_to", F.col("bucket").alias("state"))
    return gold.pit_join(s.select("tenant_id", "entity_key", "event_id", "modified_ts"), right, ["tenant_id", "entity_key"], "modified_ts", ["state"]).select("event_id", "state")
