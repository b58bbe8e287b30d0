"""Deliveries derived from the test tables, in Spark and as DuckDB text, for the registered queries.

Stage E: ``events`` as five tenants' daily files.  Stage O: ``orders`` as three tenants
with payloads of their own.  Stage C: ``customer`` with spellings of null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.projection import MappingRow
from .operators.sequencing import ingest_seq


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def moment(column: str | Column) -> Column:
    """A time as text, equal in every engine and session time zone."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", F.floor(F.col("value") / 40).cast("long").alias("bucket"), day.alias("day"))
    return rows.select(
        F.col("event_type").alias("tenant_id"),
        F.sha2(F.concat(F.lit("|"), "event_type", F.lit("|"), F.col("user_id").cast("string")), 256).alias("entity_key"),
        F.sha2(F.concat(F.lit("b"), F.col("bucket").cast("string")), 256).alias("_row_hash"),
        (F.col("day") + F.expr("INTERVAL 1 DAY")).alias("_ingest_ts"),
        F.date_format("day", "yyyy-MM-dd").alias("_batch_id"),
        F.concat("event_type", F.lit("/"), F.date_format("day", "yyyy-MM-dd")).alias("_source_file"),
        F.when(F.dayofmonth("day") % 7 == 1, "full").otherwise("delta").alias("_load_mode"),
        "bucket",
        F.col("ts").alias("modified_ts"),
        "event_id",
    )


def staged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest_seq(event_rows(spark, sf_dir), "_source_file", ["_batch_id", "tenant_id"], ["event_id"])
    return rows.select("tenant_id", "entity_key", "_row_hash", "_ingest_seq", "_ingest_ts", "_batch_id", "_source_file", "_load_mode", "bucket", "modified_ts", "event_id")


STAGED_SQL = """
staged AS (
  SELECT event_type AS tenant_id, sha256('|' || event_type || '|' || user_id) AS entity_key, sha256('b' || bucket) AS _row_hash,
    row_number() OVER (ORDER BY d, event_type, event_id) AS _ingest_seq, d + INTERVAL 1 DAY AS _ingest_ts,
    strftime(d, '%Y-%m-%d') AS _batch_id, event_type || '/' || strftime(d, '%Y-%m-%d') AS _source_file,
    CASE WHEN day(d) % 7 = 1 THEN 'full' ELSE 'delta' END AS _load_mode, bucket, ts AS modified_ts, event_id
  FROM (SELECT *, date_trunc('day', ts)::TIMESTAMP AS d, floor(value / 40)::BIGINT AS bucket FROM events))
"""

DELETED_SQL = (
    STAGED_SQL
    + """,
files AS (
  SELECT tenant_id, _source_file, min(_ingest_seq) AS lo, max(_ingest_seq) AS hi, max(_ingest_ts) AS ts, max(_batch_id) AS batch
  FROM staged WHERE _load_mode = 'full' GROUP BY tenant_id, _source_file),
known AS (
  SELECT s.tenant_id, s.entity_key, f._source_file, max(s._ingest_seq) AS last_seq
  FROM staged s JOIN files f ON s.tenant_id = f.tenant_id AND s._ingest_seq < f.lo GROUP BY ALL),
missing AS (
  SELECT k.* FROM known k ANTI JOIN staged s
  ON s.tenant_id = k.tenant_id AND s.entity_key = k.entity_key AND s._source_file = k._source_file),
tomb AS (
  SELECT s.* REPLACE ('__deleted__' AS _row_hash, f.hi AS _ingest_seq, f.ts AS _ingest_ts, f.batch AS _batch_id, f._source_file AS _source_file, 'full' AS _load_mode)
  FROM missing m JOIN staged s ON s.tenant_id = m.tenant_id AND s.entity_key = m.entity_key AND s._ingest_seq = m.last_seq
  JOIN files f ON f.tenant_id = m.tenant_id AND f._source_file = m._source_file)
"""
)


def versions_sql(start: str = "_ingest_ts") -> str:
    return (
        DELETED_SQL
        + f""",
events_all AS (SELECT * FROM staged UNION ALL SELECT * FROM tomb),
changed AS (
  SELECT * EXCLUDE (prev) FROM (
    SELECT *, lag(_row_hash) OVER (PARTITION BY tenant_id, entity_key ORDER BY _ingest_seq) AS prev FROM events_all)
  WHERE prev IS NULL OR prev <> _row_hash),
begun AS (
  SELECT *, row_number() OVER (PARTITION BY tenant_id, entity_key ORDER BY _ingest_seq)::INTEGER AS version_no,
    CASE WHEN _row_hash = '__deleted__' THEN _ingest_ts ELSE {start} END AS valid_from FROM changed),
versions AS (
  SELECT *, coalesce(lead(valid_from) OVER (PARTITION BY tenant_id, entity_key ORDER BY _ingest_seq), TIMESTAMP '9999-12-31') AS valid_to,
    lead(_ingest_seq) OVER (PARTITION BY tenant_id, entity_key ORDER BY _ingest_seq) IS NULL AND _row_hash <> '__deleted__' AS is_current,
    CASE WHEN _row_hash = '__deleted__' THEN 'deleted' WHEN version_no = 1 THEN 'new' ELSE 'changed' END AS _change_reason FROM begun)
"""
    )


VERSIONS_SQL = versions_sql()

#: How stage O's tenants name, format and rename things.
ORDER_MAPPING = (
    MappingRow("F", "K_NO", "object_id", precedence=1, is_business_key=True),
    MappingRow("F", "K_NUMBER", "object_id", precedence=2, is_business_key=True),
    MappingRow("O", "ID", "object_id", is_business_key=True),
    MappingRow("P", "key", "object_id", is_business_key=True),
    MappingRow("F", "CHANGED_ON", "modified_ts", "TIMESTAMP", "dd/MM/yyyy HH:mm:ss"),
    MappingRow("O", "CHANGED_ON", "modified_ts", "TIMESTAMP", "yyyy-MM-dd HH:mm:ss"),
    MappingRow("P", "updated", "modified_ts", "TIMESTAMP", "yyyyMMdd HH:mm"),
    MappingRow("F", "CENTS", "amount", "BIGINT"),
    MappingRow("O", "AMOUNT", "amount", "BIGINT"),
    MappingRow("P", "amount", "amount", "BIGINT"),
    MappingRow("F", "PRIO", "priority"),
    MappingRow("O", "PRIORITY", "priority"),
    MappingRow("F", "OWNER_NO", None, is_promoted=False),
)
ORDER_GRAIN = ("object_id",)


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as text values per tenant, before the payload is built.  Every 11th amount is not a number."""
    key = F.col("o_custkey").cast("string")
    cents = F.when(F.col("o_orderkey") % 11 == 0, "n/a").otherwise(F.round(F.col("o_totalprice") * 100).cast("long").cast("string"))
    is_f, is_o, is_p = (F.col("o_orderstatus") == s for s in "FOP")
    stamp = lambda f: F.date_format("o_orderdate", f)
    even = F.col("o_orderkey") % 2 == 0
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("tenant_id"),
        "o_orderkey",
        F.when(is_f & even, key).alias("K_NO"),
        F.when(is_f & ~even, key).alias("K_NUMBER"),
        F.when(is_o, key).alias("ID"),
        F.when(is_p, key).alias("key"),
        F.when(is_f, stamp("dd/MM/yyyy HH:mm:ss")).when(is_o, stamp("yyyy-MM-dd HH:mm:ss")).alias("CHANGED_ON"),
        F.when(is_p, stamp("yyyyMMdd HH:mm")).alias("updated"),
        F.when(is_f, cents).alias("CENTS"),
        F.when(is_o, cents).alias("AMOUNT"),
        F.when(is_p, cents).alias("amount_p"),
        F.when(is_f, F.col("o_orderpriority")).alias("PRIO"),
        F.when(is_o, F.col("o_orderpriority")).alias("PRIORITY"),
        F.when(is_f, key).alias("OWNER_NO"),
        F.date_format("o_orderdate", "yyyy-MM").alias("_batch_id"),
    )


ORDER_COLUMNS = ("K_NO", "K_NUMBER", "ID", "key", "CHANGED_ON", "updated", "CENTS", "AMOUNT", "PRIO", "PRIORITY", "OWNER_NO")


def order_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage O as bronze rows: numbered by month, tenant and key, a month's file full in January and July."""
    rows = order_rows(spark, sf_dir)
    payload = F.parse_json(F.to_json(F.struct(*ORDER_COLUMNS, F.col("amount_p").alias("amount"))))
    rows = rows.select(
        "tenant_id",
        "o_orderkey",
        payload.alias("payload"),
        F.sha2(F.concat_ws("|", F.coalesce("CENTS", "AMOUNT", "amount_p"), F.coalesce("PRIO", "PRIORITY", F.lit("-"))), 256).alias("_row_hash"),
        "_batch_id",
        F.concat("tenant_id", F.lit("/"), "_batch_id").alias("_source_file"),
        F.when(F.substring("_batch_id", 6, 2).isin("01", "07"), "full").otherwise("delta").alias("_load_mode"),
        F.to_timestamp_ntz(F.concat("_batch_id", F.lit("-28 00:00:00")), F.lit("yyyy-MM-dd HH:mm:ss")).alias("_ingest_ts"),
        F.lit(None).cast("string").alias("_corrupt_record"),
    )
    return ingest_seq(rows, "_source_file", ["_batch_id", "tenant_id"], ["o_orderkey"]).drop("_file_row_num")


ORDERS_SQL = """
typed AS (
  SELECT o_orderstatus AS tenant_id, o_orderkey, o_custkey::VARCHAR AS object_id,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE round(o_totalprice * 100)::BIGINT END AS amount,
    CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' ELSE round(o_totalprice * 100)::BIGINT::VARCHAR END AS raw_amount,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS priority, o_orderdate AS modified_ts,
    sha256('|' || o_orderstatus || '|' || o_custkey) AS entity_key, strftime(o_orderdate, '%Y-%m') AS _batch_id FROM orders)
"""

ORDER_STAGED_SQL = (
    ORDERS_SQL
    + """,
staged AS (
  SELECT tenant_id, entity_key, sha256(raw_amount || '|' || coalesce(priority, '-')) AS _row_hash,
    row_number() OVER (ORDER BY _batch_id, tenant_id, o_orderkey) AS _ingest_seq, (_batch_id || '-28')::TIMESTAMP AS _ingest_ts, _batch_id,
    tenant_id || '/' || _batch_id AS _source_file, CASE WHEN _batch_id[6:7] IN ('01', '07') THEN 'full' ELSE 'delta' END AS _load_mode,
    o_orderkey AS bucket, modified_ts, o_orderkey AS event_id, object_id, amount, raw_amount, priority FROM typed)
"""
)


def customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` with spellings of null, outer spaces and tabs among names and segments."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    name = F.when(k % 9 == 0, "").when(k % 9 == 1, " n/a ").when(k % 9 == 2, "(null)").when(k % 9 == 3, F.concat(F.lit("  "), "c_name", F.lit(" "))).otherwise(F.col("c_name"))
    segment = F.when(k % 7 == 0, " None").when(k % 7 == 1, "-").when(k % 7 == 2, F.concat(F.lit("\t"), "c_mktsegment")).when(k % 7 == 3, F.lit(None)).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", name.alias("c_name"), segment.alias("c_mktsegment"), "c_acctbal", "c_nationkey")


CUSTOMER_SQL = r"""
raw AS (
  SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN '' WHEN 1 THEN ' n/a ' WHEN 2 THEN '(null)' WHEN 3 THEN '  ' || c_name || ' ' ELSE c_name END AS c_name,
    CASE c_custkey % 7 WHEN 0 THEN ' None' WHEN 1 THEN '-' WHEN 2 THEN chr(9) || c_mktsegment WHEN 3 THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_acctbal, c_nationkey
  FROM customer),
normed AS (
  SELECT *, CASE WHEN upper(trim(c_name, ' ')) IN ('', 'NULL', 'N/A', 'NA', '-', '#N/A', '(NULL)', 'NONE') THEN NULL ELSE trim(c_name, ' ') END AS n_name,
    CASE WHEN upper(trim(c_mktsegment, ' ')) IN ('', 'NULL', 'N/A', 'NA', '-', '#N/A', '(NULL)', 'NONE') THEN NULL ELSE trim(c_mktsegment, ' ') END AS n_segment FROM raw)
"""
