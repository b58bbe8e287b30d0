"""Reading deliveries as text, one header at a time."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fingerprint import cell, of_header, of_row
from .landing import LandingFile

CORRUPT = "_corrupt_record"
#: A list of so many deliveries (a few hundred bytes each) is broadcast; a longer one is joined by a shuffle.
BROADCAST_FILES = 50_000
GLOB = re.compile(r"[\\{}\[\]*?]")


def literal_path(path: str) -> str:
    """A path for Spark's readers, which take some characters of it for patterns."""
    return GLOB.sub(lambda m: "\\" + m[0], path)


def file_uri(spark: SparkSession, path: str) -> str:
    """The URI under which rows report a file (``_metadata.file_path``): qualified and percent-encoded."""
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    store = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return one_slash(store.makeQualified(found).toUri().toString())


def one_slash(uri: str) -> str:
    """``file:/x`` and ``file:///x`` are the same."""
    return re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):/+", r"\1:/", uri)


def header(spark: SparkSession, path: str, **options) -> list[str]:
    """Column names of a file, from its first line alone."""
    return spark.read.options(**options).option("header", True).option("inferSchema", False).csv(literal_path(path)).columns


def read_delivery(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], mode: str, **options) -> DataFrame:
    """Files with one header, every cell as text.

    A full load fails on a malformed row, for a row lost there would look like a
    deletion.  A delta keeps it in ``_corrupt_record``.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.read.options(**options).option("header", True).option("enforceSchema", False)
    if mode == "full":
        return reader.option("mode", "FAILFAST").schema(schema).csv([literal_path(p) for p in paths]).withColumn(CORRUPT, F.lit(None).cast("string"))
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).schema(kept).csv([literal_path(p) for p in paths])


def payload(columns: Sequence[str]):
    """All cells of a row as a variant; null cells are absent from it."""
    return F.parse_json(F.to_json(F.struct(*map(cell, columns))))


def headers_of(spark: SparkSession, paths: Sequence[str], **options) -> dict[str, tuple[str, ...]]:
    """The header of each file; several are read at a time."""
    with ThreadPoolExecutor(16) as pool:
        return dict(zip(paths, pool.map(lambda p: tuple(header(spark, p, **options)), paths), strict=True))


def bronze_rows(spark: SparkSession, files: Sequence[LandingFile], source_system: str, batch_id: str, **options) -> DataFrame:
    """The rows of some files, ready for numbering.

    Files with the same header and mode are read together, so the plan grows with the
    number of headers and not of files.  Rows are told apart by the URI of their file; a
    row of a file that is not among ``files`` is an error, never dropped.
    """
    groups: dict[tuple, list[LandingFile]] = defaultdict(list)
    names = headers_of(spark, [f.path for f in files], **options)
    for f in files:
        groups[names[f.path], f.load_mode].append(f)
    order = {f.path: i for i, f in enumerate(sorted(files, key=lambda f: (f.modified_at, f.path)))}
    known = [(file_uri(spark, f.path), f.path, f.tenant, f.modified_at.replace(tzinfo=None), order[f.path]) for f in files]
    listing = spark.createDataFrame(known, "_uri string, _path string, tenant_id string, _file_modified timestamp_ntz, _file_order int")
    parts = []
    for (columns, mode), some in groups.items():
        raw = read_delivery(spark, [f.path for f in some], columns, mode, **options)
        parts.append(
            raw.select(
                F.regexp_replace(F.col("_metadata.file_path"), "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/").alias("_uri"),
                F.lit(mode).alias("_load_mode"),
                of_row(columns).alias("_row_hash"),
                F.to_json(F.struct(*map(cell, columns))).alias("_raw"),
                F.lit(of_header(columns)).alias("_schema_ver"),
                F.col(CORRUPT),
            )
        )
    rows = reduce(DataFrame.unionByName, parts)
    met = rows.join(F.broadcast(listing) if len(known) <= BROADCAST_FILES else listing, "_uri", "left")
    unknown = F.raise_error(F.concat(F.lit("rows of an unlisted file: "), F.col("_uri"))).cast("string")
    return met.select(
        F.coalesce("tenant_id", unknown).alias("tenant_id"), F.lit(source_system).alias("source_system"), F.lit(batch_id).alias("_batch_id"), F.col("_path").alias("_source_file"), "_file_modified", "_file_order", "_load_mode", "_row_hash", F.parse_json("_raw").alias("payload"), "_raw", "_schema_ver", CORRUPT
    )
