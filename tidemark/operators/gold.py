"""What consumers read: current rows, history, states at a time, timelines joined in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..columns import GONE, KEY, OPEN_END, TENANT
from ..functions.projection import MappingRow, field


def current(versions: DataFrame) -> DataFrame:
    """Open versions that are not quarantined.  The end time is tested as well as the flag, for files are skipped by it."""
    open_end = F.lit(OPEN_END).cast(versions.schema["valid_to"].dataType)
    rows = versions.where((F.col("valid_to") == open_end) & F.col("is_current"))
    return rows.where(F.col("_dq_status") != "quarantine") if "_dq_status" in versions.columns else rows


def history(versions: DataFrame, without: Sequence[str] = ("payload",)) -> DataFrame:
    """All versions, deletions included, without bulky columns."""
    return versions.drop(*without)


def asof(versions: DataFrame, at: Column) -> DataFrame:
    """The state at a time: half-open intervals, deletions left out."""
    return versions.where((at >= F.col("valid_from")) & (at < F.col("valid_to")) & (F.col("_change_reason") != GONE))


def create_asof_function(spark: SparkSession, name: str, versions_view: str, columns: dict[str, str], temporary: bool = True) -> None:
    """A SQL table function ``name(as_of)`` over a view of versions."""
    returns = ", ".join(f"{c} {t}" for c, t in columns.items())
    kind = dict(spark.table(versions_view).dtypes)["valid_from"].upper()
    spark.sql(
        f"CREATE OR REPLACE {'TEMPORARY ' * temporary}FUNCTION {name}(as_of {kind}) RETURNS TABLE ({returns}) RETURN "
        f"SELECT {', '.join(columns)} FROM {versions_view} WHERE as_of >= valid_from AND as_of < valid_to AND _change_reason <> '{GONE}'"
    )


def tenant_wide(versions: DataFrame, tenant: str, unpromoted: Sequence[MappingRow], keep: Sequence[str]) -> DataFrame:
    """One tenant's rows with its private columns from the payload, named in lower case."""
    private = [field(r.source_column).alias(r.source_column.lower()) for r in sorted(unpromoted, key=lambda r: r.source_column) if r.tenant == tenant and not r.is_promoted]
    return versions.where(F.col(TENANT) == tenant).select(*keep, *private)


def deleted_timelines(versions: DataFrame) -> DataFrame:
    """Every version of the entities that were deleted at some time."""
    gone = versions.where(F.col("_change_reason") == GONE).select(TENANT, KEY)
    return versions.join(gone, [TENANT, KEY], "left_semi")


def pit_join(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, values: Sequence[str]) -> DataFrame:
    """Each left row once, with the right version in force at its time, if any.

    An as-of join as one shuffle: both sides meet once, hashed by the keys, and the last
    version that starts at or before the row is carried forward and taken if still open.
    Null keys meet nothing, and empty or inverted intervals are never in force.  Where
    versions of one key overlap (event times that go backwards make such), the one that
    starts last is taken, and of those that start together the one that ends last; only
    for such keys are open versions kept in a list.
    """
    bag = F.struct("valid_from", "valid_to", *values)
    right = right.where("valid_from < valid_to").where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    a = left.select(*keys, F.col(at).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_l"), F.lit(None).cast(right.select(bag.alias("b")).schema["b"].dataType).alias("_r"))
    b = right.select(*keys, F.col("valid_from").alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(a.schema["_l"].dataType).alias("_l"), bag.alias("_r"))
    key = Window.partitionBy(*keys)
    order = key.orderBy("_t", "_side", F.col("_r.valid_to"))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = F.max("_r.valid_to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    met = a.unionByName(b).withColumn("_crosses", (F.col("_side") == 0) & (reached > F.col("_t")))
    met = met.withColumn("_mixed", F.coalesce(F.max("_crosses").over(key), F.lit(False)))
    met = met.withColumn("_open", F.collect_list(F.when(F.col("_mixed"), F.col("_r"))).over(so_far)).withColumn("_r", F.last("_r", ignorenulls=True).over(so_far)).where("_side = 1")
    in_force = F.filter("_open", lambda v: v["valid_to"] > F.col("_t"))
    found = F.when(F.col("_mixed"), F.try_element_at(in_force, F.lit(-1))).when(F.col("_t") < F.col("_r.valid_to"), F.col("_r"))
    met = met.withColumn("_r", found)
    return met.select(*[F.col(f"_l.{c}").alias(c) for c in left.columns], *[F.col(f"_r.{v}").alias(v) for v in values])
