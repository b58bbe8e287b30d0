"""Proofs that two results are the same, and checks of one result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..columns import DELETED, HASH, KEY, SEQ, TENANT


def comparable(df: DataFrame, without: Sequence[str] = ()) -> DataFrame:
    """Without the named columns and with variants as JSON, which set operations can compare."""
    return df.select(*[F.to_json(c).alias(c) if t == "variant" else F.col(c) for c, t in df.dtypes if c not in without])


def differences(a: DataFrame, b: DataFrame, without: Sequence[str] = (), keep_repeats: bool = True) -> DataFrame:
    """One row: rows only in a, rows only in b.  ``keep_repeats`` counts repeated rows, else sets are compared."""
    a, b = comparable(a, without), comparable(b, without)
    minus = (lambda x, y: x.exceptAll(y)) if keep_repeats else (lambda x, y: x.subtract(y))
    b = b.select(*a.columns)
    sides = minus(a, b).select(F.lit("a").alias("side")).union(minus(b, a).select(F.lit("b")))
    return sides.agg(F.count_if(F.col("side") == "a").alias("only_a"), F.count_if(F.col("side") == "b").alias("only_b"))


def count_difference(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups whose sizes differ, 0 where a side lacks the group."""
    x, y = a.groupBy(*by).agg(F.count("*").alias("n_a")), b.groupBy(*by).agg(F.count("*").alias("n_b"))
    joined = x.join(y, list(by), "full_outer").na.fill(0, ["n_a", "n_b"])
    return joined.where("n_a <> n_b")


def fingerprint(df: DataFrame, columns: Sequence[str], digits: int = 3) -> DataFrame:
    """One md5 over all rows in the order of their text; equal for equal bags of rows.

    Rows are hashed first and the hashes summed up per hash prefix, so that no task
    gathers the table: lists of one prefix make the final one.  ``digits`` of a prefix make
    16 ** digits lists; a table of n rows wants about log16(n / 10,000) of them, and more
    than five are summed up by their first three once more.
    """
    row = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns]))
    parts = df.select(row.alias("h")).groupBy(F.substring("h", 1, digits).alias("p")).agg(F.md5(F.concat_ws(",", F.array_sort(F.collect_list("h")))).alias("d"))
    while digits > 5:
        digits -= 3
        listed = F.transform(F.array_sort(F.collect_list(F.struct("p", "d"))), lambda x: x["d"])
        parts = parts.groupBy(F.substring("p", 1, digits).alias("q")).agg(F.md5(F.concat_ws(",", listed)).alias("d")).withColumnRenamed("q", "p")
    return parts.agg(F.md5(F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("p", "d"))), lambda x: x["d"]))).alias("fingerprint"))


def invariants(versions: DataFrame) -> DataFrame:
    """Entities that break a rule of type 2: several current rows, not exactly one open interval, gaps in version numbers."""
    open_ = F.year("valid_to") == 9999
    grouped = versions.groupBy(TENANT, KEY).agg(F.count_if("is_current").alias("n_current"), F.count_if(open_).alias("n_open"), F.count("*").alias("n_versions"), F.max("version_no").alias("max_version"))
    return grouped.where("n_current > 1 OR n_open <> 1 OR n_versions <> max_version")


def repeated_hashes(versions: DataFrame) -> DataFrame:
    """Versions that say the same as the one before."""
    w = Window.partitionBy(TENANT, KEY).orderBy("version_no")
    return versions.withColumn("_b", F.lag(HASH).over(w)).where(F.col("_b") == F.col(HASH)).drop("_b")


def bad_intervals(versions: DataFrame) -> DataFrame:
    """Versions whose interval is empty or inverted, with the kind."""
    kind = F.when(F.col("valid_from") == F.col("valid_to"), "empty").otherwise("inverted")
    return versions.where(F.col("valid_from") >= F.col("valid_to")).withColumn("kind", kind)


def late_arrivals(staged: DataFrame, event_time: str) -> DataFrame:
    """Rows whose event time lies before one that their entity had already reached."""
    w = Window.partitionBy(TENANT, KEY).orderBy(SEQ).rowsBetween(Window.unboundedPreceding, -1)
    return staged.withColumn("_reached", F.max(event_time).over(w)).where(F.col(event_time) < F.col("_reached")).drop("_reached")


def noop_ratio(staged: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per delivery: rows, rows that repeat their entity's last delivered hash, and their share."""
    w = Window.partitionBy(TENANT, KEY).orderBy(SEQ)
    rows = staged.withColumn("_same", F.coalesce(F.lag(HASH).over(w) == F.col(HASH), F.lit(False)))
    grouped = rows.groupBy(*by).agg(F.count("*").alias("n_rows"), F.count_if("_same").alias("n_noop"))
    return grouped.withColumn("noop_share", F.round(F.col("n_noop") / F.col("n_rows"), 6))


def live(versions: DataFrame) -> DataFrame:
    """Versions that are not deletions."""
    return versions.where(F.col(HASH) != DELETED)
