"""Change feeds: deriving them from deliveries and applying them as type 1 or type 2."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..columns import DELETED, HASH
from ..workspace import materialise
from .scd2 import BROADCAST_FILES, deletion_events

UPSERT, DELETE = "UPSERT", "DELETE"


def change_feed(extracts: DataFrame, keys: Sequence[str], attributes: Sequence[str], seq: str = "extract_seq", mode: str = "load_mode", within: Sequence[str] = ()) -> DataFrame:
    """An UPSERT per delivered row and a DELETE, without attributes, per key known before a full extract and absent from it.

    A key gets a DELETE for every later full extract that it is absent from, so applying
    a feed must be idempotent.  ``within`` names the keys that have full extracts of their
    own (the tenant).  Between two extracts that hold a key lie the full ones it is absent
    from; ordinals of extracts say which, so no list of them travels with the keys.
    """
    rows = extracts.select(*keys, *attributes, F.col(seq).alias("seq"), F.lit(UPSERT).alias("op"))
    numbers = extracts.groupBy(*within, F.col(seq).alias("_seq")).agg(F.max((F.col(mode) == "full").cast("int")).alias("_full"))
    numbers = materialise(numbers, "extracts")
    sized = F.broadcast if numbers.count() <= BROADCAST_FILES else (lambda df: df)
    order = Window.partitionBy(*within).orderBy("_seq") if within else Window.orderBy("_seq")  # one row per extract
    until = F.sum("_full").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbers = numbers.withColumn("_until", until).withColumn("_before", F.col("_until") - F.col("_full")).withColumn("_all", F.sum("_full").over(Window.partitionBy(*within)))
    seen = extracts.select(*keys, F.col(seq).alias("_seq")).distinct()
    seen = seen.withColumn("_next", F.lead("_seq").over(Window.partitionBy(*keys).orderBy("_seq")))
    own = numbers.select(*within, "_seq", F.col("_until").alias("_from"), "_all")
    following = numbers.select(*within, F.col("_seq").alias("_next"), F.col("_before").alias("_to"))
    gaps = seen.join(sized(own), [*within, "_seq"]).join(sized(following), [*within, "_next"], "left")
    gaps = gaps.withColumn("_to", F.coalesce("_to", "_all")).where("_from < _to").select(*keys, F.explode(F.sequence(F.col("_from"), F.col("_to") - 1)).alias("_n"))
    fulls = numbers.where("_full = 1").select(*within, F.col("_before").alias("_n"), F.col("_seq").alias("seq"))
    nulls = [F.lit(None).cast(extracts.schema[a].dataType).alias(a) for a in attributes]
    missed = gaps.join(sized(fulls), [*within, "_n"]).select(*keys, *nulls, "seq", F.lit(DELETE).alias("op"))
    return rows.unionByName(missed)


def staged_feed(staged: DataFrame) -> DataFrame:
    """Delivered rows and derived deletions, tagged with what they do."""
    return staged.unionByName(deletion_events(staged)).withColumn("op", F.when(F.col(HASH) == DELETED, DELETE).otherwise(UPSERT))


def apply_changes(feed: DataFrame, keys: Sequence[str], sequence_by: str = "seq", op: str = "op", except_columns: Sequence[str] = (), untracked: Sequence[str] = (), scd_type: int = 2) -> DataFrame:
    """The target of a change feed.

    Type 2: one row per run of equal tracked columns, with ``__START_AT`` and ``__END_AT``
    holding sequence numbers; a DELETE closes the open row and writes none.  Type 1: the
    last state of each key that is not deleted.  Of events with the same key and number
    the DELETE wins, then the greatest values; the order of arrival never matters.
    """
    left_out = {op, sequence_by, *except_columns}
    values = [c for c in feed.columns if c not in left_out and c not in keys]
    tracked = [c for c in values if c not in untracked]
    once = Window.partitionBy(*keys, sequence_by).orderBy(F.desc(F.col(op) == DELETE), *[F.desc(c) for c in values])
    rows = feed.withColumn("_n", F.row_number().over(once)).where("_n = 1")
    w = Window.partitionBy(*keys).orderBy(sequence_by)
    dead = F.col(op) == DELETE
    if scd_type == 1:
        last = Window.partitionBy(*keys).orderBy(F.desc(sequence_by))
        return rows.withColumn("_l", F.row_number().over(last)).where((F.col("_l") == 1) & ~dead).select(*keys, *values)
    state = F.when(~dead, F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.decode(F.unhex(F.lit("00")), "UTF-8")).alias(c) for c in tracked]) if tracked else F.struct(F.lit(1).alias("one"))))
    rows = rows.withColumn("_state", state).withColumn("_before", F.lag(F.struct("_state")).over(w))
    first = F.col("_before").isNull()
    rows = rows.where(F.when(first, ~dead).otherwise(~F.col("_state").eqNullSafe(F.col("_before._state"))))
    rows = rows.withColumn("__START_AT", F.col(sequence_by)).withColumn("__END_AT", F.lead(sequence_by).over(w))
    return rows.where(~dead).select(*keys, *values, "__START_AT", "__END_AT")
