"""Merging into tables whose format has no MERGE: one full outer join with a policy per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, TAKE, GREATEST, LEAST = "keep", "take", "greatest", "least"


def _merged(policy: str, old: Column, new: Column) -> Column:
    if policy == KEEP:
        return F.coalesce(old, new)
    if policy == TAKE:
        return F.coalesce(new, old)
    if policy == GREATEST:
        return F.greatest(old, new)
    if policy == LEAST:
        return F.least(old, new)
    raise ValueError(f"unknown policy: {policy!r}")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], policies: Mapping[str, str], defaults: Mapping[str, object] | None = None) -> DataFrame:
    """``target`` after merging ``source``: matched rows by each column's policy, unmatched rows of both sides kept.

    A column of the target that the source lacks keeps its value, and takes its default
    (else null) in inserted rows.  Keys must be unique in the source; null keys match nothing.
    """
    t, s = target.alias("t"), source.withColumn("_in", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    joined = t.join(s, on, "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            value = F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}"))
        elif c in source.columns:
            value = _merged(policies.get(c, TAKE), F.col(f"t.{c}"), F.col(f"s.{c}"))
        else:
            default = F.lit((defaults or {}).get(c)).cast(target.schema[c].dataType)
            value = F.when(F.col("s._in") & F.col(f"t.{keys[0]}").isNull(), default).otherwise(F.col(f"t.{c}"))
        out.append(value.alias(c))
    return joined.select(*out)


def update_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched rows take the source's values, others stay; nothing is inserted."""
    t, s = target.alias("t"), source.alias("s")
    joined = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "left")
    return joined.select(*[F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c) if c in source.columns and c not in keys else F.col(f"t.{c}").alias(c) for c in target.columns])
