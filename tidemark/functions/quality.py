"""Cast failures, row status and declared rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

OK, WARN, QUARANTINE = "ok", "warn", "quarantine"


def cast_failures(checks: Mapping[str, tuple[Column, Column]]) -> Column:
    """Names whose raw value is there while the typed one is null, as an array.  checks: name -> (typed, raw)."""
    return F.array_compact(F.array(*[F.when(typed.isNull() & raw.isNotNull(), F.lit(name)) for name, (typed, raw) in checks.items()]))


def row_status(corrupt: Column, required: Sequence[Column], failures: Column) -> Column:
    """quarantine for a corrupt row or a missing required value, else warn for failed casts, else ok."""
    bad = corrupt.isNotNull()
    for c in required:
        bad = bad | c.isNull()
    return F.when(bad, QUARANTINE).when(F.size(failures) > 0, WARN).otherwise(OK)


def rule_violations(required: Sequence[str] = (), domains: Mapping[str, Sequence] | None = None, bounds: Mapping[str, tuple[float | None, float | None]] | None = None) -> Column:
    """Names of the declared rules that a row breaks, as an array.  Nulls break only ``required``."""
    found = [F.when(F.col(c).isNull(), F.lit(f"required:{c}")) for c in required]
    found += [F.when(~F.col(c).isin(*values), F.lit(f"domain:{c}")) for c, values in (domains or {}).items()]
    for c, (low, high) in (bounds or {}).items():
        outside = F.lit(False)
        if low is not None:
            outside = outside | (F.col(c) < low)
        if high is not None:
            outside = outside | (F.col(c) > high)
        found.append(F.when(outside, F.lit(f"threshold:{c}")))
    return F.array_compact(F.array(*found))


def apply_rules(df, violations: Column, on_violation: str):
    """quarantine: mark rows; drop: keep rows without violations; fail: the query fails at the first row with one."""
    if on_violation == "quarantine":
        return df.withColumn("_violations", violations).withColumn("_dq_status", F.when(F.size("_violations") > 0, QUARANTINE).otherwise(OK))
    if on_violation == "drop":
        return df.where(F.size(violations) == 0)
    if on_violation == "fail":
        found = F.array_join(violations, ", ")
        return df.where(F.when(F.size(violations) > 0, F.raise_error(F.concat(F.lit("rule violated: "), found)).cast("boolean")).otherwise(True))
    raise ValueError(f"unknown policy: {on_violation!r}")
