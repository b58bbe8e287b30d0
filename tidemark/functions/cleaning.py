"""Values as people write them: numbers with their country's marks, yes and no."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of yes and no, compared in upper case.
YES = ("Y", "1", "TRUE", "T")
NO = ("N", "0", "FALSE", "F")


def locale_number(value: Column, kind: str = "DECIMAL(18,4)", group: str = ".", point: str = ",") -> Column:
    """A number without its group marks and with a decimal point; null if it is none."""
    plain = F.replace(F.replace(value, F.lit(group), F.lit("")), F.lit(point), F.lit("."))
    return plain.try_cast(kind)


def yes_or_no(value: Column) -> Column:
    upper = F.upper(value)
    return F.when(upper.isin(*YES), True).when(upper.isin(*NO), False)
