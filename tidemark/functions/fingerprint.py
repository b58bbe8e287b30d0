"""What a delivered row says, as one hash: Columns over its cells, whatever a mapping makes of them later."""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import sha256

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of "no value", compared in upper case after trimming spaces.
ABSENT = ("", "NULL", "N/A", "NA", "-", "#N/A", "(NULL)", "NONE")


def cell(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`%s`" % name.replace("`", "``"))


def cleaned(value: Column) -> Column:
    """The value without outer spaces, null if it is a spelling of "no value".  Case is kept; tabs are not spaces."""
    bare = F.trim(value)
    return F.when(~F.upper(bare).isin(*ABSENT), bare)


def canonical(names: Iterable[str]) -> Column:
    """A row as JSON that depends neither on column order nor on spellings of "no value", which become the NUL character and so differ from every text."""
    fields = [F.ifnull(cleaned(cell(n)), F.lit("\0")).alias(n) for n in sorted(names)]
    if not fields:
        raise ValueError("no columns to take a fingerprint of")
    return F.to_json(F.struct(*fields))


def of_row(names: Iterable[str]) -> Column:
    return F.sha2(canonical(names), 256)


def of_header(names: Iterable[str]) -> str:
    """The same for equal sets of column names."""
    return sha256("|".join(sorted(names)).encode()).hexdigest()
