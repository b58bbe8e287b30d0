"""Typed columns out of self-describing payloads, by a catalog of declared mappings.

A mapping says which payload field of which tenant feeds which generic column.  A
``Projection`` holds the catalog by generic column and tenant and gives Columns; made for
one tenant, it reads that tenant's fields without asking for the tenant (Catalyst does not
prune the branches of other tenants).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fingerprint import cell

KEY_NAME = "entity_key"
FIELD_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
SCALAR = re.compile(r"[A-Z]+(\(\d+(, ?\d+)?\))?")


class MappingRow(NamedTuple):
    """One line of the catalog; the names are those of its CSV header."""

    tenant: str
    source_column: str
    generic_column: str | None
    target_type: str = "STRING"
    parse_format: str | None = None
    precedence: int = 1
    is_business_key: bool = False
    is_promoted: bool = True


def field(name: str, payload: str = "payload") -> Column:
    """A payload's field as text, null where it is missing."""
    if not FIELD_NAME.fullmatch(name):
        raise ValueError(f"not a plain field name: {name!r}")
    return F.try_variant_get(cell(payload), f"$.{name}", "string")


class Projection:
    def __init__(self, rows: Iterable[MappingRow], tenant: str | None = None, tenant_column: str = "tenant_id", payload: str = "payload"):
        self.tenant, self.tenant_column, self.payload = tenant, tenant_column, payload
        self.catalog: dict[str, dict[str, list[MappingRow]]] = {}
        for row in sorted(rows, key=lambda r: (r.tenant, r.precedence, r.source_column)):
            if row.generic_column:
                self.catalog.setdefault(row.generic_column, {}).setdefault(row.tenant, []).append(row)

    def _lines(self, generic: str) -> list[MappingRow]:
        return [row for rows in self.catalog.get(generic, {}).values() for row in rows]

    def _choose(self, generic: str, read: Callable[[list[MappingRow]], Column]) -> Column:
        """``read`` of the mappings of the row's tenant; null for a tenant without any."""
        if generic not in self.catalog:
            raise ValueError(f"nothing feeds {generic!r}")
        nothing = F.lit(None).cast("string")
        if self.tenant is not None:
            return read(self.catalog[generic][self.tenant]) if self.tenant in self.catalog[generic] else nothing
        chosen = None
        for tenant, rows in self.catalog[generic].items():
            mine = cell(self.tenant_column) == tenant
            chosen = F.when(mine, read(rows)) if chosen is None else chosen.when(mine, read(rows))
        return nothing if chosen is None else chosen

    def _first(self, rows: list[MappingRow]) -> Column:
        """The first field that is there: a renamed column's new and old name."""
        return F.coalesce(*(field(r.source_column, self.payload) for r in rows))

    def _moment(self, rows: list[MappingRow]) -> Column:
        given = [r.parse_format for r in rows if r.parse_format]
        return F.try_to_timestamp(self._first(rows), F.lit(given[0])) if given else self._first(rows).try_cast("timestamp")

    def kind(self, generic: str) -> str:
        """The declared type, on which all tenants must agree."""
        kinds = sorted({r.target_type.upper() for r in self._lines(generic)})
        if len(kinds) != 1 or not SCALAR.fullmatch(kinds[0]):
            raise ValueError(f"{generic}: not one scalar type: {kinds}")
        return kinds[0]

    def text(self, generic: str) -> Column:
        """The delivered text."""
        return self._choose(generic, self._first)

    def value(self, generic: str) -> Column:
        """The value in its declared type, null where it cannot be cast.  Text stays as delivered."""
        kind = self.kind(generic)
        if kind == "TIMESTAMP":
            return self._choose(generic, self._moment).cast("timestamp")
        return self.text(generic) if kind == "STRING" else self.text(generic).try_cast(kind)

    def key(self, grain: Sequence[str]) -> Column:
        """sha256 of the tenant and the delivered key parts, each behind a bar; null if any part is.

        The parts must be exactly the generic columns that some tenant declares a key.
        """
        declared = {g for g in self.catalog if any(r.is_business_key for r in self._lines(g))}
        if not grain or declared != set(grain):
            raise ValueError(f"key columns {sorted(declared)} are not the grain {sorted(grain)}")
        keys = Projection((r for g in grain for r in self._lines(g) if r.is_business_key), self.tenant, self.tenant_column, self.payload)
        return F.sha2(F.concat(*(x for part in (cell(self.tenant_column), *map(keys.text, grain)) for x in (F.lit("|"), part))), 256)

    def names(self) -> list[str]:
        """Generic columns that some tenant promotes."""
        return sorted(g for g in self.catalog if any(r.is_promoted for r in self._lines(g)))

    def promoted(self) -> Projection:
        return Projection((r for g in self.catalog for r in self._lines(g) if r.is_promoted), self.tenant, self.tenant_column, self.payload)

    def columns(self, grain: Sequence[str]) -> list[Column]:
        """All promoted columns by name, then the entity's key."""
        shown = self.promoted()
        return [*(shown.value(g).alias(g) for g in shown.names()), self.key(grain).alias(KEY_NAME)]

    def failures_of(self) -> dict[str, tuple[Column, Column]]:
        """name -> (typed column as built, delivered text) of every promoted column with a type other than text."""
        shown = self.promoted()
        return {g: (cell(g), shown.text(g)) for g in shown.names() if shown.kind(g) != "STRING"}


def load_release(catalog: DataFrame, releases: DataFrame, version: int) -> DataFrame:
    """Catalog rows that were in force when a mapping release was made (both sides are small)."""
    r = releases.where(F.col("mapping_ver") == version).select("released_at")
    return catalog.join(r, (catalog["recorded_at"] <= r["released_at"]) & (catalog["superseded_at"] > r["released_at"])).drop("released_at")


def mapping_rows(release: DataFrame) -> list[MappingRow]:
    """The rows of a release as objects; a catalog is declared by hand, so it is small."""
    return [MappingRow(*r) for r in release.select(*MappingRow._fields).collect()]
