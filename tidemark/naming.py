"""Names of streams and of the places where their tables live."""

from __future__ import annotations

import re

LAYERS = ("bronze", "silver", "gold", "meta")
_WORD = r"[a-z][a-z0-9]*(?:_[a-z0-9]+)*"
_STREAM = re.compile(rf"({_WORD})__({_WORD})")


class Stream(str):
    """One entity of one source system, written ``system__entity``: the unit of ingest, order and failure."""

    source_system: str
    entity: str

    def __new__(cls, name: str):
        found = _STREAM.fullmatch(name)
        if not found:
            raise ValueError(f"not a stream name: {name!r}")
        made = super().__new__(cls, name)
        made.source_system, made.entity = found.groups()
        return made


def place(layer: str, what: str = "", *, suffix: str = "", catalog: str = "") -> str:
    """``catalog.layer_suffix.what``, without the parts that are not given.

    A suffix keeps the databases of a developer apart from the shared ones.
    """
    if layer not in LAYERS:
        raise ValueError(f"unknown layer: {layer!r}")
    if catalog and not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", catalog):
        raise ValueError(f"not a valid catalog: {catalog!r}")
    suffix = suffix.strip().lstrip("_")
    return ".".join(p for p in (catalog, f"{layer}_{suffix}" if suffix else layer, what) if p)
