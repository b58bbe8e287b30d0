"""Declarations of entities, mappings and environments.

A declaration is a tree of settings.  Each setting of an entity has a line in ``SETTINGS``
that says what it may hold; unknown, missing and wrong settings are errors.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Mapping
from pathlib import Path
from typing import Any, NamedTuple

from .functions.projection import MappingRow
from .naming import Stream
from .sources.landing import parse_layout


class ConfigError(ValueError):
    """A declaration that cannot be used."""


Check = Callable[[Any], Any]


def _text(value: Any) -> str:
    if not isinstance(value, str) or not value.strip():
        raise ValueError("not a text")
    return value


def _layout(value: Any) -> str:
    parse_layout(_text(value))
    return value


def _texts(least: int) -> Check:
    def check(value: Any) -> tuple[str, ...]:
        if not isinstance(value, list) or len(value) < least:
            raise ValueError(f"not a list of {least} or more entries")
        if len(found := tuple(map(_text, value))) != len(set(found)):
            raise ValueError("repeated entries")
        return found

    return check


def _one_of(*allowed: str) -> Check:
    def check(value: Any) -> str:
        if value not in allowed:
            raise ValueError(f"{value!r} is none of {allowed}")
        return value

    return check


def _options(value: Any) -> dict[str, str]:
    if not isinstance(value, Mapping):
        raise ValueError("not a mapping")
    return {str(k): str(v) for k, v in value.items()}


#: What an entity declares.  A question mark marks what may be left out.
SETTINGS: dict[str, Check] = {
    "source_system": _text,
    "entity": _text,
    "landing.volume": _text,
    "landing.path": _text,
    "landing.layout": _layout,
    "landing.format": _text,
    "landing.options?": _options,
    "grain.business_key": _texts(1),
    "grain.tenant_column": _text,
    "historisation": _one_of("scd2", "current_only", "insert_only", "append", "snapshot"),
    "sequencing.source": _one_of("file_mtime", "manifest"),
    "sequencing.manifest_column?": _text,
    "schema_evolution.new_column": _one_of("accept", "fail"),
    "schema_evolution.missing_business_key": _one_of("fail", "quarantine"),
    "quality.required": _texts(0),
    "quality.on_violation": _one_of("quarantine", "drop", "fail"),
    "event_time?": _text,
}
ENVIRONMENT: dict[str, Check] = {"name": _text, "catalog": _text, "schema_suffix?": lambda value: str(value or "")}
_FREE = {k.rstrip("?") for k, check in SETTINGS.items() if check is _options}


def _flat(tree: Any, above: str = "") -> dict[str, Any]:
    """The leaves of a tree by their dotted path; free-form settings are leaves."""
    if not isinstance(tree, Mapping):
        raise ConfigError(f"{above or 'declaration'}: not a mapping")
    out: dict[str, Any] = {}
    for key, value in tree.items():
        path = f"{above}.{key}" if above else str(key)
        out |= _flat(value, path) if isinstance(value, Mapping) and path not in _FREE else {path: value}
    return out


def settle(tree: Any, table: Mapping[str, Check]) -> dict[str, Any]:
    """The checked settings of a declaration by their dotted path; what was left out is None."""
    given = {k: v for k, v in _flat(tree).items() if not (v is None and f"{k}?" in table)}
    known = {k.rstrip("?"): k.endswith("?") for k in table}
    if unknown := sorted(set(given) - set(known)):
        raise ConfigError(f"unknown or not of this shape: {unknown}")
    if missing := sorted(k for k, free in known.items() if not free and k not in given):
        raise ConfigError(f"missing: {missing}")
    out: dict[str, Any] = dict.fromkeys(known)
    for path, value in given.items():
        try:
            out[path] = table[path if path in table else f"{path}?"](value)
        except ValueError as e:
            raise ConfigError(f"{path}: {e}") from None
    return out


class Entity(NamedTuple):
    """One declared entity: ``entity["landing.layout"]`` is a setting."""

    stream: Stream
    settings: dict[str, Any]

    def __getitem__(self, path):  # type: ignore[override]
        return self.settings[path] if isinstance(path, str) else tuple.__getitem__(self, path)


def parse_entity(data: Any) -> Entity:
    """An entity from its parsed YAML."""
    found = settle(data, SETTINGS)
    if (found["sequencing.source"] == "manifest") != bool(found["sequencing.manifest_column"]):
        raise ConfigError("sequencing: a manifest column belongs to the manifest source, and only to it")
    try:
        return Entity(Stream(f"{found['source_system']}__{found['entity']}"), found)
    except ValueError as e:
        raise ConfigError(str(e)) from None


def read_yaml(path: Path) -> Any:
    try:
        import yaml
    except ImportError:  # the parser is optional; entities can be given as dictionaries
        raise ConfigError("reading YAML needs the yaml package") from None
    try:
        return yaml.safe_load(path.read_text(encoding="utf-8"))
    except yaml.YAMLError as e:
        raise ConfigError(f"{path.name}: {e}") from None


def load_entities(folder: Path) -> dict[Stream, Entity]:
    """All ``*.yml`` entities of a folder; two for one stream are an error."""
    found: dict[Stream, Entity] = {}
    for path in sorted([*folder.glob("*.yml"), *folder.glob("*.yaml")]):
        entity = parse_entity(read_yaml(path))
        if entity.stream in found:
            raise ConfigError(f"{path.name}: {entity.stream} is declared twice")
        found[entity.stream] = entity
    return found


MAPPING_HEADER = MappingRow._fields


def _flag(value: str) -> bool:
    return _one_of("true", "false")(value.strip().lower()) == "true"


def _number(value: str) -> int:
    if not value.strip().isdigit():
        raise ValueError("not a number")
    return int(value)


#: How the cells of a mapping file are read.
CELLS: dict[str, Check] = {
    "tenant": lambda v: _text(v).strip(),
    "source_column": lambda v: _text(v).strip(),
    "generic_column": lambda v: v.strip() or None,
    "target_type": lambda v: (v.strip() or "STRING").upper(),
    "parse_format": lambda v: v.strip() or None,
    "precedence": _number,
    "is_business_key": _flag,
    "is_promoted": _flag,
}


def load_column_mapping(path: Path) -> tuple[MappingRow, ...]:
    """The mapping rows of a CSV file with exactly the columns of ``MAPPING_HEADER``."""
    with path.open(encoding="utf-8", newline="") as f:
        lines = list(csv.reader(f))
    if not lines or tuple(lines[0]) != MAPPING_HEADER:
        raise ConfigError(f"{path.name}: the header must be {','.join(MAPPING_HEADER)}")
    rows: dict[tuple[str, str], MappingRow] = {}
    for n, line in enumerate(lines[1:], 2):
        if not line:
            continue
        if len(line) != len(MAPPING_HEADER):
            raise ConfigError(f"{path.name}, line {n}: wrong number of cells")
        try:
            row = MappingRow(*(CELLS[name](value) for name, value in zip(MAPPING_HEADER, line, strict=True)))
        except ValueError as e:
            raise ConfigError(f"{path.name}, line {n}: {e}") from None
        if rows.setdefault(row[:2], row) is not row:
            raise ConfigError(f"{path.name}, line {n}: {row.tenant}.{row.source_column} is mapped twice")
    if not rows:
        raise ConfigError(f"{path.name}: no mappings")
    return tuple(rows.values())


def parse_environment(data: Any, expected: str) -> dict[str, Any]:
    """``name, catalog, schema_suffix`` of an environment, whose name must be that of its file."""
    found = settle(data, ENVIRONMENT)
    if found["name"] != expected:
        raise ConfigError(f"environment {found['name']!r} in a file named {expected!r}")
    return found | {"schema_suffix": found["schema_suffix"] or ""}


def load_environment(path: Path) -> dict[str, Any]:
    return parse_environment(read_yaml(path), path.stem)
