"""Deliveries for tests: three tenants with their own headers, full, delta and full again.

Between deliveries some objects change, some are resent unchanged and shuffled, the last
few vanish from the final full load, and one tenant gains a column.
"""

from __future__ import annotations

import csv
import os
import random
from datetime import UTC, datetime, timedelta
from pathlib import Path

from ..functions.projection import MappingRow

#: Per tenant: names of id, level, status, title, owner and change time, its time format (Python, Spark), private columns.
TENANTS = {
    "T1": (("OBJ_NO", "LVL", "STATE", "TITLE", "OWNER", "CHANGED"), "%d/%m/%Y %H:%M:%S", "dd/MM/yyyy HH:mm:ss", ("WEIGHT", "COST")),
    "T2": (("Id", "Stage", "Status", "Name", "Responsible", "ModifiedOn"), "%Y-%m-%d %H:%M:%S", "yyyy-MM-dd HH:mm:ss", ("Effort", "Risk", "Budget")),
    "T3": (("key", "tier", "condition", "label", "lead", "updated"), "%Y%m%d %H:%M", "yyyyMMdd HH:mm", ("score", "share")),
}
GENERIC = ("object_id", "level", "status", "title", "owner", "modified_ts")
OBJECTS, VANISHED, RATES = 60, 5, (0.0, 0.2, 0.1)


def mapping() -> list[MappingRow]:
    rows = []
    for tenant, (names, _, spark_format, private) in TENANTS.items():
        for name, generic in zip(names, GENERIC, strict=True):
            kind = "TIMESTAMP" if generic == "modified_ts" else "STRING"
            rows.append(MappingRow(tenant, name, generic, kind, spark_format if kind == "TIMESTAMP" else None, 1, generic == "object_id", True))
        rows += [MappingRow(tenant, p, None, is_promoted=False) for p in private]
    return rows


def write_deliveries(root: str, seed: int = 11) -> list[str]:
    """Write the files below ``root`` with rising modification times; their paths in order."""
    rng = random.Random(seed)
    start = datetime(2026, 1, 5, 8, tzinfo=UTC)
    paths = []
    for t, (tenant, (names, fmt, _, private)) in enumerate(TENANTS.items()):
        state: dict[int, list[str]] = {}
        for n, (mode, rate) in enumerate(zip(("full", "delta", "full"), RATES, strict=True)):
            when = start + timedelta(days=n, minutes=t)
            touched = []
            for i in range(OBJECTS):
                if n == 0 or rng.random() < rate:
                    level = rng.choice(("L1", "L2", "L3"))
                    state[i] = [f"{tenant}-{i:03d}", level, rng.choice(("open", "closed", "N/A", "")), f"Object {i} v{n}", rng.choice(("ann", "bob", "")), when.strftime(fmt), *(str(rng.randint(0, 999)) for _ in private)]
                    touched.append(i)
            extra = ["EXTRA"] if n == 2 and t == 0 else []
            if mode == "full":
                send = list(range(OBJECTS - (VANISHED if n else 0)))
            else:
                send = touched + [i for i in range(OBJECTS) if i not in touched and rng.random() < 0.3]
                rng.shuffle(send)
            path = Path(root, tenant, mode, f"delivery_{n}.csv")
            path.parent.mkdir(parents=True, exist_ok=True)
            with path.open("w", encoding="utf-8", newline="") as f:
                out = csv.writer(f)
                out.writerow([*names, *private, *extra])
                out.writerows([*state[i], *["x"] * len(extra)] for i in send)
            os.utime(path, (when.timestamp(), when.timestamp()))
            paths.append(str(path))
    return paths
