"""Declared changes in YAML files: found in order, checked whole before any is applied, applied level by level."""

from __future__ import annotations

import re
from collections.abc import Callable
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession

#: The actions and the level in which they apply when a patch's order allows.
LEVELS = {
    "create_manufacturer": 0,
    "create_caliber": 0,
    "create_bullet": 1,
    "update_bullet": 1,
    "create_cartridge": 2,
    "create_rifle": 2,
    "update_cartridge": 2,
    "add_bc_source": 2,
    "add_entity_alias": 2,
    "delete_cartridge": 3,
    "delete_bullet": 4,
}
NAME = re.compile(r"^\d{3}_[a-z0-9_]+$")
DATE = re.compile(r"^\d{4}-\d{2}-\d{2}$")


class InvalidPatch(ValueError):
    pass


def discovered(folder: str) -> list[Path]:
    """Patch files by their numeric prefix."""
    return sorted((p for p in Path(folder).glob("*.y*ml") if NAME.match(p.stem)), key=lambda p: (int(p.stem[:3]), p.stem))


def checked(path: Path) -> dict:
    """A patch whose head and operations are as they must be."""
    patch = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
    head = patch.get("patch") or {}
    faults = []
    if not NAME.match(str(head.get("id", ""))):
        faults.append("id")
    if not head.get("author"):
        faults.append("author")
    if not DATE.match(str(head.get("date", ""))):
        faults.append("date")
    if not head.get("description") or len(str(head["description"])) > 500:
        faults.append("description")
    operations = patch.get("operations") or []
    if not operations:
        faults.append("operations")
    faults += [f"operation {i}: {op.get('action')!r}" for i, op in enumerate(operations) if not isinstance(op, dict) or op.get("action") not in LEVELS]
    faults += [f"operation {i}: bullet_manufacturer without bullet" for i, op in enumerate(operations) if isinstance(op, dict) and op.get("action") == "update_cartridge" and op.get("bullet_manufacturer") and not op.get("bullet")]
    if faults:
        raise InvalidPatch(f"{path.name}: {', '.join(faults)}")
    return patch


def operations(spark: SparkSession, folder: str) -> DataFrame:
    """(patch_id, position, action, level, fields) of all patches, or a fault before anything is applied."""
    rows = []
    for path in discovered(folder):
        patch = checked(path)
        rows += [(patch["patch"]["id"], i, op["action"], LEVELS[op["action"]], {k: None if v is None else str(v) for k, v in op.items() if k != "action"}) for i, op in enumerate(patch["operations"])]
    return spark.createDataFrame(rows, "patch_id string, position int, action string, level int, fields map<string,string>")


def in_order(rows: list, apply: Callable[[list], None]) -> None:
    """Applies operations in runs of one level, in patch order, so each sees what those before it made."""
    run: list = []
    for r in sorted(rows, key=lambda r: (r.patch_id, r.position)):
        if run and r.level != run[-1].level:
            apply(run)
            run = []
        run.append(r)
    if run:
        apply(run)
