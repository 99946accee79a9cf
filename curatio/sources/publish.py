"""Publishing tables: a gate on keys, a hash of what is published, and a manifest written last."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.operators.joins import key_changes


def stable(old: DataFrame, new: DataFrame, key: list[str]) -> tuple[bool, DataFrame]:
    """Whether no published key is gone, and all changes of keys."""
    changes = key_changes(old, new, key)
    return changes.where("change = 'removed'").limit(1).count() == 0, changes


def content_hash(table: DataFrame) -> str:
    """One hash of a table's rows, whatever their order or files: sums of row hashes."""
    row = F.to_json(F.struct(*sorted(table.columns)), {"ignoreNullFields": "false"})
    a, n = table.agg(F.sum(F.xxhash64(row).cast("decimal(38,0)")), F.count("*")).first()
    b = table.agg(F.sum(F.xxhash64(F.lit(1), row).cast("decimal(38,0)"))).first()[0]
    return f"{n:x}-{int(a or 0) % 2**64:016x}-{int(b or 0) % 2**64:016x}"


def publish(spark: SparkSession, tables: dict[str, tuple[DataFrame, list[str]]], root: str, commit: bool = False) -> dict:
    """Writes tables as the next version below root, then the manifest that names it; without commit only says what would be.

    Stops where a key that is published would go.  Readers take the version that the manifest names, so they never
    see half of one.
    """
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest.json")
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    before = json.loads(spark.read.text(f"{root}/manifest.json", wholetext=True).first()[0]) if fs.exists(fs_path) else {"version": 0, "tables": {}}
    version = before["version"] + 1
    made: dict = {"version": version, "tables": {}, "removed_keys": []}
    for name, (table, key) in tables.items():
        if name in before["tables"]:
            ok, _ = stable(spark.read.parquet(f"{root}/v{before['version']}/{name}.parquet"), table, key)
            if not ok:
                made["removed_keys"].append(name)
        made["tables"][name] = {"rows": table.count(), "hash": content_hash(table)}
    if commit and not made["removed_keys"]:
        for name, (table, _) in tables.items():
            table.write.mode("overwrite").parquet(f"{root}/v{version}/{name}.parquet")
        out = fs.create(fs_path, True)
        out.write(bytearray(json.dumps({k: made[k] for k in ("version", "tables")}).encode()))
        out.close()
    return made
