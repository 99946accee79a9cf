"""Idempotent changes to tables of immutable files: classify against a key, then apply as copy on write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def classified(rows: DataFrame, operations: DataFrame, key: list[str], fields: list[str], blocked: DataFrame | None = None) -> DataFrame:
    """Operations (op in create, update, delete; key; fields) with an ``outcome``.

    create: CREATE, or SKIP if the key exists.  update: UPDATE if a field that is given differs, else SKIP; ERROR
    without the key.  delete: DELETE, SKIP without the key, ERROR if ``blocked`` (still referenced) has it.
    """
    have = rows.select(*key, *(F.col(f).alias(f"__old_{f}") for f in fields)).withColumn("__there", F.lit(True))
    at = operations.join(have, key, "left")
    there = F.coalesce("__there", F.lit(False))
    if blocked is not None:
        at = at.join(blocked.select(*key).distinct().withColumn("__blocked", F.lit(True)), key, "left")
    else:
        at = at.withColumn("__blocked", F.lit(None).cast("boolean"))
    differs = F.lit(False)
    for f in fields:
        differs |= F.col(f).isNotNull() & ~F.col(f).eqNullSafe(F.col(f"__old_{f}"))
    outcome = (
        F.when((F.col("op") == "create") & ~there, "CREATE")
        .when((F.col("op") == "create"), "SKIP")
        .when((F.col("op") == "update") & ~there, "ERROR")
        .when((F.col("op") == "update") & differs, "UPDATE")
        .when(F.col("op") == "update", "SKIP")
        .when((F.col("op") == "delete") & ~there, "SKIP")
        .when((F.col("op") == "delete") & F.coalesce("__blocked", F.lit(False)), "ERROR")
        .when(F.col("op") == "delete", "DELETE")
        .otherwise("ERROR")
    )
    return at.select(*operations.columns, outcome.alias("outcome"))


def applied(rows: DataFrame, outcomes: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """The table after the changes; a field that an update leaves null keeps its value.  Applying twice changes nothing more."""
    change = outcomes.where(F.col("outcome").isin("UPDATE", "DELETE")).select(*key, "outcome", *(F.col(f).alias(f"__new_{f}") for f in fields))
    kept = rows.join(change, key, "left").where(~F.col("outcome").eqNullSafe("DELETE"))
    kept = kept.select(*(F.coalesce(f"__new_{c}", c).alias(c) if c in fields else F.col(c) for c in rows.columns))
    new = outcomes.where("outcome = 'CREATE'").select(*(F.col(c) if c in outcomes.columns else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns))
    return kept.unionByName(new)


def inserted_or_ignored(rows: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """New keys are added, known ones ignored; of new rows with one key the least stays."""
    fresh = new.join(rows.select(*key), key, "left_anti")
    rest = [c for c in rows.columns if c not in key]
    if rest:
        fresh = fresh.groupBy(*key).agg(F.min(F.struct(*rest)).alias("__r")).select(*key, "__r.*")
    return rows.unionByName(fresh.select(*rows.columns))


def merged_by_url(old: DataFrame, new: DataFrame, url: str = "url") -> DataFrame:
    """Work items added by url; repeats within the new ones stay, as they were listed."""
    return old.unionByName(new.join(old.select(url).distinct(), url, "left_anti").select(*old.columns))


def merged_flags(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """One flag per key; one that is there already stays, of new ones the least."""
    rest = [c for c in old.columns if c != key]
    both = old.withColumn("__p", F.lit(0)).unionByName(new.withColumn("__p", F.lit(1)))
    return both.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct("__p", *rest)).alias("__r")).select(key, "__r.*")
