"""What a patch's operations come to: each action's own rule for what is there already, on whole levels of operations.

Operations are tables (position and fields); a level's operations see what the levels before it made, and among the
creations of one level the first by position wins.  Names are compared in any case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatio.functions.text import normalize_lookup

#: What a row that a patch creates says of its origin, and a link that a patch makes of its match.
CREATED = {"data_source": "manual", "is_locked": True}
LINKED = {"bullet_match_confidence": 1.0, "bullet_match_method": "manual"}


def with_ids(operations: DataFrame, names: DataFrame, said: str, to: str) -> DataFrame:
    """operations with the id of what ``said`` names in a table of names (norm, entity_id, tier); null if nobody has the name."""
    one = names.groupBy(F.col("norm").alias("__norm")).agg(F.min_by("entity_id", F.struct("tier", "entity_id")).alias(to))
    return operations.join(one, normalize_lookup(F.col(said)) == F.col("__norm"), "left").drop("__norm")


def _by_name(entities: DataFrame, owner: str | None, name: str) -> tuple[DataFrame, Column]:
    keys = [F.lower(name).alias("__name")] + ([F.col(owner).alias("__owner")] if owner else [])
    on = F.lower(name) == F.col("__name")
    return entities.groupBy(*keys).agg(F.min("id").alias("__by_name")), on & (F.col(owner) == F.col("__owner")) if owner else on


def created(operations: DataFrame, entities: DataFrame, *, owner: str | None = "manufacturer_id", name: str = "name", code: str | None = None) -> DataFrame:
    """operations with target_id and outcome: SKIP where the code exists, whoever's it is, or else the owner has the name;
    ERROR where the owner is not known; CREATE otherwise.

    owner None: names are unique by themselves (makers, calibres)."""
    have, on = _by_name(entities, owner, name)
    at = operations.join(have, on, "left")
    target = F.col("__by_name")
    if code:
        codes = entities.where(F.col(code).isNotNull()).groupBy(F.lower(code).alias("__code")).agg(F.min("id").alias("__by_code"))
        at = at.join(codes, F.lower(code) == F.col("__code"), "left")
        target = F.coalesce("__by_code", "__by_name")
    known = F.col(owner).isNotNull() if owner else F.lit(True)
    at = at.withColumn("target_id", target).withColumn("__fresh", known & F.col("target_id").isNull())
    for key in ([[F.lower(code)]] if code else []) + [[F.lower(name), *([F.col(owner)] if owner else [])]]:
        nth = F.row_number().over(Window.partitionBy("__fresh", *key).orderBy("position"))
        at = at.withColumn("__nth", nth).withColumn("__fresh", F.col("__fresh") & (key[0].isNull() | (F.col("__nth") == 1)))
    return at.select(*operations.columns, "target_id", F.when(~known, "ERROR").when(F.col("__fresh"), "CREATE").otherwise("SKIP").alias("outcome"))


def updated(operations: DataFrame, entities: DataFrame, fields: list[str], *, owner: str = "manufacturer_id", name: str = "name") -> DataFrame:
    """operations with target_id and outcome: UPDATE where a field that is given differs, SKIP where none does, ERROR without the row."""
    have, on = _by_name(entities, owner, name)
    old = entities.select(F.col("id").alias("target_id"), *(F.col(f).alias(f"__{f}") for f in fields))
    at = operations.join(have, on, "left").withColumnRenamed("__by_name", "target_id").join(old, "target_id", "left")
    differs = F.lit(False)
    for f in fields:
        differs |= F.col(f).isNotNull() & ~F.col(f).eqNullSafe(F.col(f"__{f}"))
    outcome = F.when(F.col("target_id").isNull(), "ERROR").when(differs, "UPDATE").otherwise("SKIP")
    return at.select(*operations.columns, "target_id", outcome.alias("outcome"))


def relinked(operations: DataFrame, cartridges: DataFrame) -> DataFrame:
    """operations (manufacturer_id, name, bullet as said, bullet_id as found) with target_id, outcome and, where the link
    changes, what a match made by hand says of itself; ERROR where cartridge or bullet is not known."""
    have, on = _by_name(cartridges, "manufacturer_id", "name")
    old = cartridges.select(F.col("id").alias("target_id"), F.col("bullet_id").alias("__bullet_id"))
    at = operations.join(have, on, "left").withColumnRenamed("__by_name", "target_id").join(old, "target_id", "left")
    lost = F.col("target_id").isNull() | (F.col("bullet").isNotNull() & F.col("bullet_id").isNull())
    changes = F.col("bullet_id").isNotNull() & ~F.col("bullet_id").eqNullSafe(F.col("__bullet_id"))
    outcome = F.when(lost, "ERROR").when(changes, "UPDATE").otherwise("SKIP")
    at = at.withColumn("outcome", outcome)
    says = [F.when(F.col("outcome") == "UPDATE", F.lit(v)).alias(c) for c, v in LINKED.items()]
    return at.select(*operations.columns, "target_id", "outcome", *says)


def deleted(operations: DataFrame, entities: DataFrame, referenced: DataFrame | None = None, *, owner: str = "manufacturer_id", name: str = "name") -> DataFrame:
    """operations (id, or owner and name) with target_id and outcome: SKIP without the row, ERROR where ``referenced`` (id) has it, else DELETE."""
    have, on = _by_name(entities, owner, name)
    ids = entities.select(F.col("id").alias("__by_id"))
    at = operations.join(ids, F.col("id") == F.col("__by_id"), "left").join(have, on & F.col("id").isNull(), "left").withColumn("target_id", F.coalesce("__by_id", "__by_name"))
    held = F.lit(False)
    if referenced is not None:
        at = at.join(referenced.select(F.col("id").alias("__held")).distinct(), F.col("target_id") == F.col("__held"), "left")
        held = F.col("__held").isNotNull()
    outcome = F.when(F.col("target_id").isNull(), "SKIP").when(held, "ERROR").otherwise("DELETE")
    return at.select(*operations.columns, "target_id", outcome.alias("outcome"))


def added(operations: DataFrame, known: DataFrame, key: list[str]) -> DataFrame:
    """operations with an outcome for rows that are all key (measurements, aliases), the first part of it the row they belong
    to: ERROR if that is not known, SKIP where the whole key exists or an earlier operation adds it, else CREATE."""
    have = known.select(*(F.col(c).alias(f"__{c}") for c in key)).distinct().withColumn("__there", F.lit(True))
    on = F.lit(True)
    for c in key:
        on &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("position"))
    at = operations.join(have, on, "left").withColumn("__nth", nth)
    outcome = F.when(F.col(key[0]).isNull(), "ERROR").when(F.col("__there").isNotNull() | (F.col("__nth") > 1), "SKIP").otherwise("CREATE")
    return at.select(*operations.columns, outcome.alias("outcome"))


def applied(entities: DataFrame, outcomes: DataFrame, fields: list[str], new_id: Column | None = None) -> DataFrame:
    """entities (id, fields, more) after the outcomes of one action; of several updates of a field the last by position counts.

    new_id: the id of a row that is created, a hash of the operation's key, so that a second run makes the same rows."""
    gone = outcomes.where("outcome = 'DELETE'").select(F.col("target_id").alias("id")).distinct()
    kept = entities.join(gone, "id", "left_anti")
    if fields:
        change = outcomes.where("outcome = 'UPDATE'").groupBy(F.col("target_id").alias("id"))
        change = change.agg(*(F.max_by(f, F.when(F.col(f).isNotNull(), F.col("position"))).alias(f"__new_{f}") for f in fields))
        kept = kept.join(change, "id", "left")
    kept = kept.select(*(F.coalesce(f"__new_{c}", c).alias(c) if c in fields else F.col(c) for c in entities.columns))
    if new_id is None:
        return kept
    make = outcomes.where("outcome = 'CREATE'").withColumn("id", new_id)
    say = {c: F.lit(v) for c, v in CREATED.items() if c in entities.columns}
    return kept.unionByName(make.select(*((say[c] if c in say else F.col(c) if c in make.columns else F.lit(None)).cast(entities.schema[c].dataType).alias(c) for c in entities.columns)))
