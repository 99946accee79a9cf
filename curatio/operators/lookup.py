"""Deterministic lookup of names: exact, alternative names, learned aliases, and periods ignored for calibres."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatio.functions.text import normalize_caliber, normalize_lookup
from curatio.operators.joins import typed_references

#: Confidence of each way of matching.
TIERS = {"exact_name": 1.0, "alt_name": 0.95, "entity_alias": 0.90, "caliber_norm": 0.95, "caliber_norm_alt": 0.90, "caliber_norm_alias": 0.90}


def names_table(entities: DataFrame, aliases: DataFrame | None, entity_type: str, caliber: bool = False) -> DataFrame:
    """The long form (norm, entity_id, maker_id, method, confidence, tier, ord) of entities (id, name, alt_names, maker_id).

    ``ord`` orders hits within a tier.  In the period-insensitive tier an entity's alternative name comes before a
    later entity's own name; in the others all own names come first.
    """
    base = entities.select(F.col("id").alias("entity_id"), "name", "alt_names", "maker_id")
    alts = base.select("entity_id", "maker_id", F.posexplode("alt_names").alias("pos", "text"))
    other = None
    if aliases is not None:
        own = aliases.where(F.col("entity_type") == entity_type)
        other = typed_references(own, {entity_type: base.select("entity_id", "name")}).select("entity_id", F.col("alias").alias("text")).join(base.select("entity_id", "maker_id"), "entity_id")

    def rows(df: DataFrame, text: str, method: str, tier: int, order, norm) -> DataFrame:
        return df.select(norm(F.col(text)).alias("norm"), "entity_id", "maker_id", F.lit(method).alias("method"), F.lit(TIERS[method]).alias("confidence"), F.lit(tier).alias("tier"), order.alias("ord"))

    none = F.lit(0).cast("int")
    parts = [rows(base, "name", "exact_name", 1, none, normalize_lookup), rows(alts, "text", "alt_name", 2, none, normalize_lookup)]
    if other is not None:
        parts.append(rows(other, "text", "entity_alias", 3, none, normalize_lookup))
    if caliber:
        parts += [rows(base, "name", "caliber_norm", 4, none, normalize_caliber), rows(alts, "text", "caliber_norm_alt", 4, F.col("pos") + 1, normalize_caliber)]
        if other is not None:
            parts.append(rows(other, "text", "caliber_norm_alias", 5, none, normalize_caliber))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("norm != ''")


def lookup(mentions: DataFrame, names: DataFrame, *, name: str = "name", maker: str | None = None, caliber: bool = False) -> DataFrame:
    """mentions (mention_id, name[, maker]) with entity_id, method and confidence of the first hit; null if there is none.

    With a maker column, a mention whose maker is known sees that maker's entities only.  Of hits in one tier the
    entity with the least id wins, then its earliest name.
    """
    keyed = mentions.withColumn("__a", normalize_lookup(F.col(name)))
    at = [F.struct(F.col("__a").alias("norm"), F.lit(0).alias("low"))]
    if caliber:
        at.append(F.struct(normalize_caliber(F.col(name)).alias("norm"), F.lit(4).alias("low")))
    asked = keyed.select("mention_id", *[maker] * (maker is not None), F.explode(F.array(*at)).alias("q")).where("q.norm != ''")
    in_reach = (F.col("q.norm") == F.col("norm")) & F.when(F.col("q.low") == 0, F.col("tier") <= 3).otherwise(F.col("tier") >= 4)
    if maker is not None:
        in_reach &= F.col(maker).isNull() | F.col("maker_id").isNull() | (F.col(maker) == F.col("maker_id"))
    hits = asked.join(names, in_reach)
    best = hits.groupBy("mention_id").agg(F.min_by(F.struct("entity_id", "method", "confidence"), F.struct("tier", "entity_id", "ord")).alias("h"))
    return mentions.join(best.select("mention_id", "h.*"), "mention_id", "left")
