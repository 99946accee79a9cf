"""What is done with each resolved mention: nine actions, first that applies, and what that teaches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.functions.text import normalize_lookup
from curatio.operators.resolve import DEFAULT, Config


def variant(config: Config = DEFAULT) -> Column:
    """A weak match to an entity of another weight, with all references known: a new weight variant."""
    tolerance = F.when(F.col("entity_type") == "bullet", config.auto_create_bullet_weight_tolerance_grains).otherwise(config.auto_create_cartridge_weight_tolerance_grains)
    apart = F.coalesce(F.abs(F.col("weight") - F.col("target_weight")) > tolerance, F.lit(True))
    return F.col("matched") & (F.col("confidence") < config.auto_create_confidence_ceiling) & (F.size("unresolved_refs") == 0) & F.coalesce(F.col("weight") > 0, F.lit(False)) & apart


def decided(resolved: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Adds ``action`` to resolved mentions.

    Columns: entity_type, matched, confidence, rejected, excluded_caliber, orphan_diameter, target_locked, weight,
    target_weight, unresolved_refs, bullet_id, old_bullet_id, bullet_diameter, caliber_diameter.
    """
    sure = F.col("matched") & (F.col("confidence") >= config.match_confidence_threshold)
    cartridge = F.col("entity_type") == "cartridge"
    relinked = cartridge & F.col("bullet_id").isNotNull() & ~F.col("bullet_id").eqNullSafe(F.col("old_bullet_id"))
    crossed = F.coalesce(F.abs(F.col("bullet_diameter") - F.col("caliber_diameter")) > 0.005, F.lit(True))
    unresolved = (F.size("unresolved_refs") > 0) | (cartridge & F.col("bullet_id").isNull())
    action = (
        F.when(F.col("rejected"), "rejected_normalization")
        .when(F.col("excluded_caliber"), "rejected_caliber")
        .when((F.col("entity_type") == "bullet") & F.col("orphan_diameter"), "rejected_orphan_diameter")
        .when(sure & F.col("target_locked"), "skipped_locked")
        .when(sure & relinked & crossed, "blocked_cross_diameter")
        .when(sure & relinked, "matched_updated")
        .when(sure, "matched_existing")
        .when(variant(config), "created_variant")
        .when(F.col("matched"), "flagged_low_confidence")
        .when(unresolved, "flagged_unresolved")
        .otherwise("created")
    )
    return resolved.withColumn("action", action)


def action_counts(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("entity_type", "action").agg(F.count("*").alias("n"))


def method_telemetry(decisions: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """By entity type and method: mentions, mean confidence, weak ones, and the share of the type's matches."""
    matched = decisions.where("matched")
    by = matched.groupBy("entity_type", "method").agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 4).alias("avg_confidence"), F.count_if(F.col("confidence") < config.low_confidence_report_threshold).alias("n_low"))
    total = matched.groupBy("entity_type").agg(F.count("*").alias("total"))
    return by.join(total, "entity_type").withColumn("share_pct", F.round(100.0 * F.col("n") / F.col("total"), 2)).drop("total")


def alias_suggestions(decisions: DataFrame, known: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Names that matched by likeness and that no lookup would find yet, and which of them are sure enough to be learned.

    decisions: entity_type, entity_id, name, canonical_name, method, confidence, is_ambiguous; known: entity_type,
    entity_id, norm.
    """
    norm = normalize_lookup(F.col("name"))
    new = decisions.where(F.col("method").isin("composite_key", "fuzzy_name") & (F.col("confidence") >= config.match_confidence_threshold)).withColumn("norm", norm)
    new = new.where((F.col("norm") != "") & (F.col("norm") != normalize_lookup(F.col("canonical_name"))))
    new = new.join(known.select("entity_type", "entity_id", "norm").distinct(), ["entity_type", "entity_id", "norm"], "left_anti")
    sure = (F.col("confidence") > config.alias_auto_promote_threshold) & ~F.col("is_ambiguous")
    return new.groupBy("entity_type", "entity_id", "norm").agg(F.min("name").alias("alias"), F.max("confidence").alias("confidence"), F.max(sure).alias("promote"))
