"""The published form of the catalogue: rows filtered, aliases folded in, names derived, inner columns dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.functions.display import bullet_display_name, cartridge_display_name
from curatio.functions.numbers import missing

#: What the published tables leave out.
DROPPED_TABLES = ["alembic_version", "bullet_bc_source", "bullet_product_line"]
DROPPED_COLUMNS = {
    "bullet": ["data_source", "is_locked", "extraction_confidence", "last_verified_at", "bc_source_notes", "product_line_id", "created_at", "updated_at"],
    "cartridge": ["data_source", "is_locked", "extraction_confidence", "last_verified_at", "bullet_match_confidence", "bullet_match_method", "created_at", "updated_at"],
    "rifle_model": ["data_source", "is_locked", "created_at", "updated_at"],
    "manufacturer": ["created_at", "updated_at"],
    "caliber": ["created_at", "updated_at"],
    "chamber": ["created_at", "updated_at"],
    "optic": ["created_at", "updated_at"],
    "reticle": ["created_at", "updated_at"],
    "entity_alias": ["created_at", "updated_at"],
    "platform": ["created_at", "updated_at"],
    "caliber_platform": ["created_at", "updated_at"],
    "chamber_accepts_caliber": ["created_at", "updated_at"],
}
WRONG_DIAMETER = 0.223
MAX_WEIGHT_GAP = 1.0
#: A maker and the names of its cartridges that are linked to wrong bullets.
MISLINKED = {"Federal": "%Power-Shok Copper%"}
#: What a published table is looked up by: rows are sorted by it within files, so that their statistics tell which to read.
LOOKUP = {"bullet": "name", "cartridge": "caliber_id", "manufacturer": "name", "caliber": "name", "chamber": "name", "optic": "name", "reticle": "name", "entity_alias": "entity_id"}


def folded_aliases(entities: DataFrame, aliases: DataFrame, id_column: str = "id") -> DataFrame:
    """alt_names with the aliases added, repeats in other case left out, in order."""
    more = aliases.groupBy(F.col("entity_id").alias(id_column)).agg(F.array_sort(F.collect_set("alias")).alias("__more"))
    joined = entities.join(more, id_column, "left")
    every = F.concat(F.coalesce("alt_names", F.array().cast("array<string>")), F.coalesce("__more", F.array().cast("array<string>")))
    once = F.aggregate(every, F.array().cast("array<string>"), lambda have, x: F.when(F.array_contains(F.transform(have, lambda h: F.lower(h)), F.lower(x)), have).otherwise(F.array_append(have, x)))
    return joined.withColumn("alt_names", once).drop("__more")


def exported_cartridges(cartridges: DataFrame, bullets: DataFrame) -> DataFrame:
    """Cartridges that have no bullet, or its weight and a ballistic coefficient from anywhere; none with a speed of nothing.

    A bullet with the wrong diameter is not published, so no coefficient is asked of it."""
    gone = F.coalesce(F.col("diameter") == WRONG_DIAMETER, F.lit(False)) if "diameter" in bullets.columns else F.lit(False)
    b = bullets.select(F.col("id").alias("bullet_id"), F.col("weight").alias("__w"), (~gone).alias("__linked"), *(F.col(c).alias(f"__{c}") for c in ("g1", "g7", "g1_est", "g7_est")))
    at = cartridges.join(b, "bullet_id", "left")
    moves = F.coalesce(F.col("velocity") > 0, F.lit(True))
    fits = ~F.coalesce(F.abs(F.col("bullet_weight") - F.col("__w")) > MAX_WEIGHT_GAP, F.lit(False))
    of_bullet = F.coalesce("__g1", "__g7", "__g1_est", "__g7_est").isNotNull()
    usable = ~F.coalesce("__linked", F.lit(False)) | ~missing(F.col("g1")) | ~missing(F.col("g7")) | of_bullet
    return at.where(moves & fits & usable).select(*cartridges.columns)


def without_mislinked(cartridges: DataFrame, makers: DataFrame) -> DataFrame:
    """Cartridges (manufacturer_id, name) but those of a maker (id, name) whose names tell that their bullets are wrong."""
    told = F.lit(False)
    for maker, pattern in MISLINKED.items():
        told |= (F.col("__maker") == maker) & F.col("name").ilike(pattern)
    at = cartridges.join(makers.select(F.col("id").alias("manufacturer_id"), F.col("name").alias("__maker")), "manufacturer_id", "left")
    return at.where(~F.coalesce(told, F.lit(False))).select(*cartridges.columns)


def exported_bullets(bullets: DataFrame, wrong_name: str | None = None) -> DataFrame:
    out = bullets.where(~F.coalesce(F.col("diameter") == WRONG_DIAMETER, F.lit(False)))
    return out if wrong_name is None else out.where(~F.coalesce(F.col("name").ilike(wrong_name), F.lit(False)))


def with_display_names(bullets: DataFrame, *, maker: str = "maker") -> DataFrame:
    """Adds display_name and a warning where it is empty, too short or no different."""
    return bullets.withColumn("display_name", bullet_display_name(F.col("name"), F.col("product_line"), F.col(maker))).withColumn("warning", name_warning(F.col("display_name"), F.col("name")))


def with_cartridge_names(cartridges: DataFrame) -> DataFrame:
    return cartridges.withColumn("display_name", cartridge_display_name(F.col("name"), F.col("product_line"), F.col("bullet_product_line"))).withColumn("warning", name_warning(F.col("display_name"), F.col("name")))


def name_warning(display: Column, name: Column) -> Column:
    return F.when(F.coalesce(display, F.lit("")) == "", "empty").when(F.length(display) < 2, "short").when(display == name, "unchanged")


def export_run(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The published tables of a catalogue's (manufacturer, bullet, cartridge, entity_alias and any others), by all rules in order.

    Aliases of product lines become alternative names; bad rows, inner tables and inner columns go; bullets and cartridges
    of a known maker get their display names."""
    out = {name: rows for name, rows in tables.items() if name not in DROPPED_TABLES}
    makers, bullets, cartridges, aliases = (tables[t] for t in ("manufacturer", "bullet", "cartridge", "entity_alias"))
    of_line = F.coalesce(F.col("entity_type") == "bullet_product_line", F.lit(False))
    bullets = folded_aliases(bullets, aliases.where(of_line).select("entity_id", "alias"), "product_line_id").select(*bullets.columns)
    facts = bullets.select("id", F.col("weight_grains").alias("weight"), F.col("bullet_diameter_inches").alias("diameter"), F.col("bc_g1_published").alias("g1"), F.col("bc_g7_published").alias("g7"), F.col("bc_g1_estimated").alias("g1_est"), F.col("bc_g7_estimated").alias("g7_est"))
    said = {"velocity": "muzzle_velocity_fps", "bullet_weight": "bullet_weight_grains", "g1": "bc_g1", "g7": "bc_g7"}
    fit = exported_cartridges(cartridges.withColumns({short: F.col(name) for short, name in said.items()}), facts).select(*cartridges.columns)
    fit = without_mislinked(fit, makers)
    kept = bullets.where(~F.coalesce(F.col("bullet_diameter_inches") == WRONG_DIAMETER, F.lit(False)))
    maker = makers.select(F.col("id").alias("manufacturer_id"), F.col("name").alias("maker"))
    named = with_display_names(kept.join(maker, "manufacturer_id", "left")).withColumn("display_name", F.when(F.col("maker").isNotNull(), F.col("display_name")))
    out["bullet"] = named.select(*bullets.columns, "display_name")
    lines = kept.select(F.col("id").alias("bullet_id"), F.col("product_line").alias("bullet_product_line"))
    named = with_cartridge_names(fit.join(lines, "bullet_id", "left").join(maker, "manufacturer_id", "left")).withColumn("display_name", F.when(F.col("maker").isNotNull(), F.col("display_name")))
    out["cartridge"] = named.select(*cartridges.columns, "display_name")
    out["entity_alias"] = aliases.where(~of_line)
    return {name: rows.drop(*DROPPED_COLUMNS.get(name, [])) for name, rows in out.items()}


def laid_out(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Tables sorted within their files by what they are looked up by: no shuffle."""
    return {name: rows.sortWithinPartitions(LOOKUP[name]) if LOOKUP.get(name) in rows.columns else rows for name, rows in tables.items()}
