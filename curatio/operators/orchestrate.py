"""One mention of any type through all its references: maker, calibre, chamber, diameter, product line, match and bullet.

Names are resolved once for each distinct text and joined back, so the cost of a reference follows the number of
different names, not of mentions.  What could not be resolved is told in ``unresolved_refs``, in a fixed order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.functions.numbers import python_round2
from curatio.functions.similarity import name_similarity
from curatio.functions.text import normalize_product_line
from curatio.operators import resolve
from curatio.operators.lookup import lookup
from curatio.operators.resolve import DEFAULT, Config, Score, full_score
from curatio.sources.scratch import scratch


@dataclass(frozen=True)
class Catalogue:
    """What mentions are resolved against.

    makers, calibers, product_lines: tables of ``lookup.names_table``; maker_names, caliber_names: (entity_id, text),
    scored where the lookup finds nothing; caliber_sizes: (caliber_id, caliber_diameter); bridge: (caliber_id,
    chamber_id, is_primary).
    """

    makers: DataFrame
    maker_names: DataFrame
    calibers: DataFrame
    caliber_names: DataFrame
    caliber_sizes: DataFrame
    bridge: DataFrame
    product_lines: DataFrame


def reference(mentions: DataFrame, column: str, names: DataFrame, dimension: DataFrame, threshold: float, scale: float, *, caliber: bool = False, score: Score = name_similarity, rounded: Score = python_round2) -> DataFrame:
    """(column, entity_id) of each distinct non-empty name in the column: by lookup, else by likeness to a dimension."""
    asked = mentions.where(F.col(column) != "").select(F.col(column).alias("mention_id"), F.col(column).alias("name")).distinct()
    told = scratch(lookup(asked, names, caliber=caliber).select("mention_id", "name", "entity_id"), "told")
    alike = resolve.fuzzy_reference(told.where("entity_id is null"), dimension, threshold, scale, score, rounded)
    found = told.where("entity_id is not null").select("mention_id", "entity_id").unionByName(alike.select("mention_id", "entity_id"))
    return found.select(F.col("mention_id").alias(column), "entity_id")


def product_lines(mentions: DataFrame, names: DataFrame, short: DataFrame | None = None) -> DataFrame:
    """(mention_id, product_line_id): the first hit of the line as given, its short form, and the name; of the maker's own
    lines where the maker is known.  mentions: mention_id, m_maker, m_name, m_product_line; short: the short forms of lines
    (__text, __line), where they are known already.  Each different name of a maker is looked up once."""
    text = F.coalesce("m_product_line", "m_name")
    rows = mentions.select("mention_id", "m_maker", "m_name", "m_product_line")
    rows = rows.withColumn("__line", normalize_product_line(text)) if short is None else rows.join(short.hint("merge"), text == F.col("__text"), "left")
    asked = rows.select("mention_id", "m_maker", F.posexplode(F.array("m_product_line", "__line", "m_name")).alias("place", "name")).where("name != ''")
    keyed = asked.select("m_maker", "name").distinct().select(F.struct("m_maker", "name").alias("mention_id"), "m_maker", "name")
    hits = lookup(keyed, names, maker="m_maker").where("entity_id is not null").select(F.col("mention_id.m_maker").alias("__maker"), F.col("mention_id.name").alias("__name"), "entity_id")
    hits = asked.join(hits.hint("merge"), (F.col("name") == F.col("__name")) & F.col("m_maker").eqNullSafe(F.col("__maker")))
    return hits.groupBy("mention_id").agg(F.min_by("entity_id", "place").alias("product_line_id"))


def _missing(known: Column, said: Column, label: str, absent: str) -> Column:
    """What to tell of a reference that was not extracted, or not found."""
    return F.when(F.coalesce(said, F.lit("")) == "", F.lit(f"{absent}: not extracted")).when(known.isNull(), F.concat(F.lit(f"{label}: "), said))


def references(mentions: DataFrame, at: Catalogue, config: Config = DEFAULT, *, score: Score = name_similarity, rounded: Score = python_round2) -> DataFrame:
    """mentions with manufacturer_id, caliber_id, chamber_id, caliber_diameter, bullet_diameter, unresolved_refs, warnings.

    mentions: mention_id, entity_type (bullet, cartridge, rifle), maker, caliber, diameter (text), bullet_name.  Bullets
    are known by their diameter, the others by a calibre, rifles by the chamber that takes it.
    """
    makers = reference(mentions, "maker", at.makers, at.maker_names, config.manufacturer_fuzzy_threshold, config.manufacturer_fuzzy_confidence_scale, score=score, rounded=rounded).withColumnRenamed("entity_id", "manufacturer_id")
    calibers = reference(mentions.where("entity_type in ('cartridge', 'rifle')"), "caliber", at.calibers, at.caliber_names, config.caliber_fuzzy_threshold, config.caliber_fuzzy_confidence_scale, caliber=True, score=score, rounded=rounded)
    chambers = resolve.chambers(calibers.select(F.col("entity_id").alias("caliber_id")).distinct(), at.bridge, config).select("caliber_id", "chamber_id")
    calibers = calibers.withColumnRenamed("entity_id", "caliber_id").join(chambers, "caliber_id", "left").join(at.caliber_sizes, "caliber_id", "left")
    kind, bullet = F.col("entity_type"), F.col("entity_type") == "bullet"
    out = mentions.join(makers, "maker", "left").join(calibers, "caliber", "left")
    for c in ("caliber_id", "chamber_id", "caliber_diameter"):
        out = out.withColumn(c, F.when(kind == "rifle" if c == "chamber_id" else kind.isin("cartridge", "rifle"), F.col(c)))
    out = out.withColumn("bullet_diameter", F.when(bullet, F.expr("try_cast(diameter as double)")))
    diameter = F.when(F.col("diameter").isNull(), F.lit("bullet_diameter_inches: not extracted")).when(F.col("bullet_diameter").isNull(), F.concat(F.lit("bullet_diameter_inches: invalid value '"), "diameter", F.lit("'")))
    told = F.array(
        _missing(F.col("manufacturer_id"), F.col("maker"), "manufacturer", "manufacturer"),
        F.when(bullet, diameter).when(kind == "rifle", _missing(F.col("chamber_id"), F.col("caliber"), "chamber (from caliber)", "caliber")).when(kind == "cartridge", _missing(F.col("caliber_id"), F.col("caliber"), "caliber", "caliber")),
    )
    no_size = F.when((kind == "cartridge") & (F.col("bullet_name") != "") & F.col("caliber_id").isNotNull() & F.col("caliber_diameter").isNull(), F.concat(F.lit("caliber "), F.col("caliber_id").cast("string"), F.lit(" has no bullet diameter; bullet match has no diameter filter")))
    unknown = F.when(~kind.isin("bullet", "cartridge", "rifle"), F.concat(F.lit("Unknown entity type: "), kind))
    return out.withColumn("unresolved_refs", F.array_compact(told)).withColumn("warnings", F.array_compact(F.array(no_size, unknown)))


def resolved(mentions: DataFrame, at: Catalogue, bullets: DataFrame, cartridges: DataFrame, rifles: DataFrame, config: Config = DEFAULT, *, score: Score = full_score, name_score: Score = name_similarity, rounded: Score = python_round2) -> DataFrame:
    """``references``, and of each mention the entity that it is, if any, and of a cartridge the bullet that it carries.

    Adds entity_id, confidence, method, product_line_id, bullet_id, bullet_match_confidence, bullet_match_method, and tells
    of bullets that were not found, are too uncertain, or have another weight.  mentions further hold m_name, m_sku,
    m_weight, m_product_line, m_g1, m_g7; bullets and cartridges are as ``resolve.match`` takes them, e_maker and
    e_caliber being ids; rifles: entity_id, e_name, e_maker, e_chamber.
    """
    whole = scratch(references(mentions, at, config, score=name_score, rounded=rounded), "references")
    own = whole.withColumn("m_maker", F.col("manufacturer_id")).withColumn("m_caliber", F.col("caliber_id")).withColumn("m_chamber", F.col("chamber_id"))
    # a bullet carried is known by its name and weight alone: no stock code, and no line but what its name says
    carries = (F.col("entity_type") == "cartridge") & (F.col("bullet_name") != "") & F.col("caliber_id").isNotNull()
    text = F.lit(None).cast("string")
    stub = own.where(carries).withColumn("m_name", F.col("bullet_name")).withColumn("m_diameter", F.col("caliber_diameter")).withColumn("m_sku", text).withColumn("m_product_line", text)
    common = resolve.shared([own, stub], [bullets, cartridges, rifles], [score, name_score])  # every match and every pass reads these
    names = scratch(at.product_lines, "line_names")
    lines = scratch(product_lines(own.where("entity_type = 'bullet'"), names, common.lines), "lines")
    none = F.lit(None).cast("bigint")
    as_bullet = own.where("entity_type = 'bullet'").join(lines, "mention_id", "left").withColumn("m_diameter", F.col("bullet_diameter")).withColumn("m_product_line_id", F.col("product_line_id"))
    as_cartridge = scratch(own.where("entity_type = 'cartridge'").withColumn("m_product_line_id", none), "cartridges")
    columns = ["mention_id", "entity_id", "confidence", "method"]
    loads = resolve.match(as_cartridge, cartridges, config, sku_scope=[("m_caliber", "e_caliber")], score=score, rounded=rounded, blocks=resolve.by_maker_and_caliber(), at=common)
    found = resolve.match(as_bullet, bullets, config, score=score, rounded=rounded, at=common).select(*columns).unionByName(loads.select(*columns))
    found = found.unionByName(resolve.match_rifles(own.where("entity_type = 'rifle'"), rifles, config, name_score, rounded, at=common).select(*columns))
    found = scratch(found, "found_entities")
    makers_line = product_lines(stub, names, common.lines).withColumnRenamed("product_line_id", "m_product_line_id")
    any_line = product_lines(stub.withColumn("m_maker", none), names, common.lines).withColumnRenamed("product_line_id", "m_any_line_id")
    stub = stub.join(makers_line, "mention_id", "left").join(any_line, "mention_id", "left")
    links = resolve.link_bullets(stub, bullets, config, score=score, rounded=rounded, at=common)
    links = links.select("mention_id", "bullet_id", F.col("confidence").alias("bullet_match_confidence"), F.col("method").alias("bullet_match_method"), "outcome")
    out = whole.join(found, "mention_id", "left").join(lines, "mention_id", "left").join(links, "mention_id", "left")
    why = F.when(F.col("outcome") == "weight_mismatch", " (weight mismatch)").when(F.col("outcome") == "low_confidence", " (low confidence)").otherwise("")
    bullet = F.when(F.col("outcome") != "linked", F.concat(F.lit("bullet: "), "bullet_name", why))
    return out.withColumn("unresolved_refs", F.array_compact(F.array_append("unresolved_refs", bullet))).withColumn("matched", F.col("entity_id").isNotNull()).drop("outcome")
