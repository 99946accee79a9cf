"""References of mentions of every type, and reports over the catalogue, on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.functions.text import containment_score
from curatio.operators import orchestrate, reports, resolve, store
from curatio.operators.lookup import names_table
from curatio.plans.curation import CONFIG, ROUND2
from curatio.plans.registry import query, table

# ---- references: brands as makers, types with a number as calibres, types as product lines


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").withColumn("p_bore", F.concat("p_type", F.lit(" "), (F.col("p_size") % 9).cast("string")))


def _dimension(df: DataFrame, column: str, alias: str) -> DataFrame:
    """(id, name, alt_names, maker_id) of a column's distinct values; the id is a check sum of the name."""
    name = F.col(column)
    return df.select(name.alias("name")).distinct().select(F.crc32("name").alias("id"), "name", F.array(F.concat(F.lit(alias), F.crc32("name").cast("string"))).alias("alt_names"), F.lit(None).cast("long").alias("maker_id"))


def _catalogue(spark: SparkSession, sf_dir: str) -> orchestrate.Catalogue:
    part = _parts(spark, sf_dir)
    makers, calibers, lines = _dimension(part, "p_brand", "maker "), _dimension(part, "p_bore", "bore "), _dimension(part, "p_type", "line ")
    text = lambda df: df.select(F.col("id").alias("entity_id"), F.col("name").alias("text"))
    sizes = calibers.select(F.col("id").alias("caliber_id"), F.when(F.col("id") % 5 != 0, F.col("id") % 1000 + 900.0).alias("caliber_diameter"))
    both = calibers.where("id % 3 <> 0").select(F.col("id").alias("caliber_id"), F.explode(F.array(F.struct(F.lit(1).alias("k"), (F.col("id") % 2 == 0).alias("p")), F.struct(F.lit(2).alias("k"), (F.col("id") % 2 != 0).alias("p")))).alias("c"))
    bridge = both.select("caliber_id", (F.col("caliber_id") * 10 + F.col("c.k")).alias("chamber_id"), F.col("c.p").alias("is_primary"))
    return orchestrate.Catalogue(names_table(makers, None, "manufacturer"), text(makers), names_table(calibers, None, "caliber", caliber=True), text(calibers), sizes, bridge, names_table(lines, None, "bullet_product_line"))


def _said(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as mentions of bullets, cartridges and rifles, some with names that nobody knows or none at all."""
    p = _parts(spark, sf_dir)
    key = F.col("p_partkey")
    text = key.cast("string")
    maker = F.when(key % 7 == 0, F.lit(None)).when(key % 7 == 1, F.concat(F.lit("zzz"), (key % 50).cast("string"))).when(key % 7 == 2, F.concat(F.lit("Maker "), F.crc32("p_brand").cast("string"))).otherwise(F.concat(F.upper("p_brand"), F.lit("®")))
    caliber = F.when(key % 5 == 0, F.lit(None)).when(key % 5 == 1, F.concat(F.lit("qqq"), (key % 40).cast("string"))).when(key % 5 == 2, F.concat(F.lit("bore "), F.crc32("p_bore").cast("string"))).otherwise(F.lower("p_bore"))
    diameter = F.when(key % 11 == 0, F.lit(None)).when(key % 11 == 1, F.lit("n/a")).otherwise(F.col("p_retailprice").cast("string"))
    return p.select(
        key.alias("mention_id"), F.when(key % 31 == 0, "scope").when(key % 3 == 0, "bullet").when(key % 3 == 1, "cartridge").otherwise("rifle").alias("entity_type"), maker.alias("maker"), caliber.alias("caliber"), diameter.alias("diameter"),
        F.when(key % 2 == 0, F.col("p_name")).alias("bullet_name"), F.col("p_name").alias("m_name"), F.when(key % 13 == 0, F.concat(F.lit("SKU-"), text)).alias("m_sku"), (F.col("p_size") + F.when(key % 4 == 0, 0.8).otherwise(0.0)).alias("m_weight"),
        F.when(key % 4 == 1, F.col("p_type")).when(key % 4 == 2, F.concat(F.lit("line "), F.crc32("p_type").cast("string"))).alias("m_product_line"), (F.col("p_size") / 50.0).alias("m_g1"), F.lit(None).cast("double").alias("m_g7"),
    )


@query("""
WITH m AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 31 = 0 THEN 'scope' WHEN p_partkey % 3 = 0 THEN 'bullet' WHEN p_partkey % 3 = 1 THEN 'cartridge' ELSE 'rifle' END AS kind, p_brand, p_bore,
  CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 7 = 1 THEN 'zzz' || p_partkey % 50 ELSE p_brand END AS maker, p_partkey % 7 > 1 AS maker_known,
  CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN 'qqq' || p_partkey % 40 ELSE p_bore END AS caliber, p_partkey % 5 > 1 AS caliber_known, p_partkey % 11 AS d FROM (SELECT *, p_type || ' ' || p_size % 9 AS p_bore FROM part)),
r AS (SELECT k, kind, CASE WHEN maker_known THEN p_brand END AS maker_name, CASE WHEN kind IN ('cartridge', 'rifle') AND caliber_known THEN p_bore END AS caliber_name, kind = 'bullet' AND d > 1 AS has_diameter,
  CASE WHEN maker IS NULL THEN 'manufacturer: not extracted' WHEN NOT maker_known THEN 'manufacturer: ' || maker END AS first,
  CASE WHEN kind = 'bullet' AND d = 0 THEN 'bullet_diameter_inches: not extracted' WHEN kind = 'bullet' AND d = 1 THEN 'bullet_diameter_inches: invalid value ''n/a''' WHEN kind IN ('cartridge', 'rifle') AND caliber IS NULL THEN 'caliber: not extracted'
       WHEN kind = 'cartridge' AND NOT caliber_known THEN 'caliber: ' || caliber WHEN kind = 'rifle' AND NOT caliber_known THEN 'chamber (from caliber): ' || caliber END AS second,
  CASE WHEN kind = 'scope' THEN 'Unknown entity type: scope' END AS warnings FROM m)
SELECT k AS mention_id, kind AS entity_type, maker_name, caliber_name, has_diameter, concat_ws('; ', first, second) AS unresolved, coalesce(warnings, '') AS warnings FROM r
""")
def resolve_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maker, calibre and diameter of every mention, and what is missing; each distinct name is looked up once.

    Chambers that no calibre has are left to ``resolve_entities``."""
    at = _catalogue(spark, sf_dir)
    sure = at.calibers.select(F.col("entity_id").alias("caliber_id")).distinct()
    at = orchestrate.Catalogue(at.makers, at.maker_names, at.calibers, at.caliber_names, sure.withColumn("caliber_diameter", F.lit(1.0)), sure.select("caliber_id", F.col("caliber_id").alias("chamber_id"), F.lit(True).alias("is_primary")), at.product_lines)
    out = orchestrate.references(_said(spark, sf_dir), at, CONFIG, score=containment_score, rounded=ROUND2)
    name = lambda names, at: names.select(F.col("entity_id").alias(at), F.col("text").alias(at.replace("_id", "_name")))
    out = out.join(name(at.maker_names, "manufacturer_id").withColumnRenamed("manufacturer_name", "maker_name"), "manufacturer_id", "left").join(name(at.caliber_names, "caliber_id"), "caliber_id", "left")
    return out.select("mention_id", "entity_type", "maker_name", "caliber_name", F.col("bullet_diameter").isNotNull().alias("has_diameter"), F.array_join("unresolved_refs", "; ").alias("unresolved"), F.array_join("warnings", "; ").alias("warnings"))


@query("SELECT p_partkey AS mention_id, p_type AS product_line FROM part WHERE p_partkey % 4 IN (1, 2)")
def product_line_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product line as given, in its short form, or by the name: the first that hits."""
    at, p = _catalogue(spark, sf_dir), table(spark, sf_dir, "part")
    said = _said(spark, sf_dir).withColumn("m_maker", F.lit(None).cast("long"))
    names = _dimension(p, "p_type", "line ").select(F.col("id").alias("product_line_id"), F.col("name").alias("product_line"))
    return orchestrate.product_lines(said, at.product_lines).join(names, "product_line_id").select("mention_id", "product_line")


@query()
def resolve_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every mention through all its references, its match and its bullet, and what is done with it."""
    p, key = _parts(spark, sf_dir), F.col("p_partkey")
    maker, caliber = F.crc32("p_brand"), F.crc32("p_bore")
    code = F.concat(F.lit("SKU-"), key.cast("string")).alias("e_sku")
    columns = [key.alias("entity_id"), F.col("p_name").alias("e_name"), maker.alias("e_maker"), F.col("p_size").cast("double").alias("e_weight"), code, F.col("p_type").alias("e_product_line"), F.crc32("p_type").alias("e_product_line_id"), (F.col("p_size") / 50.0).alias("e_g1"), F.lit(None).cast("double").alias("e_g7")]
    bullets = p.select(*columns, F.col("p_retailprice").alias("e_diameter"))
    cartridges = p.select(*columns, F.lit(None).cast("double").alias("e_diameter"), caliber.alias("e_caliber"))
    rifles = p.select(key.alias("entity_id"), F.col("p_name").alias("e_name"), maker.alias("e_maker"), (caliber * 10 + 1).alias("e_chamber"))
    out = orchestrate.resolved(_said(spark, sf_dir), _catalogue(spark, sf_dir), bullets, cartridges, rifles, CONFIG, score=containment_score, name_score=containment_score, rounded=ROUND2)
    of = p.select(key.alias("entity_id"), F.col("p_size").cast("double").alias("target_weight"))
    sizes = p.select(key.alias("bullet_id"), F.col("p_retailprice").alias("linked_diameter"))
    out = out.join(of, "entity_id", "left").join(sizes, "bullet_id", "left")
    no = F.lit(False)
    out = out.withColumns({"rejected": no, "excluded_caliber": no, "orphan_diameter": no, "target_locked": no, "weight": F.col("m_weight"), "old_bullet_id": F.lit(None).cast("long"), "bullet_diameter": F.col("linked_diameter")})
    return store.decided(out, CONFIG).select("mention_id", "entity_type", "entity_id", "confidence", "method", "product_line_id", "bullet_id", "bullet_match_confidence", "bullet_match_method", "unresolved_refs", "action")


# ---- reports: nations as calibres, parts as bullets, customers as cartridges, suppliers as rifles


@query("""
WITH c AS (SELECT n_nationkey AS id, n_name AS name, n_nationkey + 1 AS rank, (n_nationkey % 60) / 2.0::DOUBLE AS d FROM nation WHERE n_nationkey % 4 <> 0),
b AS (SELECT p_size / 2.0::DOUBLE AS d, count(*) AS n FROM part GROUP BY 1), k AS (SELECT c_nationkey AS id, count(*) AS n FROM customer GROUP BY 1)
SELECT rank, name, coalesce(b.n, 0) AS n_bullets, coalesce(k.n, 0) AS n_cartridges, (SELECT count(*) FROM supplier WHERE s_nationkey IN (c.id, (c.id + 1) % 25)) AS n_rifles FROM c LEFT JOIN b USING (d) LEFT JOIN k USING (id)
""")
def caliber_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each ranked calibre's bullets, cartridges and rifles: three aggregates, joined."""
    n, key = table(spark, sf_dir, "nation"), F.col("n_nationkey")
    calibers = n.select(key.alias("caliber_id"), F.col("n_name").alias("name"), F.when(key % 4 != 0, key + 1).alias("rank"), ((key % 60) / 2.0).alias("diameter"))
    bridge = n.select(key.alias("caliber_id"), F.explode(F.array(key, (key + 1) % 25, key)).alias("chamber_id"))
    bullets = table(spark, sf_dir, "part").select((F.col("p_size") / 2.0).alias("diameter"))
    return reports.caliber_coverage(calibers, bullets, table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("caliber_id")), table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("chamber_id")), bridge)


@query("""
WITH x AS (SELECT p_partkey AS k, p_partkey % 17 = 0 AS declined, p_partkey % 13 = 0 AS absent, p_partkey % 6 = 0 AS locked, p_size::DOUBLE AS w, CASE WHEN p_partkey % 5 = 0 THEN p_size + 3.0::DOUBLE WHEN p_partkey % 5 = 1 THEN NULL ELSE p_size::DOUBLE END AS kw,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 0.5::DOUBLE END AS g, CASE WHEN p_partkey % 4 = 0 THEN 0.6::DOUBLE ELSE 0.505::DOUBLE END AS kg, p_partkey % 10 = 7 AS coded FROM part),
d AS (SELECT *, NOT declined AND NOT absent AS here, coalesce(abs(w - kw) > greatest(0.01, 0.01 * greatest(w, kw)), TRUE) AS dw, g IS NOT NULL AND abs(g - kg) > 0.01 AS dg FROM x),
o AS (SELECT CASE WHEN declined THEN 'declined' WHEN absent THEN 'not_in_catalogue' WHEN dw OR dg OR coded THEN 'diff' ELSE 'match' END AS outcome, here AND locked AS locked, CASE WHEN here THEN concat_ws(',', CASE WHEN dw THEN 'weight' END, CASE WHEN dg THEN 'bc_g1' END, CASE WHEN coded THEN 'sku' END) ELSE '' END AS diffs FROM d)
SELECT outcome, locked, diffs, count(*) AS n FROM o GROUP BY ALL
""")
def parser_vs_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed numbers against the catalogue's: matches, differences by field, pages not there, locked rows."""
    p, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    url = F.concat(F.lit("https://x.example/"), key.cast("string")).alias("url")
    size = F.col("p_size").cast("double")
    parsed = p.select(url, (key % 17 == 0).alias("declined"), size.alias("weight"), F.when(key % 3 != 0, 0.5).alias("bc_g1"), key.cast("string").alias("sku"))
    weight = F.when(key % 5 == 0, size + 3.0).when(key % 5 != 1, size)
    known = p.where("p_partkey % 13 <> 0").select(url, (key % 6 == 0).alias("is_locked"), weight.alias("weight"), F.when(key % 4 == 0, 0.6).otherwise(0.505).alias("bc_g1"), F.when(key % 10 == 7, "other").when(key % 10 != 8, key.cast("string")).alias("sku"))
    out = reports.against_catalogue(parsed, known, ["weight", "bc_g1"], asked=["bc_g1"], codes=["sku"])
    return out.groupBy("outcome", "locked", F.array_join("diffs", ",").alias("diffs")).agg(F.count("*").alias("n"))


FLAGGED = "WITH f AS (SELECT CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS reason, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS status FROM orders)"


@query(FLAGGED + " SELECT 'reason' AS by, coalesce(reason, 'unknown') AS value, count(*) AS n FROM f GROUP BY ALL UNION ALL SELECT 'status', coalesce(status, 'pending'), count(*) FROM f GROUP BY ALL")
def flags_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged items by reason and by status, in one pass."""
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    return reports.flag_counts(o.select(F.when(key % 5 != 0, F.col("o_orderpriority")).alias("reason"), F.when(key % 3 != 0, F.col("o_orderstatus")).alias("status")))


@query("""
WITH l AS (SELECT o_custkey AS id, max(o_orderdate::DATE) AS last_verified FROM orders WHERE o_totalprice > 300000 GROUP BY 1)
SELECT c_custkey AS id, last_verified FROM customer LEFT JOIN l ON id = c_custkey WHERE last_verified IS NULL OR last_verified < DATE '1998-01-01' - 30 ORDER BY last_verified NULLS FIRST, c_custkey LIMIT 15
""")
def verify_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to check by hand next: the never verified, then the longest ago; a top-k, with no full sort."""
    log = table(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("id"), F.col("o_orderdate").cast("date").alias("verified"))
    return reports.next_to_verify(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), log, F.to_date(F.lit("1998-01-01")), 15)


@query("""
WITH n AS (SELECT p_partkey, p_size + 0.5::DOUBLE AS w, CASE WHEN p_partkey % 4 = 0 THEN 270 ELSE 224 + p_size END AS d, p_size / 100.0::DOUBLE AS g FROM part)
SELECT p_partkey AS id, w AS note_weight, CASE WHEN p_partkey % 2 = 0 THEN g END AS note_g1, CASE WHEN p_partkey % 3 = 0 THEN g END AS note_g7, d / 1000.0::DOUBLE AS note_diameter, CASE WHEN d = 270 THEN TRUE ELSE d <= 285 END AS same FROM n
""")
def numbers_in_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, coefficients and diameter read from free text, and whether the diameter is the one on file."""
    p, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    d = F.when(key % 4 == 0, 270).otherwise(F.col("p_size") + 224)
    caliber = F.when(key % 4 == 1, F.format_string('6.5mm (.%d")', d)).otherwise(F.format_string(".%d / CAL", d))
    g = F.format_string("%.2f", F.col("p_size") / 100.0)
    notes = F.concat_ws(", ", F.format_string("%.1f Gr", F.col("p_size") + 0.5), F.when(key % 2 == 0, F.concat(F.lit("G1 BC: "), g)), F.when(key % 3 == 0, F.concat(F.lit("g7="), g)))
    rows = reports.note_numbers(p.select(key.alias("id"), caliber.alias("caliber"), notes.alias("notes"), d.alias("d")))
    actual = F.when(F.col("d") == 270, 0.277).otherwise(F.least(F.col("d") / 1000.0, F.lit(0.2775)))
    return rows.withColumn("same", reports.same_diameter(F.col("note_diameter"), actual)).select("id", "note_weight", "note_g1", "note_g7", "note_diameter", "same")
