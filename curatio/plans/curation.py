"""Unit repair, agreement, resolution, decisions and changes, on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.functions.numbers import lenient_float
from curatio.functions.text import containment_score, normalize_lookup
from curatio.operators import quality, rank, resolve, store, upsert
from curatio.operators.lookup import lookup, names_table
from curatio.plans.registry import query, table

# ---- units, ranges, agreement

MEASURED = """
WITH m AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN replace(CAST(l_quantity / 4 AS VARCHAR), '.', ',') ELSE CAST(l_quantity * 10 AS VARCHAR) END AS weight_grains,
  CAST(l_extendedprice / 20 AS VARCHAR) AS muzzle_velocity_fps FROM lineitem),
x AS (SELECT *, try_cast(replace(weight_grains, ',', '.') AS DOUBLE) AS w, try_cast(muzzle_velocity_fps AS DOUBLE) AS v FROM m)
"""


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as measurements: some weights in grams with a decimal comma, velocities of all sizes."""
    line = table(spark, sf_dir, "lineitem")
    odd = F.replace((F.col("l_quantity") / 4).cast("string"), F.lit("."), F.lit(","))
    weight = F.when(F.col("l_linenumber") % 3 == 0, odd).otherwise((F.col("l_quantity") * 10).cast("string"))
    return line.select("l_orderkey", "l_linenumber", weight.alias("weight_grains"), (F.col("l_extendedprice") / 20).cast("string").alias("muzzle_velocity_fps"))


@query(
    MEASURED
    + """, n AS (SELECT *, CASE WHEN w BETWEEN 15 AND 750 THEN w WHEN w * 15.4324::DOUBLE BETWEEN 15 AND 750 THEN w * 15.4324::DOUBLE END AS wn,
  CASE WHEN v BETWEEN 400 AND 4000 THEN v WHEN v * 3.28084::DOUBLE BETWEEN 400 AND 4000 THEN v * 3.28084::DOUBLE END AS vn FROM x)
SELECT wn IS NULL AS rejected, (CASE WHEN w BETWEEN 15 AND 750 THEN 0 ELSE 1 END) + (CASE WHEN v BETWEEN 400 AND 4000 THEN 0 ELSE 1 END) AS n_events, count(*) AS n,
  round(sum(wn), 3) AS weight, round(sum(vn), 2) AS velocity FROM n GROUP BY 1, 2"""
)
def unit_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mistaken units repaired, values beyond repair nulled, rows without a critical value rejected."""
    rules = quality.rules_for("bullet", ["weight_grains", "muzzle_velocity_fps"])
    out = quality.normalized(_measured(spark, sf_dir), rules).withColumn("n_events", F.size("events"))
    return out.groupBy("rejected", "n_events").agg(F.count("*").alias("n"), F.round(F.sum("weight_grains"), 3).alias("weight"), F.round(F.sum("muzzle_velocity_fps"), 2).alias("velocity"))


@query(MEASURED + "SELECT array_to_string(list_filter([CASE WHEN NOT w BETWEEN 15 AND 750 THEN 'weight_grains' END, CASE WHEN NOT v BETWEEN 400 AND 4000 THEN 'muzzle_velocity_fps' END], lambda c: c IS NOT NULL), ',') AS warnings, count(*) AS n FROM x GROUP BY 1")
def range_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.range_warnings(_measured(spark, sf_dir), quality.rules_for("cartridge", ["weight_grains", "muzzle_velocity_fps"]))
    return out.groupBy(F.array_join("warnings", ",").alias("warnings")).agg(F.count("*").alias("n"))


@query("""
SELECT p_partkey, t AS bc_type, v AS bc_value FROM (
  SELECT p_partkey, 'g1' AS t, nullif(p_size / 50.0::DOUBLE, 1.0) AS v FROM part UNION ALL SELECT p_partkey, 'g7', CASE WHEN p_size % 2 = 0 THEN p_size / 100.0::DOUBLE END FROM part) WHERE v IS NOT NULL
""")
def unpivot_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide measurements to one row per source, without a join or a shuffle."""
    wide = table(spark, sf_dir, "part").select("p_partkey", F.nullif(F.col("p_size") / 50.0, F.lit(1.0)).alias("g1"), F.when(F.col("p_size") % 2 == 0, F.col("p_size") / 100.0).alias("g7"))
    return wide.unpivot("p_partkey", ["g1", "g7"], "bc_type", "bc_value").where("bc_value is not null")


@query("SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) % 5 AS k, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY 1, 2")
def schema_json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field of a JSON document, read once as a variant."""
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return table(spark, sf_dir, "events").groupBy("event_type", (k % 5).alias("k")).agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"))


@query("""
WITH r AS (SELECT l_orderkey, l_quantity AS a1, CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber % 2 = 0 THEN l_quantity * 1.004 ELSE l_quantity * 1.02 END AS b1,
  CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_tax END AS a2, CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_tax + 0.005 END AS b2 FROM lineitem),
u AS (SELECT 'quantity' AS field, a1 AS a, b1 AS b FROM r UNION ALL SELECT 'tax', a2, b2 FROM r),
c AS (SELECT field, CASE WHEN a IS NULL AND b IS NULL THEN 'both_null' WHEN a IS NULL THEN 'first_null' WHEN b IS NULL THEN 'second_null'
  WHEN abs(a - b) <= greatest(0.01, 0.005 * greatest(abs(a), abs(b))) THEN 'agree' ELSE 'disagree' END AS k FROM u)
SELECT field, count(*) FILTER (WHERE k = 'agree') AS agree, count(*) FILTER (WHERE k = 'disagree') AS disagree, count(*) FILTER (WHERE k = 'first_null') AS first_null,
  count(*) FILTER (WHERE k = 'second_null') AS second_null, count(*) FILTER (WHERE k = 'both_null') AS both_null,
  round(100.0 * count(*) FILTER (WHERE k = 'agree') / count(*) FILTER (WHERE k IN ('agree', 'disagree')), 2) AS pct_agree FROM c GROUP BY field
""")
def field_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources' fields within tolerance, by five classes."""
    line = table(spark, sf_dir, "lineitem")
    b1 = F.when(F.col("l_linenumber") == 1, None).when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity") * 1.004).otherwise(F.col("l_quantity") * 1.02)
    rows = line.select(F.col("l_quantity").alias("a1"), b1.alias("b1"), F.when(F.col("l_returnflag") != "R", F.col("l_tax")).alias("a2"), F.when(F.col("l_linestatus") != "F", F.col("l_tax") + 0.005).alias("b2"))
    return quality.field_agreement(rows, {"quantity": ("a1", "b1"), "tax": ("a2", "b2")})


@query("""
SELECT l_partkey, f AS finding, count(*) AS n FROM (
  SELECT l_partkey, unnest(list_filter([CASE WHEN l_discount > 0.09 THEN 'high_discount' END, CASE WHEN l_quantity = 0 THEN 'zero_quantity' END, CASE WHEN l_extendedprice / l_quantity NOT BETWEEN 905 AND 2090 THEN 'price_out_of_band' END], lambda c: c IS NOT NULL)) AS f FROM lineitem)
GROUP BY 1, 2
""")
def implausible_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings from a table of checks, in one pass."""
    checks = {"high_discount": F.col("l_discount") > 0.09, "zero_quantity": F.col("l_quantity") == 0, "price_out_of_band": ~F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).between(905, 2090)}
    return quality.findings(table(spark, sf_dir, "lineitem"), "l_partkey", checks).groupBy("l_partkey", "finding").agg(F.count("*").alias("n"))


@query("""
WITH a AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_discount > 0.09 AND l_shipdate < TIMESTAMP '1997-01-01'), b AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_discount > 0.09 AND l_shipdate >= TIMESTAMP '1997-01-01')
SELECT coalesce(a.l_partkey, b.l_partkey) AS l_partkey, CASE WHEN a.l_partkey IS NULL THEN 'new' WHEN b.l_partkey IS NULL THEN 'resolved' ELSE 'known' END AS state FROM a FULL JOIN b ON a.l_partkey = b.l_partkey
""")
def issue_state_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").where("l_discount > 0.09")
    return quality.issue_states(line.where("l_shipdate < '1997-01-01'"), line.where("l_shipdate >= '1997-01-01'"), ["l_partkey"])


@query("SELECT p_name, p_brand, p_size, count(*) AS n, min(p_partkey) AS first_key FROM part GROUP BY 1, 2, 3 HAVING count(*) > 1")
def duplicate_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_name", "p_brand", "p_size").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_key")).where("n > 1")


@query("""
SELECT l_partkey, count(*) AS sources, round((max(u) - min(u)) / max(u), 6) AS divergence FROM (SELECT l_partkey, l_extendedprice / l_quantity AS u FROM lineitem) GROUP BY l_partkey HAVING count(*) = 1 OR (max(u) - min(u)) / max(u) > 0.10
""")
def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values whose sources diverge by over a tenth, or that have one source only."""
    u = table(spark, sf_dir, "lineitem").select("l_partkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("u"))
    spread = (F.max("u") - F.min("u")) / F.max("u")
    return u.groupBy("l_partkey").agg(F.count("*").alias("sources"), F.round(spread, 6).alias("divergence"), spread.alias("x")).where("sources = 1 or x > 0.10").drop("x")


# ---- lookup and matching

NORM = r"trim(regexp_replace(regexp_replace(lower(trim(translate({0}, '®™©', ''))), '[^\p{{L}}\p{{N}}_\s.]', ' ', 'g'), '\s+', ' ', 'g'))"
SAID = """CASE s_suppkey % 4 WHEN 0 THEN upper(s_name) || '®' WHEN 1 THEN 'SUP ' || s_suppkey WHEN 2 THEN 'alias-' || s_suppkey ELSE 'nobody ' || s_suppkey END"""


@query(f"""
WITH n AS (
  SELECT {NORM.format("s_name")} AS norm, s_suppkey AS entity_id, 'exact_name' AS method, 1.0::DOUBLE AS confidence, 1 AS tier FROM supplier UNION ALL
  SELECT {NORM.format("'sup ' || s_suppkey")}, s_suppkey, 'alt_name', 0.95::DOUBLE, 2 FROM supplier UNION ALL
  SELECT {NORM.format("'alias ' || s_suppkey")}, s_suppkey, 'entity_alias', 0.90::DOUBLE, 3 FROM supplier WHERE s_suppkey % 2 = 0),
m AS (SELECT s_suppkey AS mention_id, {SAID} AS name FROM supplier),
h AS (SELECT mention_id, name, n.*, row_number() OVER (PARTITION BY mention_id ORDER BY tier, entity_id) AS r FROM m LEFT JOIN n ON norm = {NORM.format("name")} AND norm <> '')
SELECT mention_id, name, entity_id, method, confidence FROM h WHERE r = 1
""")
def lookup_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names found as they are, as an alternative, or as a learned alias; one hash join for all."""
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("string")
    entities = s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.array(F.concat(F.lit("sup "), key)).alias("alt_names"), F.lit(None).cast("long").alias("maker_id"))
    aliases = s.where("s_suppkey % 2 = 0").select(F.lit("manufacturer").alias("entity_type"), F.col("s_suppkey").alias("entity_id"), F.concat(F.lit("alias "), key).alias("alias"))
    k = F.col("s_suppkey") % 4
    said = F.when(k == 0, F.concat(F.upper("s_name"), F.lit("®"))).when(k == 1, F.concat(F.lit("SUP "), key)).when(k == 2, F.concat(F.lit("alias-"), key)).otherwise(F.concat(F.lit("nobody "), key))
    return lookup(s.select(F.col("s_suppkey").alias("mention_id"), said.alias("name")), names_table(entities, aliases, "manufacturer"))


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as known entities."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("entity_id"), F.col("p_name").alias("e_name"), F.col("p_brand").alias("e_maker"), F.col("p_retailprice").alias("e_diameter"), F.col("p_size").cast("double").alias("e_weight"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("e_sku"), F.col("p_type").alias("e_product_line"), F.lit(None).cast("long").alias("e_product_line_id"), (F.col("p_size") / 50.0).alias("e_g1"), F.lit(None).cast("double").alias("e_g7"),
    )


def _mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as they might be mentioned: some with a stock code, names in other words, weights a little off, makers missing."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return p.select(
        key.alias("mention_id"), F.concat(F.upper("p_name"), F.lit("® bullets")).alias("m_name"), F.when(key % 7 != 0, F.col("p_brand")).alias("m_maker"), F.col("p_retailprice").alias("m_diameter"),
        (F.col("p_size") + F.when(key % 5 == 0, 3.0).when(key % 5 == 1, 0.8).otherwise(0.0)).alias("m_weight"), F.when(key % 11 == 0, F.concat(F.lit("SKU-"), key.cast("string"))).alias("m_sku"),
        F.lit(None).cast("string").alias("m_product_line"), F.lit(None).cast("long").alias("m_product_line_id"), (F.col("p_size") / 50.0).alias("m_g1"), F.lit(None).cast("double").alias("m_g7"),
    )


CONFIG = resolve.Config(bullet_diameter_tolerance_inches=0.35)
ROUND2 = lambda x: F.round(x, 2)  # noqa: E731  half up: no score in these data lies on a half


@query("""
WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS t, p_brand, p_retailprice AS d, p_size::DOUBLE AS s, p_type FROM part),
m AS (SELECT p_partkey AS id, t, CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS maker, d, s + CASE WHEN p_partkey % 5 = 0 THEN 3.0 WHEN p_partkey % 5 = 1 THEN 0.8 ELSE 0.0 END AS s, p_partkey % 11 = 0 AS coded FROM w),
c AS (SELECT m.id, e.p_partkey AS e, abs(m.s - e.s) AS g, len(list_intersect(list_distinct(m.t), list_distinct(e.t)))::DOUBLE / len(list_distinct(m.t)) * (0.5 + 0.5 * least(len(list_distinct(m.t)) / 2.0::DOUBLE, 1.0)) AS sc
  FROM m JOIN w e ON abs(m.d - e.d) <= 0.35 AND (m.maker IS NULL OR m.maker = e.p_brand) WHERE NOT m.coded),
sc AS (SELECT id, e, round(0.85::DOUBLE + sc * 0.1::DOUBLE, 2) AS conf, 'composite_key' AS method, 3 AS tier FROM c WHERE g < 0.5 AND sc > 0.55 UNION ALL
       SELECT id, e, round(sc * CASE WHEN g <= 1.0 THEN 0.8::DOUBLE ELSE 0.4::DOUBLE END, 2), 'fuzzy_name', 4 FROM c WHERE sc > 0.5),
o AS (SELECT *, row_number() OVER (PARTITION BY id, e ORDER BY conf DESC, tier) AS k FROM sc),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY conf DESC, tier, e) AS r FROM o WHERE k = 1)
SELECT id AS mention_id, id AS entity_id, 1.0::DOUBLE AS confidence, 'exact_sku' AS method, 0 AS n_alternatives, NULL AS runner_up FROM m WHERE coded UNION ALL
SELECT id, max(CASE WHEN r = 1 THEN e END), max(CASE WHEN r = 1 THEN conf END), max(CASE WHEN r = 1 THEN method END), least(count(*) - 1, 3), max(CASE WHEN r = 2 THEN e END) FROM r GROUP BY id
""")
def resolve_best_with_alternatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions matched in tiers, with runners-up: blocking by maker and band, no nested loops."""
    out = resolve.match(_mentions(spark, sf_dir), _entities(spark, sf_dir), CONFIG, score=containment_score, rounded=ROUND2)
    return out.select("mention_id", "entity_id", "confidence", "method", F.size("alternatives").alias("n_alternatives"), F.try_element_at("alternatives", F.lit(1))["entity_id"].alias("runner_up"))


@query()
def resolve_with_token_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with token-set similarity and binary rounding (Arrow): no LCS in SQL."""
    return resolve.match(_mentions(spark, sf_dir), _entities(spark, sf_dir), CONFIG).select("mention_id", "entity_id", "confidence", "method", "is_ambiguous")


@query()
def two_pass_bullet_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own maker first, then all makers, a weight gate, a strict retry without the diameter, and a boost."""
    return resolve.link_bullets(_mentions(spark, sf_dir), _entities(spark, sf_dir), CONFIG, score=containment_score, rounded=ROUND2)


@query("""
WITH a AS (SELECT l_orderkey, l_partkey, l_suppkey, p_size::DOUBLE + CASE WHEN l_linenumber % 2 = 0 THEN 0.4 ELSE 0.6 END AS w, p_size::DOUBLE AS pw, p_size / 50.0::DOUBLE AS g, p_size / 50.0::DOUBLE + CASE WHEN l_linenumber % 3 = 0 THEN 0.01 ELSE 0 END AS lg FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT round(least(0.93::DOUBLE + CASE WHEN abs(w - pw) <= 0.5 THEN 0.05 ELSE 0 END + CASE WHEN abs(lg - g) < 0.0005 THEN 0.05 ELSE 0 END, 1.0), 4) AS confidence, count(*) AS n FROM a GROUP BY 1
""")
def confidence_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("e_weight"), (F.col("p_size") / 50.0).alias("e_g1"), F.lit(None).cast("double").alias("e_g7"))
    at = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    at = at.withColumn("m_weight", F.col("e_weight") + F.when(F.col("l_linenumber") % 2 == 0, 0.4).otherwise(0.6)).withColumn("m_g1", F.col("e_g1") + F.when(F.col("l_linenumber") % 3 == 0, 0.01).otherwise(0.0)).withColumn("m_g7", F.lit(None).cast("double"))
    return at.select(F.round(F.least(F.lit(0.93) + resolve.boost(), F.lit(1.0)), 4).alias("confidence")).groupBy("confidence").agg(F.count("*").alias("n"))


# ---- decisions

RESOLVED = """
WITH d AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN 'bullet' WHEN l_linenumber % 3 = 1 THEN 'cartridge' ELSE 'rifle' END AS entity_type,
  l_quantity > 3 AS matched, l_quantity / 50 AS confidence, l_tax > 0.079 AS rejected, l_discount > 0.099 AS excluded_caliber, l_suppkey % 17 = 0 AS orphan_diameter, l_suppkey % 5 = 0 AS target_locked,
  l_quantity AS weight, CASE WHEN l_linenumber % 2 = 0 THEN l_quantity ELSE l_quantity + 5 END AS target_weight, l_partkey % 4 = 0 AS unresolved,
  CASE WHEN l_partkey % 3 <> 0 THEN l_partkey END AS bullet_id, CASE WHEN l_partkey % 2 = 0 THEN l_partkey END AS old_bullet_id, CASE WHEN l_suppkey % 3 = 0 THEN 0.308 ELSE 0.300 END AS bd FROM lineitem),
a AS (SELECT *, CASE WHEN rejected THEN 'rejected_normalization' WHEN excluded_caliber THEN 'rejected_caliber' WHEN entity_type = 'bullet' AND orphan_diameter THEN 'rejected_orphan_diameter'
  WHEN matched AND confidence >= 0.7 AND target_locked THEN 'skipped_locked'
  WHEN matched AND confidence >= 0.7 AND entity_type = 'cartridge' AND bullet_id IS NOT NULL AND bullet_id IS DISTINCT FROM old_bullet_id AND abs(bd - 0.308) > 0.005 THEN 'blocked_cross_diameter'
  WHEN matched AND confidence >= 0.7 AND entity_type = 'cartridge' AND bullet_id IS NOT NULL AND bullet_id IS DISTINCT FROM old_bullet_id THEN 'matched_updated'
  WHEN matched AND confidence >= 0.7 THEN 'matched_existing'
  WHEN matched AND confidence < 0.5 AND NOT unresolved AND weight > 0 AND abs(weight - target_weight) > CASE WHEN entity_type = 'bullet' THEN 1.0 ELSE 2.0 END THEN 'created_variant'
  WHEN matched THEN 'flagged_low_confidence' WHEN unresolved OR (entity_type = 'cartridge' AND bullet_id IS NULL) THEN 'flagged_unresolved' ELSE 'created' END AS action FROM d)
"""


def _decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    k = F.col("l_linenumber") % 3
    rows = line.select(
        "l_orderkey", "l_linenumber", F.when(k == 0, "bullet").when(k == 1, "cartridge").otherwise("rifle").alias("entity_type"), (F.col("l_quantity") > 3).alias("matched"), (F.col("l_quantity") / 50).alias("confidence"),
        (F.col("l_tax") > 0.079).alias("rejected"), (F.col("l_discount") > 0.099).alias("excluded_caliber"), (F.col("l_suppkey") % 17 == 0).alias("orphan_diameter"), (F.col("l_suppkey") % 5 == 0).alias("target_locked"),
        F.col("l_quantity").alias("weight"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity")).otherwise(F.col("l_quantity") + 5).alias("target_weight"),
        F.when(F.col("l_partkey") % 4 == 0, F.array(F.lit("caliber: x"))).otherwise(F.array().cast("array<string>")).alias("unresolved_refs"),
        F.when(F.col("l_partkey") % 3 != 0, F.col("l_partkey")).alias("bullet_id"), F.when(F.col("l_partkey") % 2 == 0, F.col("l_partkey")).alias("old_bullet_id"),
        F.when(F.col("l_suppkey") % 3 == 0, 0.308).otherwise(0.300).alias("bullet_diameter"), F.lit(0.308).alias("caliber_diameter"), F.when(F.col("l_quantity") > 40, "composite_key").otherwise("fuzzy_name").alias("method"),
    )
    return store.decided(rows)


@query(RESOLVED + "SELECT l_orderkey, l_linenumber, action FROM a")
def decision_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One action per mention, first that applies."""
    return _decided(spark, sf_dir).select("l_orderkey", "l_linenumber", "action")


@query(RESOLVED + "SELECT entity_type, action, count(*) AS n FROM a GROUP BY 1, 2")
def action_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.action_counts(_decided(spark, sf_dir))


@query(
    RESOLVED
    + """, m AS (SELECT entity_type, CASE WHEN weight > 40 THEN 'composite_key' ELSE 'fuzzy_name' END AS method, confidence FROM a WHERE matched)
SELECT entity_type, method, count(*) AS n, round(avg(confidence), 4) AS avg_confidence, count(*) FILTER (WHERE confidence < 0.5) AS n_low, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY entity_type), 2) AS share_pct FROM m GROUP BY 1, 2"""
)
def method_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.method_telemetry(_decided(spark, sf_dir))


@query(f"""
WITH d AS (SELECT s_suppkey AS id, s_name, CASE s_suppkey % 3 WHEN 0 THEN 'The ' || s_name WHEN 1 THEN s_name || '®' ELSE 'known ' || s_suppkey END AS name, 0.7 + (s_suppkey % 30) / 100.0::DOUBLE AS c, s_suppkey % 2 = 0 AS amb FROM supplier),
n AS (SELECT *, {NORM.format("name")} AS norm FROM d)
SELECT 'manufacturer' AS entity_type, id AS entity_id, norm, name AS alias, round(c, 4) AS confidence, c > 0.85 AND NOT amb AS promote FROM n WHERE norm <> '' AND norm <> {NORM.format("s_name")} AND NOT starts_with(norm, 'known')
""")
def alias_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a match by likeness teaches, unless it is known already."""
    s = table(spark, sf_dir, "supplier")
    key, k = F.col("s_suppkey").cast("string"), F.col("s_suppkey") % 3
    name = F.when(k == 0, F.concat(F.lit("The "), "s_name")).when(k == 1, F.concat("s_name", F.lit("®"))).otherwise(F.concat(F.lit("known "), key))
    d = s.select(F.lit("manufacturer").alias("entity_type"), F.col("s_suppkey").alias("entity_id"), name.alias("name"), F.col("s_name").alias("canonical_name"), F.lit("fuzzy_name").alias("method"), (0.7 + (F.col("s_suppkey") % 30) / 100.0).alias("confidence"), (F.col("s_suppkey") % 2 == 0).alias("is_ambiguous"))
    known = s.select(F.lit("manufacturer").alias("entity_type"), F.col("s_suppkey").alias("entity_id"), normalize_lookup(F.concat(F.lit("known "), key)).alias("norm"))
    return store.alias_suggestions(d, known).withColumn("confidence", F.round("confidence", 4))


# ---- changes

OPERATIONS = """
WITH ops AS (SELECT c_custkey + 1000000 AS c_custkey, 'create' AS op, c_name, c_acctbal FROM customer WHERE c_custkey % 10 = 0 UNION ALL SELECT c_custkey, 'create', c_name, c_acctbal FROM customer WHERE c_custkey % 10 = 1 UNION ALL
  SELECT c_custkey, 'update', NULL, c_acctbal + 1 FROM customer WHERE c_custkey % 10 = 2 UNION ALL SELECT c_custkey, 'update', c_name, NULL FROM customer WHERE c_custkey % 10 = 3 UNION ALL SELECT -1 - c_custkey, 'update', 'x', NULL FROM customer WHERE c_custkey % 10 = 4 UNION ALL
  SELECT c_custkey, 'delete', NULL, NULL FROM customer WHERE c_custkey % 10 = 5 UNION ALL SELECT -1 - c_custkey, 'delete', NULL, NULL FROM customer WHERE c_custkey % 10 = 6),
o AS (SELECT ops.*, CASE WHEN op = 'create' THEN CASE WHEN c.c_custkey IS NULL THEN 'CREATE' ELSE 'SKIP' END
  WHEN op = 'update' THEN CASE WHEN c.c_custkey IS NULL THEN 'ERROR' WHEN (ops.c_name IS NOT NULL AND ops.c_name IS DISTINCT FROM c.c_name) OR (ops.c_acctbal IS NOT NULL AND ops.c_acctbal IS DISTINCT FROM c.c_acctbal) THEN 'UPDATE' ELSE 'SKIP' END
  WHEN c.c_custkey IS NULL THEN 'SKIP' WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = ops.c_custkey AND o_totalprice > 400000) THEN 'ERROR' ELSE 'DELETE' END AS outcome FROM ops LEFT JOIN customer c ON c.c_custkey = ops.c_custkey)
"""


def _operations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    none, nothing = F.lit(None).cast("string"), F.lit(None).cast("double")
    k, key = F.col("c_custkey") % 10, F.col("c_custkey")
    made = lambda m, at, op, name, bal: c.where(k == m).select(at.alias("c_custkey"), F.lit(op).alias("op"), name.alias("c_name"), bal.alias("c_acctbal"))
    parts = [made(0, key + 1000000, "create", F.col("c_name"), F.col("c_acctbal")), made(1, key, "create", F.col("c_name"), F.col("c_acctbal")), made(2, key, "update", none, F.col("c_acctbal") + 1), made(3, key, "update", F.col("c_name"), nothing)]
    parts += [made(4, -1 - key, "update", F.lit("x"), nothing), made(5, key, "delete", none, nothing), made(6, -1 - key, "delete", none, nothing)]
    ops = parts[0]
    for p in parts[1:]:
        ops = ops.unionByName(p)
    blocked = table(spark, sf_dir, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return c, upsert.classified(c, ops, ["c_custkey"], ["c_name", "c_acctbal"], blocked)


@query(OPERATIONS + "SELECT c_custkey, op, c_name, c_acctbal, outcome FROM o")
def upsert_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _operations(spark, sf_dir)[1]


@query(
    OPERATIONS
    + """SELECT c.c_custkey, coalesce(o.c_name, c.c_name) AS c_name, coalesce(o.c_acctbal, c.c_acctbal) AS c_acctbal FROM customer c LEFT JOIN o ON o.c_custkey = c.c_custkey AND outcome IN ('UPDATE', 'DELETE') WHERE outcome IS DISTINCT FROM 'DELETE'
UNION ALL SELECT c_custkey, c_name, c_acctbal FROM o WHERE outcome = 'CREATE'"""
)
def upsert_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, outcomes = _operations(spark, sf_dir)
    return upsert.applied(rows, outcomes, ["c_custkey"], ["c_name", "c_acctbal"])


@query("WITH o AS (SELECT url, page_id FROM pages WHERE page_id % 3 <> 0), n AS (SELECT url, page_id + 5000 AS page_id FROM pages WHERE page_id % 2 = 0) SELECT * FROM o UNION ALL SELECT * FROM n WHERE url NOT IN (SELECT url FROM o)")
def manifest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("url", "page_id")
    return upsert.merged_by_url(p.where("page_id % 3 != 0"), p.where("page_id % 2 = 0").withColumn("page_id", F.col("page_id") + 5000))


@query("WITH b AS (SELECT doc_id, quality, 0 AS p FROM labels WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, 1 - quality, 1 FROM labels) SELECT doc_id, arg_min(quality, p * 10 + quality) AS quality FROM b GROUP BY doc_id")
def flag_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return upsert.merged_flags(flags.where("doc_id % 2 = 0"), flags.withColumn("quality", 1 - F.col("quality")), "doc_id")


@query("SELECT o_orderkey, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE CAST(left(o_orderpriority, 1) AS INT) END AS priority FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED' AND CAST(left(o_orderpriority, 1) AS INT) <= 3 ORDER BY priority, o_orderkey LIMIT 50")
def priority_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work by priority, then position; the limit last."""
    p = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.left("o_orderpriority", F.lit(1)).cast("int"))
    return rank.worklist(table(spark, sf_dir, "orders").select("o_orderkey", p.alias("priority")), "priority", "o_orderkey", 50, 3)


@query("SELECT page_id FROM pages WHERE substr(sha256(url), 1, 16) NOT IN (SELECT substr(sha256(url), 1, 16) FROM pages WHERE page_id % 3 = 0 AND length(html) > 2000)")
def pending_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without a current, non-empty result."""
    from curatio.functions.text import url_hash

    p = table(spark, sf_dir, "pages").withColumn("h", url_hash(F.col("url")))
    done = p.where((F.col("page_id") % 3 == 0) & (F.length("html") > 2000)).select("h")
    return p.join(done, "h", "left_anti").select("page_id")


@query("""
WITH f AS (SELECT l_partkey, l_orderkey, l_linenumber, l_extendedprice, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS r FROM lineitem) SELECT l_partkey, l_orderkey, l_linenumber FROM f WHERE r <= 3
""")
def first_n_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return rank.first_n(rows, ["l_partkey"], [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"], 3).drop("l_extendedprice")


@query("SELECT event_id, try_cast(trim(replace(CASE event_id % 4 WHEN 0 THEN ' ' || replace(CAST(value AS VARCHAR), '.', ',') WHEN 1 THEN CAST(value AS VARCHAR) WHEN 2 THEN 'n/a' END, ',', '.')) AS DOUBLE) AS number FROM events")
def lenient_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, v = F.col("event_id") % 4, F.col("value").cast("string")
    raw = F.when(k == 0, F.concat(F.lit(" "), F.replace(v, F.lit("."), F.lit(",")))).when(k == 1, v).when(k == 2, "n/a")
    return table(spark, sf_dir, "events").select("event_id", lenient_float(raw).alias("number"))
