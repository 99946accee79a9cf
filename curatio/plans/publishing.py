"""The published catalogue as a whole, its upkeep, and what a work list expects of it, on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.operators import catalogue, export, patching, quality, reports
from curatio.operators.lookup import names_table
from curatio.plans.registry import query, table


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Regions as makers, parts as bullets, line items as cartridges."""
    part, line = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    none, key = F.lit(None).cast("double"), F.col("p_partkey")
    now = F.lit("now").alias("created_at")
    makers = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), F.when(F.col("r_regionkey") == 2, "Federal").otherwise(F.col("r_name")).alias("name"), now)
    bullets = part.select(
        key.alias("id"), F.col("p_name").alias("name"), (key % 6).alias("manufacturer_id"), F.array(F.lower("p_name")).alias("alt_names"), F.col("p_type").alias("product_line"), F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("product_line_id"),
        F.col("p_size").cast("double").alias("weight_grains"), F.when(key % 10 == 0, 0.223).otherwise(0.308).alias("bullet_diameter_inches"), F.when(F.col("p_size") % 2 == 0, 0.2).alias("bc_g1_published"), none.alias("bc_g7_published"), none.alias("bc_g1_estimated"), none.alias("bc_g7_estimated"),
        F.lit(True).alias("is_locked"), now,
    )
    cartridges = line.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.when(F.col("l_linenumber") == 2, "Federal power-shok COPPER 150").otherwise("Plain 150").alias("name"), (F.col("l_suppkey") % 5).alias("manufacturer_id"),
        F.when(F.col("l_suppkey") % 2 == 0, F.col("l_partkey")).alias("bullet_id"), F.col("l_quantity").alias("bullet_weight_grains"), F.when(F.col("l_returnflag") == "N", 0.0).otherwise(F.col("l_extendedprice")).alias("muzzle_velocity_fps"),
        F.when(F.col("l_linenumber") == 1, 0.3).alias("bc_g1"), none.alias("bc_g7"), F.lit(None).cast("string").alias("product_line"), F.lit("x").alias("data_source"), now,
    )
    size = F.col("p_size").cast("long")
    lines = part.select(F.lit("bullet_product_line").alias("entity_type"), size.alias("entity_id"), F.concat(F.lit("line "), size.cast("string")).alias("alias")).distinct()
    aliases = lines.unionByName(table(spark, sf_dir, "supplier").select(F.lit("manufacturer").alias("entity_type"), F.col("s_suppkey").alias("entity_id"), F.col("s_name").alias("alias")))
    return {"manufacturer": makers, "bullet": bullets, "cartridge": cartridges, "entity_alias": aliases, "bullet_product_line": lines}


@query("""
WITH b AS (SELECT p_partkey AS id, p_size AS w, CASE WHEN p_partkey % 10 = 0 THEN 0.223 ELSE 0.308 END AS d, p_size % 2 = 0 AS g, CASE WHEN p_size % 2 = 0 THEN 2 ELSE 1 END AS alts FROM part),
c AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_suppkey % 5 = 2 AND l_linenumber = 2 AS mislinked, l_quantity AS w, CASE WHEN l_returnflag = 'N' THEN 0 ELSE l_extendedprice END AS v, l_linenumber = 1 AS g, CASE WHEN l_suppkey % 2 = 0 THEN l_partkey END AS bullet FROM lineitem),
k AS (SELECT c.id FROM c LEFT JOIN b ON b.id = c.bullet WHERE v > 0 AND NOT coalesce(abs(c.w - b.w) > 1.0, false) AND (b.id IS NULL OR b.d = 0.223 OR c.g OR b.g) AND NOT mislinked)
SELECT 'bullet' AS table_name, count(*) AS n_rows, sum(id)::BIGINT AS id_sum, sum(alts)::BIGINT AS n_alternatives, 'id,name,manufacturer_id,alt_names,product_line,weight_grains,bullet_diameter_inches,bc_g1_published,bc_g7_published,bc_g1_estimated,bc_g7_estimated,display_name' AS columns FROM b WHERE d <> 0.223 UNION ALL
SELECT 'cartridge', count(*), sum(id)::BIGINT, NULL, 'id,name,manufacturer_id,bullet_id,bullet_weight_grains,muzzle_velocity_fps,bc_g1,bc_g7,product_line,display_name' FROM k UNION ALL
SELECT 'entity_alias', count(*), sum(s_suppkey)::BIGINT, NULL, 'entity_type,entity_id,alias' FROM supplier UNION ALL
SELECT 'manufacturer', count(*), sum(r_regionkey)::BIGINT, NULL, 'id,name' FROM region
""")
def export_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules of the published form in their order: what is left of each table, and its columns."""
    out = None
    for name, rows in sorted(export.export_run(_tables(spark, sf_dir)).items()):
        of = "entity_id" if name == "entity_alias" else "id"
        alternatives = F.sum(F.size("alt_names")) if "alt_names" in rows.columns else F.lit(None).cast("long")
        one = rows.agg(F.count("*").alias("n_rows"), F.sum(of).cast("long").alias("id_sum"), alternatives.cast("long").alias("n_alternatives"))
        one = one.select(F.lit(name).alias("table_name"), "*", F.lit(",".join(rows.columns)).alias("columns"))
        out = one if out is None else out.unionByName(one)
    return out


@query("""
SELECT 0 AS place, 0 AS pass, 'manufacturer' AS table_name, 'INSERT OR IGNORE INTO manufacturer (id, name) VALUES (' || r_regionkey || ', ''' || r_name || '''''s'');' AS statement FROM region UNION ALL
SELECT 1, 0, 'caliber', 'INSERT OR IGNORE INTO caliber (id, name, parent_caliber_id) VALUES (' || n_nationkey || ', ' || CASE WHEN n_nationkey % 4 = 0 THEN 'NULL' ELSE '''' || n_name || '''' END || ', NULL);' FROM nation UNION ALL
SELECT 1, 1, 'caliber', 'UPDATE caliber SET parent_caliber_id = ' || n_regionkey || ' WHERE id = ' || n_nationkey || ';' FROM nation WHERE n_nationkey > 4
""")
def seed_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statements that would fill a new database, parents first, references of a table to itself last."""
    makers = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), F.concat("r_name", F.lit("'s")).alias("name"))
    key = F.col("n_nationkey")
    calibers = table(spark, sf_dir, "nation").select(key.alias("id"), F.when(key % 4 != 0, F.col("n_name")).alias("name"), F.when(key > 4, F.col("n_regionkey")).alias("parent_caliber_id"))
    return catalogue.seed_statements({"caliber": calibers, "manufacturer": makers})


@query("""
SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 1 THEN 'g7' ELSE 'g1' END AS bc_type, round(p_size / 50.0::DOUBLE + CASE p_partkey % 3 WHEN 0 THEN 5e-10 WHEN 1 THEN 0 ELSE 1e-6 END, 7) AS bc_value FROM part WHERE p_partkey % 3 <> 0
""")
def unseen_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements that are not there yet: another type or value; a difference below 1e-9 is none."""
    p, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    value = F.col("p_size") / 50.0
    known = p.select(key.alias("id"), F.lit("g1").alias("bc_type"), value.alias("bc_value"))
    said = value + F.when(key % 3 == 0, 5e-10).when(key % 3 == 1, 0.0).otherwise(1e-6)
    new = p.select(key.alias("id"), F.when(key % 3 == 1, "g7").otherwise("g1").alias("bc_type"), said.alias("bc_value"))
    new = new.unionByName(new.where("id % 2 = 0"))
    return catalogue.unseen_sources(new, known, ["id", "bc_type"], "bc_value").withColumn("bc_value", F.round("bc_value", 7))


@query("SELECT page_id FROM pages WHERE contains(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), 'blog.')")
def of_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.of_domain(table(spark, sf_dir, "pages"), "BLOG.").select("page_id")


@query("""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_id WHEN 1 THEN event_id + 1 ELSE -1 END AS number, CASE WHEN event_id % 2 = 0 THEN event_type END AS name FROM events
""")
def envelope_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that are plain in some documents, wrapped in others, and missing or without a value in the rest."""
    e, key = table(spark, sf_dir, "events"), F.col("event_id")
    k, text = key % 4, key.cast("string")
    number = F.when(k == 0, F.concat(F.lit('"n": '), text)).when(k == 1, F.concat(F.lit('"n": {"value": '), (key + 1).cast("string"), F.lit(', "confidence": 0.9}'))).when(k == 2, F.lit('"n": {"confidence": 0.1}')).otherwise(F.lit('"m": 1'))
    name = F.when(key % 2 == 0, F.concat(F.lit('{"value": "'), "event_type", F.lit('"}'))).otherwise("null")
    d = e.select("event_id", F.try_parse_json(F.concat(F.lit("{"), number, F.lit(', "name": '), name, F.lit("}"))).alias("d"))
    return d.select("event_id", catalogue.envelope(F.col("d"), "n", "bigint", F.lit(-1).cast("bigint")).alias("number"), catalogue.envelope(F.col("d"), "name", "string").alias("name"))


SLUG = "trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g'), '-')"


@query(f"""
WITH b AS (SELECT p_partkey AS id, p_partkey % 5 AS maker, p_type, {SLUG} AS slug FROM part WHERE p_partkey % 7 <> 0), l AS (SELECT DISTINCT maker, slug, maker = 0 AS known FROM b)
SELECT b.id, maker, l.slug, l.known FROM b JOIN l USING (maker) WHERE b.slug = l.slug
""")
def product_line_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines made of what bullets say, in any case and with marks, and the bullets linked to them; one maker's are there already."""
    p, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    said = F.when(key % 2 == 0, F.upper("p_type")).otherwise(F.concat(F.col("p_type"), F.lit("®")))
    bullets = p.select(key.alias("id"), (key % 5).alias("maker_id"), F.when(key % 7 != 0, said).alias("product_line"), F.lit(None).cast("long").alias("product_line_id"))
    have = bullets.where("maker_id = 0 and product_line is not null").select("maker_id", catalogue.slug(F.col("product_line")).alias("slug")).distinct()
    lines = have.select((-1 - F.crc32("slug")).alias("id"), "maker_id", F.upper("slug").alias("name"), "slug")
    every = catalogue.seeded_lines(bullets, lines)
    linked = catalogue.with_line_ids(bullets, every).where("product_line_id is not null")
    of = every.select(F.col("id").alias("product_line_id"), "slug", (F.col("maker_id") == 0).alias("known"))
    return linked.join(of, "product_line_id").select("id", F.col("maker_id").alias("maker"), "slug", "known")


def _answers(rows: list[dict]) -> list:
    """A stand-in for a service: right, blank, mistaken or incomplete answers by id."""
    out = []
    for r in rows:
        k = r["id"] % 6
        answer = {"id": r["id"] + 1 if k == 1 else str(r["id"]), "product_line": {2: None, 3: "  "}.get(k, f" {r['name']} ")}
        out.append({"id": r["id"]} if k == 4 else answer)
    return out


@query("""
SELECT p_partkey AS id, CASE WHEN p_partkey % 6 IN (0, 5) THEN p_name END AS product_line, CASE p_partkey % 6 WHEN 1 THEN 'id_mismatch' WHEN 2 THEN 'generic' WHEN 3 THEN 'generic' WHEN 4 THEN 'malformed' ELSE CASE WHEN p_partkey % 12 = 0 THEN 'locked' ELSE 'updated' END END AS outcome FROM part
""")
def product_line_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product lines asked of an extractor, fifty rows at a time; each answer must name its row."""
    key = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(key.alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("maker"), F.when(key % 12 == 0, True).alias("is_locked"))
    return catalogue.backfilled(rows, _answers)


@query("""
WITH x AS (SELECT p_partkey AS k, p_partkey % 2 = 0 AS bullet, p_partkey % 5 AS f, p_partkey % 7 AS h, p_size + 10 AS w FROM part WHERE p_partkey % 11 <> 0),
f AS (SELECT bullet, unnest(list_filter([CASE WHEN f = 1 THEN 'MANUFACTURER' END, CASE WHEN bullet AND f = 2 THEN 'WEIGHT' END, CASE WHEN bullet AND f = 3 THEN 'DIAMETER' END,
  CASE WHEN bullet AND h = 1 THEN 'BC_MISSING' END, CASE WHEN bullet AND h = 2 THEN 'BC_MISMATCH' END, CASE WHEN NOT bullet AND f = 2 THEN 'CALIBER' END, CASE WHEN NOT bullet AND h = 1 THEN 'ZERO_VELOCITY' END], lambda z: z IS NOT NULL)) AS finding FROM x)
SELECT CASE WHEN bullet THEN 'bullet' ELSE 'cartridge' END AS entity, finding, count(*) AS n FROM f GROUP BY ALL
""")
def crosscheck_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a work list's entries and their notes say against the catalogue: seven kinds of findings."""
    p, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    f, h, w = key % 5, key % 7, (F.col("p_size") + 10).cast("string")
    url = F.concat(F.lit("https://x.example/"), key.cast("string")).alias("url")
    notes = F.concat_ws(", ", F.lit('bore .270"'), F.when(h < 4, "G1 BC: 0.400"))
    entries = p.select(url, F.when(key % 2 == 0, "bullet").otherwise("cartridge").alias("entity_type"), F.lit("Acme Bullets").alias("expected_manufacturer"), F.when(key % 2 == 0, "x").otherwise("6.5 PRC").alias("expected_caliber"), F.concat(w, F.lit(" gr")).alias("brief_description"), notes.alias("notes"))
    there = p.where("p_partkey % 11 <> 0")
    maker = F.when(f == 1, "Other").otherwise("ACME").alias("maker")
    weight = (F.col("p_size") + F.when(f == 2, 12.5).otherwise(11.0)).alias("weight")
    g1 = F.when(h == 1, F.lit(None)).when(h == 2, 0.45).otherwise(0.41)
    bullets = there.where("p_partkey % 2 = 0").select(url, maker, weight, F.when(f == 3, 0.308).otherwise(0.277).alias("diameter"), g1.alias("g1"), F.lit(None).cast("double").alias("g7"))
    cartridges = there.where("p_partkey % 2 <> 0").select(url, maker, F.when(f == 2, "308 Win").otherwise("6.5mm PRC").alias("caliber"), F.when(h == 1, 0.0).otherwise(2700.0).alias("velocity"))
    return reports.crosscheck(entries, bullets, cartridges).groupBy("entity", "finding").agg(F.count("*").alias("n"))


@query("""
WITH f AS (SELECT l_partkey, year(l_shipdate) AS run FROM lineitem WHERE l_discount > 0.09 AND l_shipdate < TIMESTAMP '1998-01-01')
SELECT l_partkey, min(run) AS first_seen, max(run) AS last_seen, count(DISTINCT run) AS times_seen, CASE WHEN max(run) < 1997 THEN 'resolved' WHEN min(run) = 1997 THEN 'new' ELSE 'known' END AS state FROM f GROUP BY 1
""")
def issue_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each issue's first and last run, in how many runs it was found, and what it is in the latest."""
    found = table(spark, sf_dir, "lineitem").where("l_discount > 0.09 and l_shipdate < '1998-01-01'").select("l_partkey", F.year("l_shipdate").cast("long").alias("run"))
    return quality.issue_history(found, ["l_partkey"], F.lit(1997))


@query("""
WITH b AS (SELECT p_partkey AS id, p_size::DOUBLE AS w, CASE WHEN p_partkey % 4 = 0 THEN 0.277 ELSE 0.308 END AS d FROM part)
SELECT l_orderkey, l_linenumber, abs(l_quantity - w) > 1.0 AS weight_off, d <> 0.308 AS diameter_off FROM lineitem JOIN b ON id = l_partkey WHERE abs(l_quantity - w) > 1.0 OR d <> 0.308
""")
def linked_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cartridges whose bullet has another weight or diameter than they say."""
    key = F.col("p_partkey")
    bullets = table(spark, sf_dir, "part").select(key.alias("id"), F.col("p_size").cast("double").alias("weight"), F.when(key % 4 == 0, 0.277).otherwise(0.308).alias("diameter"))
    cartridges = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("bullet_id"), F.col("l_quantity").alias("bullet_weight"), F.lit(0.308).alias("bullet_diameter"))
    return reports.linked_mismatches(cartridges, bullets).select("l_orderkey", "l_linenumber", "weight_off", "diameter_off")


@query("SELECT p_brand AS maker, count(*) AS n, count(*) FILTER (WHERE p_size % 3 = 0 AND p_partkey % 2 = 0) AS without FROM part GROUP BY 1")
def without_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By maker, bullets and those of which no coefficient is known."""
    none = F.lit(None).cast("double")
    bullets = table(spark, sf_dir, "part").select(F.col("p_brand").alias("maker"), F.when(F.col("p_size") % 3 != 0, 0.4).alias("g1"), none.alias("g7"), F.when(F.col("p_partkey") % 2 != 0, 0.2).alias("g1_est"), none.alias("g7_est"))
    return reports.without_coefficients(bullets)


@query("""
WITH e AS (SELECT url, page_id AS id FROM pages UNION ALL SELECT url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'variant=2', page_id + 1000000 FROM pages WHERE page_id % 3 = 0)
SELECT regexp_replace(url, '[?#].*$', '') AS base, count(*) AS n, array_to_string(list(id ORDER BY id), ',') AS ids FROM e GROUP BY 1 HAVING count(*) > 1
""")
def shared_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses that several entities share, with all that share one (a page's few variants, not a hot key)."""
    p = table(spark, sf_dir, "pages").select("url", F.col("page_id").alias("id"))
    more = p.where("id % 3 = 0").select(F.concat("url", F.when(F.contains("url", F.lit("?")), "&").otherwise("?"), F.lit("variant=2")).alias("url"), (F.col("id") + 1000000).alias("id"))
    g = p.unionByName(more).groupBy(F.regexp_replace("url", "[?#].*$", "").alias("base")).agg(F.count("*").alias("n"), F.array_sort(F.collect_list("id")).alias("ids")).where("n > 1")
    return g.select("base", "n", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


# ---- patches: regions as makers, customers as bullets and as cartridges


@query("""
WITH c AS (SELECT c_custkey AS k FROM customer), f AS (SELECT k, k % 11 = 0 AS lost, k % 11 <> 0 AND k % 3 <> 0 AND k % 4 <> 0 AS fresh FROM c),
g AS (SELECT *, fresh AND (k % 7 <> 0 OR row_number() OVER (PARTITION BY fresh, k % 7 = 0 ORDER BY k) = 1) AS first FROM f),
n AS (SELECT *, first AND row_number() OVER (PARTITION BY first, k % 50 ORDER BY k) = 1 AS made FROM g)
SELECT 'create_bullet' AS action, k AS position, CASE WHEN lost THEN 'ERROR' WHEN made THEN 'CREATE' ELSE 'SKIP' END AS outcome FROM n UNION ALL
SELECT 'create_manufacturer', r_regionkey, CASE WHEN r_regionkey % 2 = 0 THEN 'SKIP' ELSE 'CREATE' END FROM region UNION ALL
SELECT 'update_bullet', k, CASE WHEN k % 11 = 0 OR k % 9 = 0 THEN 'ERROR' WHEN k % 2 = 0 THEN 'UPDATE' ELSE 'SKIP' END FROM c UNION ALL
SELECT 'update_cartridge', k, CASE WHEN k % 11 = 0 OR k % 9 = 0 THEN 'ERROR' WHEN k % 4 = 0 THEN 'UPDATE' ELSE 'SKIP' END FROM c UNION ALL
SELECT 'delete_bullet', k, CASE WHEN k % 8 = 0 OR k % 11 = 0 AND k % 2 <> 0 THEN 'SKIP' WHEN EXISTS (FROM orders WHERE o_custkey = k) THEN 'ERROR' ELSE 'DELETE' END FROM c UNION ALL
SELECT 'add_bc_source', k, CASE WHEN k % 13 = 0 THEN 'ERROR' WHEN k % 2 = 0 THEN 'CREATE' ELSE 'SKIP' END FROM c
""")
def patch_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each operation of a patch comes to, action by action, by that action's own rule."""
    c, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    text, owner = key.cast("string"), key % 5
    makers = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"), F.array(F.concat(F.lit("maker "), F.col("r_regionkey").cast("string"))).alias("alt_names"), F.lit(None).cast("long").alias("maker_id"))
    names = names_table(makers, None, "manufacturer")
    bullets = c.select(key.alias("id"), owner.alias("manufacturer_id"), F.col("c_name").alias("name"), F.when(key % 2 == 0, F.concat(F.lit("S-"), text)).alias("sku"), F.lit(1.0).alias("bc"))
    said = F.when(key % 11 == 0, "nobody").otherwise(F.concat(F.lit("Maker "), owner.cast("string"))).alias("manufacturer")
    ops = lambda *more: patching.with_ids(c.select(key.alias("position"), said, *more), names, "manufacturer", "manufacturer_id")
    name = F.when(key % 4 == 0, F.concat(F.lit("other "), text)).when(key % 3 == 0, F.upper("c_name")).otherwise(F.concat(F.lit("new "), (key % 50).cast("string")))
    code = F.when(key % 4 == 0, F.concat(F.lit("s-"), text)).when((key % 7 == 0) & (key % 3 != 0), F.when(key % 2 == 0, "NEW").otherwise("new"))
    known = F.when(key % 9 == 0, "gone").otherwise(F.upper("c_name")).alias("name")
    outcomes = {
        "create_bullet": patching.created(ops(name.alias("name"), code.alias("sku")), bullets, code="sku"),
        "create_manufacturer": patching.created(makers.select(F.col("id").alias("position"), F.concat(F.lower("name"), F.when(F.col("id") % 2 == 0, "").otherwise(" arms")).alias("name")), makers, owner=None),
        "update_bullet": patching.updated(ops(known, F.when(key % 2 == 0, 2.0).when(key % 3 == 0, 1.0).alias("bc")), bullets, ["bc"]),
        "update_cartridge": patching.relinked(ops(known, F.when(key % 2 == 0, "said").alias("bullet"), F.when(key % 4 == 0, -1 - key).when(key % 2 == 0, key).alias("bullet_id")), bullets.withColumn("bullet_id", F.col("id"))),
        "delete_bullet": patching.deleted(ops(F.when(key % 8 == 0, -1 - key).when(key % 2 == 0, key).alias("id"), F.lower("c_name").alias("name")), bullets, table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))),
        "add_bc_source": patching.added(c.select(key.alias("position"), F.when(key % 13 != 0, key).alias("id"), F.when(key % 2 == 0, 0.5).otherwise(1.0).alias("bc")), bullets, ["id", "bc"]),
    }
    out = None
    for action, of in outcomes.items():
        one = of.select(F.lit(action).alias("action"), "position", "outcome")
        out = one if out is None else out.unionByName(one)
    return out


@query("""
WITH n AS (SELECT p_brand, CASE p_partkey % 7 WHEN 0 THEN upper(p_name) || ' (50CT)' WHEN 1 THEN '30 Cal ' || p_name WHEN 2 THEN '12,0 g / 185 gr ' || p_name WHEN 3 THEN p_name || '®' WHEN 4 THEN repeat('x', 81) WHEN 5 THEN p_name || ' (20 ct)' ELSE p_name END AS kind, p_partkey % 7 AS k FROM part)
SELECT p_brand AS maker, count(*) AS n, count(*) FILTER (WHERE k IN (0, 5)) AS pack_count, count(*) FILTER (WHERE k = 0) AS all_caps, count(*) FILTER (WHERE k = 1) AS caliber_in_name, count(*) FILTER (WHERE k = 2) AS metric_weight, count(*) FILTER (WHERE k = 3) AS trademark, count(*) FILTER (WHERE k = 4) AS too_long FROM n GROUP BY 1
""")
def name_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names to be tidied, by maker and by what is wrong with them."""
    k, name = F.col("p_partkey") % 7, F.col("p_name")
    said = F.when(k == 0, F.concat(F.upper(name), F.lit(" (50CT)"))).when(k == 1, F.concat(F.lit("30 Cal "), name)).when(k == 2, F.concat(F.lit("12,0 g / 185 gr "), name)).when(k == 3, F.concat(name, F.lit("®"))).when(k == 4, F.repeat(F.lit("x"), F.lit(81))).when(k == 5, F.concat(name, F.lit(" (20 ct)"))).otherwise(name)
    return reports.name_patterns(table(spark, sf_dir, "part").select(F.col("p_brand").alias("maker"), said.alias("name")))


@query("""
WITH r AS (SELECT l_orderkey, l_linenumber, l_quantity AS a, CASE WHEN l_linenumber % 2 = 0 THEN l_quantity * 1.004 ELSE l_quantity * 1.02 END AS b FROM lineitem), d AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS n FROM r WHERE abs(a - b) > greatest(0.01, 0.005 * greatest(abs(a), abs(b))))
SELECT 'quantity' AS field, l_orderkey, l_linenumber, a AS first, b AS second FROM d WHERE n <= 5
""")
def disagreement_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five rows on which two sources of a field differ."""
    q = F.col("l_quantity")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", q.alias("a"), F.when(F.col("l_linenumber") % 2 == 0, q * 1.004).otherwise(q * 1.02).alias("b"))
    return quality.disagreement_samples(rows, {"quantity": ("a", "b")}, ["l_orderkey", "l_linenumber"])
