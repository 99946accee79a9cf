"""Pages: reduction, text, links, lineage; work lists and audits over them; published tables; sweeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.functions.numbers import ratio
from curatio.functions.text import caliber_alike, maker_alike, normalize_match, url_hash, url_host
from curatio.operators import export
from curatio.operators.rank import best_with_alternatives
from curatio.operators.store import action_counts
from curatio.plans.registry import query, table
from curatio.sources.html import reduced_pages, step_summary
from curatio.sources.parsers import PARSERS, lineage, parsed_pages


@query()
def reduce_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through all steps of its reduction (an HTML tree: no SQL)."""
    return reduced_pages(table(spark, sf_dir, "pages"), target=0).select("page_id", "original_size", "reduced_size", "steps_applied", "under_target", "strategy_used", F.sha2("reduced_html", 256).alias("reduced_hash"))


@query()
def reduce_meta_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return step_summary(reduced_pages(table(spark, sf_dir, "pages"), target=0))


STRIPPED = r"(?is)<(script|style)\b.*?</(?:script|style)>|<!--.*?-->|<[^>]+>"


@query(r"SELECT page_id, trim(regexp_replace(regexp_replace(html, '(?is)<(script|style)\b.*?</(?:script|style)>|<!--.*?-->|<[^>]+>', ' ', 'g'), '[ \t\r\n\f\v]+', ' ', 'g')) AS body FROM pages")
def strip_tags_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages' text by patterns alone, inside code generation."""
    return table(spark, sf_dir, "pages").select("page_id", F.trim(F.regexp_replace(F.regexp_replace("html", STRIPPED, " "), r"[ \t\r\n\f\x0B]+", " ")).alias("body"))


@query("""
SELECT page_id, regexp_extract(x, 'href="([^"]*)"', 1) AS href, regexp_extract(x, '>([^<]*)</a>$', 1) AS label FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="[^"]*"[^>]*>[^<]*</a>')) AS x FROM pages)
""")
def links_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of attribute and content, all of a page at once."""
    x = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a href="[^"]*"[^>]*>[^<]*</a>'), F.lit(0))).alias("x"))
    return x.select("page_id", F.regexp_extract("x", 'href="([^"]*)"', 1).alias("href"), F.regexp_extract("x", ">([^<]*)</a>$", 1).alias("label"))


@query("""
WITH p AS (SELECT page_id, list_transform(regexp_extract_all(html, '<a href="[^"]*"'), lambda a: regexp_extract(a, '"([^"]*)"', 1)) AS l FROM pages)
SELECT page_id, len(l) AS links, len(list_distinct(l)) AS targets, CASE WHEN len(l) > 0 THEN l[len(l)] END AS last_target FROM p
""")
def spec_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated pairs as arrays: how many, how many different, and the last, which wins."""
    found = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    p = table(spark, sf_dir, "pages").select("page_id", found.alias("l"))
    return p.select("page_id", F.size("l").alias("links"), F.size(F.array_distinct("l")).alias("targets"), F.try_element_at("l", F.lit(-1)).alias("last_target"))


@query()
def parse_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages through the parsers of their hosts; hosts are dealt to the parsers here, and pages of other kinds must be declined."""
    hosts = F.array(*map(F.lit, [*sorted(PARSERS), "example.com"]))
    p = table(spark, sf_dir, "pages").withColumn("url", F.concat(F.lit("https://"), F.element_at(hosts, (F.col("page_id") % 4 + 1).cast("int")), F.lit("/x"))).withColumn("kind", F.lit("bullet"))
    done = lineage(parsed_pages(p, "kind"), p.where("page_id % 2 = 0").select("page_id"))
    return done.groupBy("parser", "status", "extraction_method").agg(F.count("*").alias("n"))


HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1))"


@query(f"""
WITH p AS (SELECT {HOST} AS host, length(html) > 3000 AS parsed FROM pages), h AS (SELECT host, count(*) AS n FROM p GROUP BY host),
f AS (SELECT CASE WHEN n < 5 THEN 'other' ELSE p.host END AS host, parsed FROM p JOIN h ON h.host = p.host)
SELECT host, count(*) AS n, count(*) FILTER (WHERE parsed) AS by_parser, round(count(*) FILTER (WHERE parsed) / count(*)::DOUBLE, 4) AS rate, count(*) >= 20 AND count(*) FILTER (WHERE parsed) < 0.8 * count(*) AS falling FROM f GROUP BY host
""")
def lineage_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How pages were read, by host, small hosts together, with an alert where the parser's share falls."""
    by_host = table(spark, sf_dir, "pages").select(url_host(F.col("url")).alias("host"), (F.length("html") > 3000).alias("parsed")).groupBy("host").agg(F.count("*").alias("n"), F.count_if("parsed").alias("p"))
    folded = by_host.groupBy(F.when(F.col("n") < 5, "other").otherwise(F.col("host")).alias("host")).agg(F.sum("n").alias("n"), F.sum("p").alias("by_parser"))
    return folded.select("host", "n", "by_parser", F.round(ratio(F.col("by_parser"), F.col("n")), 4).alias("rate"), ((F.col("n") >= 20) & (F.col("by_parser") < 0.8 * F.col("n"))).alias("falling"))


@query("WITH g AS (SELECT regexp_replace(url, '[?#].*$', '') AS base, list(page_id ORDER BY page_id) AS ids FROM pages GROUP BY 1) SELECT base, len(ids) AS n, ids[1] AS first_id FROM g WHERE len(ids) > 1")
def shared_url_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses that several entries share."""
    g = table(spark, sf_dir, "pages").groupBy(F.regexp_replace("url", "[?#].*$", "").alias("base")).agg(F.count("*").alias("n"), F.min("page_id").alias("first_id"))
    return g.where("n > 1")


@query("SELECT page_id, length(trim(html)) < 800 OR page_id % 13 = 0 AS fall_back FROM pages")
def fetch_fallback_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which fetches go to the second fetcher: a bad status (here: every 13th) or too little text."""
    return table(spark, sf_dir, "pages").select("page_id", ((F.length(F.trim("html")) < 800) | (F.col("page_id") % 13 == 0)).alias("fall_back"))


@query("""
WITH j AS (SELECT l_orderkey, l_linenumber, l_quantity, p_size, l_extendedprice / l_quantity AS u, p_retailprice FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT finding, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN abs(l_quantity - p_size) > 1 THEN 'weight' END, CASE WHEN abs(u - p_retailprice) / p_retailprice > 0.05 THEN 'coefficient' END, CASE WHEN p_size = 0 THEN 'zero_velocity' END], lambda f: f IS NOT NULL)) AS finding FROM j) GROUP BY 1
""")
def manifest_crosscheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a work list expects against what the tables hold, as findings by type."""
    j = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    off = F.abs(F.col("l_extendedprice") / F.col("l_quantity") - F.col("p_retailprice")) / F.col("p_retailprice") > 0.05
    told = F.array_compact(F.array(F.when(F.abs(F.col("l_quantity") - F.col("p_size")) > 1, "weight"), F.when(off, "coefficient"), F.when(F.col("p_size") == 0, "zero_velocity")))
    return j.select(F.explode(told).alias("finding")).groupBy("finding").agg(F.count("*").alias("n"))


@query()
def names_alike(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibre and maker names in other words, by rule (normal forms and number sets)."""
    s = table(spark, sf_dir, "supplier")
    cal = F.concat(F.lit("."), (F.col("s_suppkey") % 400 + 200).cast("string"), F.lit(" Win Mag"))
    other = F.concat((F.col("s_suppkey") % 400 + 200).cast("string"), F.when(F.col("s_suppkey") % 2 == 0, " Winchester Magnum").otherwise(" PRC"))
    return s.select("s_suppkey", caliber_alike(cal, other).alias("caliber"), maker_alike(F.col("s_name"), F.concat(F.lit("The "), F.col("s_name"), F.lit(" Inc."))).alias("maker"), normalize_match(cal).alias("form"))


@query("""
WITH m AS (SELECT a.p_partkey AS id, max(CASE WHEN abs(a.p_size - b.p_size) <= 1 THEN 1 ELSE 0 END) AS strict FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_name = b.p_name AND a.p_partkey <> b.p_partkey GROUP BY 1)
SELECT p_brand, count(*) AS mentions, count(*) FILTER (WHERE strict = 1) AS linked, count(*) FILTER (WHERE strict = 0) AS recovered FROM m JOIN part ON p_partkey = id GROUP BY 1
""")
def two_config_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is linked only under the relaxed of two configurations."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_size")
    other = part.toDF("k", "p_brand", "p_name", "z")
    m = part.join(other, ["p_brand", "p_name"]).where("p_partkey != k").groupBy("p_partkey", "p_brand").agg(F.max((F.abs(F.col("p_size") - F.col("z")) <= 1)).alias("strict"))
    return m.groupBy("p_brand").agg(F.count("*").alias("mentions"), F.count_if("strict").alias("linked"), F.count_if(~F.col("strict")).alias("recovered"))


@query("""
WITH m AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2), s AS (SELECT l_partkey, l_suppkey, round(q / 1000, 3) AS c FROM m),
r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY c DESC, l_suppkey) AS r FROM s)
SELECT l_partkey, max(CASE WHEN r = 1 THEN l_suppkey END) AS best, max(CASE WHEN r = 1 THEN c END) AS confidence, array_to_string(list(l_suppkey ORDER BY r) FILTER (WHERE r BETWEEN 2 AND 4), ',') AS runners_up FROM r GROUP BY l_partkey
""")
def two_pass_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of each group with its runners-up, by a total order."""
    scored = table(spark, sf_dir, "lineitem").groupBy("l_partkey", F.col("l_suppkey").alias("entity_id")).agg(F.sum("l_quantity").alias("q"))
    scored = scored.select("l_partkey", "entity_id", F.round(F.col("q") / 1000, 3).alias("confidence"), F.lit("sum").alias("method"), F.lit(1).alias("tier"))
    out = best_with_alternatives(scored, ["l_partkey"])
    return out.select("l_partkey", F.col("entity_id").alias("best"), "confidence", F.nullif(F.array_join(F.transform("alternatives", lambda a: a["entity_id"].cast("string")), ","), F.lit("")).alias("runners_up"))


@query("""
WITH c AS (SELECT l_orderkey, l_linenumber, l_quantity AS bw, CASE WHEN l_returnflag = 'N' THEN 0 ELSE l_extendedprice END AS v, CASE WHEN l_linenumber = 1 THEN 0.3 END AS g1, CASE WHEN l_suppkey % 2 = 0 THEN l_partkey END AS b FROM lineitem),
p AS (SELECT p_partkey, p_size::DOUBLE AS w, CASE WHEN p_size % 2 = 0 THEN 0.2 END AS g FROM part)
SELECT l_orderkey, l_linenumber FROM c LEFT JOIN p ON p_partkey = b WHERE v > 0 AND NOT coalesce(abs(bw - w) > 1.0, false) AND (p_partkey IS NULL OR g1 IS NOT NULL OR g IS NOT NULL)
""")
def export_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows fit to publish: a speed, and where a row is linked its weight and a coefficient from either."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    none = F.lit(None).cast("double")
    c = line.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("bullet_weight"), F.when(F.col("l_returnflag") == "N", 0.0).otherwise(F.col("l_extendedprice")).alias("velocity"), F.when(F.col("l_linenumber") == 1, 0.3).alias("g1"), none.alias("g7"), F.when(F.col("l_suppkey") % 2 == 0, F.col("l_partkey")).alias("bullet_id"))
    b = part.select(F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("weight"), F.when(F.col("p_size") % 2 == 0, 0.2).alias("g1"), none.alias("g7"), none.alias("g1_est"), none.alias("g7_est"))
    return export.exported_cartridges(c, b).select("l_orderkey", "l_linenumber")


@query("""
WITH a AS (SELECT s_suppkey AS id, unnest([lower(s_name), 'Alt ' || s_suppkey, 'alt ' || s_suppkey]) AS x, unnest([1, 2, 3]) AS i FROM supplier)
SELECT id, string_agg(x, '|' ORDER BY i) AS alt_names FROM (SELECT id, x, i, row_number() OVER (PARTITION BY id, lower(x) ORDER BY i) AS r FROM a) WHERE r = 1 GROUP BY id
""")
def fold_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases folded into alternative names, repeats in other case left out."""
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("string")
    entities = s.select(F.col("s_suppkey").alias("id"), F.array(F.lower("s_name")).alias("alt_names"))
    aliases = s.select(F.col("s_suppkey").alias("entity_id"), F.explode(F.array(F.concat(F.lit("Alt "), key), F.concat(F.lit("alt "), key))).alias("alias"))
    return export.folded_aliases(entities, aliases).select("id", F.array_join("alt_names", "|").alias("alt_names"))


@query()
def export_display_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published names of cartridges, by four ways, with warnings."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 4
    rows = p.select("p_partkey", F.concat(F.lit("6.5 Creedmoor 143 gr ELD-X "), F.initcap("p_name"), F.lit(" 2700 fps")).alias("name"), F.when(k < 2, F.initcap("p_name")).alias("product_line"), F.when(k % 2 == 0, F.lit("Sierra MATCHKING®")).alias("bullet_product_line"))
    return export.with_cartridge_names(rows).select("p_partkey", "display_name", "warning")


@query("SELECT bullet || '_' || bc || '_' || velocity AS case_id, round(velocity * bc / weight, 6) AS metric FROM (SELECT unnest([1, 2, 3]) AS bullet) a, (SELECT unnest([0.2::DOUBLE, 0.3, 0.4]) AS bc) b, (SELECT unnest(range(2400, 3201, 100)) AS velocity) c, (SELECT 140.0::DOUBLE AS weight) d")
def parameter_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid of cases from literal ranges: generators, not a join."""
    one = spark.range(1).select(F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("bullet"))
    grid = one.withColumn("bc", F.explode(F.array(F.lit(0.2), F.lit(0.3), F.lit(0.4)))).withColumn("velocity", F.explode(F.sequence(F.lit(2400), F.lit(3200), F.lit(100))))
    return grid.select(F.concat_ws("_", "bullet", "bc", "velocity").alias("case_id"), F.round(F.col("velocity") * F.col("bc") / 140.0, 6).alias("metric"))


@query("SELECT event_type, max(abs(value - m)) AS max_delta, rank() OVER (ORDER BY max(abs(value - m)) DESC) AS r FROM events JOIN (SELECT event_type AS e, avg(value) AS m FROM events GROUP BY 1) ON e = event_type GROUP BY 1")
def sweep_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest deviation from a baseline, ranked over the few groups."""
    e = table(spark, sf_dir, "events").select("event_type", "value")
    d = e.join(e.groupBy("event_type").agg(F.avg("value").alias("m")), "event_type").groupBy("event_type").agg(F.max(F.abs(F.col("value") - F.col("m"))).alias("max_delta"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("max_delta")).alias("x"), "event_type", "max_delta")))
    return d.agg(order.alias("a")).select(F.posexplode("a").alias("r", "x")).select("x.event_type", "x.max_delta", (F.col("r") + 1).cast("long").alias("r"))


@query("SELECT role AS entity_type, CASE WHEN length(text) < 40 THEN 'errored' WHEN turn > 2 THEN 'expired' ELSE 'succeeded' END AS action, count(*) AS n FROM conversations GROUP BY 1, 2")
def batch_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of a batch by status: too short is truncated, hence errored."""
    status = F.when(F.length("text") < 40, "errored").when(F.col("turn") > 2, "expired").otherwise("succeeded")
    return action_counts(table(spark, sf_dir, "conversations").select(F.col("role").alias("entity_type"), status.alias("action")))


@query("SELECT substr(sha256(url), 1, 16) AS url_hash, min(page_id) AS page_id FROM pages GROUP BY 1")
def cache_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").groupBy(url_hash(F.col("url")).alias("url_hash")).agg(F.min("page_id").alias("page_id"))
