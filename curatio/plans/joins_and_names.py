"""Joins beyond equality, and names in normal form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.functions import display, text
from curatio.functions.similarity import name_similarity
from curatio.operators.joins import band_join, key_changes, last_per_key, typed_references
from curatio.plans.registry import query, table

def _norm(x: str, keep: str) -> str:
    """DuckDB's form of the name normalisers, for the oracle."""
    s = f"trim(regexp_replace(regexp_replace(lower(trim(translate({x}, '®™©', ''))), '[^\\p{{L}}\\p{{N}}_\\s{keep}]', ' ', 'g'), '\\s+', ' ', 'g'))"
    return f"array_to_string(list_transform(string_split({s}, ' '), lambda t: CASE WHEN starts_with(t, '.') THEN t ELSE rtrim(t, '.') END), ' ')"


@query("""
SELECT a.p_partkey AS p_partkey, count(b.p_partkey) AS near FROM part a LEFT JOIN part b
ON abs(a.p_retailprice - b.p_retailprice) < 0.5 AND a.p_brand = b.p_brand AND a.p_partkey <> b.p_partkey GROUP BY a.p_partkey
""")
def band_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one brand within a band of price: an equi-join on buckets."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_brand")
    other = part.toDF("other", "other_price", "other_brand")
    pairs = band_join(part, other, ("p_retailprice", "other_price"), 0.5, also=[("p_brand", "other_brand")], inclusive=False).where("p_partkey != other")
    n = pairs.groupBy("p_partkey").agg(F.count("*").alias("near"))
    return part.join(n, "p_partkey", "left").select("p_partkey", F.coalesce("near", F.lit(0).cast("long")).alias("near"))


@query("""
WITH a AS (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'), b AS (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1993-01-01')
SELECT o_orderkey, 'removed' AS change FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)
UNION ALL SELECT o_orderkey, 'added' FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)
""")
def pk_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that two versions of a table do not share."""
    orders = table(spark, sf_dir, "orders")
    return key_changes(orders.where("o_orderdate < '1997-01-01'"), orders.where("o_orderdate >= '1993-01-01'"), ["o_orderkey"])


@query("""
SELECT c_custkey, arg_max(o_orderkey, o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice
FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey
""")
def last_row_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last row per key, as a lookup table."""
    last = last_per_key(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey", "o_orderkey")
    return table(spark, sf_dir, "customer").select("c_custkey").join(last, F.col("c_custkey") == F.col("o_custkey")).drop("o_custkey")


@query("""
WITH r AS (SELECT 'supplier' AS entity_type, l_suppkey AS entity_id FROM lineitem WHERE l_quantity > 49 UNION ALL
           SELECT 'part', l_partkey FROM lineitem WHERE l_quantity > 49 UNION ALL SELECT 'part', l_partkey + 100000000 FROM lineitem WHERE l_quantity > 49)
SELECT entity_type, entity_name, count(*) AS n FROM (
  SELECT r.*, s_name AS entity_name FROM r JOIN supplier ON entity_type = 'supplier' AND s_suppkey = entity_id UNION ALL
  SELECT r.*, p_name FROM r JOIN part ON entity_type = 'part' AND p_partkey = entity_id) GROUP BY 1, 2
""")
def typed_reference_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References whose target table stands in a column; dangling ones go."""
    line = table(spark, sf_dir, "lineitem").where("l_quantity > 49")
    refs = line.select(F.explode(F.array(F.struct(F.lit("supplier").alias("entity_type"), F.col("l_suppkey").alias("entity_id")), F.struct(F.lit("part").alias("entity_type"), F.col("l_partkey").alias("entity_id")), F.struct(F.lit("part").alias("entity_type"), (F.col("l_partkey") + 100000000).alias("entity_id")))).alias("r")).select("r.*")
    targets = {"supplier": table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "part": table(spark, sf_dir, "part").select("p_partkey", "p_name")}
    return typed_references(refs, targets).groupBy("entity_type", "entity_name").agg(F.count("*").alias("n"))


@query("""
SELECT s_suppkey, c.r_name AS region, p.n_name AS nation FROM supplier JOIN nation p ON s_nationkey = n_nationkey JOIN region c ON n_regionkey = r_regionkey
""")
def parent_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    parents = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("region"), F.col("n_name").alias("nation"))
    return table(spark, sf_dir, "supplier").join(parents, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "region", "nation")


@query(f"""
SELECT doc_id, {_norm("text", ".")} AS lookup_form, {_norm("text", ".-")} AS match_form FROM documents
""")
def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both normal forms of whole texts."""
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize_lookup(F.col("text")).alias("lookup_form"), text.normalize_match(F.col("text")).alias("match_form"))


@query(f"""
WITH n AS (SELECT p_partkey, '.' || p_size || ' ' || p_name || ' Inc.' AS name FROM part)
SELECT p_partkey, array_to_string(list_transform(string_split({_norm("name", ".")}, ' '), lambda t: ltrim(t, '.')), ' ') AS caliber_form FROM n
""")
def normalize_calibers(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("."), F.col("p_size").cast("string"), F.lit(" "), F.col("p_name"), F.lit(" Inc."))
    return table(spark, sf_dir, "part").select("p_partkey", text.normalize_caliber(name).alias("caliber_form"))


@query("SELECT p_partkey, trim(regexp_replace(replace(lower(p_name), '™', ''), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part")
def slugify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", text.slugify(F.col("p_name")).alias("slug"))


@query("SELECT page_id, substr(sha256(url), 1, 16) AS url_hash, sha256(html) AS content_hash, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host FROM pages")
def url_hash_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.url_hash(F.col("url")).alias("url_hash"), text.content_hash(F.col("html")).alias("content_hash"), text.url_host(F.col("url")).alias("host"))


MEANINGFUL = """list_filter(list_distinct(string_split({0}, ' ')), lambda t: t <> '' AND NOT regexp_full_match(replace(t, '.', ''), '[0-9]+') AND NOT list_contains({1}, t))"""
NOISE = "[" + ", ".join(f"'{w}'" for w in text.NOISE_WORDS) + "]"


@query(f"""
WITH d AS (SELECT p_partkey, {MEANINGFUL.format(_norm("p_name", ".-"), NOISE)} AS q, p_brand FROM part),
r AS (SELECT p_brand, {MEANINGFUL.format(_norm("min(p_name)", ".-"), NOISE)} AS t FROM part GROUP BY p_brand),
j AS (SELECT p_partkey, q, t, len(list_intersect(q, t)) AS h FROM d JOIN r USING (p_brand))
SELECT p_partkey, CASE WHEN len(q) > 0 AND len(t) > 0 AND h > 0 THEN round(h / len(q)::DOUBLE * (0.5 + 0.5 * least(len(q) / 2.0::DOUBLE, 1.0)), 9) ELSE 0.0 END AS score FROM j
""")
def token_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each name is contained in its brand's first name."""
    part = table(spark, sf_dir, "part")
    first = part.groupBy("p_brand").agg(F.min("p_name").alias("known"))
    return part.join(first, "p_brand").select("p_partkey", F.round(text.containment_score(F.col("p_name"), F.col("known")), 9).alias("score"))


@query(
    "WITH t0 AS (SELECT p_partkey, list_concat(string_split(lower(p_name), ' '), CASE p_size % 4 WHEN 0 THEN ['hpbt'] WHEN 1 THEN ['boat', 'tail'] WHEN 2 THEN ['soft', 'point', 'tmk'] ELSE ['round', 'nose'] END) AS w FROM part)"
    + "".join(
        f", a{i} AS (SELECT p_partkey, CASE WHEN list_contains(w, '{a}') THEN list_concat(w, [{', '.join(repr(x) for x in ws)}]) ELSE w END AS w FROM t{i}), t{i + 1} AS (SELECT p_partkey, CASE WHEN list_has_all(w, [{', '.join(repr(x) for x in ws)}]) THEN list_append(w, '{a}') ELSE w END AS w FROM a{i})"
        for i, (a, ws) in enumerate(text.ABBREVIATIONS.items())
    )
    + f" SELECT p_partkey, array_to_string(list_sort(list_distinct(w)), ' ') AS words FROM t{len(text.ABBREVIATIONS)}"
)
def abbreviation_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Abbreviations and their words, both ways, in one ordered pass."""
    k = F.col("p_size") % 4
    more = F.when(k == 0, text.lit_array(["hpbt"])).when(k == 1, text.lit_array(["boat", "tail"])).when(k == 2, text.lit_array(["soft", "point", "tmk"])).otherwise(text.lit_array(["round", "nose"]))
    words = F.array_distinct(F.concat(F.split(F.lower("p_name"), " "), more))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.array_sort(text.expand_abbreviations(words)), " ").alias("words"))


@query()
def token_set_ratio_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perturbed supplier names against the nations: the most alike of a small dimension (no LCS in SQL)."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    typos = table(spark, sf_dir, "supplier").join(nation.toDF("s_nationkey", "true_name"), "s_nationkey")
    typos = typos.select("s_suppkey", "true_name", F.concat(F.substring("true_name", 2, 99), F.lit(" Inc.")).alias("said"))
    scored = typos.join(nation, F.length("said") + F.length("n_name") > 0).withColumn("score", name_similarity(F.col("said"), F.col("n_name"))).where("score > 0.5")
    return scored.groupBy("s_suppkey", "true_name").agg(F.min_by(F.struct("n_name", "score"), F.struct(-F.col("score"), "n_nationkey")).alias("b")).select("s_suppkey", "true_name", F.col("b.n_name").alias("matched"), F.round("b.score", 6).alias("score"))


@query()
def display_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short names from names with calibre, weight and pack noise (the patterns look around, which DuckDB's do not)."""
    part = table(spark, sf_dir, "part")
    noisy = F.concat(F.lit("30 Cal .308\" "), (F.col("p_size") + 100).cast("string"), F.lit(" gr "), F.initcap("p_name"), F.lit("® MATCHKING (50ct)"))
    return part.select("p_partkey", display.bullet_display_name(noisy, F.col("p_brand"), F.lit("Sierra")).alias("display_name"))


@query("SELECT p_partkey, CASE WHEN length(p_name || ' ' || p_type) > 20 THEN left(p_name || ' ' || p_type, 17) || '...' ELSE p_name || ' ' || p_type END AS short FROM part")
def truncated_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", text.truncated(F.concat_ws(" ", "p_name", "p_type"), 20).alias("short"))


@query("""
SELECT p_brand, count(*) AS n, count(*) FILTER (WHERE p_name = upper(p_name)) AS all_caps, count(*) FILTER (WHERE regexp_matches(p_name, '[0-9]')) AS has_digit,
       count(*) FILTER (WHERE length(p_name) > 20) AS long_name, count(*) FILTER (WHERE p_name ILIKE '%an%') AS has_an FROM part GROUP BY p_brand
""")
def name_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of patterns in names, by brand."""
    n = F.col("p_name")
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("n"), F.count_if(n == F.upper(n)).alias("all_caps"), F.count_if(n.rlike("[0-9]")).alias("has_digit"), F.count_if(F.length(n) > 20).alias("long_name"), F.count_if(n.ilike("%an%")).alias("has_an"))
