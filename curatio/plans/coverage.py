"""Coverage and counting reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.operators.joins import preferred
from curatio.plans.registry import query, table

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@query("""
SELECT n_name, count(*) AS suppliers, count(*) FILTER (WHERE s_acctbal > 0) AS in_credit,
       count(*) FILTER (WHERE s_acctbal IS NULL OR s_acctbal = 0) AS missing_balance,
       CAST(round(sum(s_acctbal), 2) AS DOUBLE) AS balance
FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name
""")
def supplier_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers by nation with conditional counts."""
    joined = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(
        F.count("*").alias("suppliers"),
        F.count_if(F.col("s_acctbal") > 0).alias("in_credit"),
        F.count_if(F.col("s_acctbal").isNull() | (F.col("s_acctbal") == 0)).alias("missing_balance"),
        F.round(F.sum("s_acctbal"), 2).alias("balance"),
    )


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES))
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table; each count comes from file footers."""
    out = None
    for t in TABLES:
        one = table(spark, sf_dir, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("""
SELECT c_mktsegment, count(*) AS n, count(c_acctbal) AS has_balance, count(*) FILTER (WHERE c_acctbal < 0) AS overdrawn,
       round(100.0 * count(*) FILTER (WHERE c_acctbal < 0) / count(*), 4) AS pct_overdrawn
FROM customer GROUP BY c_mktsegment
""")
def field_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled and out-of-band fields by segment."""
    over = F.count_if(F.col("c_acctbal") < 0)
    return table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.count("c_acctbal").alias("has_balance"), over.alias("overdrawn"), F.round(100.0 * over / F.count("*"), 4).alias("pct_overdrawn"))


@query("SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY p_brand, p_type")
def brand_by_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))


@query("""
WITH f AS (
  SELECT p_brand, 'type' AS facet, p_type AS v FROM part UNION ALL
  SELECT p_brand, 'size', CAST(p_size AS VARCHAR) FROM part UNION ALL
  SELECT p_brand, 'supplier', CAST(l_suppkey AS VARCHAR) FROM part JOIN lineitem ON l_partkey = p_partkey)
SELECT p_brand, count(DISTINCT CASE WHEN facet = 'type' THEN v END) AS types, count(DISTINCT CASE WHEN facet = 'size' THEN v END) AS sizes,
       count(DISTINCT CASE WHEN facet = 'supplier' THEN v END) AS suppliers FROM f GROUP BY p_brand
""")
def facet_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values by facet, pivoted: distinct first, so that what is shuffled for the counts is small."""
    part, line = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    sold = line.select("l_partkey", "l_suppkey").distinct().join(part, F.col("l_partkey") == F.col("p_partkey"))
    facets = part.select("p_brand", F.lit("type").alias("facet"), F.col("p_type").alias("v"))
    facets = facets.unionByName(part.select("p_brand", F.lit("size").alias("facet"), F.col("p_size").cast("string").alias("v")))
    facets = facets.unionByName(sold.select("p_brand", F.lit("supplier").alias("facet"), F.col("l_suppkey").cast("string").alias("v")))
    count = lambda f: F.count_if((F.col("facet") == f) & F.col("v").isNotNull())
    return facets.distinct().groupBy("p_brand").agg(count("type").alias("types"), count("size").alias("sizes"), count("supplier").alias("suppliers"))


@query("""
SELECT p.p_size, count(DISTINCT p.p_partkey) AS parts, count(DISTINCT l.l_suppkey) AS suppliers, count(DISTINCT l.l_orderkey) AS orders
FROM part p LEFT JOIN lineitem l ON l.l_partkey = p.p_partkey GROUP BY p.p_size
""")
def value_join_distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts after a join that fans out."""
    part, line = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey")
    at = part.select("p_partkey", "p_size").join(line, F.col("l_partkey") == F.col("p_partkey"), "left")
    return at.groupBy("p_size").agg(F.countDistinct("p_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct("l_orderkey").alias("orders"))


@query("""
SELECT printf('%d', CAST(floor(p_retailprice / 4) AS BIGINT)) AS band, count(*) AS n, min(p_retailprice) AS low, max(p_retailprice) AS high,
       string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS brands FROM part GROUP BY 1
""")
def rounded_band_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary by rounded value, with a sorted list of what is in each band."""
    band = F.format_string("%d", F.floor(F.col("p_retailprice") / 4))
    return table(spark, sf_dir, "part").groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.min("p_retailprice").alias("low"), F.max("p_retailprice").alias("high"), F.array_join(F.array_sort(F.collect_set("p_brand")), ",").alias("brands"))


@query("SELECT n_name, count(c_custkey) AS customers FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal > 9000 GROUP BY n_name")
def zero_kept_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that keep groups without rows: counted first, joined after."""
    rich = table(spark, sf_dir, "customer").where("c_acctbal > 9000").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return table(spark, sf_dir, "nation").join(rich, F.col("n_nationkey") == F.col("c_nationkey"), "left").groupBy("n_name").agg(F.sum(F.coalesce("n", F.lit(0))).alias("customers"))


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_rank_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top k with a total order: TakeOrderedAndProject, no full sort."""
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey", "o_totalprice", "o_orderpriority")


@query("""
SELECT n_name FROM nation n WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_nationkey = n.n_nationkey AND s.s_acctbal > 5000)
AND n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900 AND c_nationkey IS NOT NULL)
""")
def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What has neither: two anti joins."""
    rich_s = table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("n_nationkey"))
    rich_c = table(spark, sf_dir, "customer").where("c_acctbal > 9900").select(F.col("c_nationkey").alias("n_nationkey"))
    return table(spark, sf_dir, "nation").join(rich_s, "n_nationkey", "left_anti").join(rich_c, "n_nationkey", "left_anti").select("n_name")


@query("""
SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)
AND p_size IN (SELECT DISTINCT p_size FROM part WHERE p_retailprice > 999)
""")
def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreferenced rows among those with an accepted value: an anti and a semi join."""
    part = table(spark, sf_dir, "part")
    big = table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return part.join(big, "p_partkey", "left_anti").join(part.where("p_retailprice > 999").select("p_size").distinct(), "p_size", "left_semi").select("p_partkey")


@query("""
SELECT l_partkey, arg_min(l_suppkey, (CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) * 1000000000000 + l_suppkey) AS l_suppkey FROM lineitem GROUP BY l_partkey
""")
def preferred_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One link per key: a preferred one, else the least."""
    return preferred(table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag"), ["l_partkey"], F.col("l_returnflag") == "R", ["l_suppkey"]).select("l_partkey", "l_suppkey")


GAPS = """
WITH have AS (SELECT p_type, count(*) AS have FROM part WHERE p_retailprice > 950 GROUP BY p_type),
sold AS (SELECT p_type, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type),
ranked AS (SELECT p_type, rank() OVER (ORDER BY n DESC, p_type) AS r FROM sold),
t AS (SELECT p_type, CASE WHEN r <= 2 THEN 200 WHEN r <= 5 THEN 120 WHEN r <= 10 THEN 60 WHEN r <= 25 THEN 20 ELSE 5 END AS target FROM ranked),
g AS (SELECT t.p_type, target, coalesce(have, 0) AS have, greatest(0, target - coalesce(have, 0)) AS gap FROM t LEFT JOIN have USING (p_type))
"""


@query(GAPS + "SELECT p_type, target, have, gap FROM g")
def gap_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets by tier of popularity, what is there, and what is missing: two aggregates and a join."""
    part, line = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    have = part.where("p_retailprice > 950").groupBy("p_type").agg(F.count("*").alias("have"))
    sold = line.groupBy("l_partkey").agg(F.count("*").alias("k")).join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type").agg(F.sum("k").alias("n"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "p_type")))
    ranked = sold.agg(order.alias("a")).select(F.posexplode("a").alias("r", "x")).select("r", "x.p_type")  # types are a dimension
    target = F.when(F.col("r") < 2, 200).when(F.col("r") < 5, 120).when(F.col("r") < 10, 60).when(F.col("r") < 25, 20).otherwise(5)
    out = ranked.withColumn("target", target).join(have, "p_type", "left").withColumn("have", F.coalesce("have", F.lit(0).cast("long")))
    return out.select("p_type", "target", "have", F.greatest(F.lit(0), F.col("target") - F.col("have")).alias("gap"))


@query(GAPS + "SELECT CASE WHEN gap = 0 THEN 'none' WHEN gap >= 100 THEN 'high' WHEN gap >= 20 THEN 'medium' ELSE 'low' END AS priority, count(*) AS n, sum(gap) AS total, (list(p_type ORDER BY p_type))[1:10]::VARCHAR AS first_names FROM g GROUP BY 1")
def gap_priority_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps by priority with the first names of each."""
    g = gap_targets(spark, sf_dir)
    priority = F.when(F.col("gap") == 0, "none").when(F.col("gap") >= 100, "high").when(F.col("gap") >= 20, "medium").otherwise("low")
    names = F.slice(F.array_sort(F.collect_list("p_type")), 1, 10)
    return g.groupBy(priority.alias("priority")).agg(F.count("*").alias("n"), F.sum("gap").alias("total"), F.concat(F.lit("["), F.array_join(names, ", "), F.lit("]")).alias("first_names"))
