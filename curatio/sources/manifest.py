"""Work lists of addresses: read, checked, merged, and what of them is still to be done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.functions.text import url_hash
from curatio.operators.joins import first_per_key

SCHEMA = "url string, entity_type string, expected_manufacturer string, expected_caliber string, priority string, source_type string, discovery_method string, brief_description string, confidence double, notes string, _corrupt_record string"
#: What each field may hold.
ENTITY_TYPES = ["bullet", "cartridge", "rifle"]
SOURCE_TYPES = ["manufacturer", "retailer", "review", "reference"]
DISCOVERY_METHODS = ["ai_research", "manual", "crawl", "known", "cowork_research"]


def read_manifest(spark: SparkSession, *paths: str) -> DataFrame:
    """Entries of JSON arrays with their position; of an address in several lists the first list's entry stays."""
    out = None
    for i, path in enumerate(paths):
        one = spark.read.schema(SCHEMA).option("multiLine", True).option("mode", "PERMISSIVE").json(path).withColumn("list", F.lit(i)).withColumn("pos", F.monotonically_increasing_id())
        out = one if out is None else out.unionByName(one)
    return out


def first_listed(entries: DataFrame) -> DataFrame:
    return first_per_key(entries, "url", ["list", "pos"])


def problems(entries: DataFrame) -> DataFrame:
    """(pos, url, level, problem): one row per fault; errors keep a list from being used, warnings do not."""
    repeated = entries.where("url is not null").groupBy("url").agg(F.min(F.struct("list", "pos")).alias("__first"), F.count("*").alias("__n")).where("__n > 1")
    at = entries.join(repeated, "url", "left")
    again = F.col("__n").isNotNull() & (F.struct("list", "pos") != F.col("__first"))
    missing = lambda f: F.coalesce(F.col(f), F.lit("")) == ""
    odd = lambda f, known: ~missing(f) & ~F.col(f).isin(known)
    checks = [
        ("error", "corrupt entry", F.col("_corrupt_record").isNotNull()),
        *(("error", f"missing {f}", missing(f)) for f in ("url", "entity_type", "expected_manufacturer")),
        ("error", "invalid url", ~missing("url") & ~F.col("url").rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+")),
        ("error", "duplicate url", again),
        ("error", "invalid entity_type", odd("entity_type", ENTITY_TYPES)),
        ("warning", "unknown source_type", odd("source_type", SOURCE_TYPES)),
        ("warning", "unknown discovery_method", odd("discovery_method", DISCOVERY_METHODS)),
        ("warning", "priority is no integer", ~missing("priority") & F.col("priority").try_cast("int").isNull()),
        *(("warning", f"missing {f}", missing(f)) for f in ("expected_caliber", "priority")),
    ]
    told = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(level).alias("level"), F.lit(name).alias("problem"))) for level, name, c in checks)))
    return at.select("pos", "url", F.explode(told).alias("p")).select("pos", "url", "p.*")


def pending(entries: DataFrame, cache: DataFrame, schema_versions: dict[str, int]) -> DataFrame:
    """Entries without a cached, non-empty result of the current version of their type."""
    version = F.create_map(*(F.lit(x) for pair in schema_versions.items() for x in pair))
    done = cache.where((F.col("entity_count") > 0) & (F.col("schema_version") >= version[F.col("entity_type")])).select("url_hash")
    return entries.withColumn("url_hash", url_hash(F.col("url"))).join(done.distinct(), "url_hash", "left_anti")


def tallies(entries: DataFrame, top: int = 10) -> tuple[DataFrame, DataFrame]:
    """Entries by type, and the makers with most."""
    by_type = entries.groupBy("entity_type").agg(F.count("*").alias("n"))
    return by_type, entries.groupBy("expected_manufacturer").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "expected_manufacturer").limit(top)
