"""Streaming queries, drained over the driver's tables (extensions)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.plans.registry import query, table
from curatio.sources.scratch import shared_folder
from curatio.streaming.incremental import drained, file_stream, new_pages, sessions, windows


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling windows over a file stream; the last state of every window."""
    out = f"{shared_folder(spark)}/windows-{uuid.uuid4().hex[:12]}"
    drained(windows(file_stream(spark, sf_dir, "events"), "1 day"), lambda batch, _: batch.write.mode("overwrite").parquet(out), "complete")
    return spark.read.parquet(out).select(F.col("window.start").cast("timestamp_ntz").alias("day"), "event_type", "n", "total")


@query("SELECT substr(sha256(url), 1, 16) AS url_hash, count(*) AS n FROM (SELECT DISTINCT url FROM pages) GROUP BY 1")
def stream_new_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each address once, however often it comes."""
    out = f"{shared_folder(spark)}/pages-{uuid.uuid4().hex[:12]}"
    drained(new_pages(file_stream(spark, sf_dir, "pages")), lambda batch, i: batch.select("url_hash").write.mode("overwrite").parquet(f"{out}/batch={i}"))
    return spark.read.parquet(out).groupBy("url_hash").agg(F.count("*").alias("n"))


@query("""
WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e) SELECT user_id, count(*) AS n_sessions, max(n) AS longest FROM (SELECT user_id, k, count(*) AS n FROM s GROUP BY 1, 2) GROUP BY 1
""")
def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions by gap: the streaming operator on a table."""
    return sessions(table(spark, sf_dir, "events")).groupBy("user_id").agg(F.count("*").alias("n_sessions"), F.max("n").alias("longest"))
