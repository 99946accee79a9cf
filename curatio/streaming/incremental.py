"""Streams over files that keep coming: new pages once, events by window.

Extensions: what they stand beside are resumable caches keyed by an address's hash.  State is bounded by a
watermark where time is told; results go to tables in the shared folder through ``foreachBatch``, which writes
each batch under its number, so a batch that is repeated after a failure replaces itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.functions.text import url_hash
from curatio.sources.scratch import shared_folder


def file_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table's files in a folder as a stream, with the schema of what is there; a table may be one file or a folder of parts."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}*.parquet")


def drained(stream: DataFrame, sink: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Runs a stream over all that is there now, then stops; progress is kept in the shared folder."""
    at = f"{shared_folder(stream.sparkSession)}/progress-{uuid.uuid4().hex[:12]}"
    stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", at).trigger(availableNow=True).start().awaitTermination()


def new_pages(pages: DataFrame, hours: int = 24) -> DataFrame:
    """Each address once, as long as its hash is remembered: with a time column ``ts`` for ``hours``, else for good."""
    keyed = pages.withColumn("url_hash", url_hash(F.col("url")))
    if "ts" in pages.columns:
        return keyed.withWatermark("ts", f"{hours} hours").dropDuplicatesWithinWatermark(["url_hash"])
    return keyed.dropDuplicates(["url_hash"])


def timed(events: DataFrame) -> DataFrame:
    """Watermarks need instants: times without a zone are read in the session's."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def windows(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by window and type; events later than ``late`` are left out."""
    return timed(events).withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """A user's events without a longer gap, as one session."""
    return timed(events).withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
