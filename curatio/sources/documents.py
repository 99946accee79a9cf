"""Folders of documents: JSON files by their stems, corrupt ones apart, and pages by their hashes; reports as Markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_STEM = r"([^/]+)\.[A-Za-z]+$"


def read_folder(spark: SparkSession, folder: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """A folder's JSON files, one document each: (stem, fields) of those that can be read, and (stem, text) of the corrupt.

    Rows have no order; ``stem`` is what to order by."""
    files = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), _STEM, 1).alias("stem"), F.col("value").alias("text"))
    sound = F.try_parse_json("text").isNotNull()
    return files.where(sound).select("stem", F.from_json("text", schema).alias("d")).select("stem", "d.*"), files.where(~sound)


def with_html(entries: DataFrame, folder: str, key: str = "url_hash") -> DataFrame:
    """entries with the page that a folder holds under their hash; null where there is none."""
    pages = entries.sparkSession.read.option("pathGlobFilter", "*.html").text(folder, wholetext=True)
    pages = pages.select(F.regexp_extract(F.col("_metadata.file_path"), _STEM, 1).alias(key), F.col("value").alias("html"))
    return entries.join(pages, key, "left")


def markdown(rows: DataFrame, title: str, most: int = 50) -> str:
    """A report's first rows as a Markdown table: for aggregates, of which no more than ``most`` rows reach the driver."""
    found = rows.limit(most + 1).collect()
    if not found:
        return f"## {title}\n\nNo rows.\n"
    cell = lambda x: "" if x is None else str(x).replace("|", "\\|").replace("\n", " ")
    lines = [f"| {' | '.join(rows.columns)} |", "|" + "-|" * len(rows.columns), *(f"| {' | '.join(map(cell, r))} |" for r in found[:most])]
    return "\n".join([f"## {title}", "", *lines, "", *([f"(first {most} rows)", ""] if len(found) > most else [])])
