"""Upkeep of the catalogue: product lines seeded and filled in, measurements added once, excluded calibres, seed statements."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatio.functions.text import url_host
from curatio.operators.joins import band_join

#: Tables in the order in which a seed inserts them (parents first), and references of a table to itself.
SEED_ORDER = [
    "platform", "manufacturer", "chamber", "caliber", "chamber_accepts_caliber", "caliber_platform", "entity_alias",
    "reticle", "bullet", "bullet_bc_source", "optic", "cartridge", "rifle_model",
]
SELF_REFERENCES = {"caliber": "parent_caliber_id"}
#: Two measurements this close are one.
SAME_VALUE = 1e-9


def of_domain(rows: DataFrame, part: str, url: str = "url") -> DataFrame:
    """Rows whose host contains this text, in any case."""
    return rows.where(F.contains(url_host(F.col(url)), F.lit(part.lower())))


def envelope(document: Column, field: str, kind: str, default: Column | None = None) -> Column:
    """A field of a variant document: the value of an envelope, a plain value as it is, the default where there is neither."""
    path = f"$.{field}"
    whole = F.try_variant_get(document, path, "variant")
    wrapped = F.schema_of_variant(whole).startswith("OBJECT")
    value = F.when(wrapped, F.try_variant_get(document, f"{path}.value", kind)).otherwise(F.try_variant_get(document, path, kind))
    return value if default is None else F.coalesce(value, default)


def unseen_sources(new: DataFrame, known: DataFrame, key: list[str], value: str) -> DataFrame:
    """New measurements that no known one of the same key equals within 1e-9; repeats among the new ones go."""
    theirs = known.select(*(F.col(c).alias(f"__{c}") for c in [*key, value]))
    return band_join(new.dropDuplicates([*key, value]), theirs, (value, f"__{value}"), SAME_VALUE, also=[(c, f"__{c}") for c in key], how="left_anti")


def rejected_calibers(spark: SparkSession, path: str) -> DataFrame:
    """(name): the calibres that a JSON file lists as not wanted, in lower case."""
    listed = spark.read.schema("calibers array<string>").option("multiLine", True).json(path)
    return listed.select(F.explode("calibers").alias("name")).select(F.lower(F.trim("name")).alias("name")).distinct()


def with_excluded(rows: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Adds excluded_caliber: whether an unresolved reference of the row is to a calibre that is not wanted."""
    refs = rows.select(key, F.explode("unresolved_refs").alias("ref")).where(F.col("ref").startswith("caliber:"))
    hits = refs.select(key, F.lower(F.trim(F.substring("ref", F.lit(9), F.length("ref")))).alias("name")).join(names, "name", "left_semi")
    hits = hits.select(key).distinct().withColumn("excluded_caliber", F.lit(True))
    return rows.join(hits, key, "left").withColumn("excluded_caliber", F.coalesce("excluded_caliber", F.lit(False)))


# ---- product lines


def slug(name: Column) -> Column:
    plain = F.regexp_replace(F.lower(F.trim(name)), "[®™©]", "")
    return F.trim(F.regexp_replace(plain, "[^a-z0-9]+", "-"), F.lit("-"))


def seeded_lines(bullets: DataFrame, lines: DataFrame) -> DataFrame:
    """lines (id, maker_id, name, slug) with those that bullets (maker_id, product_line) name and nobody has yet.

    A line is known by its maker with its name, whatever the case, or its slug.  Of names with one slug the least is
    kept, and the id of a new line is a hash of maker and slug, the same in every run.
    """
    said = bullets.where("product_line is not null").select("maker_id", F.col("product_line").alias("name")).distinct().withColumn("slug", slug(F.col("name")))
    have = lines.select(F.col("maker_id").alias("__m"), F.lower("name").alias("__n"), F.col("slug").alias("__s"))
    same = F.col("maker_id").eqNullSafe(F.col("__m"))
    fresh = said.join(have, same & (F.lower("name") == F.col("__n")), "left_anti").join(have, same & (F.col("slug") == F.col("__s")), "left_anti")
    fresh = fresh.groupBy("maker_id", "slug").agg(F.min("name").alias("name"))
    return lines.select("id", "maker_id", "name", "slug").unionByName(fresh.withColumn("id", F.xxhash64("maker_id", "slug")))


def with_line_ids(bullets: DataFrame, lines: DataFrame) -> DataFrame:
    """bullets with product_line_id filled in where it is null and a line has the name, else the slug, of product_line."""
    by = lambda key, name: lines.groupBy(F.col("maker_id").alias(f"__m_{name}"), key.alias(f"__{name}")).agg(F.min("id").alias(f"__id_{name}"))
    out = bullets
    for name, key, own in (("name", F.lower("name"), F.lower("product_line")), ("slug", F.col("slug"), slug(F.col("product_line")))):
        out = out.join(by(key, name), F.col("maker_id").eqNullSafe(F.col(f"__m_{name}")) & (own == F.col(f"__{name}")), "left")
    filled = F.coalesce("product_line_id", "__id_name", "__id_slug")
    return out.select(*(filled.alias(c) if c == "product_line_id" else F.col(c) for c in bullets.columns))


def backfilled(rows: DataFrame, extractor: Callable[[list[dict]], list], size: int = 50) -> DataFrame:
    """(id, product_line, outcome) for rows (id, name, maker, is_locked) by an extractor that answers lists of rows.

    outcome: updated, locked, generic (no line, or a blank one), malformed, id_mismatch, or failed where the extractor
    fails or answers another number of rows.  Lists have at most ``size`` rows; which rows share one is not defined.
    """

    def told(row: dict, answer: object) -> tuple:
        if not isinstance(answer, dict) or (answer.get("id") is None or str(answer["id"]) == str(row["id"])) and "product_line" not in answer:
            return row["id"], None, "malformed"
        if answer.get("id") is not None and str(answer["id"]) != str(row["id"]):
            return row["id"], None, "id_mismatch"
        line = str(answer["product_line"] if answer["product_line"] is not None else "").strip()
        return (row["id"], line, "locked" if row["is_locked"] else "updated") if line else (row["id"], None, "generic")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            every = b.to_dict("records")
            for at in range(0, len(every), size):
                chunk = every[at : at + size]
                try:
                    answers = extractor([{k: r[k] for k in ("id", "name", "maker")} for r in chunk])
                except (OSError, ValueError):
                    answers = None
                if not isinstance(answers, list) or len(answers) != len(chunk):
                    out += [(r["id"], None, "failed") for r in chunk]
                else:
                    out += map(told, chunk, answers)
            yield pd.DataFrame(out, columns=["id", "product_line", "outcome"])

    kind = dict(rows.dtypes)["id"]
    return rows.select("id", "name", "maker", F.coalesce("is_locked", F.lit(False)).alias("is_locked")).mapInPandas(work, f"id {kind}, product_line string, outcome string")


# ---- seed statements


def seed_statements(tables: dict[str, DataFrame], order: list[str] = SEED_ORDER, self_references: dict[str, str] = SELF_REFERENCES, key: str = "id") -> DataFrame:
    """(place, pass, table_name, statement): inserts of all rows, parents first.

    A table that refers to itself is inserted without its references (pass 0), which updates fill in (pass 1), so
    within a place and pass statements may run in any order.
    """
    out = None
    for place, name in enumerate(n for n in order if n in tables):
        rows, parent = tables[name], self_references.get(name)
        columns = F.lit(", ".join(rows.columns))
        values = F.concat_ws(", ", *(F.lit("NULL") if f.name == parent else _literal(f) for f in rows.schema))
        made = rows.select(F.lit(0).alias("pass"), F.concat(F.lit(f"INSERT OR IGNORE INTO {name} ("), columns, F.lit(") VALUES ("), values, F.lit(");")).alias("statement"))
        if parent:
            later = F.concat(F.lit(f"UPDATE {name} SET {parent} = "), _literal(rows.schema[parent]), F.lit(f" WHERE {key} = "), _literal(rows.schema[key]), F.lit(";"))
            made = made.unionByName(rows.where(F.col(parent).isNotNull()).select(F.lit(1).alias("pass"), later.alias("statement")))
        made = made.select(F.lit(place).alias("place"), "pass", F.lit(name).alias("table_name"), "statement")
        out = made if out is None else out.unionByName(made)
    if out is None:
        raise ValueError("no table of the seed's order is given")
    return out


def _literal(field: T.StructField) -> Column:
    x = F.col(field.name)
    if isinstance(field.dataType, T.BooleanType):
        x = x.cast("int")
    text = x.cast("string") if isinstance(field.dataType, (T.NumericType, T.BooleanType)) else F.concat(F.lit("'"), F.replace(x.cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))
    return F.coalesce(text, F.lit("NULL"))
