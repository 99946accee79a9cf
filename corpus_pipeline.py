"""From raw documents to packed sequences: toxicity, near-dedup, PII, source mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the columns of
``documents``; the last returns the packed pieces.  ``run`` writes each stage's result to the shared scratch
folder and reads it again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.llm.mixing import mixed_texts
from curatio.llm.near_duplicates import near_duplicates
from curatio.llm.packing import packed
from curatio.llm.pii import pseudonymised
from curatio.llm.shared import scratch
from curatio.llm.toxicity import held_out, scored, train

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents that score at least this much are rejected.
TOXIC = 0.3
#: The key of the surrogates; a real run takes its own from where its secrets are kept.
PII_KEY = "curatio-demonstration-key"


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxic score; the model is trained on the labels' training part and the documents given.

    Null and empty texts are scored as texts without words; every repeated row is kept or goes like the others; null ids
    carry no label; very long texts are scored whole; there are no ties, as no row is compared with another.  An empty
    table gives an empty one, and further columns of docs, whatever their names, are left out."""
    learnt = ~F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(learnt), training=learnt)
    return scored(docs.select(*COLUMNS), model, out="toxic_score").where(F.col("toxic_score") < TOXIC).drop("toxic_score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates: the one with the least doc_id, nulls last; of equal ids, one row.

    Null and empty texts are one class; repeated rows are copies, of which one stays; very long texts are compared whole.
    An empty table gives an empty one, and further columns of docs are left out."""
    rows = scratch(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "rows")
    classes = near_duplicates(rows, key="row").select(F.col("row").alias("of"), "class_id")
    ranked = rows.select("doc_id", "row").join(classes.hint("merge"), F.col("row") == F.col("of"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    kept = scratch(ranked.groupBy("class_id").agg(F.min(order)["row"].alias("kept_row")).select("kept_row"), "kept")
    return rows.join(kept.hint("merge"), F.col("row") == F.col("kept_row"), "left_semi").select(*COLUMNS)


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data replaced by surrogates.

    Null texts stay null, with no number of characters, and empty ones empty; repeated rows stay, and are replaced alike;
    null ids matter nothing; very long texts are searched whole; ties between surrogates go to the least form.  An empty
    table gives an empty one, and further columns of docs are left out."""
    return pseudonymised(docs.select(*COLUMNS), PII_KEY).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each pass of the mix that takes words of a document, with these as its text; a document of which it takes
    none, as one with a null or empty text, is not in the mix.

    Repeated rows are documents of their own; rows that tie in the order are interchangeable; a null source is a source, and
    null ids stand together in its order; of very long texts any part may be taken.  An empty table gives an empty one, and
    further columns of docs are left out."""
    return mixed_texts(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1,024 tokens, one row per piece, with the piece's ids.

    A null or empty text is its end id alone; repeated rows are packed each on their own; null ids stay null; a very long
    text is a run of whole sequences; rows that tie are equal.  An empty table gives no pieces, and other columns are not
    carried."""
    return packed(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("toxicity", remove_toxic),
    ("near_dedup", drop_near_duplicates),
    ("pii", replace_pii),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained weights, sampled sketches and tokenizer ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
