"""Token counts by the whole-token shortcut.

Which vocabulary strings encode alone as one token is proved once for a tokenizer, by encoding each.  A
text is cut into pre-tokens; those among the proved strings count 1 without a merge, and only the rest
go through the merges of the library, each distinct one once a batch.

Nulls and empty texts count 0 tokens and 0 bytes.  Repeated rows each get their own row.  An empty table
gives an empty table.  Other columns are not carried, so clashing names do no harm.  A text of any length
is one value of one row; it is cut into pre-tokens as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.llm.bpe import loaded
from curatio.llm.shared import chunks


def token_counts(docs: DataFrame, tokenizer: str, *, text: str = "text", key: str = "doc_id", limit: int = 1024) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for each row; tokenizer: the path of a byte-level BPE's JSON."""
    with open(tokenizer, encoding="utf-8") as f:  # the driver's own file; its text goes along as a broadcast
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema[key].dataType

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(definition.value)
        for part, data, offsets in chunks(batches, "text"):
            raw = memoryview(data.tobytes())
            texts = [str(raw[offsets[i] : offsets[i + 1]], "utf-8") for i in range(part.num_rows)]
            n = pa.array(bpe.counts(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(offsets[1:] - offsets[:-1], pa.int64()), n], ["key", "n_bytes", "n_tokens"])

    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([StructField("key", kind), StructField("n_bytes", LongType()), StructField("n_tokens", LongType())])
    counted = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(count, schema)
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
