"""Substring dedup by seeding and extending: every passage of ``window`` words that also stands elsewhere.

Seeds.  Every run of ``gram`` words has a hash; every window of ``window`` words names as its anchor the gram
with the least hash in it (of equals the last).  Equal windows name equal anchors at equal places, so two
equal passages always meet at an anchor, whatever stands around them, and about one word in ten is an anchor.
Anchors that occur once are dropped by a count.

Extension.  What is left is extended both ways, as far as windows name the same anchor: that stretch is a run.
Runs with equal words are repeats as a whole.  Where an anchor's runs differ, as at the ends of a repeat, its
distinct runs are compared window by window.  The windows found are joined to maximal repeats: spans of words.

No occurrence is paired with another: equality is told by counts over (anchor, hash), so a passage in a third
of all documents is as cheap as one in two.  Copies of a text count as one class and are not compared at all.
Texts travel once, to be extended, and those with repeats once more, compressed, to be cut.

Null texts have no words.  Repeated rows are copies.  Texts shorter than a window keep all their words.  An
empty table gives an empty result.  Other columns are not carried.  Equality is by two 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from curatio.llm.shared import U64, bytes_hash, chunks, inside, lists, scratch, signed, spans_hash, text_key, words

EMPTY = hashlib.sha256(b"").hexdigest()


def anchors(hashes: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts, the position of each window's anchor, and the gram hash at every position (0 where none fits)."""
    starts = inside(bounds, window)
    if not len(starts):
        return starts, starts, np.zeros(len(hashes), U64)
    n = len(hashes) - gram + 1
    at = np.arange(n)
    grams = spans_hash(hashes, at, at + gram)
    low = ((grams >> U64(32)) << U64(32)) | (U64(0xFFFFFFFF) - at.astype(U64))
    size, width = 1, window - gram + 1
    while 2 * size <= width:
        low = np.minimum(low[: len(low) - size], low[size:])
        size *= 2
    least = np.minimum(low[starts], low[starts + width - size])
    return starts, (U64(0xFFFFFFFF) - (least & U64(0xFFFFFFFF))).astype(np.int64), np.append(grams, np.zeros(gram - 1, U64))


def runs(starts: np.ndarray, named: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last (exclusive) index of each stretch of windows in a row that name the same anchor."""
    new = np.concatenate([[True], (named[1:] != named[:-1]) | (starts[1:] != starts[:-1] + 1)]) if len(starts) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(starts))


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap as one."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def deduplicated(docs: DataFrame, *, text: str = "text", key: str = "doc_id", window: int = 35, gram: int = 16, with_text: bool = False) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256, spans[, kept_text]) for every row; spans: the words [start, end) that go.

    kept_text is null where nothing goes or everything does: the text is then the row's own, or empty."""
    kind = docs.schema[key].dataType
    k1, k2 = text_key(F.col(text).cast("string"))
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), k1.alias("k1"), k2.alias("k2"))

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches, "text"):
            begin, end, bounds = words(data, offsets)
            hashes = bytes_hash(data, begin, end)
            starts, named, grams = anchors(hashes, bounds, window, gram)
            first, _ = runs(starts, named)
            at = named[first]
            raw = memoryview(data.tobytes())
            full = [hashlib.sha256(b" ".join(bytes(raw[a:b]).split())).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            doc = np.searchsorted(bounds, at, "right") - 1
            cuts = np.searchsorted(doc, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("k1"), part.column("k2"), pa.array(np.diff(bounds)), pa.array(full), lists(signed(grams[at]), cuts), lists(pa.array((at - bounds[doc]).astype(np.int32)), cuts)],
                ["key", "k1", "k2", "n_words", "full", "anchors", "places"],
            )

    seeded = StructType([StructField("key", kind), StructField("k1", LongType()), StructField("k2", LongType()), StructField("n_words", LongType()), StructField("full", StringType()), StructField("anchors", ArrayType(LongType())), StructField("places", ArrayType(IntegerType()))])
    read = scratch(rows.select("key", "k1", "k2", "text").mapInArrow(seed, seeded), "seeds")
    found = read.select("key", "k1", "k2", F.explode(F.arrays_zip("anchors", "places")).alias("x")).select("key", "k1", "k2", F.col("x.anchors").alias("anchor"), F.col("x.places").alias("place"))
    # an occurrence is a place in a class of copies; two different ones make a seed
    one = F.xxhash64("k1", "k2", "place")
    seeds = scratch(found.groupBy("anchor").agg(F.min(one).alias("a"), F.max(one).alias("b")).where("a != b").select("anchor"), "repeated")
    hits = found.join(seeds, "anchor", "left_semi").groupBy("k1", "k2").agg(F.min("key").alias("key"), F.collect_set("place").alias("places"))
    whole = rows.join(hits.withColumnRenamed("key", "rep"), (rows.k1 == hits.k1) & (rows.k2 == hits.k2) & rows.key.eqNullSafe(F.col("rep"))).select(rows.k1, rows.k2, "places", "text")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for part, data, offsets in chunks(batches, "text"):
            begin, end, bounds = words(data, offsets)
            hashes = bytes_hash(data, begin, end)
            starts, named, grams = anchors(hashes, bounds, window, gram)
            places = part.column("places")
            marked = np.zeros(len(hashes), bool)
            marked[np.array(places.flatten()) + np.repeat(bounds[:-1], np.array(places.value_lengths()))] = True
            first, last = runs(starts, named)
            told = marked[named[first]]
            first, last = first[told], last[told]
            content = spans_hash(hashes, starts[first], starts[last - 1] + window)
            windows = spans_hash(hashes, starts, starts + window)
            doc = np.searchsorted(bounds, starts[first], "right") - 1
            size = last - first
            inner = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
            run = pa.StructArray.from_arrays(
                [signed(grams[named[first]]), signed(content), pa.array((starts[first] - bounds[doc]).astype(np.int32)), lists(signed(windows[inner]), np.append(0, np.cumsum(size)))],
                ["anchor", "content", "start", "windows"],
            )
            raw = memoryview(data.tobytes())
            text = [press.compress(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            cuts = np.searchsorted(doc, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_arrays([part.column("k1"), part.column("k2"), pa.array(text, pa.binary()), lists(run, cuts)], ["k1", "k2", "text", "runs"])

    extended = scratch(whole.mapInArrow(extend, "k1 bigint, k2 bigint, text binary, runs array<struct<anchor:bigint,content:bigint,start:int,windows:array<bigint>>>"), "extended")
    run = extended.select("k1", "k2", F.explode("runs").alias("r")).select("k1", "k2", "r.*")
    one = F.xxhash64("k1", "k2", "start")
    contents = scratch(run.groupBy("anchor", "content").agg(F.min(one).alias("a"), F.max(one).alias("b"), F.min("windows").alias("windows")), "contents")
    repeated = contents.where("a != b").select("anchor", "content", F.lit(None).cast("array<int>").alias("only"))
    # anchors with different runs: those are compared by window
    mixed = scratch(contents.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "mixed")
    each = contents.join(mixed, "anchor", "left_semi").select("anchor", "content", (F.col("a") == F.col("b")).alias("single"), F.posexplode("windows").alias("d", "w"))
    each = scratch(each, "windows")
    twice = scratch(each.groupBy("anchor", "w").agg(F.min("content").alias("a"), F.max("content").alias("b")).where("a != b").select("anchor", "w"), "twice")
    some = each.where("single").join(twice, ["anchor", "w"], "left_semi").groupBy("anchor", "content").agg(F.collect_list("d").alias("only"))
    verdict = scratch(repeated.unionByName(some), "verdict")
    covered = run.select("k1", "k2", "anchor", "content", "start", F.size("windows").alias("n")).join(verdict, ["anchor", "content"])
    span = F.when(F.col("only").isNull(), F.array(F.struct("start", (F.col("start") + F.col("n") - 1 + window).alias("end")))).otherwise(
        F.transform("only", lambda d: F.struct((F.col("start") + d).alias("start"), (F.col("start") + d + window).alias("end")))
    )
    spans = scratch(covered.select("k1", "k2", F.explode(span).alias("s")).groupBy("k1", "k2").agg(F.collect_set("s").alias("spans")), "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            out: dict[str, list] = {"n_removed": [], "kept_sha256": [], "spans": [], "kept_text": []}
            for text, spans_ in zip(batch.column("text"), batch.column("spans").to_pylist(), strict=True):
                own = unpress.decompress(text.as_py()).split()
                gone = joined([(s["start"], s["end"]) for s in spans_])
                keep, at = [], 0
                for s, e in gone:
                    keep += own[at:s]
                    at = e
                keep += own[at:]
                kept = b" ".join(keep)
                out["n_removed"].append(len(own) - len(keep))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["spans"].append([{"start": s, "end": e} for s, e in gone])
                out["kept_text"].append(kept.decode() if with_text else None)
            kinds = {"n_removed": pa.int64(), "kept_sha256": pa.string(), "spans": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), "kept_text": pa.string()}
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), *(pa.array(v, kinds[k]) for k, v in out.items())], ["k1", "k2", *out])

    done = "k1 bigint, k2 bigint, n_removed bigint, kept_sha256 string, spans array<struct<start:int,end:int>>, kept_text string"
    cuts = extended.select("k1", "k2", "text").join(spans.hint("merge"), ["k1", "k2"]).mapInArrow(cut, done)
    classes = read.groupBy("k1", "k2").agg(F.max("n_words").alias("n"), F.count("*").alias("copies")).where(f"copies > 1 and n >= {window}")
    all_of_it = classes.select("k1", "k2", F.col("n").alias("n_removed"), F.lit(EMPTY).alias("kept_sha256"), F.array(F.struct(F.lit(0).alias("start"), F.col("n").cast("int").alias("end"))).alias("spans"), F.lit(None).cast("string").alias("kept_text"))
    # whole classes go before what the extension found in one of their copies
    told = all_of_it.withColumn("p", F.lit(0)).unionByName(cuts.withColumn("p", F.lit(1)))
    told = scratch(told.groupBy("k1", "k2").agg(F.min_by(F.struct("n_removed", "kept_sha256", "spans", "kept_text"), "p").alias("t")).select("k1", "k2", "t.*"), "cuts")
    out = read.select("key", "k1", "k2", "n_words", "full").join(told.hint("merge"), ["k1", "k2"], "left")
    columns = [F.col("key").alias(key), "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("kept_sha256", "full").alias("kept_sha256"), F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans")]
    return out.select(*columns, *["kept_text"] * with_text)


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")


ORACLE = r"""
WITH k AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM k)),
r AS (SELECT doc_id, i FROM s WHERE x IN (SELECT x FROM s GROUP BY x HAVING count(*) > 1)),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM r),
u AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM k),
m AS (SELECT u.doc_id, count(c.p) AS n_removed, string_agg(word, ' ' ORDER BY u.p) FILTER (WHERE c.p IS NULL) AS kept FROM u LEFT JOIN c ON c.doc_id = u.doc_id AND c.p = u.p GROUP BY u.doc_id)
SELECT k.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM k LEFT JOIN m ON m.doc_id = k.doc_id
"""
