"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier in numpy is fitted from confirmed toxic documents and unlabelled text.  With the class
prior p, the risk is p R(positive as +) + max(0, R(unlabelled as -) - p R(positive as -)): what the positives
hidden in the unlabelled text add to the negative risk is taken off again, and where the estimate would fall
below zero the step is turned round, which keeps the model from fitting the unlabelled text by heart.

Features: the presence of each word and of its first 4, 5, 6 and 7 bytes, ASCII letters lowered, hashed to
2**20 places.  The fit sees at most ``positives`` confirmed documents and ``unlabelled`` documents of the training part,
with or without a label, chosen by a hash of the id; the prior counts every training label.  How often each place occurs
in the two samples is summed up by place; the at most ``keep`` places that set positives apart go to the driver, and
then, for each document of the samples, which of these it has.  Scores never see labels, language, source or ids.

Null texts are empty; an empty text scores as the bias says.  Repeated rows each get their own row; labels
that repeat an id count once a row in the prior, and an id of several rows once in the fit, by the least text.  Ties in
the hash go by id.  Without any confirmed positive every score is the prior, 0.  An empty table gives an empty result.
Long texts are read whole.  ``train`` carries no columns, ``scored`` all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from curatio.llm.shared import U64, chunks, crc32_of_id, lists, mix, powers, scratch, words

PLACES = 1 << 20
PREFIXES = (4, 5, 6, 7)
_BREAK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of every feature of every text, with repeats."""
    data = _LOWER[data]
    starts, ends, _ = words(data, offsets, _BREAK)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc = np.searchsorted(offsets, starts, "right") - 1
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=total[1:])
    docs, places = [], []
    for k, n in enumerate((None, *PREFIXES)):
        if n is None:
            s, e, d = starts, ends, doc
        else:
            long = np.flatnonzero(ends - starts > n)
            s, d = starts[long], doc[long]
            e = s + n
        h = mix((total[e] - total[s]) * down[s] + (e - s).astype(U64) * U64(0xD6E8FEB86659FD93) + U64(k > 0))
        docs.append(d)
        places.append((h & U64(PLACES - 1)).astype(np.int64))
    return np.concatenate(docs), np.concatenate(places)


def distinct(doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique(doc * PLACES + place)
    return pairs // PLACES, pairs % PLACES


class Model:
    """Weights by place and a bias."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights, bias

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        doc, place = features(data, offsets)
        told = np.flatnonzero(self.weights[place])
        doc, place = distinct(doc[told], place[told])
        z = self.bias + np.bincount(doc, self.weights[place], len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], chosen: np.ndarray, prior: float, *, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> Model:
    """Adam over the non-negative risk with the logistic loss, all rows in each step, deterministic.

    chosen: the places that are features; the samples hold, for each text, the numbers of those that it has."""

    def rows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
        return np.repeat(np.arange(len(texts)), [len(c) for c in texts]), np.concatenate([np.zeros(0, np.int64), *texts]).astype(np.int64), len(texts)

    sets = rows(positive), rows(unlabelled)
    w = np.zeros(len(chosen) + 1)
    w[-1] = np.log(prior / (1 - prior)) if 0 < prior < 1 else 0.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        s = [1 / (1 + np.exp(-np.clip(np.bincount(r, w[c], n) + w[-1], -60, 60))) for r, c, n in sets]
        part = lambda k, g: np.append(np.bincount(sets[k][1], g[sets[k][0]], len(chosen)), g.sum()) / sets[k][2]
        plus, minus_p, minus_u = part(0, s[0] - 1), part(0, s[0]), part(1, s[1])
        negative = -np.log1p(-np.minimum(s[1], 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(s[0], 1 - 1e-12)).mean()
        gradient = prior * plus + (minus_u - prior * minus_p) if negative >= 0 else -(minus_u - prior * minus_p)
        gradient[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(PLACES)
    weights[chosen] = w[:-1]
    return Model(weights, float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, *, training: Column | None = None, text: str = "text", key: str = "doc_id", label: str = "toxic", positives: int = 4000, unlabelled: int = 8000, keep: int = 3000, least: int = 3) -> Model:
    """A model from the labels given, whose documents' texts are found by key, and from unlabelled text.

    training: the documents that unlabelled text may come from, by default all."""
    labels = labels.select(F.col(key).alias("key"), F.col(label).alias("label")).where("key is not null and label is not null")
    n, toxic = labels.agg(F.count("*"), F.count_if(F.col("label") == 1)).first()
    prior = toxic / n if n else 0.0
    nothing = Model(np.zeros(PLACES), -500.0)
    if not toxic:
        return nothing
    texts = docs.where(F.coalesce(training, F.lit(True)) if training is not None else F.lit(True)).select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where("key is not null")
    ranked = lambda table, k, most: table.distinct().orderBy(F.xxhash64(F.lit(k), "key"), "key").limit(most)
    p = ranked(labels.where("label = 1").select("key"), 1, positives).withColumn("p", F.lit(True))
    u = ranked(texts.select("key"), 2, unlabelled).withColumn("u", F.lit(True))
    wanted = p.join(u, "key", "full")  # at most positives + unlabelled rows: that is the bound of the broadcast
    kind = docs.schema[key].dataType

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches, "text"):
            doc, place = distinct(*features(data, offsets))
            bounds = np.searchsorted(doc, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("sort"), lists(pa.array(place.astype(np.int32)), bounds)], ["key", "sort", "places"])

    sort = F.when(F.col("p"), 1).otherwise(0) + F.when(F.col("u"), 2).otherwise(0)
    schema = StructType([StructField("key", kind), StructField("sort", LongType()), StructField("places", ArrayType(IntegerType()))])
    found = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).join(F.broadcast(wanted), "key").select("key", sort.cast("long").alias("sort"), "text").mapInArrow(read, schema)
    samples = scratch(found.groupBy("key", "sort").agg(F.min("places").alias("places")), "samples")
    has = lambda bit: (F.col("sort").bitwiseAND(F.lit(bit)) > 0).cast("int")
    np_, nu = samples.agg(F.coalesce(F.sum(has(1)), F.lit(0)), F.coalesce(F.sum(has(2)), F.lit(0))).first()
    if not np_ or not nu:
        return nothing
    # places more frequent among positives than in unlabelled text, by how many deviations
    counts = samples.select(has(1).alias("p"), has(2).alias("u"), F.explode("places").alias("place")).groupBy("place").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    rate_u = (F.col("u") + 0.5) / (nu + 1)
    told = counts.where(F.col("p") >= least).withColumn("z", (F.col("p") / np_ - rate_u) / F.sqrt(rate_u / np_)).where("z > 3")
    best = sorted(r["place"] for r in told.orderBy(F.desc("z"), "place").limit(keep).collect())
    chosen = np.array(best, dtype=np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(chosen)  # at most ``keep`` places

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = []
            for places in batch.column("places"):
                x = np.array(places.values, dtype=np.int64)
                at = np.minimum(np.searchsorted(shared.value, x), max(0, len(shared.value) - 1))
                own.append(at[shared.value[at] == x].astype(np.uint16).tobytes() if len(shared.value) and len(x) else b"")
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("sort"), pa.array(own, pa.binary())], ["key", "sort", "own"])

    schema = StructType([StructField("key", kind), StructField("sort", LongType()), StructField("own", BinaryType())])
    rows = samples.mapInArrow(narrow, schema).orderBy("key").select("sort", "own").collect()
    sets = [[np.frombuffer(r["own"], np.uint16) for r in rows if r["sort"] & bit] for bit in (1, 2)]
    return fit(*sets, chosen, prior)


def scored(docs: DataFrame, model: Model, *, text: str = "text", out: str = "score") -> DataFrame:
    """docs with one more column, the score."""
    kept = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))  # PLACES numbers, whatever the input
    names = [f"c{i}" for i in range(len(docs.columns))]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Model(*kept.value)
        for part, data, offsets in chunks(batches, "__text"):
            columns = [part.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(mine.scores(data, offsets))], [*names, "__score"])

    plain = docs.toDF(*names)
    at = docs.columns.index(text)
    schema = StructType([StructField(n, f.dataType) for n, f in zip(names, docs.schema.fields, strict=True)] + [StructField("__score", DoubleType())])
    done = plain.select("*", F.col(names[at]).cast("string").alias("__text")).mapInArrow(task, schema)
    return done.toDF(*docs.columns, out)


def held_out(doc_id: Column) -> Column:
    return crc32_of_id(doc_id) % 4 == 2


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    learnt = ~F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    model = train(docs, labels.where(learnt), training=learnt)
    done = scored(docs.select("doc_id", "text"), model)
    return done.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
