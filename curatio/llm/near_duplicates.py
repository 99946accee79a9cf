"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles, banded, verified exactly.

A text is the multiset of its runs of five words (all its words, if fewer); a shingle weighs its count times
log(1 + N / df), where df counts the documents that have it, for every shingle.  Distinct texts are put in blocks of
about 1 MB; a block sends its distinct shingles, with how many rows have each, to buckets by their leading bits, a
bucket adds up what all blocks sent, and sends every block the totals in the order in which it asked.  So no
shingle meets more rows than there are blocks, nothing is broadcast, and each text goes on with its own totals.

Every text gets ``bands * rows`` samples; two texts agree in a sample with the probability of their weighted
Jaccard similarity.  Texts that share a band are candidates: each with the least of its bucket, then, where a
bucket still holds several classes, the members of different classes with each other, so no link is lost to
the first comparison and none is sought within a class.  The second comparison deals a bucket into blocks; a
task has two of them with their texts, compares what shares no earlier bucket and is in no common class yet,
and returns only the links that join classes, so neither candidates nor links of a large bucket are listed.
A candidate pair whose samples agree too seldom to be similar (``sieve``; at 0.8 one in 10**5) is left out,
and the others' similarity is computed from both texts in double precision.  Links at or above ``similarity``
are joined by ``components``.

Equal texts are one class from the start and counted once, whatever their number; a null text is an empty
one, and texts without words are alike only if equal.  Rows that repeat a key are judged by their text; a key
with two texts takes part in both classes.  Null keys are judged too, ordered last.  An empty table gives an
empty result.  Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, LongType, StructField, StructType

from curatio.llm.shared import ASK, U64, answered, answers, asks, bytes_hash, chunks, clear, coded, components, decoded, grams, lists, mix, salted_join, scratch, signed, spans_hash, text_key, words, written

WIDTH = 5
_LOG = (-np.log((np.arange(1 << 16) + 0.5) / (1 << 16))).astype(np.float32)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count), each once, ordered by text and shingle."""
    begin, end, bounds = words(data, offsets)
    hashes = bytes_hash(data, begin, end)
    at, found = grams(hashes, bounds, WIDTH)
    few = np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < WIDTH))
    doc = np.concatenate([np.searchsorted(bounds, at, "right") - 1, few])
    found = np.concatenate([found, spans_hash(hashes, bounds[few], bounds[few + 1])])
    order = np.lexsort((found, doc))
    doc, found = doc[order], found[order]
    new = np.flatnonzero(np.concatenate([[True], (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])])) if len(doc) else np.zeros(0, np.int64)
    return doc[new], found[new], np.diff(np.append(new, len(doc)))


class Weights:
    """Shingles' inverse document frequencies: those known (in order), and one value for all others."""

    def __init__(self, common: np.ndarray, idf: np.ndarray, rare: float) -> None:
        self.common, self.idf, self.rare = common, idf, rare

    def __call__(self, found: np.ndarray, times: np.ndarray) -> np.ndarray:
        out = np.full(len(found), self.rare)
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, found), len(self.common) - 1)
            hit = self.common[at] == found
            out[hit] = self.idf[at[hit]]
        return out * times


def samples(doc: np.ndarray, found: np.ndarray, weight: np.ndarray, n: int, number: int) -> np.ndarray:
    """Improved consistent weighted sampling: ``number`` samples of each of n texts, 0 for a text without shingles.

    For each shingle and sample, r and c are Gamma(2, 1) and b uniform, all by hash; with t = floor(ln w / r + b)
    and ln a = ln c - r (t - b) - r, the sample is the (shingle, t) of the least a."""
    out = np.zeros((n, number), np.uint32)
    if not len(doc):
        return out
    cut = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    log_w = np.log(weight).astype(np.float32)
    for k in range(number):
        z = mix(np.array([k + 1], U64))[0] ^ found
        z = z * U64(0x9FB21C651E98DF25)
        z = (z ^ (z >> U64(32))) * U64(0xD6E8FEB86659FD93)
        z ^= z >> U64(29)
        part = z.view(np.uint16).reshape(-1, 4)
        r = _LOG[part[:, 0]] + _LOG[part[:, 1]]
        log_c = np.log(_LOG[part[:, 2]] + _LOG[part[:, 3]])
        b = ((z * U64(0xA24BAED4963EE407)) >> U64(48)).astype(np.float32) * np.float32(1 / 65536)
        t = np.floor(log_w / r + b)
        a = (log_c - r * (t - b) - r).view(np.int32)
        a ^= (a >> 31) & np.int32(0x7FFFFFFF)  # integers in the order of the floats
        name = (found + t.astype(np.int64).view(U64) * U64(0xC2B2AE3D27D4EB4F)) * U64(0x9E3779B97F4A7C15)
        key = ((a.astype(np.int64) + (1 << 31)).view(U64) << U64(32)) | (name >> U64(32))
        out[doc[cut], k] = (np.minimum.reduceat(key, cut) & U64(0xFFFFFFFF)).astype(np.uint32)
    return out


def similarities(texts: list[bytes], weights: Weights) -> np.ndarray:
    """The weighted Jaccard similarity of texts 0 and 1, 2 and 3, and so on."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    doc, found, times = shingles(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))
    w = weights(found, times)
    pair = doc // 2
    order = np.lexsort((found, pair))
    pair, found, w = pair[order], found[order], w[order]
    both = np.flatnonzero((pair[1:] == pair[:-1]) & (found[1:] == found[:-1]))
    common = np.bincount(pair[both], np.minimum(w[both], w[both + 1]), len(texts) // 2)
    whole = np.bincount(pair, w, len(texts) // 2)
    return common / np.maximum(whole - common, 1e-300)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]).astype(np.int64)


def blocks_of(read: DataFrame, key_type: DataType) -> DataFrame:
    """One row for about 1 MB of distinct texts: their ids (the least names the block), keys, numbers of rows and compressed bytes."""
    once = read.groupBy("k1", "k2").agg(F.min("key").alias("rep"), F.count("*").alias("m"), F.first(F.coalesce("text", F.lit(""))).alias("text"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, uid = zstandard.ZstdCompressor(level=3), TaskContext.get().partitionId() << 40
        for part, _, offsets in chunks(batches, "text"):
            texts = pa.array([c.compress(t.encode()) for t in part.column("text").to_pylist()], pa.binary())
            whole = np.array([0, part.num_rows])
            columns = [pa.array(np.arange(part.num_rows) + uid), *(part.column(c) for c in ("k1", "k2", "rep", "m")), texts]
            yield pa.RecordBatch.from_arrays([pa.array([uid]), pa.array([int(offsets[-1])]), *(lists(x, whole) for x in columns)], schema.names)
            uid += part.num_rows

    kinds = {"cid": LongType(), "k1": LongType(), "k2": LongType(), "rep": key_type, "m": LongType(), "text": BinaryType()}
    schema = StructType([StructField("block", LongType()), StructField("size", LongType()), *(StructField(c, ArrayType(t)) for c, t in kinds.items())])
    return scratch(once.mapInArrow(pack, schema), "blocks")


def frequencies(blocks: DataFrame, bucket: int = 8 << 20) -> DataFrame:
    """(block, told): the number of rows that have each of a block's distinct shingles, in their order; bucket: bytes of text."""
    size = blocks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    bits = max(1, (size // bucket).bit_length())

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                doc, found, _ = shingles(*joined([u.decompress(t) for t in batch.column("text")[i].as_py()]))
                own, at = np.unique(found, return_inverse=True)
                if len(own):
                    times = np.bincount(at, np.array(batch.column("m")[i].values)[doc], len(own)).astype(U64)
                    yield asks(batch.column("block")[i].as_py(), own, [times], bits)

    def count(at: np.ndarray, first: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.bincount(at, times.view(np.int64)).astype(U64)[at], first

    return answered(blocks.select("block", "m", "text").mapInArrow(ask, ASK), count, "frequencies")


def near_duplicates(docs: DataFrame, *, text: str = "text", key: str = "doc_id", similarity: float = 0.8, bands: int = 12, rows: int = 4, sieve: float = 0.55, block: int = 256) -> DataFrame:
    """(key, class_id, kept) for every row; class_id: the least key of the class, which alone is kept."""
    before = written()
    k1, k2 = text_key(F.col(text).cast("string"))
    read = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), k1.alias("k1"), k2.alias("k2"))
    blocks = blocks_of(read, docs.schema[key].dataType)
    n = blocks.agg(F.coalesce(F.sum(F.aggregate("m", F.lit(0).cast("long"), lambda s, x: s + x)), F.lit(0))).first()[0]
    number = bands * rows

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                cid, c1, c2, rep, texts = (batch.column(c)[i].values for c in ("cid", "k1", "k2", "rep", "text"))
                size = len(cid)
                doc, found, times = shingles(*joined([u.decompress(t) for t in texts.to_pylist()]))
                own, at = np.unique(found, return_inverse=True)
                df = answers(batch.column("told")[i].as_py())
                drawn = samples(doc, found, Weights(own, np.log1p(n / np.maximum(df, U64(1))), 0.0)(found, times), size, number)
                flat = drawn.reshape(-1).astype(U64) + U64(1)
                begin = np.arange(size * bands) * rows
                keys = mix(spans_hash(flat, begin, begin + rows) + np.tile(np.arange(bands), size).astype(U64))
                some = np.zeros(size, bool)
                some[doc] = True
                keys = keys[np.repeat(some, bands)]
                cuts = np.append(0, np.cumsum(some * bands))
                ends = np.searchsorted(doc, np.arange(size + 1))
                dfs = pa.array([coded(df[at[x:y]]) for x, y in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([cid, c1, c2, rep, lists(signed(keys), cuts), lists(pa.array(drawn.reshape(-1).view(np.int32)), np.arange(size + 1) * number), texts, dfs], signed_schema.names)

    kinds = {"cid": LongType(), "k1": LongType(), "k2": LongType(), "rep": docs.schema[key].dataType, "bands": ArrayType(LongType()), "drawn": ArrayType(IntegerType()), "text": BinaryType(), "df": BinaryType()}
    signed_schema = StructType([StructField(c, t) for c, t in kinds.items()])
    classes = scratch(blocks.drop("size", "m").join(frequencies(blocks).drop("news").hint("merge"), "block", "left").mapInArrow(sign, signed_schema), "classes")
    members = read.select("key", "k1", "k2")

    def similar(texts: list[bytes], dfs: list[bytes]) -> np.ndarray:
        """Of texts 0 and 1, 2 and 3, and so on: whether they are similar; dfs: of each text's shingles, in their order."""
        idf = np.concatenate([np.zeros(0), *(np.log1p(n / decoded(x)) for x in dfs)])
        return similarities(texts, lambda found, times: idf * times) >= similarity

    held = scratch(classes.select("cid", F.posexplode("bands").alias("band", "bucket")), "buckets")
    drawn = classes.select("cid", "drawn")

    def agree(a: str, b: str) -> F.Column:
        same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
        return same >= F.lit(int(np.ceil(sieve * number)))

    least = scratch(held.groupBy("bucket").agg(F.min("cid").alias("lead"), F.count("*").alias("n")).where("n > 1").select("bucket", "lead"), "leads", small=True)
    stars = held.select("bucket", "cid").join(least.hint("merge"), "bucket").where("cid != lead").select("lead", "cid").distinct()
    stars = stars.join(drawn.hint("merge"), "cid").join(drawn.select(F.col("cid").alias("lead"), F.col("drawn").alias("lead_drawn")).hint("merge"), "lead")
    stars = scratch(stars.where(agree("drawn", "lead_drawn")).select(F.col("lead").alias("a"), F.col("cid").alias("b")), "stars", small=True)

    def texts_of(cids: DataFrame) -> DataFrame:
        """The texts of candidates, compressed, and their shingles' document frequencies."""
        return scratch(classes.select("cid", "text", "df").join(cids.hint("merge"), "cid"), "texts")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = zstandard.ZstdDecompressor()
        for batch in batches:
            at, hits = 0, []
            while at < batch.num_rows:
                own, dfs, size, begin = [], [], 0, at
                while at < batch.num_rows and size < 1 << 20:
                    own += [u.decompress(batch.column(c)[at].as_py()) for c in ("ta", "tb")]
                    dfs += [batch.column(c)[at].as_py() for c in ("da", "db")]
                    size += len(own[-1]) + len(own[-2])
                    at += 1
                hits.append(np.flatnonzero(similar(own, dfs)) + begin)
            told = pa.array(np.concatenate(hits) if hits else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(told), batch.column("b").take(told)], ["a", "b"])

    texts = texts_of(stars.select(F.col("a").alias("cid")).union(stars.select("b")).distinct())
    ta, tb = (texts.select(F.col("cid").alias(c), F.col("text").alias(f"t{c}"), F.col("df").alias(f"d{c}")).hint("merge") for c in ("a", "b"))
    links = scratch(stars.join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb", "da", "db").mapInArrow(compare, "a bigint, b bigint"), "links")
    tied = components(links)
    # buckets that still hold several classes
    now = held.join(tied.withColumnRenamed("node", "cid").hint("merge"), "cid", "left").withColumn("c", F.coalesce("component", "cid")).drop("component")
    now = scratch(now, "classed", small=True)
    open_ = now.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n")).where("lo != hi")
    open_ = scratch(open_.select("bucket", F.expr(f"cast((n + {block - 1}) div {block} as int)").alias("blocks")), "open", small=True)
    left = scratch(now.join(open_.hint("merge"), "bucket"), "left", small=True)
    cids = left.select("cid").distinct()
    more_texts = texts_of(cids.join(texts.select("cid").hint("merge"), "cid", "left_anti"))
    there = left.join(texts.unionByName(more_texts).hint("merge"), "cid").join(drawn.hint("merge"), "cid").withColumn("block", F.pmod(F.xxhash64("cid"), "blocks").cast("int"))
    there = there.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    there = there.select("bucket", "band", "cid", "drawn", "c", "text", "df", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))

    def meet(group: pa.Table) -> pa.Table:
        """Links between the classes of a block, or of two."""
        u = zstandard.ZstdDecompressor()
        cid, block_ = np.array(group.column("cid")), np.array(group.column("block"))
        drawn_ = np.array(group.column("drawn").combine_chunks().flatten()).reshape(len(cid), number)
        _, parent = np.unique(np.array(group.column("c")), return_inverse=True)
        band, low, high = (group.column(c)[0].as_py() for c in ("band", "lo", "hi"))
        x, y = np.flatnonzero(block_ == low), np.flatnonzero(block_ == high)
        text, df = [u.decompress(t.as_py()) for t in group.column("text")], group.column("df").to_pylist()
        found: list[tuple[int, int]] = []
        pairs: list[tuple[np.ndarray, ...]] = []
        for i in x:
            mine = y[y > i] if low == high else y
            same = drawn_[mine] == drawn_[i]
            earlier = same[:, : band * rows].reshape(len(mine), band, rows).all(axis=2).any(axis=1)
            n = same.sum(axis=1)
            told = np.flatnonzero(~earlier & (n >= np.ceil(sieve * number)) & (parent[mine] != parent[i]))
            pairs.append((np.full(len(told), i), mine[told], n[told]))
        a, b, n = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 3
        order = np.argsort(-n, kind="stable")
        a, b = a[order], b[order]
        while len(a):
            p, q = a[:256], b[:256]
            a, b = a[256:], b[256:]
            both = np.stack([p, q], axis=1).ravel()
            for i in np.flatnonzero(similar([text[k] for k in both], [df[k] for k in both])):
                if parent[p[i]] != parent[q[i]]:
                    found.append((cid[p[i]], cid[q[i]]))
                    parent[parent == parent[q[i]]] = parent[p[i]]
            open__ = parent[a] != parent[b]
            a, b = a[open__], b[open__]
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    more = scratch(there.groupBy("bucket", "lo", "hi").applyInArrow(meet, "a bigint, b bigint"), "more")
    tied = components(links.unionByName(more)).select(F.col("node").alias("cid"), "component")
    named = classes.select("cid", "k1", "k2", "rep").join(tied.hint("merge"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    named = scratch(named, "named")
    first = scratch(named.groupBy("component").agg(F.min("rep").alias("class_id")), "first", small=True)
    named = scratch(salted_join(named, first, ["component"], by=["k1"]).select("k1", "k2", "class_id"), "told")
    clear(docs.sparkSession, before)
    out = salted_join(members, named, ["k1", "k2"])
    return out.select(F.col("key").alias(key), "class_id", F.col("key").eqNullSafe(F.col("class_id")).alias("kept"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Every pair of texts that share a shingle, without sampling.
ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [1] ELSE range(1, len(w) - 3) END) AS i FROM d)),
f AS (SELECT doc_id, s, count(*) AS n FROM x GROUP BY 1, 2),
i AS (SELECT s, ln(1 + (SELECT count(*) FROM d) / count(*)::DOUBLE) AS idf FROM f GROUP BY s),
v AS (SELECT doc_id, s, n * idf AS w FROM f JOIN i USING (s)),
z AS (SELECT doc_id, sum(w) AS total FROM v GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.w, b.w)) AS m FROM v a JOIN v b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN z za ON za.doc_id = p.a JOIN z zb ON zb.doc_id = p.b WHERE m / (za.total + zb.total - m) >= 0.8 UNION SELECT a.doc_id, b.doc_id FROM d a JOIN d b ON a.t = b.t AND a.doc_id < b.doc_id),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS class_id FROM r GROUP BY a)
SELECT a AS doc_id, class_id, a = class_id AS kept FROM c
"""
