"""Document fingerprints: a Merkle tree over sections, paragraphs and short runs of words.

Leaves are runs of bytes that end with a paragraph (a line) or after a word whose hash says so, about eight
words long, so an insertion moves no later boundary.  Every node is a BLAKE2b digest of 16 bytes: of a leaf's bytes, of
a paragraph's leaves' digests, of a section's paragraphs', of the root's sections', each kind with a mark of its own.
Sections end at an empty line or after a paragraph whose digest says so.  The fingerprint is the root's 32 hex digits,
a colon, and each leaf's first 8 hex digits with what closes after it: ``,`` a leaf, ``.`` a paragraph too, ``;`` a
section too.  Equal texts have equal roots, and equal roots mean equal texts as surely as BLAKE2b has no collisions;
``differing`` descends into the branches that differ and says where.

Null texts are empty texts; their fingerprint has a root and no leaf.  Rows that repeat a key are ordered by
their text's hash.  A null key comes after every other.  A table of one row is its own next document, and an
empty table gives an empty one.  Other columns are not carried.  Long texts are fingerprinted whole.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from curatio.llm.shared import bytes_hash, partitions, words

#: A word's hash ends a leaf in one of LEAF, a paragraph's a section in one of SECTION.
LEAF, SECTION = 8, 8


#: Bytes of a digest, hex digits of a root, and the marks of leaves, paragraphs, sections and roots.
DIGEST = 16
ROOT = 2 * DIGEST
MARKS = b"\0", b"\1", b"\2", b"\3"


def digest(mark: bytes, data: bytes) -> bytes:
    return hashlib.blake2b(mark + data, digest_size=DIGEST).digest()


def parents(mark: bytes, children: bytes, ends: np.ndarray) -> list[bytes]:
    """The digests of nodes; children: all their children's digests in a row, ends: the child after each node's last."""
    cuts = [0, *(ends * DIGEST).tolist()]
    return [digest(mark, children[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def chosen(digests: list[bytes]) -> np.ndarray:
    """Whether a digest says that its node ends a section."""
    return np.frombuffer(b"".join(digests), "<u8")[:: DIGEST // 8] % np.uint64(SECTION) == 0


class Tree:
    """The trees of many texts: leaf digests with, for each text, where its leaves begin, and the roots."""

    def __init__(self, texts: list[bytes]) -> None:
        raw = b"".join(texts)
        data = np.frombuffer(raw, dtype=np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        starts, ends, bounds = words(data, offsets)
        doc = np.searchsorted(offsets, starts, "right") - 1
        line = np.cumsum(data == 10) if len(data) else np.zeros(0, np.int64)
        own = line[starts] if len(starts) else np.zeros(0, np.int64)
        last = np.ones(len(starts), bool)
        last[:-1] = doc[1:] != doc[:-1]
        paragraph, blank = last.copy(), np.zeros(len(starts), bool)
        if len(starts):
            paragraph[:-1] |= own[1:] != own[:-1]
            blank[:-1] = own[1:] - own[:-1] > 1
        close = paragraph | (bytes_hash(data, starts, ends) % np.uint64(LEAF) == 0)
        at = np.flatnonzero(close)  # the words that end a leaf
        first = np.concatenate([[0], at[:-1] + 1]).astype(np.int64) if len(at) else at
        # a text's first leaf begins with the text, every other with its first word
        opens = np.concatenate([[True], doc[at][1:] != doc[at][:-1]]) if len(at) else np.zeros(0, bool)
        begin = np.where(opens, offsets[doc[at]], starts[first])
        leaf_doc, ends_paragraph, ends_blank, ends_doc = doc[at], paragraph[at], blank[at], last[at]
        bare = np.array([i for i in range(len(texts)) if bounds[i] == bounds[i + 1] and len(texts[i])], np.int64)  # blanks alone: one leaf
        order = np.argsort(np.concatenate([leaf_doc, bare]), kind="stable")
        join = lambda x, y: np.concatenate([x, np.full(len(bare), y) if np.isscalar(y) else y])[order]
        begin, leaf_doc = join(begin, offsets[bare]), join(leaf_doc, bare)
        ends_paragraph, ends_blank, ends_doc = join(ends_paragraph, True), join(ends_blank, False), join(ends_doc, True)
        cuts = [*begin.tolist(), len(raw)]
        leaves = b"".join([digest(MARKS[0], raw[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)])
        self.bounds = np.searchsorted(leaf_doc, np.arange(len(texts) + 1))
        p_end = np.flatnonzero(ends_paragraph) + 1
        paragraphs = parents(MARKS[1], leaves, p_end)
        ends_section = ends_blank[p_end - 1] | ends_doc[p_end - 1] | chosen(paragraphs)
        s_end = np.flatnonzero(ends_section) + 1
        sections = parents(MARKS[2], b"".join(paragraphs), s_end)
        s_bounds = np.searchsorted(leaf_doc[p_end[s_end - 1] - 1], np.arange(1, len(texts) + 1))
        self.roots = parents(MARKS[3], b"".join(sections), s_bounds)
        marks = np.full(len(begin), ord(","), np.uint8)
        marks[p_end - 1] = ord(".")
        marks[p_end[s_end - 1] - 1] = ord(";")
        short = np.ascontiguousarray(np.frombuffer(leaves, np.uint8).reshape(-1, DIGEST)[:, :4])
        digits = np.frombuffer(short.tobytes().hex().encode(), np.uint8).reshape(-1, 8)
        self.body = np.concatenate([digits, marks[:, None]], axis=1).tobytes().decode()
        short = short.view(">u4").ravel()
        self.sets = [set(short[a:b].tolist()) for a, b in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True)]

    def fingerprint(self, i: int) -> str:
        return f"{self.roots[i].hex()}:{self.body[9 * self.bounds[i] : 9 * self.bounds[i + 1]]}"


def fingerprint(text: str | None) -> str:
    return Tree([(text or "").encode()]).fingerprint(0)


def likeness_of(a: set[int], b: set[int]) -> float:
    """Twice the common leaves over all leaves; two trees without a leaf are alike."""
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0


def likeness(one: str, other: str) -> float:
    """Of two fingerprints, 0 to 1: 1 for equal roots, else by their distinct leaves."""
    if one[:ROOT] == other[:ROOT]:
        return 1.0
    cut = lambda x: {int(x[i : i + 8], 16) for i in range(ROOT + 1, len(x), 9)}
    return likeness_of(cut(one), cut(other))


def differing(one: str, other: str) -> list[tuple[int, int]]:
    """(section, paragraph) of the first tree whose branch the second does not have, in order; equal roots: none.

    Sections that the other tree also holds are skipped whole, then paragraphs, as their hashes stand for all below.
    """
    if one[:ROOT] == other[:ROOT]:
        return []
    cut = lambda x: [[p for p in s.split(".") if p] for s in x[ROOT + 1 :].split(";") if s]
    mine, theirs = cut(one), cut(other)
    sections, paragraphs = {tuple(s) for s in theirs}, {p for s in theirs for p in s}
    return [(i, k) for i, s in enumerate(mine) if tuple(s) not in sections for k, p in enumerate(s) if p not in paragraphs]


def with_next(docs: DataFrame, text: str, key: str, ranges: int) -> DataFrame:
    """(pid, borrowed, key, text), dealt and sorted so that every document is followed by the next in descending key order.

    Keys, of any type that has an order, are cut into ranges by a sample of about 20 keys for each, chosen by a hash,
    which goes to the driver; the greatest document of a range is lent to the range above it, whose last document it follows, and the
    greatest of all to the lowest range.  Bounds and loans, an entry for each range, are broadcast.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    step = max(1, rows.count() // (20 * ranges))
    some = rows.where("key is not null").select("key").where(F.pmod(F.xxhash64("key"), F.lit(step)) == 0).distinct()
    sample = sorted(r["key"] for r in some.collect())
    bounds = sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []
    held = docs.sparkSession.sparkContext.broadcast(bounds)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: bisect_right(held.value, k)).astype("int32")

    pid = F.when(F.col("key").isNull(), F.lit(-1)).otherwise(range_of(F.coalesce("key", F.lit(sample[0] if sample else None).cast(docs.schema[key].dataType))))  # no key: below all
    placed = rows.withColumn("own", pid)
    tops = placed.groupBy("own").agg(F.max("key").alias("top")).orderBy("own").collect()  # a row per range
    to = {x["own"]: (x["top"], tops[(i + 1) % len(tops)]["own"]) for i, x in enumerate(tops)}
    if not to:
        return placed.select(F.lit(0).alias("pid"), F.lit(False).alias("borrowed"), "key", "text")
    loans = docs.sparkSession.createDataFrame([(own, top, other) for own, (top, other) in to.items()], StructType([StructField("at", IntegerType()), StructField("top", docs.schema[key].dataType), StructField("other", IntegerType())]))
    placed = placed.join(F.broadcast(loans), F.col("own") == F.col("at"))
    also = F.when(F.col("key").eqNullSafe(F.col("top")), F.col("other"))
    place = F.array_compact(F.array(F.struct(F.col("own").alias("pid"), F.lit(False).alias("borrowed")), F.when(also.isNotNull(), F.struct(also.alias("pid"), F.lit(True).alias("borrowed")))))
    placed = placed.withColumn("place", F.explode(place)).select("place.*", "key", "text")
    dealt = placed.repartition(partitions(docs.sparkSession), "pid")
    return dealt.sortWithinPartitions("pid", "borrowed", F.col("key").desc_nulls_last(), F.xxhash64("text"))


def fingerprints(docs: DataFrame, *, text: str = "text", key: str = "doc_id", ranges: int | None = None) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and how like they are to each other and to the next document's."""
    ordered = with_next(docs, text, key, ranges or 4 * partitions(docs.sparkSession))

    def work(rows: list[tuple], after: tuple | None) -> pa.RecordBatch | None:
        """rows in order; after: the row that follows the last, if it has the same range."""
        line = [*rows, *[after] * (after is not None)]
        own = [i for i in range(len(line) - 1) if not line[i][1] and line[i][0] == line[i + 1][0]]
        if not own:
            return None
        edited = []
        for i in own:
            t, n = line[i][3], len(line[i][3])
            edited.append((t[: n - n // 3] + line[i + 1][3][: n // 3]).encode())
        trees, made = Tree([r[3].encode() for r in line]), Tree(edited)
        near_edited = [1.0 if trees.roots[i] == made.roots[j] else likeness_of(trees.sets[i], made.sets[j]) for j, i in enumerate(own)]
        near_next = [1.0 if trees.roots[i] == trees.roots[i + 1] else likeness_of(trees.sets[i], trees.sets[i + 1]) for i in own]
        return pa.RecordBatch.from_pydict(
            {
                "key": pa.array([line[i][2] for i in own], kind),
                "n_chars": pa.array([len(line[i][3]) for i in own], pa.int64()),
                "edited_sha256": [hashlib.sha256(e).hexdigest() for e in edited],
                "fingerprint": [trees.fingerprint(i) for i in own],
                "edited_fingerprint": [made.fingerprint(j) for j in range(len(own))],
                "near_edited": pa.array(near_edited, pa.float64()),
                "near_next": pa.array(near_next, pa.float64()),
            }
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("pid", "borrowed", "key", "text")), strict=True):
                if size > 1 << 20:
                    if (out := work(held, row)) is not None:
                        yield out
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held and (out := work(held, None)) is not None:
            yield out

    kind = to_arrow_type(docs.schema[key].dataType)
    types = (("n_chars", LongType()), ("edited_sha256", StringType()), ("fingerprint", StringType()), ("edited_fingerprint", StringType()), ("near_edited", DoubleType()), ("near_next", DoubleType()))
    schema = StructType([StructField("key", docs.schema[key].dataType), *(StructField(*t) for t in types)])
    return ordered.mapInArrow(task, schema).withColumnRenamed("key", key)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
