"""Packing token sequences: first-fit decreasing with a tournament tree, in randomised groups of documents.

Documents are dealt by a keyed hash of id and text to numbered groups of about ``group_bytes`` of text; a task sorts
its groups by that hash and works through them one by one, so what is in memory is one group however large the input
is.  A group that comes out larger (rows that repeat id and text share one) is packed in parts of ``part_tokens``.
Groups, their order and their sequence ids follow from the rows alone, so a rerun, and a task that runs again for a
lost executor, give the same sequences.  Within a group a document gives whole sequences of ``length`` and a tail; tails are placed by first-fit decreasing, the leftmost bin with
room found by descending a tournament tree of bin capacities.  Gaps over ``gap`` tokens are then closed by
cutting up the emptiest bins, so a group pads at most its last sequence, and that one is divided into
powers of two, which need no padding.

A null text is an empty one; it has its end id alone.  Repeated rows are packed each on their own.  An
empty table gives no pieces.  Other columns are not carried.  A long document is a run of whole sequences.
Documents that tie in hash and id are equal, and interchangeable.  Sequence ids are unique across the result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from curatio.llm.bpe import loaded
from curatio.llm.shared import chunks, lists, partitions

COLUMNS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


class CapacityTree:
    """A tournament tree over bins: each inner node holds the larger room of its two children."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.size = 1 << max(0, (bins - 1).bit_length())
        self.room = [capacity] * (2 * self.size)

    def place(self, need: int) -> int:
        """Takes ``need`` from the leftmost bin that has room for it and returns that bin."""
        room, node = self.room, 1
        while node < self.size:
            node *= 2
            if room[node] < need:
                node += 1
        at, room[node] = node, room[node] - need
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return at - self.size


def pack(sizes: list[int], length: int = 1024, gap: int = 16) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents with these sizes."""
    full, tails = [], []
    for d, n in enumerate(sizes):
        full += [(d, s, length) for s in range(0, n - n % length, length)]
        if n % length:
            tails.append((d, n - n % length, n % length))
    tails.sort(key=lambda t: (-t[2], t[0]))
    tree = CapacityTree(max(1, len(tails)), length)
    bins: dict[int, list[tuple[int, int, int]]] = {}
    for t in tails:
        bins.setdefault(tree.place(t[2]), []).append(t)
    closed = [b for b in bins.values() if sum(t[2] for t in b) >= length - gap]
    loose = sorted(((sum(t[2] for t in b), b) for b in bins.values() if sum(t[2] for t in b) < length - gap), key=lambda x: -x[0])
    last = []
    hi = len(loose)
    for k in range(len(loose)):  # the fullest is filled up from the emptiest
        if k >= hi:
            break
        fill, own = loose[k][0], list(loose[k][1])
        while fill < length and hi - 1 > k:
            left, pieces = loose[hi - 1]
            d, s, n = pieces.pop()
            cut = min(n, length - fill)
            own.append((d, s, cut))
            if cut < n:
                pieces.append((d, s + cut, n - cut))
            fill, loose[hi - 1] = fill + cut, (left - cut, pieces)
            if not pieces:
                hi -= 1
        if fill >= length - gap:
            closed.append(own)
        else:
            last = own
    out = []
    for b in [*([p] for p in full), *closed, *powers_of_two(last, length)]:
        at, seq = 0, out[-1][3] + 1 if out else 0
        for d, s, n in b:
            out.append((d, s, n, seq, at))
            at += n
    return out


def powers_of_two(pieces: list[tuple[int, int, int]], length: int) -> list[list[tuple[int, int, int]]]:
    """The pieces cut into sequences that are each full or a power of two long."""
    todo, out = list(pieces), []
    while todo:
        left = sum(t[2] for t in todo)
        room = min(length, 1 << (left.bit_length() - 1))
        own = []
        while room:
            d, s, n = todo.pop(0)
            cut = min(n, room)
            own.append((d, s, cut))
            room -= cut
            if cut < n:
                todo.insert(0, (d, s + cut, n - cut))
        out.append(own)
    return out


def packed(docs: DataFrame, tokenizer: str, *, text: str = "text", key: str = "doc_id", end_id: int = 0, length: int = 1024, gap: int = 16, group_bytes: int = 1 << 20, part_tokens: int = 1 << 20, seed: int = 20260, with_ids: bool = False) -> DataFrame:
    """One row per piece; with_ids adds the piece's ids themselves."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:  # the driver's own file; its text goes along as a broadcast
        definition = spark.sparkContext.broadcast(f.read())
    names = ["key", *COLUMNS, *["ids"] * with_ids]

    def rows(keys: list[pa.Array], ids: list[np.ndarray], first: int) -> tuple[pa.RecordBatch, int]:
        cut = pack([len(x) for x in ids], length, gap)
        d, s, n, seq, at = (np.array(x, dtype=np.int64) for x in zip(*cut, strict=True))
        crc = np.array([zlib.crc32(ids[i][a : a + m].astype("<u4").tobytes()) for i, a, m in zip(d.tolist(), s.tolist(), n.tolist(), strict=True)], dtype=np.int64)
        columns = [pa.concat_arrays(keys).take(pa.array(d)), *map(pa.array, (s, n, crc, np.array([len(x) for x in ids], dtype=np.int64)[d], seq + first, at))]
        if with_ids:
            flat = np.concatenate([ids[i][a : a + m] for i, a, m in zip(d.tolist(), s.tolist(), n.tolist(), strict=True)])
            columns.append(lists(pa.array(flat.view(np.int32)), np.append(0, np.cumsum(n))))
        return pa.RecordBatch.from_arrays(columns, names), int(seq[-1]) + 1

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(definition.value)
        now, keys, ids, total, made = None, [], [], 0, 0
        for part, data, offsets in chunks(batches, "text"):
            raw, groups = memoryview(data.tobytes()), np.array(part.column("group"))
            for i in range(part.num_rows):
                if ids and (groups[i] != now or total >= part_tokens):
                    out, n = rows(keys, ids, (int(now) << 32) + made)
                    yield out
                    keys, ids, total, made = [], [], 0, made + n
                if groups[i] != now:
                    now, made = groups[i], 0
                keys.append(part.column("key").slice(i, 1))
                ids.append(np.append(bpe.ids(str(raw[offsets[i] : offsets[i + 1]], "utf-8")), np.uint32(end_id)))
                total += len(ids[-1])
        if ids:
            yield rows(keys, ids, (int(now) << 32) + made)[0]

    schema = StructType([StructField("key", docs.schema[key].dataType), *(StructField(c, LongType()) for c in COLUMNS), *[StructField("ids", ArrayType(IntegerType()))] * with_ids])
    read = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    size = read.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    order = F.xxhash64(F.lit(seed), "key", "text")
    dealt = read.withColumn("order", order).withColumn("group", F.pmod("order", F.lit(max(1, size // group_bytes))))
    dealt = dealt.repartition(partitions(spark), "group").sortWithinPartitions("group", "order", "key").drop("order")
    return dealt.mapInArrow(task, schema).withColumnRenamed("key", key)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
