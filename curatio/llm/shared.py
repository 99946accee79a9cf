"""What the operators of this subpackage share: scratch tables, byte-level words, hashes and components."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.sources.scratch import clear, dealt, partitions, scratch, written  # noqa: F401  the operators take them from here

#: A word: what lies between blanks, as a Java and RE2 pattern.
WORD = r"[^\x20\x09-\x0D]+"
U64 = np.uint64
_MULT, _INV = 0x9E3779B97F4A7C15 | 1, pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of text that are handled at once, beside a single longer text.
CHUNK = 1 << 20


def text_key(text: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a text: equal texts, and in practice only those, share both."""
    text = F.coalesce(text, F.lit(""))
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def crc32_of_id(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary"))


# ---------------------------------------------------------------------------------------------- bytes


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each value begins (one entry more than values); null: empty."""
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_binary()).fill_null(b"")
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw[2], dtype=np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str, size: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``size`` bytes of text each, with that text's bytes and offsets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = buffers(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
            yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            at = to


def words(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each word's first byte and the byte after its last, and where each text's words begin."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~blank[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    before[offsets[offsets < n]] = False
    after[offsets[offsets > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)


def bytes_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int = 256) -> np.ndarray:
    """A 64-bit hash of each span of bytes: eight at a time, each eight mixed into what came before, so that no
    arithmetic of positions can cancel out; spans over ``most`` bytes are hashed by BLAKE2b."""
    size = ends - starts
    out = mix(size.astype(U64) * U64(0x9E3779B97F4A7C15) + U64(1))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    todo = np.flatnonzero((size > 0) & (size <= most))
    at, left, h = starts[todo], size[todo], out[todo]
    while len(todo):
        h = mix(h ^ (eight[at] & _MASKS[np.minimum(left, 8)]))
        over = left <= 8
        out[todo[over]] = h[over]
        more = ~over
        todo, at, left, h = todo[more], at[more] + 8, left[more] - 8, h[more]
    for i in np.flatnonzero(size > most):
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


_powers = np.ones(1, U64), np.ones(1, U64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_MULT and its inverse to the powers 0 to n, modulo 2**64."""
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, CHUNK // 4)
        made = []
        for base in (_MULT, _INV):
            x = np.full(size, base, U64)
            x[0] = 1
            made.append(np.cumprod(x, dtype=U64))
        if size > 4 * CHUNK:
            return made[0], made[1]
        _powers = made[0], made[1]
    return _powers


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each span: the same wherever the same values stand.

    A polynomial, so windows slide at no cost; made for runs of hashes (see ``bytes_hash`` for bytes)."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, U64)
    np.cumsum((values.astype(U64) + U64(1)) * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def inside(bounds: np.ndarray, length: int) -> np.ndarray:
    """The positions at which ``length`` values of one text begin; bounds: where each text's values begin."""
    n = int(bounds[-1])
    last = np.repeat(bounds[1:], np.diff(bounds))
    return np.flatnonzero(np.arange(n) + length <= last)


def grams(values: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of ``length`` values begin within a text, and their hashes."""
    at = inside(bounds, length)
    return at, spans_hash(values, at, at + length)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == U64 else x.astype(np.int64))


def lists(values: pa.Array, bounds: np.ndarray) -> pa.Array:
    """bounds: where each list begins, and the end."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values)


# ---------------------------------------------------------------------------------------------- joins


def salted_join(left: DataFrame, right: DataFrame, on: list[str], by: list[str] | None = None, how: str = "inner", salt: int = 32) -> DataFrame:
    """left joined with right, which has each key about once: right stands ``salt`` times, and left's rows are dealt over
    these by the columns ``by`` (or one by one), so a key with a third of all rows is spread over as many tasks."""
    number = F.xxhash64(*by) if by else F.monotonically_increasing_id()
    dealt_ = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return left.withColumn("__salt", F.pmod(number, F.lit(salt)).cast("int")).join(dealt_.hint("merge"), [*on, "__salt"], how).drop("__salt")


# ------------------------------------------------------------------------------------------ exchanges


def coded(x: np.ndarray) -> bytes:
    """64-bit numbers by planes of bytes, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), 8).T).tobytes())


def decoded(x: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, len(raw) // 8).T).view(U64).ravel()


#: What a block of the input asks a bucket of keys: its keys in order, and what it says of each.
ASK = "bucket bigint, block bigint, keys binary, said array<binary>"


def asks(block: int, keys: np.ndarray, said: list[np.ndarray], bits: int) -> pa.RecordBatch:
    """A block's questions; keys in order, buckets by their leading bits; said: numbers for each key."""
    to, cuts = np.unique(keys >> U64(64 - bits), return_index=True)
    spans = list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)], strict=False))
    told = pa.array([coded(np.ascontiguousarray(x[a:b])) for a, b in spans for x in said], pa.binary())
    own = pa.array([coded(np.diff(keys[a:b], prepend=U64(0))) for a, b in spans], pa.binary())
    columns = [pa.array(to.astype(np.int64)), pa.array(np.full(len(spans), block)), own, lists(told, np.arange(len(spans) + 1) * len(said))]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "block", "keys", "said"])


def answered(asked: DataFrame, answer: Callable[..., tuple[np.ndarray, np.ndarray]], name: str) -> DataFrame:
    """(block, told, news): for each block the answers to its keys, in the order of its keys, and a sum; bucketed by block.

    A bucket has one question of each block, so a key that all the input has is as cheap as any other.
    answer(at, first, *said) gets, for all blocks' keys in the order of blocks, which distinct key each is and
    whether it is the first of that key; it gives an answer for each, and a number that is summed up by block."""

    def bucket(group: pa.Table) -> pa.Table:
        group = group.sort_by("block")
        keys = [np.cumsum(decoded(k), dtype=U64) for k in group.column("keys").to_pylist()]
        rows = group.column("said").to_pylist()
        said = [np.concatenate([decoded(r[i]) for r in rows]) for i in range(len(rows[0]))]
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        _, index, at = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        first = np.zeros(len(at), bool)
        first[index] = True
        told, news = answer(at, first, *said)
        told = pa.array([coded(np.ascontiguousarray(x)) for x in np.split(told, cuts)], pa.binary())
        return pa.table({"bucket": group.column("bucket"), "block": group.column("block"), "told": told, "news": pa.array([int(x.sum()) for x in np.split(news, cuts)], pa.int64())})

    told = asked.groupBy("bucket").applyInArrow(bucket, "bucket bigint, block bigint, told binary, news bigint")
    told = told.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "told"))).alias("told"), F.sum("news").alias("news"))
    return dealt(told.select("block", F.col("told.told").alias("told"), "news"), name, "block", grouped=True)


def answers(told: list[bytes] | None) -> np.ndarray:
    """A block's answers, all in one."""
    return np.concatenate([np.zeros(0, U64), *map(decoded, told or [])])


# ---------------------------------------------------------------------------------------- components


def components(edges: DataFrame, a: str = "a", b: str = "b", salt: int = 32) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` is joined with, directly or not.

    Alternating large-star and small-star rounds; each ends in a scratch table, and the rounds end when the
    stars no longer change.  No node's neighbours are ever gathered: a round is a minimum by node and a join
    in which every node's edges are dealt over ``salt`` parts, so a node with a third of all edges is as
    cheap as any other.  Null ends and loops are left out.  Nothing goes to the driver but a checksum.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u != v")
    now = scratch(now.distinct(), "edges", small=True)
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: every larger neighbour is tied to the least of the neighbourhood
        now = _star(both, salt).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = scratch(now.where("u != v").distinct(), "large", small=True)
        # small star: a node and its smaller neighbours are tied to the least of them
        tied = _star(now, salt)
        now = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(tied.select("u", F.col("m").alias("v")))
        now = scratch(now.where("u != v").distinct(), "small", small=True)
        sign = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if sign == seen:
            break
        seen = sign
    stars = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return scratch(stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct(), "components", small=True)


def _star(edges: DataFrame, salt: int) -> DataFrame:
    least = scratch(edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least", small=True)
    dealt = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    # both sides grow with the input, which a small compressed file does not show: never broadcast
    return edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(salt)).cast("int")).join(dealt.hint("merge"), ["u", "salt"])
