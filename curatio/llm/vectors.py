"""Embedding near-duplicates by dual traversal of cover trees: every pair at or above a cosine, exactly.

On unit vectors a cosine of at least c is a distance of at most t = sqrt(2 - 2c).  Equal vectors are counted
and stand as one.  A bounded sample, as large as the cells need, gives centres, one for about ``block`` vectors (at most
``cells``); each vector goes to its nearest, and a cell whose centre lies further than both covering radii plus t from
another's is never compared with it.  Cells are dealt into blocks of about ``block`` vectors, and each pair of blocks
that may hold a link is one piece of work.  The blocks, each with its tree, are written once; every two parts of that table
meet by being read again (a Cartesian product of files), so no block is copied for each block that it is compared with.

In a group, each block gets a cover tree: nested nets whose radii halve from level to level, every node with
its exact covering radius; a level whose net would hold most of a node's points is left out.  Two trees are walked
together: a pair of nodes further apart than both radii plus t is dropped, a pair wholly within t is counted without
being opened, and the rest are opened down to single vectors, whose cosine is then taken in double precision.  At the
top the distance is first bounded from below by the first ``FIRST`` coordinates alone.  A group returns one row per
linked vector: how many it links with, and the least vector it is tied to there.  Sums give the links and ``components``
the classes, so no list of pairs exists anywhere.

Vectors that are null, zero, or hold null or non-finite components link with nothing; so do vectors of
different lengths with each other.  There is one row per vector: rows that repeat a key or have none are vectors of
their own; a component is named by its least key that is not null.  A vector without links has its own key, or null,
as its component.  An empty table gives an empty result.  Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.llm.shared import clear, components, salted_join, scratch, written

#: One row for a block: its vectors, the parts of its tree, and the blocks it is compared with.
GROWN = "block int, near array<int>, points binary, tree array<binary>"
GROWN_ARROW = pa.schema([("block", pa.int32()), ("near", pa.list_(pa.int32())), ("points", pa.binary()), ("tree", pa.list_(pa.binary()))])
#: What single-precision distances may be off by, with room to spare.
SLACK = 1e-3
STEP = 100_000
#: The level of a node's children where coarser nets would hold most of its points; the coordinates looked at first; nodes in a tile.
FINE, FIRST, TILE = 0.125, 24, 1024


class CoverTree:
    """Nodes in arrays; a node's points are order[begin:end], its children nodes first:last."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points.astype(np.float32)
        self.order = np.arange(len(points))
        nodes = [[0, 0.0, 0, len(points), 0, 0]]  # centre, radius, begin, end, first child, last
        levels = [2.0]
        at = 0
        while at < len(nodes):
            begin, end, level = nodes[at][2], nodes[at][3], levels[at]
            own = self.order[begin:end]
            nodes[at][1] = float(self._distance(own, nodes[at][0]).max()) if end - begin > 1 else 0.0
            if nodes[at][1] > 1e-4:
                level /= 2
                centres, which = self._net(own, level)
                if level > FINE and len(centres) > len(own) / 2:
                    level = FINE
                    centres, which = self._net(own, level)
                while len(centres) == 1 and level > 1e-4:
                    level /= 2
                    centres, which = self._net(own, level)
                if len(centres) > 1:
                    sort = np.argsort(which, kind="stable")
                    self.order[begin:end] = own[sort]
                    cuts = begin + np.searchsorted(which[sort], np.arange(len(centres) + 1))
                    nodes[at][4:] = len(nodes), len(nodes) + len(centres)
                    nodes += [[c, 0.0, a, b, 0, 0] for c, a, b in zip(centres, cuts[:-1], cuts[1:], strict=True)]
                    levels += [level] * len(centres)
            at += 1
        self.centre, self.radius, self.begin, self.end, self.first, self.last = (np.array(x) for x in zip(*nodes, strict=True))
        self.at = self.points[self.centre]

    ARRAYS = (("order", "<i4"), ("centre", "<i4"), ("radius", "<f8"), ("begin", "<i4"), ("end", "<i4"), ("first", "<i4"), ("last", "<i4"))

    def parts(self) -> list[bytes]:
        return [np.ascontiguousarray(getattr(self, name), kind).tobytes() for name, kind in self.ARRAYS]

    @classmethod
    def of(cls, points: np.ndarray, parts: list[bytes]) -> "CoverTree":
        """A tree again, from its points and parts()."""
        tree = cls.__new__(cls)
        tree.points = points.astype(np.float32)
        for (name, kind), raw in zip(cls.ARRAYS, parts, strict=True):
            setattr(tree, name, np.frombuffer(raw, kind).astype(np.float64 if name == "radius" else np.int64))
        tree.at = tree.points[tree.centre]
        return tree

    def _distance(self, own: np.ndarray, centre: int) -> np.ndarray:
        return np.sqrt(np.maximum(0, 2 - 2 * (self.points[own] @ self.points[centre])))

    def _net(self, own: np.ndarray, radius: float) -> tuple[list[int], np.ndarray]:
        """Centres further than ``radius`` apart that cover all within it, and each point's centre."""
        least = 1 - radius * radius / 2
        centres: list[int] = []
        which = np.empty(len(own), np.int64)
        for lo in range(0, len(own), 256):
            part = own[lo : lo + 256]
            near = np.full(len(part), -1)
            if centres:
                dots = self.points[part] @ self.points[centres].T
                best = dots.argmax(axis=1)
                near = np.where(dots[np.arange(len(part)), best] >= least, best, -1)
            left = np.flatnonzero(near < 0)
            if len(left):
                dots = self.points[part[left]] @ self.points[part[left]].T
                open_ = np.ones(len(left), bool)
                for i in range(len(left)):
                    if open_[i]:
                        mine = open_ & (dots[i] >= least)
                        mine[i] = True
                        near[left[mine]] = len(centres)
                        centres.append(int(part[left[i]]))
                        open_ &= ~mine
            which[lo : lo + 256] = near
        return centres, which


class Links:
    """Counts of links by point and the components of what is linked."""

    def __init__(self, weight: np.ndarray) -> None:
        self.weight, self.count, self.parent = weight, np.zeros(len(weight), np.int64), np.arange(len(weight))

    def find(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[x]
            if np.array_equal(up, x):
                return x
            x = up

    def tie(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.find(a), self.find(b)
            open_ = a != b
            a, b = a[open_], b[open_]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))

    def pairs(self, a: np.ndarray, b: np.ndarray) -> None:
        self.count += np.bincount(a, self.weight[b], len(self.weight)).astype(np.int64) + np.bincount(b, self.weight[a], len(self.weight)).astype(np.int64)
        self.tie(a, b)


def dual(left: CoverTree, right: CoverTree, same: bool, exact: np.ndarray, dims: np.ndarray, shift: int, cosine: float, links: Links) -> None:
    """Counts every pair of ``left`` and ``right`` at or above ``cosine``; right's points are numbered from shift in exact."""
    t = float(np.sqrt(max(0.0, 2 - 2 * cosine)))

    def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", left.at[a], right.at[b])))

    def keep(a: np.ndarray, b: np.ndarray, d: np.ndarray) -> None:
        ra, rb = left.radius[a], right.radius[b]
        self_pair = (a == b) & same
        may = self_pair | (d <= ra + rb + t + SLACK)
        a, b, d, ra, rb, self_pair = a[may], b[may], d[may], ra[may], rb[may], self_pair[may]
        one = (left.end[a] - left.begin[a] == 1) & (right.end[b] - right.begin[b] == 1)
        whole = ~one & (np.where(self_pair, 0, d) + ra + rb <= t - SLACK)
        leaf = ~one & ~whole & (left.last[a] == 0) & (right.last[b] == 0)
        for i in np.flatnonzero(whole | leaf):
            x, y = left.order[left.begin[a[i]] : left.end[a[i]]], right.order[right.begin[b[i]] : right.end[b[i]]] + shift
            if leaf[i] or len(set(dims[x].tolist()) | set(dims[y].tolist())) > 1:
                xs, ys = (v.ravel() for v in np.meshgrid(x, y, indexing="ij"))
                point_pairs(*((xs[xs < ys], ys[xs < ys]) if self_pair[i] else (xs, ys)))
                continue
            wx, wy = links.weight[x].sum(), links.weight[y].sum()
            links.count[x] += wy - (links.weight[x] if self_pair[i] else 0)
            if not self_pair[i]:
                links.count[y] += wx
            both = np.concatenate([x, y])
            links.tie(both, np.full(len(both), both[0]))
        point = one & ~self_pair
        point_pairs(left.order[left.begin[a[point]]], right.order[right.begin[b[point]]] + shift)
        rest = np.flatnonzero(~one & ~whole & ~leaf)
        if len(rest):
            todo.append((a[rest], b[rest]))

    def point_pairs(x: np.ndarray, y: np.ndarray) -> None:
        for lo in range(0, len(x), STEP):
            p, q = x[lo : lo + STEP], y[lo : lo + STEP]
            found = (np.einsum("ij,ij->i", exact[p], exact[q]) >= cosine) & (dims[p] == dims[q])
            links.pairs(p[found], q[found])

    def tops(tree: CoverTree) -> np.ndarray:
        own = np.arange(tree.first[0], tree.last[0]) if tree.last[0] else np.zeros(1, np.int64)
        return own[np.argsort(tree.radius[own], kind="stable")]  # wide nodes share tiles

    def halves(points: np.ndarray, left_side: bool) -> np.ndarray:
        """Rows whose products are minus half the squared distances in the first coordinates."""
        some = points[:, :FIRST]
        less, one = -0.5 * (some * some).sum(axis=1, keepdims=True), np.ones((len(points), 1), np.float32)
        return np.hstack([some, less, one] if left_side else [some, one, less]).astype(np.float32)

    todo: list[tuple[np.ndarray, np.ndarray]] = []
    tl, tr = tops(left), tops(right)
    hl, hr = halves(left.at[tl], True), halves(right.at[tr], False)
    for i in range(0, len(tl), TILE):
        for k in range(i if same else 0, len(tr), TILE):
            most = min(2.0, left.radius[tl[i : i + TILE]].max() + right.radius[tr[k : k + TILE]].max() + t + SLACK)  # by the tile's widest nodes; keep() takes each pair's own
            dots = hl[i : i + TILE] @ hr[k : k + TILE].T
            near = np.flatnonzero((dots >= np.float32(-(most**2) / 2 - 1e-4)).ravel())
            if len(near) > dots.size // 16:
                dots = left.at[tl[i : i + TILE]] @ right.at[tr[k : k + TILE]].T
                near = np.flatnonzero((dots >= np.float32(1 - most**2 / 2 - 1e-5)).ravel())
            a, b = near // dots.shape[1], near % dots.shape[1]
            if same and i == k:
                a, b = a[a <= b], b[a <= b]
            a, b = tl[a + i], tr[b + k]
            keep(a, b, distances(a, b))
            while todo:
                a, b = todo.pop()
                # open the wider node of each pair; of a pair with itself both
                wide = (left.radius[a] >= right.radius[b]) & (left.last[a] > 0) | (right.last[b] == 0)
                mine = (a == b) & same
                n = np.where(mine, (left.last[a] - left.first[a]) ** 2, np.where(wide, left.last[a] - left.first[a], right.last[b] - right.first[b]))
                if len(a) > 1 and n.sum() > STEP:
                    cut = max(1, min(len(a) - 1, int(np.searchsorted(np.cumsum(n), STEP))))
                    todo += [(a[cut:], b[cut:]), (a[:cut], b[:cut])]
                    continue
                if len(a) == 1 and mine[0]:
                    kids = np.arange(left.first[a[0]], left.last[a[0]])
                    for lo in range(0, len(kids), 256):
                        xs, ys = np.meshgrid(kids[lo : lo + 256], kids, indexing="ij")
                        xs, ys = xs[xs <= ys], ys[xs <= ys]
                        keep(xs, ys, distances(xs, ys))
                    continue
                if mine.any():
                    todo += [(a[m : m + 1], b[m : m + 1]) for m in np.flatnonzero(mine)]
                    a, b, wide, n = a[~mine], b[~mine], wide[~mine], n[~mine]
                    if not len(a):
                        continue
                row = np.repeat(np.arange(len(a)), n)
                child = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.where(wide, left.first[a], right.first[b])[row]
                xs, ys = np.where(wide[row], child, a[row]), np.where(wide[row], b[row], child)
                keep(xs, ys, distances(xs, ys))


def POINTS(width: int, kind: str) -> np.dtype:  # noqa: N802
    return np.dtype([("id", "<i8"), ("copies", "<i8"), ("size", "<i4"), ("v", kind, (width,))])


def every_two(blocks: DataFrame) -> DataFrame:
    """Each block beside each that it may have links with, itself included, once: parts of the table are read, nothing is shuffled."""
    others = blocks.select(F.col("block").alias("other"), F.col("points").alias("points_2"), F.col("tree").alias("tree_2"))
    return blocks.join(others.hint("shuffle_replicate_nl"), (F.col("block") <= F.col("other")) & F.array_contains("near", F.col("other")))


def matrix(column: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column, short ones filled up with zeros, and the lists' lengths."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.array(column.value_lengths().fill_null(0), dtype=np.int64)
    flat = np.array(column.flatten(), dtype=np.float64)
    out = np.zeros((len(sizes), max(width or 0, int(sizes.max(initial=1)))))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out, sizes


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)  # so that no square is out of range
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)


def linked(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.9, block: int = 4096, cells: int = 4096) -> DataFrame:
    """(key, n_links, component_id, kept) for every vector."""
    spark = vectors.sparkSession
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    doubles = F.col(vector).cast("array<double>")
    usable = F.coalesce((F.size(doubles) > 0) & ~F.exists(doubles, bad) & F.exists(doubles, lambda x: x != 0), F.lit(False))
    twin = {"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")}
    single = vectors.schema[vector].dataType.simpleString() == "array<float>"
    kind = "float" if single else "double"  # tables of vectors stay as small as the input
    rows = vectors.select(F.col(key).alias("key"), F.when(usable, doubles.cast(f"array<{kind}>")).alias("v")).withColumns(twin)
    # equal vectors stand as one, under a number of their own
    once = rows.where("v is not null").groupBy("h1", "h2").agg(F.count("*").alias("copies"), F.min("key").alias("least"), F.first("v").alias("v"))
    held = scratch(once.withColumn("id", F.monotonically_increasing_id()), "vectors")
    done = written()[-1]
    classes = scratch(held.select("id", "h1", "h2", "copies", "least"), "classes")
    n, width = held.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    wanted = max(1, min(cells, -(-n // block)))
    seen = held.select("v").orderBy("h1", "h2").limit(max(2048, 16 * wanted)).toArrow()
    centres = _centres(matrix(seen.column("v"), width)[0], wanted) if seen.num_rows else np.zeros((1, width))
    shared = spark.sparkContext.broadcast(centres)  # at most ``cells`` vectors

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if part.num_rows:
                dots = unit(matrix(part.column("v"), width)[0]) @ shared.value.T
                cell = dots.argmax(axis=1)
                gap = np.sqrt(np.maximum(0, 2 - 2 * dots[np.arange(len(cell)), cell]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32)), pa.array(gap)], [*part.schema.names, "cell", "gap"])

    in_cells = scratch(held.select("id", "v", "copies").mapInArrow(place, f"id bigint, v array<{kind}>, copies bigint, cell int, gap double"), "cells")
    clear(spark, [x for x in written() if x != done], keep=0)
    done = written()[-1]
    stats = in_cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("r")).orderBy("cell").collect()  # a row per cell
    t = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    cuts = np.concatenate([[0], np.cumsum([-(-s["n"] // block) for s in stats])]).astype(int).tolist()
    at, reach = centres[[s["cell"] for s in stats]], np.array([s["r"] for s in stats])
    table = []
    for i, s in enumerate(stats):  # which cells may hold a link with this one, and their blocks
        close = np.flatnonzero(np.linalg.norm(at - at[i], axis=1) <= reach + s["r"] + t + SLACK).tolist()
        table.append((s["cell"], cuts[i], cuts[i + 1] - cuts[i], [b for o in close for b in range(cuts[o], cuts[o + 1])]))
    by_cell = F.broadcast(spark.createDataFrame(table, "cell int, first int, n int, near array<int>"))  # a row per cell

    stored = "<f4" if single else "<f8"

    def grow(group: pa.Table) -> pa.Table:
        """A block's vectors and its cover tree as one row: it is grown once."""
        group = group.take(pc.sort_indices(group, [("id", "ascending")]))
        raw, dims = matrix(group.column("v"), width)
        points = np.zeros(len(raw), POINTS(width, stored))
        points["id"], points["copies"], points["size"], points["v"] = np.array(group.column("id")), np.array(group.column("copies")), dims, raw
        tree = CoverTree(unit(raw)).parts()
        return pa.Table.from_pylist([{"block": group.column("block")[0].as_py(), "near": group.column("near")[0].as_py(), "points": points.tobytes(), "tree": tree}], GROWN_ARROW)

    dealt_ = in_cells.join(by_cell, "cell").withColumn("block", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("n"))).cast("int"))
    grown = dealt_.select("id", "v", "copies", "block", "near").groupBy("block").applyInArrow(grow, GROWN)
    blocks = scratch(grown, "blocks")
    clear(spark, [x for x in written() if x != done], keep=0)
    done = written()[-1]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for i in range(part.num_rows):
                yield compared(part.slice(i, 1).to_pylist()[0])

    def compared(row: dict) -> pa.RecordBatch:
        alone = row["block"] == row["other"]
        read = [np.frombuffer(row[p], POINTS(width, stored)) for p in ("points", "points_2")[: 1 if alone else 2]]
        units = [unit(x["v"].astype(np.float64)) for x in read]
        every = np.concatenate(read)
        ids, exact, dims = every["id"], np.concatenate(units), every["size"].astype(np.int64)
        trees = [CoverTree.of(x, row[t]) for x, t in zip(units, ("tree", "tree_2"), strict=False)]
        links = Links(every["copies"])
        dual(trees[0], trees[-1], alone, exact, dims, 0 if alone else len(read[0]), cosine, links)
        told = np.flatnonzero(links.count)
        least = np.full(len(ids), np.iinfo(np.int64).max)
        roots = links.find(np.arange(len(ids)))
        np.minimum.at(least, roots, ids)
        return pa.RecordBatch.from_pydict({"id": ids[told], "links": links.count[told], "tied": least[roots[told]]})

    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, "4")  # a row holds two blocks
    try:
        found = scratch(every_two(blocks).drop("near").mapInArrow(join, "id bigint, links bigint, tied bigint"), "links")
    finally:
        spark.conf.set(batch, before)
    clear(spark, [x for x in written() if x != done], keep=0)
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    tied = components(found.select(F.col("id").alias("a"), F.col("tied").alias("b"))).withColumnRenamed("node", "id")
    told = classes.join(counts.hint("merge"), "id", "left").join(tied.hint("merge"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    told = scratch(told.select("h1", "h2", "component", "least", (F.coalesce("links", F.lit(0).cast("long")) + F.col("copies") - 1).alias("links")), "told")
    named = told.groupBy("component").agg(F.min("least").alias("name"))
    told = salted_join(told, named, ["component"], by=["h1"]).select("h1", "h2", "links", "name")
    alone = rows.where("v is null").select("key", F.lit(0).cast("long").alias("links"), F.col("key").alias("name"))
    out = salted_join(rows.where("v is not null").select("key", "h1", "h2"), told, ["h1", "h2"]).select("key", "links", "name").unionByName(alone)
    return out.select(F.col("key").alias(key), F.col("links").alias("n_links"), F.col("name").alias("component_id"), F.col("key").eqNullSafe(F.col("name")).alias("kept"))


def _centres(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first centres of a sample."""
    x = unit(sample)
    chosen, gap = [0], 1 - x @ x[0]
    while len(chosen) < min(n, len(x)):
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, 1 - x @ x[chosen[-1]])
    return x[chosen]


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), r AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a
), c AS (SELECT a, min(b) AS m FROM r GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM p WHERE p.a = vec_id) AS n_links, m AS component_id, vec_id = m AS kept
FROM embeddings JOIN c ON c.a = vec_id
"""
