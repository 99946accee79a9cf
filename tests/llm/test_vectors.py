"""Cover trees and the vector join against all pairs."""

import numpy as np
import pytest

from curatio.llm.vectors import CoverTree, Links, dual, linked, unit


def clouds(seed):
    r = np.random.default_rng(seed)
    base = r.normal(size=(60, 8))
    near = base[r.integers(0, 60, 300)] + r.normal(size=(300, 8)) * r.choice([0.01, 0.1, 0.3], size=(300, 1))
    return np.concatenate([base, near, base[:1] + r.normal(size=(400, 8)) * 0.2, base[:1] * 3])


@pytest.mark.parametrize("seed", range(3))
def test_dual_traversal_finds_every_pair(seed):
    e = unit(clouds(seed))
    n = len(e)
    g = (e @ e.T) >= 0.9
    np.fill_diagonal(g, False)
    w = np.random.default_rng(seed).integers(1, 4, n)
    one, tree = Links(w), CoverTree(e)
    dual(tree, tree, True, e, np.full(n, 8), 0, 0.9, one)
    assert (one.count == g @ w).all()
    two, c = Links(w), 300
    dual(CoverTree(e[:c]), CoverTree.of(e[c:], CoverTree(e[c:]).parts()), False, e, np.full(n, 8), c, 0.9, two)
    g[:c, :c] = g[c:, c:] = False
    assert (two.count == g @ w).all()


def test_covering_radii_hold_and_nets_are_nested():
    tree = CoverTree(unit(clouds(1)))
    for k in range(len(tree.centre)):
        own = tree.order[tree.begin[k] : tree.end[k]]
        assert tree._distance(own, tree.centre[k]).max() <= tree.radius[k] + 1e-3
        if tree.last[k]:
            assert tree.begin[tree.first[k]] == tree.begin[k] and tree.end[tree.last[k] - 1] == tree.end[k]


@pytest.mark.parametrize("block", [4096, 100])
def test_links_and_classes(spark, block):
    x = clouds(2)
    e = unit(x)
    g = (e @ e.T) >= 0.9
    np.fill_diagonal(g, False)
    least = np.arange(len(x))
    while True:
        new = np.array([min(least[i], *(least[np.flatnonzero(g[i])]), least[i]) if g[i].any() else least[i] for i in range(len(x))])
        if (new == least).all():
            break
        least = new
    rows = [(i, [float(v) for v in row], "clash", 1.0) for i, row in enumerate(x)]
    got = linked(spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string, v double"), block=block).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (int(g[i].sum()), int(least[i]), least[i] == i) for i in range(len(x))}


def test_unusable_vectors_link_with_nothing(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [1.0, 0.0, 0.0]), (1, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [None, 1.0]), (9, []), (None, [1.0, 0.0])]
    got = linked(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    together = [(k, 4, 1, k == 1) for k in (1, 1, 2, 7, None)]
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=str) == sorted([*together, *((k, 0, k, True) for k in (3, 4, 5, 6, 8, 9))], key=str)
    assert linked(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
    named = linked(spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.01]), (None, None)], "vec_id string, embedding array<double>")).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in named), key=str) == [("a", 1, "a", True), ("b", 1, "a", False), (None, 0, None, True)]
