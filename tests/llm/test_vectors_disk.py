"""Blocks of vectors meet by being read again: nothing that grows with the pairs of blocks is written."""

import numpy as np

from curatio.llm import vectors
from curatio.sources.scratch import written


def test_pairs_of_blocks_are_not_shuffled(spark, monkeypatch):
    plans, real = [], vectors.every_two

    def seen(blocks):
        out = real(blocks)
        plans.append((out._jdf.queryExecution().executedPlan().toString(), out.count(), blocks.count()))
        return out

    monkeypatch.setattr(vectors, "every_two", seen)
    x = np.random.default_rng(5).normal(size=(300, 16)).astype(np.float32)
    x[200:] = x[:100] * np.float32(1.5)
    before = set(written())
    got = vectors.linked(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>"), block=40).collect()
    ((plan, pairs, blocks),) = plans
    assert "CartesianProduct" in plan and "Exchange" not in plan
    assert blocks > 4 and blocks <= pairs <= blocks * (blocks + 1) // 2
    e = vectors.unit(x.astype(np.float64))
    g = e @ e.T >= 0.9
    assert {r.vec_id: r.n_links for r in got} == {i: int(g[i].sum()) - 1 for i in range(len(x))}
    assert not [p for p in written() if p not in before and any(f"/{n}-" in p for n in ("vectors", "cells", "blocks"))]
