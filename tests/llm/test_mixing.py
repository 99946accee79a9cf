"""Mixing: targets by water filling, exact totals, spans that are really taken."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from curatio.llm.mixing import counted, mixed, mixed_texts, permuted, targets
from tests.llm.helpers import odd


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1000])
def test_the_permutation_is_one(spark, n):
    got = [r[0] for r in spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), F.lit("key"))).collect()]
    assert sorted(got) == list(range(n))
    assert n < 100 or got != list(range(n))


def filled(sizes, weights=(5, 2, 1)):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    out, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100, None: 50}, {"a": 1, "b": 1000, "c": 10}, {"a": 0, "b": 5}, {"x": 7}])
def test_targets_as_by_sharing_again_and_again(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in targets(rows).collect()}
    assert got == pytest.approx(filled(sizes))


def docs(spark):
    rows = [(i, " ".join(f"{s}{i}_{k}" for k in range((i * 37) % 400)), s) for i, s in enumerate(["a", "b", "b", "c", None] * 30)]
    return spark.createDataFrame([*rows, (500, None, "a"), (501, "", "zz")], "doc_id long, text string, source string")


def test_every_source_gives_its_target(spark):
    documents, mix = mixed(docs(spark), block=16, shard_words=3700)
    rows = counted(documents, mix).collect()
    again = counted(*mixed(docs(spark), block=16, shard_words=3700)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    taken, target = Counter(), {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert len({r.shard for r in mix.collect()}) > 4


def test_mixed_texts_hold_the_words_taken(spark):
    table = docs(spark).withColumn("text", F.regexp_replace("text", "_7 ", "_7\n\n "))
    documents, mix = mixed(table, block=16, shard_words=3700)
    want = {r.key: r.taken for r in counted(documents, mix).collect() if r.taken}
    got = defaultdict(list)
    for r in mixed_texts(table, block=16, shard_words=3700).collect():
        got[r.doc_id].append(r.text)
    assert sum(len(t.split()) for ts in got.values() for t in ts) == pytest.approx(sum(want.values()), abs=2)
    whole = {r.doc_id: r.text for r in table.collect()}
    for i, ts in got.items():
        assert len(ts) <= 2 and max(Counter(w for t in ts for w in t.split()).values()) <= 2
        for t in ts:
            assert set(t.split()) <= set(whole[i].split()) and t == t.rstrip()
            assert all(line in whole[i] for line in t.split("\n\n ")) or t != whole[i]
    assert any("\n\n" in t for ts in got.values() for t in ts)


def test_odd_and_empty(spark):
    rows = counted(*mixed(odd(spark))).collect()
    assert len(rows) == odd(spark).count()
    by = defaultdict(int)
    for r in rows:
        by[r.source] += r.taken
    assert sum(by.values()) == pytest.approx(sum({r.source: r.target for r in rows}.values()), abs=2)
    assert counted(*mixed(odd(spark, []))).collect() == []
    assert set(mixed_texts(odd(spark)).columns) == set(odd(spark).columns)
