"""Matching by profiles against every pair of rows, on random tables full of copies, ties and missing values."""

import random

import pytest
from pyspark.sql import functions as F

from curatio.functions.text import containment_score
from curatio.operators import orchestrate, resolve
from curatio.operators.rank import best_with_alternatives
from curatio.sources import scratch

ROUND2 = lambda x: F.round(x, 2)
NAMES = ["red bolt", "red ring", "old bolt match", "HPBT", "hollow point boat tail", "match", None, ""]
LINES = [None, "match", "", "pro hunter", "Sierra pro hunter bullets"]
MENTION = "mention_id long, m_name string, m_maker string, m_diameter double, m_weight double, m_sku string, m_product_line string, m_product_line_id long, m_caliber long, m_chamber long"
ENTITY = MENTION.replace("m_", "e_").replace("mention_id", "entity_id").replace("entity_id long, e_name", "entity_id long, e_name")
CONFIG = resolve.Config(bullet_diameter_tolerance_inches=0.35)


def tables(spark, seed, n=120):
    r = random.Random(seed)
    maybe = lambda x, p=0.3: None if r.random() < p else x
    row = lambda i: (i, r.choice(NAMES), maybe(r.choice("ab")), maybe(900 + r.randrange(8) / 4), maybe(r.choice([150.0, 150.4, 151.0, 155.0, 180.0])), maybe(f"s{r.randrange(40)}", 0.6), r.choice(LINES), maybe(r.randrange(4), 0.6), maybe(r.randrange(3)), maybe(r.randrange(3)))
    return spark.createDataFrame([row(i) for i in range(n)], MENTION), spark.createDataFrame([row(1000 + i) for i in range(n)], ENTITY)


def plain(mentions, pairs, score):
    best = best_with_alternatives(resolve.scored_tiers(pairs, CONFIG, score, ROUND2), ["mention_id"])
    return {r.mention_id: (r.entity_id, r.confidence, r.method, r.alternatives) for r in best.collect()}


def scored(found):
    return {r.mention_id: (r.entity_id, r.confidence, r.method, r.alternatives) for r in found.where("method <> 'exact_sku'").collect()}


@pytest.mark.parametrize(("seed", "score"), [(1, containment_score), (2, resolve.full_score)])
def test_every_pair_counts(spark, seed, score):
    mentions, entities = tables(spark, seed)
    uncoded = mentions.join(entities, F.col("m_sku") == F.col("e_sku"), "left_anti")
    want = plain(uncoded, resolve.candidates(*resolve.with_words(uncoded, entities), CONFIG), score)
    assert len(want) > 20 and scored(resolve.match(mentions, entities, CONFIG, score=score, rounded=ROUND2)) == want
    uncoded = mentions.join(entities, (F.col("m_sku") == F.col("e_sku")) & (F.col("m_caliber") == F.col("e_caliber")), "left_anti")
    want = plain(uncoded, resolve.cartridge_pairs(*resolve.with_words(uncoded, entities)), score)
    got = scored(resolve.match(mentions, entities, CONFIG, sku_scope=[("m_caliber", "e_caliber")], score=score, rounded=ROUND2, blocks=resolve.by_maker_and_caliber()))
    assert len(want) > 20 and got == want


def test_the_retry_and_rifles(spark):
    mentions, entities = tables(spark, 3)
    left = mentions.where("m_weight is not null").withColumn("m_sku", F.lit(None).cast("string"))
    want = plain(left, resolve.relaxed_candidates(*resolve.with_words(left, entities), CONFIG), containment_score)
    got = scored(resolve.match(left, entities, CONFIG, score=containment_score, rounded=ROUND2, blocks=resolve.by_weight_or_line(CONFIG)))
    assert len(want) > 20 and {k: v[:3] for k, v in got.items()} == {k: v[:3] for k, v in want.items()}
    found = {r.mention_id: (r.entity_id, r.confidence) for r in resolve.match_rifles(mentions, entities, CONFIG, containment_score, ROUND2).collect()}
    pairs = mentions.join(entities, F.col("m_maker") == F.col("e_maker")).withColumn("s", containment_score(F.col("m_name"), F.col("e_name"))).where("s > 0.5")
    agrees = F.coalesce(F.col("m_chamber") == F.col("e_chamber"), F.lit(False))
    both = F.when(F.col("m_chamber").isNull() | agrees, 0.85 + 0.1 * F.col("s")).otherwise(F.col("s") * 0.4)
    best = pairs.groupBy("mention_id").agg(F.min_by(F.struct("entity_id", F.round(both, 2).alias("c")), F.struct(-F.round(both, 2), "entity_id")).alias("b"))
    assert found == {r.mention_id: (r.b.entity_id, r.b.c) for r in best.collect()} and len(found) > 20


def test_copies_are_scored_once(spark):
    """Sixty mentions of which nothing is known, and sixty entities: four pairs of names, not 3,600."""
    calls = spark.sparkContext.accumulator(0)

    def said(a, b):
        calls.add(1)
        return 1.0 if a == b else 0.0

    mentions = spark.createDataFrame([(i, "ab"[i % 2], None, None, None, None, None, None) for i in range(60)], ", ".join(MENTION.split(", ")[:8]))
    entities = spark.createDataFrame([(i, "ab"[i % 2], "m", 0.3, 1.0, None, None, None) for i in range(60)], ", ".join(ENTITY.split(", ")[:8]))
    got = resolve.match(mentions, entities, score=F.udf(said, "double"), rounded=ROUND2).collect()
    assert {(r.mention_id % 2, r.entity_id, tuple(a.entity_id for a in r.alternatives)) for r in got} == {(0, 0, (2, 4, 6)), (1, 1, (3, 5, 7))} and len(got) == 60
    assert calls.value <= 40


def test_only_the_keys_that_mentions_know_make_profiles(spark):
    """Every mention has a maker and a diameter: entities are not told apart by one of the two, or by neither."""
    mentions, entities = tables(spark, 4, 20)
    before = len(scratch.written())
    resolve.match(mentions.where("m_maker is not null and m_diameter is not null"), entities, CONFIG, score=containment_score, rounded=ROUND2)
    known = [path for path in scratch.written()[before:] if path.rsplit("/", 1)[1].startswith("known-")]
    assert {r[0] for path in known for r in spark.read.parquet(path).select("__e_by").distinct().collect()} <= {3}


def test_passes_share_words_and_lines(spark, monkeypatch):
    """The three passes over bullets find the words of names and the short forms of lines once."""
    calls = []
    for name in ("said_words", "known_words", "normalize_product_line"):
        monkeypatch.setattr(resolve, name, lambda text, name=name, made=getattr(resolve, name): calls.append(name) or made(text))
    mentions, entities = (t.withColumns({f"{side}_g1": F.lit(0.5), f"{side}_g7": F.lit(None).cast("double")}) for t, side in zip(tables(spark, 5, 20), "me", strict=True))
    resolve.link_bullets(mentions, entities, CONFIG, score=containment_score, rounded=ROUND2)
    assert sorted(calls) == ["known_words", "normalize_product_line", "said_words"]


def test_a_name_is_looked_up_once(spark, monkeypatch):
    """Sixty mentions of one maker's line: the line, its short form and the name, not three for every mention."""
    asked = []
    monkeypatch.setattr(orchestrate, "lookup", lambda mentions, names, lookup=orchestrate.lookup, **how: asked.append(mentions.count()) or lookup(mentions, names, **how))
    mentions = spark.createDataFrame([(i, 1, "red bolt", "pro hunter") for i in range(60)], "mention_id long, m_maker long, m_name string, m_product_line string")
    names = spark.createDataFrame([("pro hunter", 7, 1, "exact_name", 1.0, 1, 0)], "norm string, entity_id long, maker_id long, method string, confidence double, tier int, ord int")
    assert {tuple(r) for r in orchestrate.product_lines(mentions, names).collect()} == {(i, 7) for i in range(60)} and max(asked) <= 3
