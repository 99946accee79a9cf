"""One mention through all its references, and the reports over the catalogue, on small tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from curatio.operators import orchestrate, reports, store
from curatio.operators.lookup import names_table

NAMES = "id long, name string, alt_names array<string>, maker_id long"
MENTION = "mention_id long, entity_type string, maker string, caliber string, diameter string, bullet_name string, m_name string, m_sku string, m_weight double, m_product_line string, m_g1 double, m_g7 double"


@pytest.fixture(scope="module")
def at(spark):
    makers = spark.createDataFrame([(1, "Hornady", ["Hornady Mfg"], None), (2, "Sierra Bullets", [], None), (3, "Federal", [], None)], NAMES)
    calibers = spark.createDataFrame([(10, ".308 Winchester", ["308 Win"], None), (11, "6.5 Creedmoor", [], None), (12, "Wildcat", [], None)], NAMES)
    lines = spark.createDataFrame([(100, "ELD Match", ["ELDM"], 1), (101, "MatchKing", ["SMK"], 2), (102, "Match", [], 2)], NAMES)
    text = lambda df: df.select(F.col("id").alias("entity_id"), F.col("name").alias("text"))
    sizes = spark.createDataFrame([(10, 0.308), (11, 0.264), (12, None)], "caliber_id long, caliber_diameter double")
    bridge = spark.createDataFrame([(10, 50, False), (10, 51, True), (11, 52, False)], "caliber_id long, chamber_id long, is_primary boolean")
    return orchestrate.Catalogue(names_table(makers, None, "manufacturer"), text(makers), names_table(calibers, None, "caliber", caliber=True), text(calibers), sizes, bridge, names_table(lines, None, "bullet_product_line"))


MENTIONS = [
    (1, "bullet", "Hornady Mfg", None, "0.308", None, "ELDM 178", None, 178.0, "ELDM", None, None),
    (2, "bullet", None, None, "wide", None, "x", None, None, None, None, None),
    (3, "cartridge", "Federal", "308 Win", None, "SMK", "Gold Medal 175", "GM308", 175.0, None, None, None),
    (4, "cartridge", "Nobody", "9mm", None, "SMK", "Ball", None, 115.0, None, None, None),
    (5, "rifle", "Sierra Bullets", "6.5 Creedmoor", None, None, "Long Range Hunter", None, None, None, None, None),
    (6, "rifle", "Federal", "Wildcat", None, None, "Walker", None, None, None, None, None),
    (7, "scope", "Federal", None, None, None, "Glass", None, None, None, None, None),
    (8, "cartridge", "Federal", ".308 Winchester", None, "SMK", "Other", None, 250.0, None, None, None),
    (9, None, None, None, None, None, None, None, None, None, None, None),
]


def test_references_and_what_is_missing(spark, at):
    got = {r.mention_id: r for r in orchestrate.references(spark.createDataFrame(MENTIONS, MENTION), at).collect()}
    assert len(got) == len(MENTIONS)
    assert (got[1].manufacturer_id, got[1].bullet_diameter, got[1].unresolved_refs) == (1, 0.308, [])
    assert got[2].unresolved_refs == ["manufacturer: not extracted", "bullet_diameter_inches: invalid value 'wide'"]
    assert (got[3].caliber_id, got[3].chamber_id, got[3].caliber_diameter) == (10, None, 0.308)
    assert got[4].unresolved_refs == ["manufacturer: Nobody", "caliber: 9mm"]
    assert (got[5].caliber_id, got[5].chamber_id, got[5].unresolved_refs) == (11, 52, [])
    assert (got[6].caliber_id, got[6].chamber_id, got[6].unresolved_refs) == (12, None, ["chamber (from caliber): Wildcat"])
    assert got[7].warnings == ["Unknown entity type: scope"] and got[7].unresolved_refs == []
    assert got[9].unresolved_refs == ["manufacturer: not extracted"] and got[9].warnings == []


def test_product_line_by_the_first_name_that_hits(spark, at):
    rows = [(1, 1, "any", "ELDM"), (2, 1, "ELD Match", "no such line"), (3, 2, "ELD Match", None), (4, None, "SMK", None), (5, 2, None, None)]
    got = {r.mention_id: r.product_line_id for r in orchestrate.product_lines(spark.createDataFrame(rows, "mention_id long, m_maker long, m_name string, m_product_line string"), at.product_lines).collect()}
    assert got == {1: 100, 2: 100, 4: 101}


def test_every_type_is_matched_and_cartridges_get_their_bullet(spark, at):
    entity = "entity_id long, e_name string, e_maker long, e_diameter double, e_weight double, e_sku string, e_product_line string, e_product_line_id long, e_g1 double, e_g7 double"
    bullets = spark.createDataFrame([(1, "30 Cal .308 178 gr ELD Match", 1, 0.308, 178.0, None, "ELD Match", 100, None, None), (2, "30 Cal 175 gr HPBT", 2, 0.308, 175.0, None, "MatchKing", 101, None, None)], entity)
    cartridges = spark.createDataFrame([(20, "Gold Medal", 3, 0.308, 175.0, "GM308", None, None, None, None, 10), (21, "Gold Medal", 3, 0.264, 140.0, "GM308", None, None, None, None, 11)], entity + ", e_caliber long")
    rifles = spark.createDataFrame([(30, "Long Range Hunter", 2, 52), (31, "Long Range Hunter", 2, 51)], "entity_id long, e_name string, e_maker long, e_chamber long")
    out = orchestrate.resolved(spark.createDataFrame(MENTIONS, MENTION), at, bullets, cartridges, rifles).cache()
    got = {r.mention_id: r for r in out.collect()}
    assert len(got) == len(MENTIONS)
    assert (got[1].entity_id, got[1].method, got[1].product_line_id) == (1, "product_line_alias", 100)
    assert (got[3].entity_id, got[3].method, got[3].bullet_id, got[3].bullet_match_method) == (20, "exact_sku", 2, "product_line_alias")
    assert got[3].bullet_match_confidence == pytest.approx(0.98) and got[3].unresolved_refs == []
    assert got[5].entity_id == 30 and got[5].method == "composite_key"
    assert got[8].bullet_id is None and got[8].unresolved_refs == ["bullet: SMK (weight mismatch)"]
    assert got[4].bullet_id is None and got[4].unresolved_refs == ["manufacturer: Nobody", "caliber: 9mm"]
    false, none = F.lit(False), F.lit(None)
    acted = store.decided(
        out.withColumns({"rejected": false, "excluded_caliber": false, "orphan_diameter": false, "target_locked": false, "weight": F.col("m_weight"), "target_weight": none.cast("double"), "old_bullet_id": none.cast("bigint")}).withColumn("bullet_diameter", F.col("caliber_diameter"))
    )
    actions = {r.mention_id: r.action for r in acted.collect()}
    assert (actions[1], actions[3], actions[4], actions[5]) == ("matched_existing", "matched_updated", "flagged_unresolved", "matched_existing")


def test_resolution_of_nothing(spark, at):
    assert orchestrate.references(spark.createDataFrame([], MENTION), at).count() == 0


def test_parsers_against_the_catalogue(spark):
    row = "url string, declined boolean, w double, g1 double, sku string"
    parsed = spark.createDataFrame([("a", False, 100.0, 0.5, "s"), ("b", False, 100.0, None, None), ("c", True, None, None, None), ("d", False, 1.0, 1.0, "x"), ("e", False, 100.0, 0.5, "s")], row)
    known = spark.createDataFrame([("a", True, 100.9, 0.5, "s"), ("b", False, 102.0, 0.4, "t"), ("c", False, 1.0, 1.0, "u"), ("e", None, None, 0.7, "t")], "url string, is_locked boolean, w double, g1 double, sku string")
    got = {r.url: (r.outcome, r.locked, r.diffs) for r in reports.against_catalogue(parsed, known, ["w", "g1"], asked=["g1"], codes=["sku"]).collect()}
    assert got == {"a": ("match", True, []), "b": ("diff", False, ["w"]), "c": ("declined", False, []), "d": ("not_in_catalogue", False, []), "e": ("diff", False, ["w", "g1", "sku"])}


def test_flags_and_what_to_verify_next(spark):
    flags = spark.createDataFrame([("low", None), ("low", "done"), (None, None)], "reason string, status string")
    assert {(r.by, r.value): r.n for r in reports.flag_counts(flags).collect()} == {("reason", "low"): 2, ("reason", "unknown"): 1, ("status", "pending"): 2, ("status", "done"): 1}
    day = lambda n: datetime.date(2026, 1, 31) - datetime.timedelta(n)
    log = spark.createDataFrame([(1, day(5)), (1, day(50)), (2, day(31)), (3, day(90)), (5, day(30))], "id long, verified date")
    got = reports.next_to_verify(spark.range(1, 6), log, F.lit(day(0)), 3).collect()
    assert [r.id for r in got] == [4, 3, 2]


def test_numbers_in_notes(spark):
    rows = [('6.5mm (.264")', "140 gr, G1 BC: 0.625 G7=0.315", 0.264), (".308 / 30 CAL", "178.5GR", 0.308), (".270 CAL", None, 0.277), (".500 CAL", "", 0.500), (None, "Dia: 7.83 mm (.308'')", 0.301)]
    out = reports.note_numbers(spark.createDataFrame(rows, "caliber string, notes string, d double"))
    got = [(r.note_weight, r.note_g1, r.note_g7, r.note_diameter, r.same) for r in out.withColumn("same", reports.same_diameter(F.col("note_diameter"), F.col("d"))).collect()]
    assert got == [(140.0, 0.625, 0.315, 0.264, True), (178.5, None, None, 0.308, True), (None, None, None, 0.270, True), (None, None, None, 0.5, False), (None, None, None, 0.308, True)]
