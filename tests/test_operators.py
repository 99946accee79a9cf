"""Catalogue operators on small tables: matching scenarios, decisions, changes, unit repair, pages."""

import json

import pytest
from pyspark.sql import functions as F

from curatio.operators import export, joins, quality, rank, resolve, store, upsert
from curatio.operators.lookup import lookup, names_table
from curatio.sources import html, parsers

ENTITY = "entity_id long, e_name string, e_maker string, e_diameter double, e_weight double, e_sku string, e_product_line string, e_product_line_id long, e_g1 double, e_g7 double"
MENTION = "mention_id long, m_name string, m_maker string, m_diameter double, m_weight double, m_sku string, m_product_line string, m_product_line_id long, m_g1 double, m_g7 double"
BULLETS = [
    (1, "30 Cal .308 178 gr ELD-X®", "H", 0.308, 178.0, "3074", "ELD-X", 11, 0.552, None),
    (2, "30 Cal .308 178 gr ELD Match", "H", 0.308, 178.0, "3075", "ELD Match", 12, None, None),
    (3, "6.5mm .264 143 gr ELD-X", "H", 0.264, 143.0, "2635", "ELD-X", 11, None, None),
    (4, "30 Cal 175 gr HPBT MatchKing", "S", 0.308, 175.0, None, "MatchKing", 13, None, None),
]


def match(spark, *mentions, **kwargs):
    found = resolve.match(spark.createDataFrame(list(mentions), MENTION), spark.createDataFrame(BULLETS, ENTITY), **kwargs)
    return {r.mention_id: r for r in found.collect()}


def test_tiers_of_matching(spark):
    got = match(
        spark,
        (1, "whatever", None, None, None, "2635", None, None, None, None),
        (2, "another name", "H", 0.308, 178.0, None, "ELD-X", 11, None, None),
        (3, "another name", "H", 0.308, None, None, "ELD-X", None, None, None),
        (4, "Hollow Point Boat Tail MatchKing", None, 0.3085, 175.3, None, None, None, None, None),
        (5, "MatchKing HPBT 30 Cal", None, 0.308, 190.0, None, None, None, None, None),
        (6, "Nothing Alike", "H", 0.308, 178.0, None, None, None, None, None),
        (7, "ELD-X", "H", 0.3095, 178.0, None, None, None, None, None),
    )
    assert (got[1].entity_id, got[1].confidence, got[1].method) == (3, 1.0, "exact_sku")
    assert (got[2].entity_id, got[2].confidence, got[2].method) == (1, 0.93, "product_line_alias")
    assert (got[3].entity_id, got[3].confidence, got[3].method) == (1, 0.80, "product_line")
    assert (got[4].entity_id, got[4].method) == (4, "composite_key") and got[4].confidence >= 0.9
    assert got[5].entity_id == 4 and got[5].method == "fuzzy_name" and got[5].confidence <= 0.4
    assert 6 not in got and 7 not in got  # nothing alike; another diameter


def test_order_of_rows_does_not_matter(spark):
    m = spark.createDataFrame([(1, "MatchKing", None, 0.308, 175.0, None, None, None, None, None)], MENTION)
    twins = [(i, "30 Cal 175 gr MatchKing", "S", 0.308, 175.0, None, None, None, None, None) for i in (9, 5, 7, 6)]
    a, b = (resolve.match(m, spark.createDataFrame(rows, ENTITY)).first() for rows in (twins, twins[::-1]))
    assert a == b and a.entity_id == 5 and [x.entity_id for x in a.alternatives] == [6, 7, 9] and a.is_ambiguous


def test_bullet_links_prefer_the_makers_own_and_gate_weights(spark):
    bullets = spark.createDataFrame([*BULLETS, (5, "Match BTHP", "H", 0.308, 175.0, None, "Match", None, None, None)], ENTITY)
    mentions = spark.createDataFrame(
        [(1, "BTHP", "H", 0.308, 175.0, None, None, None, None, None), (2, "HPBT MatchKing", "F", 0.308, 175.0, None, "MatchKing", None, None, None), (3, "ELD-X", "H", 0.308, 212.0, None, "ELD-X", None, None, None), (4, "ELD-X", "H", 0.338, 143.0, None, None, None, None, None)],
        MENTION,
    )
    got = {r.mention_id: r for r in resolve.link_bullets(mentions, bullets).collect()}
    assert (got[1].bullet_id, got[1].outcome) == (5, "linked")
    assert got[2].bullet_id == 4 and got[2].confidence == pytest.approx(1.0)  # 0.95 and 0.05 for the weight
    assert got[3].bullet_id is None and got[3].outcome == "weight_mismatch"
    assert got[4].bullet_id == 3 and got[4].method.endswith("+relaxed_diameter")


def test_lookup_tiers_and_periods(spark):
    e = spark.createDataFrame([(1, ".308 Winchester", ["308 Win"], None), (2, "6.5 Creedmoor", ["6.5 CM"], None)], "id long, name string, alt_names array<string>, maker_id long")
    a = spark.createDataFrame([("caliber", 2, "Six Five"), ("caliber", 99, "gone"), ("maker", 1, "x")], "entity_type string, entity_id long, alias string")
    m = spark.createDataFrame([(1, ".308 winchester"), (2, "308 WIN"), (3, "six-five"), (4, "308 Winchester"), (5, "gone"), (6, "®")], "mention_id long, name string")
    got = {r.mention_id: (r.entity_id, r.method, r.confidence) for r in lookup(m, names_table(e, a, "caliber", caliber=True), caliber=True).collect()}
    assert got == {1: (1, "exact_name", 1.0), 2: (1, "alt_name", 0.95), 3: (2, "entity_alias", 0.90), 4: (1, "caliber_norm", 0.95), 5: (None, None, None), 6: (None, None, None)}


def test_unit_repair(spark):
    rows = spark.createDataFrame([(1, "6,5", "0.308"), (2, "178", "7.62"), (3, "2000", "0.264"), (4, None, "0.9"), (5, "n/a", "0.308")], "id int, weight_grains string, bullet_diameter_inches string")
    got = {r.id: r for r in quality.normalized(rows, quality.rules_for("bullet", ["weight_grains", "bullet_diameter_inches"])).collect()}
    assert got[1].weight_grains == pytest.approx(100.3106) and got[1].events[0].reason == "grams_to_grains" and not got[1].rejected
    assert got[2].bullet_diameter_inches == pytest.approx(0.3) and [e.reason for e in got[2].events] == ["mm_to_inches"]
    assert got[3].weight_grains is None and got[3].rejected and "weight_grains" in got[3].rejection_reason
    assert got[4].rejected and "bullet_diameter_inches" in got[4].rejection_reason  # a missing weight alone is no reason
    assert not got[5].events and not got[5].rejected


def test_every_action_is_reached(spark):
    base = dict(entity_type="bullet", matched=True, confidence=0.9, rejected=False, excluded_caliber=False, orphan_diameter=False, target_locked=False, weight=100.0, target_weight=100.0, unresolved_refs=[], bullet_id=1, old_bullet_id=1, bullet_diameter=0.308, caliber_diameter=0.308)
    cases = {
        "rejected_normalization": {"rejected": True},
        "rejected_caliber": {"excluded_caliber": True},
        "rejected_orphan_diameter": {"orphan_diameter": True},
        "skipped_locked": {"target_locked": True},
        "matched_existing": {},
        "matched_updated": {"entity_type": "cartridge", "old_bullet_id": 2},
        "blocked_cross_diameter": {"entity_type": "cartridge", "old_bullet_id": 2, "bullet_diameter": 0.338},
        "created_variant": {"confidence": 0.4, "target_weight": 101.5},
        "flagged_low_confidence": {"confidence": 0.4},
        "flagged_unresolved": {"matched": False, "entity_type": "cartridge", "bullet_id": None},
        "created": {"matched": False},
    }
    schema = "entity_type string, matched boolean, confidence double, rejected boolean, excluded_caliber boolean, orphan_diameter boolean, target_locked boolean, weight double, target_weight double, unresolved_refs array<string>, bullet_id long, old_bullet_id long, bullet_diameter double, caliber_diameter double"
    rows = spark.createDataFrame([tuple((base | c).values()) for c in cases.values()], schema)
    assert [r.action for r in store.decided(rows).collect()] == list(cases)


def test_changes_are_idempotent(spark):
    rows = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], "id int, name string, v double")
    ops = spark.createDataFrame([(4, "create", "d", 4.0), (1, "create", "x", 9.0), (2, "update", None, 5.0), (3, "delete", None, None), (9, "update", "y", None), (8, "delete", None, None)], "id int, op string, name string, v double")
    first = upsert.classified(rows, ops, ["id"], ["name", "v"])
    assert {(r.id, r.outcome) for r in first.collect()} == {(4, "CREATE"), (1, "SKIP"), (2, "UPDATE"), (3, "DELETE"), (9, "ERROR"), (8, "SKIP")}
    once = upsert.applied(rows, first, ["id"], ["name", "v"])
    assert sorted(map(tuple, once.collect())) == [(1, "a", 1.0), (2, "b", 5.0), (4, "d", 4.0)]
    again = upsert.classified(once, ops, ["id"], ["name", "v"])
    assert {r.outcome for r in again.collect()} == {"SKIP", "ERROR"}
    blocked = upsert.classified(rows, ops, ["id"], ["name", "v"], rows.where("id = 3"))
    assert [r.outcome for r in blocked.collect() if r.id == 3] == ["ERROR"]


def test_band_join_loses_no_pair(spark):
    a = spark.range(300).select(F.col("id"), (F.col("id") * 0.0007).alias("x"))
    b = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 0.0011).alias("y"))
    for inclusive in (True, False):
        got = joins.band_join(a, b, ("x", "y"), 0.001, inclusive=inclusive).count()
        near = (lambda g: g <= 0.001) if inclusive else (lambda g: g < 0.001)
        assert got == sum(near(abs(i * 0.0007 - k * 0.0011)) for i in range(300) for k in range(300))
    plan = joins.band_join(a, b, ("x", "y"), 0.001)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_worklist_order_and_limit(spark):
    rows = spark.createDataFrame([(0, 3), (1, None), (2, 1), (3, 1), (4, 2)], "pos int, priority int")
    assert [r.pos for r in rank.worklist(rows, "priority", "pos").collect()] == [2, 3, 4, 0, 1]
    assert [r.pos for r in rank.worklist(rows, "priority", "pos", 2, 2).collect()] == [2, 3]


def test_published_rows(spark):
    b = spark.createDataFrame([(1, 150.0, 0.4, None, None, None), (2, 150.0, None, None, None, None)], "id long, weight double, g1 double, g7 double, g1_est double, g7_est double")
    c = spark.createDataFrame([(1, 1, 150.5, 2700.0, None, None), (2, 1, 152.0, 2700.0, None, None), (3, 2, 150.0, 2700.0, 0.0, None), (4, 2, 150.0, 2700.0, 0.3, None), (5, 1, 150.0, 0.0, None, None), (6, None, 150.0, 2700.0, 0.3, None)], "id long, bullet_id long, bullet_weight double, velocity double, g1 double, g7 double")
    assert sorted(r.id for r in export.exported_cartridges(c, b).collect()) == [1, 4, 6]


# ---- pages

PAGE = (
    '<html><head><style>a{}</style><script type="application/ld+json">{"a": 1}</script><script>var x=1;</script></head><body><nav>menu</nav><div class="my-social-box">share</div><div class="antisocial">stays</div>'
    '<img alt="a cat"><img><!-- note --><aside>more</aside><form>f</form><p class="x" title="t">hello <span>world</span></p><div></div></body></html>'
)


def test_reduction_step_by_step():
    out, meta = html.reduce_html(PAGE, None, 0)
    assert meta["steps_applied"] == 14 and not meta["under_target"] and meta["strategy_used"] == "generic"
    assert all(s["before"] - s["after"] == s["removed"] for s in meta["steps"])
    for gone in ("menu", "share", "note", "more", "<form", "<span", "class=", "var x"):
        assert gone not in out
    for kept in ("stays", "[image: a cat]", "hello world"):
        assert kept in out
    assert html.reduce_html(PAGE, None, 10**6)[1]["steps_applied"] == 1


def test_reduction_by_host():
    data = '<script type="application/ld+json">{"@type":  "Product"}</script>'
    page = f'<html><head><title>T</title><meta property="og:x" content="c">{data}</head><body><main>{"text " * 2000}</main><div>other</div></body></html>'
    out, meta = html.reduce_html(page, "www.nosler.com", 30_000)
    assert meta["strategy_used"] == "main_content" and "other" not in out and "text" in out
    assert html.reduce_html("<main>short</main>", "www.nosler.com")[1]["strategy_used"] == "main_content_fallback"
    out, meta = html.reduce_html(page, "www.norma-ammunition.com")
    assert meta["strategy_used"] == "jsonld_only" and '<!-- DATA: {"@type":"Product"} -->' in out and "og:x: c" in out
    assert html.reduce_html("<p>x</p>", "www.norma-ammunition.com")[1]["strategy_used"] == "jsonld_only_fallback"


def test_parsers_read_their_pages_and_decline_others(spark):
    inline = 'x {"id":12,"title":"30 Cal .308 178 gr ELD-X®","weight":178,"ball_coef":0.552,"ball_coef_type":1,"ball_coef_2":0.278,"ball_coef_type_2":"(G7)","sku":"3074","linktitle":"<a href=x>ELD-X® </a>"}'
    array = '<script type="application/ld+json">{"@type":"Product","name":"168 gr HPBT"}</script>' + "".join(f'{{\\"id\\":\\"1\\",\\"name\\":\\"{k}\\",\\"value\\":\\"{v}\\"}}' for k, v in (("Bullet Diameter", "0.308"), ("Bullet Weight", "168"), ("G1 BC", "0.462"), ("Item #", "2200C"), ("Bullet Type", "Hollow Point Boat Tail"), ("Purpose", "Match/Target")))
    spec = "<table>" + "".join(f"<tr><th>{k}</th><td>{v}</td></tr>" for k, v in (("Product Name", "AccuBond 150gr"), ("Manufacturer SKU", "56719"), ("Cartridge", "308 Win"), ("Bullet Weight", "150gr"), ("Bullet Type", "AccuBond"))) + "</table><table><th>VELOCITY (FPS)</th><tr><td>Muzzle</td></tr><tr><td>2,850</td><td>2600</td></tr>ENERGY<tr><td>9999</td></tr></table>"
    rows = [(1, "https://www.hornady.com/a", inline, "bullet"), (2, "https://sierrabullets.com/b", array, "bullet"), (3, "https://www.nosler.com/c", spec, "cartridge"), (4, "https://www.hornady.com/d", '{"id":42,"x":1}', "bullet"), (5, "https://www.nosler.com/e", "<p>no table</p>", "bullet"), (6, "https://elsewhere.com/f", inline, "bullet"), (7, "https://sierrabullets.com/g", None, "bullet")]
    got = {r.page_id: r for r in parsers.parsed_pages(spark.createDataFrame(rows, "page_id int, url string, html string, kind string"), "kind").collect()}
    assert [got[k].status for k in sorted(got)] == ["parsed"] * 3 + ["declined"] * 2 + ["no_parser", "declined"]
    v = lambda k: {f: x["value"] for f, x in json.loads(got[k].entity).items()}
    assert (v(1)["bullet_diameter_inches"], v(1)["bc_g7"], v(1)["product_line"]) == (0.308, 0.278, "ELD-X") and len(got[1].bc_sources) == 2
    assert (v(2)["sku"], v(2)["base_type"], v(2)["tip_type"], v(2)["type_tags"]) == ("2200", "boat_tail", "hollow_point", ["match", "target"])
    assert (v(3)["caliber"], v(3)["muzzle_velocity_fps"], v(3)["bullet_weight_grains"]) == ("308 Win", 2850, 150.0)


def test_cartridge_candidates_by_what_is_known(spark):
    mentions = spark.createDataFrame([(1, "a", 5, None), (2, "a", None, None), (3, None, 5, "x"), (4, None, None, None)], "mention_id long, m_maker string, m_caliber long, m_sku string")
    cartridges = spark.createDataFrame([(10, "a", 5, "x"), (11, "a", 6, None), (12, "b", 5, "y"), (13, None, None, None)], "entity_id long, e_maker string, e_caliber long, e_sku string")
    got = sorted((r.mention_id, r.entity_id) for r in resolve.cartridge_pairs(mentions, cartridges).collect())
    assert got == [(1, 10), (2, 10), (2, 11), (3, 10), (4, 10), (4, 11), (4, 12), (4, 13)]


def test_the_retry_without_a_diameter_meets_only_its_weight_band_and_line(spark):
    columns = "m_maker string, m_diameter double, m_weight double, m_product_line string, m_product_line_id long, m_name string"
    mentions = spark.createDataFrame([(1, None, None, 150.0, "Pro Hunter", None, "pro hunter 150"), (2, None, None, 99.5, None, 7, "other")], f"mention_id long, {columns}")
    entities = spark.createDataFrame([(10, 150.8, None, None), (11, 180.0, "pro hunter", None), (12, 200.0, "else", None), (13, 55.0, None, 7)], "entity_id long, e_weight double, e_product_line string, e_product_line_id long")
    pairs = resolve.relaxed_candidates(mentions, entities)
    assert sorted((r.mention_id, r.entity_id) for r in pairs.collect()) == [(1, 10), (1, 11), (2, 13)]
    assert "NestedLoop" not in pairs._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    ("purpose", "pursuit", "want"),
    [
        ("Match/Target", "", (["match", "target"], ["competition", "precision"])),
        ("Hunting", "Big Game and Varmint", (["hunting"], ["hunting_deer", "hunting_elk"])),
        ("Hunting", "Varmint", (["hunting", "varmint"], ["hunting_varmint"])),
        ("Hunting, Self Defense", "", (["hunting", "tactical"], ["hunting_deer", "self_defense"])),
        ("", "Varmint", ([], [])),
    ],
)
def test_purposes(purpose, pursuit, want):
    from curatio.sources.parsers import purposes

    assert purposes(purpose, pursuit) == want
