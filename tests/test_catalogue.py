"""Upkeep of the catalogue on small tables: export rules, patches, product lines, seeds, crosschecks, documents in folders."""

import json

import pytest
from pyspark.sql import functions as F

from curatio.operators import catalogue, export, patching, reports
from curatio.operators.lookup import names_table
from curatio.sources import documents

BULLET = "id long, name string, manufacturer_id long, alt_names array<string>, product_line string, product_line_id long, weight_grains double, bullet_diameter_inches double, bc_g1_published double, bc_g7_published double, bc_g1_estimated double, bc_g7_estimated double, is_locked boolean"
CARTRIDGE = "id long, name string, manufacturer_id long, bullet_id long, bullet_weight_grains double, muzzle_velocity_fps double, bc_g1 double, bc_g7 double, product_line string, updated_at string"


def tables(spark, bullets, cartridges):
    return {
        "manufacturer": spark.createDataFrame([(1, "Federal", "t"), (2, "Sierra", "t")], "id long, name string, created_at string"),
        "bullet": spark.createDataFrame(bullets, BULLET),
        "cartridge": spark.createDataFrame(cartridges, CARTRIDGE),
        "entity_alias": spark.createDataFrame([("bullet_product_line", 7, "TMK"), ("bullet_product_line", 7, "smk"), ("bullet", 1, "x"), (None, 1, "y")], "entity_type string, entity_id long, alias string"),
        "bullet_bc_source": spark.createDataFrame([(1,)], "id long"),
    }


def test_export_rules(spark):
    bullet = lambda i, w=150.0, d=0.308, g=0.4, line=None, maker=2: (i, "Plain Name", maker, ["SMK"], "MatchKing", line, w, d, g, None, None, None, True)
    cartridge = lambda i, b, w=150.0, v=2700.0, g=None, name="a", maker=2: (i, name, maker, b, w, v, g, None, None, "t")
    rows = [cartridge(1, 1), cartridge(2, 1, v=0.0), cartridge(3, 1, v=None), cartridge(4, 1, w=151.5), cartridge(5, None), cartridge(6, 2), cartridge(7, 2, g=0.3), cartridge(8, 3), cartridge(9, 1, name="Federal power-shok copper 150", maker=1), cartridge(10, 1, name="Power-Shok Copper", maker=2), cartridge(11, None, w=None, v=None), cartridge(12, 1, maker=None)]
    out = export.export_run(tables(spark, [bullet(1, line=7), bullet(2, g=None), bullet(3, d=0.223, g=None), bullet(4, maker=9)], rows))
    # without a bullet, or with one that is not published, nothing is asked of a coefficient
    assert sorted(r.id for r in out["cartridge"].collect()) == [1, 3, 5, 7, 8, 10, 11, 12]
    got = {r.id: r for r in out["bullet"].collect()}
    assert sorted(got) == [1, 2, 4] and got[1].alt_names == ["SMK", "TMK"] and got[2].alt_names == ["SMK"]
    assert got[4].display_name is None and got[1].display_name
    assert sorted((r.entity_type or "", r.alias) for r in out["entity_alias"].collect()) == [("", "y"), ("bullet", "x")]
    assert sorted(out) == ["bullet", "cartridge", "entity_alias", "manufacturer"] and out["manufacturer"].columns == ["id", "name"]
    assert "is_locked" not in out["bullet"].columns and "product_line_id" not in out["bullet"].columns and "updated_at" not in out["cartridge"].columns
    assert {k: v.count() for k, v in export.laid_out(out).items()} == {k: v.count() for k, v in out.items()}
    empty = export.export_run({k: v.limit(0) for k, v in tables(spark, [bullet(1)], rows).items()})
    assert all(v.count() == 0 for v in empty.values())


def outcomes(frame):
    return {r.position: r.outcome for r in frame.collect()}


def test_patch_creations_and_changes(spark):
    have = spark.createDataFrame([(1, 1, "ELD-X", "S1", 0.5, False, None), (2, 2, "eld-x", None, 0.6, False, None)], "id long, manufacturer_id long, name string, sku string, bc double, is_locked boolean, data_source string")
    ops = spark.createDataFrame([(1, 2, "New", "s1"), (2, 1, "eld-X", None), (3, 1, "Other", "S9"), (4, 1, "Another", "s9"), (5, 1, "OTHER", None), (6, None, "z", None), (7, 2, "Other", None)], "position long, manufacturer_id long, name string, sku string")
    made = patching.created(ops, have, code="sku")
    assert outcomes(made) == {1: "SKIP", 2: "SKIP", 3: "CREATE", 4: "SKIP", 5: "SKIP", 6: "ERROR", 7: "CREATE"}
    after = patching.applied(have, made, [], F.xxhash64("manufacturer_id", F.lower("name")))
    new = after.where("id not in (1, 2)").collect()
    assert sorted((r.manufacturer_id, r["name"], r.sku, r.is_locked, r.data_source) for r in new) == [(1, "Other", "S9", True, "manual"), (2, "Other", None, True, "manual")]
    assert set(outcomes(patching.created(ops, after, code="sku")).values()) == {"SKIP", "ERROR"}  # applied again: nothing more

    change = spark.createDataFrame([(1, 1, "ELD-x", 0.7, None), (2, 1, "eld-x", 0.8, None), (3, 2, "ELD-X", 0.6, None), (4, 3, "ELD-X", 0.6, None), (5, 1, "ELD-X", None, "S2")], "position long, manufacturer_id long, name string, bc double, sku string")
    told = patching.updated(change, have, ["bc", "sku"])
    assert outcomes(told) == {1: "UPDATE", 2: "UPDATE", 3: "SKIP", 4: "ERROR", 5: "UPDATE"}
    row = patching.applied(have, told, ["bc", "sku"]).where("id = 1").first()
    assert (row.bc, row.sku, row.name) == (0.8, "S2", "ELD-X")

    gone = spark.createDataFrame([(1, 1, None, None), (2, None, 2, "ELD-X"), (3, 9, None, None), (4, None, 3, "x")], "position long, id long, manufacturer_id long, name string")
    held = spark.createDataFrame([(1,), (1,)], "id long")
    told = patching.deleted(gone, have, held)
    assert outcomes(told) == {1: "ERROR", 2: "DELETE", 3: "SKIP", 4: "SKIP"}
    assert [r.id for r in patching.applied(have, told, []).collect()] == [1]


def test_patch_links_and_additions(spark):
    have = spark.createDataFrame([(1, 1, "a", 5, 0.6, "fuzzy_name"), (2, 1, "b", None, None, None)], "id long, manufacturer_id long, name string, bullet_id long, bullet_match_confidence double, bullet_match_method string")
    ops = spark.createDataFrame([(1, 1, "A", "x", 5), (2, 1, "b", "x", 6), (3, 1, "b", "unknown", None), (4, 1, "c", "x", 5), (5, 1, "a", None, None)], "position long, manufacturer_id long, name string, bullet string, bullet_id long")
    told = patching.relinked(ops, have)
    assert outcomes(told) == {1: "SKIP", 2: "UPDATE", 3: "ERROR", 4: "ERROR", 5: "SKIP"}
    rows = {r.id: r for r in patching.applied(have, told, ["bullet_id", "bullet_match_confidence", "bullet_match_method"]).collect()}
    assert (rows[1].bullet_id, rows[1].bullet_match_method) == (5, "fuzzy_name") and (rows[2].bullet_id, rows[2].bullet_match_confidence, rows[2].bullet_match_method) == (6, 1.0, "manual")

    known = spark.createDataFrame([(1, "g1", 0.5, None)], "id long, kind string, value double, source string")
    ops = spark.createDataFrame([(1, 1, "g1", 0.5, None), (2, 1, "g1", 0.6, "s"), (3, 1, "g1", 0.6, "s"), (4, None, "g1", 0.6, "s")], "position long, id long, kind string, value double, source string")
    assert outcomes(patching.added(ops, known, ["id", "kind", "value", "source"])) == {1: "SKIP", 2: "CREATE", 3: "SKIP", 4: "ERROR"}

    makers = spark.createDataFrame([(1, "Sierra Bullets", ["Sierra"], None)], "id long, name string, alt_names array<string>, maker_id long")
    said = spark.createDataFrame([(1, "SIERRA®"), (2, "nobody"), (3, None)], "position long, manufacturer string")
    got = patching.with_ids(said, names_table(makers, None, "manufacturer"), "manufacturer", "manufacturer_id")
    assert {r.position: r.manufacturer_id for r in got.collect()} == {1: 1, 2: None, 3: None}


def test_product_lines(spark):
    bullets = spark.createDataFrame([(1, 1, "ELD-X®", None), (2, 1, "eld x", None), (3, 1, "MatchKing", None), (4, 2, "MatchKing", None), (5, 1, None, None), (6, None, "Odd", None), (7, 1, "other", 99)], "id long, maker_id long, product_line string, product_line_id long")
    lines = spark.createDataFrame([(50, 1, "MATCHKING", "mk")], "id long, maker_id long, name string, slug string")
    every = catalogue.seeded_lines(bullets, lines)
    assert sorted((r.maker_id or 0, r.slug, r.name) for r in every.collect()) == [(0, "odd", "Odd"), (1, "eld-x", "ELD-X®"), (1, "mk", "MATCHKING"), (1, "other", "other"), (2, "matchking", "MatchKing")]
    got = {r.id: r.product_line_id for r in catalogue.with_line_ids(bullets, every).collect()}
    assert len(got) == 7 and got[1] == got[2] and got[3] == 50 and got[4] not in (None, 50) and got[5] is None and got[6] is not None and got[7] == 99
    assert catalogue.seeded_lines(bullets, every).count() == every.count()


def test_backfill_failures(spark):
    rows = spark.createDataFrame([(i, "n", "m", None) for i in range(7)], "id long, name string, maker string, is_locked boolean").coalesce(1)

    def short(chunk):
        if any(r["id"] == 6 for r in chunk):
            raise ValueError("no JSON")
        return [{"product_line": "A"}] * (len(chunk) - (chunk[0]["id"] == 3))

    got = {r.id: r.outcome for r in catalogue.backfilled(rows, short, 3).collect()}
    assert got == {0: "updated", 1: "updated", 2: "updated", 3: "failed", 4: "failed", 5: "failed", 6: "failed"}
    odd = {r.id: r.outcome for r in catalogue.backfilled(rows, lambda c: ["text", {"id": 9}, {"id": 9, "product_line": "x"}, {"product_line": None}, {"id": "4", "product_line": " b "}, {"product_line": 5}, {}], 50).collect()}
    assert odd == {0: "malformed", 1: "id_mismatch", 2: "id_mismatch", 3: "generic", 4: "updated", 5: "updated", 6: "malformed"}


def test_unseen_excluded_and_seed(spark):
    known = spark.createDataFrame([(1, "g1", 0.5)], "id long, kind string, value double")
    new = spark.createDataFrame([(1, "g1", 0.5 + 9e-10), (1, "g1", 0.5 + 2e-9), (1, "g7", 0.5), (2, "g1", 0.5), (2, "g1", 0.5), (3, "g1", None)], "id long, kind string, value double")
    got = sorted((r.id, r.kind) for r in catalogue.unseen_sources(new, known, ["id", "kind"], "value").collect())
    assert got == [(1, "g1"), (1, "g7"), (2, "g1"), (3, "g1")]
    names = spark.createDataFrame([("9mm luger",)], "name string")
    rows = spark.createDataFrame([(1, ["caliber:  9mm Luger "]), (2, ["manufacturer: 9mm luger"]), (3, []), (4, None)], "id long, unresolved_refs array<string>")
    assert {r.id: r.excluded_caliber for r in catalogue.with_excluded(rows, names, "id").collect()} == {1: True, 2: False, 3: False, 4: False}
    t = spark.createDataFrame([("a'b", True, None, 0.5)], "id string, flag boolean, parent_caliber_id string, x double")
    one = [r.statement for r in catalogue.seed_statements({"caliber": t}).collect()]
    assert one == ["INSERT OR IGNORE INTO caliber (id, flag, parent_caliber_id, x) VALUES ('a''b', 1, NULL, 0.5);"]
    with pytest.raises(ValueError):
        catalogue.seed_statements({"nobody": t})


def test_crosscheck_odd_rows(spark):
    entry = "url string, entity_type string, expected_manufacturer string, expected_caliber string, brief_description string, notes string"
    entries = spark.createDataFrame([("u1", "bullet", None, None, None, None), ("u2", "cartridge", "", "", None, None), ("u3", "bullet", "X", "y", "1 gr", "G7 0.200"), ("u4", "bullet", "Acme", None, "0 gr", "150 gr G7 0.200")], entry)
    bullets = spark.createDataFrame([("u1", "Acme", 1.0, 0.3, None, None), ("u4", None, 149.5, 0.0, None, 0.215)], "url string, maker string, weight double, diameter double, g1 double, g7 double")
    cartridges = spark.createDataFrame([("u2", "Acme", "6.5 PRC", None)], "url string, maker string, caliber string, velocity double")
    got = [(r.url, r.finding) for r in reports.crosscheck(entries, bullets, cartridges).collect()]
    assert got == [("u4", "BC_MISMATCH")]


def test_folders_of_documents(spark, tmp_path):
    for stem, text in (("b", '{"url": "u", "n": 1}'), ("a", '{"url": "v",\n "n": 2}'), ("c", "{not json")):
        (tmp_path / f"{stem}.json").write_text(text)
    (tmp_path / "a.html").write_text("<p>\n x</p>")
    good, bad = documents.read_folder(spark, str(tmp_path), "url string, n long")
    assert [(r.stem, r.url, r.n) for r in good.orderBy("stem").collect()] == [("a", "v", 2), ("b", "u", 1)]
    assert [r.stem for r in bad.collect()] == ["c"]
    pages = documents.with_html(spark.createDataFrame([("a",), ("z",)], "url_hash string"), str(tmp_path))
    assert {r.url_hash: r.html for r in pages.collect()} == {"a": "<p>\n x</p>", "z": None}
    (tmp_path / "list").mkdir()
    (tmp_path / "list" / "x.json").write_text(json.dumps({"calibers": [" 9mm Luger", "9MM LUGER"]}))
    assert [r.name for r in catalogue.rejected_calibers(spark, str(tmp_path / "list")).collect()] == ["9mm luger"]


def test_markdown(spark):
    rows = spark.createDataFrame([("a|b", 1.0, None), ("c\nd", 2.5, True)], "x string, y double, z boolean")
    assert documents.markdown(rows.orderBy("x"), "Title", 1) == "## Title\n\n| x | y | z |\n|-|-|-|\n| a\\|b | 1.0 |  |\n\n(first 1 rows)\n"
    assert documents.markdown(rows.limit(0), "Title", 5) == "## Title\n\nNo rows.\n"
