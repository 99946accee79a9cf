"""Work lists, patches, the extractor's seam and publishing."""

import json

import pytest
from pyspark.sql import functions as F

from curatio.sources import extractor, manifest, patches, publish


def test_manifest_faults_and_first_listed(spark, tmp_path):
    a = [{"url": "https://x.com/1", "entity_type": "bullet", "expected_manufacturer": "H", "priority": 1, "expected_caliber": ".308"}, {"url": "x.com/2", "entity_type": "boat"}, {"url": "https://x.com/1", "entity_type": "rifle", "expected_manufacturer": "S", "priority": "soon"}]
    (tmp_path / "a.json").write_text(json.dumps(a))
    (tmp_path / "b.json").write_text(json.dumps([{"url": "https://x.com/1", "entity_type": "cartridge", "expected_manufacturer": "B"}, {"url": "https://x.com/9", "entity_type": "bullet", "expected_manufacturer": "B"}]))
    entries = manifest.read_manifest(spark, str(tmp_path / "a.json"), str(tmp_path / "b.json"))
    got = {(r.level, r.problem) for r in manifest.problems(entries).collect()}
    assert {("error", "invalid url"), ("error", "invalid entity_type"), ("error", "missing expected_manufacturer"), ("error", "duplicate url"), ("warning", "priority is no integer"), ("warning", "missing priority")} <= got
    assert {r.url: r.expected_manufacturer for r in manifest.first_listed(entries).collect()} == {"https://x.com/1": "H", "x.com/2": None, "https://x.com/9": "B"}


def test_pending_by_version(spark):
    entries = spark.createDataFrame([("u1", "bullet"), ("u2", "bullet"), ("u3", "rifle")], "url string, entity_type string")
    cache = entries.select(F.left(F.sha2("url", 256), F.lit(16)).alias("url_hash"), "entity_type", F.lit(1).alias("entity_count"), F.when(F.col("url") == "u2", 1).otherwise(2).alias("schema_version"))
    assert sorted(r.url for r in manifest.pending(entries, cache, {"bullet": 2, "rifle": 2}).collect()) == ["u2"]


def test_answers_are_classified(spark):
    rows = [("succeeded", None, 'x ```json\n[{"a":1}]\n``` y'), ("succeeded", None, '{"a": 2}'), ("succeeded", None, "sorry"), ("succeeded", "max_tokens", "[1"), ("errored", None, ""), ("expired", None, "")]
    got = [r.outcome for r in extractor.classified(spark.createDataFrame(rows, "status string, stop_reason string, text string")).collect()]
    assert got == ["parsed", "parsed", "unparseable", "errored", "errored", "expired"]


def test_retries_and_the_circuit_breaker(spark):
    calls, waits = [], []

    def flaky(prompt):
        calls.append(prompt)
        if len(calls) < 3:
            raise extractor.Transient("busy")
        return "done"

    assert extractor.with_retries(flaky, "p", sleep=waits.append) == ("succeeded", "done")
    assert len(waits) == 2 and 2 <= waits[0] <= 3 and 4 <= waits[1] <= 5

    def broken(prompt):
        raise ValueError("bad request")

    got = extractor.extracted(spark.range(6).coalesce(1).select(F.col("id").alias("page_id"), F.lit("p").alias("prompt")), broken).collect()
    assert [r.status for r in sorted(got)] == ["failed"] * 3 + ["skipped"] * 3


def test_patches_are_checked_whole_and_ordered(spark, tmp_path):
    head = "patch: {id: %s, author: me, date: 2025-01-02, description: d}\n"
    (tmp_path / "010_b.yaml").write_text(head % "010_b" + "operations: [{action: create_bullet, name: B}, {action: create_manufacturer, name: M}]")
    (tmp_path / "002_a.yaml").write_text(head % "002_a" + "operations: [{action: create_caliber, name: C}, {action: create_manufacturer, name: N}]")
    rows = patches.operations(spark, str(tmp_path)).collect()
    assert [(r.patch_id, r.position) for r in rows] == [("002_a", 0), ("002_a", 1), ("010_b", 0), ("010_b", 1)]
    runs = []
    patches.in_order(rows, lambda run: runs.append([r.action for r in run]))
    assert runs == [["create_caliber", "create_manufacturer"], ["create_bullet"], ["create_manufacturer"]]
    (tmp_path / "011_c.yaml").write_text(head % "011_c" + "operations: [{action: explode}]")
    with pytest.raises(patches.InvalidPatch):
        patches.operations(spark, str(tmp_path))


def test_publishing_stops_where_keys_would_go(spark, tmp_path):
    root, rows = str(tmp_path / "out"), spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert publish.publish(spark, {"t": (rows, ["id"])}, root)["version"] == 1
    first = publish.publish(spark, {"t": (rows, ["id"])}, root, commit=True)
    again = publish.publish(spark, {"t": (rows.repartition(2), ["id"])}, root, commit=True)
    assert again["version"] == 2 and again["tables"] == first["tables"]
    assert publish.publish(spark, {"t": (rows.where("id = 1"), ["id"])}, root, commit=True)["removed_keys"] == ["t"]
