"""The corpus pipeline and the registered queries on small written tables, against plain versions."""

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from curatio.llm.catalog import ORACLES, QUERIES
from tests.llm.test_mixing import filled
from tests.llm.test_texts import near_copies, plain_classes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
MAIL = "write to jane.doe@corp.example today"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


def corpus():
    """Clean texts, near copies, toxic ones, one with an address, nulls, empties, a repeated row and a very long text."""
    r = np.random.default_rng(6)
    words = [f"word{i}" for i in range(300)]
    some = lambda n: " ".join(words[k] for k in r.integers(0, 300, n))
    rows = [(i, some(60), "abc"[i % 3]) for i in range(200)]
    rows += [(300 + i, f"{some(30)} grumble{i % 9} grumble{i % 7} {some(30)}", "a") for i in range(60)]
    rows += [(400 + i, t, "b") for i, t in near_copies(4, 3)]
    return [*rows, (500, f"{some(30)} {MAIL}\n\n{some(8)}", "c"), (501, None, "a"), (502, "", None), (3, rows[3][1], "a"), (503, some(20_000), "c"), (None, some(50), None)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = corpus()
    table(spark, rows).coalesce(2).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int("grumble" in (t or ""))) for i, t, _ in rows if i is not None and i < 400]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{path}/labels.parquet")
    x = np.random.default_rng(1).normal(size=(30, 4))
    vectors = [(i, [float(v) for v in x[i % 20] + 0.01 * (i > 20)], i % 3) for i in range(30)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int").coalesce(1).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def test_one_row_of_each_class_stays(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(40)) for c in "abc")
    rows = [(1, one), (1, one), (2, one), (2, two), (3, two), (None, three), (None, three), (None, two), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted([(1, one), (2, two), (None, three), (None, None)], key=str)


def test_every_stage_does_its_work_on_what_came_before(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.scratch(stage(spark, docs, folder), name)
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    rows = corpus()
    clean = [(i, t) for i, t, _ in rows if "grumble" not in (t or "")]
    assert sorted(((r.doc_id, r.text) for r in kept["toxicity"]), key=str) == sorted(clean, key=str)
    classes = plain_classes([(k, t) for k, (_, t) in enumerate(clean)])
    assert len(kept["near_dedup"]) == len(set(classes.values()))
    before = {(r.doc_id, r.text) for r in kept["near_dedup"]}
    after = Counter(r.doc_id for r in kept["pii"])
    assert after == Counter(i for i, _ in before)
    assert {r.doc_id for r in kept["pii"] if (r.doc_id, r.text) not in before} == {500}
    assert all("jane.doe" not in (r.text or "") and r.n_chars == (None if r.text is None else len(r.text)) for r in kept["pii"])
    sizes, taken = defaultdict(int), defaultdict(int)
    for total, name in ((sizes, "pii"), (taken, "mixing")):
        for r in kept[name]:
            total[r.source] += len((r.text or "").split())
    assert dict(taken) == pytest.approx({s: t for s, t in filled(sizes).items() if t}, abs=2)
    # the sequences hold the mixed texts' ids, each once
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((r.doc_id, x) for r in kept["mixing"] for x in [*library.encode(r.text, add_special_tokens=False).ids, 0])
    assert Counter((r.doc_id, x) for r in kept["packing"] for x in r.ids) == want
    filled_up = defaultdict(int)
    for r in sorted(kept["packing"], key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled_up[r.sequence_id] and len(r.ids) == r.length
        filled_up[r.sequence_id] += r.length
    assert max(filled_up.values()) <= 1024


def test_stages_take_empty_tables(spark, folder):
    empty = table(spark, [])
    assert [stage(spark, empty, folder).collect() for _, stage in corpus_pipeline.STAGES] == [[]] * 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_queries_keep_their_contract(spark, folder, name):
    got = QUERIES[name](spark, folder)
    rows = got.collect()
    assert len(rows) >= (30 if name == "op8_vectors" else len(corpus()))
    if name in ORACLES:
        duckdb = pytest.importorskip("duckdb")
        with duckdb.connect() as c:
            for t in ("documents", "embeddings"):
                c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
            if name == "op8_vectors":
                want = c.execute(ORACLES[name])
                columns = [d[0] for d in want.description]
                assert sorted(map(str, (tuple(r[x] for x in columns) for r in rows))) == sorted(map(str, want.fetchall()))
    kinds = dict(got.dtypes)
    contract = {
        "op1_language_model": {"held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
        "op2_mixing": {"size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
        "op3_token_counts": {"n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
        "op5_packing": {"start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
        "op7_repeats": {"n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
        "op8_vectors": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
        "op9_fingerprints": {"n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
        "op10_toxicity": {"held_out": "boolean", "score": "double", "predicted": "int"},
    }
    assert {k: kinds[k] for k in contract.get(name, {})} == contract.get(name, {})
