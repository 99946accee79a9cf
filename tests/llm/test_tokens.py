"""Token counts and packing against the library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from curatio.llm.bpe import ByteBpe
from curatio.llm.packing import CapacityTree, pack, packed
from curatio.llm.token_counts import token_counts
from tests.llm.helpers import odd, passages

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_whole_tokens_are_proved(library):
    whole = ByteBpe(open(PATH, encoding="utf-8").read()).whole_tokens()
    assert 45_000 < len(whole) <= 50_257
    assert all(len(library.encode(t, add_special_tokens=False).ids) == 1 for t in random.Random(1).sample(sorted(whole), 500))


def test_any_code_point_counts_as_the_library_counts(library):
    bpe = ByteBpe(open(PATH, encoding="utf-8").read())
    points = [c for c in [*range(0x500), *range(0x2000, 0x2100), 0x3042, 0x4E2D, 0x1F600, 0x85, 0x1C] if not 0xD800 <= c < 0xE000]
    texts = [t for c in points for t in (f"a{chr(c)}b 1{chr(c)}2", f" {chr(c)} {chr(c)}{chr(c)}x", f"!{chr(c)}!  {chr(c)}\n")]
    texts += ["a<|endoftext|>b", "<|endoftext|><|endoftext|>", "it's  \n\n we'LL", ""]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert bpe.counts(texts) == list(map(len, want))
    assert [list(bpe.ids(t)) for t in texts] == want


def test_only_a_stretch_around_an_odd_code_point_leaves_the_shortcut(library):
    bpe = ByteBpe(open(PATH, encoding="utf-8").read())
    text = "some plain words here, " * 20 + "one \u3042\u4e2d odd" + " and plain words again, 1 2 3" * 20
    cut = bpe.stretches(text)
    assert "".join(t for _, t in cut) == text and sum(len(t) for p, t in cut if not p) < 12
    r = random.Random(5)
    signs = ["a", "B", "7", " ", "  ", "\n", "!", "'s", "\u3042", "\u0085", "\u180e", "\u200b", "\u0660", "é", "<|endoftext|>", "x "]
    texts = ["".join(r.choice(signs) for _ in range(40)) for _ in range(400)]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert bpe.counts(texts) == list(map(len, want)) and [list(bpe.ids(t)) for t in texts] == want


def test_counts_of_odd_rows(spark, library):
    got = sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(odd(spark), PATH).collect())
    want = sorted((len((r.text or "").encode()), n := len(library.encode(r.text or "", add_special_tokens=False).ids), n > 1024) for r in odd(spark).collect())
    assert got == want
    assert token_counts(odd(spark, []), PATH).collect() == []


def test_tournament_tree_takes_the_leftmost_bin():
    r = random.Random(2)
    tree, rooms = CapacityTree(50, 100), [100] * 50
    for _ in range(50):
        need = r.randint(1, 100)
        at = next(i for i, room in enumerate(rooms) if room >= need)
        rooms[at] -= need
        assert tree.place(need) == at


@pytest.mark.parametrize("seed", range(20))
def test_pieces_cover_each_document_once_and_pad_little(seed):
    r = random.Random(seed)
    sizes = [r.choice([1, 2, 1023, 1024, 1025, r.randint(1, 5000)]) for _ in range(r.randint(1, 60))]
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for d, s, n, q, at in pack(sizes):
        by_doc[d].append((s, n))
        by_sequence[q].append((at, n))
    for pieces, total in [(by_doc[d], n) for d, n in enumerate(sizes)] + [(x, sum(n for _, n in x)) for x in by_sequence.values()]:
        at = 0
        for s, n in sorted(pieces):
            assert s == at and n > 0
            at += n
        assert at == total
    lengths = [sum(n for _, n in x) for x in by_sequence.values()]
    assert max(lengths) <= 1024
    assert sum(1024 - n for n in lengths if n & (n - 1)) <= 16 * len(lengths)


def test_packed_rows_hold_the_librarys_ids(spark, library):
    docs = odd(spark, [(i, t) for i, t in passages() if i not in (5, 102)] + [(900, "y " * 5000)])
    rows = packed(docs, PATH, with_ids=True).collect()
    ids = {r.doc_id: [*library.encode(r.text or "", add_special_tokens=False).ids, 0] for r in docs.collect()}
    joined = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == len(joined[r.doc_id]) and r.length == len(r.ids) and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        joined[r.doc_id] += r.ids
    assert joined == ids
    assert packed(odd(spark, []), PATH).collect() == []


def test_sequences_do_not_depend_on_how_the_rows_lie(spark):
    rows = [*passages(), (None, "no key"), (None, "no key"), (7, "again"), (7, "again")]
    one, two = (sorted(map(str, packed(odd(spark, rows).repartition(n), PATH, group_bytes=700, part_tokens=200).collect())) for n in (1, 7))
    assert one == two and len(one) >= len(rows)
