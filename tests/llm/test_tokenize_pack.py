"""Tokenizer and containers: against the public library, exact round trips, and bounds."""

import base64
import random
from pathlib import Path

import numpy as np
import pytest

from lexframe.llm import containers as C
from lexframe.llm import tokenize as K

FOLDER = Path(K.FOLDER)
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no vocabulary files")
ODD = ["", "  ", " a", "a \n\n b \n", "don't I'll we've'd x'sx 'll' ''s 's's \t'tis", "1'2's", "<|endoftext|>", " 　x", "'re're'ree", "😀😀 '😀", "x½² é é", "it'S\x00\x1c"]


def texts(n=3000):
    rnd = random.Random(3)
    return ODD + ["".join(rnd.choice(" \n\t'sdmtlverea1½é́ñ 　!?x\x85") for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_ids_equal_the_public_library():
    tokenizers = pytest.importorskip("tokenizers")
    other = tokenizers.Tokenizer.from_file(str(FOLDER / "byte_bpe_50k.json"))
    other.encode_special_tokens = True
    own, rows = K.tokenizer("byte_bpe_50k"), texts()
    ids, ends, at = own.encode(rows)
    got = [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]
    assert got == [e.ids for e in other.encode_batch(rows, add_special_tokens=False)]
    assert own.counts(rows).tolist() == [len(x) for x in got]
    assert [own.decode(x) for x in got] == rows
    assert all(0 <= p < max(1, len(rows[i])) for i in range(len(rows)) for p in at[ends[i] : ends[i + 1]])


def test_own_merging_equals_the_library():
    own = K.tokenizer("byte_bpe_50k")
    rnd = random.Random(8)
    for word in (" xin", "chào", "Điều", "ộ", "aaaaaaaaaaaaaaaa", "\ud800x", "ab" * 50_000, *("".join(rnd.choice("aăâeêintghươ ") for _ in range(rnd.randint(1, 40))) for _ in range(500))):
        assert own._merge(word.encode("utf-8", "replace")) == list(own.merge(word.encode("utf-8", "replace")))


def test_table_begins_anew_when_full(tmp_path):
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"abab": 257}
    (tmp_path / "tiny.tiktoken").write_text("\n".join(f"{base64.b64encode(k).decode()} {v}" for k, v in ranks.items()))
    own = K.Tokenizer(str(tmp_path / "tiny.tiktoken"))
    expected = own.encode(["ababab x", "ab"])[0].tolist()
    for i in range(K.KEPT + 2):
        own.known.setdefault(f"#{i}", 0)
    assert own.encode(["ababab x", "ab"])[0].tolist() == expected and len(own.known) < 10


def test_documents(spark):
    df = spark.createDataFrame([(1, "xin chào", "x"), (2, None, "y"), (3, "", None), (1, "xin chào", "x"), (4, "ộ" * 300_000, "z")], "doc_id bigint, text string, ids string")
    got = [(r.doc_id, len(r.ids)) for r in K.encode_documents(df).collect()]
    assert sorted(got)[:2] == [(1, got[0][1])] * 2 and dict(got)[2] == dict(got)[3] == 0 and dict(got)[4] > 300_000
    assert K.encode_documents(df, offsets=True).columns == ["doc_id", "ids", "offsets"]
    assert K.encode_documents(df.limit(0)).count() == 0


def test_plans_hold_everything_and_leave_little():
    rnd = random.Random(2)
    for capacity, count in ((512, 3000), (97, 500), (8, 40), (2048, 1)):
        items = [rnd.randint(1, capacity) for _ in range(count)]
        histogram = {n: items.count(n) for n in set(items)}
        plan = C.plan_containers(histogram, capacity)
        held: dict[int, int] = {}
        for c in plan:
            assert 0 < sum(n * k for n, k in c.content.items()) <= capacity
            for n, k in c.content.items():
                held[n] = held.get(n, 0) + k * c.copies
        assert held == histogram
        bins, best = sum(c.copies for c in plan), -(-sum(items) // capacity)
        assert bins <= best * 1.08 + 1
    assert C.plan_containers({}, 10) == [] and C.plan_containers({5: 3}, 4) == []


@pytest.mark.parametrize("capacity, spread", [(512, 512), (2048, 700), (8192, 1200)])
def test_the_program_fills_nearly_all_containers(capacity, spread):
    rnd = random.Random(capacity)
    for scale in (1, 100):
        items = [min(capacity, 1 + int(rnd.expovariate(1 / spread))) for _ in range(8000)]
        histogram = {n: items.count(n) * scale for n in set(items)}
        made = sum(c.copies for c in C.program(dict(histogram), capacity))
        bins = sum(c.copies for c in C.plan_containers(histogram, capacity))
        alone = sum(c.copies for c in C._best_fit(histogram, capacity))
        assert made >= 0.9 * bins and bins <= alone * 1.002 + 1


def test_places_of_ranks():
    plan = [C.Configuration({3: 2, 5: 1}, 2), C.Configuration({3: 1}, 3)]
    places = C.Places(plan)
    assert places.of(np.array([3] * 7 + [5] * 2), np.array([*range(7), 0, 1])).tolist() == [0, 0, 1, 1, 2, 3, 4, 0, 1] and places.containers == 5


def test_knapsack_against_brute_force():
    import itertools

    import numpy as np

    rnd = random.Random(1)
    for _ in range(30):
        lengths = np.array(sorted(rnd.sample(range(1, 12), 3)))
        prices, most = np.array([rnd.random() for _ in lengths]), np.array([rnd.randint(1, 6) for _ in lengths])
        sack = C.Knapsack(lengths, prices, most, 13)
        for room in range(14):
            content = sack.content(room)
            assert all(c <= most[k] for k, c in content.items()) and sum(c * lengths[k] for k, c in content.items()) <= room
            best = max(sum(c * p for c, p in zip(cs, prices)) for cs in itertools.product(*(range(m + 1) for m in most)) if sum(c * n for c, n in zip(cs, lengths)) <= room)
            assert abs(sum(c * prices[k] for k, c in content.items()) - best) < 1e-9 and abs(sack.best[room] - best) < 1e-9


def test_packing(spark):
    rnd = random.Random(9)
    words = ["xin", "chào", "điều", "a", "luật"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 3, 10, 10, 10, 60])))) for i in range(300)] + [(900, None), (901, ""), (902, "một " * 500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumnRenamed("text", "text")
    sizes = spark.createDataFrame([("k", 64, "byte_bpe_50k"), ("k", 32, "byte_bpe_50k"), ("w", 16, "byte_bpe_50k"), ("none", 0, "byte_bpe_50k"), (None, 5, None)], "pack_kind string, capacity_tokens int, tokenizer string")
    count = {r.doc_id: r.n_tokens for r in K.count_tokens(df).collect()}
    packed = C.pack_documents(df, sizes).collect()
    for kind, capacity in (("k", 64), ("w", 16)):
        mine = [r for r in packed if r.pack_kind == kind]
        used: dict[int, int] = {}
        for r in mine:
            if r.container_id is not None:
                used[r.container_id] = used.get(r.container_id, 0) + r.n_tokens
        assert max(used.values()) <= capacity and set(used) == set(range(len(used)))
        for doc, n in count.items():
            parts = sorted((r for r in mine if r.doc_id == doc), key=lambda r: r.part)
            assert sum(r.n_tokens for r in parts) == n and [r.start_token for r in parts] == [r.part * capacity for r in parts]
            assert len(parts) == 1 or n > capacity
            assert (parts[0].container_id is None) == (n == 0)
    report = {r.pack_kind: r for r in C.fill_report(C.pack_documents(df, sizes), sizes).collect()}
    assert report["k"].over == 0 and report["k"].fill > 0.9
    assert C.pack_documents(df, sizes.limit(0)).count() == 0 and C.pack_documents(df.limit(0), sizes).count() == 0
