"""Overlaps, near-duplicates and repetition against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexframe.llm import hyperminhash as H
from lexframe.llm import overlaps as O
from lexframe.llm import repetition as R
from lexframe.llm import textvec as V
from lexframe.llm.lookalikes import consistent
from lexframe.llm.pairs import equal_pairs, self_pairs


def words(t):
    return re.findall(r"[^\W_]+", t.lower())


def shingles(t, n=3):
    w = words(t)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def alike(a, b):
    x, y = shingles(a), shingles(b)
    return bool(x or y) and 10 * len(x & y) >= 7 * len(x | y)


def edited(rnd, t, share):
    w = t.split()
    for _ in range(int(len(w) * share)):
        i = rnd.randrange(len(w))
        w[i : i + 1] = rnd.choice([[], [w[i], "thêm"], ["khác" + str(rnd.randint(0, 99))]])
    return " ".join(w)


def corpus(seed, n):
    """Texts of mixed length that share passages, with copies and edits; a third of them one group of near-copies."""
    rnd = random.Random(seed)
    pool = [" ".join(f"từ{rnd.randint(0, 400)}" for _ in range(12)) for _ in range(60)]
    base = [". ".join(rnd.sample(pool, rnd.randint(1, 12))) for _ in range(n // 3)]
    hot = base[0]
    return base + [edited(rnd, hot, rnd.choice([0, 0.01, 0.03])) for _ in range(n // 3)] + [edited(rnd, rnd.choice(base), rnd.choice([0, 0.02, 0.05, 0.08, 0.2])) for _ in range(n // 3)]


def test_words_and_ngrams_are_those_of_the_text():
    texts = ["Một hai, MỘT hai_ba", "", " ", "x½ ²y 1.2", "Я η ộ", "a\x00b\nc"]
    codes, docs, starts = V.words(texts)
    joined = "\n".join(t.lower() for t in texts)
    flat = [(i, w) for i, t in enumerate(texts) for w in words(t)]
    assert docs.tolist() == [i for i, _ in flat] and [joined[s : s + len(w)] for s, (_, w) in zip(starts, flat)] == [w for _, w in flat]
    assert len({(w, c) for (_, w), c in zip(flat, codes.tolist())}) == len({w for _, w in flat}) == len(set(codes.tolist()))
    values, offsets = V.shingle_sets(texts * 2, 3)
    assert np.diff(offsets).tolist() == [len(shingles(t)) for t in texts * 2]


def test_sketches_estimate_similarity():
    rnd = random.Random(1)
    for share in (0.2, 0.5, 0.8):
        values = np.array([rnd.getrandbits(64) for _ in range(2000)], dtype=np.uint64)
        common = int(2000 * share)
        a, b = np.sort(values[: common + (2000 - common) // 2]), np.sort(np.concatenate([values[:common], values[common + (2000 - common) // 2 :]]))
        regs = H.registers(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        size = np.array([len(a)])
        assert abs(H.estimated_jaccard(regs[:1], regs[1:], size, size)[0] - share) < 0.13
    assert not H.registers(np.zeros(0, np.uint64), np.array([0, 0])).any()


def test_chance_agreement_of_registers():
    rnd = np.random.default_rng(2)
    for n, m in ((64, 64), (2000, 2000), (3000, 300)):
        sets = 600
        sizes = np.tile([n, m], sets)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        regs = H.registers(rnd.integers(0, 1 << 63, offsets[-1], dtype=np.uint64), offsets)
        seen, told = (regs[::2] == regs[1::2]).mean(), H.chance(np.array([n]), np.array([m]))[0]
        assert abs(seen - told) < 4 * (told / (sets * H.REGISTERS)) ** 0.5, (n, m, seen, told)


def test_near_duplicates_against_brute_force(spark):
    texts = [(i, None if i % 17 == 0 else f"tiêu đề {i % 3}", t) for i, t in enumerate(corpus(7, 240))]
    texts += [(1000, "x", None), (1001, "x", ""), (1002, None, "ba từ thôi"), (1003, None, "ba từ thôi"), (1004, "", "hai từ"), (1005, "", "hai từ")]
    texts += [(1006, "t", "Ｍột h​аi ba bốn năm sáu"), (1007, "t", "Một hai ba bốn năm sáu")]
    df = spark.createDataFrame([(*t, 1) for t in [*texts, texts[1], texts[100]]], "record_id bigint, title string, full_text string, id int")  # two rows are repeated
    got = sorted((r.row_a, r.row_b) for r in H.member_pairs(*H.near_duplicates(df)).collect())
    full = [(i, (h or "") + "\n" + consistent(t)) for i, h, t in texts if t]
    assert got == sorted((a, b) for a, x in full for b, y in full if a < b and alike(x, y))
    assert H.member_pairs(*H.near_duplicates(df.limit(0))).count() == 0


def test_short_sets_meet_exactly():
    rnd = random.Random(5)
    missed = 0
    for _ in range(3000):
        union = rnd.randint(7, 30)
        common = -(-union * 7 // 10)
        u = np.array([rnd.getrandbits(64) for _ in range(union)], dtype=np.uint64)
        side = np.array([rnd.random() < 0.5 for _ in range(union - common)], dtype=bool)
        a, b = np.sort(np.concatenate([u[:common], u[common:][side]])), np.sort(np.concatenate([u[:common], u[common:][~side]]))
        offsets = np.array([0, len(a), len(a) + len(b)])
        x, y = H.prefix_keys(np.concatenate([a, b]), offsets)
        missed += not set(x.tolist()) & set(y.tolist())
    assert not missed
    assert [len(k) for k in H.prefix_keys(np.arange(H.SHORT + 1, dtype=np.uint64), np.array([0, 0, H.SHORT + 1]))] == [0, 0]


def test_overlaps_against_brute_force(spark):
    rnd = random.Random(8)
    zero, blank = "0" * 64, None
    rows = []
    for i, t in enumerate([*corpus(11, 210), None, "", "một hai ba", "một hai ba", "một", "một", " "]):
        rows.append((i, rnd.choice(["train", "test", "validation", "train"]) if i % 50 else None, t, rnd.choice([blank, "", f"D{rnd.randint(0, 80)} ", f"d{rnd.randint(0, 80)}", "0000-00"]), rnd.choice([blank, zero, "", f"h{rnd.randint(0, 90)}"])))
    df = spark.createDataFrame([(*r, "s") for r in rows], "row_id bigint, split string, text string, document_id string, source_sha256 string, source string")

    def known(v):
        v = (v or "").strip().lower()
        return None if re.fullmatch(r"[0\-\s]*", v) else v

    expected = set()
    for a in rows:
        for b in rows:
            if a[1] not in (None, "train") and b[1] == "train":
                if (known(a[3]) and known(a[3]) == known(b[3])) or (known(a[4]) and known(a[4]) == known(b[4])) or (a[2] and a[2] == b[2]) or (a[2] and b[2] and alike(a[2], b[2])):
                    expected.add((a[0], b[0]))
    pairs = O.overlapping_rows(df)
    assert {(r.eval_id, r.train_id) for r in pairs.collect()} == expected
    report = O.overlap_report(df, pairs).collect()
    assert sum(r.n_pairs for r in report) == len(expected) and sum(r.n_overlapping for r in report) == len({a for a, _ in expected})
    assert O.overlapping_rows(df.limit(0)).count() == 0


def test_edits_all_over_a_text_are_found(spark):
    rnd = random.Random(3)
    base = [[f"w{rnd.randint(0, 3000)}" for _ in range(n)] for n in (60, 100, 200, 400, 1000) for _ in range(8)]
    new = lambda: f"n{rnd.randint(0, 10**6)}"
    rows = [(i, "train", " ".join(w)) for i, w in enumerate(base)]
    for step in (9, 12, 14, 16, 17, 20):  # a word put in, or another one, after every so many
        for k, change in enumerate((lambda part: [*part, new()], lambda part: [*part[:-1], new()])):
            rows += [(step * 1000 + 500 * k + i, "test", " ".join(x for j in range(0, len(w), step) for x in change(w[j : j + step]))) for i, w in enumerate(base)]
    for i, w in enumerate(base):
        for k in range(4):  # changes at random places, and all in one place
            scattered, cut = list(w), rnd.randrange(len(w))
            for _ in range(int(len(w) * rnd.uniform(0.02, 0.08))):
                scattered[rnd.randrange(len(w))] = new()
            rows += [(40000 + 10 * i + k, "test", " ".join(scattered)), (50000 + 10 * i + k, "test", " ".join(w[:cut] + [new() for _ in range(int(len(w) * rnd.uniform(0.05, 0.2)))] + w[cut:]))]
    df = spark.createDataFrame(rows, "row_id bigint, split string, text string")
    sets = {i: shingles(t) for i, _, t in rows}
    expected = {(a, b) for a, x, _ in rows if x == "test" for b, y, _ in rows if y == "train" and 10 * len(sets[a] & sets[b]) >= 7 * len(sets[a] | sets[b])}
    assert len(expected) > 400
    _, links = O.containments(df)
    assert {(r.a, r.b) for r in links.collect()} == expected


def repeated(t, n=8):
    w = words(t or "")
    seen, marked = set(), [False] * len(w)
    for i in range(len(w) - n + 1):
        k = tuple(w[i : i + n])
        if k in seen:
            marked[i : i + n] = [True] * n
        seen.add(k)
    return len(w), sum(marked)


def test_repetition_against_brute_force():
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 80))) for _ in range(400)] + ["", " ", "a b c d e f g h " * 3000, "một"]
    total, again = R.repeated_words(texts)
    assert list(zip(total.tolist(), again.tolist())) == [repeated(t) for t in texts]


def test_hosts(spark):
    bad, good = "a b c d e f g h " * 10, " ".join(f"w{i}" for i in range(60))
    rows = [(i, bad if i % 10 < 9 else good, "spam") for i in range(60)] + [(100 + i, good, "clean") for i in range(300)] + [(500, bad, "one"), (501, None, None), (502, "", "clean"), (503, bad, None)]
    df = spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id bigint, text string, source string, share double")
    got = {r.doc_id: r for r in R.repetition(df).collect()}
    assert len(got) == len(rows) and got[0].host_bad and not got[100].host_bad and got[501].host_bad is None
    assert got[0].failed and not got[9].failed and got[9].host_bad and got[501].n_words == 0 and not got[502].failed and got[503].failed
    rates = {r.source: r.host_rate for r in got.values()}
    assert rates["one"] < 1 and rates["spam"] > rates["clean"]
    assert abs(rates["one"] - (1 + 55 / 362) / 2) < 1e-9  # hosts this unlike leave the prior the weight of one document
    assert R.repetition(df.limit(0)).count() == 0
    measured = R.measure_repetition(df.select("doc_id", "text", "source"))
    assert measured.where(F.col("n_words") > 0).count() == len(rows) - 2


@pytest.mark.parametrize("share", [0.05, 0.3])
def test_prior_of_hosts(spark, share):
    rnd = random.Random(2)
    rates = {f"h{i}": min(1.0, max(0.0, rnd.gauss(share, 0.03))) for i in range(60)} | {f"s{i}": share for i in range(300)}
    n = {h: rnd.randint(50, 400) if h[0] == "h" else rnd.randint(1, 3) for h in rates}
    bad = {h: sum(rnd.random() < rates[h] for _ in range(n[h])) for h in rates}
    df = spark.createDataFrame([(h, i < bad[h]) for h in n for i in range(n[h])], "source string, failed boolean")
    got = {r.source: r.rate for r in R.host_verdicts(df).collect()}
    docs, mean = sum(n.values()), sum(bad.values()) / sum(n.values())
    w = {h: n[h] / docs for h in n}
    seen = sum(w[h] * (bad[h] / n[h] - mean) ** 2 for h in n)
    within, between = sum(w[h] * (1 - w[h]) / n[h] for h in n), sum(w[h] * (1 - w[h]) for h in n)
    alike = (seen - mean * (1 - mean) * within) / (mean * (1 - mean) * (between - within))
    weight = 1 / alike - 1
    assert 10 < weight < 2000  # not pulled down by the many hosts with one document
    assert all(abs(got[h] - (bad[h] + mean * weight) / (n[h] + weight)) < 1e-9 for h in n)


@pytest.mark.parametrize("lengths", [[], [5], [3, 3, 3], [100, 1, 1]])
def test_chunks_cover_all(lengths):
    parts = list(V.chunks(lengths, limit=6))
    assert [i for a, b in parts for i in range(a, b)] == list(range(len(lengths)))


def test_pairs_in_blocks(spark):
    left = spark.createDataFrame([("a", i) for i in range(30)] + [("b", 99), (None, 1), ("c", 5)], "k string, x int")
    right = spark.createDataFrame([("a", 100 + i) for i in range(25)] + [("b", 7), ("b", 7), (None, 2)], "k string, y int")
    got = sorted((r.x, r.y) for r in equal_pairs(left, right, "x", "y", block=4).collect())
    assert got == sorted([(i, 100 + j) for i in range(30) for j in range(25)] + [(99, 7)] * 2)


def test_each_pair_once_at_its_first_shared_key(spark):
    rnd = random.Random(6)
    keys = {i: sorted({rnd.choice([0, 0, 1, *range(2, 12)]) for _ in range(3)}) for i in range(40)}
    rows = spark.createDataFrame([(k, i, ks[:at]) for i, ks in keys.items() for at, k in enumerate(ks)], "k int, x int, seen array<int>")
    expected = sorted((a, b) for a in keys for b in keys if a < b and set(keys[a]) & set(keys[b]))
    for block in (3, 1000):
        assert sorted((r.a, r.b) for r in self_pairs(rows, "x", once="seen", block=block).collect()) == expected
        assert {(r.a, r.b) for r in self_pairs(rows, "x", block=block).collect()} == set(expected)
