"""Span operators against plain loops."""

import random

import pytest

from lexframe.operators import evaluation as E
from lexframe.operators import quality as Q
from lexframe.operators import sequence as S
from lexframe.operators import spans as N


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_occurrences(spark):
    docs = spark.createDataFrame([(1, "aaaa Điều ĐIỀU"), (2, "ßx İ aa"), (3, None), (4, "")], "id int, text string")
    needles = spark.createDataFrame([("A", "aa"), ("D", "điều"), ("X", "x"), ("E", "")], "label string, variant string")
    got = rows(N.find_spans(docs, "text", needles, ["id"]))
    listed, N.LISTED = N.LISTED, 1  # as for a list that is too long for literals
    assert rows(N.find_spans(docs, "text", needles, ["id"])) == got
    N.LISTED = listed
    assert got == [(1, "A", 0, 2), (1, "A", 2, 4), (1, "D", 10, 14), (1, "D", 5, 9), (2, "A", 5, 7), (2, "X", 1, 2)]


def test_resolution_against_a_loop(spark):
    rnd = random.Random(3)
    data = {(i % 7, rnd.choice("AB"), s := rnd.randint(0, 30), s + rnd.randint(1, 6)) for i in range(150)}
    expected = []
    for doc in range(7):
        taken = []
        for _, label, s, e in sorted((x for x in data if x[0] == doc), key=lambda x: (x[2], -(x[3] - x[2]), x[1])):
            hit = next((t for t in taken if s < t[1] and t[0] < e), None)
            expected.append((doc, label, s, e, hit is None, hit and f"overlap_with_{hit[2]}"))
            if not hit:
                taken.append((s, e, label))
    assert rows(N.resolve_overlaps(spark.createDataFrame(list(data), "id int, label string, start_char int, end_char int"), ["id"])) == sorted(expected, key=str)


def test_greedy_choice_against_a_loop(spark):
    rnd = random.Random(4)
    data = {(i % 5, rnd.choice("AB"), s := rnd.randint(0, 25), s + rnd.randint(1, 6), rnd.choice([0.5, 0.75, 1.0])) for i in range(100)}
    expected = []
    for doc in range(5):
        taken = []
        for x in sorted((x for x in data if x[0] == doc), key=lambda x: (-x[4], -(x[3] - x[2]), x[2], x[1])):
            if not any(x[2] < t[3] and t[2] < x[3] for t in taken):
                taken.append(x)
        expected += taken
    assert rows(N.greedy_select(spark.createDataFrame(list(data), "id int, label string, start_char int, end_char int, confidence double"), ["id"])) == sorted(expected, key=str)


def decoded(tokens, gap=True):
    out, active = [], None
    for s, e, label, c in tokens:
        base = label[2:]
        if label == "O" or label[:2] == "B-" or active is None or active[0] != base or (gap and s > active[2] + 1):
            if active:
                out.append(active)
            active = None if label == "O" else [base, s, e, [c]]
        else:
            active[2] = max(active[2], e) if gap else e
            active[3].append(c)
    return [(b, s, e, sum(c) / len(c), len(c)) for b, s, e, c in out + ([active] if active else [])]


@pytest.mark.parametrize("gap", [True, False])
def test_bio_decoding_against_a_loop(spark, gap):
    rnd = random.Random(6)
    data, expected = [], []
    for doc in range(12):
        at, tokens = 0, []
        for i in range(30):
            at += rnd.randint(0, 2)
            tokens.append((at, at + 2, rnd.choice(["O", "B-X", "I-X", "B-Y", "I-Y"]), rnd.choice([0.25, 0.5])))
            data.append((doc, i, *tokens[-1]))
            at += 2
        expected += [(doc, *x) for x in decoded(tokens, gap)]
    df = spark.createDataFrame(data, "id int, i int, start_char int, end_char int, label string, confidence double")
    assert rows(N.decode_bio(df, ["id"], ["i"], gap)) == sorted(expected, key=str)


def test_merging(spark):
    df = spark.createDataFrame([(1, "A", 0, 2, 0.5, 1, "c1"), (1, "A", 0, 2, 1.0, 3, "c0"), (1, "B", 0, 2, 1.0, 1, "c0")], "id int, label string, start_char int, end_char int, confidence double, n_tokens int, chunk_id string")
    assert rows(N.merge_entities(df, ["id"])) == [(1, "A", 0, 2, 0.875, 4, ["c0", "c1"]), (1, "B", 0, 2, 1.0, 1, ["c0"])]


def test_blocks_and_matches(spark):
    docs = spark.createDataFrame([(1, "a\n\n bản dịch 😀 Bản Dịch\nx"), (2, None), (3, " \n ")], "id int, text string")
    blocks = N.blocks_of(docs, "text", ["id"])
    assert rows(blocks) == [(1, 0, 0, 1, "a"), (1, 2, 2, 22, " bản dịch 😀 Bản Dịch"), (1, 3, 23, 24, "x")]
    joined = spark.createDataFrame([(1, "a\n bản dịch 😀 Bản Dịch\nx")], "id int, text string")
    found = N.matches_of(joined, "text", "(?iu)bản dịch", ["id"])
    assert rows(N.in_blocks(found, blocks, ["id"]).select("start_char", "end_char", "match", "block_no")) == [(14, 22, "Bản Dịch", 2), (3, 11, "bản dịch", 2)]


def test_windows(spark):
    docs = spark.createDataFrame([(n, " ".join("w" for _ in range(n))) for n in (0, 1, 6, 7, 10, 11, 30)], "id int, text string")
    tokens = S.word_tokens(docs, "text", ["id"])
    got = rows(S.chunk_windows(tokens, ["id"], max_length=8, stride=2).select("id", "chunk_no", "first_token", "last_token"))
    expected = []
    for n in (1, 6, 7, 10, 11, 30):
        start = k = 0
        while True:
            expected.append((n, k, start, min(start + 6, n) - 1))
            if start + 6 >= n:
                break
            start, k = start + 4, k + 1
    assert got == sorted(expected, key=str)
    assert rows(S.empty_chunks(docs, tokens, ["id"]).select("id", "chunk_id")) == [(0, "c00000")]
    with pytest.raises(ValueError, match="max_length"):
        S.chunk_windows(tokens, ["id"], max_length=4, stride=2)


def test_model_inputs(spark):
    import re

    encode = lambda t: [(len(m.group()), m.start(), m.end()) for m in re.finditer(r"\S+", t)]
    docs = spark.createDataFrame([(1, "a bb ccc dddd"), (2, None), (3, "")], "id int, text string")
    tokens = S.piece_tokens(docs, "text", ["id"], encode)
    got = S.chunk_inputs(tokens, ["id"], max_length=5, stride=1, first=[101], last=[102]).orderBy("chunk_no").collect()
    assert [r.input_ids for r in got] == [[101, 1, 2, 3, 102], [101, 3, 4, 102]]
    assert [len(r.attention_mask) for r in got] == [5, 4] and [tuple(x) for x in got[1].offset_mapping] == [(0, 0), (5, 8), (9, 13), (0, 0)]
    assert [(r.chunk_id, r.start_char, r.end_char) for r in got] == [("c00000", 0, 8), ("c00001", 5, 13)]


def test_alignment(spark):
    tokens = spark.createDataFrame([(1, 0, 0, 0), (1, 1, 0, 3), (1, 2, 4, 6), (1, 3, 7, 9), (1, 4, 10, 12)], "id int, token_no int, start_char int, end_char int")
    entities = spark.createDataFrame([(1, 0, "A", 0, 6), (1, 1, "B", 5, 9)], "id int, entity_no int, label string, start_char int, end_char int")
    assert rows(S.align_bio(tokens, entities, ["id"]).select("token_no", "bio")) == [(0, None), (1, "B-A"), (2, "I-A"), (3, "B-B"), (4, "O")]
    assert rows(S.bio_vocabulary(entities)) == [("B-A", 1), ("B-B", 3), ("I-A", 2), ("I-B", 4), ("O", 0)]


def test_metrics(spark):
    schema = "document_id string, start_char int, end_char int, label string"
    gold = spark.createDataFrame([("a", 0, 2, "X"), ("a", 0, 2, "X"), ("a", 5, 9, "Y"), ("b", 0, 1, "X")], schema)
    predicted = spark.createDataFrame([("a", 0, 2, "X"), ("a", 6, 9, "Z"), ("a", 20, 21, "X"), ("c", 0, 1, "X")], schema)
    outcomes = E.span_outcomes(gold, predicted)
    got = {r.label: (r.tp, r.fp, r.fn, r.support) for r in E.metrics_by_label(outcomes).collect()}
    assert got == {"X": (1, 2, 1, 2), "Y": (0, 0, 1, 1), "Z": (0, 1, 0, 0)}
    within = {r.label: r.fp for r in E.metrics_by_label(E.span_outcomes(gold, predicted, documents=gold)).collect()}
    assert within == {"X": 1, "Y": 0, "Z": 1}
    assert rows(E.confusion(E.boundary_errors(outcomes))) == [("Y", "Z", 1)]
    assert tuple(E.document_counts(gold, predicted).first()) == (2, 2, 1, 1, 1)
    micro = {r.average: r for r in E.micro_macro(outcomes).collect()}
    assert micro["micro"].precision == 0.25 and abs(micro["micro"].recall - 1 / 3) < 1e-12
    assert E.metrics_by_label(E.span_outcomes(gold.limit(0), predicted.limit(0))).count() == 0


def test_quality(spark):
    entity = "array<struct<start_char:int,end_char:int,text:string,label:string>>"
    df = spark.createDataFrame([(1, "abc", [(0, 2, "ab", "X"), (1, 9, "bc", "X"), None, (0, 1, "b", "Q")], "train"), (1, "abc", None, "test"), (2, None, [(0, 1, "a", "X")], None)], f"id int, text string, entities {entity}, split string")
    assert rows(Q.span_issues(df, "id", ["X"])) == [(1, 1, "offset_range"), (1, 3, "text_mismatch"), (1, 3, "unknown_label"), (2, 0, "offset_range")]
    assert rows(Q.leakage(df, "id")) == [(1, "test,train")]
    assert rows(Q.missing_labels(df, ["X", "Z"])) == [("test", "X"), ("test", "Z"), ("train", "Z")]
    spans = spark.createDataFrame([(1, 0, 5, "A"), (1, 1, 2, "B"), (1, 4, 6, "C"), (1, 6, 7, "D"), (1, 6, 7, "D")], "id int, start_char int, end_char int, label string")
    assert rows(Q.duplicate_entities(spans, "id")) == [(1, "D", 6, 7, 2)]
    assert [r[3] for r in rows(Q.overlapping_entities(spans.distinct(), "id"))] == ["B", "C"]
    with pytest.raises(ValueError, match="three ratios"):
        Q.ratios_valid((0.5, 0.5, 0.5))


def test_long_texts_and_many_needles(spark):
    words = [f"từ{i}" for i in range(3_000)]
    docs = spark.createDataFrame([(1, " ".join(words) + " "), (2, "không có"), (3, None)], "id int, text string")
    needles = spark.createDataFrame([("W", w + " ") for w in words], "label string, variant string")
    assert N.find_spans(docs, "text", needles, ["id"]).count() == len(words)


def test_many_spans_of_one_text(spark):
    """What is chosen doesn't depend on where spans hang together."""
    import random

    rnd = random.Random(3)
    found = [(1, rnd.choice("AB"), s, s + rnd.randint(1, 9), rnd.randint(0, 9) / 10) for s in (rnd.randint(0, 3_000) for _ in range(800))]
    df = spark.createDataFrame(list(dict.fromkeys(found)), "id int, label string, start_char int, end_char int, confidence double")
    end, accepted = -1, []
    for s in sorted({(s, s - e, label, e) for _, label, s, e, _ in found}):
        if s[0] >= end:
            end = s[3]
            accepted.append((s[0], s[3], s[2]))
    got = N.resolve_overlaps(df.drop("confidence").distinct(), ["id"]).where("accepted")
    assert sorted((r.start_char, r.end_char, r.label) for r in got.collect()) == sorted(accepted)
    chosen = []
    for c, _, s, label, e in sorted((-c, s - e, s, label, e) for _, label, s, e, c in set(found)):
        if all(e <= a or b <= s for a, b, _ in chosen):
            chosen.append((s, e, label))
    assert sorted((r.start_char, r.end_char, r.label) for r in N.greedy_select(df, ["id"]).collect()) == sorted(chosen)
