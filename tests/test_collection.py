"""Collection and label operators."""

import hashlib

from pyspark.sql import functions as F

from lexframe.operators import articles as A
from lexframe.operators import collection as C
from lexframe.operators import labels as L


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_types_leave_longer_names_out(spark):
    df = spark.createDataFrame([("Thông tư", "x"), ("Thông tư liên tịch", "x"), ("", "THÔNG TƯ-BTC"), ("", "Thong tu lien tich 1"), ("", "Thông tưx"), (None, None)], "doc_type string, title string")
    assert [r[0] for r in df.select(C.matches_type(F.col("doc_type"), F.col("title"), "3")).collect()] == [True, False, True, False, False, False]
    assert df.where(C.matches_type(F.col("doc_type"), F.col("title"), "unknown")).count() == 6
    assert rows(C.document_types(df.distinct(), ["title", "doc_type"]).select("type_id")) == [("thong_tu",), ("thong_tu",), ("thong_tu_lien_tich",), ("thong_tu_lien_tich",)]


def test_folders(spark):
    df = spark.createDataFrame([("a1", "1/2", "Luật", 1), ("b123456789012345", "1/2", "Luật", 2), ("c", "1/2", None, 3), ("d2345678901", "", "Luật", 4), ("e", "Không số", "Luật", 5), (None, None, None, 6)], "item_id string, doc_number string, doc_type string, ord int")
    assert rows(C.folder_names(df)) == [("a1", "Luật", "1_2"), ("b123456789012345", "Luật", "1_2__b12345678901"), ("c", "Khac", "1_2"), ("d2345678901", "Luật", "Khong_so_d2345678"), ("e", "Luật", "Khong_so_e"), (None, "Khac", "Khong_so")]


def test_resuming(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "item_id string")
    assert rows(C.pending_items(ids("a", "b", "c", "a", None, ""), ids("a", "b"), ids("b", "x"))) == [("a",), ("c",)]
    assert rows(C.stale_items(ids("a", "b", "b"), ids("b"))) == [("a",)]


def test_thirty_relations(spark):
    edges = spark.createDataFrame([(1, "3", "outgoing", 2, "b"), (1, "3", "outgoing", 1, "a")], "record_id int, code string, direction string, place int, id string")
    got = C.relation_graph(edges, spark.createDataFrame([(1,), (2,)], "record_id int"))
    assert got.count() == 60 and rows(got.where("n_documents > 0").select("record_id", "code", "documents")) == [(1, "3", "a,b")]
    assert C.relation_names(spark).count() == 30


def test_attachments(spark):
    df = spark.createDataFrame([(1, ["a.docx", None, "Template.doc", "a.docx", "b.PDF", "c.txt"]), (2, None)], "id int, f array<string>")
    assert [r[0] for r in df.select(C.attachment_names(F.col("f"))).collect()] == [["a.docx", "b.PDF"], None]
    sized = spark.createDataFrame([(1, 0, "a.pdf", 5), (1, 1, "b.doc", 5), (1, 2, "c.docx", 5), (1, 3, "d.docx", 5), (2, 0, "x.pdf", 9), (2, 1, "x.docx", 8)], "id int, place int, name string, size bigint")
    assert rows(C.best_attachment(sized, "id")) == [(1, "c.docx", 5), (2, "x.pdf", 9)]


def test_articles_and_sentences(spark):
    text = "Mở đầu\nĐiều 1. Phạm vi\nNội dung một; xong.\nĐIỀU 2: Hai\nB. C?  D\nĐiều 3"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, text string")
    assert rows(A.split_articles(df, "text", ["id"]).select("article_number", "title", "content")) == [("1", "Điều 1. Phạm vi", "Nội dung một; xong."), ("2", "ĐIỀU 2: Hai", "B. C?  D")]
    got = [text[s:e] for _, _, s, e in rows(A.sentence_offsets(df.where("id = 1"), "text", ["id"]))]
    assert "".join(got).replace(" ", "").replace("\n", "") == text.replace(" ", "").replace("\n", "") and "C?" in got and got[-1].startswith("D")


def test_signatures(spark):
    lines = ["x", "KT. BỘ TRƯỞNG", "THỨ TRƯỞNG", "(Đã ký)", "", "Trần Tuấn Đoan", "Nơi nhận: A"]
    inline = ["TM. CHÍNH PHỦ", "Đã ký Lê Văn Tám"]
    none = ["a", "b"]
    df = spark.createDataFrame([(k, i, t) for k, ls in enumerate((lines, inline, none)) for i, t in enumerate(ls)], "id int, line_no int, line string")
    assert rows(A.signatures(df, ["id"])) == [(0, "Trần Tuấn Đoan", "KT. BỘ TRƯỞNG THỨ TRƯỞNG"), (1, "Lê Văn Tám", "TM. CHÍNH PHỦ")]


def test_flattening(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": [1, {"c": "x"}, []]}, "d": null, "e": {}}'), (2, "broken"), (3, None), (4, "5")], "id int, j string")
    assert rows(L.flatten_json(df, "j", ["id"]).select("id", "path", "value")) == [(1, "a.b[]", "1"), (1, "a.b[].c", "x"), (1, "d", None), (4, "", "5")]
    deep = spark.createDataFrame([(1, '{"a": {"b": {"c": 1}}}')], "id int, j string")
    assert rows(L.flatten_json(deep, "j", ["id"], depth=1).select("path", "value")) == [("a", '{"b":{"c":1}}')]
    nested = '{"s": "[[{\\\\\\"[", "a": ' + '{"b": ' * 10 + '[1, {"c": "x"}]' + "}" * 10 + "}"
    very = spark.createDataFrame([(1, nested), (2, "[" * 30), (3, None)], "id int, j string")
    at = "a" + ".b" * 10 + "[]"
    assert L.json_depth(very, "j") == 13
    assert rows(L.flatten_json(very, "j", ["id"]).select("path", "value")) == sorted([(at, "1"), (at + ".c", "x"), ("s", '[[{\\"[')])


def test_splits_and_samples(spark):
    for n in (0, 1, 7, 100):
        df = spark.range(n).withColumnRenamed("id", "k")
        got = dict(rows(L.split_by_digest(df, "k", (0.6, 0.2, 0.2)).groupBy("split").count()))
        assert (got.get("train", 0), got.get("validation", 0), sum(got.values())) == (int(n * 0.6), int(n * 0.2), n)
        for size in (1, 3, 7, 99, 200):
            sample = [r[0] for r in rows(L.systematic_sample(df, "k", size))]
            assert sorted(sample) == (list(range(n)) if n <= size else [int(i * (n / size)) for i in range(size)])
    df = spark.range(60).selectExpr("id as k", "id % 6 = 0 as p")
    picked = L.sampled_negatives(df, "k", F.col("p"), 1.5)
    best = sorted((k for k in range(60) if k % 6), key=lambda k: hashlib.sha256(f"42|{k}".encode()).hexdigest())[:15]
    assert {r.k for r in picked.collect()} == {k for k in range(60) if k % 6 == 0} | set(best)


def test_weak_labels(spark):
    docs = spark.createDataFrame([(1, "Số 12/2018 của Bộ A, ngày 5/1/2018; bộ a."), (2, "không có"), (3, None)], "id int, text string")
    values = spark.createDataFrame([(1, "Bộ A", "2018-01-05"), (2, "Bộ A", "--"), (3, None, "")], "id int, office string, issued string")
    leaves = L.record_leaves(values, {"office": "attribute_json.attributes.co_quan", "issued": "attribute_json.attributes.ngay"}, ["id"])
    profile = L.path_profile(leaves, docs.where("text is not null"), "text", ["id"])
    assert rows(profile.select("path", "documents", "combined_match_rate")) == [("attribute_json.attributes.co_quan", 2, 0.5), ("attribute_json.attributes.ngay", 1, 1.0)]
    labels = L.induced_labels(profile).where("is_span_entity").select("path", "name", F.lit(False).alias("allow_multiple"))
    assert rows(L.weak_spans(leaves, labels, docs, "text", ["id"]).select("id", "label", "start_char", "end_char")) == [(1, "ATTRIBUTE_JSON_ATTRIBUTES_CO_QUAN", 15, 19), (1, "ATTRIBUTE_JSON_ATTRIBUTES_NGAY", 26, 34)]
