"""Records from fetched replies."""

import json

from lexframe.operators import articles
from lexframe.sources import details


def test_records(spark, tmp_path):
    detail = {
        "data": {
            "id": "a1", "title": "Luật A", "docNum": 12, "docType": {"name": "Luật"}, "issueDate": "2020-01-02T00:00:00", "effTo": None, "organization": {"title": "Bộ B"}, "documentFields": [{"name": "x"}, None, "y", {}],
            "effStatus": {"code": "C"}, "documentContent": {"content": "<p>Điều 1. Một</p><p>hai</p><p>hai</p>"},
            "documentIssues": [{"personName": "Lê An", "jobTitleName": "Bộ trưởng", "orderIndex": 2}, "x", {"personName": "Hồ Ba"}],
            "documentRelatedList": [], "references": [{"document": {"id": "r1", "title": "R"}, "docNum": "9"}, {"docId": 7}, 3],
        },
        "success": True,
    }
    diagram = {"documentNamesByType": {"3": [{"id": "d1", "name": "D"}, {"name": "?"}], "4": {"id": "no"}}, "documentNamesBySource": None}
    for name, text in {"a1.json": json.dumps(detail), "a1.diagram.json": json.dumps(diagram), "b2.json": json.dumps({"docAbs": "tóm tắt"}), "c3.json": "[1]"}.items():
        (tmp_path / name).write_text(text)
    items = spark.createDataFrame([("a1", None, None, "old", "s"), ("", "https://x/y--22", None, None, None), ("b2", None, "https://u", "kept", "s"), ("c3", None, None, None, None), (None, None, None, None, None)], "item_id string, url_toanvan string, url string, title string, summary string")
    replies = details.fetch_replies(items, details.folder_details(str(tmp_path))).cache()
    assert sorted(map(tuple, details.failures(replies).collect())) == [("22", "not_fetched"), ("c3", "unreadable")]
    got = {r.item_id: r for r in details.records(replies, "https://h/").collect()}
    a, b = got["a1"], got["b2"]
    assert len(got) == 2 and (a.title, a.doc_number, a.doc_type, a.issue_date, a.expiration_date, a.issuer, a.field, a.status, a.url_toanvan) == ("Luật A", "12", "Luật", "2020-01-02", "", "Bộ B", "x, y", "C", "https://h/a1")
    assert (a.signer, a.signer_title, a.full_text) == ("Lê An, Hồ Ba", "Bộ trưởng", "Điều 1. Một\nhai") and [p.order_index for p in a.issuing_people] == [2, None]
    assert [tuple(r) for r in a.related_docs] == [("r1", "R", "9", "https://h/r1"), ("7", "", "", "https://h/7")]
    assert len(a.relationship_graph.relations) == 30 and [tuple(x) for r in a.relationship_graph.relations for x in r.documents] == [("d1", "D", "https://h/d1")]
    assert (b.title, b.full_text, b.url_toanvan, b.signer) == ("kept", "tóm tắt", "https://u", "") and len(b.relationship_graph.relations) == 30
    parts = articles.split_articles(details.records(replies), "full_text", ["item_id"]).collect()
    assert [(r.article_number, r.content) for r in parts] == [("1", "hai")]
