"""Files, listings, states and streams."""

import json

import pytest
from pyspark.sql import functions as F

from lexframe.operators import collection as C
from lexframe.sources import files, listing, sinks
from lexframe.streaming import resume


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())


def test_word_round_trip(spark, tmp_path):
    write(tmp_path / "a" / "d1" / "noi_dung.docx", sinks.docx_bytes(["Điều 1.  X", "", " ", "<b> & 😀"]))
    write(tmp_path / "a" / "d2" / "x.docx", b"broken")
    write(tmp_path / "a" / "d3" / "x.doc", b"old")
    write(tmp_path / "a" / "d4" / "empty.docx", sinks.docx_bytes([]))
    got = {r.document_id: r for r in files.read_documents(spark, str(tmp_path)).collect()}
    doc = got["d1"]
    assert doc.normalized_text == "Điều 1. X\n<b> & 😀" and doc.error is None
    assert [(b.block_id, b.paragraph_index, doc.normalized_text[b.start_char : b.end_char]) for b in doc.blocks] == [("b00000", 0, "Điều 1. X"), ("b00003", 3, "<b> & 😀")]
    assert len(doc.normalized_to_raw) == len(doc.normalized_text) and doc.raw_text[doc.normalized_to_raw[-1]] == "😀"
    assert "BadZipFile" in got["d2"].error and "converter" in got["d3"].error and got["d4"].normalized_text == ""


def test_cached_documents_are_read_again_only_when_changed(spark, tmp_path):
    write(tmp_path / "in" / "d1" / "x.docx", sinks.docx_bytes(["one"]))
    write(tmp_path / "in" / "d2" / "x.docx", sinks.docx_bytes(["two"]))
    sinks.write_cache(files.read_documents(spark, str(tmp_path / "in")).withColumn("extraction_method", F.lit("cached")), str(tmp_path / "cache"))
    write(tmp_path / "in" / "d2" / "x.docx", sinks.docx_bytes(["two!"]))
    got = files.read_cached_documents(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "cache")))
    assert rows(got.select("document_id", "extraction_method", "normalized_text")) == [("d1", "cached", "one"), ("d2", "docx", "two!")]


def test_tables_in_word_files(spark):
    import zipfile
    from io import BytesIO

    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    p = "<w:p><w:r><w:t>{}</w:t></w:r></w:p>"
    body = f"<w:document {w}><w:body>{p.format('before')}<w:tbl><w:tr><w:tc>{p.format('a')}{p.format('')}{p.format('b')}</w:tc><w:tc>{p.format('c')}</w:tc></w:tr></w:tbl></w:body></w:document>"
    out = BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", body)
        z.writestr("word/footer1.xml", f"<w:ftr {w}>{p.format('end')}</w:ftr>")
    blocks = files.docx_blocks(out.getvalue())
    assert [(b["block_type"], b.get("cell_index"), b["text"]) for b in blocks] == [("paragraph", None, "before"), ("table_cell", 0, "a\nb"), ("table_cell", 1, "c"), ("footer", None, "end")]


def test_inventory_and_pairs(spark, tmp_path):
    for name, text in {"x/1/noi_dung.docx": "w", "x/1/thuoc_tinh.json": '\ufeff{"metadata": {"item_id": "id1"}}', "x/1/luoc_do.json": "{", "x/2/a.doc": ".", "x/2/b.docx": ".", "y/3/thuoc_tinh.json": "[]", "y/z.txt": "?"}.items():
        write(tmp_path / name, text)
    found = files.list_files(spark, str(tmp_path))
    assert rows(C.inventory_summary(found).select("kind", "n_files", "n_unreadable")) == [("attribute_json", 2, 0), ("other", 1, 0), ("schema_json", 1, 1), ("word", 3, 0)]
    assert rows(C.duplicate_basenames(found)) == [("thuoc_tinh.json", 2)]
    pairs = C.pair_files(files.file_item_ids(spark, str(tmp_path)))
    assert rows(pairs.select("document_id", "word_file", "pairing_confidence", "status")) == [("2__1", "b.docx", 0.8, "partial"), ("2__2", "a.doc", 0.8, "partial"), ("3", None, 0.0, "unmatched"), ("id1", "noi_dung.docx", 1.0, "paired")]
    assert rows(files.discover_inputs(spark, str(tmp_path)).select("document_id")) == [("1",), ("a",), ("b",)]
    assert rows(files.read_exported_ids(spark, str(tmp_path), ["x"])) == [("id1", "x")]


def test_text_formats(spark, tmp_path):
    write(tmp_path / "a.jsonl", '{"a": 1}\n\n{"a": 2, "b": "x"}\nbroken\n[1]\n')
    good, bad = files.read_jsonl(spark, str(tmp_path / "a.jsonl"), "a int, b string")
    assert rows(good) == [(1, None), (2, "x")] and rows(bad) == [("[1]",), ("broken",)]
    write(tmp_path / "keys.txt", " a \n\nb\na\n")
    assert rows(files.read_key_set(spark, str(tmp_path / "keys.txt"))) == [("a",), ("b",)]
    write(tmp_path / "t.csv", '\ufeffx,y\n1,"a\nb"\n')
    assert [r.asDict() for r in files.read_csv(spark, str(tmp_path / "t.csv")).collect()] == [{"x": "1", "y": "a\nb"}]
    write(tmp_path / "p" / "a.json", json.dumps({"document_id": "d", "entities": [{"label": "X", "start_char": 0, "end_char": 2}]}))
    write(tmp_path / "p" / "b.json", "{")
    entities, rejects = files.read_predictions(spark, str(tmp_path / "p"))
    assert rows(entities.select("document_id", "label", "end_char")) == [("d", "X", 2)] and rejects.count() == 1


def test_listing_pages(spark, tmp_path):
    for page in (1, 2, 3):
        items = [{"id": f"{page}-{i}", "title": "t", "docType": {"name": "Luật"}, "organization": {"title": "o"}} for i in range(2 if page < 3 else 1)]
        write(tmp_path / f"page_{page}.json", json.dumps({"data": {"total": 5, "items": items}}))
    read = listing.read_listing(spark, path=str(tmp_path), pageSize=2, typeId="1")
    assert rows(read.select("item_id", "doc_type", "issuer", "list_page"))[0] == ("1-0", "Luật", "o", 1) and read.count() == 5
    assert listing.read_listing(spark, path=str(tmp_path), pageSize=2, afterPage=1, maxPages=1).count() == 2
    assert read.where("keyword = 'k' and title = 't'").count() == 0 and read.where("keyword = 't'").count() == 5
    assert listing.total_pages(None, 10) == (0, 0) and listing.total_pages(21, 10) == (21, 3) and listing.total_pages(0, 10) == (0, 1)
    assert listing.with_retries(lambda: {"a": 1}) == {"a": 1} and listing.with_retries(lambda: int("x")) is None


def test_listing_asks_and_filters_by_type(spark, tmp_path):
    assert listing.listing_payload(2, 10, "3", "a b") == {"pageNumber": 2, "pageSize": 10, "keyword": "a b", **listing.ASKED, "docType": [listing.SERVICE_TYPES["thong_tu"]]}
    assert len(listing.listing_payload(1, 10, "", "")["docType"]) == 26 and "docType" not in listing.listing_payload(1, 10, "other", "")
    kinds = ["Luật", "Thông tư", "Thông tư liên tịch", {"name": "THÔNG  TƯ"}, ""]
    titles = ["a", "b", "c", "đê điều", "Thông tư về đê"]
    write(tmp_path / "page_1.json", json.dumps({"total": 5, "items": [{"id": str(i), "title": t, "docType": k} for i, (k, t) in enumerate(zip(kinds, titles))]}))
    read = lambda **o: sorted(r.item_id for r in listing.read_listing(spark, path=str(tmp_path), **o).collect())
    assert read() == list("01234") and read(typeId="thong_tu") == list("134") and read(typeId="luat") == ["0"] and read(typeId="3", keyword="ĐÊ") == list("34")
    assert read(ask='{"keyword": "đê"}') == list("34")
    every = listing.read_listing(spark, path=str(tmp_path))
    assert sorted(r.item_id for r in every.where("type_id = 'thong_tu'").collect()) == list("134")
    assert listing.read_listing(spark, path=str(tmp_path), typeId="luat").where("type_id = 'thong_tu'").count() == 0


def test_pages_that_cannot_be_read(spark, tmp_path):
    for page in (1, 3):
        write(tmp_path / f"page_{page}.json", json.dumps({"data": {"total": 3, "items": [{"id": str(page), "title": "t"}]}}))
    with pytest.raises(Exception, match="page 2 of the listing"):
        listing.read_listing(spark, path=str(tmp_path), pageSize=1, attempts=1).collect()
    got = listing.read_listing(spark, path=str(tmp_path), pageSize=1, attempts=1, onError="row").collect()
    assert sorted((r.list_page, r.item_id, bool(r.error)) for r in got) == [(1, "1", False), (2, None, True), (3, "3", False)]
    write(tmp_path / "page_2.json", json.dumps({"data": {"total": 3, "items": [{"id": "2", "title": "t"}]}}))
    assert rows(listing.read_listing(spark, path=str(tmp_path), pageSize=1, pages="2").select("item_id", "list_page")) == [("2", 2)]
    with pytest.raises(Exception, match="page 1 of the listing"):
        listing.read_listing(spark, path=str(tmp_path / "none"), attempts=1).count()
    assert [(r.list_page, r.error is None) for r in listing.read_listing(spark, path=str(tmp_path / "none"), attempts=1, onError="row").collect()] == [(1, False)]
    write(tmp_path / "empty" / "page_1.json", json.dumps({"data": {"total": 0, "items": []}}))
    assert listing.read_listing(spark, path=str(tmp_path / "empty")).count() == 0


def test_merges_rewrite_only_the_buckets_they_touch(spark, tmp_path):
    table = resume.KeyedTable(spark, str(tmp_path / "t"), "k", "at", buckets=4, kept=1)
    row = lambda k, at: spark.createDataFrame([(k, f"{k}{at}", at)], "k string, v string, at int")
    table.merge(spark.createDataFrame([(str(i), "x", 0) for i in range(40)], "k string, v string, at int"), 0)
    for batch in range(1, 5):
        table.merge(row("7", batch), batch)
    assert table.read().count() == 40 and rows(table.read().where("k = '7'")) == [("7", "74", 4)]
    parts = sorted(str(p.relative_to(tmp_path / "t").parent) for p in (tmp_path / "t").glob("v*/_bucket=*/*.parquet"))
    assert len({p for p in parts if p.startswith("v1/")}) == 3 and {p[:2] for p in parts} == {"v1", "v4", "v5"}  # the last one and one more
    table.merge(row("7", 9), 2)  # a batch that is part of the table
    assert rows(table.read().where("k = '7'")) == [("7", "74", 4)]
    table.merge(row("7", 9).limit(0), 5)
    assert table.read().count() == 40


def test_resuming_stream_reads_files_once(spark, tmp_path):
    source, state = tmp_path / "in", str(tmp_path / "state")
    target = resume.KeyedTable(spark, state, "item_id", "at")
    run = lambda: resume.ingest_listing(spark, str(source), "item_id string, title string, at int", target, str(tmp_path / "cp"))
    write(source / "1.jsonl", '{"item_id": "a", "title": "old", "at": 1}\n{"item_id": "b", "title": "x", "at": 1}\nbroken\n')
    assert run() == 3 and run() == 0
    write(source / "2.jsonl", '{"item_id": "a", "title": "new", "at": 2}\n{"item_id": "b", "title": "older", "at": 0}\n')
    assert run() == 2
    assert rows(target.read()) == [("a", "new", 2), ("b", "x", 1)]
    target.merge(target.read().withColumn("title", F.lit("again")), 0)  # a batch that is part of the table
    assert rows(target.read())[0] == ("a", "new", 2)


def test_orphan_counts_from_a_stream(spark, tmp_path):
    target = resume.KeyedTable(spark, str(tmp_path / "state"), "ref_id", "batch")
    change = lambda k, c, day: json.dumps({"ref_id": k, "change": c, "ts": f"2024-01-0{day}T00:00:00"}) + "\n"
    batches = (change("a", "reference", 1) + change("b", "reference", 1) + change("b", "record", 1), change("a", "record", 2) + change("b", "withdrawn", 2) + change("b", "removal", 2), change("a", "removal", 3) + change("b", "record", 1))
    seen = []
    for i, lines in enumerate(batches):
        write(tmp_path / "in" / f"{i}.json", lines)
        resume.orphan_counts_stream(spark, str(tmp_path / "in"), target, str(tmp_path / "cp"))
        seen.append(rows(target.read().select("ref_id", "n_ref", "n_exist")))
    assert seen == [[("a", 1, 0), ("b", 1, 1)], [("a", 1, 1), ("b", 0, 0)], [("a", 1, 0), ("b", 0, 0)]]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, "i", None, "t", "", None)], "record_id int, item_id string, url_toanvan string, title string, so_hieu string, loai_van_ban string")
    body = json.loads(sinks.attribute_json(df).first().json)
    assert body == {"metadata": {"item_id": "i", "url_toanvan": None, "title": "t"}, "attributes": {"so_hieu": "", "loai_van_ban": None}}
    words = sinks.word_files(spark.createDataFrame([(1, "a\nb"), (2, None)], "id int, text string"), "id", "text").collect()
    assert [[b["text"] for b in files.docx_blocks(bytes(r.content))] for r in words] == [["a", "b"], ["(no content)"]]
    assert sinks.environment_report(spark)["pyspark"].startswith("4")
    packed = sinks.document_archives(spark.createDataFrame([(1, "b", b"2"), (1, "a", b"1")], "id int, name string, content binary"), "id").first()
    import io
    import zipfile

    assert zipfile.ZipFile(io.BytesIO(bytes(packed.content))).namelist() == ["a", "b"]


def test_word_files_from_html(spark):
    html = """<style>p {}</style><div align="center"><b>QUYẾT ĐỊNH</b></div><h2>Điều 1.</h2><p style="text-align: right">một <i>hai</i><br>ba &amp; 4</p>
    <ul><li>x<ol><li>y<li>z</ol></ul><table><tr><td>a<td><p>b</p><p>c</p></tr><tr><th>d<table><tr><td>e</td></tr></table></table>
    <div style="display: table"><div style="display:table-cell; text-align:center"><div>trái</div></div><div style="display:table-cell">phải</div></div><script>no</script>đuôi"""
    blocks = files.docx_blocks(sinks.html_docx_bytes(html, "Tên <1>"))
    texts = [(b["block_type"][:5], b["text"]) for b in blocks if b["text"].strip()]
    assert texts == [("parag", "Tên <1>"), ("parag", "QUYẾT ĐỊNH"), ("parag", "Điều 1."), ("parag", "một hai\nba & 4"), ("parag", "• x"), ("parag", "  1. y"), ("parag", "  2. z"), ("table", "a"), ("table", "b\nc"), ("table", "d\ne"), ("table", "trái"), ("table", "phải"), ("parag", "đuôi")]
    assert sorted((b["table_index"], b["row_index"], b["cell_index"]) for b in blocks if b["block_type"] == "table_cell") == [(0, 0, 0), (0, 0, 1), (0, 1, 0), (1, 0, 0), (1, 0, 1)]
    import io
    import zipfile

    xml = zipfile.ZipFile(io.BytesIO(sinks.html_docx_bytes(html))).read("word/document.xml").decode()
    assert '<w:jc w:val="center"/></w:pPr><w:r><w:rPr><w:b/>' in xml and '<w:jc w:val="right"/>' in xml and 'w:val="Heading2"' in xml and "<w:i/>" in xml
    for broken in ("", "<", "<table>", "<td>a</table>b", "<table><tr>", "</p></div>", "<li>x", "<table>x<tr><td>y", "\x00<p>\ud800"):
        files.docx_blocks(sinks.html_docx_bytes(broken))
    df = spark.createDataFrame([(1, "thô", "T", "<p>h</p>", "html"), (2, "thô", "T", "<p>h</p>", "raw_text"), (3, None, None, None, "attachments")], "id int, t string, title string, html string, how string")
    made = sinks.word_files(df, "id", "t", "title", "html", "how").collect()
    assert {r.id: [b["text"] for b in files.docx_blocks(bytes(r.content))] for r in made} == {1: ["T", "h"], 2: ["thô"], 3: ["(no content)"]}


def test_the_list_command_keeps_what_could_be_read(spark, tmp_path):
    from lexframe import cli

    for page in (1, 3):
        write(tmp_path / "in" / f"page_{page}.json", json.dumps({"data": {"total": 3, "items": [{"id": str(page), "title": "t"}]}}))
    write(tmp_path / "in" / "page_2.json", "{")
    call = ["list", "--source", str(tmp_path / "in"), "--out", str(tmp_path / "out"), "--page-size", "1"]
    assert cli.main([*call, "--all-pages"], spark) == 0
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("item_id")) == [("1",), ("3",)]
    assert rows(spark.read.parquet(str(tmp_path / "out_unread")).select("list_page")) == [(2,)]
    write(tmp_path / "in" / "page_2.json", json.dumps({"data": {"total": 3, "items": [{"id": "2", "title": "t"}]}}))
    assert cli.main([*call, "--pages", "2"], spark) == 0
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("item_id")) == [("1",), ("2",), ("3",)]


def test_legacy_word_files_by_an_office_program(spark, tmp_path):
    office = tmp_path / "office"
    write(office, '#!/bin/sh\nfor last; do :; done\nwhile [ "$1" != --outdir ]; do shift; done\ncase "$(cat "$last")" in bad*) echo broken >&2; exit 1;; slow*) sleep 20;; esac\ncp "$last" "$2/in.docx"\n')
    office.chmod(0o755)
    convert = files.OfficeConverter(str(office), timeout=3)
    write(tmp_path / "in" / "a" / "x.doc", sinks.docx_bytes(["cũ"]))
    write(tmp_path / "in" / "b" / "x.DOC", "bad")
    write(tmp_path / "in" / "c" / "x.doc", "slow")
    got = {r.document_id: (r.normalized_text, r.extraction_method, r.error) for r in files.read_documents(spark, str(tmp_path / "in"), convert).collect()}
    assert got["a"] == ("cũ", "converted_docx", None) and "broken" in got["b"][2] and "TimeoutExpired" in got["c"][2]
    assert "is needed" in files.extract("a/x.doc", b"", None, files.OfficeConverter("no such program"))["error"]


def test_nested_annotations(spark):
    articles = spark.createDataFrame([(1, 2, "7", "Điều 7"), (1, 1, "5", "Điều 5"), (2, 1, "1", None)], "id int, article_no int, article_number string, title string")
    tokens = spark.createDataFrame([(1, 1, 1, "Muối", "I-X", 3, 7), (1, 1, 0, "Bộ", "B-X", 0, 2), (1, 1, 2, "và", "O", 8, 10)], "id int, article_no int, token_no int, token string, tag string, start_char int, end_char int")
    entities = spark.createDataFrame([(1, 1, "Bộ Muối", "X", 0, 7)], "id int, article_no int, text string, label string, start_char int, end_char int")
    about = spark.createDataFrame([(1, "t", None)], "id int, title string, doc_number string")
    got = {r.id: json.loads(r.json) for r in sinks.annotation_json(articles, tokens, entities, "id", about).collect()}
    assert [a["article_number"] for a in got[1]["annotations"]] == ["5", "7"] and got[1]["metadata"] == {"title": "t", "doc_number": None}
    assert got[1]["annotations"][0]["entities"] == [{"text": "Bộ Muối", "label": "X", "start_char": 0, "end_char": 7, "tokens": ["Bộ", "Muối"], "bio_tags": ["B-X", "I-X"]}]
    assert [t["token"] for t in got[1]["annotations"][0]["token_annotations"]] == ["Bộ", "Muối", "và"] and got[1]["annotations"][1]["entities"] == []
    assert got[2] == {"metadata": None, "annotations": [{"article_number": "1", "article_title": None, "token_annotations": [], "entities": []}]}
    assert sinks.annotation_json(articles.limit(0), tokens, entities, "id").count() == 0
