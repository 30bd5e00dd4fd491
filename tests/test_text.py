"""Text functions, and normalization that keeps offsets."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexframe.functions import normalize as N
from lexframe.functions import text as X


def values(spark, f, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_normalization_of_a_mixed_text():
    raw = "  Nghi\u0323 \r\n\r\n \u201cA\u201d \u2013 \u200bB \t C\n "
    text, places = N.normalize_with_offsets(raw)
    assert text == 'Ngh\u1ecb\n"A" - B C' and len(text) == len(places)
    assert raw[places[3]] == "i" and N.normalize_with_offsets("") == ("", [])


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a \n\r\t ​́é😀-–", max_size=40))
def test_normalization_keeps_order(raw):
    text, places = N.normalize_with_offsets(raw)
    assert len(text) == len(places) and places == sorted(places)
    assert not text.startswith(" ") and text == text.rstrip(" \n") and "  " not in text


def test_fast_path_equals_the_exact_one(spark):
    rows = ["a  b\n\n c ", "\n x", " ‘q’\r\n\r\n", "", "​", "a  b \n\t\n c", None, "x" * 50_000]
    assert values(spark, X.normalize_fast, rows) == [None if r is None else N.normalize_text(r) for r in rows]


def test_spans_map_back(spark):
    row = spark.createDataFrame([("  a ​b",)], "v string").select(N.normalized("v").alias("n")).select(N.span_to_raw(F.col("n.offsets"), F.lit(0), F.lit(3)).alias("s"), N.span_to_raw(F.col("n.offsets"), F.lit(2), F.lit(9)).alias("t")).first()
    assert tuple(row.s) == (2, 6) and row.t is None


def test_names_and_slugs(spark):
    assert values(spark, X.slug, ["Nghị định số 19/2018", "Đường", "", None, "...."]) == ["nghi-dinh-so-19-2018", "duong", "van-ban", "van-ban", "van-ban"]
    assert values(spark, X.safe_filename, ["19/2018/NĐ-CP", "__", None, "ăâ b"]) == ["19_2018_NĐ-CP", "untitled", "untitled", "ăâ_b"]
    assert values(spark, X.extension, ["a/b.DOCX", "a.b/c", ".x", "a/.x", ""]) == [".docx", "", "", "", ""]


def test_value_variants(spark):
    got = values(spark, X.value_variants, ["2018-01-05", "Nghị định số 19/2018/NĐ-CP; về việc", "--", "", None, "2018-13-45", "a / b"])
    assert got[0][:4] == ["2018-01-05", "05/01/2018", "5/1/2018", "ngày 5 tháng 1 năm 2018"]
    assert "Nghị định số 19/2018/NĐ-CP" in got[1]
    assert got[2:4] == [["//"], []] and got[4] in (None, []) and got[5] == ["2018-13-45", "2018/13/45"] and got[6] == ["a / b", "a/b", "a-b"]


def test_html(spark):
    page = '<script>var a="</p>";</script><p title="a > b">x<br/>y &amp; z</p><!-- <p>no</p> --><ul><li>1</li><li>1</li></ul>'
    assert values(spark, X.html_lines, [page, "", None]) == [["x", "y & z", "1"], [], []]


def test_predicates(spark):
    assert values(spark, X.is_signature_title, ["KT. BỘ TRƯỞNG", "Chủ tịch", "Nơi nhận: Bộ trưởng", "", "x" * 200]) == [True, True, False, False, False]
    assert values(spark, X.is_person_name, ["Trần Tuấn Đoan", "Trần", "trần đoan", "Bộ Trưởng A", "Trần 2 Đoan", None]) == [True, False, False, False, False, False]


def test_payloads(spark):
    assert values(spark, X.payload_bytes, ["YWI", "YWI=", "YQ", "", None]) == [b"ab", b"ab", b"a", b"", None]
    assert values(spark, X.hex_length, ["ff", "10"]) == [255, 16]
