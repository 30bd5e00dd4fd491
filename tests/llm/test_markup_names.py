"""Markup, look-alikes and names on written cases."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from lexframe.llm import lookalikes as L
from lexframe.llm import markup as M
from lexframe.llm import names as N

HTML = """<style>h2 { } li:before { content: '- ' }</style><script>var q = "<h2>no</h2>";</script><!-- <h3>no</h3> -->
<div id=a><div><P title="a > b">x<H2>Quyết&nbsp;<B>định</B><br/>1</H2><ul><li>một <b>hai</b>
<ul><li>con 1<li>con&#32;2</ul></li><LI>ba \\(a_1 \\le 2\\)</ul><pre><code>a &lt;b&gt;
  c</code></pre><script type="math/tex; mode=display">x^2</script><p>$$y = 1$$ giá 5 $ và 6 $</p></div></div>"""
LATEX = r"""\documentclass{article}
\begin{document}
\section*{Điều \textbf{1}. \href{u}{Phạm vi} {\bf A}} % \section{no}
Giá 5\% \$ \[ a^2 \] và $b$.
\begin{itemize}
\item một \emph{hai}\footnote{x}
\begin{enumerate} \item con \end{enumerate}
\item ba
\end{itemize}
\begin{verbatim}
% \item no
x = {1}
\end{verbatim}
\end{document}"""
WIKI = """==Điều [[Trang|một]]==
*một '''hai'''<ref>no</ref>
** con
# [https://x y ba] &lt;
:<math display="block">a = b</math>
<source lang="x">
* no
</source>
{| class="wikitable"
* no
|}
==== Hai ====
"""
MARKDOWN = """Tiêu đề *một*
=====

### Điều 1. **Hai** ###

- một __hai__ [ba](http://x) \\* \\[88\\]
  - con
1. bốn
tiếp

```xml
# no
```

$$
a \\ge b
$$

Số 5 \\$ và $x_1$ cho 6 \\$, a * b
Chương
---
"""


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        (HTML, [("heading", "Quyết định 1"), ("list_item", "một hai"), ("list_item", "con 1"), ("list_item", "con 2"), ("list_item", "ba a_1 \\le 2"), ("formula", "a_1 \\le 2"), ("code", "a <b> c"), ("formula", "x^2"), ("formula", "y = 1")]),
        (LATEX, [("heading", "Điều 1. Phạm vi A"), ("formula", "a^2"), ("formula", "b"), ("list_item", "một hai"), ("list_item", "con"), ("list_item", "ba"), ("code", "% \\item no x = {1}")]),
        (WIKI, [("heading", "Điều một"), ("list_item", "một hai"), ("list_item", "con"), ("list_item", "y ba <"), ("formula", "a = b"), ("code", "* no"), ("heading", "Hai")]),
        (MARKDOWN, [("heading", "Tiêu đề một"), ("heading", "Điều 1. Hai"), ("list_item", "một hai ba * [88]"), ("list_item", "con"), ("list_item", "bốn tiếp"), ("code", "# no"), ("formula", "a \\ge b"), ("formula", "x_1"), ("heading", "Số 5 $ và x_1 cho 6 $, a * b Chương")]),
        ("<p>một</p><h2>Hai</h2>\n\n### Ba\n\n- bốn\n", [("heading", "Hai"), ("heading", "Ba"), ("list_item", "bốn")]),
        ("<h2>Hai</h2>\n\n==Ba==\n*bốn ''năm''\n", [("heading", "Hai"), ("heading", "Ba"), ("list_item", "bốn năm")]),
        ("SỞ A\nSố: 1/2\n\nĐiều 1. Nội dung, a < b và 5 $.", []),
        ("", []), (None, []), (" \n ", []), ("<", []), ("<ul><li>", []), ("\\begin{itemize}\\item", []), ("```", []),
    ],
)
def test_elements(source, expected):
    assert sorted(M.elements(source)) == sorted(expected)


def test_wiki_tables():
    table = """== Biểu ==
{| class="wikitable"
|+ Mức '''phí'''
|-
! Tên !! colspan="2" | Mức
|- style="x"
| một || align=right | 5 <math>a|b</math>
|
* hai
** con
=== Trong ===
{|
| [[Trang|sâu]] || x | y
|}
| <source lang="x">
k = 1
</source>
| ba

cuối
|}
Sau"""
    assert M.elements(table) == [("heading", "Biểu"), ("formula", "a|b"), ("list_item", "hai"), ("list_item", "con"), ("heading", "Trong"), ("code", "k = 1")]
    assert M.clean_text(table).split("\n") == ["# Biểu", "Mức phí", "Tên", "Mức", "một", "5 a|b", "- hai", "  - con", "# Trong", "sâu", "x | y", "```", "k = 1", "```", "ba", "cuối", "Sau"]
    open_end = "== A ==\n{|\n| một\n{|\n| hai\n|}\n\n== B ==\n* ba <math>c</math>\n{|\n! bốn\n== C ==\nhết"
    assert M.clean_text(open_end).split("\n") == ["# A", "một", "hai", "# B", "- ba c", "bốn", "# C", "hết"]
    assert [k for k, _ in M.elements(open_end)] == ["heading", "heading", "list_item", "formula", "heading"]
    for source in ("== A ==\n" + "{|\n| x\n" * 3_000, "== A ==\n" + "{|\n| x\n" * 2_000 + "|}\n" * 2_000, "== A ==\n{|\n|" + " a=b" * 20_000 + " ' | x"):
        assert "x" in M.clean_text(source)


def test_emphasis():
    cases = {"**a** b": "a b", "*a b*": "a b", "***a***": "a", "a*b*c": "abc", "snake_case_x _y_": "snake_case_x y", "2 * 3 * 4": "2 * 3 * 4", "*a": "*a", "**a *b* c**": "a b c", "__a__ ~~b~~": "a b", "** a **": "** a **", "a_": "a_"}
    for raw, clean in cases.items():
        assert M._without_emphasis(raw) == clean, raw


def test_blocks_of_links_are_left_out():
    menu = "<div><ul>" + "".join(f'<li><a href="{i}">mục {i} của trang này</a></li>' for i in range(9)) + "</ul></div>"
    body = "<div><h1>Một</h1><p>" + "Nội dung, dài, của bài. " * 9 + '</p><ul><li>điều <a href="x">này</a> giữ lại</li></ul></div>'
    got = M.elements(menu + body)
    assert got == [("heading", "Một"), ("list_item", "điều này giữ lại")]
    assert M.clean_text(menu + body).startswith("# Một") and M.clean_text(None) is None and M.clean_text("") == ""


SENTENCE = "Điều này quy định, theo luật, các mức phí, lệ phí và thời hạn nộp hồ sơ của tổ chức. "
FOOTER = "Bản quyền thuộc cổng thông tin, ghi rõ nguồn khi dùng lại, giấy phép số 12."
COMMENTS = "".join(f"<p>Cảm ơn bài viết số {i}, rất hữu ích, mong có thêm.</p>" for i in range(3))
ARTICLE = "<h1>Thông tư</h1>" + "".join(f"<p>{SENTENCE * 3}</p>" for _ in range(8))
LINKS = "<ul>" + "".join(f'<li><a href="{i}">chuyên mục số {i}</a></li>' for i in range(6)) + "</ul>"


@pytest.mark.parametrize(
    "page",
    [
        f"<div>{LINKS}</div><div>{ARTICLE}</div><div><p>{FOOTER}</p></div><div>{COMMENTS}</div>",  # told by links beside it
        f'<div class="page"><div>{ARTICLE}</div><div class="list-comments">{COMMENTS}</div><footer><p>{FOOTER}</p></footer></div>',  # told by names
        f"<nav>{LINKS}</nav><main><section>{ARTICLE}</section><aside><p>{FOOTER}</p></aside></main><form>{COMMENTS}</form>",
        f"<div><div><div>{LINKS}</div><div><div>{ARTICLE}</div></div></div><div>{COMMENTS}</div></div><footer><p>{FOOTER}</p></footer>",
    ],
)
def test_the_frame_of_a_page_is_left_out(page):
    text, everything = M.clean_text(page), M.elements(page, whole=True)
    assert text.startswith("# Thông tư") and text.count("Điều này quy định") == 24
    assert "chuyên mục" not in text and "Bản quyền" not in text and "hữu ích" not in text
    assert len(everything) > len(M.elements(page)) or "<li>" not in page  # elements are those of the whole page


def test_fragments_keep_what_stands_beside_the_best_container():
    assert "Nơi nhận" in M.clean_text(f"<div>{ARTICLE}</div><table><tr><td>Nơi nhận: Lưu VT.</td><td>KT. BỘ TRƯỞNG</td></tr></table>")
    assert "Lời đầu" in M.clean_text(f"<div><p>Lời đầu.</p></div><div>{ARTICLE}</div>")
    assert M.clean_text(f'<div class="comments">{COMMENTS}</div>').count("hữu ích") == 3  # nothing better is there


def test_pages_nested_deeply():
    for depth in (3_000, 20_000):
        page = "<div>" * depth + f"<p>{SENTENCE}<ul><li>một" + "</div>" * depth
        assert M.elements(page) == [("list_item", "một")] and SENTENCE.strip() in M.clean_text(page)
    assert M.clean_text("<p>x<blockquote>" * 4_000).count("x") == 4_000
    assert M.elements("<ul><li>a" * 3_000, whole=True) == [("list_item", "a")] * 3_000


def test_long_and_broken_markup_ends():
    for source in ("<div>" * 800 + "x", "*" * 20_000, "[" * 5_000, "$" * 5_001, "<p " * 3_000, "{" * 3_000 + "\\textbf{", "a_" * 5_000 + "\n- x", "> " * 3_000, "''" * 3_000 + "\n* x", "*a " * 100_000, "- " + "_a " * 100_000, "a**b " * 50_000, "~~x " * 50_000):
        M.elements(source)


def test_markup_of_rows(spark):
    df = spark.createDataFrame([(1, "<h1>a</h1><h1>a</h1>", "x"), (2, None, None), (3, "", "")], "record_id bigint, content_html string, kind string")
    assert [tuple(r) for r in M.markup_elements(df).collect()] == [(1, 1, "heading", "a", True), (1, 2, "heading", "a", True)]
    assert [tuple(r) for r in M.markup_texts(df).orderBy("record_id").collect()] == [(1, "# a\n# a"), (2, None), (3, "")]
    assert M.markup_elements(df.limit(0)).count() == 0


def test_rows_have_the_elements_of_link_blocks(spark):
    source = '<div><ul><li><a href="1">văn bản liên quan số 1</a></li></ul></div><div><h1>Một</h1><p>' + "Nội dung, dài, của bài. " * 9 + "</p></div>"
    df = spark.createDataFrame([(1, source)], "record_id bigint, content_html string")
    assert [(r.kind, r.content, r.kept) for r in M.markup_elements(df).collect()] == [("list_item", "văn bản liên quan số 1", False), ("heading", "Một", True)]
    assert "liên quan" not in M.markup_texts(df).first().text


# --- look-alikes --------------------------------------------------------------------------------


def test_consistent_form():
    cases = {
        "Ｔｒầｎ　Ａ": "Trần A", "Ngu​yễ­n": "Nguyễn", "a b c\td\ne": "a b c d\ne", "Ðỗ Ɖức ðề ɖi": "Đỗ Đức đề đi", "Trаn На": "Tran На",
        "Гидролес η": "Гидролес η", "m² ½ № ℃ “x” – …": "m² ½ № ℃ “x” – …", "ế": "ế", "": "", "a\r\nb": "a\r\nb", "СОOP": "COOP", "Нải": "Hải",
    }
    for raw, clean in cases.items():
        assert L.consistent(raw) == clean, raw
        assert L.consistent(clean) == clean
    assert L.consistent("Tа̉i") == unicodedata.normalize("NFC", "Tải")


def test_script_sets():
    assert L.token_scripts("abc")[0] == "single" and L.token_scripts("сор")[0] == "whole" and L.token_scripts("Сop")[0] in ("mixed", "blend") and L.token_scripts("Гop")[0] == "blend" and L.token_scripts("12")[0] == "single"


def test_values_that_differ(spark):
    df = spark.createDataFrame([(1, "Ａ", "b", None), (2, None, "", "x​"), (1, "Ａ", "b", None)], "record_id bigint, signer string, clean string, full_text string")
    assert sorted(map(tuple, L.consistent_values(df, "record_id", ["signer", "full_text"]).collect())) == [(1, "signer", "A"), (1, "signer", "A"), (2, "full_text", "x")]
    assert L.consistent_values(df.limit(0), "record_id", ["signer"]).count() == 0


# --- names --------------------------------------------------------------------------------------


def test_canonical_tokens():
    same = {"Nguyeenx": "Nguyễn", "Tra6n2": "Trần", "D9o64": "Đỗ", "ddieeuf": "Điều", "truwowngr": "trưởng", "THỦY": "thuỷ", "Traѕc".replace("ѕ", "s"): "Trác", "lí": "lý"}
    for typed, name in same.items():
        assert N.canonical(typed) == N.canonical(name), typed


def test_subsequences_against_the_table():
    rnd = random.Random(2)
    for _ in range(300):
        a, b = ("".join(rnd.choice("abc") for _ in range(rnd.randint(0, 12))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        assert N.lcs(a, b) == row[-1]


def test_linking(spark):
    officials = spark.createDataFrame(
        [("P1", "Trần Tuấn Đoan", "A1", "T1"), ("P2", "Lê Văn Xuân Lữ", "A1", "T2"), ("P3", "Trần Tuấn Đoan", "A2", "T2"), ("P4", "Hồ Bá Ấn", "A2", "T1"), ("P5", None, "A1", "T1")], "person_id string, full_name string, agency_id string, title_id string"
    )
    agencies = spark.createDataFrame([("A1", "Bộ Thủy văn và Đê điều", "BTVĐĐ"), ("A2", "Sở Địa bạ tỉnh Lâm Vụ", None), ("A3", "Sở Địa bạ tỉnh Yên Mạc", None)], "agency_id string, name string, short_name string")
    titles = spark.createDataFrame([("T1", "Bộ trưởng"), ("T2", "Thứ trưởng")], "title_id string, title string")
    typed = [
        (1, "Trần Tuấn Đoan", "Bộ Thủy văn và Đê điều", "Bộ trưởng"), (2, "TRAN TUAN DOAN", "BTVĐĐ", "bo truong"), (3, "Tra6n2 Tua61n D9oan", "Sở Địa bạ T. Lâm Vụ", "Thứ trưỡng"), (4, "L.V.X.Lữ", "btvdd", "KT. BỘ TRƯỞNG\nTHỨ TRƯỞNG"),
        (5, "Lữ, Lê Văn Xuân", None, "--"), (6, "ChịẤn", "Tỉnh Lâm Vụ - Sở Địa bạ", ""), (7, "ThS.Hồ Bá Ấn", "Sở Địa bạ tỉnh Lâm Vj", None), (8, "Trần Tuấn Đoan", None, None), (9, "Ngô Ai", "Sở Địa bạ tỉnh Bạch Lưu", "Tổ trưởng"),
        (10, None, "", "--"), (11, "", None, None), (12, "x" * 5_000, "y" * 5_000, "z" * 5_000), (13, "Hồ Ấn (Út)", "Sở Địa bạ Lâm Vụ", "Bộ trưởng"), (1, "Trần Tuấn Đoan", "Bộ Thủy văn và Đê điều", "Bộ trưởng"),
    ]
    docs = spark.createDataFrame([(*t, "?") for t in typed], "record_id bigint, signer string, issuer string, signer_title string, name string")
    got = {(r.record_id, r.field): r.entity_id for r in N.link_documents(docs, officials, agencies, titles).collect()}
    signer = {k[0]: v for k, v in got.items() if k[1] == "signer"}
    issuer = {k[0]: v for k, v in got.items() if k[1] == "issuer"}
    title = {k[0]: v for k, v in got.items() if k[1] == "signer_title"}
    assert signer == {1: "P1", 2: "P1", 3: "P3", 4: "P2", 5: "P2", 6: "P4", 7: "P4", 13: "P4"}
    assert issuer == {1: "A1", 2: "A1", 3: "A2", 4: "A1", 6: "A2", 7: "A2", 13: "A2"}
    assert title == {1: "T1", 2: "T1", 3: "T2", 4: "T2", 13: "T1"}
    for empty in ((docs.limit(0), officials, agencies, titles), (docs, officials.limit(0), agencies.limit(0), titles.limit(0))):
        assert N.link_documents(*empty).where(F.col("entity_id").isNotNull()).count() == 0


def test_signers_under_titles_without_entry(spark):
    officials = spark.createDataFrame([("P1", "Trần Tuấn Đoan", "A1", "T1"), ("P3", "Trần Tuấn Đoan", "A2", "T1"), ("P4", "Hồ Bá Ấn", "A2", "T1")], "person_id string, full_name string, agency_id string, title_id string")
    agencies = spark.createDataFrame([("A1", "Bộ Thủy văn và Đê điều", "BTVĐĐ"), ("A2", "Sở Địa bạ tỉnh Lâm Vụ", None)], "agency_id string, name string, short_name string")
    titles = spark.createDataFrame([("T1", "Bộ trưởng"), ("T2", "Thứ trưởng")], "title_id string, title string")
    typed = [
        (1, "TRẦN TUẤN ĐOAN", "Bộ Thủy văn và Đê điều", "Quyền Giám đốc kho"), (2, "Hồ Bá Ấn", None, "Tổ trưởng tổ kho"), (3, "Trần Tuấn Đoan", None, "Tổ trưởng tổ kho"), (4, "Hồ Bá Ân Anh", "Sở Địa bạ tỉnh Lâm Vụ", "Tổ trưởng tổ kho"),
        (5, "Hồ Bá Ấn", "Bộ Thủy văn và Đê điều", "Tổ trưởng tổ kho"),
    ]
    docs = spark.createDataFrame(typed, "record_id bigint, signer string, issuer string, signer_title string")
    got = {(r.record_id, r.field): r.entity_id for r in N.link_documents(docs, officials, agencies, titles).collect() if r.field != "issuer"}
    assert got == {(1, "signer"): "P1", (2, "signer"): "P4"}


def grown_register(spark, times, seed=4):
    """Registers of `times` 210 organisations and 2,000 persons with namesakes, and spellings of some of them."""
    rnd = random.Random(seed)
    syllables = [a + b for a in ("b", "ch", "d", "g", "h", "kh", "l", "m", "n", "ph", "qu", "r", "t", "th", "tr", "v", "x") for b in ("a", "an", "ang", "e", "iên", "inh", "o", "ong", "u", "ung", "ương", "uân")]
    place = lambda: " ".join(rnd.choice(syllables).capitalize() for _ in range(2))
    offices = [(f"A{i}", f"{rnd.choice(['Sở Tài chính', 'Sở Xây dựng', 'Ủy ban nhân dân', 'Hội đồng nhân dân', 'Cục Thuế'])} tỉnh {place()}", None) for i in range(210 * times)]
    given = [s.capitalize() for s in rnd.sample(syllables, 120)]
    people = [(f"P{i}", " ".join([rnd.choice(["Nguyễn", "Trần", "Lê", "Phạm", "Hoàng"]), rnd.choice(["Văn", "Thị", rnd.choice(given)]), rnd.choice(given), rnd.choice(given)]), f"A{rnd.randrange(len(offices))}", "T1") for i in range(2_000 * times)]
    office_of = {a: n for a, n, _ in offices}

    def slip(name):
        at = rnd.randrange(1, len(name) - 1)
        return name[:at] + name[at + 1 :] if name[at] != " " and name[at - 1] != " " else name + name[-1]

    def initials(name):
        *first, last = name.split()
        return ". ".join(w[0] for w in first) + ". " + last

    forms = [str.upper, slip, initials, lambda n: f"{n.split()[-1]}, {' '.join(n.split()[:-1])}", lambda n: "Ông " + n]
    rows, truth = [], {}
    for i, (person, name, office, _) in enumerate(rnd.sample(people, 1_500)):
        rows.append((i, forms[i % 5](name), slip(office_of[office]) if i % 3 else office_of[office], "Giám đốc"))
        truth[i] = person, office
    tables = (
        spark.createDataFrame(rows, "record_id bigint, signer string, issuer string, signer_title string"),
        spark.createDataFrame(people, "person_id string, full_name string, agency_id string, title_id string"),
        spark.createDataFrame(offices, "agency_id string, name string, short_name string"),
        spark.createDataFrame([("T1", "Giám đốc")], "title_id string, title string"),
    )
    return tables, truth


@pytest.mark.parametrize("times", [1, 10])
def test_recall_on_larger_registers(spark, times):
    tables, truth = grown_register(spark, times)
    got = N.resolve_documents(*tables).collect()
    for column, at in (("signer", 0), ("issuer", 1)):
        links = {r.record_id: r.entity_id for r in got if r.field == column}
        right = sum(links.get(i) == t[at] for i, t in truth.items())
        wrong = sum(links.get(i) not in (None, t[at]) for i, t in truth.items())
        print(times, column, right, wrong, len(truth), sum(r.n > 1 for r in got if r.field == column))
        assert right >= 0.96 * len(truth) and wrong <= 0.01 * len(truth)
