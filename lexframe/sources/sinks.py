"""What is written: states, exports, reports, datasets and Word files."""

from __future__ import annotations

import io
import platform
import re
import sys
import zipfile
from collections.abc import Callable, Iterator
from html import escape as html_escape
from html.parser import HTMLParser
from importlib import metadata
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_TYPES = """<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/word/document.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"/></Types>"""
_RELS = """<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="word/document.xml"/></Relationships>"""
_EPOCH = (1980, 1, 1, 0, 0, 0)


def _packed(files: dict[str, bytes]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in files.items():
            z.writestr(zipfile.ZipInfo(name, _EPOCH), data)
    return out.getvalue()


def _legal(text: str) -> str:
    return escape("".join(c for c in text if c in "\t\n" or ord(c) >= 32 and c not in "\ufffe\uffff" and not 0xD800 <= ord(c) < 0xE000))


def _document(body: str) -> bytes:
    document = f'<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>'
    return _packed({"[Content_Types].xml": _TYPES.encode(), "_rels/.rels": _RELS.encode(), "word/document.xml": document.encode()})


def docx_bytes(lines: list[str]) -> bytes:
    """A .docx with a paragraph for each line; the same lines give the same bytes."""
    return _document("".join(f'<w:p><w:r><w:t xml:space="preserve">{_legal(line)}</w:t></w:r></w:p>' for line in lines))


class _Layout(HTMLParser):
    """HTML as the body of a Word document: headings, paragraphs with their alignment, emphasis, lists and tables.

    Blocks laid out as tables by style count as such; scripts, styles, frames and images are left out. A table in a cell becomes
    paragraphs of the cell.
    """

    _blocks = {"p", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "caption", "dt", "dd", "section", "article", "center"}
    _skipped = {"script", "style", "iframe", "head", "title", "object"}
    _sides = {"left": "left", "center": "center", "right": "right", "justify": "both"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.runs: list[str] = []
        self.open: list[tuple[str, str, str]] = []  # (tag, what it is laid out as, alignment)
        self.lists: list[list] = []
        self.skip = self.tables = 0
        self.mark = ""

    def _end_paragraph(self, empty: bool = False) -> None:
        text = "".join(self.runs)
        if text.strip() or empty:
            heading = next((t for t, _, _ in reversed(self.open) if len(t) == 2 and t[0] == "h" and t[1].isdigit()), "")
            side = next((s for _, _, s in reversed(self.open) if s), "")
            look = (f'<w:pStyle w:val="Heading{heading[1]}"/><w:outlineLvl w:val="{int(heading[1]) - 1}"/>' if heading else "") + (f'<w:jc w:val="{side}"/>' if side else "")
            mark = f'<w:r><w:t xml:space="preserve">{self.mark}</w:t></w:r>' if self.mark else ""
            self.out.append(f"<w:p>{f'<w:pPr>{look}</w:pPr>' if look else ''}{mark}{text}</w:p>")
            self.mark = ""
        self.runs.clear()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self._skipped:
            self.skip += 1
        if self.skip or tag in ("img", "input", "hr", "meta", "link", "wbr"):
            return
        if tag == "br":
            self.runs.append("<w:r><w:br/></w:r>")
            return
        given = dict(attrs)
        style = re.sub(r"\s", "", (given.get("style") or "").lower())
        side = self._sides.get((given.get("align") or "").lower()) or next((self._sides[s] for s in re.findall(r"text-align:(\w+)", style) if s in self._sides), "center" if tag == "center" else "")
        kind = {"table": "table", "tr": "row", "td": "cell", "th": "cell"}.get(tag) or ("table" if "display:table;" in style + ";" else "row" if "display:table-row" in style else "cell" if "display:table-cell" in style else "")
        if kind or tag in self._blocks or tag in ("ul", "ol"):
            self._end_paragraph()
        if kind == "table":
            self.tables += 1
            if self.tables == 1:
                self.out.append("<w:tbl>")
        elif kind in ("row", "cell") and self.tables == 1:
            inner = [k for _, k, _ in self.open]
            last = max((i for i, k in enumerate(inner) if k == "table"), default=0)
            for closed in ("cell", "row") if kind == "row" else ("cell",):
                if closed in inner[last:]:
                    self.handle_endtag(self.open[last + inner[last:].index(closed)][0])
            if kind == "cell" and "row" not in [k for _, k, _ in self.open][last:]:
                self.out.append("<w:tr>")
                self.open.append(("", "row", ""))
            self.out.append("<w:tr>" if kind == "row" else "<w:tc>")
        if tag in ("ul", "ol"):
            self.lists.append([tag, 0])
        elif tag == "li" and self.lists:
            self.lists[-1][1] += 1
            self.mark = "  " * (len(self.lists) - 1) + (f"{self.lists[-1][1]}. " if self.lists[-1][0] == "ol" else "• ")
        self.open.append((tag, kind, side))

    def _close(self, kind: str) -> None:
        if kind == "cell" and self.tables == 1:
            if self.out[-1] == "<w:tc>":
                self.out.append("<w:p/>")
            self.out.append("</w:tc>")
        elif kind == "row" and self.tables == 1:
            if self.out[-1] == "<w:tr>":
                self.out.append("<w:tc><w:p/></w:tc>")
            self.out.append("</w:tr>")
        elif kind == "table":
            if self.tables == 1:
                self.out.append("<w:tr><w:tc><w:p/></w:tc></w:tr></w:tbl>" if self.out[-1] == "<w:tbl>" else "</w:tbl>")
            self.tables -= 1

    def handle_endtag(self, tag: str) -> None:
        if tag in self._skipped:
            self.skip = max(0, self.skip - 1)
            return
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if self.skip or at is None:
            return
        if tag in self._blocks or tag in ("ul", "ol") or any(k for _, k, _ in self.open[at:]):
            self._end_paragraph()
        while len(self.open) > at:
            name, kind, _ = self.open.pop()
            self._close(kind)
            if name in ("ul", "ol") and self.lists:
                self.lists.pop()

    def handle_data(self, data: str) -> None:
        text = re.sub(r"\s+", " ", data)
        kinds = [k for _, k, _ in self.open if k]
        if self.skip or not text.strip() and not self.runs or self.tables == 1 and kinds and kinds[-1] != "cell":
            return  # white space between blocks, and text between the cells of a table
        tags = {t for t, _, _ in self.open}
        look = ("<w:b/>" if tags & {"b", "strong", "th", "h1", "h2", "h3", "h4", "h5", "h6"} else "") + ("<w:i/>" if tags & {"i", "em"} else "") + ('<w:u w:val="single"/>' if "u" in tags else "")
        self.runs.append(f"<w:r>{f'<w:rPr>{look}</w:rPr>' if look else ''}<w:t xml:space=\"preserve\">{_legal(text)}</w:t></w:r>")

    def body(self, html: str) -> str:
        self.feed(html)
        self.close()
        self._end_paragraph()
        while self.open:
            self._close(self.open.pop()[1])
        return "".join(self.out)


def html_docx_bytes(html: str, title: str | None = None) -> bytes:
    """A .docx of HTML, under its title as a heading where one is given."""
    head = _Layout().body(f"<h1>{html_escape(title)}</h1>") if title else ""
    body = _Layout().body(html)
    return _document(head + (body + "<w:p/>" if body.endswith("</w:tbl>") else body))


def word_files(df: DataFrame, key: str, text: str, title: str | None = None, html: str | None = None, strategy: str | None = None) -> DataFrame:
    """(key, content): each row as a Word file.

    Rows whose `strategy` (see `collection.export_strategy`) is ``html`` are laid out from the column `html` under their
    title; the others, and all without these columns, have a paragraph for each line of `text`. Null and empty texts give a
    file with a note.
    """
    kind = df.schema[key].dataType.simpleString()
    none = F.lit(None).cast("string")
    given = [F.col(c) if c else none for c in (key, text, title, html, strategy)]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            made = [html_docx_bytes(h, head) if how == "html" and h else docx_bytes((t or "(no content)").split("\n")) for t, head, h, how in zip(part["t"], part["head"], part["h"], part["how"])]
            yield pd.DataFrame({key: part["k"], "content": made})

    return df.select(*(c.alias(n) for c, n in zip(given, ("k", "t", "head", "h", "how")))).mapInPandas(run, f"`{key}` {kind}, content binary")


def document_archives(files: DataFrame, key: str) -> DataFrame:
    """(key, content): the files (key, name, content) of each document in one ZIP archive; bounded by a document's files."""
    kind = files.schema[key].dataType.simpleString()

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        rows = part.sort_values("name")
        return pd.DataFrame({key: [part[key].iloc[0]], "content": [_packed({n: bytes(c) for n, c in zip(rows["name"], rows["content"])})]})

    return files.select(key, "name", "content").groupBy(key).applyInPandas(pack, f"`{key}` {kind}, content binary")


def append_state(df: DataFrame, folder: str, kind: str = "parquet") -> None:
    """Rows added to a state table: processed keys, failures, or listed items."""
    df.write.mode("append").format(kind).save(folder)


def attribute_json(df: DataFrame) -> DataFrame:
    """(record_id, doc_type, json) of attribute rows as they are exported, with metadata and attributes apart."""
    inner = [c for c in df.columns if c not in ("record_id", "item_id", "url_toanvan", "title")]
    body = F.struct(F.struct("item_id", "url_toanvan", "title").alias("metadata"), F.struct(*inner).alias("attributes"))
    return df.select("record_id", F.col("loai_van_ban").alias("doc_type"), F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))


def relation_json(df: DataFrame) -> DataFrame:
    return df.select("record_id", F.to_json("relationship_graph", {"ignoreNullFields": "false"}).alias("json"))


def write_report(df: DataFrame, folder: str) -> None:
    """A report as CSV with a header; spreadsheet programs that want a byte order mark must be told UTF-8."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(folder)


def write_dataset(rows: DataFrame, manifest: DataFrame, vocabulary: DataFrame, folder: str) -> None:
    """The rows by split, the manifest and the label map."""
    rows.write.mode("overwrite").partitionBy("split").parquet(f"{folder}/rows")
    manifest.coalesce(1).write.mode("overwrite").json(f"{folder}/manifest")
    vocabulary.coalesce(1).write.mode("overwrite").json(f"{folder}/label_map")


def write_entities(entities: DataFrame, summary: DataFrame, failures: DataFrame, folder: str) -> None:
    """Entities, their summary by document and the documents that failed."""
    entities.write.mode("overwrite").parquet(f"{folder}/entities")
    write_report(summary, f"{folder}/summary")
    write_report(failures, f"{folder}/failures")


def annotation_json(articles: DataFrame, tokens: DataFrame, entities: DataFrame, key: str, metadata: DataFrame | None = None) -> DataFrame:
    """(key, json): the annotations of each document as one nested text: its metadata, its articles, and their tokens and entities.

    articles: (key, article_no, article_number, title); tokens: (key, article_no, token_no, token, tag, start_char, end_char); entities:
    (key, article_no, text, label, start_char, end_char), which get the tokens that they hold; metadata: (key, and what is
    known of a document). Articles without tokens or entities have empty lists. What is gathered is one document's.
    """
    by = [key, "article_no"]
    words = tokens.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("token_no", "token", "tag", "start_char", "end_char"))).alias("t"))
    found = entities.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("start_char", "end_char", "label", "text"))).alias("e"))
    rows = articles.select(*by, "article_number", "title").join(words, by, "left").join(found, by, "left")
    token = lambda x: F.struct(x["token"].alias("token"), x["tag"].alias("tag"), x["start_char"].alias("start_char"), x["end_char"].alias("end_char"))

    def entity(e: Column) -> Column:
        held = F.filter(F.col("t"), lambda x: (x["start_char"] >= e["start_char"]) & (x["end_char"] <= e["end_char"]))
        lists = (F.coalesce(F.transform(held, _field(n)), F.array().cast("array<string>")).alias(a) for n, a in (("token", "tokens"), ("tag", "bio_tags")))
        return F.struct(e["text"].alias("text"), e["label"].alias("label"), e["start_char"].alias("start_char"), e["end_char"].alias("end_char"), *lists)

    none = lambda c, kind: F.coalesce(c, F.array().cast(kind))
    annotation = F.struct(
        "article_no",
        F.col("article_number"),
        F.col("title").alias("article_title"),
        none(F.transform("t", token), "array<struct<token:string,tag:string,start_char:int,end_char:int>>").alias("token_annotations"),
        none(F.transform("e", entity), "array<struct<text:string,label:string,start_char:int,end_char:int,tokens:array<string>,bio_tags:array<string>>>").alias("entities"),
    )
    whole = rows.groupBy(key).agg(F.array_sort(F.collect_list(annotation), lambda a, b: a["article_no"] - b["article_no"]).alias("annotations"))
    about = F.struct(*(c for c in metadata.columns if c != key)) if metadata is not None else None
    whole = whole.join(metadata.select(key, about.alias("metadata")), key, "left") if about is not None else whole
    body = F.struct(*(["metadata"] if about is not None else []), F.transform("annotations", lambda a: a.dropFields("article_no")).alias("annotations"))
    return whole.select(key, F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))


def _field(name: str) -> Callable[[Column], Column]:
    return lambda x: x[name]


def environment_report(spark: SparkSession) -> dict[str, str]:
    """Versions and settings that a run depends on."""
    packages = {}
    for name in ("pyspark", "pyarrow", "pandas", "numpy", "tiktoken"):
        try:
            packages[name] = metadata.version(name)
        except metadata.PackageNotFoundError:
            packages[name] = "not installed"
    settings = {k: spark.conf.get(k, "") for k in ("spark.master", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.checkpoint.dir")}
    return {"python": sys.version.split()[0], "platform": platform.platform(), **packages, **settings}


def write_cache(documents: DataFrame, folder: str) -> None:
    """Extracted documents for `read_cached_documents`; a file's rows are found by its hash."""
    documents.write.mode("append").parquet(folder)
