"""Files of a collection: inventory, Word documents, JSON, CSV and text, read by executors."""

from __future__ import annotations

import hashlib
import io
import json
import re
import shutil
import subprocess
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..functions.normalize import normalize_with_offsets
from ..operators.collection import file_kind

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
BLOCK = T.StructType(
    [T.StructField(n, t) for n, t in (
        ("block_id", T.StringType()), ("block_type", T.StringType()), ("paragraph_index", T.IntegerType()), ("table_index", T.IntegerType()), ("row_index", T.IntegerType()),
        ("cell_index", T.IntegerType()), ("start_char", T.IntegerType()), ("end_char", T.IntegerType()), ("raw_start_char", T.IntegerType()), ("raw_end_char", T.IntegerType()), ("text", T.StringType()),
    )]
)
EXTRACTED = T.StructType(
    [T.StructField(n, t) for n, t in (
        ("document_id", T.StringType()), ("source_file", T.StringType()), ("source_sha256", T.StringType()), ("extraction_method", T.StringType()), ("raw_text", T.StringType()),
        ("normalized_text", T.StringType()), ("normalized_to_raw", T.ArrayType(T.IntegerType())), ("blocks", T.ArrayType(BLOCK)), ("error", T.StringType()),
    )]
)

#: Turns the bytes of a legacy Word file into those of a .docx.
Converter = Callable[[bytes], bytes]


@dataclass(frozen=True)
class OfficeConverter:
    """Converts by an office program that the worker has; fails where it has none, or where a file takes longer than `timeout` seconds.

    Each file is converted in a folder of its own, with a profile of its own, so tasks of one machine don't meet; nothing of it is
    needed afterwards. `read_cached_documents` keeps what was converted before.
    """

    program: str = "libreoffice"
    timeout: float = 120.0

    def __call__(self, data: bytes) -> bytes:
        if not shutil.which(self.program):
            raise ValueError(f"{self.program} is needed to read legacy Word files")
        with tempfile.TemporaryDirectory() as folder:
            source = Path(folder, "in.doc")
            source.write_bytes(data)
            call = [self.program, f"-env:UserInstallation=file://{folder}/profile", "--headless", "--convert-to", "docx", "--outdir", folder, str(source)]
            done = subprocess.run(call, capture_output=True, text=True, timeout=self.timeout, check=False)
            made = Path(folder, "in.docx")
            if done.returncode or not made.exists():
                raise ValueError(f"conversion failed: {done.stderr.strip()[:500]}")
            return made.read_bytes()


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, relative_path, name, extension, kind, size_bytes, readable, error) of all files below a folder.

    JSON files are parsed to see whether they can be read; of the others the content isn't looked at. Files without a
    byte are left out, as the source skips them.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    path = F.regexp_replace("path", "^file:/*", "/")
    root = re.sub("^file:/*", "/", folder).rstrip("/") + "/"
    content = F.when(F.lower("path").endswith(".json"), F.try_validate_utf8(F.decode("content", "UTF-8")))
    bad = F.lower("path").endswith(".json") & F.try_parse_json(F.regexp_replace(content, "^\ufeff", "")).isNull()
    return files.select(
        path.alias("path"), F.replace(path, F.lit(root), F.lit("")).alias("relative_path"), F.regexp_extract(path, "([^/]*)$", 1).alias("name"), X.extension(path).alias("extension"),
        file_kind(path).alias("kind"), F.col("length").alias("size_bytes"), (~bad).alias("readable"), F.when(bad, "not JSON").otherwise("").alias("error"),
    )


def file_item_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(directory, name, kind, item_id) for `pair_files`: the id that an attribute or relation file names."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    path = F.regexp_replace("path", "^file:/*", "/")
    parsed = F.when(file_kind(path).isin("attribute_json", "schema_json"), F.try_parse_json(F.regexp_replace(F.decode("content", "UTF-8"), "^\ufeff", "")))
    item = X.name_of(F.try_variant_get(parsed, "$.metadata.item_id", "string"), F.try_variant_get(parsed, "$.current_document.item_id", "string"))
    return files.select(F.regexp_extract(path, "^(.*)/[^/]*$", 1).alias("directory"), F.regexp_extract(path, "([^/]*)$", 1).alias("name"), file_kind(path).alias("kind"), item.alias("item_id"))


def discover_inputs(spark: SparkSession, folder: str) -> DataFrame:
    """(path, document_id) of Word files, one for each content path; the parent's name stands for files called `source` or `noi_dung`."""
    rows = list_files(spark, folder).where("kind = 'word'")
    stem, parent = X.stem(F.col("path")), X.parent(F.col("path"))
    return rows.select("path", F.when(F.lower(stem).isin("source", "noi_dung"), parent).otherwise(stem).alias("document_id"))


# --- Word ---------------------------------------------------------------------------------------


def _paragraph(p: ElementTree.Element) -> str:
    out = []
    for node in p.iter():
        if node.tag == _W + "t":
            out.append(node.text or "")
        elif node.tag == _W + "tab":
            out.append("\t")
        elif node.tag in (_W + "br", _W + "cr"):
            out.append("\n")
    return "".join(out)


def docx_blocks(data: bytes) -> list[dict]:
    """The blocks of a .docx in the order of its body, headers and footers last; empty paragraphs count but are blank."""
    archive = zipfile.ZipFile(io.BytesIO(data))
    body = ElementTree.fromstring(archive.read("word/document.xml")).find(_W + "body")
    blocks: list[dict] = []
    paragraph = table = 0
    for node in body if body is not None else []:
        if node.tag == _W + "p":
            blocks.append({"block_type": "paragraph", "paragraph_index": paragraph, "text": _paragraph(node)})
            paragraph += 1
        elif node.tag == _W + "tbl":
            for r, row in enumerate(node.iter(_W + "tr")):
                for c, cell in enumerate(row.iter(_W + "tc")):
                    lines = [t for p in cell.iter(_W + "p") if (t := _paragraph(p)).strip()]
                    blocks.append({"block_type": "table_cell", "table_index": table, "row_index": r, "cell_index": c, "text": "\n".join(lines)})
            table += 1
    for kind in ("header", "footer"):
        for name in sorted(n for n in archive.namelist() if re.fullmatch(rf"word/{kind}\d*\.xml", n)):
            blocks += [{"block_type": kind, "text": _paragraph(p)} for p in ElementTree.fromstring(archive.read(name)).iter(_W + "p")]
    return blocks


def extract(path: str, data: bytes, document_id: str | None = None, convert: Converter | None = None) -> dict:
    """One document: normalized text with the raw place of each character, and its blocks with their offsets.

    A block is normalized, dropped when blank, and joined to the others by line breaks; its id is its number before
    blank ones go. Errors are given in `error` with all else empty.
    """
    out = {"document_id": document_id or (path.rsplit("/", 2)[-2] if "/" in path else path), "source_file": path, "source_sha256": hashlib.sha256(data).hexdigest(), "error": None}
    try:
        if path.lower().endswith(".doc"):
            if convert is None:
                raise ValueError("no converter for legacy Word files is configured")
            data, method = convert(data), "converted_docx"
        else:
            method = "docx"
        raw, text, offsets, blocks = [], [], [], []
        raw_at = at = 0
        for number, block in enumerate(docx_blocks(data)):
            source = block["text"]
            clean, places = normalize_with_offsets(source)
            if clean.strip():
                if text:
                    offsets.append(raw_at - 1 if raw_at else 0)
                    at += 1
                blocks.append({"block_id": f"b{number:05d}", "start_char": at, "end_char": at + len(clean), "raw_start_char": raw_at, "raw_end_char": raw_at + len(source), **block, "text": clean})
                text.append(clean)
                offsets += [raw_at + i for i in places]
                at += len(clean)
            raw.append(source)
            raw_at += len(source) + 1
        return out | {"extraction_method": method, "raw_text": "\n".join(raw), "normalized_text": "\n".join(text), "normalized_to_raw": offsets, "blocks": [{f.name: b.get(f.name) for f in BLOCK} for b in blocks]}
    except Exception as e:  # a broken file is a row with its error, not the end of the job
        return out | {"extraction_method": None, "raw_text": None, "normalized_text": None, "normalized_to_raw": None, "blocks": None, "error": f"{type(e).__name__}: {e}"}


def read_documents(spark: SparkSession, folder: str, convert: Converter | None = None) -> DataFrame:
    """Every Word file below a folder, extracted; see `extract`. Rows in error are the rejects."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    files = files.where(F.lower("path").rlike(r"[^./]\.docx?$")).select(F.regexp_replace("path", "^file:/*", "/").alias("path"), "content")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame([extract(p, bytes(c), None, convert) for p, c in zip(part["path"], part["content"])], columns=EXTRACTED.names)

    return files.mapInPandas(run, EXTRACTED)


def read_cached_documents(spark: SparkSession, folder: str, cache: DataFrame, convert: Converter | None = None) -> DataFrame:
    """Documents from the cache where the file's hash is the same, others extracted anew."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    files = files.where(F.lower("path").rlike(r"[^./]\.docx?$")).select(F.regexp_replace("path", "^file:/*", "/").alias("path"), "content", F.sha2("content", 256).alias("sha"))
    known = cache.where("error is null").select("source_file", "source_sha256").distinct()
    same = (F.col("path") == F.col("source_file")) & (F.col("sha") == F.col("source_sha256"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame([extract(p, bytes(c), None, convert) for p, c in zip(part["path"], part["content"])], columns=EXTRACTED.names)

    anew = files.join(known, same, "left_anti").select("path", "content").mapInPandas(run, EXTRACTED)
    kept = cache.join(files.select("path", "sha"), same, "left_semi")
    return kept.select(*EXTRACTED.names).unionByName(anew)


# --- text formats -------------------------------------------------------------------------------


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a JSON-lines file: blank lines are skipped, lines that aren't objects are rejects."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    readable = F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT")
    fields = schema if isinstance(schema, str) else schema.simpleString()
    rows = lines.where(F.coalesce(readable, F.lit(False))).select(F.from_json("value", fields).alias("r")).select("r.*")
    return rows, lines.where(~F.coalesce(readable, F.lit(False)))


def read_key_set(spark: SparkSession, path: str) -> DataFrame:
    """The distinct lines of a text file, trimmed, without blank ones."""
    return key_set(spark.read.text(path), "value")


def key_set(df: DataFrame, column: str) -> DataFrame:
    """(key): the distinct values of a column, trimmed, without null and blank ones."""
    return df.select(F.trim(column).alias("key")).where("key <> ''").distinct()


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, all strings, with or without a byte order mark."""
    df = spark.read.option("header", True).option("encoding", "UTF-8").option("multiLine", True).option("escape", '"').csv(path)
    return df.toDF(*[c.lstrip("\ufeff") for c in df.columns])


def first_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first n rows in an explicit order."""
    return df.orderBy(*order).limit(n)


def read_exported_ids(spark: SparkSession, folder: str, types: list[str] | None = None) -> DataFrame:
    """(item_id, type_dir) of exported attribute files in `<folder>/<type>/<document>/thuoc_tinh.json`; only the types' folders are listed."""
    paths = [f"{folder}/{t}/*/thuoc_tinh.json" for t in types] if types else [f"{folder}/*/*/thuoc_tinh.json"]
    rows = spark.read.format("binaryFile").option("ignoreMissingFiles", "true").load(paths)
    return exported_ids(rows.select(F.decode("content", "UTF-8").alias("json"), F.regexp_extract("path", "([^/]+)/[^/]+/[^/]+$", 1).alias("type_dir")))


def exported_ids(exports: DataFrame) -> DataFrame:
    """(item_id, type_dir), distinct, of exported attributes (json, type_dir); unreadable ones and those without an id give none."""
    parsed = F.try_parse_json(F.regexp_replace("json", "^\ufeff", ""))
    return exports.select(F.try_variant_get(parsed, "$.metadata.item_id", "string").alias("item_id"), "type_dir").where("item_id <> ''").distinct()


def read_predictions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(entities, rejects) of the result files below a folder, one JSON document each.

    entities: (document_id, label, text, start_char, end_char, confidence); rejects: paths that can't be read. A document
    with several files is taken from the one changed last.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(folder)
    parsed = F.from_json(F.decode("content", "UTF-8"), "document_id string, entities array<struct<label:string,text:string,start_char:int,end_char:int,confidence:double,source:string>>")
    rows = files.select("path", "modificationTime", parsed.alias("r"), F.schema_of_variant(F.try_parse_json(F.decode("content", "UTF-8"))).alias("shape"))
    good = F.coalesce(F.col("shape").startswith("OBJECT"), F.lit(False)) & F.col("r.document_id").isNotNull()
    w = Window.partitionBy("r.document_id").orderBy(F.desc("modificationTime"), F.desc("path"))
    latest = rows.where(good).withColumn("_n", F.row_number().over(w)).where("_n = 1")
    return latest.select("r.document_id", F.explode("r.entities").alias("e")).select("document_id", "e.*"), rows.where(~good).select("path")


def load_config(path: str, required: tuple[str, ...] = ("model_name", "max_length", "stride", "confidence_threshold")) -> dict:
    """A JSON or YAML configuration; raises where a required key is missing."""
    with open(path, encoding="utf-8-sig") as f:
        text = f.read()
    try:
        config = json.loads(text)
    except ValueError:
        import yaml

        config = yaml.safe_load(text) or {}
    missing = [k for k in required if k not in config]
    if missing:
        raise ValueError(f"the configuration lacks {', '.join(missing)}")
    return config


def config_hash(config: dict) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True).encode()).hexdigest()
