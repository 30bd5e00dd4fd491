"""Listings, records and files of a collection: typing, naming, pairing, resuming and relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X

# Document types by id, their numbers in old links, relations by code as (outgoing, incoming).
TYPE_NAMES = {
    "hien_phap": "Hiến pháp", "bo_luat": "Bộ luật", "luat": "Luật", "phap_lenh": "Pháp lệnh", "nghi_dinh": "Nghị định", "thong_tu": "Thông tư",
    "quyet_dinh": "Quyết định", "lenh": "Lệnh", "nghi_quyet": "Nghị quyết", "nghi_quyet_lien_tich": "Nghị quyết liên tịch", "van_ban_hop_nhat": "Văn bản hợp nhất",
    "van_ban_hanh_chinh_lien_quan": "Văn bản hành chính liên quan", "ban_dich_van_ban": "Bản dịch văn bản", "chi_thi": "Chỉ thị", "van_ban_he_thong_hoa": "Văn bản hệ thống hóa",
    "chua_xac_dinh": "Chưa xác định", "thong_tu_lien_tich": "Thông tư liên tịch", "thong_tu_lien_bo": "Thông tư liên bộ", "cong_uoc": "Công ước", "thong_bao": "Thông báo",
    "van_ban_khac": "Văn bản khác", "sac_luat": "Sắc luật", "quy_dinh": "Quy định", "sac_lenh": "Sắc lệnh", "cong_van": "Công văn", "van_ban_lien_quan": "Văn bản liên quan",
}
TYPE_ALIASES = {"1": "luat", "2": "nghi_dinh", "3": "thong_tu", "4": "quyet_dinh", "5": "thong_tu_lien_tich", "6": "nghi_quyet", "7": "lenh", "8": "chi_thi", "10": "van_ban_hop_nhat"}
RELATIONS = {
    "1": ("Văn bản bị bãi bỏ", "Văn bản bãi bỏ"), "2": ("Bản dịch", "Bản dịch"), "3": ("Căn cứ ban hành", "Văn bản áp dụng"), "4": ("Văn bản được dẫn chiếu", "Văn bản dẫn chiếu"),
    "5": ("Văn bản bị đình chỉ thi hành", "Văn bản đình chỉ thi hành"), "6": ("Văn bản được đính chính", "Văn bản đính chính"), "7": ("Văn bản được hợp nhất", "Văn bản hợp nhất"),
    "8": ("Văn bản được hướng dẫn áp dụng", "Văn bản hướng dẫn áp dụng"), "9": ("Văn bản được quy định chi tiết, hướng dẫn thi hành", "Văn bản quy định chi tiết, hướng dẫn thi hành"),
    "10": ("Văn bản được sửa đổi bổ sung", "Văn bản sửa đổi bổ sung"), "11": ("Văn bản bị tạm ngưng hiệu lực", "Văn bản tạm ngưng hiệu lực"), "12": ("Văn bản được thay thế", "Văn bản thay thế"),
    "13": ("Văn bản được sửa đổi bổ sung", "Văn bản sửa đổi bổ sung"), "14": ("Văn bản được giải thích", "Văn bản giải thích"), "15": ("Văn bản được công bố", "Văn bản công bố"),
}
NO_NUMBER, NO_TYPE = "không số", "Khac"
UUID = "(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
LEGACY = "--([0-9]+)(?:[?#]|$)"
# End of the fixed values.


def canonical_type(c: Column) -> Column:
    """A type's id; the numbers of old links are resolved, unknown ones stay."""
    aliases = F.create_map(*[F.lit(x) for pair in TYPE_ALIASES.items() for x in pair])
    return F.coalesce(F.try_element_at(aliases, c), c, F.lit(""))


def _begins(folded: Column, name: str) -> Column:
    return (folded == name) | folded.startswith(name + " ") | folded.startswith(name + "-")


def type_predicates() -> dict[str, tuple[list[str], list[str]]]:
    """For each type the folded names that select it, and those of types whose name goes on where it ends."""
    from unicodedata import category, normalize

    folded = {k: "".join(c for c in normalize("NFD", v.lower()) if category(c) != "Mn").replace("đ", "d") for k, v in TYPE_NAMES.items()}
    return {k: ([n], [m for o, m in folded.items() if o != k and m.startswith(n + " ")]) for k, n in folded.items()}


def matches_type(doc_type: Column, title: Column, type_id: str) -> Column:
    """Whether a document is of a type, by its type's name or the start of its title, accents aside; any is, of an unknown type.

    A name that another type's name begins with doesn't take that type's documents.
    """
    wanted = TYPE_ALIASES.get(type_id, type_id)
    if wanted not in TYPE_NAMES:
        return F.lit(True)
    names, longer = type_predicates()[wanted]
    forms = [X.fold(doc_type), X.fold(title)]
    any_of = lambda ns: F.expr("false") if not ns else _or([_begins(f, n) for f in forms for n in ns])
    return ~any_of(longer) & any_of(names)


def _or(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def document_types(df: DataFrame, key: list[str]) -> DataFrame:
    """(key, type_id) for every type that a document matches; title and type are folded once."""
    folded = df.select(*key, X.fold(F.col("doc_type")).alias("_t"), X.fold(F.col("title")).alias("_h"))
    hits = []
    for type_id, (names, longer) in type_predicates().items():
        forms = [F.col("_t"), F.col("_h")]
        hit = _or([_begins(f, n) for f in forms for n in names])
        if longer:
            hit = hit & ~_or([_begins(f, n) for f in forms for n in longer])
        hits.append(F.when(hit, F.lit(type_id)))
    return folded.select(*key, F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())).alias("type_id"))


def item_id_of(item_id: Column, *urls: Column) -> Column:
    """A document's id: its own, or else the UUID or the digits after `--` in the first address that has one; empty without."""
    found = [F.nullif(item_id, F.lit(""))]
    for u in urls:
        found += [F.nullif(F.regexp_extract(u, UUID, 0), F.lit("")), F.nullif(F.regexp_extract(u, LEGACY, 1), F.lit(""))]
    return F.coalesce(*found, F.lit(""))


def document_key(item_id: Column, url_toanvan: Column, url: Column) -> Column:
    return X.name_of(item_id, url_toanvan, url)


def normalized_items(df: DataFrame) -> DataFrame:
    """List items with empty strings for nulls, the dates' heads, and their key."""
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    filled = df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c in texts else F.col(c) for c in df.columns])
    return filled.withColumn("issue_date", X.date_head(F.col("issue_date"))).withColumn("effective_date", X.date_head(F.col("effective_date"))).withColumn("item_key", document_key(F.col("item_id"), F.col("url_toanvan"), F.col("url")))


def latest_items(df: DataFrame, key: str = "item_id", order: tuple[str, ...] = ("crawled_at", "list_page")) -> DataFrame:
    """One row for each item: the one crawled last, by max over a struct rather than by a window, so a hot item is combined on the map side."""
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order, F.xxhash64(*rest))).alias("_r"))
    return best.select(key, "_r.*").select(*df.columns)


def page_counts(df: DataFrame, page_size: int) -> DataFrame:
    """(type_id, keyword, total, total_pages): the distinct items of each listing and the pages they fill; at least one."""
    sums = df.groupBy("type_id", "keyword").agg(F.countDistinct("item_id").alias("total"))
    return sums.select("type_id", "keyword", "total", F.greatest(F.ceil(F.col("total") / page_size), F.lit(1)).cast("bigint").alias("total_pages"))


def pending_items(listed: DataFrame, processed: DataFrame, exported: DataFrame, key: str = "item_id") -> DataFrame:
    """Keys still to fetch: listed, and not both processed and exported; null and empty keys are none."""
    done = processed.select(key).distinct().join(exported.select(key).distinct(), key, "left_semi")
    return listed.select(key).where(f"{key} <> ''").distinct().join(done, key, "left_anti")


def stale_items(processed: DataFrame, exported: DataFrame, key: str = "item_id") -> DataFrame:
    """Keys noted as processed whose export is gone."""
    return processed.select(key).where(f"{key} <> ''").distinct().join(exported.select(key).distinct(), key, "left_anti")


def folder_names(df: DataFrame, item: str = "item_id", number: str = "doc_number", kind: str = "doc_type", order: str = "ord") -> DataFrame:
    """(item, type_dir, folder): where a document's files go.

    The folder is the number, made safe, or `Khong_so_` and the id's head where there is none. The first
    document of a type keeps the name, later ones get `__` and twelve characters of their id.
    """
    raw = F.coalesce(F.col(number), F.lit(""))
    base = X.safe_filename(F.when((raw == "") | (F.lower(F.trim(raw)) == NO_NUMBER), F.concat(F.lit("Khong_so_"), F.substring(F.coalesce(F.col(item), F.lit("")), 1, 8))).otherwise(raw))
    rows = df.select(F.col(item), F.col(order).alias("_o"), F.when(F.coalesce(F.col(kind), F.lit("")) == "", NO_TYPE).otherwise(X.safe_filename(F.col(kind))).alias("type_dir"), base.alias("_base"))
    # the first of each name is found by a combinable minimum, not a window: a name that many share is no group in one task
    first = rows.groupBy("type_dir", "_base").agg(F.min(F.struct("_o", item)).alias("_first"))
    named = rows.join(first, ["type_dir", "_base"])
    own = (F.col("_first._o") == F.col("_o")) & (F.col(f"_first.{item}").eqNullSafe(F.col(item)))
    return named.select(item, "type_dir", F.when(own, F.col("_base")).otherwise(F.concat_ws("__", "_base", X.safe_filename(F.substring(F.coalesce(F.col(item), F.lit("")), 1, 12), "duplicate"))).alias("folder"))


def pair_files(files: DataFrame) -> DataFrame:
    """Word files with their attribute and relation files, by directory.

    files: (directory, name, kind, item_id) of kind `word`, `attribute_json` or `schema_json`. Result:
    (document_id, directory, word_file, attribute_json, schema_json, pairing_method, pairing_confidence, status).
    Several Word files of one directory get `__1`, `__2`... after the id, .docx before .doc.
    """
    info = files.groupBy("directory").agg(
        F.max(F.when(F.col("kind") == "attribute_json", F.col("name"))).alias("attribute_json"),
        F.max(F.when(F.col("kind") == "schema_json", F.col("name"))).alias("schema_json"),
        F.max(F.when(F.col("kind") == "attribute_json", F.nullif("item_id", F.lit("")))).alias("_a"),
        F.max(F.when(F.col("kind") == "schema_json", F.nullif("item_id", F.lit("")))).alias("_s"),
        F.sum((F.col("kind") == "word").cast("int")).alias("_n"),
    ).where("_n > 0 or attribute_json is not null or schema_json is not null")
    w = Window.partitionBy("directory").orderBy(F.lower("name").endswith(".docx").cast("int").desc(), "name")
    words = files.where("kind = 'word'").select("directory", F.col("name").alias("word_file"), F.row_number().over(w).alias("_i"))
    rows = info.join(words, "directory", "left")
    known = F.when(F.col("attribute_json").isNotNull(), F.col("_a")).otherwise(F.col("_s"))
    base = F.coalesce(known, X.stem(F.col("directory")))
    shared = known.isNotNull()
    status = F.when(F.col("word_file").isNull(), "unmatched").when(F.col("attribute_json").isNotNull() & F.col("schema_json").isNotNull(), "paired").otherwise("partial")
    return rows.select(
        F.when(F.col("_n") > 1, F.concat_ws("__", base, F.col("_i").cast("string"))).otherwise(base).alias("document_id"),
        "directory", "word_file", "attribute_json", "schema_json",
        F.when(shared, "shared_item_id_and_directory").otherwise("document_directory").alias("pairing_method"),
        F.when(F.col("word_file").isNull(), 0.0).when(shared, 1.0).otherwise(0.8).alias("pairing_confidence"),
        status.alias("status"),
    )


def relation_names(spark: SparkSession) -> DataFrame:
    """(code, direction, relation_type): the thirty kinds of relations."""
    rows = [(code, d, names[i]) for code, names in RELATIONS.items() for i, d in enumerate(("outgoing", "incoming"))]
    return spark.createDataFrame(rows, "code string, direction string, relation_type string")


def relation_graph(diagram_edges: DataFrame, records: DataFrame, key: str = "record_id") -> DataFrame:
    """(key, code, direction, relation_type, n_documents, documents): all thirty relations of every record, empty ones too.

    diagram_edges: (key, code, direction, place, id). The thirty kinds are exploded from a literal, so only the
    edges are shuffled.
    """
    rows = [(code, d, names[i]) for code, names in RELATIONS.items() for i, d in enumerate(("outgoing", "incoming"))]
    kinds = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(d).alias("direction"), F.lit(n).alias("relation_type")) for c, d, n in rows])
    every = records.select(key, F.explode(kinds).alias("k")).select(key, "k.*")
    found = diagram_edges.groupBy(key, "code", "direction").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "id"))), lambda x: x["id"]), ",").alias("documents"), F.count("*").alias("n_documents"))
    return every.join(found, [key, "code", "direction"], "left").select(key, "code", "direction", "relation_type", F.coalesce("n_documents", F.lit(0)).alias("n_documents"), F.coalesce("documents", F.lit("")).alias("documents"))


def file_kind(path: Column) -> Column:
    name = F.lower(F.regexp_extract(path, "([^/]*)$", 1))
    return F.when(name.rlike(r"[^.]\.docx?$"), "word").when(name == "thuoc_tinh.json", "attribute_json").when(name == "luoc_do.json", "schema_json").when(name.rlike(r"[^.]\.json$"), "other_json").otherwise("other")


def inventory_summary(files: DataFrame) -> DataFrame:
    """(kind, n_files, size_bytes, n_unreadable) of files (path, size_bytes, readable)."""
    return files.groupBy(file_kind(F.col("path")).alias("kind")).agg(F.count("*").alias("n_files"), F.sum("size_bytes").alias("size_bytes"), F.sum((~F.col("readable")).cast("bigint")).alias("n_unreadable"))


def duplicate_basenames(files: DataFrame) -> DataFrame:
    """(name, n_files) of base names, case aside, that more than one file has."""
    return files.groupBy(F.lower(F.regexp_extract("path", "([^/]*)$", 1)).alias("name")).agg(F.count("*").alias("n_files")).where("n_files > 1")


def attachment_names(value: Column) -> Column:
    """The names in an array that are Word or PDF files and no templates, first seen first."""
    return F.array_distinct(F.filter(value, lambda x: x.isNotNull() & F.lower(x).rlike(r"\.doc|\.pdf") & ~F.lower(x).contains("template")))


def guessed_attachments(doc_number: Column) -> Column:
    """Names that the files of a document with this number usually have."""
    name = F.regexp_replace(F.coalesce(doc_number, F.lit("")), "[/ ]", "_")
    return F.when(name == "", F.array().cast("array<string>")).otherwise(F.array(*[F.concat(name, F.lit(e)) for e in (".docx", ".doc", ".pdf")]))


def best_attachment(files: DataFrame, key: str) -> DataFrame:
    """(key, name, size): the largest file; .docx before .doc before .pdf, then the first, where equal."""
    ext = X.extension(F.col("name"))
    priority = F.when(ext == ".docx", 3).when(ext == ".doc", 2).otherwise(1)
    return files.groupBy(key).agg(F.max(F.struct("size", priority.alias("p"), (-F.col("place")).alias("o"), "name")).alias("b")).select(key, "b.name", "b.size")


def export_strategy(html: Column, limit: int = 500_000) -> Column:
    """How a record's text becomes a Word file: from attachments without HTML, as plain text beyond `limit`, else from the HTML."""
    body = X.html_text(html)
    return F.when(F.coalesce(html, F.lit("")) == "", "attachments").when(F.length(html) > limit, "raw_text").when(body == "", "attachments").otherwise("html")


def without_inline_images(html: Column) -> Column:
    return F.regexp_replace(html, r"(?i)<img\b[^>]*src=[\"']data:[^>]*>", "")


def attribute_export(df: DataFrame) -> DataFrame:
    """The attributes of a record as they are exported, `--` for what is missing; the number as it is."""
    missing = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("--"))
    names = {"nganh": "industry", "linh_vuc": "field", "tinh_trang_hieu_luc": "status", "co_quan_ban_hanh": "issuer", "loai_van_ban": "doc_type", "ngay_ban_hanh": "issue_date", "ngay_co_hieu_luc": "effective_date", "ngay_het_hieu_luc": "expiration_date", "nguoi_ky": "signer", "chuc_danh_nguoi_ky": "signer_title"}
    return df.select("record_id", "item_id", "url_toanvan", "title", F.col("doc_number").alias("so_hieu"), *[missing(c).alias(n) for n, c in names.items()])
