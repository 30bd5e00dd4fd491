"""Queries over listings and records: typing, naming, resuming, pairing, relations, inventory, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import collection as C
from ..operators import references
from ..session import table
from ..sources import files, sinks
from .problems import _EDGES_SQL, _ENDS, EDGES, flat_tables
from .texts import _FOLDED, _HTML, _SAFE


def type_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "list_items").select("title", "doc_type").distinct()
    return C.document_types(rows, ["title", "doc_type"]).groupBy("type_id").agg(F.count("*").alias("n_items"))


def type_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the type that their listing asked for; the number of old links is resolved."""
    rows = table(spark, sf_dir, "list_items")
    asked = rows.select("item_id", "doc_type", "title", C.canonical_type(F.col("type_id")).alias("wanted")).distinct()
    types = C.document_types(asked.select("doc_type", "title").distinct(), ["doc_type", "title"])
    hit = asked.join(types, (asked["doc_type"].eqNullSafe(types["doc_type"])) & (asked["title"].eqNullSafe(types["title"])) & (F.col("wanted") == F.col("type_id")), "left_semi")
    return hit.groupBy("wanted").agg(F.count("*").alias("n_items"))


def list_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.normalized_items(table(spark, sf_dir, "list_items"))
    return rows.select("item_key", "title", "doc_number", "doc_type", "issue_date", "effective_date", "issuer", "status", "list_page").distinct()


def list_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each item was last crawled, and on which page then."""
    rows = C.latest_items(table(spark, sf_dir, "list_items").where("item_id is not null").select("item_id", "crawled_at", "list_page").distinct())
    return rows.select("item_id", "crawled_at", "list_page")


def newest_items(spark: SparkSession, sf_dir: str, n: int = 50) -> DataFrame:
    """The listing's order: issue date downwards, cut at n; the top-k is the feature."""
    rows = table(spark, sf_dir, "list_items").select("item_id", X.date_head(F.col("issue_date")).alias("issued")).where("item_id is not null").distinct()
    return rows.orderBy(F.desc("issued"), "item_id").limit(n)


def page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.page_counts(table(spark, sf_dir, "list_items"), 50)


def resume_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    fetched, labelled = table(spark, sf_dir, "vb_documents").select("item_id"), table(spark, sf_dir, "ner_dataset").select(F.col("document_id").alias("item_id"))
    return C.pending_items(table(spark, sf_dir, "list_items"), fetched, labelled)


def resume_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    fetched, labelled = table(spark, sf_dir, "vb_documents").select("item_id"), table(spark, sf_dir, "ner_dataset").select(F.col("document_id").alias("item_id"))
    return C.stale_items(fetched, labelled)


def folder_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.folder_names(table(spark, sf_dir, "vb_documents"), "item_id", "doc_number", "doc_type", "record_id")


def pair_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled texts (Word files) with the records (attributes) and their diagrams (relations), by document id."""
    words = table(spark, sf_dir, "ner_dataset").select(references.same_id(F.col("document_id")).alias("directory"), F.col("source_file").alias("name"), F.lit("word").alias("kind"), F.lit("").alias("item_id")).where("directory is not null")
    docs = table(spark, sf_dir, "vb_documents").select(references.same_id(F.col("item_id")).alias("directory"), "relationship_graph").where("directory is not null")
    attributes = docs.select("directory", F.lit("thuoc_tinh.json").alias("name"), F.lit("attribute_json").alias("kind"), F.col("directory").alias("item_id")).distinct()
    relations = docs.where("relationship_graph is not null").select("directory", F.lit("luoc_do.json").alias("name"), F.lit("schema_json").alias("kind"), F.col("directory").alias("item_id")).distinct()
    pairs = C.pair_files(words.unionByName(attributes).unionByName(relations))
    return pairs.groupBy("status", "pairing_method", "pairing_confidence").agg(F.count("*").alias("n"), F.countDistinct("directory").alias("n_directories"))


def relation_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "vb_documents")
    edges = flat_tables(docs)[EDGES].where("item_id <> ''").select(F.col("_key").alias("record_id"), F.col("_relation_type_code").alias("code"), F.col("_direction").alias("direction"), F.col("_place").alias("place"), F.col("item_id").alias("id"))
    return C.relation_graph(edges, docs.where("relationship_graph is not null"))


def related_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each id is referred to, by related documents and by relations."""
    flat = flat_tables(table(spark, sf_dir, "vb_documents"))
    both = flat["record.related_docs"].select("item_id").unionByName(flat[EDGES].select("item_id"))
    return both.where("item_id <> ''").groupBy(F.lower(F.trim("item_id")).alias("id")).agg(F.count("*").alias("n"))


def inventory_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "ner_dataset").select(F.col("source_file").alias("path"), F.length("text").cast("bigint").alias("size_bytes"), F.col("text").isNotNull().alias("readable"))
    return C.inventory_summary(files.unionByName(_attached(spark, sf_dir).select("path", F.lit(0).cast("bigint").alias("size_bytes"), F.lit(True).alias("readable"))))


def _attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "vb_documents").select("record_id", F.posexplode("attached_files").alias("place", "path")).where("path is not null")


def inventory_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.duplicate_basenames(table(spark, sf_dir, "ner_dataset").select(F.col("source_file").alias("path")))


def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "ner_dataset").select("source_file").distinct()
    return rows.select("source_file", X.extension(F.col("source_file")).alias("extension"), X.stem(F.col("source_file")).alias("stem"), X.parent(F.col("source_file")).alias("parent"))


def attach_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each record's attachments the best kind, then the largest number as a stand-in for its size."""
    names = table(spark, sf_dir, "vb_documents").select("record_id", F.posexplode(C.attachment_names(F.col("attached_files"))).alias("place", "name"))
    sized = names.select("record_id", "place", "name", F.coalesce(F.nullif(F.regexp_extract("name", "([0-9]+)", 1), F.lit("")).cast("bigint"), F.lit(0)).alias("size"))
    return C.best_attachment(sized, "record_id")


def export_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "vb_documents").select("record_id", C.export_strategy(F.col("content_html")).alias("strategy"))


def attribute_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.attribute_export(table(spark, sf_dir, "vb_documents"))


def key_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys in lists with one on each line: here the lines of the documents."""
    lines = table(spark, sf_dir, "documents", "doc_id").select(F.explode(F.split("text", "\n")).alias("value"))
    return files.key_set(lines, "value").select(F.md5("key").alias("key"), F.length("key").cast("bigint").alias("n_chars"))


def exported_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids read back from exported attributes, of two types' folders only."""
    exports = sinks.attribute_json(C.attribute_export(table(spark, sf_dir, "vb_documents"))).where(F.col("doc_type").isin("Thông tư", "Nghị quyết"))
    return files.exported_ids(exports.select("json", F.col("doc_type").alias("type_dir")))


def page_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of at most three pages after the fifth."""
    rows = table(spark, sf_dir, "list_items").where("list_page > 5 and list_page <= 5 + 3")
    return rows.groupBy(F.col("list_page").cast("bigint").alias("list_page")).agg(F.count("*").alias("n"), F.countDistinct("item_id").alias("n_items"))


QUERIES = {f.__name__: f for f in (key_sets, exported_keys, page_bound, type_match, type_listing, list_normalize, list_latest, newest_items, page_counts, resume_antijoin, resume_stale, folder_collisions, pair_files, relation_edges, related_ids, inventory_kind, inventory_duplicates, path_parts, attach_pick, export_route, attribute_export)}

_TYPES = "(values " + ", ".join(f"('{k}', '{n[0]}', [{', '.join(repr(x) for x in longer)}]::varchar[])" for k, (n, longer) in C.type_predicates().items()) + ") as types(type_id, form, longer)"
_HITS = "(f = {0} or starts_with(f, {0} || ' ') or starts_with(f, {0} || '-'))"
_TYPED = f"""forms as (select distinct title, doc_type, [{_FOLDED.format('doc_type')}, {_FOLDED.format('title')}] as fs from list_items),
typed as (select title, doc_type, type_id from forms, {_TYPES} where len(list_filter(fs, lambda f: {_HITS.format('form')})) > 0
  and len(list_filter(longer, lambda x: len(list_filter(fs, lambda f: {_HITS.format('x')})) > 0)) = 0)"""
_ALIASES = "case type_id " + " ".join(f"when '{k}' then '{v}'" for k, v in C.TYPE_ALIASES.items()) + " else coalesce(type_id, '') end"
_E = lambda c: f"coalesce({c}, '')"
_MISSING = lambda c: f"coalesce(nullif({c}, ''), '--')"
_RELATIONS = "(values " + ", ".join(f"('{k}', '{d}', '{n[i]}')" for k, n in C.RELATIONS.items() for i, d in enumerate(("outgoing", "incoming"))) + ") as kinds(code, direction, relation_type)"
_KEY = f"lower(regexp_replace({{0}}, {_ENDS}, '', 'g'))"
_NAME = "lower(regexp_extract(path, '([^/]*)$', 1))"
_RAW = "coalesce(doc_number, '')"

SQL = {
    "key_sets": "select distinct md5(k) as key, length(k) as n_chars from (select trim(unnest(string_split(text, chr(10))), ' ') as k from documents) where k <> ''",
    "exported_keys": "select distinct item_id, doc_type as type_dir from vb_documents where item_id <> '' and doc_type in ('Thông tư', 'Nghị quyết')",
    "page_bound": "select list_page, count(*) as n, count(distinct item_id) as n_items from list_items where list_page between 6 and 8 group by 1",
    "type_match": f"with {_TYPED} select type_id, count(*) as n_items from typed group by 1",
    "type_listing": f"with {_TYPED}, asked as (select distinct item_id, doc_type, title, {_ALIASES} as wanted from list_items) select wanted, count(*) as n_items from asked a where exists (select 1 from typed t where t.type_id = a.wanted and t.title is not distinct from a.title and t.doc_type is not distinct from a.doc_type) group by 1",
    "list_normalize": f"select distinct coalesce(nullif(item_id, ''), nullif(url_toanvan, ''), nullif(url, ''), '') as item_key, {_E('title')} as title, {_E('doc_number')} as doc_number, {_E('doc_type')} as doc_type, split_part({_E('issue_date')}, 'T', 1) as issue_date, split_part({_E('effective_date')}, 'T', 1) as effective_date, {_E('issuer')} as issuer, {_E('status')} as status, list_page from list_items",
    "list_latest": "select item_id, (max({'c': crawled_at, 'p': list_page})).c as crawled_at, (max({'c': crawled_at, 'p': list_page})).p as list_page from list_items where item_id is not null group by 1",
    "newest_items": "select distinct item_id, split_part(coalesce(issue_date, ''), 'T', 1) as issued from list_items where item_id is not null order by issued desc, item_id limit 50",
    "page_counts": "select type_id, keyword, count(distinct item_id) as total, greatest(ceil(count(distinct item_id) / 50.0), 1)::bigint as total_pages from list_items group by all",
    "resume_antijoin": "select distinct item_id from list_items where item_id <> '' except select item_id from vb_documents where item_id in (select document_id from ner_dataset)",
    "resume_stale": "select distinct item_id from vb_documents where item_id <> '' except select document_id from ner_dataset",
    "folder_collisions": f"""with n as (select item_id, record_id, case when coalesce(doc_type, '') = '' then 'Khac' else {_SAFE.format('doc_type', "'untitled'")} end as type_dir,
 {_SAFE.format(f"case when {_RAW} = '' or lower(trim({_RAW})) = 'không số' then 'Khong_so_' || coalesce(item_id, '')[1:8] else doc_number end", "'untitled'")} as base from vb_documents)
 select item_id, type_dir, case when record_id = min(record_id) over (partition by type_dir, base) then base else base || '__' || {_SAFE.format("coalesce(item_id, '')[1:12]", "'duplicate'")} end as folder from n""",
    "pair_files": f"""with w as (select {_KEY.format('document_id')} as d from ner_dataset where document_id is not null),
 a as (select {_KEY.format('item_id')} as d, max((relationship_graph is not null)::int) as s from vb_documents where item_id is not null group by 1),
 r as (select coalesce(w.d, a.d) as d, w.d is not null as word, a.d is not null as attr, coalesce(a.s, 0) = 1 as rel from w full join a on w.d = a.d)
 select case when not word then 'unmatched' when attr and rel then 'paired' else 'partial' end as status, case when attr and d <> '' then 'shared_item_id_and_directory' else 'document_directory' end as pairing_method,
 (case when not word then 0.0 when attr and d <> '' then 1.0 else 0.8 end)::double as pairing_confidence, count(*) as n, count(distinct d) as n_directories from r group by 1, 2, 3""",
    "relation_edges": f"""with {_EDGES_SQL},
 e as (select record_id, code, direction, string_agg(id, ',' order by place, id) as documents, count(*) as n_documents from (select * from listed union all select * from drawn) where id <> '' group by 1, 2, 3)
 select v.record_id, k.code, k.direction, k.relation_type, coalesce(n_documents, 0) as n_documents, coalesce(documents, '') as documents
 from (select record_id from vb_documents where relationship_graph is not null) v, {_RELATIONS.replace('as kinds(', 'as k(')} left join e on e.record_id = v.record_id and e.code = k.code and e.direction = k.direction""",
    "related_ids": f"with {_EDGES_SQL}, b as (select id from listed union all select id from drawn union all select r.item_id from (select unnest(related_docs) as r from vb_documents)) select lower(trim(id)) as id, count(*) as n from b where id <> '' group by 1",
    "inventory_kind": f"""with f as (select source_file as path, length(text) as size_bytes, text is not null as ok from ner_dataset union all select p, 0, true from (select unnest(attached_files) as p from vb_documents) where p is not null)
 select case when regexp_matches({_NAME}, '[^.]\\.docx?$') then 'word' when {_NAME} = 'thuoc_tinh.json' then 'attribute_json' when {_NAME} = 'luoc_do.json' then 'schema_json' when regexp_matches({_NAME}, '[^.]\\.json$') then 'other_json' else 'other' end as kind,
 count(*) as n_files, sum(size_bytes)::bigint as size_bytes, sum((not ok)::int)::bigint as n_unreadable from f group by 1""",
    "inventory_duplicates": "select lower(regexp_extract(source_file, '([^/]*)$', 1)) as name, count(*) as n_files from ner_dataset group by 1 having count(*) > 1",
    "path_parts": r"select distinct source_file, lower(regexp_extract(source_file, '[^/.](\.[^/.]+)$', 1)) as extension, regexp_extract(source_file, '([^/]+?)(?:\.[^/.]*)?$', 1) as stem, regexp_extract(source_file, '([^/]+)/[^/]*$', 1) as parent from ner_dataset",
    "attach_pick": r"""with n as (select record_id, f as name, i as place, coalesce(try_cast(nullif(regexp_extract(f, '([0-9]+)', 1), '') as bigint), 0) as size from (select record_id, unnest(attached_files) as f, generate_subscripts(attached_files, 1) as i from vb_documents)
 where f is not null and regexp_matches(lower(f), '\.doc|\.pdf') and not contains(lower(f), 'template')),
 r as (select *, row_number() over (partition by record_id order by size desc, case when lower(name) like '%.docx' then 3 when lower(name) like '%.doc' then 2 else 1 end desc, place) as k from n)
 select record_id, name, size from r where k = 1""",
    "export_route": f"select record_id, case when coalesce(content_html, '') = '' then 'attachments' when length(content_html) > 500000 then 'raw_text' when {_HTML} = '' then 'attachments' else 'html' end as strategy from vb_documents",
    "attribute_export": f"select record_id, item_id, url_toanvan, title, doc_number as so_hieu, {_MISSING('industry')} as nganh, {_MISSING('field')} as linh_vuc, {_MISSING('status')} as tinh_trang_hieu_luc, {_MISSING('issuer')} as co_quan_ban_hanh, {_MISSING('doc_type')} as loai_van_ban, {_MISSING('issue_date')} as ngay_ban_hanh, {_MISSING('effective_date')} as ngay_co_hieu_luc, {_MISSING('expiration_date')} as ngay_het_hieu_luc, {_MISSING('signer')} as nguoi_ky, {_MISSING('signer_title')} as chuc_danh_nguoi_ky from vb_documents",
}
