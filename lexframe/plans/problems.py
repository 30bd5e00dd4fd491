"""Queries p2 and p6: orphan references, and nested records as flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import BLANKS
from ..operators import inlining, references
from ..session import checkpointed, table


# --- p2 -----------------------------------------------------------------------------------------


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reference of the collection: (table_name, row_id, ref_id, ts)."""
    docs = table(spark, sf_dir, "vb_documents").select("record_id", "scraped_at", F.explode("related_docs").alias("r"))
    own = references.same_id(F.col("r.item_id"))
    related = docs.select(
        F.lit("vb_documents").alias("table_name"),
        F.col("record_id").alias("row_id"),
        F.when(F.coalesce(own, F.lit("")) != "", own).otherwise(references.id_of_url(F.col("r.url"))).alias("ref_id"),
        F.col("scraped_at").alias("ts"),
    )
    rows = table(spark, sf_dir, "ner_dataset").select(
        F.lit("ner_dataset").alias("table_name"), F.col("row_id"), references.same_id(F.col("document_id")).alias("ref_id"), F.col("built_at").alias("ts")
    )
    return related.unionByName(rows).where("ref_id is not null")


def _existence(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    records = table(spark, sf_dir, "vb_documents").select(references.same_id(F.col("item_id")).alias("ref_id"), F.col("scraped_at").alias("ts"))
    removed = table(spark, sf_dir, "removals").select(references.same_id(F.col("item_id")).alias("ref_id"), F.col("removed_at").alias("ts"))
    return records, removed


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.orphan_references(_references(spark, sf_dir), *_existence(spark, sf_dir)).distinct()


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.orphan_report(references.orphan_references(_references(spark, sf_dir), *_existence(spark, sf_dir)))


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.change_log(_references(spark, sf_dir), *_existence(spark, sf_dir))


def p2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans as of now, from the signed counts of one batch."""
    return references.current_orphans(references.merge_counts(None, references.count_deltas(_changes(spark, sf_dir), None)))


def p2_current_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from three batches, the time cut in three: the counts that a batch leaves are what the next one starts from."""
    changes = _changes(spark, sf_dir)
    dated = changes.where(F.col("ts") < F.lit(references.FINAL).cast("timestamp_ntz"))
    bounds = dated.agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    first, last = (bounds.select(F.unix_timestamp(c)).scalar() for c in "ab")
    slice_of = F.least(F.greatest(F.floor((F.unix_timestamp("ts") - first) * 3 / (last - first + 1)), F.lit(0)), F.lit(2))
    counts = None
    for i in range(3):
        counts = checkpointed(references.merge_counts(counts, references.count_deltas(changes.where(slice_of == i), counts)))
    return references.current_orphans(counts)


#: White space at either end, as a SQL literal.
_ENDS = "'" + f"^[{BLANKS}\n\r]+|[{BLANKS}\n\r]+$" + "'"

_REFS_SQL = rf"""
refs as (
  select * from (
    select 'vb_documents' as table_name, record_id as row_id, scraped_at as ts,
           coalesce(nullif(lower(regexp_replace(r.item_id, {_ENDS}, '', 'g')), ''),
                    lower(nullif(regexp_extract(r.url, '(?i)([0-9a-f]{{8}}(?:-[0-9a-f]{{4}}){{3}}-[0-9a-f]{{12}})/*\s*$', 1), '')),
                    nullif(regexp_extract(r.url, '--([0-9]+)/*\s*$', 1), '')) as ref_id
    from (select record_id, scraped_at, unnest(related_docs) as r from vb_documents)
    union all
    select 'ner_dataset', row_id, built_at, lower(regexp_replace(document_id, {_ENDS}, '', 'g')) from ner_dataset
  ) where ref_id is not null),
recs as (select lower(regexp_replace(item_id, {_ENDS}, '', 'g')) as ref_id, scraped_at as ts from vb_documents),
rems as (select lower(regexp_replace(item_id, {_ENDS}, '', 'g')) as ref_id, removed_at as ts from removals)"""

_ORPHANS_SQL = f"""{_REFS_SQL},
ids as (select distinct ref_id, ts from refs),
seen as (
  select i.ref_id, i.ts, count(r.ref_id) as n, max(r.ts) filter (where r.ts <= i.ts) as last
  from ids i left join recs r on r.ref_id = i.ref_id group by 1, 2),
state as (
  select s.ref_id, s.ts, case when n = 0 then 'missing' when last is null then 'late'
         when exists (select 1 from rems m where m.ref_id = s.ref_id and m.ts > s.last and m.ts <= s.ts) then 'deleted' end as kind
  from seen s),
orphans as (
  select table_name, row_id, f.ref_id, kind, strftime(f.ts, '%Y-%m') as period
  from refs f join state s on s.ref_id = f.ref_id and s.ts = f.ts where kind is not null)"""

# --- p6 -----------------------------------------------------------------------------------------


#: The table of edges in the plan of a record, and the columns of its relation that its rows repeat.
EDGES = "record.relationship_graph__relations.documents"
CARRY = {EDGES: ["relation_type_code", "direction"]}


def flat_tables(docs: DataFrame) -> dict[str, DataFrame]:
    """The flat tables of vb_documents; where there are no relations, those of the diagram are taken."""
    graph = F.col("relationship_graph")
    listed = docs.schema["relationship_graph"].dataType["relations"].dataType
    drawn = F.transform(
        inlining.diagram_relations(graph["raw"]),
        lambda r: F.struct(
            r["code"].alias("relation_type_code"),
            r["direction"].alias("direction"),
            F.lit(None).cast("string").alias("relation_type"),
            F.transform(r["ids"], lambda i: F.struct(i.alias("item_id"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("url"))).alias("documents"),
        ),
    )
    relations = F.coalesce(graph["relations"], drawn.cast(listed))
    shaped = docs.withColumn("relationship_graph", F.when(graph.isNotNull(), F.struct(graph["current_document"].alias("current_document"), relations.alias("relations"))))
    return inlining.flatten_records(shaped, "record_id", carry=CARRY)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The children of each record: rows of the flat tables, each a projection of one scan."""
    flat = flat_tables(table(spark, sf_dir, "vb_documents"))

    def rows(name: str, child: str, path: Column, key: Column) -> DataFrame:
        return flat[name].select(F.col("_key").alias("record_id"), F.lit(child).alias("child"), path.alias("path"), key.alias("child_key"))

    place = F.col("_place").cast("string")
    people = rows("record.issuing_people", "person", place, F.coalesce("person_id", F.lit("")))
    related = rows("record.related_docs", "related", place, F.coalesce("item_id", F.lit("")))
    path = F.concat(F.coalesce("_relation_type_code", F.lit("")), F.lit("/"), F.coalesce("_direction", F.lit("")), F.lit("/"), place)
    edges = rows(EDGES, "edge", path, F.col("item_id")).where("child_key <> ''")
    return people.unionByName(related).unionByName(edges).distinct()


def p6_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_tables(table(spark, sf_dir, "vb_documents"))["record.issuing_people"].withColumnsRenamed({"_key": "record_id", "_place": "place"}).drop("_parent_place")


def p6_related(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_tables(table(spark, sf_dir, "vb_documents"))["record.related_docs"].withColumnsRenamed({"_key": "record_id", "_place": "place"}).drop("_parent_place")


_EDGES_SQL = """
listed as (
  select record_id, rel.relation_type_code as code, rel.direction as direction, unnest(rel.documents).item_id as id, generate_subscripts(rel.documents, 1) as place
  from (select record_id, unnest(relationship_graph.relations) as rel from vb_documents where relationship_graph.relations is not null)),
raws as (
  select record_id, case when json_type(j, '$.data') = 'OBJECT' then json_extract(j, '$.data') else j end as j
  from (select record_id, relationship_graph.raw::json as j from vb_documents
        where relationship_graph is not null and relationship_graph.relations is null and json_valid(relationship_graph.raw))),
lists as (
  select record_id, c::varchar as code, d as direction,
         json_extract(j, '$.' || case d when 'outgoing' then 'documentNamesByType' else 'documentNamesBySource' end || '."' || c::varchar || '"') as l
  from raws, range(1, 16) as codes(c), (values ('outgoing'), ('incoming')) as dirs(d)),
items as (
  select record_id, code, direction, l, unnest(range(1, json_array_length(l)::bigint + 1)) as place from lists where json_type(l) = 'ARRAY'),
drawn as (
  select record_id, code, direction, coalesce(nullif(json_extract_string(e, '$.id'), ''), nullif(json_extract_string(e, '$.docId'), '')) as id, place
  from (select *, json_extract(l, '$[' || (place - 1)::varchar || ']') as e from items) where json_type(e) = 'OBJECT')"""

_P6_SQL = f"""with {_EDGES_SQL},
people as (select record_id, unnest(issuing_people) as p, generate_subscripts(issuing_people, 1) as place from vb_documents),
rels as (select record_id, unnest(related_docs) as p, generate_subscripts(related_docs, 1) as place from vb_documents)
select record_id, 'person' as child, place::varchar as path, coalesce(p.person_id, '') as child_key from people where p is not null
union
select record_id, 'related', place::varchar, coalesce(p.item_id, '') from rels where p is not null
union
select record_id, 'edge', coalesce(code, '') || '/' || coalesce(direction, '') || '/' || place::varchar, id
from (select * from listed union all select * from drawn) where id <> ''"""

QUERIES = {
    "p2_found": p2_found,
    "p2_report": p2_report,
    "p2_current": p2_current,
    "p2_current_batches": p2_current_batches,
    "p6_found": p6_found,
    "p6_people": p6_people,
    "p6_related": p6_related,
}

_CURRENT_SQL = f"""with {_REFS_SQL},
last as (select ref_id, max(ts) as ts from recs where ref_id is not null group by 1),
alive as (select l.ref_id from last l where not exists (select 1 from rems m where m.ref_id = l.ref_id and m.ts > l.ts))
select ref_id, count(*) as n_ref from refs where ref_id not in (select ref_id from alive) group by 1"""

SQL = {
    "p2_found": f"with {_ORPHANS_SQL} select distinct * from orphans",
    "p2_report": f"with {_ORPHANS_SQL} select table_name, period, kind, count(*) as n_refs, count(distinct ref_id) as n_ids from orphans group by all",
    "p2_current": _CURRENT_SQL,
    "p2_current_batches": _CURRENT_SQL,
    "p6_found": _P6_SQL,
    "p6_people": "select record_id, place::int as place, p.agency_id, p.agency_name, p.person_id, p.person_name, p.job_title_id, p.job_title_code, p.job_title_name, p.order_index from (select record_id, unnest(issuing_people) as p, generate_subscripts(issuing_people, 1) as place from vb_documents) where p is not null",
    "p6_related": "select record_id, place::int as place, p.item_id, p.title, p.doc_number, p.url from (select record_id, unnest(related_docs) as p, generate_subscripts(related_docs, 1) as place from vb_documents) where p is not null",
}
