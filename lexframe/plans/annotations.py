"""Queries over annotated texts: spans, labels, samples, token sequences, evaluation and quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import collection as C
from ..operators import evaluation as E
from ..operators import labels as L
from ..operators import quality as Q
from ..operators import sequence as S
from ..operators import spans as N
from ..session import table
from .texts import _BLANK, _LINES, _NORMAL, _q

# Phrases that name a relation, and titles of legal documents.
RELATION_PHRASES = r"bản dịch|căn cứ ban hành|văn bản (?:được )?(?:dẫn chiếu|đính chính|thay thế|giải thích|sửa đổi(?:,? bổ sung)?|hợp nhất)"
KINDS = "Thông tư liên tịch|Thông tư|Quyết định|Nghị quyết|Nghị định|Chỉ thị|Kế hoạch|Hướng dẫn|Công văn|Quy chế"
NEEDLES = {"CAN_CU": "căn cứ", "DIEU": "Điều 1", "QUYET_DINH": "quyết định", "THONG_TU": "thông tư số", "NGAY": "ngày", "VAN_BAN": "văn bản này", "CO_QUAN": "ủy ban nhân dân"}
# End of the fixed values.
NUMBER = r"[0-9]+/[0-9]{4}/[A-ZĐ]+-[A-ZĐ]+"
ATTRIBUTES = {c: f"attribute_json.attributes.{p}" for c, p in {"doc_number": "so_hieu", "industry": "nganh", "field": "linh_vuc", "status": "tinh_trang_hieu_luc", "issuer": "co_quan_ban_hanh", "doc_type": "loai_van_ban", "issue_date": "ngay_ban_hanh", "effective_date": "ngay_co_hieu_luc", "expiration_date": "ngay_het_hieu_luc", "signer": "nguoi_ky", "signer_title": "chuc_danh_nguoi_ky"}.items()} | {"item_id": "attribute_json.metadata.item_id", "title": "attribute_json.metadata.title"}


def _big(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]


def _needles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(NEEDLES.items()), "label string, variant string")


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.find_spans(table(spark, sf_dir, "documents", "doc_id").select("doc_id", "text"), "text", _needles(spark), ["doc_id"])


def span_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir).groupBy("doc_id", "label").agg(F.count("*").alias("n"), F.sum("start_char").cast("bigint").alias("sum_start"))


def span_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.resolve_overlaps(_found(spark, sf_dir), ["doc_id"]).groupBy("doc_id", "accepted", "rejection_reason").agg(F.count("*").alias("n"), F.sum("start_char").cast("bigint").alias("sum_start"))


def rule_entities_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases that name a relation, with their lines, in the relations of each record followed by its text."""
    names = F.create_map(*(F.lit(x) for code, (name, _) in C.RELATIONS.items() for x in (code, name)))
    relations = F.nullif(F.array_join(F.transform("relationship_graph.relations", lambda r: F.concat(F.coalesce(F.try_element_at(names, r["relation_type_code"]), F.lit("")), F.lit(": "), F.coalesce(r["relation_type"], F.lit("")))), "\n"), F.lit(""))
    docs = table(spark, sf_dir, "vb_documents", "record_id").select("record_id", F.concat_ws("\n", relations, "full_text").alias("full_text"))
    kept = docs.withColumn("full_text", F.array_join(F.filter(F.split("full_text", "\n"), lambda x: ~X.is_blank(x)), "\n"))
    found = N.matches_of(kept, "full_text", f"(?iu)(?:{RELATION_PHRASES})", ["record_id"])
    placed = N.in_blocks(found, N.blocks_of(docs, "full_text", ["record_id"]), ["record_id"])
    return placed.select("record_id", *_big("start_char", "end_char", "block_no"), "match")


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Q.entity_rows(table(spark, sf_dir, "ner_dataset", "row_id"), "row_id")
    return rows.select("row_id", "entity_no", "label", "start_char", "end_char", "text", (F.col("match_score") / 100).alias("confidence"))


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What patterns say: numbers, kinds of documents, and the first line as the office."""
    rows = table(spark, sf_dir, "ner_dataset", "row_id").select("row_id", "text")
    out = None
    for label, pattern in (("SO_HIEU", NUMBER), ("LOAI_VAN_BAN", KINDS), ("CO_QUAN", r"\A[^\n]+")):
        one = N.matches_of(rows, "text", pattern, ["row_id"]).select("row_id", F.lit(label).alias("label"), "start_char", "end_char", (F.lit(0.5) + (F.col("end_char") - F.col("start_char")) / 1000).alias("confidence"))
        out = one if out is None else out.unionByName(one)
    return out


def entity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.document_summary(_gold(spark, sf_dir), table(spark, sf_dir, "ner_dataset", "row_id"), "row_id").select("row_id", *_big("n_entities", "n_values"), "labels", "mean_confidence", "min_confidence", "max_confidence")


def json_flatten_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.flatten_json(table(spark, sf_dir, "events"), "props", ["event_id"]).select("event_id", "path", "value")


def json_flatten_diagrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of the relationship diagrams, and how often each has a leaf."""
    raw = table(spark, sf_dir, "vb_documents", "record_id").select("record_id", F.col("relationship_graph.raw").alias("raw"))
    return L.flatten_json(raw, "raw", ["record_id"]).groupBy("path", "type").agg(F.count("*").alias("n"), F.countDistinct("record_id").alias("n_records"))


def json_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structures of the relationship diagrams, and how many have each."""
    raw = table(spark, sf_dir, "vb_documents", "record_id").select("record_id", F.col("relationship_graph.raw").alias("raw"))
    return L.json_shapes(raw, "raw", ["record_id"]).groupBy(F.md5("shape").alias("shape"), F.length("shape").cast("bigint").alias("n_chars")).agg(F.count("*").alias("n"))


def _leaves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "vb_documents", "record_id").where("full_text is not null")
    return L.record_leaves(docs, ATTRIBUTES, ["record_id"]), docs.select("record_id", "full_text")


def path_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves, texts = _leaves(spark, sf_dir)
    return L.path_profile(leaves, texts, "full_text", ["record_id"])


def label_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves, texts = _leaves(spark, sf_dir)
    return L.induced_labels(L.path_profile(leaves, texts, "full_text", ["record_id"])).select("path", "is_span_entity", "name", "role")


def weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of attribute values in the texts, one for each value, as labels would be built from the induced schema."""
    leaves, texts = _leaves(spark, sf_dir)
    labels = L.induced_labels(L.path_profile(leaves, texts, "full_text", ["record_id"])).where("is_span_entity").select("path", "name", F.lit(False).alias("allow_multiple"))
    return L.weak_spans(leaves, labels, texts, "full_text", ["record_id"]).select("record_id", "label", *_big("start_char", "end_char"))


def weak_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weak labels that stay after overlaps are resolved, by split and label."""
    accepted = N.resolve_overlaps(weak_labels(spark, sf_dir), ["record_id"]).where("accepted")
    splits = L.split_by_digest(table(spark, sf_dir, "vb_documents", "record_id").where("full_text is not null"), "record_id")
    return accepted.join(splits, "record_id").groupBy("split", "label").agg(F.count("*").alias("n_spans"), F.countDistinct("record_id").alias("n_records"))


def systematic_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.systematic_sample(table(spark, sf_dir, "documents", "doc_id").select("doc_id"), "doc_id", 100)


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.split_by_digest(table(spark, sf_dir, "documents", "doc_id"), "doc_id")


def reservoir_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "ner_dataset", "row_id").select("row_id", "split", F.coalesce(F.size("entities"), F.lit(0)).alias("n"))
    positive = F.col("n") >= 3
    return L.sampled_negatives(rows, "row_id", positive, 0.25).select("row_id", positive.alias("positive"))


def dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.dataset_manifest(table(spark, sf_dir, "ner_dataset", "row_id"), "document_id", "source_sha256")


def chunk_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "ner_dataset", "row_id").select("row_id", "text")
    tokens = S.word_tokens(rows.where("text is not null"), "text", ["row_id"])
    every = S.chunk_windows(tokens, ["row_id"]).unionByName(S.empty_chunks(rows, tokens, ["row_id"]))
    return every.select("row_id", "chunk_id", *_big("chunk_no", "first_token", "last_token", "start_char", "end_char"))


def _aligned(spark: SparkSession, sf_dir: str, entities: DataFrame) -> DataFrame:
    tokens = S.word_tokens(table(spark, sf_dir, "ner_dataset", "row_id").where("text is not null"), "text", ["row_id"])
    return S.align_bio(tokens, entities, ["row_id"])


def token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aligned(spark, sf_dir, _gold(spark, sf_dir)).groupBy("row_id", "bio").agg(F.count("*").alias("n"), F.sum("token_no").cast("bigint").alias("sum_token"))


def bio_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.bio_vocabulary(_gold(spark, sf_dir)).select("bio", *_big("id"))


def _event_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as tokens of their users: a kind of label for each type, neighbouring places for neighbouring events."""
    label = F.create_map(*[F.lit(x) for pair in {"signup": "O", "click": "B-X", "view": "I-X", "error": "B-Y", "purchase": "I-Y"}.items() for x in pair])
    start = F.floor(F.col("event_id") / 150)
    return table(spark, sf_dir, "events").select("user_id", "event_id", start.alias("start_char"), (start + 1).alias("end_char"), label[F.col("event_type")].alias("label"), F.col("value").alias("confidence"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("user_id", "label", *_big("start_char", "end_char", "n_tokens"), F.round("confidence", 6).alias("confidence"))


def bio_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(N.decode_bio(_event_tokens(spark, sf_dir), ["user_id"], ["event_id"]))


def bio_decode_nogap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(N.decode_bio(_event_tokens(spark, sf_dir), ["user_id"], ["event_id"], gap=False))


def entity_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.floor(F.col("event_id") / 300)
    rows = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("label"), place.alias("start_char"), (place + 1).alias("end_char"), F.col("value").alias("confidence"), F.lit(1).alias("n_tokens"), F.concat(F.lit("c"), F.get_json_object("props", "$.k")).alias("chunk_id"))
    return N.merge_entities(rows, ["user_id"]).select("user_id", "label", *_big("start_char", "end_char", "n_tokens"), F.round("confidence", 6).alias("confidence"), F.array_join("chunk_ids", ",").alias("chunks"))


def confidence_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.above_threshold(_event_tokens(spark, sf_dir), 20.0).groupBy("label").agg(F.count("*").alias("n"), F.min("confidence").alias("least"))


def greedy_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = _gold(spark, sf_dir).select("row_id", "label", "start_char", "end_char", "confidence").unionByName(_predicted(spark, sf_dir))
    return N.greedy_select(both, ["row_id"]).select("row_id", "label", *_big("start_char", "end_char"), F.round("confidence", 6).alias("confidence"))


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.span_outcomes(_gold(spark, sf_dir), _predicted(spark, sf_dir), "row_id", table(spark, sf_dir, "ner_dataset", "row_id"))


def prf_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.metrics_by_label(_outcomes(spark, sf_dir))


def macro_micro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.micro_macro(_outcomes(spark, sf_dir))


def confusion_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.confusion(E.boundary_errors(_outcomes(spark, sf_dir), "row_id"))


def document_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.document_counts(_gold(spark, sf_dir), _predicted(spark, sf_dir), "row_id")


def sequence_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities read back from aligned tokens, gold against patterns."""
    predicted = _predicted(spark, sf_dir).withColumn("entity_no", F.col("start_char"))

    def read(entities: DataFrame) -> DataFrame:
        tokens = _aligned(spark, sf_dir, entities).select("row_id", "token_no", "start_char", "end_char", F.col("bio").alias("label"), F.lit(1.0).alias("confidence"))
        return N.decode_bio(tokens, ["row_id"], ["token_no"])

    return E.metrics_by_label(E.span_outcomes(read(_gold(spark, sf_dir)), read(predicted), "row_id"))


def split_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "ner_dataset", "row_id").select("split", "row_id", F.explode("entities").alias("e")).where("e is not null")
    return rows.groupBy("split", F.col("e.label").alias("label")).agg(F.count("*").alias("n_entities"), F.countDistinct("row_id").alias("n_rows"))


def missing_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.missing_labels(table(spark, sf_dir, "ner_dataset", "row_id"), ["CO_QUAN", "SO_HIEU", "LOAI_VAN_BAN", "NGUOI_KY"])


def span_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.span_issues(table(spark, sf_dir, "ner_dataset", "row_id"), "row_id", ["CO_QUAN", "SO_HIEU"]).groupBy("row_id", "issue").agg(F.count("*").alias("n"))


def overlap_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = _gold(spark, sf_dir).select("row_id", "label", "start_char", "end_char").unionByName(_predicted(spark, sf_dir).select("row_id", "label", "start_char", "end_char")).distinct()
    return Q.overlapping_entities(both, "row_id").select("row_id", "label", *_big("start_char", "end_char"))


def dup_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = _gold(spark, sf_dir).select("row_id", "label", "start_char", "end_char").unionByName(_predicted(spark, sf_dir).select("row_id", "label", "start_char", "end_char"))
    return Q.duplicate_entities(both, "row_id").select("row_id", "label", *_big("start_char", "end_char", "n"))


def leakage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.leakage(table(spark, sf_dir, "ner_dataset", "row_id"), "document_id")


def source_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.unaccounted(table(spark, sf_dir, "vb_documents", "record_id").select("item_id"), table(spark, sf_dir, "ner_dataset", "row_id").select(F.col("document_id").alias("item_id")), "item_id")


def zero_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "ner_dataset", "row_id").where(F.coalesce(F.size("entities"), F.lit(0)) <= 0).select("row_id", F.lit("zero_entities").alias("warning"))


def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.schema_issues(table(spark, sf_dir, "ner_dataset", "row_id"), "row_id", ["document_id", "source_file", "source_sha256", "text", "entities"])


def output_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and entities that don't have the form of an output."""
    rows = table(spark, sf_dir, "ner_dataset", "row_id")
    documents = Q.schema_issues(rows, "row_id", ["document_id", "source_sha256"], Q.document_rules())
    entities = Q.schema_issues(Q.entity_rows(rows, "row_id"), "row_id", ["label", "start_char", "end_char"], Q.entity_rules(F.col("match_score") / 100, F.col("match_method"), ("exact", "normalized")))
    return documents.unionByName(entities).groupBy("row_id", "issue").agg(F.count("*").alias("n"))


def stale_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose hash is not the one that most rows of their document have: the cache is read again only where both agree."""
    rows = table(spark, sf_dir, "ner_dataset", "row_id").where("document_id is not null")
    counts = rows.groupBy("document_id", "source_sha256").agg(F.count("*").alias("n"), F.max(F.length("text")).alias("text_length"))
    best = counts.groupBy("document_id").agg(F.max_by(F.struct("source_sha256", "text_length"), F.struct("n", F.coalesce("source_sha256", F.lit("")))).alias("b")).select("document_id", "b.*")
    outputs = rows.select("document_id", "row_id", "source_sha256", F.length("text").alias("text_length"))
    return Q.stale_sources(outputs, best, "document_id").groupBy("issue").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (span_search, span_resolve, rule_entities_blocks, entity_summary, json_flatten_props, json_flatten_diagrams, json_shapes, path_profile, label_schema, weak_labels, weak_dataset, systematic_sample, hash_split, reservoir_topk, dataset_manifest, chunk_windows, token_align, bio_vocab, bio_decode, bio_decode_nogap, entity_merge, confidence_filter, greedy_select, prf_metrics, macro_micro, confusion_overlap, document_counts, sequence_metrics, split_distribution, missing_labels, span_quality, overlap_check, dup_spans, leakage_check, source_accounting, zero_entities, required_fields, output_schema, stale_outputs)}


def _matches_sql(key: str, text: str, source: str, pattern: str, label: str) -> str:
    """SQL for the matches of a pattern, with their offsets."""
    p = _q(pattern)
    return f"""(with m as (select {key}, regexp_extract_all({text}, {p}) as f, string_split_regex({text}, {p}) as b from {source} where {text} is not null),
 x as (select {key}, unnest(f) as match, unnest(b[:len(f)]) as lead, unnest(range(1, len(f)::bigint + 1)) as i from m)
 select {key}, {_q(label)} as label, match, e - length(match) as start_char, e as end_char from (select *, (sum(length(lead) + length(match)) over (partition by {key} order by i))::bigint as e from x))"""


_NEEDLE_ROWS = "(values " + ", ".join(f"({_q(k)}, {_q(v)})" for k, v in NEEDLES.items()) + ") as needles(label, variant)"
_FOUND = f"""found as (select doc_id, label, start_char, start_char + n as end_char from (
  select doc_id, label, length(variant) as n, (sum(length(piece)) over w + (i - 1) * length(variant))::bigint as start_char, i, total from (
    select doc_id, label, variant, unnest(p) as piece, unnest(range(1, len(p)::bigint + 1)) as i, len(p) as total
    from (select doc_id, label, variant, string_split(case when length(lower(text)) = length(text) then lower(text) else text end, case when length(lower(text)) = length(text) then lower(variant) else variant end) as p from documents, {_NEEDLE_ROWS} where text is not null))
  window w as (partition by doc_id, label order by i)) where i < total)"""
_GOLD = "gold as (select row_id, no, e.label as label, e.start_char::bigint as start_char, e.end_char::bigint as end_char, e.text as text, e.match_score / 100 as confidence from (select row_id, unnest(entities) as e, generate_subscripts(entities, 1) as no from ner_dataset) where e is not null)"
_PRED = (
    "pred as (select row_id, label, start_char, end_char, 0.5 + (end_char - start_char) / 1000 as confidence from ("
    + " union all ".join(f"select * from {_matches_sql('row_id', 'text', 'ner_dataset', p, label)}" for label, p in (("SO_HIEU", NUMBER), ("LOAI_VAN_BAN", KINDS)))
    + " union all select row_id, 'CO_QUAN', regexp_extract(text, '\\A[^\\n]+'), 0, length(regexp_extract(text, '\\A[^\\n]+')) from ner_dataset where regexp_extract(text, '\\A[^\\n]+') <> ''))"
)
_OUT = """outcomes as (select row_id, start_char, end_char, label, case when max(g) + max(p) = 2 then 'tp' when max(p) = 1 then 'fp' else 'fn' end as outcome
 from (select row_id, start_char, end_char, label, 1 as g, 0 as p from {g} union all select row_id, start_char, end_char, label, 0, 1 from {p}) group by 1, 2, 3, 4)"""
_SUMS = "sums as (select label, sum((outcome = 'tp')::int)::bigint as tp, sum((outcome = 'fp')::int)::bigint as fp, sum((outcome = 'fn')::int)::bigint as fn from outcomes group by 1)"
_PRF = "tp / greatest(tp + fp, 1)::double as precision, tp / greatest(tp + fn, 1)::double as recall, 2 * (tp / greatest(tp + fp, 1)) * (tp / greatest(tp + fn, 1)) / greatest(tp / greatest(tp + fp, 1) + tp / greatest(tp + fn, 1), 1e-15) as f1"
_TOKENS = r"""tokens as (select row_id, (row_number() over (partition by row_id order by i) - 1) as token_no, start_char, start_char + length(piece) as end_char from (
 select row_id, piece, i, coalesce(sum(length(piece) + 1) over (partition by row_id order by i rows between unbounded preceding and 1 preceding), 0)::bigint as start_char from (
  select row_id, unnest(p) as piece, unnest(range(0, len(p)::bigint)) as i from (select row_id, string_split_regex(text, '[ \t\n\r\x0b\f]') as p from ner_dataset where text is not null))) where piece <> '')"""
_ALIGNED = """{n} as (select row_id, token_no, start_char, end_char, case when e is null then 'O' when row_number() over (partition by row_id, e.s, e.e, e.l order by token_no) = 1 then 'B-' || e.l else 'I-' || e.l end as bio from (
 select t.row_id, t.token_no, t.start_char, t.end_char, min(case when g.row_id is not null then {{'n': g.no, 's': g.start_char, 'e': g.end_char, 'l': g.label}} end) as e
 from tokens t left join {g} g on g.row_id = t.row_id and t.start_char < g.end_char and g.start_char < t.end_char group by 1, 2, 3, 4))"""
_EVENTS = "toks as (select user_id, event_id, event_id // 150 as start_char, event_id // 150 + 1 as end_char, case event_type when 'signup' then 'O' when 'click' then 'B-X' when 'view' then 'I-X' when 'error' then 'B-Y' when 'purchase' then 'I-Y' end as label, value as confidence from events)"
_ISLANDS = """select {k}, b as label, min(start_char) as start_char, {end} as end_char, count(*) as n_tokens, {conf} from (
 select *, sum(case when b is null or label like 'B-%' or pb is null or pb <> b {gap} then 1 else 0 end) over (partition by {k} order by {o}) as island from (
  select *, nullif(label[3:], '') as b, lag(nullif(label[3:], '')) over (partition by {k} order by {o}) as pb, lag(end_char) over (partition by {k} order by {o}) as pe from {f})) where b is not null group by {k}, island, b"""
_NORMAL_VALUE = _NORMAL.replace("translate(text,", "translate(value,", 1)
_VARIANTS = rf"""leaves as (select record_id, path, value, text from (select record_id, full_text as text, unnest([{", ".join(f"{{'path': {_q(p)}, 'value': {c}}}" for c, p in ATTRIBUTES.items())}], recursive := true) from vb_documents where full_text is not null)
  where value is not null and trim(value) not in ('', '--')),
 v as (select *, {_NORMAL_VALUE} as n from leaves),
 p as (select *, regexp_replace(rtrim(regexp_extract(n, '(?i)^(.+?\bsố[ \t\n\r]+[^ \t\n\r]+)', 1)), '[.,;:]+$', '') as legal,
   try_strptime(case when regexp_matches(n, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') then n end, '%Y-%m-%d') as d, regexp_replace(n, '[ \t\n\r]*([/-])[ \t\n\r]*', '\1', 'g') as c from v),
 variants as (select record_id, path, value, text, list_filter(list_concat([n, legal], case when d is not null then [strftime(d, '%d/%m/%Y'), day(d) || '/' || month(d) || '/' || strftime(d, '%Y'), 'ngày ' || day(d) || ' tháng ' || month(d) || ' năm ' || strftime(d, '%Y')] else [] end,
   [c, replace(c, '/', '-'), replace(c, '-', '/')]), lambda x: x <> '' and x <> '--') as a from p),
 hits as (select *, len(list_filter(a, lambda x: contains(text, x))) > 0 as e, len(list_filter(a, lambda x: contains(lower(text), lower(x)))) > 0 as f from variants),
 examples as (select path, string_agg(x, ' | ' order by x) as examples from (select path, x, row_number() over (partition by path order by x) as r from (select distinct path, value[:200] as x from leaves)) where r <= 5 group by 1),
 profile as (select path, count(distinct record_id) as documents, count(distinct record_id) / (select count(*) from vb_documents where full_text is not null) as document_rate, count(*) as "values", avg(e::int) as exact_match_rate, avg((not e and f)::int) as normalized_match_rate, avg((e or f)::int) as combined_match_rate, avg(length(value)) as average_length from hits group by 1)"""
_ENTITY = "(combined_match_rate >= 0.2 and average_length <= 250 and not suffix(path, 'item_id') and not suffix(path, 'url_toanvan') and not starts_with(path, 'attribute_json.metadata.'))"
_SHA = "sha256('42|' || {0}::varchar)"
_RELATION_NAMES = "map {" + ", ".join(f"{_q(code)}: {_q(name)}" for code, (name, _) in C.RELATIONS.items()) + "}"
_RELATED = f"(select record_id, concat_ws(chr(10), nullif(array_to_string([coalesce({_RELATION_NAMES}[r.relation_type_code], '') || ': ' || coalesce(r.relation_type, '') for r in relationship_graph.relations], chr(10)), ''), full_text) as t from vb_documents)"
_BLOCKS = f"blocks as (select record_id, n as block_no, line, coalesce(sum(length(line) + 1) over (partition by record_id order by n rows between unbounded preceding and 1 preceding), 0)::bigint as s from ({_LINES.format(k='record_id', t='t', f=_RELATED)}) where not regexp_matches(line, {_BLANK}))"

SQL = {
    "span_search": f"with {_FOUND} select doc_id, label, count(*) as n, sum(start_char)::bigint as sum_start from found group by 1, 2",
    "rule_entities_blocks": f"""with {_BLOCKS}, texts as (select record_id, string_agg(line, chr(10) order by block_no) as text from blocks group by 1), m as (select * from {_matches_sql('record_id', 'text', 'texts', '(?i)(?:' + RELATION_PHRASES + ')', '')})
 select m.record_id, start_char, end_char, block_no, match from m left join blocks b on b.record_id = m.record_id and start_char >= s and start_char < s + length(line)""",
    "entity_summary": f"""with {_GOLD}, l as (select row_id, string_agg(label || ':' || n, ',' order by label) as labels from (select row_id, label, count(*) as n from gold group by 1, 2) group by 1)
 select d.row_id, count(g.row_id) as n_entities, count(distinct lower(g.text)) as n_values, coalesce(max(l.labels), '') as labels, coalesce(avg(confidence), 0) as mean_confidence, coalesce(min(confidence), 0) as min_confidence, coalesce(max(confidence), 0) as max_confidence
 from (select distinct row_id from ner_dataset) d left join gold g on g.row_id = d.row_id left join l on l.row_id = d.row_id group by 1""",
    "json_flatten_props": "select event_id, 'k' as path, json_extract_string(props, '$.k') as value from events",
    "path_profile": f"with {_VARIANTS} select p.*, x.examples from profile p left join examples x on x.path = p.path",
    "label_schema": f"with {_VARIANTS} select path, {_ENTITY} as is_span_entity, case when {_ENTITY} then replace(replace(upper(path), '.', '_'), '[]', '') end as name, case when {_ENTITY} then 'label' when starts_with(path, 'attribute_json.metadata.') then 'metadata' else 'ignored' end as role from profile",
    "weak_labels": f"""with {_VARIANTS}, wanted as (select path from profile where {_ENTITY}), w as (select record_id, path, value, text, unnest(list_distinct(a)) as x from variants where path in (select path from wanted)),
 s as (select record_id, path, value, length(x) as n, strpos(case when length(lower(text)) = length(text) then lower(text) else text end, case when length(lower(text)) = length(text) then lower(x) else x end) as pos from w)
 select record_id, upper(replace(path, '.', '_')) as label, (min({{'s': pos - 1, 'e': pos - 1 + n}})).s::bigint as start_char, (min({{'s': pos - 1, 'e': pos - 1 + n}})).e::bigint as end_char from s where pos > 0 group by record_id, path, value""",
    "systematic_sample": "with r as (select doc_id, row_number() over (order by doc_id) - 1 as k, count(*) over () as n from documents) select doc_id from r where n <= 100 or k in (select floor(i * (n / 100.0::double))::bigint from range(0, 100) as t(i))",
    "hash_split": f"with r as (select doc_id, row_number() over (order by {_SHA.format('doc_id')}, doc_id) - 1 as k, count(*) over () as n from documents) select doc_id, case when k < floor(n * 0.7::double) then 'train' when k < floor(n * 0.7::double) + floor(n * 0.15::double) then 'validation' else 'test' end as split from r",
    "reservoir_topk": f"""with r as (select row_id, coalesce(len(entities), 0) >= 3 as positive from ner_dataset), k as (select *, row_number() over (partition by positive order by {_SHA.format('row_id')}, row_id) as n from r)
 select row_id, positive from k where positive or n <= floor((select count(*) from r where positive) * 0.25::double)""",
    "dataset_manifest": """with l as (select coalesce(document_id, '') || ':' || coalesce(source_sha256, '') as l from ner_dataset), h as (select md5(l)[:4] as r, md5(string_agg(l, chr(10) order by l)) as h from l group by 1)
 select count(*) as documents, sum((split = 'train')::int)::bigint as train, sum((split = 'validation')::int)::bigint as validation, sum((split = 'test')::int)::bigint as test, (select sha256(string_agg(h, '' order by r)) from h) as dataset_hash from ner_dataset""",
    "chunk_windows": f"""with {_TOKENS}, n as (select row_id, max(token_no) + 1 as n from tokens group by 1), c as (select row_id, n, unnest(range(0, case when n <= 254 then 1 else ceil((n - 254) / 190.0)::bigint + 1 end)) as chunk_no from n)
 select c.row_id, 'c' || lpad(chunk_no::varchar, 5, '0') as chunk_id, chunk_no, min(token_no) as first_token, max(token_no) as last_token, min(start_char) as start_char, max(end_char) as end_char from c join tokens t on t.row_id = c.row_id and token_no >= chunk_no * 190 and token_no < chunk_no * 190 + 254 group by c.row_id, chunk_no
 union all select row_id, 'c00000', 0, 0, -1, 0, 0 from ner_dataset where row_id not in (select row_id from n)""",
    "token_align": f"with {_GOLD}, {_TOKENS}, {_ALIGNED.format(n='al', g='gold')} select row_id, bio, count(*) as n, sum(token_no)::bigint as sum_token from al group by 1, 2",
    "bio_vocab": f"with {_GOLD}, l as (select distinct label from gold where label is not null) select p || label as bio, row_number() over (order by label, p) as id from l, (values ('B-'), ('I-')) as t(p) union all select 'O', 0",
    "bio_decode": f"with {_EVENTS}, d as ({_ISLANDS.format(k='user_id', end='max(end_char)', conf='avg(confidence) as confidence', gap='or start_char > pe + 1', o='start_char, end_char, event_id', f='toks')}) select user_id, label, start_char, end_char, n_tokens, round(confidence, 6) as confidence from d",
    "bio_decode_nogap": f"with {_EVENTS}, d as ({_ISLANDS.format(k='user_id', end='arg_max(end_char, event_id)', conf='avg(confidence) as confidence', gap='', o='event_id', f='toks')}) select user_id, label, start_char, end_char, n_tokens, round(confidence, 6) as confidence from d",
    "entity_merge": """select user_id, event_type as label, event_id // 300 as start_char, event_id // 300 + 1 as end_char, count(*) as n_tokens, round(avg(value), 6) as confidence, string_agg(distinct 'c' || json_extract_string(props, '$.k'), ',' order by 'c' || json_extract_string(props, '$.k')) as chunks from events group by 1, 2, 3, 4""",
    "confidence_filter": f"with {_EVENTS} select label, count(*) as n, min(confidence) as least from toks where label = 'O' or confidence >= 20 group by 1",
    "prf_metrics": f"with {_GOLD}, {_PRED}, {_OUT.format(g='gold', p='pred')}, {_SUMS} select label, tp, fp, fn, {_PRF}, tp + fn as support from sums",
    "macro_micro": f"with {_GOLD}, {_PRED}, {_OUT.format(g='gold', p='pred')}, {_SUMS}, t as (select sum(tp) as tp, sum(fp) as fp, sum(fn) as fn from sums) select 'micro' as average, {_PRF} from t union all select 'macro', avg(precision), avg(recall), avg(f1) from (select {_PRF} from sums)",
    "confusion_overlap": f"""with {_GOLD}, {_PRED}, {_OUT.format(g='gold', p='pred')}, w as (select g.label as gold_label, p.label as pred_label, row_number() over (partition by p.row_id, p.start_char, p.end_char, p.label order by least(p.end_char, g.end_char) - greatest(p.start_char, g.start_char) desc, g.start_char, g.end_char, g.label) as k
 from (select * from outcomes where outcome = 'fp') p join (select * from outcomes where outcome <> 'fp') g on g.row_id = p.row_id and p.start_char < g.end_char and g.start_char < p.end_char) select gold_label, pred_label, count(*) as n from w where k = 1 group by 1, 2""",
    "document_counts": f"with {_GOLD}, {_PRED}, g as (select distinct row_id from gold), p as (select distinct row_id from pred) select (select count(*) from g) as documents, (select count(*) from p) as predicted_documents, (select count(*) from g where row_id in (select row_id from p)) as matched_documents, (select count(*) from g where row_id not in (select row_id from p)) as missing_documents, (select count(*) from p where row_id not in (select row_id from g)) as unmatched_documents",
    "sequence_metrics": f"""with {_GOLD}, {_PRED}, {_TOKENS}, pn as (select *, start_char as no from pred), {_ALIGNED.format(n='ga', g='gold')}, {_ALIGNED.format(n='pa', g='pn')},
 gt as (select row_id, token_no, start_char, end_char, bio as label from ga), pt as (select row_id, token_no, start_char, end_char, bio as label from pa),
 gs as ({_ISLANDS.format(k='row_id', end='max(end_char)', conf='1 as confidence', gap='or start_char > pe + 1', o='start_char, end_char, token_no', f='gt')}), ps as ({_ISLANDS.format(k='row_id', end='max(end_char)', conf='1 as confidence', gap='or start_char > pe + 1', o='start_char, end_char, token_no', f='pt')}),
 {_OUT.format(g='gs', p='ps')}, {_SUMS} select label, tp, fp, fn, {_PRF}, tp + fn as support from sums""",
    "split_distribution": "select split, e.label as label, count(*) as n_entities, count(distinct row_id) as n_rows from (select split, row_id, unnest(entities) as e from ner_dataset) where e is not null group by 1, 2",
    "missing_labels": "with s as (select distinct split from ner_dataset where split is not null), w as (select split, l as label from s, (values ('CO_QUAN'), ('SO_HIEU'), ('LOAI_VAN_BAN'), ('NGUOI_KY')) as t(l)) select * from w except select split, e.label from (select split, unnest(entities) as e from ner_dataset)",
    "span_quality": """select row_id, issue, count(*) as n from (
 select row_id, unnest(list_filter([case when coalesce(label in ('CO_QUAN', 'SO_HIEU'), false) then null else 'unknown_label' end, case when not coalesce(start_char >= 0 and start_char < end_char and end_char <= length(doc), false) then 'offset_range' when not coalesce(doc[start_char + 1:end_char] = slice, false) then 'text_mismatch' end], lambda x: x is not null)) as issue
 from (select row_id, doc, e.label as label, e.start_char as start_char, e.end_char as end_char, e.text as slice from (select row_id, text as doc, unnest(entities) as e from ner_dataset) where e is not null)) group by 1, 2""",
    "overlap_check": f"with {_GOLD}, {_PRED}, b as (select row_id, label, start_char, end_char from gold union select row_id, label, start_char, end_char from pred), r as (select *, max(end_char) over (partition by row_id order by start_char, end_char, label rows between unbounded preceding and 1 preceding) as reach from b) select row_id, label, start_char, end_char from r where start_char < reach",
    "dup_spans": f"with {_GOLD}, {_PRED}, b as (select row_id, label, start_char, end_char from gold union all select row_id, label, start_char, end_char from pred) select row_id, label, start_char, end_char, count(*) as n from b group by 1, 2, 3, 4 having count(*) > 1",
    "leakage_check": "select document_id, string_agg(distinct split, ',' order by split) as splits from ner_dataset where document_id is not null and split is not null group by 1 having count(distinct split) > 1",
    "source_accounting": "select item_id, 'no_output' as side from (select distinct item_id from vb_documents where item_id is not null and item_id not in (select document_id from ner_dataset where document_id is not null)) union all select document_id, 'no_source' from (select distinct document_id from ner_dataset where document_id is not null and document_id not in (select item_id from vb_documents where item_id is not null))",
    "zero_entities": "select row_id, 'zero_entities' as warning from ner_dataset where coalesce(len(entities), 0) = 0",
    "required_fields": "select row_id, unnest(list_filter([" + ", ".join(f"case when {c} is null then 'missing_{c}' end" for c in ("document_id", "source_file", "source_sha256", "text", "entities")) + "], lambda x: x is not null)) as issue from ner_dataset",
}
SQL["greedy_select"] = f"""with recursive {_GOLD}, {_PRED}, b as (select row_id, label, start_char, end_char, confidence::double as c from gold union all select row_id, label, start_char, end_char, confidence::double from pred),
 o as (select *, row_number() over (partition by row_id order by c desc, end_char - start_char desc, start_char, label, end_char) as i from b),
 walk as (select row_id, i, [{{'s': start_char, 'e': end_char}}] as chosen, true as taken, label, start_char, end_char, c from o where i = 1
  union all select o.row_id, o.i, case when len(list_filter(w.chosen, lambda y: y.s < o.end_char and o.start_char < y.e)) = 0 then list_append(w.chosen, {{'s': o.start_char, 'e': o.end_char}}) else w.chosen end,
   len(list_filter(w.chosen, lambda y: y.s < o.end_char and o.start_char < y.e)) = 0, o.label, o.start_char, o.end_char, o.c from walk w join o on o.row_id = w.row_id and o.i = w.i + 1)
 select row_id, label, start_char, end_char, round(c, 6) as confidence from walk where taken"""
SQL["span_resolve"] = f"""with recursive {_FOUND}, o as (select *, row_number() over (partition by doc_id order by start_char, start_char - end_char, label) as i from found),
 walk as (select doc_id, i, start_char, label, true as accepted, null::varchar as rejection_reason, end_char as reach, label as holder from o where i = 1
  union all select o.doc_id, o.i, o.start_char, o.label, o.start_char >= w.reach, case when o.start_char < w.reach then 'overlap_with_' || w.holder end, case when o.start_char >= w.reach then o.end_char else w.reach end, case when o.start_char >= w.reach then o.label else w.holder end
  from walk w join o on o.doc_id = w.doc_id and o.i = w.i + 1)
 select doc_id, accepted, rejection_reason, count(*) as n, sum(start_char)::bigint as sum_start from walk group by 1, 2, 3"""

SQL["weak_dataset"] = f"""with recursive w as ({SQL['weak_labels']}), o as (select *, row_number() over (partition by record_id order by start_char, start_char - end_char, label) as i from w),
 walk as (select record_id, i, label, true as accepted, end_char as reach from o where i = 1
  union all select o.record_id, o.i, o.label, o.start_char >= w.reach, case when o.start_char >= w.reach then o.end_char else w.reach end from walk w join o on o.record_id = w.record_id and o.i = w.i + 1),
 r as (select record_id, row_number() over (order by {_SHA.format('record_id')}, record_id) - 1 as k, count(*) over () as n from vb_documents where full_text is not null),
 s as (select record_id, case when k < floor(n * 0.7::double) then 'train' when k < floor(n * 0.7::double) + floor(n * 0.15::double) then 'validation' else 'test' end as split from r)
 select split, label, count(*) as n_spans, count(distinct s.record_id) as n_records from walk join s on s.record_id = walk.record_id where accepted group by 1, 2"""
SQL["stale_outputs"] = """with r as (select document_id, source_sha256 as h, length(text) as n from ner_dataset where document_id is not null),
 c as (select document_id, h, count(*) as k, max(n) as n from r group by 1, 2),
 b as (select *, row_number() over (partition by document_id order by k desc, coalesce(h, '') desc) as place from c)
 select issue, count(*) as n from (select case when r.h is distinct from b.h then 'hash_mismatch' when r.n is distinct from b.n then 'length_mismatch' end as issue from r join b on b.document_id = r.document_id and place = 1) where issue is not null group by 1"""
_LEAF = "case json_type(j) when 'VARCHAR' then 'string' when 'BIGINT' then 'bigint' when 'UBIGINT' then 'bigint' when 'BOOLEAN' then 'boolean' when 'NULL' then 'void' when 'DOUBLE' then 'decimal' else lower(json_type(j)) end"
SQL["json_shapes"] = f"""with recursive nodes as (
  select record_id, '' as path, relationship_graph.raw::json as j from vb_documents where json_valid(relationship_graph.raw)
  union all
  select record_id, case when key is null then path || '[]' when path = '' then key else path || '.' || key end, v from (
    select record_id, path, key, json_extract(j, '/' || replace(replace(key, '~', '~0'), '/', '~1')) as v from (select record_id, path, j, unnest(json_keys(j)) as key from nodes where json_type(j) = 'OBJECT')
    union all select record_id, path, null, json_extract(j, '$[0]') from nodes where json_type(j) = 'ARRAY' and json_array_length(j) > 0)),
 leaves as (select record_id, path || ':' || {_LEAF} as leaf from nodes where json_type(j) not in ('OBJECT', 'ARRAY') or json_type(j) = 'ARRAY' and json_array_length(j) = 0 or json_type(j) = 'OBJECT' and len(json_keys(j)) = 0),
 shapes as (select record_id, string_agg(leaf, chr(10) order by leaf) as shape from leaves group by 1)
 select md5(shape) as shape, length(shape) as n_chars, count(*) as n from shapes group by 1, 2"""
SQL["json_flatten_diagrams"] = """with recursive nodes as (
  select record_id, '' as path, relationship_graph.raw::json as j from vb_documents where json_valid(relationship_graph.raw)
  union all
  select record_id, case when key is null then path || '[]' when path = '' then key else path || '.' || key end, v from (
    select record_id, path, key, json_extract(j, '/' || replace(replace(key, '~', '~0'), '/', '~1')) as v from (select record_id, path, j, unnest(json_keys(j)) as key from nodes where json_type(j) = 'OBJECT')
    union all select record_id, path, null, unnest(json_extract(j, '$[*]')) from nodes where json_type(j) = 'ARRAY'))
 select path, type, count(*) as n, count(distinct record_id) as n_records from (
  select record_id, path, case json_type(j) when 'VARCHAR' then 'string' when 'BIGINT' then 'bigint' when 'UBIGINT' then 'bigint' when 'BOOLEAN' then 'boolean' when 'NULL' then 'void' when 'DOUBLE' then 'decimal' end as type from nodes where json_type(j) not in ('OBJECT', 'ARRAY')) group by 1, 2"""
_HASH = "'^[0-9a-f]{64}$'"
SQL["output_schema"] = f"""with d as (select row_id, unnest([case when document_id is null then 'missing_document_id' end, case when source_sha256 is null then 'missing_source_sha256' end, case when document_id = '' then 'bad_document_id' end, case when source_file = '' then 'bad_source_file' end, case when not regexp_full_match(source_sha256, {_HASH}) then 'bad_source_sha256' end]) as issue from ner_dataset),
 e as (select row_id, unnest(entities) as e from ner_dataset),
 i as (select row_id, unnest([case when e.label is null then 'missing_label' end, case when e.start_char is null then 'missing_start_char' end, case when e.end_char is null then 'missing_end_char' end, case when e.text = '' then 'bad_text' end, case when e.start_char < 0 then 'bad_start_char' end, case when e.end_char < 1 then 'bad_end_char' end,
   case when e.match_score / 100 < 0 or e.match_score / 100 > 1 then 'bad_confidence' end, case when e.match_method not in ('exact', 'normalized') then 'bad_source' end]) as issue from e where e is not null)
 select row_id, issue, count(*) as n from (select * from d union all select * from i) where issue is not null group by 1, 2"""
