"""Queries over texts: normalization, lines, articles, signatures, names and dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..functions import text as X
from ..operators import articles, spans
from ..session import table


def _q(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


_B = X.BLANKS


def normalize_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = X.normalize_fast(F.col("text"))
    return table(spark, sf_dir, "documents", "doc_id").select("doc_id", F.length(text).cast("bigint").alias("n_chars"), F.md5(text).alias("digest"))


_NORMAL = f"translate(text, {_q(X.PLAIN_FROM)}, {_q(X.PLAIN_TO)})"
for _p, _r in ((f"[{X.INVISIBLE}]", ""), (f"[{_B}]+", " "), (" *\n[ \n]*", "\n"), ("^ +|[ \n]+$", "")):
    _NORMAL = f"regexp_replace({_NORMAL}, {_q(_p)}, {_q(_r)}, 'g')"


def accent_fold_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.col("title")
    return table(spark, sf_dir, "list_items").select("title").distinct().select("title", X.fold(title).alias("folded"), X.slug(title).alias("slug"))


_FOLDED = f"lower(trim(regexp_replace(replace(replace(strip_accents(nfc_normalize(coalesce({{0}}, ''))), 'đ', 'd'), 'Đ', 'D'), {_q(f'[{_B}' + chr(10) + chr(13) + ']+')}, ' ', 'g')))"
_SLUG = "coalesce(nullif(lower(regexp_replace(regexp_replace(replace(replace(strip_accents(nfc_normalize(coalesce({0}, ''))), 'đ', 'd'), 'Đ', 'D'), '[^A-Za-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')), ''), 'van-ban')"


def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "list_items").select("doc_number", "type_id", "keyword").distinct()
    return rows.select("doc_number", "type_id", "keyword", X.safe_filename(F.col("doc_number")).alias("file"), X.cache_key(F.col("type_id"), F.col("keyword"), 50).alias("cache"))


_SAFE = r"coalesce(nullif(regexp_replace(regexp_replace(coalesce({0}, ''), '[^\p{{L}}\p{{N}}_\-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), {1})"


def html_text_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = X.html_text(F.col("content_html"))
    rows = table(spark, sf_dir, "vb_documents", "record_id").select("record_id", text.alias("t"))
    return rows.select("record_id", F.md5("t").alias("digest"), F.length("t").cast("bigint").alias("n_chars"), F.size(F.split("t", "\n")).cast("bigint").alias("n_lines"))


_HTML = "coalesce(content_html, '')"
for _p, _r in X.HTML_STEPS:
    _HTML = f"regexp_replace({_HTML}, {_q(_p)}, {_q(_r)}, 'g')"


def url_id_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.collection import item_id_of

    none = F.lit("")
    rows = table(spark, sf_dir, "list_items").select("url", "api_detail_url").distinct()
    return rows.select("url", "api_detail_url", item_id_of(none, F.col("url"), F.col("api_detail_url")).alias("id"))


def article_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = articles.split_articles(table(spark, sf_dir, "vb_documents", "record_id"), "full_text", ["record_id"])
    return rows.select("record_id", F.col("article_no").cast("bigint").alias("article_no"), "article_number", "title", F.md5("content").alias("digest"))


def sentence_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = articles.sentence_offsets(table(spark, sf_dir, "documents", "doc_id"), "text", ["doc_id"])
    return rows.select("doc_id", *[F.col(c).cast("bigint").alias(c) for c in ("sentence_no", "start_char", "end_char")])


def line_blocks_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spans.blocks_of(table(spark, sf_dir, "documents", "doc_id"), "text", ["doc_id"])
    return rows.select("doc_id", *[F.col(c).cast("bigint").alias(c) for c in ("block_no", "start_char", "end_char")])


def line_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = articles.text_lines(table(spark, sf_dir, "documents", "doc_id"), "text", ["doc_id"])
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).cast("bigint").alias("n_chars"))


def person_title_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "vb_documents", "record_id").select("record_id", F.explode(F.split("full_text", "\n")).alias("line"))
    flags = lines.select("record_id", X.is_signature_title(F.col("line")).cast("bigint").alias("t"), X.is_person_name(F.col("line")).cast("bigint").alias("p"))
    return flags.groupBy("record_id").agg(F.count("*").alias("n_lines"), F.sum("t").alias("n_titles"), F.sum("p").alias("n_names"))


def signature_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signer and title read back from the foot of a page, made of what each record has of both."""
    foot = F.concat_ws("\n", "doc_number", "signer_title", F.lit("(Đã ký)"), "signer")
    docs = table(spark, sf_dir, "vb_documents", "record_id").select("record_id", foot.alias("foot"))
    return articles.signatures(articles.text_lines(docs, "foot", ["record_id"]), ["record_id"])


def api_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = F.filter("issuing_people", lambda p: p.isNotNull())
    return table(spark, sf_dir, "vb_documents", "record_id").where("issuing_people is not null").select("record_id", articles.column_signature(people).alias("s")).select("record_id", "s.*")


def value_variants_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "list_items").select(F.explode(F.array(X.date_head(F.col("issue_date")), F.col("doc_number"), F.col("title"))).alias("value")).where("value is not null").distinct()
    return rows.select("value", F.array_join(X.value_variants(F.col("value")), "\n").alias("variants"))


def base64_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.rtrim(F.base64(F.col("text").cast("binary")), F.lit("="))
    rows = table(spark, sf_dir, "documents", "doc_id").where("text is not null")
    return rows.select("doc_id", F.md5(X.payload_bytes(payload)).alias("digest"), X.hex_length(F.hex(F.length("text").cast("bigint"))).alias("n"))


def sha_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by content hash: the first of each, and how many share it."""
    rows = table(spark, sf_dir, "documents", "doc_id").where("text is not null").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    return rows.groupBy("sha256").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n_docs"))


def match_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles in the form in which they are compared."""
    return table(spark, sf_dir, "list_items").select("title").distinct().where("title is not null").select("title", N.match_form("title").alias("form"))


def raw_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the normalized text of a document lies in the raw one."""
    rows = table(spark, sf_dir, "documents", "doc_id").where("text is not null").select("doc_id", N.normalized("text").alias("n"))
    whole = N.span_to_raw(F.col("n.offsets"), F.lit(0), F.length("n.text"))
    return rows.where("n.text <> ''").select("doc_id", whole["start"].cast("bigint").alias("start_char"), whole["end"].cast("bigint").alias("end_char"))


QUERIES = {f.__name__: f for f in (match_forms, raw_spans, normalize_fast, accent_fold_slug, safe_names, html_text_regex, url_id_extract, article_split, sentence_offsets, line_blocks_offsets, line_dedupe, person_title_predicates, signature_windows, api_signatures, value_variants_dates, base64_decode, sha_fingerprint)}

#: A line of white space only, as a SQL literal.
_BLANK = _q(f"^[{_B}\n\r]*$")
_LINES = "select {k}, unnest(string_split({t}, chr(10))) as line, generate_subscripts(string_split({t}, chr(10)), 1) - 1 as n from {f} where {t} is not null"
_ONE_LINE = f"trim(regexp_replace(coalesce(line, ''), {_q(f'[{_B}' + chr(10) + chr(13) + ']+')}, ' ', 'g'))"
_TITLE = f"(length(upper({_ONE_LINE})) <= 160 and not regexp_matches(upper({_ONE_LINE}), {_q('^(?:' + X._quoted(X.RECIPIENTS) + ')')}) and regexp_matches(upper({_ONE_LINE}), {_q('^(?:' + X._quoted(X.TITLE_MARKERS) + ')')}))"
_NAME = rf"""(not regexp_matches({_ONE_LINE}, '[0-9]') and not regexp_matches(upper({_ONE_LINE}), {_q(X._quoted(X.NOT_IN_NAMES))})
 and len(string_split({_ONE_LINE}, ' ')) between 2 and 6
 and len(list_filter(string_split({_ONE_LINE}, ' '), lambda w: regexp_matches(w[1:1], '\p{{L}}') and not regexp_matches(w[1:1], '\p{{Lu}}'))) = 0)"""
_TRIM = f"regexp_replace({{0}}, {_q(f'^[{_B}' + chr(10) + chr(13) + ']+|[' + _B + chr(10) + chr(13) + ']+$')}, '', 'g')"

_ARTICLE = _q(articles.ARTICLE.replace("(?iu)", "(?i)"))

SQL = {
    "normalize_fast": f"select doc_id, length({_NORMAL}) as n_chars, md5({_NORMAL}) as digest from documents",
    "accent_fold_slug": f"select distinct title, {_FOLDED.format('title')} as folded, {_SLUG.format('title')} as slug from list_items",
    "safe_names": f"""select distinct doc_number, type_id, keyword, {_SAFE.format('doc_number', _q('untitled'))} as file,
 'list_items_type_' || coalesce(nullif(type_id, ''), 'all') || '_' || coalesce(nullif(regexp_replace(trim(coalesce(keyword, '')), '[^A-Za-z0-9_-]+', '_', 'g'), ''), 'no_keyword') || '_ps50.jsonl' as cache from list_items""",
    "html_text_regex": f"select record_id, md5(t) as digest, length(t) as n_chars, len(string_split(t, chr(10))) as n_lines from (select record_id, {_HTML} as t from vb_documents)",
    "url_id_extract": r"""select distinct url, api_detail_url, coalesce(nullif(regexp_extract(url, '(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}'), ''), nullif(regexp_extract(url, '--([0-9]+)(?:[?#]|$)', 1), ''),
 nullif(regexp_extract(api_detail_url, '(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}'), ''), nullif(regexp_extract(api_detail_url, '--([0-9]+)(?:[?#]|$)', 1), ''), '') as id from list_items""",
    "article_split": f"""select record_id, article_no, regexp_extract(mark, '([0-9]+)$', 1) as article_number, {_TRIM.format("mark || rest[:instr(rest, chr(10)) - 1]")} as title,
 md5({_TRIM.format("rest[instr(rest, chr(10)) + 1:]")}) as digest
 from (select record_id, unnest(regexp_extract_all(full_text, {_ARTICLE})) as mark, unnest(string_split_regex(full_text, {_ARTICLE})[2:]) as rest,
   unnest(range(1, len(regexp_extract_all(full_text, {_ARTICLE}))::bigint + 1)) as article_no from vb_documents where full_text is not null)
 where instr(rest, chr(10)) > 0""",
    "sentence_offsets": r"""with gaps as (select doc_id, text, regexp_extract_all(text, '[.!?;][ \t\n\r\x0b\f]+') as g from documents where text is not null),
 pieces as (select doc_id, text, string_split_regex(text, '[.!?;][ \t\n\r\x0b\f]+') as b, g from gaps),
 rows as (select doc_id, text, unnest(b) as piece, unnest(list_append(g, '')) as gap, unnest(range(0, len(b)::bigint)) as sentence_no from pieces)
 select doc_id, sentence_no, start_char, start_char + length(piece) + least(length(gap), 1) as end_char from (
   select *, coalesce(sum(length(piece) + length(gap)) over (partition by doc_id order by sentence_no rows between unbounded preceding and 1 preceding), 0)::bigint as start_char from rows)""",
    "line_blocks_offsets": f"""select doc_id, n as block_no, start_char, start_char + length(line) as end_char from (
 select doc_id, n, line, coalesce(sum(length(line) + 1) over (partition by doc_id order by n rows between unbounded preceding and 1 preceding), 0)::bigint as start_char
 from ({_LINES.format(k='doc_id', t='text', f='documents')}) where not regexp_matches(line, {_BLANK}))""",
    "line_dedupe": f"""select doc_id, count(*) as n_lines, sum(length(line))::bigint as n_chars from (select *, lag(line) over (partition by doc_id order by n) as b from ({_LINES.format(k='doc_id', t='text', f='documents')})) where line is distinct from b group by 1""",
    "person_title_predicates": f"select record_id, count(*) as n_lines, sum({_TITLE}::int)::bigint as n_titles, sum({_NAME}::int)::bigint as n_names from ({_LINES.format(k='record_id', t='full_text', f='vb_documents')}) group by 1",
    "api_signatures": "select record_id, coalesce(array_to_string(list_filter([p.person_name for p in issuing_people if p is not null], lambda x: coalesce(x, '') <> ''), ', '), '') as signer, coalesce(array_to_string(list_filter([p.job_title_name for p in issuing_people if p is not null], lambda x: coalesce(x, '') <> ''), ', '), '') as signer_title from vb_documents where issuing_people is not null",
    "base64_decode": "select doc_id, md5(text) as digest, length(text) as n from documents where text is not null",
    "sha_fingerprint": "select sha256(text) as sha256, min(doc_id) as first_doc, count(*) as n_docs from documents where text is not null group by 1",
}

_VALUES = "select distinct v as value from (select unnest([split_part(coalesce(issue_date, ''), 'T', 1), doc_number, title]) as v from list_items) where v is not null"
_NORMAL_VALUE = _NORMAL.replace("translate(text,", "translate(value,", 1)
SQL["value_variants_dates"] = rf"""with v as (select value, {_NORMAL_VALUE} as n from ({_VALUES})),
 p as (select *, regexp_replace(rtrim(regexp_extract(n, '(?i)^(.+?\bsố[ \t\n\r]+[^ \t\n\r]+)', 1)), '[.,;:]+$', '') as legal,
   try_strptime(case when regexp_matches(n, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') then n end, '%Y-%m-%d') as d, regexp_replace(n, '[ \t\n\r]*([/-])[ \t\n\r]*', '\1', 'g') as c from v),
 e as (select value, list_filter(list_concat([n, legal], case when d is not null then [strftime(d, '%d/%m/%Y'), day(d) || '/' || month(d) || '/' || strftime(d, '%Y'), 'ngày ' || day(d) || ' tháng ' || month(d) || ' năm ' || strftime(d, '%Y')] else [] end,
   [c, replace(c, '/', '-'), replace(c, '-', '/')]), lambda x: x <> '' and x <> '--') as a from p)
 select value, coalesce(array_to_string(list_filter(a, lambda x, i: list_position(a, x) = i), chr(10)), '') as variants from e"""

_IS_NAME = _NAME.replace("line", "own")
SQL["signature_windows"] = rf"""with l as (select record_id, line, n, lag(line) over (partition by record_id order by n) as b from ({_LINES.format(k='record_id', t='t', f="(select record_id, concat_ws(chr(10), doc_number, signer_title, '(Đã ký)', signer) as t from vb_documents)")})),
 k as (select record_id, line, row_number() over (partition by record_id order by n) as r, {_TITLE} as is_title, {_NAME} as is_name, trim(regexp_extract(line, '(?i)\(?đã ký\)?[ \t]*(.+)$', 1)) as own from l where line is distinct from b),
 p as (select record_id, r, case when own <> '' and {_IS_NAME} then own end as own from k where contains(line, 'Đã ký') or contains(line, 'Ðã ký')),
 f as (select p.record_id, p.r, any_value(p.own) as own, list(k.line order by k.r) filter (is_title and k.r <= p.r) as up, list(k.line order by k.r) filter (is_name and k.r > p.r) as down from p join k on k.record_id = p.record_id and k.r between p.r - 5 and p.r + 7 group by 1, 2),
 g as (select record_id, r, case when len(up) > 0 then trim(regexp_replace(array_to_string(up[-3:], ' '), '\(?Đã ký\)?.*$', '')) end as title, coalesce(down[1], own) as name from f)
 select record_id, arg_min(name, r) filter (name is not null) as signer, arg_min(title, r) filter (title is not null) as signer_title from g group by 1 having max(name) is not null or max(title) is not null"""
SQL["match_forms"] = f"select distinct title, lower(nfc_normalize({_NORMAL_VALUE.replace('translate(value,', 'translate(title,', 1)})) as form from list_items where title is not null"
_GONE = f"[{_B}\n\r\x1c-\x1f\x85\u2028\u2029{X.INVISIBLE}]"
SQL["raw_spans"] = f"""select doc_id, length(text) - length(regexp_replace(text, {_q('^' + _GONE + '+')}, '')) as start_char, length(regexp_replace(text, {_q(chr(92) + 'p{M}*' + _GONE + '*$')}, '')) as end_char
 from documents where regexp_replace(text, {_q(_GONE)}, '', 'g') <> ''"""
