"""Queries over documents, vb_documents and ner_dataset, by problem."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import BLANKS
from ..session import table
from . import containers, hyperminhash, lookalikes, markup, names, overlaps, repetition, tokenize


def _registers(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [table(spark, sf_dir, t) for t in ("vb_documents", "officials", "agencies", "job_titles")]


def p1_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every name that denotes an entry, with the spelling there."""
    return names.link_documents(*_registers(spark, sf_dir))


def p1_ambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that several entries fit equally well."""
    return names.ambiguous_names(*_registers(spark, sf_dir))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_links(spark, sf_dir).where("value <> name").select("record_id", "field", "entity_id").distinct()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_elements(spark, sf_dir).select("record_id", "kind", "content").distinct()


def p3_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.markup_elements(table(spark, sf_dir, "vb_documents", "record_id"))


def p3_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.markup_texts(table(spark, sf_dir, "vb_documents", "record_id"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = lookalikes.consistent_values(table(spark, sf_dir, "vb_documents", "record_id"), "record_id", ["signer", "issuer", "full_text"])
    return values.select("record_id", "field", F.sha2(F.col("clean").cast("binary"), 256).alias("clean_sha256")).distinct()


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = overlaps.overlapping_rows(table(spark, sf_dir, "ner_dataset", "row_id"))
    return pairs.select(F.least("eval_id", "train_id").alias("row_a"), F.greatest("eval_id", "train_id").alias("row_b"))


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "ner_dataset", "row_id")
    return overlaps.overlap_report(rows, overlaps.overlapping_rows(rows))


def p5_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-same texts: the containment of an evaluation text in a training text."""
    _, links = overlaps.containments(table(spark, sf_dir, "ner_dataset", "row_id"))
    return links.select("a", "b", "shared", F.round(F.col("shared") / F.col("n_a"), 9).alias("containment"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = hyperminhash.member_pairs(*hyperminhash.near_duplicates(table(spark, sf_dir, "vb_documents", "record_id")))
    return pairs.select(F.col("row_a").alias("record_a"), F.col("row_b").alias("record_b"))


def p7_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record: its class, and the number of other classes that it is linked to."""
    classes, links = hyperminhash.near_duplicates(table(spark, sf_dir, "vb_documents", "record_id"))
    per_class = links.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("n"))
    return classes.join(per_class, "class_id", "left").select("record_id", "class_id", F.coalesce("n", F.lit(0)).alias("n_links"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize.encode_documents(table(spark, sf_dir, "documents", "doc_id"))


def p9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containers.pack_documents(table(spark, sf_dir, "documents", "doc_id"), table(spark, sf_dir, "pack_sizes"))


def p9_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers of each kind, and the share of their capacity that is used."""
    return containers.fill_report(p9_pack(spark, sf_dir), table(spark, sf_dir, "pack_sizes"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_repetition(spark, sf_dir).where("failed").select("doc_id").distinct()


def p10_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its repetition and the verdict on its source."""
    rows = repetition.repetition(table(spark, sf_dir, "documents", "doc_id"))
    return rows.withColumns({c: F.round(c, 9) for c in ("share", "host_rate")})


QUERIES = {
    "p1_found": p1_found,
    "p1_links": p1_links,
    "p1_ambiguous": p1_ambiguous,
    "p3_found": p3_found,
    "p3_elements": p3_elements,
    "p3_texts": p3_texts,
    "p4_found": p4_found,
    "p5_found": p5_found,
    "p5_report": p5_report,
    "p5_containment": p5_containment,
    "p7_found": p7_found,
    "p7_classes": p7_classes,
    "p8_ids": p8_ids,
    "p9_pack": p9_pack,
    "p9_fill": p9_fill,
    "p10_found": p10_found,
    "p10_repetition": p10_repetition,
}

_WORDS = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')"
_BLANK_ENDS = "'" + f"^[{BLANKS}\n\r]+|[{BLANKS}\n\r]+$" + "'"
_KNOWN = f"nullif(lower(regexp_replace({{0}}, {_BLANK_ENDS}, '', 'g')), '')"
_SIDES = "(select row_id, {k} as k from ner_dataset where split <> 'train') e join (select row_id, {k} as k from ner_dataset where split = 'train') t on e.k = t.k where not regexp_matches(e.k, '^[0\\-\\s]*$')"
_OVERLAPS = f"""w as (select row_id, split, {_WORDS} as w from ner_dataset where text <> '' and split is not null),
 s as (select distinct row_id, split, array_to_string(w[i:i + 2], ' ') as g from (select row_id, split, w, unnest(range(1, len(w)::bigint - 1)) as i from w)),
 n as (select row_id, count(*) as n from s group by 1),
 c as (select e.row_id as eval_id, t.row_id as train_id, count(*) as c from s e join s t on e.g = t.g where e.split <> 'train' and t.split = 'train' group by 1, 2),
 near as (select eval_id, train_id, c, a.n as n_a, b.n as n_b from c join n a on a.row_id = eval_id join n b on b.row_id = train_id where 10 * c >= 7 * (a.n + b.n - c)),
 pairs as (select eval_id, train_id from near
  union select e.row_id, t.row_id from {_SIDES.format(k=_KNOWN.format('document_id'))}
  union select e.row_id, t.row_id from {_SIDES.format(k=_KNOWN.format('source_sha256'))}
  union select e.row_id, t.row_id from ner_dataset e join ner_dataset t on e.text = t.text where e.split <> 'train' and t.split = 'train' and e.text <> '')"""



def _translation(source: dict[str, str]) -> tuple[str, str]:
    """The characters of a table, and those composed from them with marks, with what they become; as SQL literals."""
    pairs = {}
    for i in range(0x80, 0x1FFFF):
        base, *marks = unicodedata.normalize("NFD", chr(i))
        if base in source and len(out := unicodedata.normalize("NFC", source[base] + "".join(marks))) == 1:
            pairs[chr(i)] = out
    return "'" + "".join(pairs) + "'", "'" + "".join(pairs.values()) + "'"


_WIDE = dict(zip((chr(0xFF01 + i) for i in range(94)), (chr(0x21 + i) for i in range(94))))
_SINGLE = ["'" + "".join(d).replace("'", "''") + "'" for d in ([*_WIDE, *lookalikes.STROKED], [*_WIDE.values(), *lookalikes.STROKED.values()])]
_WORD = r"'[\p{L}\p{N}][\p{L}\p{N}\x{300}-\x{36f}]*'"


def _consistent_sql(source: str) -> str:
    """SQL for (id, clean) of a source (id, value): words with Latin letters get the Latin look-alikes, the rest is by character."""
    plain = f"nfc_normalize(translate(regexp_replace(regexp_replace(value, '[{lookalikes.WIDTHLESS}]', '', 'g'), '[{lookalikes.BLANKS}]', ' ', 'g'), {_SINGLE[0]}, {_SINGLE[1]}))"
    old, new = _translation(lookalikes.CONFUSABLE)
    return f"""(select id, nfc_normalize(string_agg(gap || case when regexp_matches(word, '\\p{{Latin}}') then translate(word, {old}, {new}) else word end, '' order by i)) as clean from (
  select id, unnest(string_split_regex(v, {_WORD})) as gap, unnest(list_append(regexp_extract_all(v, {_WORD}), '')) as word, unnest(range(0, len(regexp_extract_all(v, {_WORD}))::bigint + 1)) as i from (select id, {plain} as v from {source})) group by 1)"""


_FIELDS = "(select {'r': record_id, 'f': f, 'v': v} as id, v as value from (select record_id, unnest(['signer', 'issuer', 'full_text']) as f, unnest([signer, issuer, full_text]) as v from vb_documents) where v is not null and v <> '')"
_BODIES = "(select record_id as id, full_text as value from vb_documents where full_text <> '')"

_NEAR = f"""t as (select id, regexp_extract_all(lower(coalesce(title, '') || chr(10) || clean), '[\\p{{L}}\\p{{N}}]+') as w from {_consistent_sql(_BODIES)} join vb_documents on record_id = id),
 s as (select distinct id, array_to_string(w[i:i + 2], ' ') as g from (select id, w, unnest(range(1, len(w)::bigint - 1)) as i from t)),
 n as (select id, count(*) as n from s group by 1),
 c as (select a.id as a, b.id as b, count(*) as c from s a join s b on a.g = b.g and a.id < b.id group by 1, 2),
 near as (select a, b from c join n x on x.id = a join n y on y.id = b where 10 * c >= 7 * (x.n + y.n - c))"""

#: Feasible at the scale of the correctness gate; above it the full comparison is what the operators avoid.
SQL = {
    "p4_found": f"select distinct id.r as record_id, id.f as field, sha256(clean) as clean_sha256 from {_consistent_sql(_FIELDS)} where clean <> id.v",
    "p7_found": f"with {_NEAR} select a as record_a, b as record_b from near",
    "p7_classes": f"""with {_NEAR}, h as (select id, md5(string_agg(g, '|' order by g)) as h from s group by 1), k as (select id, min(id) over (partition by h) as class_id from h),
 l as (select class_id, count(*) as n from (select unnest([a, b]) as class_id, a, b from near) where a in (select class_id from k) and b in (select class_id from k) group by 1)
 select id as record_id, k.class_id, coalesce(n, 0) as n_links from k left join l on l.class_id = k.class_id""",
    "p5_found": f"with {_OVERLAPS} select least(eval_id, train_id) as row_a, greatest(eval_id, train_id) as row_b from pairs",
    "p5_report": f"with {_OVERLAPS}, k as (select eval_id, count(*) as n from pairs group by 1) select split, source, count(*) as n_rows, count(n) as n_overlapping, coalesce(sum(n), 0)::bigint as n_pairs from ner_dataset left join k on eval_id = row_id where split <> 'train' group by 1, 2",
    "p5_containment": f"""with t as (select text, min(row_id) as id, bool_or(split is null or split <> 'train') as asked, bool_or(split = 'train') as held from ner_dataset where text <> '' group by 1),
 w as (select id, asked, held, {_WORDS} as w from t),
 s as (select distinct id, asked, held, array_to_string(w[i:i + 2], ' ') as g from (select *, unnest(range(1, len(w)::bigint - 1)) as i from w)),
 n as (select id, count(*) as n from s group by 1),
 c as (select e.id as a, t.id as b, count(*)::bigint as shared from s e join s t on e.g = t.g and e.id <> t.id where e.asked and t.held group by 1, 2)
 select a, b, shared::int as shared, round(shared / x.n, 9) as containment from c join n x on x.id = a join n y on y.id = b where 10 * shared >= 7 * (x.n + y.n - shared)""",
    "p10_repetition": f"""with w as (select doc_id, source, {_WORDS} as w from documents),
 g as (select doc_id, i, array_to_string(w[i:i + 7], ' ') as g from (select doc_id, w, unnest(range(1, len(w)::bigint - 6)) as i from w)),
 f as (select doc_id, i, min(i) over (partition by doc_id, g) as first from g),
 m as (select doc_id, count(distinct i + k) as n from f, range(0, 8) as t(k) where first < i group by 1),
 d as (select w.doc_id, source, coalesce(len(w), 0)::bigint as n_words, coalesce(n, 0)::bigint as n_repeated from w left join m on m.doc_id = w.doc_id),
 r as (select *, case when n_words > 0 then n_repeated / n_words else 0.0 end as share, n_words >= 40 and n_repeated * 10 >= n_words * 3 as failed from d),
 h as (select source, count(*) as n, count(*) filter (where failed) as bad from r where source is not null group by 1),
 t as (select sum(n) as docs, sum(bad) / sum(n) as mean, 1 - sum(n * n) / (sum(n) * sum(n)) as between_hosts, (count(*) - 1) / sum(n) as within_hosts, sum(bad * bad / n) / sum(n) - (sum(bad) / sum(n)) * (sum(bad) / sum(n)) as seen from h),
 p as (select mean, 1 / least(greatest((seen - mean * (1 - mean) * within_hosts) / (mean * (1 - mean) * (between_hosts - within_hosts)), 1e-6), 0.5) - 1 as weight from t),
 v as (select source, (bad + mean * weight) / (n + weight) as host_rate from h, p)
 select doc_id, r.source, n_words, n_repeated, round(share, 9) as share, failed, round(host_rate, 9) as host_rate, host_rate > 0.1 as host_bad from r left join v on v.source = r.source""",
    "p10_found": f"""with w as (select doc_id, {_WORDS} as w from documents where text is not null),
 g as (select doc_id, i, array_to_string(w[i:i + 7], ' ') as g from (select doc_id, w, unnest(range(1, len(w)::bigint - 6)) as i from w)),
 f as (select doc_id, i, min(i) over (partition by doc_id, g) as first from g),
 m as (select doc_id, count(distinct i + k) as n from f, range(0, 8) as t(k) where first < i group by 1)
 select w.doc_id from w join m on m.doc_id = w.doc_id where len(w) >= 40 and n * 10 >= len(w) * 3""",
}
