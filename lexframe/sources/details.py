"""Fetched records: the replies for an item and its diagram, and the record that they make."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.collection import RELATIONS, item_id_of
from ..operators.inlining import DIRECTIONS
from .listing import with_retries

#: Gives the reply for an id as JSON text, or null; the second argument asks for the diagram.
Transport = Callable[[str, bool], str | None]


def folder_details(folder: str) -> Transport:
    """Replies that lie as <id>.json and <id>.diagram.json in a folder."""

    def get(item: str, diagram: bool) -> str | None:
        path = Path(folder, f"{item}{'.diagram' * diagram}.json")
        return path.read_text(encoding="utf-8") if path.exists() else None

    return get


def fetch_replies(items: DataFrame, transport: Transport, attempts: int = 3, delay: float = 0.0) -> DataFrame:
    """Items with `detail` and `diagram`, JSON text; null where a reply failed. Items without an id are left out.

    Executors fetch, one item after the other in each task; a task that is lost fetches its items again.
    """
    found = items.withColumn("_id", item_id_of(F.col("item_id"), F.col("url_toanvan"), F.col("url"))).where("_id <> ''")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            replies = [[with_retries(lambda i=i, d=d: transport(i, d), attempts, delay) for d in (False, True)] for i in part["_id"]]
            yield part.assign(detail=[r[0] for r in replies], diagram=[r[1] for r in replies])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)
    return found.mapInPandas(run, f"{fields}, detail string, diagram string").withColumn("item_id", F.col("_id")).drop("_id")


def _unwrapped(text: Column) -> Column:
    """A reply's `data` where that is an object, else the reply."""
    return X.bound(F.try_parse_json(text), lambda v: F.when(F.schema_of_variant(F.try_variant_get(v, "$.data", "variant")).startswith("OBJECT"), F.try_variant_get(v, "$.data", "variant")).otherwise(v))


def _scalar(v: Column, path: str) -> Column:
    """A member that is text or a number, as text; null otherwise and where empty."""
    member = F.try_variant_get(v, f"$.{path}", "variant")
    return F.when(F.schema_of_variant(member).rlike("^(STRING|BIGINT|DECIMAL|DOUBLE)"), F.nullif(F.try_variant_get(member, "$", "string"), F.lit("")))


def _named(v: Column, path: str) -> Column:
    """A member's name, title or code where it is an object, else the member as text."""
    return F.coalesce(_scalar(v, path), *(_scalar(v, f"{path}.{n}") for n in ("name", "title", "code")))


def _objects(v: Column, path: str) -> Column:
    entries = F.coalesce(F.try_variant_get(v, f"$.{path}", "array<variant>"), F.expr("cast(array() as array<variant>)"))
    return F.filter(entries, lambda e: F.coalesce(F.schema_of_variant(e).startswith("OBJECT"), F.lit(False)))


def _names(v: Column, path: str) -> Column:
    entries = F.coalesce(F.try_variant_get(v, f"$.{path}", "array<variant>"), F.expr("cast(array() as array<variant>)"))
    return X.join_names(F.transform(entries, lambda e: F.coalesce(F.when(F.schema_of_variant(e).startswith("STRING"), F.try_variant_get(e, "$", "string")), *(_scalar(e, n) for n in ("name", "title", "code")))))


def records(replies: DataFrame, base_url: str = "https://example.invalid/van-ban/chi-tiet/") -> DataFrame:
    """One record for each item whose detail could be read, in the columns of vb_documents.

    A field comes from the reply, or else from the listing's item, or is empty. The text is that of the page, without
    lines equal to the one before, or else the summary. Signers are the people that the reply names. All thirty
    relations are there, empty ones too. Everything is a column expression; nothing is shuffled.
    """
    d, g = F.col("_d"), F.col("_g")
    text = lambda *c: F.coalesce(*c, F.lit(""))
    item = lambda c: F.nullif(F.col(c), F.lit("")) if c in replies.columns else F.lit(None).cast("string")
    date = lambda n: F.nullif(X.date_head(_scalar(d, n)), F.lit(""))
    url = lambda i: F.when(i != "", F.concat(F.lit(base_url), i)).otherwise("")

    people = F.transform(
        _objects(d, "documentIssues"),
        lambda p: F.struct(
            *[text(_scalar(p, n)).alias(a) for n, a in (("agencyId", "agency_id"), ("agencyName", "agency_name"), ("personId", "person_id"), ("personName", "person_name"), ("jobTitleId", "job_title_id"), ("jobTitleCode", "job_title_code"), ("jobTitleName", "job_title_name"))],
            F.try_variant_get(p, "$.orderIndex", "int").alias("order_index"),
        ),
    )
    listed = _objects(d, "documentRelatedList")

    def related(e: Column) -> Column:
        inner = F.try_variant_get(e, "$.document", "variant")
        doc = F.when(F.schema_of_variant(inner).startswith("OBJECT"), inner).otherwise(e)
        found = text(_scalar(doc, "id"), _scalar(doc, "docId"))
        return F.struct(found.alias("item_id"), text(_scalar(doc, "title"), _scalar(e, "title")).alias("title"), text(_scalar(doc, "docNum"), _scalar(e, "docNum")).alias("doc_number"), url(found).alias("url"))

    def referred(e: Column) -> Column:
        found = text(_scalar(e, "id"), _scalar(e, "docId"))
        return F.struct(found.alias("item_id"), text(_scalar(e, "name"), _scalar(e, "title")).alias("title"), url(found).alias("url"))

    relations = F.array(
        *[
            F.struct(F.lit(code).alias("relation_type_code"), F.lit(way).alias("direction"), F.lit(names[i]).alias("relation_type"), F.filter(F.transform(_objects(g, f"{DIRECTIONS[way]}['{code}']"), referred), lambda x: x["item_id"] != "").alias("documents"))
            for code, names in RELATIONS.items()
            for i, way in enumerate(("outgoing", "incoming"))
        ]
    )
    rows = replies.withColumn("_d", _unwrapped(F.col("detail"))).withColumn("_g", _unwrapped(F.col("diagram")))
    rows = rows.where(F.schema_of_variant("_d").startswith("OBJECT")).withColumn("_people", people).withColumn("content_html", text(_scalar(d, "documentContent.content")))
    page = F.array_join(X.html_lines(F.col("content_html")), "\n")
    from_people = lambda n: F.nullif(X.join_names(F.transform("_people", lambda p: p[n])), F.lit(""))
    return rows.select(
        "item_id",
        text(item("url_toanvan"), item("url"), url(F.col("item_id"))).alias("url_toanvan"),
        text(_scalar(d, "title"), item("title")).alias("title"),
        text(_scalar(d, "docNum"), item("doc_number")).alias("doc_number"),
        text(_named(d, "docType"), item("doc_type")).alias("doc_type"),
        text(date("issueDate"), item("issue_date")).alias("issue_date"),
        text(date("effFrom"), item("effective_date")).alias("effective_date"),
        text(date("effTo")).alias("expiration_date"),
        text(_scalar(d, "agencyName"), _named(d, "organization"), item("issuer")).alias("issuer"),
        text(_scalar(d, "signer"), _scalar(d, "signerName"), from_people("person_name")).alias("signer"),
        text(_scalar(d, "signerTitle"), _scalar(d, "positionName"), _scalar(d, "position"), from_people("job_title_name")).alias("signer_title"),
        text(_scalar(d, "gazetteNumber")).alias("gazette_number"),
        text(date("gazetteDate")).alias("gazette_date"),
        _names(d, "documentMajors").alias("industry"),
        _names(d, "documentFields").alias("field"),
        text(_scalar(d, "scope")).alias("scope"),
        text(_named(d, "effStatus"), _scalar(d, "status"), item("status")).alias("status"),
        F.col("_people").alias("issuing_people"),
        text(F.nullif(page, F.lit("")), _scalar(d, "docAbs"), item("summary")).alias("full_text"),
        F.transform(F.when(F.size(listed) > 0, listed).otherwise(_objects(d, "references")), related).alias("related_docs"),
        F.struct(F.struct(text(_scalar(d, "id")).alias("item_id"), text(_scalar(d, "title")).alias("title")).alias("current_document"), relations.alias("relations"), F.col("diagram").alias("raw")).alias("relationship_graph"),
        "content_html",
        F.expr("cast(array() as array<string>)").alias("attached_files"),
    )


def failures(replies: DataFrame) -> DataFrame:
    """(item_id, reason) of items whose detail wasn't fetched or isn't an object."""
    bad = F.when(F.col("detail").isNull(), "not_fetched").when(~F.coalesce(F.schema_of_variant(_unwrapped(F.col("detail"))).startswith("OBJECT"), F.lit(False)), "unreadable")
    return replies.select("item_id", bad.alias("reason")).where("reason is not null")
