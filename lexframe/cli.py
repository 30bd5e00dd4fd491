"""Command line: `python -m lexframe.cli COMMAND ...`; every command is one plan over a folder or a table."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.normalize import normalized
from .operators import collection, evaluation, model, quality, references
from .session import importable
from .sources import files, listing, sinks


def _rows(spark: SparkSession, path: str):
    return spark.read.parquet(path) if not path.endswith((".json", ".jsonl")) else spark.read.json(path)


def run_list(spark, a) -> None:
    options = {"path": a.source} if not a.source.startswith("http") else {"url": a.source}
    options |= {"pageSize": a.page_size, "typeId": a.type_id, "keyword": a.keyword, "maxPages": 0 if a.all_pages else a.max_pages, "afterPage": a.after_page, "onError": "row"}
    options |= {"pages": a.pages} if a.pages else {}
    read = listing.read_listing(spark, **options).persist()
    unread = read.where("error is not null").select("list_page", "type_id", "keyword", "error")
    items = read.where("error is null").drop("error")
    if a.doc_type:
        items = items.where(collection.matches_type(F.col("doc_type"), F.col("title"), a.doc_type))
    if a.limit:
        items = items.orderBy(F.desc("issue_date"), "item_id").limit(a.limit)
    sinks.append_state(items, a.out)
    sinks.append_state(unread, f"{a.out}_unread")
    read.unpersist()


def run_inventory(spark, a) -> None:
    found = files.list_files(spark, a.source)
    sinks.write_report(found, f"{a.out}/inventory")
    sinks.write_report(collection.inventory_summary(found), f"{a.out}/summary")
    sinks.write_report(collection.duplicate_basenames(found), f"{a.out}/duplicates")


def run_pair(spark, a) -> None:
    sinks.write_report(collection.pair_files(files.file_item_ids(spark, a.source)), a.out)


def run_extract(spark, a) -> None:
    sinks.write_cache(files.read_documents(spark, a.source, files.OfficeConverter()), a.out)


def run_train(spark, a) -> None:
    ratios = tuple(a.ratios)
    quality.ratios_valid(ratios)
    best, history, metrics = model.train_and_evaluate(_rows(spark, a.source))
    best.save(f"{a.out}/model")
    sinks.write_report(metrics, f"{a.out}/metrics")
    print(json.dumps({"validation_f1": {str(k): v for k, v in history.items()}}))


def run_infer(spark, a) -> None:
    rows = _rows(spark, a.source)
    texts = rows.select(F.col(a.key).alias("document_id"), normalized(F.col(a.text)).alias("n")).select("document_id", F.col("n.text").alias("text")).where("text is not null")
    found = model.infer_entities(texts, "text", ["document_id"], model.BaselineClassifier.load(a.model), a.threshold, a.max_length, a.stride)
    sinks.write_entities(found, evaluation.document_summary(found, texts), texts.join(found, "document_id", "left_anti").select("document_id"), a.out)


def run_evaluate(spark, a) -> None:
    gold = _rows(spark, a.gold)
    outcomes = evaluation.span_outcomes(gold, _rows(spark, a.source), a.key, gold)
    errors = evaluation.boundary_errors(outcomes, a.key)
    for name, df in (("by_label", evaluation.metrics_by_label(outcomes)), ("averages", evaluation.micro_macro(outcomes)), ("boundary_errors", errors), ("confusion", evaluation.confusion(errors))):
        sinks.write_report(df, f"{a.out}/{name}")


def run_validate(spark, a) -> int:
    rows = _rows(spark, a.source)
    issues = quality.span_issues(rows, a.key, a.labels or None)
    leaks = quality.leakage(rows, a.key)
    sinks.write_report(issues, f"{a.out}/issues")
    sinks.write_report(leaks, f"{a.out}/leakage")
    return int(not (issues.isEmpty() and leaks.isEmpty()))


def run_orphans(spark, a) -> None:
    refs, records, removals = (_rows(spark, p) for p in (a.refs, a.records, a.removals))
    sinks.write_report(references.orphan_report(references.orphan_references(refs, records, removals)), a.out)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lexframe")
    commands = p.add_subparsers(required=True)

    def command(name: str, run, *needs: str, **more) -> argparse.ArgumentParser:
        c = commands.add_parser(name)
        c.set_defaults(run=run)
        for n in needs:
            c.add_argument(f"--{n.replace('_', '-')}", required=True)
        for n, default in more.items():
            kind = {bool: {"action": "store_true"}, list: {"nargs": "*", "default": default}}.get(type(default), {"type": type(default), "default": default})
            c.add_argument(f"--{n.replace('_', '-')}", **kind)
        return c

    command("list", run_list, "source", "out", type_id="", keyword="", doc_type="", max_pages=1, all_pages=False, page_size=50, limit=0, after_page=0, pages="")
    command("inventory", run_inventory, "source", "out")
    command("pair", run_pair, "source", "out")
    command("extract", run_extract, "source", "out")
    train = command("train", run_train, "source", "out")
    train.add_argument("--ratios", nargs=3, type=float, default=[0.7, 0.15, 0.15])
    command("infer", run_infer, "source", "model", "out", key="document_id", text="text", threshold=0.5, max_length=256, stride=64)
    command("evaluate", run_evaluate, "gold", "source", "out", key="document_id")
    command("validate", run_validate, "source", "out", key="document_id", labels=[])
    command("orphans", run_orphans, "refs", "records", "removals", "out")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    return a.run(importable(spark or SparkSession.builder.appName("lexframe").getOrCreate()), a) or 0


if __name__ == "__main__":
    raise SystemExit(main())
