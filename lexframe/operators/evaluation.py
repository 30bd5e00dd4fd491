"""Predicted against gold spans: counts, precision, recall, confusion and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = ["start_char", "end_char", "label"]


def span_outcomes(gold: DataFrame, predicted: DataFrame, key: str = "document_id", documents: DataFrame | None = None) -> DataFrame:
    """(key, start_char, end_char, label, outcome): tp, fp or fn for every distinct span.

    `documents` are those that annotators looked at: predictions for others don't count. Without it all do. Both sides
    meet in one aggregation by span.
    """
    if documents is not None:
        predicted = predicted.join(documents.select(key).distinct(), key, "left_semi")
    both = gold.select(key, *SPAN, F.lit(1).alias("g"), F.lit(0).alias("p")).unionByName(predicted.select(key, *SPAN, F.lit(0).alias("g"), F.lit(1).alias("p")))
    merged = both.groupBy(key, *SPAN).agg(F.max("g").alias("g"), F.max("p").alias("p"))
    return merged.select(key, *SPAN, F.when(F.col("g") + F.col("p") == 2, "tp").when(F.col("p") == 1, "fp").otherwise("fn").alias("outcome"))


def _ratios(tp: Column, fp: Column, fn: Column) -> list[Column]:
    precision, recall = tp / F.greatest(tp + fp, F.lit(1)), tp / F.greatest(tp + fn, F.lit(1))
    f1 = 2 * precision * recall / F.greatest(precision + recall, F.lit(1e-15))
    return [precision.alias("precision"), recall.alias("recall"), f1.alias("f1")]


def _counts() -> list[Column]:
    return [F.sum((F.col("outcome") == o).cast("bigint")).alias(o) for o in ("tp", "fp", "fn")]


def metrics_by_label(outcomes: DataFrame) -> DataFrame:
    sums = outcomes.groupBy("label").agg(*_counts())
    return sums.select("label", "tp", "fp", "fn", *_ratios(F.col("tp"), F.col("fp"), F.col("fn")), (F.col("tp") + F.col("fn")).alias("support"))


def micro_macro(outcomes: DataFrame) -> DataFrame:
    """Two rows: `micro` over all spans, `macro` the plain mean over the labels seen."""
    labels = metrics_by_label(outcomes)
    total = labels.agg(*(F.sum(c).alias(c) for c in ("tp", "fp", "fn"))).select(F.lit("micro").alias("average"), *_ratios(F.col("tp"), F.col("fp"), F.col("fn")))
    return total.unionByName(labels.agg(*(F.avg(c).alias(c) for c in ("precision", "recall", "f1"))).select(F.lit("macro").alias("average"), "precision", "recall", "f1"))


def boundary_errors(outcomes: DataFrame, key: str = "document_id") -> DataFrame:
    """Each false positive that overlaps gold, with the gold span it overlaps most; the earliest where equal."""
    wrong = outcomes.where("outcome = 'fp'").select(F.col(key), F.col("start_char").alias("pred_start"), F.col("end_char").alias("pred_end"), F.col("label").alias("pred_label"))
    gold = outcomes.where("outcome <> 'fp'").select(F.col(key).alias("_k"), F.col("start_char").alias("gold_start"), F.col("end_char").alias("gold_end"), F.col("label").alias("gold_label"))
    met = wrong.join(gold, (F.col(key) == F.col("_k")) & (F.col("pred_start") < F.col("gold_end")) & (F.col("gold_start") < F.col("pred_end")))
    shared = F.least("pred_end", "gold_end") - F.greatest("pred_start", "gold_start")
    w = Window.partitionBy(key, "pred_start", "pred_end", "pred_label").orderBy(shared.desc(), "gold_start", "gold_end", "gold_label")
    return met.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_k")


def confusion(errors: DataFrame) -> DataFrame:
    return errors.groupBy("gold_label", "pred_label").agg(F.count("*").alias("n"))


def document_counts(gold: DataFrame, predicted: DataFrame, key: str = "document_id") -> DataFrame:
    """One row: documents with gold, with predictions, with both, and with one only."""
    both = gold.select(key, F.lit(1).alias("g"), F.lit(0).alias("p")).unionByName(predicted.select(key, F.lit(0).alias("g"), F.lit(1).alias("p"))).groupBy(key).agg(F.max("g").alias("g"), F.max("p").alias("p"))
    count = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))
    g, p = F.col("g") == 1, F.col("p") == 1
    return both.agg(count(g).alias("documents"), count(p).alias("predicted_documents"), count(g & p).alias("matched_documents"), count(g & ~p).alias("missing_documents"), count(p & ~g).alias("unmatched_documents"))


def document_summary(entities: DataFrame, documents: DataFrame, key: str = "document_id") -> DataFrame:
    """Per document: entities, distinct values, labels with their numbers, and the range of confidence; zeros where there is none."""
    per_label = entities.groupBy(key, "label").agg(F.count("*").alias("n"))
    labels = per_label.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "label", F.col("n").cast("string")))), ",").alias("labels"))
    sums = entities.groupBy(key).agg(
        F.count("*").alias("n_entities"), F.countDistinct(F.lower("text")).alias("n_values"), F.avg("confidence").alias("mean_confidence"), F.min("confidence").alias("min_confidence"), F.max("confidence").alias("max_confidence")
    )
    rows = documents.select(key).distinct().join(sums, key, "left").join(labels, key, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return rows.select(key, zero("n_entities"), zero("n_values"), F.coalesce("labels", F.lit("")).alias("labels"), zero("mean_confidence"), zero("min_confidence"), zero("max_confidence"))
