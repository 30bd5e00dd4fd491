"""Integrity checks of datasets and of outputs; each gives the rows at fault."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ERROR = ["key", "issue", "detail"]
#: Sources that an entity may name: the model, or the phrase rules.
SOURCES = ("model", "relation_rule")


def entity_rows(df: DataFrame, key: str, text: str = "text", entities: str = "entities") -> DataFrame:
    """(key, text, entity_no, entity fields) of the entities that aren't null."""
    return df.select(F.col(key), F.col(text).alias("_text"), F.posexplode(entities).alias("entity_no", "e")).where("e is not null").select(key, "_text", "entity_no", "e.*")


def _issue(condition: Column, name: str) -> Column:
    return F.when(condition, F.lit(name))


def span_issues(df: DataFrame, key: str, labels: list[str] | None = None, text: str = "text", entities: str = "entities") -> DataFrame:
    """(key, entity_no, issue): unknown labels, offsets out of range, and text that isn't the slice at its offsets.

    An entity out of range isn't looked at further.
    """
    rows = entity_rows(df, key, text, entities)
    range_ok = (F.col("start_char") >= 0) & (F.col("start_char") < F.col("end_char")) & (F.col("end_char") <= F.length("_text"))
    slice_ = F.expr("substring(_text, start_char + 1, end_char - start_char)")
    known = F.lit(True) if labels is None else F.col("label").isin(labels)
    issues = F.array(_issue(~F.coalesce(known, F.lit(False)), "unknown_label"), F.when(~F.coalesce(range_ok, F.lit(False)), F.lit("offset_range")).when(~F.coalesce(slice_ == F.col("text"), F.lit(False)), F.lit("text_mismatch")))
    return rows.select(key, "entity_no", F.explode(F.filter(issues, lambda x: x.isNotNull())).alias("issue"))


def duplicate_entities(entities: DataFrame, key: str) -> DataFrame:
    """(key, label, start_char, end_char, n) of spans that occur more than once."""
    return entities.groupBy(key, "label", "start_char", "end_char").agg(F.count("*").alias("n")).where("n > 1")


def overlapping_entities(entities: DataFrame, key: str) -> DataFrame:
    """(key, start_char, end_char, label) of spans that begin before the greatest end of those in front of them."""
    w = Window.partitionBy(key).orderBy("start_char", "end_char", "label").rowsBetween(Window.unboundedPreceding, -1)
    return entities.select(key, "start_char", "end_char", "label", F.max("end_char").over(w).alias("_reach")).where("start_char < _reach").drop("_reach")


def leakage(df: DataFrame, key: str, split: str = "split") -> DataFrame:
    """(key, splits): keys that stand in more than one split."""
    rows = df.where(F.col(key).isNotNull() & F.col(split).isNotNull()).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(split)), ",").alias("splits"), F.countDistinct(split).alias("_n"))
    return rows.where("_n > 1").drop("_n")


def missing_labels(df: DataFrame, required: list[str], split: str = "split", entities: str = "entities") -> DataFrame:
    """(split, label): required labels that a split has no entity of."""
    splits = df.select(split).where(F.col(split).isNotNull()).distinct()
    wanted = splits.select(split, F.explode(F.array(*[F.lit(x) for x in required])).alias("label"))
    present = df.select(split, F.explode(entities).alias("e")).select(split, F.col("e.label").alias("label")).distinct()
    return wanted.join(present, [split, "label"], "left_anti")


def unaccounted(sources: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """(key, side): keys of sources without output, and of outputs without source; null keys are none."""
    a, b = (x.select(key).where(F.col(key).isNotNull()).distinct() for x in (sources, outputs))
    return a.join(b, key, "left_anti").select(key, F.lit("no_output").alias("side")).unionByName(b.join(a, key, "left_anti").select(key, F.lit("no_source").alias("side")))


def schema_issues(outputs: DataFrame, key: str, required: list[str], rules: dict[str, Column] | None = None) -> DataFrame:
    """(key, issue): required columns that are null in an output row, and `rules` (name -> condition) that a row breaks.

    A condition that is null, as of a missing value, is not broken: that is what `required` is for.
    """
    issues = F.array(*[_issue(F.col(c).isNull(), f"missing_{c}") for c in required], *[_issue(~condition, f"bad_{name}") for name, condition in (rules or {}).items()])
    return outputs.select(key, F.explode(F.filter(issues, lambda x: x.isNotNull())).alias("issue"))


def document_rules() -> dict[str, Column]:
    """What a document's output must meet: ids and files that aren't empty, and a hash that is one."""
    return {"document_id": F.col("document_id") != "", "source_file": F.col("source_file") != "", "source_sha256": F.col("source_sha256").rlike("^[0-9a-f]{64}$")}


def entity_rules(confidence: Column, sources: Column | None = None, known: tuple[str, ...] = SOURCES) -> dict[str, Column]:
    """What an entity must meet: text, offsets from 0 and 1, a confidence from 0 to 1, and, where given, a source that is known."""
    rules = {"text": F.col("text") != "", "start_char": F.col("start_char") >= 0, "end_char": F.col("end_char") >= 1, "confidence": confidence.between(0, 1)}
    return rules | ({} if sources is None else {"source": sources.isin(*known)})


def stale_sources(outputs: DataFrame, sources: DataFrame, key: str) -> DataFrame:
    """(key, issue): outputs whose source is missing, has another hash, or another length of text."""
    s = sources.select(F.col(key).alias("_k"), F.col("source_sha256").alias("_sha"), F.col("text_length").alias("_n"))
    joined = outputs.join(s, F.col(key) == F.col("_k"), "left")
    issue = F.when(F.col("_k").isNull(), "missing_source").when(~F.col("source_sha256").eqNullSafe(F.col("_sha")), "hash_mismatch").when(~F.col("text_length").eqNullSafe(F.col("_n")), "length_mismatch")
    return joined.select(key, issue.alias("issue")).where("issue is not null")


def ratios_valid(ratios: tuple[float, float, float]) -> None:
    """Raises unless three ratios, none negative, sum up to one."""
    if len(ratios) != 3 or min(ratios) < 0 or abs(sum(ratios) - 1) > 1e-9:
        raise ValueError("three ratios that sum up to 1 are needed")
