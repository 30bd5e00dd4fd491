"""Token classification: a pluggable classifier, a trainable baseline, and the inference plan around it."""

from __future__ import annotations

from typing import Protocol

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import FeatureHasher, IndexToString, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import sequence, spans
from .evaluation import metrics_by_label, micro_macro, span_outcomes


class TokenClassifier(Protocol):
    """Adds `label` (BIO) and `confidence` to tokens (keys, token_no, start_char, end_char, word, before, after)."""

    def predict(self, tokens: DataFrame) -> DataFrame: ...


def token_features(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, token_no, start_char, end_char, word, before, after) of the words of each text, with their neighbours."""
    tokens = sequence.word_tokens(df, text, keys)
    named = tokens.join(df.select(*keys, F.col(text).alias("_text")), keys)
    word = F.expr("substring(_text, start_char + 1, end_char - start_char)")
    rows = named.select(*keys, "token_no", "start_char", "end_char", word.alias("word"))
    w = Window.partitionBy(*keys).orderBy("token_no")
    return rows.withColumn("before", F.coalesce(F.lag("word").over(w), F.lit("^"))).withColumn("after", F.coalesce(F.lead("word").over(w), F.lit("$")))


def _columns(c: Column) -> list[Column]:
    low = F.lower(c)
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\p{Lu}", "A"), r"\p{Ll}", "a"), "[0-9]", "9")
    return [low.alias("w"), F.substring(low, 1, 3).alias("p"), F.expr("right(lower(word), 3)").alias("s"), F.regexp_replace(shape, r"(.)\1+", "$1").alias("shape")]


class BaselineClassifier:
    """Logistic regression on hashed features of a word and its neighbours; entity classes can weigh more than O."""

    def __init__(self, model: PipelineModel):
        self.model = model

    @staticmethod
    def _features(tokens: DataFrame) -> DataFrame:
        place = F.least(F.col("token_no"), F.lit(30)).cast("string")
        return tokens.select("*", *_columns(F.col("word")), F.lower("before").alias("b"), F.lower("after").alias("a"), place.alias("place"))

    @classmethod
    def fit(cls, tokens: DataFrame, label: str = "bio", entity_weight: float = 5.0, features: int = 1 << 16, iterations: int = 30) -> BaselineClassifier:
        """Fits on tokens with their BIO label; O has weight 1."""
        rows = cls._features(tokens.where(F.col(label).isNotNull())).withColumn("weight", F.when(F.col(label) == "O", 1.0).otherwise(entity_weight))
        stages = [
            StringIndexer(inputCol=label, outputCol="y", stringOrderType="alphabetAsc", handleInvalid="skip"),
            FeatureHasher(inputCols=["w", "p", "s", "shape", "b", "a", "place"], outputCol="x", numFeatures=features),
            LogisticRegression(featuresCol="x", labelCol="y", weightCol="weight", maxIter=iterations, regParam=1e-4, family="multinomial"),
        ]
        model = Pipeline(stages=stages).fit(rows)
        names = IndexToString(inputCol="prediction", outputCol="label", labels=model.stages[0].labels)
        return cls(PipelineModel([*model.stages[1:], names]))

    def predict(self, tokens: DataFrame) -> DataFrame:
        scored = self.model.transform(self._features(tokens))
        return scored.select(*tokens.columns, "label", F.array_max(vector_to_array("probability")).alias("confidence"))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> BaselineClassifier:
        return cls(PipelineModel.load(path))


def infer_entities(df: DataFrame, text: str, keys: list[str], classifier: TokenClassifier, threshold: float = 0.5, max_length: int = 256, stride: int = 64, rules: DataFrame | None = None) -> DataFrame:
    """(keys, entity_no, label, start_char, end_char, confidence, chunk_ids, source, text, block_no) of each text.

    Words are classified, kept from the threshold on, decoded within overlapping windows, merged over them, joined by
    the entities of `rules` (keys, label, start_char, end_char), and chosen greedily so that none overlap.
    """
    tokens = token_features(df, text, keys)
    labelled = sequence.above_threshold(classifier.predict(tokens), threshold)
    windows = sequence.chunk_windows(tokens, keys, max_length, stride).select(*keys, "chunk_no", "chunk_id")
    inside = sequence.in_windows(labelled, keys, max_length, stride).join(windows, [*keys, "chunk_no"]).drop("chunk_no")
    decoded = spans.decode_bio(inside, [*keys, "chunk_id"], ["token_no"])
    merged = spans.merge_entities(decoded, keys).select(*keys, "label", "start_char", "end_char", "confidence", "chunk_ids")
    if rules is not None:
        merged = merged.unionByName(rules.select(*keys, "label", "start_char", "end_char", F.lit(1.0).alias("confidence"), F.array(F.lit("rule:relation_type")).alias("chunk_ids")))
    chosen = spans.greedy_select(merged, keys).drop("confidence")
    found = chosen.join(merged, [*keys, "label", "start_char", "end_char"]).groupBy(*keys, "label", "start_char", "end_char").agg(F.max("confidence").alias("confidence"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("chunk_ids")))).alias("chunk_ids"))
    placed = spans.in_blocks(found, spans.blocks_of(df, text, keys), keys)
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("start_char", "end_char")) - 1
    source = F.when(F.array_contains("chunk_ids", "rule:relation_type"), "relation_rule").otherwise("model")
    named = placed.join(df.select(*keys, F.col(text).alias("_text")), keys)
    return named.select(*keys, number.alias("entity_no"), "label", "start_char", "end_char", "confidence", "chunk_ids", source.alias("source"), F.expr("substring(_text, start_char + 1, end_char - start_char)").alias("text"), "block_no")


def train_and_evaluate(rows: DataFrame, key: str = "row_id", text: str = "text", split: str = "split", weights: tuple[float, ...] = (1.0, 5.0)) -> tuple[BaselineClassifier, dict, DataFrame]:
    """(best classifier, history, test metrics): fitted on train for each weight, chosen by micro F1 on validation, tested once."""
    from .quality import entity_rows

    rows = rows.where(F.col(text).isNotNull())
    gold = entity_rows(rows, key, text)
    tokens = token_features(rows, text, [key])
    aligned = sequence.align_bio(tokens.select(key, "token_no", "start_char", "end_char"), gold, [key]).select(key, "token_no", "bio")
    whole = tokens.join(aligned, [key, "token_no"]).join(rows.select(key, split), key).persist()

    def outcomes(model: BaselineClassifier, part: str) -> DataFrame:
        here = whole.where(F.col(split) == part)
        predicted = spans.decode_bio(model.predict(here.drop("bio", split)), [key], ["token_no"])
        expected = spans.decode_bio(here.select(key, "token_no", "start_char", "end_char", F.col("bio").alias("label"), F.lit(1.0).alias("confidence")), [key], ["token_no"])
        return span_outcomes(expected, predicted, key)

    best, history = None, {}
    for weight in weights:
        model = BaselineClassifier.fit(whole.where(F.col(split) == "train").drop(split), entity_weight=weight)
        score = micro_macro(outcomes(model, "validation")).where("average = 'micro'").first()
        history[weight] = score.f1 if score else 0.0
        if best is None or history[weight] > history[best[0]]:
            best = (weight, model)
    metrics = metrics_by_label(outcomes(best[1], "test"))
    return best[1], history, metrics
