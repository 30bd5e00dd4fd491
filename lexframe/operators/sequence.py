"""Token sequences: windows over positions, and labels on tokens."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Label of tokens that no text stands for.
IGNORED = -100


def word_tokens(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, token_no, start_char, end_char) of the runs of anything but white space."""
    parts = F.split(F.col(text), "[ \t\n\r\x0b\f]")
    pieces = df.select(*keys, F.posexplode(parts).alias("_piece", "_text"))
    w = Window.partitionBy(*keys).orderBy("_piece")
    start = F.coalesce(F.sum(F.length("_text") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = pieces.withColumn("start_char", start.cast("int")).where("_text <> ''")
    rows = rows.withColumn("token_no", F.row_number().over(w) - 1)
    return rows.select(*keys, "token_no", "start_char", (F.col("start_char") + F.length("_text")).alias("end_char"))


def piece_tokens(df: DataFrame, text: str, keys: list[str], encode: Callable[[str], list[tuple[int, int, int]]]) -> DataFrame:
    """(keys, token_no, start_char, end_char, token_id) of the pieces that a tokenizer cuts texts into.

    `encode` gives (id, start, end) for each piece, without special ones; a tokenizer that knows no offsets gives the
    word's to each of its pieces. Null texts have none.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [(*key, i, start, end, piece) for *key, t in part.itertuples(index=False) if t is not None for i, (piece, start, end) in enumerate(encode(t))]
            yield pd.DataFrame(rows, columns=[*keys, "token_no", "start_char", "end_char", "token_id"])

    fields = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.select(*keys, text).mapInPandas(run, f"{fields}, token_no int, start_char int, end_char int, token_id int")


def chunk_inputs(tokens: DataFrame, keys: list[str], max_length: int, stride: int, first: list[int], last: list[int]) -> DataFrame:
    """Windows with `input_ids`, `attention_mask` and `offset_mapping`, as a model takes them.

    `first` and `last` are the special ids around each window; their offsets are (0, 0). A window is at most
    `max_length` ids, so what is gathered for one is bounded.
    """
    windows = chunk_windows(tokens, keys, max_length, stride, len(first) + len(last))
    placed = in_windows(tokens, keys, max_length, stride, len(first) + len(last))
    inside = windows.join(placed.select(*keys, "chunk_no", "token_no", "token_id", F.col("start_char").alias("_s"), F.col("end_char").alias("_e")), [*keys, "chunk_no"])
    held = inside.groupBy(*keys, "chunk_no", "chunk_id", "start_char", "end_char").agg(F.array_sort(F.collect_list(F.struct("token_no", "token_id", "_s", "_e"))).alias("t"))
    special = lambda ids: F.array(*[F.lit(i) for i in ids]).cast("array<int>")
    zero = lambda n: F.expr(f"array_repeat(named_struct('start', 0, 'end', 0), {n})")
    ids = F.concat(special(first), F.transform("t", lambda x: x["token_id"]), special(last))
    offsets = F.concat(zero(len(first)), F.transform("t", lambda x: F.struct(x["_s"].alias("start"), x["_e"].alias("end"))), zero(len(last)))
    return held.select(*keys, "chunk_no", "chunk_id", "start_char", "end_char", ids.alias("input_ids"), F.array_repeat(F.lit(1), F.size(ids)).alias("attention_mask"), offsets.alias("offset_mapping"))


def in_windows(tokens: DataFrame, keys: list[str], max_length: int = 256, stride: int = 64, specials: int = 2) -> DataFrame:
    """`tokens` with `chunk_no`, one row for each window that the token lies in; a window after the last one may be among them."""
    capacity = max_length - specials
    if capacity <= 0 or stride >= capacity:
        raise ValueError("max_length must exceed special tokens and stride")
    step = capacity - stride
    # a token lies in the windows whose start is at most step-aligned below it and less than `capacity` before it
    first = F.greatest(F.lit(0), F.ceil((F.col("token_no") - capacity + 1) / F.lit(step))).cast("int")
    last = F.floor(F.col("token_no") / F.lit(step)).cast("int")
    return tokens.withColumn("chunk_no", F.explode(F.sequence(first, last)))


def chunk_windows(tokens: DataFrame, keys: list[str], max_length: int = 256, stride: int = 64, specials: int = 2) -> DataFrame:
    """(keys, chunk_no, chunk_id, first_token, last_token, start_char, end_char) of windows that overlap by `stride` tokens.

    A window has room for max_length - specials tokens; the last one reaches the end. Texts without
    tokens have none here: `empty_chunks` gives them theirs.
    """
    placed = in_windows(tokens.select(*keys, "token_no", "start_char", "end_char"), keys, max_length, stride, specials)
    windows = placed.groupBy(*keys, "chunk_no").agg(F.min("token_no").alias("first_token"), F.max("token_no").alias("last_token"), F.min("start_char").alias("start_char"), F.max("end_char").alias("end_char"))
    # a window is the last one when the one before it already reaches the end of the text
    before = F.lag("last_token").over(Window.partitionBy(*keys).orderBy("chunk_no"))
    windows = windows.withColumn("_before", before).where("_before is null or last_token > _before").drop("_before")
    return windows.withColumn("chunk_id", F.concat(F.lit("c"), F.lpad(F.col("chunk_no").cast("string"), 5, "0")))


def empty_chunks(df: DataFrame, tokens: DataFrame, keys: list[str]) -> DataFrame:
    """The one empty chunk of each text without tokens."""
    none = df.select(*keys).join(tokens.select(*keys).distinct(), keys, "left_anti")
    zero = F.lit(0)
    return none.select(*keys, zero.alias("chunk_no"), F.lit("c00000").alias("chunk_id"), zero.alias("first_token"), F.lit(-1).alias("last_token"), zero.alias("start_char"), zero.alias("end_char"))


def bio_vocabulary(labels: DataFrame) -> DataFrame:
    """(bio, id): O, then B- and I- of every label in order, numbered densely from 0."""
    rows = labels.select("label").where("label is not null").distinct()
    both = rows.select("label", F.explode(F.array(F.lit("B-"), F.lit("I-"))).alias("prefix"))
    place = F.row_number().over(Window.orderBy("label", "prefix"))  # one row for each label: a vocabulary, not data
    numbered = both.select(F.concat("prefix", "label").alias("bio"), place.cast("int").alias("id"))
    return numbered.unionByName(labels.sparkSession.range(1).select(F.lit("O").alias("bio"), F.lit(0).alias("id")))


def align_bio(tokens: DataFrame, entities: DataFrame, keys: list[str]) -> DataFrame:
    """Tokens with `bio`: the label of the first entity, in list order (`entity_no`), that overlaps them.

    The first token of an entity gets B-, the others I-, others O, tokens without width null. An
    equi-join on the text, with the overlap within.
    """
    e = entities.select(*(F.col(k).alias(f"_{k}") for k in keys), "entity_no", "label", F.col("start_char").alias("_s"), F.col("end_char").alias("_e"))
    on = [F.col(k) == F.col(f"_{k}") for k in keys] + [F.col("start_char") < F.col("_e"), F.col("_s") < F.col("end_char"), F.col("end_char") > F.col("start_char")]
    met = tokens.join(e, on, "left")
    first = met.groupBy(*keys, "token_no", "start_char", "end_char").agg(F.min(F.when(F.col("entity_no").isNotNull(), F.struct("entity_no", "_s", "_e", "label"))).alias("e"))
    w = Window.partitionBy(*keys, "e._s", "e._e", "e.label").orderBy("token_no")
    bio = F.when(F.col("end_char") <= F.col("start_char"), None).when(F.col("e").isNull(), "O").when(F.row_number().over(w) == 1, F.concat(F.lit("B-"), "e.label")).otherwise(F.concat(F.lit("I-"), "e.label"))
    return first.select(*keys, "token_no", "start_char", "end_char", bio.alias("bio"))


def above_threshold(predictions: DataFrame, threshold: float) -> DataFrame:
    """Predictions of O, and of labels with a confidence of `threshold` or more."""
    return predictions.where((F.col("label") == "O") | (F.col("confidence") >= threshold))
