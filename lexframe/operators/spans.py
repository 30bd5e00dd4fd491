"""Labelled spans of text: half-open intervals of code points, found, resolved, merged and chosen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bound, is_blank


#: Needles that go to all tasks as literals; letters of a needle by which it meets texts where there are more.
LISTED, HEAD = 1_000, 4


def folded(text: Column) -> Column:
    """The text in lower case; null where that isn't as long, as offsets would shift."""
    return bound(F.lower(text), lambda low: F.when(F.length(low) == F.length(text), low))


def occurrences(text: Column, needle: Column, low: Column | None = None) -> Column:
    """Start offsets of the occurrences of `needle` that don't overlap, case aside; none for an empty needle.

    `low` is `folded(text)`, for callers that have it already. Where it is null, case counts.
    """
    low = folded(text) if low is None else low
    parts = F.when(low.isNotNull(), F.split(low, F.concat(F.lit("\\Q"), F.lower(needle), F.lit("\\E")))).otherwise(F.split(text, F.concat(F.lit("\\Q"), needle, F.lit("\\E"))))
    step = F.length(needle)
    none = F.array().cast("array<int>")

    def starts(p: Column) -> Column:
        return F.aggregate(
            F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))),
            F.struct(none.alias("found"), F.lit(0).alias("next")),
            lambda a, x: F.struct(F.concat(a["found"], F.array(a["next"] + F.length(x))).alias("found"), (a["next"] + F.length(x) + step).alias("next")),
            lambda a: a["found"],
        )

    return F.when(needle != "", bound(parts, starts)).otherwise(none)


def _literals(rows: list) -> Column:
    kind = "array<struct<label:string,variant:string>>"
    return F.array(*(F.struct(F.lit(r.label).alias("label"), F.lit(r.variant).alias("variant")) for r in rows)).cast(kind)


def _headed(df: DataFrame, keys: list[str], needles: DataFrame) -> DataFrame:
    """(keys, _text, _low, label, variant) of the texts and the needles that begin somewhere in them."""
    heads = F.array(*(F.struct(F.substring(c, 1, HEAD).alias("head"), F.lit(k).alias("low")) for k, c in ((True, F.lower("variant")), (False, F.col("variant")))))
    headed = needles.select("label", "variant", F.explode(heads).alias("h")).select("label", "variant", "h.*")
    sizes = F.array(*map(F.lit, headed.agg(F.array_sort(F.collect_set(F.length("head")))).first()[0]))  # HEAD numbers at most
    searched = F.coalesce("_low", "_text")
    begun = df.select(*keys, F.col("_low").isNotNull().alias("low"), searched.alias("s"), F.explode(sizes).alias("size")).where("length(s) >= size")
    begun = begun.select(*keys, "low", "s", "size", F.explode(F.sequence(F.lit(1), F.length("s") - F.col("size") + 1)).alias("at"))
    begun = begun.select(*keys, "low", F.substring("s", F.col("at"), F.col("size")).alias("head")).distinct()
    return df.join(begun.join(headed, ["head", "low"]).drop("head", "low").distinct(), keys)


def find_spans(df: DataFrame, text: str, needles: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, start_char, end_char): where the variants of values stand in the texts of `df`.

    `needles` has columns `label` and `variant` and, where it shares keys with `df`, is joined on
    them. Without shared keys every needle is looked for in every text: a list of up to `LISTED` goes to all tasks as
    literals. Of a longer one needles and texts meet on the needle's first `HEAD` letters, so a text is searched for those
    only of which it has the beginning.
    """
    shared = [k for k in keys if k in needles.columns]
    df = df.select(*keys, F.col(text).alias("_text"), folded(F.col(text)).alias("_low"))
    if shared:
        joined = df.join(needles, shared)
    else:
        listed = needles.select("label", "variant").where("variant <> ''").distinct()
        rows = listed.limit(LISTED + 1).collect()
        joined = _headed(df, keys, listed) if len(rows) > LISTED else df.select("*", F.explode(_literals(rows)).alias("n")).select("*", "n.label", "n.variant").drop("n")
    at = joined.select(*keys, "label", F.length("variant").alias("size"), F.explode(occurrences(F.col("_text"), F.col("variant"), F.col("_low"))).alias("start_char"))
    return at.select(*keys, "label", "start_char", (F.col("start_char") + F.col("size")).alias("end_char")).distinct()


def _clusters(spans: DataFrame, keys: list[str]) -> DataFrame:
    """`spans` with `_cluster`: the number of its group of spans of one text that hang together by overlaps.

    What is chosen in one group says nothing about another, so folds are over the spans of a group, which is short, and not over
    all of a text.
    """
    w = Window.partitionBy(*keys).orderBy("start_char", "end_char")
    reach = F.max("end_char").over(w.rowsBetween(Window.unboundedPreceding, -1))
    begins = spans.withColumn("_begins", F.when(F.col("start_char") < reach, 0).otherwise(1))
    return begins.withColumn("_cluster", F.sum("_begins").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_begins")


def resolve_overlaps(spans: DataFrame, keys: list[str]) -> DataFrame:
    """`spans` (keys, label, start_char, end_char) with `accepted` and `rejection_reason`.

    In order of start, longest first, then label, a span is accepted unless it overlaps one accepted
    before; the reason names the label of the first such. As accepted spans are disjoint and in order, only
    the one that ends last can overlap: a fold over the spans that hang together keeps just that.
    """
    order = F.array_sort(F.collect_list(F.struct("start_char", (-(F.col("end_char") - F.col("start_char"))).alias("size"), "label", "end_char")))
    folded = F.aggregate(
        "spans",
        F.struct(F.lit(-1).cast("int").alias("end"), F.lit(None).cast("string").alias("label"), F.array().cast("array<struct<label:string,start_char:int,end_char:int,accepted:boolean,rejection_reason:string>>").alias("out")),
        lambda a, s: F.struct(
            F.when(s["start_char"] >= a["end"], s["end_char"]).otherwise(a["end"]).alias("end"),
            F.when(s["start_char"] >= a["end"], s["label"]).otherwise(a["label"]).alias("label"),
            F.concat(
                a["out"],
                F.array(
                    F.struct(
                        s["label"].alias("label"),
                        s["start_char"].alias("start_char"),
                        s["end_char"].alias("end_char"),
                        (s["start_char"] >= a["end"]).alias("accepted"),
                        F.when(s["start_char"] < a["end"], F.concat(F.lit("overlap_with_"), a["label"])).alias("rejection_reason"),
                    )
                ),
            ).alias("out"),
        ),
        lambda a: a["out"],
    )
    typed = spans.select(*keys, "label", F.col("start_char").cast("int").alias("start_char"), F.col("end_char").cast("int").alias("end_char"))
    return _clusters(typed, keys).groupBy(*keys, "_cluster").agg(order.alias("spans")).select(*keys, F.inline(folded))


def decode_bio(tokens: DataFrame, keys: list[str], order: list[str], gap: bool = True) -> DataFrame:
    """(keys, label, start_char, end_char, confidences, n_tokens) of the entities in BIO-labelled tokens.

    An entity begins at `B-`, at `I-` after anything but its own label, and, with `gap`, at `I-` that starts
    more than one character after the end so far. `order` breaks ties of equal offsets. Ends are the
    greatest so far; without `gap` the last token's.
    """
    w = Window.partitionBy(*keys).orderBy("start_char", "end_char", *order) if gap else Window.partitionBy(*keys).orderBy(*order)
    base = F.when(F.col("label") != "O", F.substring("label", 3, 1_000_000))
    rows = tokens.withColumn("_base", base).withColumn("_before", F.lag("_base").over(w)).withColumn("_ended", F.lag("end_char").over(w))
    begins = F.col("label").startswith("B-") | F.col("_before").isNull() | (F.col("_before") != F.col("_base"))
    if gap:
        begins = begins | (F.col("start_char") > F.col("_ended") + 1)
    rows = rows.withColumn("_island", F.sum(F.when(F.col("_base").isNull() | begins, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.max("end_char") if gap else F.max_by("end_char", F.struct(*order))
    found = rows.where("_base is not null").groupBy(*keys, "_island", F.col("_base").alias("label"))
    return found.agg(F.min("start_char").alias("start_char"), last.alias("end_char"), F.avg("confidence").alias("confidence"), F.count("*").alias("n_tokens")).drop("_island")


def merge_entities(entities: DataFrame, keys: list[str]) -> DataFrame:
    """One row for equal label and offsets: the mean confidence over all tokens, and the chunks, sorted."""
    return entities.groupBy(*keys, "label", "start_char", "end_char").agg(
        (F.sum(F.col("confidence") * F.col("n_tokens")) / F.sum("n_tokens")).alias("confidence"), F.sum("n_tokens").alias("n_tokens"), F.array_sort(F.collect_set("chunk_id")).alias("chunk_ids")
    )


def greedy_select(entities: DataFrame, keys: list[str]) -> DataFrame:
    """Entities (keys, label, start_char, end_char, confidence) that don't overlap, the most confident first.

    Rank: confidence, then length, then the earlier start; label last, so that the choice is the
    same everywhere. An entity is chosen unless it overlaps one chosen before.
    """
    rank = F.struct((-F.col("confidence")).alias("c"), (-(F.col("end_char") - F.col("start_char"))).alias("n"), "start_char", "label", "end_char", "confidence")
    chosen = F.aggregate(
        "ranked",
        F.expr("cast(array() as array<struct<label:string,start_char:int,end_char:int,confidence:double>>)"),
        lambda a, s: F.when(
            F.exists(a, lambda x: (x["start_char"] < s["end_char"]) & (s["start_char"] < x["end_char"])), a
        ).otherwise(F.concat(a, F.array(F.struct(s["label"].alias("label"), s["start_char"].alias("start_char"), s["end_char"].alias("end_char"), s["confidence"].alias("confidence"))))),
    )
    typed = entities.select(*keys, "label", F.col("start_char").cast("int").alias("start_char"), F.col("end_char").cast("int").alias("end_char"), F.col("confidence").cast("double").alias("confidence"))
    return _clusters(typed, keys).groupBy(*keys, "_cluster").agg(F.array_sort(F.collect_list(rank)).alias("ranked")).select(*keys, F.inline(chosen))


def blocks_of(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, block_no, start_char, end_char, text): the lines of a text that aren't blank, numbered before blank ones go.

    Offsets are those in the lines that are left, joined by line breaks.
    """
    rows = df.select(*keys, F.posexplode(F.split(F.col(text), "\n")).alias("block_no", "text")).where(~is_blank(F.col("text")))
    before = Window.partitionBy(*keys).orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("text") + 1).over(before), F.lit(0))
    return rows.withColumn("start_char", start).select(*keys, "block_no", "start_char", (F.col("start_char") + F.length("text")).alias("end_char"), "text")


def in_blocks(spans: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Each span with the number of the block that its start lies in, or null; an equi-join on the text with a range within."""
    b = blocks.select(*(F.col(k).alias(f"_{k}") for k in keys), "block_no", F.col("start_char").alias("_s"), F.col("end_char").alias("_e"))
    on = [F.col(k) == F.col(f"_{k}") for k in keys] + [F.col("start_char") >= F.col("_s"), F.col("start_char") < F.col("_e")]
    return spans.join(b, on, "left").drop(*(f"_{k}" for k in keys), "_s", "_e")


def matches_of(df: DataFrame, text: str, pattern: str, keys: list[str]) -> DataFrame:
    """(keys, start_char, end_char, match) of a pattern's matches, by the lengths of what lies between them."""
    found = F.regexp_extract_all(F.col(text), F.lit(f"({pattern})"), 1)
    between = F.split(F.col(text), pattern)
    rows = df.select(*keys, found.alias("f"), between.alias("b")).where(F.size("f") > 0)
    step = F.transform("f", lambda m, i: F.struct(m.alias("m"), F.length(F.get("b", i)).alias("lead")))
    folded = F.aggregate(
        step,
        F.struct(F.expr("cast(array() as array<struct<start_char:int,end_char:int,match:string>>)").alias("out"), F.lit(0).alias("at")),
        lambda a, s: F.struct(
            F.concat(a["out"], F.array(F.struct((a["at"] + s["lead"]).alias("start_char"), (a["at"] + s["lead"] + F.length(s["m"])).alias("end_char"), s["m"].alias("match")))).alias("out"),
            (a["at"] + s["lead"] + F.length(s["m"])).alias("at"),
        ),
        lambda a: a["out"],
    )
    return rows.select(*keys, F.inline(folded))
