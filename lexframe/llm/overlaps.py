"""Records of evaluation splits that recur, exactly or almost, in training."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import BLANKS
from ..session import checkpointed
from .pairs import equal_pairs
from .textvec import chunks, mix, shingle_sets, text_lengths

#: Words of a sequence for similarity, and the share, in tenths, from which texts are near-same.
N, TENTHS = 3, 7
#: Common shingles, the rarest first, that two texts must have among their prefixes.
HITS = 8
#: Counters of shingles, of which texts count each once; they only set the order. Bits that tell which shingles a side has.
COUNTERS, BITS = 1 << 22, 1 << 24
#: Texts with a shingle, as counted, that make a block of its own; counts are kept as logarithms with so many steps to a doubling.
BLOCK, STEPS = 5_000, 6


def _counters(values: np.ndarray) -> np.ndarray:
    return (mix(values) & np.uint64(COUNTERS - 1)).astype(np.int64)


def prefixes(texts: list[str], frequency: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(prefix, n_shingles) of each text.

    prefix: its shingles in the order of their counters in `frequency`, then of their hash, which is one
    order for all texts, as far as the `HITS`-th common shingle of a near-same text can lie.
    """
    values, offsets = shingle_sets(texts, N)
    count = np.diff(offsets)
    owner = np.repeat(np.arange(len(texts)), count)
    values = values[np.lexsort((values, frequency[_counters(values)], owner))].view(np.int64)
    size = np.minimum(count - -(-count * TENTHS // 10) + HITS, count)
    return [values[offsets[i] : offsets[i] + size[i]] for i in range(len(texts))], count


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in arrays])])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


def _frequency(df: DataFrame) -> np.ndarray:
    """In how many of all texts of (text) the shingles of each counter stand, on a scale of logarithms in one byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            for a, b in chunks(text_lengths(batch.column(0))):
                at = _counters(shingle_sets(batch.column(0).slice(a, b - a).to_pylist(), N)[0])
                np.add.at(total, at, 1)
        some = np.flatnonzero(total)
        for a in range(0, len(some), 100_000):
            part = some[a : a + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(total[part], pa.int64())], ["counter", "n"])

    scaled = F.ceil(F.log2(F.sum("n") + 1) * STEPS).cast("tinyint")
    counted = df.mapInArrow(run, "counter int, n bigint").groupBy("counter").agg(scaled.alias("n")).toArrow()  # a row for each counter at most
    frequency = np.zeros(COUNTERS, dtype=np.uint8)
    frequency[counted.column(0).to_numpy()] = counted.column(1).to_numpy().view(np.uint8)
    return frequency


def _prefixed(df: DataFrame, frequency: np.ndarray) -> DataFrame:
    """(id, asked, held, n, prefix) of (id, asked, held, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in chunks(text_lengths(batch.column(3))):
                part = batch.slice(a, b - a)
                lists, count = prefixes(part.column(3).to_pylist(), frequency)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(count, pa.int32()), _lists(lists)], ["id", "asked", "held", "n", "prefix"])

    return df.mapInArrow(run, "id bigint, asked boolean, held boolean, n int, prefix array<bigint>")


def _bits(prefix: DataFrame) -> np.ndarray:
    """Which shingles stand in the prefixes of (prefix), as `BITS` bits: a mark may stand for others as well, none is missing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(BITS, dtype=bool)
        for batch in batches:
            own[_bit(batch.column(0).flatten().to_numpy())] = True
        packed = np.packbits(own).view(np.int64)
        some = np.flatnonzero(packed)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(packed[some], pa.int64())], ["word", "bits"])

    found = prefix.mapInArrow(run, "word int, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # BITS / 64 rows at most
    packed = np.zeros(BITS // 64, dtype=np.int64)
    packed[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return packed.view(np.uint8)


def _bit(values: np.ndarray) -> np.ndarray:
    return (mix(values.view(np.uint64)) >> np.uint64(40)).astype(np.int64)


def _meeting(prefixed: DataFrame, bits: np.ndarray, frequency: np.ndarray) -> DataFrame:
    """(id, n, rank, p, blocks) of (id, n, prefix): the shingles that the other side has, with their rank in the prefix, from 1.

    blocks: into how many the texts with the shingle are dealt. A text with fewer shingles left than any near-same one
    must share with it gives no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            values, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            count = np.diff(ends)
            owner = np.repeat(np.arange(len(count)), count)
            rank = np.arange(len(values)) - ends[owner] + 1
            at = _bit(values)
            there = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            n = batch.column(1).to_numpy()
            least = np.minimum(HITS, -(-n * TENTHS // 10))
            there &= np.bincount(owner[there], minlength=len(count))[owner] >= least[owner]
            keep = np.flatnonzero(there)
            for a in range(0, len(keep), 100_000):
                some = keep[a : a + 100_000]
                own = owner[some]
                blocks = np.ceil(np.exp2(frequency[_counters(values[some].view(np.uint64))] / STEPS) / BLOCK)
                columns = [pa.array(n[own], pa.int32()), pa.array(rank[some], pa.int32()), pa.array(values[some], pa.int64()), pa.array(blocks.astype(np.int64))]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), *columns], ["id", "n", "rank", "p", "blocks"])

    return prefixed.select("id", "n", "prefix").mapInArrow(run, "id bigint, n int, rank int, p bigint, blocks bigint")


def _shingled(df: DataFrame) -> DataFrame:
    """(id, grams) of (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in chunks(text_lengths(batch.column(1))):
                part = batch.slice(a, b - a)
                values, offsets = shingle_sets(part.column(1).to_pylist(), N)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64), pa.int64()))], ["id", "grams"])

    return df.mapInArrow(run, "id bigint, grams array<bigint>")


def known(column: Column) -> Column:
    """An id or hash in comparable form; null where it is null, empty or all zeros."""
    form = F.lower(F.regexp_replace(column, f"^[{BLANKS}\n\r]+|[{BLANKS}\n\r]+$", ""))
    return F.when(~form.rlike(r"^[0\-\s]*$"), form)


def containments(df: DataFrame, key: str = "row_id", text: str = "text", train: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(members, links) of near-same texts across the splits.

    members: (id, is_train, a) for every row with a text that is not empty, `a` being the least id
    among the rows with exactly this text. links: (a, b, shared, n_a, n_b) for a text `a` that an
    evaluation row has and another text `b` that a training row has, of which `TENTHS` tenths of
    all distinct shingles stand in both: shared / n_a is the containment of the evaluation text
    in the training text.

    Each distinct text is handled once. The search is exact for every length: of texts with n_a and
    n_b shingles, near-same ones have at least need = ceil(7 / 17 (n_a + n_b)) in common. In one order
    of all shingles, about the rarest first, after the k-th common one at the places i and j at
    most min(n_a - i, n_b - j) can follow, so k + min(n_a - i, n_b - j) >= need for it and for all
    before it. Pairs with k = `HITS` (or need, if less) such shingles are verified on all shingles.
    Shingles of these prefixes that no text of the other side has among its own are dropped before anything is
    shuffled, by a bit map of fixed size that is broadcast, and so are texts that have too few left.
    Shingles that many texts have meet in blocks of either side.
    """
    train = (F.col("split") == "train") if train is None else train
    rows = df.select(df[f"`{key}`"].cast("bigint").alias("id"), F.coalesce(train, F.lit(False)).alias("is_train"), df[f"`{text}`"].alias("text")).where("text <> ''")
    hashed = rows.select("id", "is_train", F.sha2("text", 256).alias("h"))
    texts = hashed.groupBy("h").agg(F.min("id").alias("a"), F.max(~F.col("is_train")).alias("asked"), F.max("is_train").alias("held"))
    members = checkpointed(hashed.join(texts, "h").select("id", "is_train", "a", "asked", "held"))
    first = members.where("id = a").select("id", "asked", "held")
    texts = rows.select("id", "text")
    frequency = _frequency(texts.select("text"))
    prefixed = checkpointed(_prefixed(texts.join(first, "id").select("id", "asked", "held", "text"), frequency))
    asked, held = prefixed.where("asked"), prefixed.where("held")
    sides = []
    for side, other, i in ((asked, held, "a"), (held, asked, "b")):
        met = _meeting(side, _bits(other.select("prefix")), frequency)
        sides.append(met.select(F.col("p").alias("k"), "blocks", F.struct(F.col("id").alias(i), F.col("n").alias(f"n_{i}"), F.col("rank").alias(f"rank_{i}")).alias(f"at_{i}")))
    need = F.expr(f"((n_a + n_b) * {TENTHS} + {9 + TENTHS}) div {10 + TENTHS}")
    hits = F.least(F.lit(HITS), need)
    common = equal_pairs(*sides, "at_a", "at_b", blocks="blocks").select("at_a.*", "at_b.*")
    common = common.where((F.col("a") != F.col("b")) & (hits + F.least(F.col("n_a") - F.col("rank_a"), F.col("n_b") - F.col("rank_b")) >= need))
    likely = checkpointed(common.groupBy("a", "b").agg(F.count("*").alias("hits"), F.first(hits).alias("least")).where("hits >= least").select("a", "b"))

    concerned = likely.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    grams = _shingled(texts.join(concerned, "id", "left_semi"))
    shared = F.size(F.array_intersect("grams_a", "grams_b"))
    links = (
        likely.join(grams.select(F.col("id").alias("a"), F.col("grams").alias("grams_a")), "a")
        .join(grams.select(F.col("id").alias("b"), F.col("grams").alias("grams_b")), "b")
        .select("a", "b", shared.alias("shared"), F.size("grams_a").alias("n_a"), F.size("grams_b").alias("n_b"))
        .where((F.col("n_a") + F.col("n_b") - F.col("shared")) * TENTHS <= F.col("shared") * 10)
    )
    return members.select("id", "is_train", "a"), links


def overlapping_rows(df: DataFrame, key: str = "row_id", split: str = "split", text: str = "text", document: str = "document_id", source_hash: str = "source_sha256") -> DataFrame:
    """(eval_id, train_id), distinct: rows of other splits and of train with the same document, source, or (nearly) the same text.

    Ids and hashes are compared trimmed and in lower case; null, empty and all-zero values never
    match. A row without a split belongs to none and takes no part. Each way is an equi-join in
    blocks, as all pairs of a key are part of the result.
    """
    df = df.where(df[f"`{split}`"].isNotNull())
    is_train = F.col(split) == "train"
    out = []
    for column in (document, source_hash):
        rows = df.select(df[f"`{key}`"].cast("bigint").alias("id"), is_train.alias("is_train"), known(df[f"`{column}`"]).alias("k")).where("k is not null")
        asked, held = rows.where("not is_train").select(F.col("id").alias("eval_id"), "k"), rows.where("is_train").select(F.col("id").alias("train_id"), "k")
        out.append(equal_pairs(asked, held, "eval_id", "train_id"))
    members, links = containments(df, key, text, is_train)
    asked = members.where("not is_train").select(F.col("id").alias("eval_id"), "a")
    held = members.where("is_train").select(F.col("id").alias("train_id"), F.col("a").alias("k"))
    out.append(equal_pairs(asked.withColumnRenamed("a", "k"), held, "eval_id", "train_id"))
    out.append(equal_pairs(links.join(asked, "a").select("eval_id", F.col("b").alias("k")), held, "eval_id", "train_id"))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3]).distinct()


def overlap_report(df: DataFrame, pairs: DataFrame, key: str = "row_id") -> DataFrame:
    """(split, source, n_rows, n_overlapping, n_pairs) for every split but train and every source."""
    per_row = pairs.groupBy(F.col("eval_id").alias(key)).agg(F.count("*").alias("n"))
    rows = df.where("split <> 'train'").select(key, "split", "source").join(per_row, key, "left")
    return rows.groupBy("split", "source").agg(F.count("*").alias("n_rows"), F.count("n").alias("n_overlapping"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_pairs"))
