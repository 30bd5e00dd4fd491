"""Near-duplicate records by HyperMinHash sketches, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .lookalikes import consistent
from .pairs import equal_pairs, self_pairs
from .textvec import chunks, mix, shingle_sets, text_lengths

#: Sketches of one set, buckets of a sketch, mantissa bits of a register, registers of a band.
SKETCHES, BUCKETS, MANTISSA, BAND = 8, 32, 10, 5
REGISTERS = SKETCHES * BUCKETS
#: Classes with the same band, beyond which its pairs are kept from coming again at their other bands.
FEW = 16
#: Sets of up to so many values meet exactly, by a prefix of their values, whatever their registers.
SHORT = 40
_LOW = np.uint64((1 << 59) - 1)


def registers(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The registers of each set, as an array of (sets, REGISTERS) 16-bit numbers.

    `values[offsets[i]:offsets[i + 1]]` is set i. In each of the independent sketches a value falls
    into a bucket by its first bits; the bucket keeps its least remainder, stored as the number
    of leading zeros and the `MANTISSA` bits after them. An empty bucket takes the register of
    the next filled one, scrambled with the distance, so equality of registers stays as likely
    as the sets are alike. An empty set has all registers 0.
    """
    sets = len(offsets) - 1
    owner = np.repeat(np.arange(sets), np.diff(offsets))
    out = np.zeros((sets, SKETCHES, BUCKETS), dtype=np.uint16)
    none = np.uint64(1 << 63)
    for k in range(SKETCHES):
        own = mix(values ^ mix(np.full(1, k + 1, dtype=np.uint64)))
        cell = owner * BUCKETS + (own >> np.uint64(59)).astype(np.int64)
        least = np.full(sets * BUCKETS, none, dtype=np.uint64)
        np.minimum.at(least, cell, own & _LOW)
        least = least.reshape(sets, BUCKETS)
        packed = _packed(least)
        empty = least == none
        filled = ~empty.all(axis=1)
        for step in range(1, BUCKETS):
            if not empty[filled].any():
                break
            source = np.roll(least, -step, axis=1)
            usable = empty & (source != none)
            packed[usable] = _packed(mix(source[usable] ^ np.uint64(step << 59)) & _LOW)
            empty &= ~usable
        packed[~filled] = 0
        out[:, k, :] = packed
    return out.reshape(sets, REGISTERS)


def _packed(x: np.ndarray) -> np.ndarray:
    """Leading zeros (6 bits) and mantissa (MANTISSA bits) of 59-bit numbers."""
    exponent = np.frexp(x.astype(np.float64))[1]  # x < 2**exponent; rounding up moves to the next, in the same way for equal x
    zeros = np.clip(59 - exponent, 0, 62)
    shift = np.clip(exponent - 1 - MANTISSA, 0, 63).astype(np.uint64)
    mantissa = (x >> shift) & np.uint64((1 << MANTISSA) - 1)
    return ((zeros.astype(np.uint64) << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each sketch; a band takes its registers from different sketches."""
    sets = len(sketch)
    order = np.arange(REGISTERS).reshape(SKETCHES, BUCKETS).T.ravel()
    bands = REGISTERS // BAND
    taken = sketch[:, order[: bands * BAND]].reshape(sets, bands, BAND).astype(np.uint64)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) + np.uint64(1), (sets, bands)).copy()
    for i in range(BAND):
        key = mix(key ^ taken[:, :, i])
    return key.view(np.int64)


def prefix_keys(values: np.ndarray, offsets: np.ndarray, tenths: int = 7) -> list[np.ndarray]:
    """For each set of up to `SHORT` values the least values, one of which any set alike to `tenths` tenths has among its own; nothing for the others."""
    count = np.diff(offsets)
    size = np.where(count <= SHORT, np.minimum(count - -(-count * tenths // 10) + 1, count), 0)
    salted = mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)).view(np.int64)
    return [salted[a : a + n] for a, n in zip(offsets[:-1], size)]


def chance(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The share of registers of two sets of these sizes that agree though the sets have nothing in common.

    With k and l values in a bucket the least ones, as parts of the range, have the densities k(1-x)^(k-1) and
    l(1-x)^(l-1), and registers agree where both fall into one cell: 2^MANTISSA cells between 2^-i and 2^(1-i).
    """
    k, m = (np.maximum(np.asarray(n, dtype=np.float64) / BUCKETS, 1.0)[:, None] for n in (n_a, n_b))
    low = 2.0 ** -np.arange(1, 60)[None, :]
    rest = k + m - 1
    return (k * m / rest * low * ((1 - low) ** rest - (1 - 2 * low) ** rest)).sum(axis=1) / (1 << MANTISSA)


def estimated_jaccard(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarities from arrays of registers (pairs, REGISTERS) and set sizes, corrected for registers that agree by chance."""
    by_chance = chance(n_a, n_b)
    return np.maximum(0.0, ((a == b).mean(axis=1) - by_chance) / (1 - by_chance))


def sketches(df: DataFrame, key: str, head: str, body: str, n: int = 3, tenths: int = 7) -> DataFrame:
    """(key, n_shingles, class_a, class_b, sketch, bands) of every row whose `body` is neither null nor empty.

    The text is `head` (nothing where null), a line break and the consistent form of `body`.
    class_a and class_b are sums over the set of shingles: equal for equal sets. Rows with fewer
    than `n` words have no shingles, class 0 and no bands. Short texts have their prefix among the bands.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _texts(batch):
                values, offsets = shingle_sets(texts, n)
                sketch = registers(values, offsets)
                bands = band_keys(sketch)
                count = np.diff(offsets)
                some = count > 0
                keys = [np.concatenate([x, y]) if k else y for k, x, y in zip(some, bands, prefix_keys(values, offsets, tenths))]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in keys])])
                sums = []
                for salt in (0, 0x5851F42D4C957F2D):
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values ^ np.uint64(salt)))])
                    sums.append(pa.array((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(count, pa.int32()),
                        *sums,
                        pa.array([row.tobytes() for row in sketch], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys), pa.int64())),
                    ],
                    [key, "n_shingles", "class_a", "class_b", "sketch", "bands"],
                )

    kind = df.schema[key].dataType.simpleString()
    return _texts_of(df, key, head, body).mapInArrow(run, f"`{key}` {kind}, n_shingles int, class_a bigint, class_b bigint, sketch binary, bands array<bigint>")


def shingles(df: DataFrame, key: str, head: str, body: str, n: int = 3) -> DataFrame:
    """(key, grams): the set of n-gram hashes of every row, for verification."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _texts(batch):
                values, offsets = shingle_sets(texts, n)
                grams = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64), pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), grams], [key, "grams"])

    kind = df.schema[key].dataType.simpleString()
    return _texts_of(df, key, head, body).mapInArrow(run, f"`{key}` {kind}, grams array<bigint>")


def _texts_of(df: DataFrame, key: str, head: str, body: str) -> DataFrame:
    return df.where(df[f"`{body}`"] != "").select(df[f"`{key}`"], df[f"`{head}`"], df[f"`{body}`"])


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    lengths = text_lengths(batch.column(2))
    for a, b in chunks(lengths):
        part = batch.slice(a, b - a)
        yield part, [(h or "") + "\n" + consistent(t) for h, t in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]


def near(grams_a: Column, grams_b: Column, tenths: int) -> Column:
    """Whether two sets are alike to `tenths` tenths or more."""
    both = F.size(F.array_intersect(grams_a, grams_b))
    return both * 10 >= (F.size(grams_a) + F.size(grams_b) - both) * tenths


def _registers_of(column: pa.Array) -> np.ndarray:
    """Sketches of one batch as an array; all have the same size."""
    data = np.frombuffer(column.buffers()[2], dtype=np.uint16)
    first = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset] // 2
    return data[first : first + len(column) * REGISTERS].reshape(len(column), REGISTERS)


def _estimates(pairs: DataFrame, least: float) -> DataFrame:
    """The (a, b) of `pairs` (a, b, sketch_a, sketch_b, n_a, n_b) that are short or whose estimated similarity is `least` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            keep = np.maximum(n_a, n_b) <= SHORT
            keep |= estimated_jaccard(_registers_of(batch.column(2)), _registers_of(batch.column(3)), n_a, n_b) >= least
            yield batch.select([0, 1]).filter(pa.array(keep))

    pairs = pairs.select("a", "b", "sketch_a", "sketch_b", "n_a", "n_b")
    return pairs.mapInArrow(run, pairs.select("a", "b").schema)


def near_duplicates(df: DataFrame, key: str = "record_id", head: str = "title", body: str = "full_text", n: int = 3, tenths: int = 7, margin: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """(classes, links): rows by class, and pairs of classes that are alike.

    classes: (key, class_id) for every row with words enough; rows with the same set of shingles
    form a class, named by its least key. links: (a, b) of class ids, a < b, whose sets are
    alike to `tenths` tenths or more.

    Copies are one row before anything is compared. Classes meet where a band of registers is the
    same: at 0.7 a pair is missed by all bands with a probability of 1e-4, at 0.75 of 1e-6.
    Registers of few shingles depend on each other, so texts of up to `SHORT` shingles meet by an exact
    prefix as well, and pairs of them are verified whatever the estimate.
    Pairs whose sketches estimate less than the threshold by `margin` (seven standard errors)
    are left out, the others are verified on their shingles, which are made anew for the rows
    concerned only. No group is gathered in one task: pairs come from an equi-join on the band, in blocks. Of the
    bands that more than `FEW` classes have, a pair comes at the first only that both share.
    """
    made = checkpointed(sketches(df, key, head, body, n, tenths)).where("n_shingles > 0").withColumnRenamed(key, "id")
    classes = made.groupBy("class_a", "class_b", "n_shingles").agg(F.min("id").alias("class_id"))
    members = checkpointed(made.select("id", "class_a", "class_b", "n_shingles").join(classes, ["class_a", "class_b", "n_shingles"]).select("id", "class_id"))
    first = made.join(members.where("id = class_id").select("id"), "id", "left_semi")
    banded = first.select("id", F.explode("bands").alias("k"))
    shared = checkpointed(banded.join(banded.groupBy("k").agg(F.count("*").alias("n")).where("n > 1"), "k"))
    crowded = shared.where(F.col("n") > FEW)
    listed = crowded.groupBy("id").agg(F.sort_array(F.collect_set("k")).alias("bands"))  # at most as many as a row has bands
    seen = listed.select("id", "bands", F.posexplode("bands").alias("at", "k")).select("k", "id", F.slice("bands", 1, F.col("at")).alias("seen"))
    seen = seen.unionByName(shared.where(F.col("n") <= FEW).select("k", "id", F.array().cast("array<bigint>").alias("seen")))
    met = self_pairs(seen, "id", once="seen").distinct()
    sketch = first.select("id", "sketch", F.col("n_shingles").alias("n"))
    pairs = met
    for side in "ab":
        pairs = pairs.join(sketch.select(F.col("id").alias(side), F.col("sketch").alias(f"sketch_{side}"), F.col("n").alias(f"n_{side}")), side)
    likely = checkpointed(_estimates(pairs, tenths / 10 - margin))
    concerned = likely.select(F.explode(F.array("a", "b")).alias(key)).distinct()
    sets = shingles(df.select(df[f"`{key}`"], df[f"`{head}`"], df[f"`{body}`"]).join(concerned, key, "left_semi"), key, head, body, n)
    links = (
        likely.join(sets.select(F.col(key).alias("a"), F.col("grams").alias("grams_a")), "a")
        .join(sets.select(F.col(key).alias("b"), F.col("grams").alias("grams_b")), "b")
        .where(near(F.col("grams_a"), F.col("grams_b"), tenths))
        .select("a", "b")
    )
    return members.withColumnRenamed("id", key), links


def member_pairs(classes: DataFrame, links: DataFrame, key: str = "record_id") -> DataFrame:
    """(row_a, row_b), row_a < row_b, distinct: all pairs of rows in one class or in linked classes.

    Large classes are spread over blocks. A row that is repeated makes no pair with itself.
    """
    members = classes.select(F.col(key).alias("y"), F.col("class_id").alias("k"))
    several = members.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select(F.col("k").alias("a"), F.col("k").alias("b"))
    sides = links.select("a", "b").unionByName(several)
    left = sides.join(members.select(F.col("y").alias("x"), F.col("k").alias("a")), "a").select(F.col("b").alias("k"), F.struct("x", (F.col("a") == F.col("b")).alias("same")).alias("x"))
    met = equal_pairs(left, members, "x", "y").where("(not x.same or x.x < y) and x.x <> y")
    return met.select(F.least("x.x", "y").alias("row_a"), F.greatest("x.x", "y").alias("row_b")).distinct()
