"""Texts of varying length in containers of fixed capacity, with little room left.

The lengths' histogram is all that the plan needs: a linear program over configurations (which
lengths a container holds), solved by multiplicative weights. Lengths are grouped into at most
`GRAINS` classes. Each round prices the classes, a knapsack by dynamic programming over the room finds the
configuration of the highest price and, for each class, the best one that holds it; those of nearly the
best price are taken as often as the classes have items left, so amounts are whole numbers,
and the price of a class falls with the share of it that is covered. Rounds go on until all but `REST` of
the volume is covered, however many there are. Configurations of classes are then spelled out in lengths
that sum up to the capacity, and the remainder is fitted best, longest first, into the room left and into
further containers. Documents take the places that the plan has for their length, by rank,
without any of them seeing another.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed
from .tokenize import FOLDER, count_tokens

#: Classes of lengths at most; share of the volume left to best fit; share by which a price may stay below the best.
GRAINS, REST, NEAR = 512, 0.05, 0.02
#: Growth of the first prices over the length, fall of a price with the share covered.
SLOPE, FALL = 0.2, 0.2
#: Room, as a share of the capacity, that a configuration may leave: from none, in steps, where no other is left.
SLACK = (0.0, 0.002, 0.006, 0.014, 0.03, 0.06, 0.12)
#: Rows of one length that are ranked together.
RANKED = 1_000_000


@dataclass
class Configuration:
    """What one container holds (length -> number), and how many containers hold it."""

    content: dict[int, int]
    copies: int


class Knapsack:
    """Dynamic programming over the room: the best price for every room, with at most `most` items of each size."""

    def __init__(self, sizes: np.ndarray, prices: np.ndarray, most: np.ndarray, room: int):
        self.pieces: list[tuple[int, int, int]] = []  # (class, items, size): bounds as sums of powers of two
        for k, (size, bound) in enumerate(zip(sizes.tolist(), most.tolist())):
            left, items = min(bound, room // size), 1
            while left > 0:
                items = min(items, left)
                self.pieces.append((k, items, size * items))
                left -= items
                items *= 2
        self.best = np.zeros(room + 1)
        self.taken = np.zeros((len(self.pieces), room + 1), dtype=bool)
        for row, (k, items, size) in zip(self.taken, self.pieces):
            gain = self.best[: room + 1 - size] + prices[k] * items
            better = gain > self.best[size:] + 1e-12
            row[size:] = better
            np.copyto(self.best[size:], gain, where=better)

    def content(self, room: int) -> dict[int, int]:
        """Class -> items of the best configuration for this room."""
        out: dict[int, int] = {}
        for row, (k, items, size) in zip(self.taken[::-1], self.pieces[::-1]):
            if row[room]:
                out[k] = out.get(k, 0) + items
                room -= size
        return out


def _program(sizes: np.ndarray, demand: np.ndarray, room: int) -> list[tuple[dict[int, int], int]]:
    """Configurations (size -> items) and how often each is taken, for classes of items of the given sizes."""
    left, total = demand.copy(), int((sizes * demand).sum())
    weight = (sizes / room) ** SLOPE
    out: list[tuple[dict[int, int], int]] = []
    slack = 0
    while (left * sizes).sum() > REST * total and slack < len(SLACK):
        live = np.flatnonzero(left)
        size, price = sizes[live], (weight * sizes)[live]
        sack = Knapsack(size, price, left[live], room)
        value = price + sack.best[room - size]  # of the best configurations that hold each class
        covered, least = np.zeros(len(live)), None
        for k in [-1, *np.argsort(-value, kind="stable").tolist()]:
            worth = sack.best[room] if k < 0 else value[k]
            if k >= 0 and least is not None and worth < least:
                break
            content = sack.content(room if k < 0 else room - int(size[k]))
            if k >= 0:
                content[k] = content.get(k, 0) + 1
            if not content:
                break
            at, items = np.array(list(content)), np.array(list(content.values()))
            if (size[at] * items).sum() < room * (1 - SLACK[slack]):
                continue
            least = worth * (1 - NEAR) if least is None else least
            copies = int((left[live[at]] // items).min())
            if copies:
                left[live[at]] -= copies * items
                covered[at] += copies * items / demand[live[at]]
                out.append(({int(size[i]): n for i, n in content.items()}, copies))
        if covered.any():
            weight[live] *= np.exp(-FALL * covered)
        else:
            slack += 1
    return out


class _Shelf:
    """The lengths of one class, ascending, of which items are left."""

    def __init__(self) -> None:
        self.lengths: list[int] = []

    def nearest(self, wanted: int, free: Callable[[int], bool]) -> int | None:
        """The length nearest to the wanted one among those with a free item."""
        return min((n for n in self.lengths if free(n)), key=lambda n: abs(n - wanted), default=None)

    def most(self, room: int, free: Callable[[int], bool]) -> int | None:
        """The greatest length that fits, among those with a free item."""
        return next((n for n in self.lengths[bisect_right(self.lengths, room) - 1 :: -1] if free(n)), None) if self.lengths and self.lengths[0] <= room else None


def _class(length: int, grain: int, room: int) -> int:
    """The size of a length in grains, rounded to the nearest; 0 for those too short for the program."""
    return min((length + grain // 2) // grain, room)


def _spelled(columns: list[tuple[dict[int, int], int]], left: dict[int, int], capacity: int, grain: int) -> list[Configuration]:
    """Configurations of classes as such of lengths; `left` (length -> number) is what remains.

    Lengths are chosen so that their differences from the middle of their classes cancel out, the last
    one as great as fits. Equal containers are made together, so there are at most as many
    configurations as columns and lengths.
    """
    room_of = capacity // grain
    shelves: dict[int, _Shelf] = {}
    for n in sorted(left):
        shelves.setdefault(_class(n, grain, room_of), _Shelf()).lengths.append(n)
    plan = []
    for content, copies in columns:
        sizes = [k for k in sorted(content, reverse=True) for _ in range(content[k])]
        while copies:
            used: dict[int, int] = {}
            room, off = capacity, 0
            for i, k in enumerate(sizes):
                free = lambda n: left[n] > used.get(n, 0)  # noqa: B023, E731
                n = shelves[k].most(room, free) if i == len(sizes) - 1 else shelves[k].nearest(k * grain - off, free)
                if n is None or n > room:
                    continue
                used[n] = used.get(n, 0) + 1
                room -= n
                off += n - k * grain
            if not used:
                break
            same = min(copies, *(left[n] // q for n, q in used.items()))
            plan.append(Configuration(used, same))
            copies -= same
            for n, q in used.items():
                left[n] -= q * same
                if not left[n]:
                    shelves[_class(n, grain, room_of)].lengths.remove(n)
    for n in [n for n, c in left.items() if not c]:
        del left[n]
    return plan


def _best_fit(left: dict[int, int], capacity: int, begun: list[Configuration] | None = None) -> list[Configuration]:
    """`begun` and what is left, longest first, each where the least room remains; equal containers are handled together."""
    by_room: dict[int, list[Configuration]] = {}
    rooms = np.zeros(capacity + 1, dtype=bool)

    def put(c: Configuration, room: int) -> None:
        by_room.setdefault(room, []).append(c)
        rooms[room] = True

    for c in begun or []:
        put(c, capacity - sum(n * q for n, q in c.content.items()))
    for n in sorted(left, reverse=True):
        todo = left[n]
        while todo:
            ahead = rooms[n:]
            first = int(ahead.argmax()) + n if ahead.any() else None
            if first is None:
                each = capacity // n
                copies, rest = divmod(todo, each)
                if copies:
                    put(Configuration({n: each}, copies), capacity - each * n)
                if rest:
                    put(Configuration({n: rest}, 1), capacity - rest * n)
                break
            c = by_room[first].pop()
            if not by_room[first]:
                rooms[first] = False
            each = min(first // n, todo)
            copies = min(c.copies, todo // each)
            if copies < c.copies:
                put(Configuration(c.content, c.copies - copies), first)
            content = dict(c.content)
            content[n] = content.get(n, 0) + each
            put(Configuration(content, copies), first - each * n)
            todo -= copies * each
    return [c for group in by_room.values() for c in group]


def plan_containers(histogram: dict[int, int], capacity: int) -> list[Configuration]:
    """Configurations that together hold exactly the items of `histogram` (length -> number), none longer than `capacity`."""
    left = {n: c for n, c in histogram.items() if c > 0 and 0 < n <= capacity}
    return _best_fit(left, capacity, program(left, capacity))


def program(left: dict[int, int], capacity: int) -> list[Configuration]:
    """The containers that the linear program fills; `left` (length -> number) is changed to what remains."""
    grain = -(-capacity // GRAINS)
    room = capacity // grain
    demand: dict[int, int] = {}
    for n, c in left.items():
        k = _class(n, grain, room)
        if k:
            demand[k] = demand.get(k, 0) + c
    if not demand:
        return []
    sizes = np.array(sorted(demand), dtype=np.int64)
    return _spelled(_program(sizes, np.array([demand[k] for k in sizes.tolist()], dtype=np.int64), room), left, capacity, grain)


class Places:
    """The places that a plan has for each length, in the order of ranks, as arrays."""

    def __init__(self, plan: list[Configuration]):
        runs: dict[int, list[tuple[int, int, int]]] = {}
        used: dict[int, int] = {}
        self.containers = 0
        for c in plan:
            for n, k in c.content.items():
                runs.setdefault(n, []).append((used.get(n, 0), self.containers, k))
                used[n] = used.get(n, 0) + k * c.copies
            self.containers += c.copies
        self.base = np.zeros(max(runs, default=0) + 1, dtype=np.int64)  # where the ranks of each length begin
        at, rows = 0, []
        for n in sorted(runs):
            self.base[n] = at
            rows += [(at + rank, container, k) for rank, container, k in runs[n]]
            at += used[n]
        self.first, self.container, self.each = np.array(rows, dtype=np.int64).reshape(-1, 3).T

    def of(self, lengths: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """The container of the item of each length and rank."""
        at = self.base[lengths] + ranks
        run = np.searchsorted(self.first, at, side="right") - 1
        return self.container[run] + (at - self.first[run]) // self.each[run]


def pack_documents(documents: DataFrame, pack_sizes: DataFrame, key: str = "doc_id", text: str = "text", folder: str = FOLDER) -> DataFrame:
    """(pack_kind, container_id, key, part, start_token, n_tokens): where each document goes, for each kind of container.

    A text longer than the capacity is cut: whole pieces of the capacity fill containers alone, the rest
    is an item like any other text. No other text is split. Texts without tokens (null, empty) have
    one row with a null container. Containers are numbered from 0 within a kind, pieces that
    fill one alone after the others. Repeated rows are items each. A kind that is named twice is
    packed once, with the greater capacity; kinds without a positive capacity are left out.

    The histogram has at most as many rows as the capacity and is all that the driver sees; the plan
    that executors get is bounded by it, too. A length that a third of all texts have is ranked
    in buckets of about `RANKED` rows, whose sizes are summed up.
    """
    kinds = [r for r in pack_sizes.where("capacity_tokens > 0 and pack_kind is not null and tokenizer is not null").groupBy("pack_kind").agg(F.max_by(F.struct("tokenizer", "capacity_tokens"), "capacity_tokens").alias("s")).select("pack_kind", "s.*").orderBy("pack_kind").collect()]
    source = documents.select(documents[f"`{key}`"], documents[f"`{text}`"])
    kind_of_key = documents.schema[key].dataType.simpleString()
    schema = f"pack_kind string, container_id bigint, `{key}` {kind_of_key}, part int, start_token bigint, n_tokens bigint"
    if not kinds:
        return documents.sparkSession.createDataFrame([], schema)
    counted = None
    for name in sorted({k.tokenizer for k in kinds}):
        one = checkpointed(count_tokens(source, key, text, name, folder)).withColumn("tokenizer", F.lit(name))
        counted = one if counted is None else counted.unionByName(one)
    wanted = F.array(*[F.struct(F.lit(k.pack_kind).alias("pack_kind"), F.lit(k.tokenizer).alias("own"), F.lit(k.capacity_tokens).cast("bigint").alias("capacity")) for k in kinds])
    rows = counted.select(F.col(key).alias("id"), "n_tokens", "tokenizer", F.explode(wanted).alias("k")).where("tokenizer = k.own").select("id", "n_tokens", "k.pack_kind", "k.capacity")
    rows = rows.withColumn("whole", F.when(F.col("n_tokens") > F.col("capacity"), F.floor(F.col("n_tokens") / F.col("capacity"))).otherwise(F.lit(0)))
    rows = rows.withColumn("rest", F.col("n_tokens") - F.col("whole") * F.col("capacity"))

    sums = rows.groupBy("pack_kind", "rest").agg(F.count("*").alias("n"), F.sum("whole").alias("whole")).collect()  # at most a row for each length up to the capacities
    places = {k.pack_kind: Places(plan_containers({int(r.rest): int(r.n) for r in sums if r.pack_kind == k.pack_kind}, int(k.capacity_tokens))) for k in kinds}
    buckets = max(16, sum(r.n for r in sums) // RANKED)

    bucket = F.pmod(F.xxhash64("id"), F.lit(buckets))
    lone_sums = rows.where("whole > 0").withColumn("bucket", bucket)
    items = rows.where("rest > 0").withColumn("bucket", bucket)
    sizes = items.groupBy("pack_kind", "rest", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("pack_kind", "rest").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("pack_kind", "rest", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("pack_kind", "rest", "bucket").orderBy("id")
    ranked = items.withColumn("own", F.row_number().over(own) - 1).join(starts, ["pack_kind", "rest", "bucket"])
    ranked = ranked.select("pack_kind", "id", F.col("whole").cast("int").alias("part"), (F.col("whole") * F.col("capacity")).alias("start_token"), F.col("rest").alias("n_tokens"), (F.col("before") + F.col("own")).alias("rank"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, lengths, ranks = batch.column(0).to_numpy(zero_copy_only=False), batch.column(4).to_numpy(), batch.column(5).to_numpy()
            found = np.empty(len(ranks), dtype=np.int64)
            for name in set(names.tolist()):
                own = names == name
                found[own] = places[name].of(lengths[own], ranks[own])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), *(batch.column(i) for i in (1, 2, 3, 4))], ["pack_kind", "container_id", key, "part", "start_token", "n_tokens"])

    packed = ranked.mapInArrow(placed, schema)

    # pieces that fill a container alone: numbered by running sums over buckets, then within
    lone_sizes = lone_sums.groupBy("pack_kind", "bucket").agg(F.sum("whole").alias("n"))
    before = Window.partitionBy("pack_kind").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    lone_starts = lone_sizes.select("pack_kind", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("pack_kind", "bucket").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    firsts = F.create_map(*[x for k in kinds for x in (F.lit(k.pack_kind), F.lit(places[k.pack_kind].containers).cast("bigint"))])
    lone = lone_sums.withColumn("own", F.coalesce(F.sum("whole").over(own), F.lit(0))).join(lone_starts, ["pack_kind", "bucket"])
    lone = lone.select("pack_kind", "id", "capacity", (firsts[F.col("pack_kind")] + F.col("before") + F.col("own")).alias("first"), F.posexplode(F.sequence(F.lit(1), F.col("whole"))).alias("part", "_"))
    lone = lone.select("pack_kind", (F.col("first") + F.col("part")).alias("container_id"), F.col("id").alias(key), "part", (F.col("part") * F.col("capacity")).alias("start_token"), F.col("capacity").alias("n_tokens"))

    empty = rows.where("n_tokens = 0").select("pack_kind", F.lit(None).cast("bigint").alias("container_id"), F.col("id").alias(key), F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("start_token"), F.lit(0).cast("bigint").alias("n_tokens"))
    return packed.unionByName(lone).unionByName(empty)


def fill_report(packed: DataFrame, pack_sizes: DataFrame) -> DataFrame:
    """(pack_kind, n_containers, n_tokens, fill, over): `over` counts containers that hold more than their capacity, which is none."""
    each = packed.where("container_id is not null").groupBy("pack_kind", "container_id").agg(F.sum("n_tokens").alias("used"))
    sizes = pack_sizes.groupBy("pack_kind").agg(F.max("capacity_tokens").cast("bigint").alias("capacity"))
    return each.join(sizes, "pack_kind").groupBy("pack_kind").agg(
        F.count("*").alias("n_containers"), F.sum("used").alias("n_tokens"), (F.sum("used") / F.sum("capacity")).alias("fill"), F.sum((F.col("used") > F.col("capacity")).cast("bigint")).alias("over")
    )
