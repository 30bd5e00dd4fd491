"""Encoding with a public byte-pair tokenizer.

Texts are split into pre-tokens on arrays: each code point gets a class, and each class is a
transition function on "where did the run begin that this character belongs to". These
functions are either constant (a run begins here) or the identity (it goes on), their
composition is associative, and the scan over all characters of a batch is a running maximum.
The slices between boundaries are merged once each and kept in a table, from which the ids of
the whole batch are gathered.
"""

from __future__ import annotations

import base64
import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textvec import chunks, codepoints, text_lengths

#: Where the vocabulary files lie; a parameter of every function that reads one.
FOLDER = os.environ.get("LEXFRAME_TOKENIZERS", "/opt/tokenizers")
OTHER, LETTER, NUMBER, BLANK, SPACE, BREAK = range(6)
#: Code points with the property White_Space, other than U+0020.
WHITE = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Pre-tokens kept with their ids; beyond that the table is begun anew.
KEPT = 400_000


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    table = np.zeros(0x110000, dtype=np.uint8)
    for i in range(0x110000):
        c = unicodedata.category(chr(i))[0]
        if c == "L":
            table[i] = LETTER
        elif c == "N":
            table[i] = NUMBER
    table[WHITE] = SPACE
    table[0x20] = BLANK
    return table


def boundaries(array: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin; `array` holds texts, each followed by one break character, `starts` their starts and the end.

    The breaks themselves are marked as well, so that a pre-token ends at the next mark.
    A pre-token is: a contraction of an apostrophe and s, d, m, t, ll, ve or re; a run of letters,
    of numbers, or of other characters, with one U+0020 before it; white space that leaves one
    character for what follows; or what is left of it.
    """
    size = len(array)
    kind = class_table()[array]
    kind[starts[1:] - 1] = BREAK
    group = np.where(kind == BLANK, np.uint8(SPACE), kind)
    begins = np.ones(size, dtype=bool)
    begins[1:] = group[1:] != group[:-1]
    begins |= kind == BREAK
    begins[starts[:-1]] = True
    began = np.maximum.accumulate(np.where(begins, np.arange(size), 0))  # the scan: constant functions beat the identity

    mark = begins.copy()
    last = np.flatnonzero(group[:-1] == SPACE)
    last = last[(group[last + 1] != SPACE) & (kind[last + 1] != BREAK)]  # the last character of white space before something
    mark[last] = True  # the white space before it is a pre-token of its own
    lead = last[kind[last] == BLANK]
    mark[lead + 1] = False  # U+0020 joins what follows

    quote = np.flatnonzero(array == 0x27)
    if len(quote):
        quote = quote[mark[quote] & (began[quote] == quote)]
        quote = quote[group[quote + 1] == LETTER]
        one = array[quote + 1]
        two = array[np.minimum(quote + 2, size - 1)]
        short = (one == ord("s")) | (one == ord("d")) | (one == ord("m")) | (one == ord("t"))
        long = ((one == ord("l")) & (two == ord("l"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("r")) & (two == ord("e")))
        for at, step in ((quote[short], 2), (quote[long], 3)):
            mark[at + 1] = False
            rest = at + step
            rest = rest[rest < size]
            mark[rest[group[rest] == LETTER]] = True
    return mark


class Tokenizer:
    """A byte-level pair merger over the ranks of a vocabulary file, with a table of pre-tokens."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.merge = self._merge
        try:
            import tiktoken

            self.merge = tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=self.ranks, special_tokens={})._core_bpe.encode_single_piece
        except ImportError:
            pass
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.pool = np.zeros(1 << 16, dtype=np.int32)
        self.first = np.zeros(1 << 14, dtype=np.int64)
        self.count = np.zeros(1 << 14, dtype=np.int64)
        self.used = 0

    def _merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token: the pair of lowest rank is merged until none is left; n log n, however long a run is."""
        ranks, size = self.ranks, len(piece)
        if piece in ranks:
            return [ranks[piece]]
        ends = list(range(1, size + 1))  # of the part that begins at each place
        before = list(range(-1, size))  # beginning of the part before
        heap = [(r, i, i + 2) for i in range(size - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, end = heappop(heap)
            if not ends[i] or ends[i] == size or ends[ends[i]] != end:
                continue  # one of the two is another part by now
            gone = ends[i]
            ends[gone], ends[i] = 0, end
            if end < size:
                before[end] = i
                if (r := ranks.get(piece[i : ends[end]])) is not None:
                    heappush(heap, (r, i, ends[end]))
            if before[i] >= 0 and (r := ranks.get(piece[before[i] : end])) is not None:
                heappush(heap, (r, before[i], end))
        out, i = [], 0
        while i < size:
            out.append(ranks[piece[i : ends[i]]])
            i = ends[i]
        return out

    def _learn(self, piece: str) -> int:
        ids = self.merge(piece.encode("utf-8", "replace"))
        k, n = len(self.known), len(ids)
        if k == len(self.first):
            self.first, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.count))
        while self.used + n > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.first[k], self.count[k] = self.used, n
        self.pool[self.used : self.used + n] = ids
        self.used += n
        self.known[piece] = k
        return k

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(number in the table, start in the text, document) of each pre-token, and the starts of the texts."""
        array, starts, joined = codepoints(texts)
        at = np.flatnonzero(boundaries(array, starts))
        ends = np.append(at[1:], len(array))
        owner = np.searchsorted(starts, at, side="right") - 1
        real = at != starts[owner + 1] - 1
        at, ends, owner = at[real], ends[real], owner[real]
        if len(self.known) > KEPT:
            self._reset()
        known = self.known
        slices = [joined[a:b] for a, b in zip(at.tolist(), ends.tolist())]
        numbers = [known.get(s, -1) for s in slices]
        if -1 in numbers:
            for i, k in enumerate(numbers):
                if k < 0:
                    s = slices[i]
                    k = known.get(s, -1)
                    numbers[i] = self._learn(s) if k < 0 else k
        return np.array(numbers, dtype=np.int64), at - starts[owner], owner, starts

    def counts(self, texts: list[str]) -> np.ndarray:
        """The number of ids of each text."""
        numbers, _, owner, _ = self._pieces(texts)
        return np.bincount(owner, weights=self.count[numbers], minlength=len(texts)).astype(np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, start of each text in them and the end, for each id the place of its pre-token in the text)."""
        numbers, at, owner, _ = self._pieces(texts)
        count = self.count[numbers]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.pool[np.repeat(self.first[numbers] - (ends - count), count) + np.arange(total)]
        offsets = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum(np.bincount(owner, weights=count, minlength=len(texts)).astype(np.int64), out=offsets[1:])
        return ids, offsets, np.repeat(at, count).astype(np.int32)

    @lru_cache(maxsize=1)  # noqa: B019
    def pieces_of_ids(self) -> dict[int, bytes]:
        return {i: p for p, i in self.ranks.items()}

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.pieces_of_ids()[i] for i in ids).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def tokenizer(name: str, folder: str = FOLDER) -> Tokenizer:
    """The tokenizer of a rank file, one for each worker."""
    return Tokenizer(os.path.join(folder, f"{name}.tiktoken"))


def _texts(column: pa.ChunkedArray | pa.Array) -> list[str]:
    return [t if t is not None else "" for t in column.to_pylist()]


def encode_documents(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = "byte_bpe_50k", folder: str = FOLDER, offsets: bool = False) -> DataFrame:
    """(key, ids, and with `offsets` the place of each id's pre-token in the text) of every row of `df`.

    Null and empty texts give an empty list; repeated rows are encoded each. One pass over the
    two columns, without a shuffle; a long text is taken whole. Memory is bounded by the
    longest text and by `textvec.CHUNK`.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(name, folder)
        for batch in batches:
            lengths = text_lengths(batch.column(1))
            for a, b in chunks(lengths):
                part = batch.slice(a, b - a)
                ids, ends, at = own.encode(_texts(part.column(1)))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in ((ids, at) if offsets else (ids,))]
                yield pa.RecordBatch.from_arrays([part.column(0), *lists], ["k", "ids", "offsets"][: 2 + offsets])

    schema = f"`{key}` {kind}, ids array<int>" + ", offsets array<int>" * offsets
    renamed = df.select(df[f"`{key}`"], df[f"`{text}`"])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield batch.rename_columns([key, *batch.schema.names[1:]])

    return renamed.mapInArrow(named, schema)


def count_tokens(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = "byte_bpe_50k", folder: str = FOLDER) -> DataFrame:
    """(key, n_tokens) of every row of `df`; 0 for null and empty texts."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(name, folder)
        for batch in batches:
            lengths = text_lengths(batch.column(1))
            for a, b in chunks(lengths):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own.counts(_texts(part.column(1))), pa.int64())], [key, "n_tokens"])

    return df.select(df[f"`{key}`"], df[f"`{text}`"]).mapInArrow(run, f"`{key}` {kind}, n_tokens bigint")
