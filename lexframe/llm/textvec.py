"""Text as arrays: code points, words and word n-grams of many documents at once."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Code points taken into arrays at a time; a longer document is taken alone, whole.
CHUNK = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x + _BASE
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def text_lengths(column: pa.Array) -> list[int]:
    """Code points of each text; 0 for null."""
    return pc.fill_null(pc.utf8_length(column), 0).to_pylist()


def chunks(lengths: list[int], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of documents with at most `limit` code points together, or one document."""
    first, total = 0, 0
    for i, n in enumerate(lengths):
        if i > first and total + n > limit:
            yield first, i
            first, total = i, 0
        total += n + 1
    if first < len(lengths):
        yield first, len(lengths)


def codepoints(texts: list[str]) -> tuple[np.ndarray, np.ndarray, str]:
    """(code points of the texts, each followed by a line break; start of each text and the end; the joined text)."""
    joined = "\n".join(texts) + "\n"
    array = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return array, starts, joined


@lru_cache(maxsize=1)
def alnum_table() -> np.ndarray:
    """True for the code points of words: letters and digits."""
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), dtype=bool, count=0x110000)


@lru_cache(maxsize=1)
def _letter_codes() -> np.ndarray:
    return mix(np.arange(0x110000, dtype=np.uint64))


_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]
_FACTOR = 0xD1342543DE82EF95
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd factor and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK + CHUNK // 8)
        for k, f in enumerate((_FACTOR, _INVERSE)):
            steps = np.full(size, f, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document, start) of each word of the texts, in order; words are runs of letters and digits in lower case.

    `start` is the place in the joined lower-case text. The hash is a polynomial of random letter
    codes, taken from running sums, so no slice of text is made.
    """
    array, starts, _ = codepoints([t.lower() for t in texts])
    inside = alnum_table()[array]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    first, last = edge[::2], edge[1::2]  # the text ends with a line break, so every word ends
    up, down = _grown(len(array) + 1)
    sums = np.zeros(len(array) + 1, dtype=np.uint64)
    np.cumsum(_letter_codes()[array] * up[: len(array)], out=sums[1:])
    codes = mix((sums[last] - sums[first]) * down[first])
    return codes, np.searchsorted(starts, first, side="right") - 1, first


def ngrams(codes: np.ndarray, docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of each sequence of n consecutive words of one document; its place is that of its first word."""
    count = len(codes) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    total = np.zeros(count, dtype=np.uint64)
    for k in range(n):
        total = (total + codes[k : k + count]) * np.uint64(_FACTOR)
    return mix(total), np.where(docs[:count] == docs[n - 1 :], docs[:count], -1)


def shingle_sets(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets): the distinct n-gram hashes of each text, ascending as unsigned numbers."""
    codes, docs, _ = words(texts)
    grams, owner = ngrams(codes, docs, n)
    keep = owner >= 0
    grams, owner = grams[keep], owner[keep]
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(np.bincount(owner[new], minlength=len(texts)), out=offsets[1:])
    return grams[new], offsets
