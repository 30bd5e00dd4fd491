"""Offset-preserving normalization: every character kept knows its place in the raw text."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import PLAIN_FROM, PLAIN_TO

_PLAIN = {ord(a): b for a, b in zip(PLAIN_FROM, PLAIN_TO)} | {0xA0: " ", 0x200B: "", 0xFEFF: ""}
MAPPED = T.StructType([T.StructField("text", T.StringType()), T.StructField("offsets", T.ArrayType(T.IntegerType()))])


def normalize_with_offsets(text: str) -> tuple[str, list[int]]:
    """(normalized text, raw place of each of its characters).

    A character and the combining marks after it are composed together and share the place of the
    first. White space becomes one blank, or one line break without blanks before it; invisible
    characters go, as does white space at the end and blanks at the start.
    """
    groups: list[list] = []
    for place, char in enumerate(text):
        plain = char.translate(_PLAIN)
        if groups and plain and unicodedata.combining(plain[0]):
            groups[-1][1] += plain
        else:
            groups.append([place, plain])
    kept: list[str] = []
    places: list[int] = []
    for place, raw in groups:
        for char in unicodedata.normalize("NFC", raw):
            last = kept[-1] if kept else ""
            if char == "\n":
                if last == "\n":
                    continue
                while kept and kept[-1] == " ":
                    kept.pop()
                    places.pop()
                if kept and kept[-1] == "\n":
                    continue
            elif char.isspace():
                if last in ("", " ", "\n"):
                    continue
                char = " "
            elif unicodedata.category(char) in ("Cc", "Cf"):
                continue
            kept.append(char)
            places.append(place)
    while kept and kept[-1] in " \n":
        kept.pop()
        places.pop()
    return "".join(kept), places


def normalize_text(text: str) -> str:
    return normalize_with_offsets(text)[0]


@F.pandas_udf(MAPPED)
def normalized(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """struct<text, offsets> of a text column; null stays null inside the struct."""
    for batch in texts:
        rows = [(None, None) if t is None else normalize_with_offsets(t) for t in batch]
        yield pd.DataFrame(rows, columns=["text", "offsets"])


@F.pandas_udf(T.StringType())
def match_form(values: pd.Series) -> pd.Series:
    """The form in which values are compared: normalized and case-folded."""
    return values.map(lambda v: None if v is None else normalize_text(v).casefold())


def span_to_raw(offsets: Column, start: Column, end: Column) -> Column:
    """struct<start, end> of a normalized half-open span in the raw text; null where the span is out of range."""
    valid = (start >= 0) & (start < end) & (end <= F.size(offsets))
    return F.when(valid, F.struct(F.try_element_at(offsets, start + 1).alias("start"), (F.try_element_at(offsets, F.greatest(end, F.lit(1))) + 1).alias("end")))
