"""One consistent form for text that looks the same but differs in its characters."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

# Letters of other scripts and the Latin letters that they look like.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХҮҺԌԚԜаеѕіјорсухһԁԛԝӏү", "ABESIJKMHOPCTYXYhGQWaesijopcyxhdqwly"))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορυχϲϳ", "ABEZHIKMNOPTYXaikvopuxcj"))
ARMENIAN = dict(zip("ՕՍԼհոսօցյ", "OULhnuogj"))
CHEROKEE = dict(zip("ᎠᎡᎢᎪᎫᎬᎳᎷᎻᎽᏀᏃᏚᏞᏟᏢᏦᏩᏴ", "DRTAJEWMHYGZSLCPKGB"))
CYRILLIC_RARE = dict(zip("ѴѵԌꙆꙇ", "VvGIi"))
GREEK_RARE = dict(zip("ϹͿ", "CJ"))
COPTIC = dict(zip("ⲎⲒⲔⲘⲚⲞⲟⲢⲣⲤⲥⲦⲨⲬⲭ", "HIKMNOoPpCcTYXx"))
LISU = dict(zip("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"))
#: Letters used in place of Đ and đ.
STROKED = {"Ð": "Đ", "Ɖ": "Đ", "ð": "đ", "ɖ": "đ"}
# End of the fixed values.

CONFUSABLE = CYRILLIC | CYRILLIC_RARE | GREEK | GREEK_RARE | ARMENIAN | CHEROKEE | COPTIC | LISU


def _class(*ranges: int | tuple[int, int]) -> str:
    """The inside of a character class."""
    return "".join(re.escape(chr(r)) if isinstance(r, int) else f"{chr(r[0])}-{chr(r[1])}" for r in ranges)


#: Blanks other than U+0020; line breaks are none.
BLANKS = _class(0x09, 0x0B, 0x0C, 0xA0, 0x1680, (0x2000, 0x200A), 0x202F, 0x205F, 0x3000)
#: Characters without width: soft hyphen, fillers, joiners, direction marks, variation selectors, tags.
WIDTHLESS = _class(
    0xAD, 0x34F, 0x61C, 0x115F, 0x1160, 0x17B4, 0x17B5, (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), 0x3164,
    (0xFE00, 0xFE0F), 0xFEFF, 0xFFA0, (0xFFF9, 0xFFFB), (0xE0000, 0xE0FFF),
)
_WIDE = {0xFF01 + i: 0x21 + i for i in range(94)}
_SINGLE = _WIDE | {ord(a): b for a, b in STROKED.items()}
_BLANK = re.compile(f"[{BLANKS}]")
_DROP = re.compile(f"[{WIDTHLESS}]")
_ODD = re.compile(f"[{BLANKS}{WIDTHLESS}{''.join(STROKED)}\uff01-\uff5e]")
_SCRIPTED = re.compile("[\u0370-\u052f\u0531-\u058f\u13a0-\u13ff\u1c80-\u1c8f\u1d26-\u1d2b\u1f00-\u1fff\u2c80-\u2cff\u2de0-\u2dff\ua4d0-\ua4ff\ua640-\ua69f\uab70-\uabbf]")
_TOKEN = re.compile(r"[^\W_](?:[^\W_]|[\u0300-\u036f])*")

LATIN, ANY = frozenset({"Latn"}), None


@lru_cache(maxsize=4096)
def scripts(char: str) -> frozenset[str] | None:
    """The scripts that a character may belong to, with those of its look-alikes; None stands for all scripts."""
    name = unicodedata.name(char, "")
    if not char.isalpha():
        return ANY
    own = name.split(" ", 1)[0]
    found = {"LATIN": "Latn", "CYRILLIC": "Cyrl", "GREEK": "Grek", "ARMENIAN": "Armn", "CHEROKEE": "Cher", "COPTIC": "Copt", "LISU": "Lisu", "CJK": "Hani", "HIRAGANA": "Hira", "KATAKANA": "Kana", "HANGUL": "Hang"}.get(own, own)
    return frozenset({found, "Latn"} if char in CONFUSABLE else {found})


def token_scripts(token: str) -> tuple[str, frozenset[str] | None]:
    """(kind, scripts) of a token: the intersection of its characters' own scripts decides.

    kind: ``single`` (one script holds all characters), ``mixed`` (none does, but with
    look-alikes one can), ``whole`` (not Latin, but every letter looks like a Latin one) or
    ``blend`` (no script can hold all).
    """
    own = resolved = ANY
    for c in unicodedata.normalize("NFD", token):
        s = scripts(c)
        if s is ANY:
            continue
        base = s - {"Latn"} if c in CONFUSABLE else s
        own = base if own is ANY else own & base
        resolved = s if resolved is ANY else resolved & s
    if own is ANY or own:
        return ("whole", resolved) if own is not ANY and "Latn" in (resolved or ()) and "Latn" not in own else ("single", own)
    return ("mixed" if resolved else "blend"), resolved


@lru_cache(maxsize=200_000)
def _spelled(token: str) -> str:
    """The token in the script that it is consistent in; unchanged where no Latin letter stands in it."""
    kind, _ = token_scripts(token)
    if kind in ("single", "whole"):
        return token
    parts = unicodedata.normalize("NFD", token)
    if not any(scripts(c) == LATIN for c in parts):
        return token
    return unicodedata.normalize("NFC", "".join(CONFUSABLE.get(c, c) for c in parts))


def consistent(text: str) -> str:
    """`text` in consistent form.

    Composed characters; ASCII for wide forms; U+0020 for other blanks, line breaks stay; nothing
    without width; in tokens with Latin letters the Latin letter for one of another script that
    looks like it; Đ and đ for the letters used in their place. All else stays.
    """
    if text.isascii() and not _ODD.search(text):
        return text
    if _ODD.search(text):
        text = _BLANK.sub(" ", _DROP.sub("", text)).translate(_SINGLE)
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    if _SCRIPTED.search(text):
        text = _TOKEN.sub(lambda m: _spelled(m.group()) if _SCRIPTED.search(m.group()) else m.group(), text)
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
    return text


def consistent_values(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, clean) for every value of `fields` that isn't in consistent form; nulls never are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, field in enumerate(fields, 1):
                values = batch.column(i).to_pylist()
                rows, clean = [], []
                for r, v in enumerate(values):
                    if v is not None and (c := consistent(v)) != v:
                        rows.append(r)
                        clean.append(c)
                if rows:
                    keys = batch.column(0).take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([keys, pa.array([field] * len(rows)), pa.array(clean)], [key, "field", "clean"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(*(df[f"`{c}`"] for c in [key, *fields])).mapInArrow(run, f"`{key}` {kind}, field string, clean string")
