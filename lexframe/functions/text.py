"""Text functions as Spark column expressions; nothing here leaves the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

def _class(*ranges: int | tuple[int, int]) -> str:
    """The inside of a character class, in a form that Java and RE2 read alike."""
    return "".join(chr(r) if isinstance(r, int) else f"{chr(r[0])}-{chr(r[1])}" for r in ranges)


#: White space other than the line break, as the inside of a character class.
BLANKS = _class(0x09, 0x0B, 0x0C, (0x1C, 0x20), 0x85, 0xA0, 0x1680, (0x2000, 0x200A), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: Control and format characters that are no white space.
INVISIBLE = _class((0x00, 0x08), (0x0E, 0x1B), (0x7F, 0x84), (0x86, 0x9F), 0xAD, (0x600, 0x605), 0x61C, 0x6DD, 0x70F, 0x180E, (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x2064), (0x2066, 0x206F), 0xFEFF, (0xFFF9, 0xFFFB))
# Punctuation and the plain characters it becomes.
PLAIN_FROM, PLAIN_TO = "\r\u2018\u2019\u201c\u201d\u2013\u2014\u2212", "\n''\"\"---"
# End of the fixed values.


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often it is referred to."""
    return F.get(F.transform(F.array(value), use), 0)


def _folding() -> tuple[str, str]:
    """Accented Latin letters and their base letters, by decomposition."""
    pairs = {}
    for i in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFD", chr(i))
        plain = "".join(c for c in base if unicodedata.category(c) != "Mn")
        if len(plain) == 1 and plain != chr(i):
            pairs[chr(i)] = plain
    pairs |= {"đ": "d", "Đ": "D"}
    return "".join(pairs), "".join(pairs.values())


ACCENTED, BASE = _folding()


def strip_accents(c: Column) -> Column:
    """Latin letters without accents, d for đ; combining marks dropped."""
    return F.translate(F.regexp_replace(c, r"\p{Mn}", ""), ACCENTED, BASE)


def fold(c: Column) -> Column:
    """Without accents, white space collapsed, trimmed, lower case; null is empty."""
    return F.lower(F.trim(F.regexp_replace(strip_accents(F.coalesce(c, F.lit(""))), f"[{BLANKS}\n\r]+", " ")))


def slug(c: Column) -> Column:
    """ASCII letters and digits joined by hyphens; `van-ban` where nothing is left."""
    return F.coalesce(F.nullif(F.lower(F.regexp_replace(F.regexp_replace(strip_accents(F.coalesce(c, F.lit(""))), "[^A-Za-z0-9]+", "-"), "^-+|-+$", "")), F.lit("")), F.lit("van-ban"))


def safe_filename(c: Column, fallback: str = "untitled") -> Column:
    """Letters, digits, `_` and `-` of any script; other runs become one `_`."""
    cleaned = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\p{L}\p{N}_\-]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit(fallback))


def cache_key(type_id: Column, keyword: Column, page_size: int) -> Column:
    """The name of a listing's cache for a type, a keyword and a page size."""
    kind = F.coalesce(F.nullif(type_id, F.lit("")), F.lit("all"))
    word = F.coalesce(F.nullif(F.regexp_replace(F.trim(F.coalesce(keyword, F.lit(""))), "[^A-Za-z0-9_-]+", "_"), F.lit("")), F.lit("no_keyword"))
    return F.concat(F.lit("list_items_type_"), kind, F.lit("_"), word, F.lit(f"_ps{page_size}.jsonl"))


def normalize_fast(c: Column) -> Column:
    """Plain quotes and dashes, no invisible characters, single blanks, single line breaks.

    For composed (NFC) text the same as `normalize.normalize_text`; blanks before a line break and at
    the start go, as do blanks and line breaks at the end.
    """
    text = F.translate(c, PLAIN_FROM, PLAIN_TO)
    text = F.regexp_replace(text, f"[{INVISIBLE}]", "")
    text = F.regexp_replace(text, f"[{BLANKS}]+", " ")
    text = F.regexp_replace(text, " *\n[ \n]*", "\n")
    return F.regexp_replace(text, "^ +|[ \n]+$", "")


#: Steps from HTML to lines of text, as (pattern, replacement), valid in Java and RE2.
HTML_STEPS = (
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<script\b.*?</script *>", ""),
    (r"(?is)<style\b.*?</style *>", ""),
    (r"(?is)<noscript\b.*?</noscript *>", ""),
    (r"(?i)<br *(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>", "\n"),
    (r"(?i)</(?:p|div|tr|li|h[1-6]|table|ul|ol|blockquote)\b *>", "\n"),
    (r"(?i)<(?:p|div|tr|li|h[1-6]|table|ul|ol|blockquote)\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>", "\n"),
    (r"</?[A-Za-z](?:[^<>\"']|\"[^\"]*\"|'[^']*')*>", " "),
    (r"(?i)&nbsp;", " "),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"&quot;", '"'),
    (r"&amp;", "&"),
    ("[ \t\r\x0b\x0c\xa0]+", " "),
    (" *\n[ \n]*", "\n"),
    ("^[ \n]+|[ \n]+$", ""),
)


def html_text(c: Column) -> Column:
    """Lines of text of an HTML page; null is empty. Block tags end lines, inline tags part words."""
    text = F.coalesce(c, F.lit(""))
    for pattern, replacement in HTML_STEPS:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def lines(c: Column) -> Column:
    return F.split(c, "\n")


def without_repeats(items: Column) -> Column:
    """An array without entries equal to the one before them."""
    return F.filter(items, lambda x, i: (i == 0) | (~x.eqNullSafe(F.try_element_at(items, F.when(i > 0, i).otherwise(F.lit(1))))))


def is_blank(c: Column) -> Column:
    """Whether a text is empty or all white space."""
    return c.rlike(f"^[{BLANKS}\n\r]*$")


def html_lines(c: Column) -> Column:
    """The lines of a page, consecutive duplicates once; none for an empty page."""
    text = html_text(c)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(without_repeats(lines(text)))


def sentences(c: Column) -> Column:
    """Sentences: cut at white space after . ! ? or ;"""
    return F.split(c, r"(?<=[.!?;])[ \t\n\r\x0b\f]+")


def name_of(*candidates: Column) -> Column:
    """The first candidate that is neither null nor empty, else empty."""
    return F.coalesce(*(F.nullif(x, F.lit("")) for x in candidates), F.lit(""))


def date_head(c: Column) -> Column:
    """An ISO time's date; null is empty."""
    return F.split_part(F.coalesce(c, F.lit("")), F.lit("T"), F.lit(1))


def join_names(items: Column) -> Column:
    """Names joined by a comma and a blank, empty and null ones left out."""
    return F.array_join(F.filter(items, lambda x: F.coalesce(x, F.lit("")) != ""), ", ")


def value_variants(c: Column) -> Column:
    """Ways in which a value can stand in a text, without repeats, in order.

    The value; of a long legal title the type and number; of an ISO date three other forms; the value
    without blanks around `/` and `-`, and with these swapped. Empty forms and ``--`` are left out.
    """
    return bound(normalize_fast(c), _variants)


def _variants(value: Column) -> Column:
    legal = F.regexp_replace(F.rtrim(F.regexp_extract(value, r"(?iu)^(.+?\bsố[ \t\n\r]+[^ \t\n\r]+)", 1)), "[.,;:]+$", "")
    date = r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})$"
    year, month, day = (F.regexp_extract(value, date, i) for i in (1, 2, 3))
    real = value.rlike(date) & F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))).isNotNull()
    bare = lambda x: F.regexp_replace(x, "^0(?=.)", "")
    dates = F.when(
        real,
        F.array(
            F.concat_ws("/", F.lpad(day, 2, "0"), F.lpad(month, 2, "0"), year),
            F.concat_ws("/", bare(day), bare(month), year),
            F.concat(F.lit("ngày "), bare(day), F.lit(" tháng "), bare(month), F.lit(" năm "), year),
        ),
    ).otherwise(F.array().cast("array<string>"))
    compact = F.regexp_replace(value, r"[ \t\n\r]*([/-])[ \t\n\r]*", "$1")
    swapped = bound(compact, lambda x: F.array(x, F.translate(x, "/", "-"), F.translate(x, "-", "/")))
    return F.array_distinct(F.filter(F.concat(F.array(value, legal), dates, swapped), lambda v: (v != "") & (v != "--")))


def payload_bytes(c: Column) -> Column:
    """The bytes of a payload: base64 with or without its padding; null where it is none."""
    body = F.regexp_replace(c, "[ \t\n\r=]", "")
    return F.try_to_binary(F.rpad(body, (F.ceil(F.length(body) / 4) * 4).cast("int"), F.lit("=")), F.lit("base64"))


def hex_length(c: Column) -> Column:
    """A length given in hexadecimal digits."""
    return F.conv(c, 16, 10).cast("bigint")


def extension(c: Column) -> Column:
    """The last suffix of a path, with its dot, lower case; empty where there is none."""
    return F.lower(F.regexp_extract(c, r"[^/.](\.[^/.]+)$", 1))


def stem(c: Column) -> Column:
    return F.regexp_extract(c, r"([^/]+?)(?:\.[^/.]*)?$", 1)


def parent(c: Column) -> Column:
    """The name of the directory that a path lies in."""
    return F.regexp_extract(c, r"([^/]+)/[^/]*$", 1)


# Beginnings of a signature's title, lines that are none, and parts that no person's name has.
TITLE_MARKERS = ("TM.", "KT.", "TL.", "TUQ.", "THỦ TƯỚNG", "PHÓ THỦ TƯỚNG", "BỘ TRƯỞNG", "THỨ TRƯỞNG", "CHỦ TỊCH", "PHÓ CHỦ TỊCH", "CHÁNH ÁN", "VIỆN TRƯỞNG", "TỔNG KIỂM TOÁN", "THỐNG ĐỐC")
RECIPIENTS = ("NƠI NHẬN", "LƯU:", "KÍNH GỬI")
NOT_IN_NAMES = ("TM.", "KT.", "THỦ TƯỚNG", "PHÓ THỦ TƯỚNG", "BỘ TRƯỞNG", "CHỦ TỊCH", "PHỤ LỤC", "NƠI NHẬN", "LƯU:", "CHÍNH PHỦ", "CỘNG HÒA", "ĐÃ KÝ")
# End of the fixed values.


def _quoted(words: tuple[str, ...]) -> str:
    return "|".join(w.replace(".", r"\.") for w in words)


def is_signature_title(line: Column) -> Column:
    """Whether a line is the title above a signature."""
    text = F.upper(F.trim(F.regexp_replace(F.coalesce(line, F.lit("")), f"[{BLANKS}\n\r]+", " ")))
    return (F.length(text) <= 160) & ~text.rlike(f"^(?:{_quoted(RECIPIENTS)})") & text.rlike(f"^(?:{_quoted(TITLE_MARKERS)})")


def is_person_name(line: Column) -> Column:
    """Whether a line can be a person's name: two to six words, capitals first, no digits, no other matter."""
    text = F.trim(F.regexp_replace(F.coalesce(line, F.lit("")), f"[{BLANKS}\n\r]+", " "))
    words = F.split(text, " ")
    first = lambda w: F.substring(w, 1, 1)
    capital = F.forall(words, lambda w: ~first(w).rlike(r"\p{L}") | first(w).rlike(r"\p{Lu}"))
    return ~text.rlike("[0-9]") & ~F.upper(text).rlike(_quoted(NOT_IN_NAMES)) & F.size(words).between(2, 6) & capital
