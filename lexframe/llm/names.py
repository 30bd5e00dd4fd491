"""Links names as people typed them to the register entries that they denote.

Names meet by token suffixes: typed and registered names are exploded into the suffixes of
their tokens and joined on them. Of each suffix there is a key alone and keys with another field (the kind of office of
an organisation, the organisation or the title of a person), and of each token one with every other near it.
A suffix that more than a given number of entries have counts only with such a field or token, and is left out only
if it is still common then, so the entries that a name is compared with don't grow with the register. Pairs that meet are compared by
the ratio of their longest common subsequence, on forms without accents in which the keystrokes of the usual input
methods (doubled letters, w, tone letters and digits) are resolved.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .lookalikes import consistent

#: Shortest proper suffix of a token, entries beyond which a suffix is common, distance of tokens that refine each other.
LEAST, COMMON, APART = 3, 25, 4
# Words before a name that are no part of it, and words of birth order and kinship.
HONORIFICS = {"ong", "ba", "anh", "chi", "bac", "co", "chu", "cau", "di", "ks", "ths", "ts", "gs", "pgs", "bs", "ls", "cn", "dc", "tskh", "cvc", "cv"}
BIRTH_ORDER = {"ca", "hai", "ba", "tu", "nam", "sau", "bay", "tam", "chin", "muoi", "ut"}
SHORT_WORDS = {"ub": "ui ban", "ubnd": "ui ban nhan dan", "hdnd": "hoi dong nhan dan", "nd": "nhan dan", "t": "tinh", "h": "huien", "p": "pho", "tp": "thanh pho"}
# End of the fixed values.

_VOWELS = set("aeiouy")
_DEGREES = re.compile(r"^(?:(?:PGS|GS|TSKH|TS|ThS|THS|KS|BS|LS|CN|CVC|Đ/[cC]|đ/c)[.\s]*)+(?=([^\W\d_]))")


@lru_cache(maxsize=100_000)
def canonical(token: str) -> str:
    """A token without case, accents and the keystrokes of input methods; i stands for y."""
    t = unicodedata.normalize("NFD", token.lower().replace("đ", "d"))
    t = "".join(c for c in t if not unicodedata.combining(c))
    if not any(c.isalpha() for c in t):
        return t
    t = re.sub(r"\d", "", t)
    t = re.sub(r"^dd", "d", t).replace("aa", "a").replace("ee", "e").replace("oo", "o")
    out, vowel = [], False
    for i, c in enumerate(t):
        if vowel and (c in "sfrxj" or c == "w"):
            continue  # no syllable has these after its vowel
        vowel = vowel or c in _VOWELS
        out.append(c)
    t = "".join(out).replace("y", "i")
    return t.replace("aa", "a").replace("ee", "e").replace("oo", "o")


@lru_cache(maxsize=100_000)
def tidy(value: str) -> str:
    """The value in consistent form, words run together split at capitals, white space as one blank; line breaks become ` - `."""
    text = re.sub(r"\s*\n\s*", " - ", consistent(value).strip())
    text = _DEGREES.sub(lambda m: "" if m.group(1).isupper() else m.group(), text)
    out = []
    for i, c in enumerate(text):
        if i and c.isupper() and (text[i - 1].islower() or text[i - 1].isdigit()):
            out.append(" ")
        out.append(c)
    return re.sub(r"\s+", " ", "".join(out)).strip()


@lru_cache(maxsize=50_000)
def registered(name: str) -> tuple[str, ...]:
    """The tokens of a registered name."""
    return tuple(tokens(tidy(name)))


def tokens(text: str) -> list[str]:
    return [c for w in re.findall(r"[^\W_]+|&", text) if (c := "va" if w == "&" else canonical(w))]


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, on the bits of one number."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        m = row & masks.get(c, 0)
        row = ((row + m) | (row - m)) & full
    return len(a) - row.bit_count()


@lru_cache(maxsize=500_000)
def ratio(a: str, b: str) -> float:
    return 2 * lcs(a, b) / (len(a) + len(b)) if a and b else 0.0


def close(a: str, b: str, slips: int = 1) -> bool:
    """Whether either has at most `slips` letters outside their longest common subsequence."""
    if abs(len(a) - len(b)) > slips:
        return False
    return a == b or max(len(a), len(b)) - lcs(a, b) <= slips


HONORIFICS = {canonical(w) for w in HONORIFICS}
BIRTH_ORDER = {canonical(w) for w in BIRTH_ORDER}

# --- persons ------------------------------------------------------------------------------------


@lru_cache(maxsize=100_000)
def person_forms(value: str) -> tuple[tuple[tuple[str, ...], float], ...]:
    """Readings of a typed person's name, as tokens with the family name first, and how sure each is."""
    text = tidy(value)
    text = re.sub(r"^\s*\([^)]*\)\s*", "", text)  # (signed)
    text = re.sub(r"\([^)]*\)", " ", text)  # a nickname
    parts = tokens(text.replace(",", " "))
    forms: list[tuple[tuple[str, ...], float]] = [(tuple(parts), 1.0)]
    if "," in text:
        last, _, rest = text.partition(",")
        forms.insert(0, ((*tokens(rest), *tokens(last)), 1.0))
    if len(parts) > 2:
        forms.append(((*parts[1:], parts[0]), 0.97))  # the given name first
    if len(parts) > 1 and parts[0] in HONORIFICS | BIRTH_ORDER:
        rest = tuple(parts[1:])
        forms.append((rest, 0.98 if len(rest) > 1 else 0.9))
        if len(rest) > 2 and rest[0] in HONORIFICS:
            forms.append((rest[1:], 0.97))
    return tuple(dict.fromkeys((f, s) for f, s in forms if f))


def person_score(value: str, name: tuple[str, ...], near: bool) -> float:
    """How well a typed name denotes a registered one (tokens); 0 if it doesn't.

    near: the organisation is known to be the person's; only then a given name alone, or a family and a
    given name, are enough.
    """
    best = 0.0
    whole = "".join(name)
    for form, sure in person_forms(value):
        typed = "".join(form)
        if close(typed, whole) and len(typed) > 3:
            if near or len(form) != len(name) or all(len(n) > 2 or t == n for t, n in zip(form, name)):  # a short word with a slip is another one
                best = max(best, sure * ratio(typed, whole))
        elif len(form) == len(name) and any(len(t) == 1 for t in form[:-1]):
            fits = all(t == n[:1] if len(t) == 1 else close(t, n) and t[:1] == n[:1] for t, n in zip(form[:-1], name))
            if fits and (form[-1] == name[-1] or len(name[-1]) > 3 and close(form[-1], name[-1])):
                best = max(best, 0.85 * sure * (1 if form[-1] == name[-1] else 0.9))
        elif len(form) == 2 and len(name) > 2 and sure >= 0.98:
            if form[0] == name[0] and form[1] == name[-1]:
                best = max(best, 0.8 * sure)
            elif near and (form[0] == name[0] and len(name[-1]) > 2 and close(form[1], name[-1]) or form[1] == name[-1] and len(name[0]) > 2 and close(form[0], name[0])):
                best = max(best, 0.75 * sure)
        elif near and len(form) == 3 and len(name) == 4 and sure == 1.0 and form[0] == name[0] and form[2] == name[3] and form[1] in name[1:3]:
            best = max(best, 0.7)
        elif near and len(form) == 1 and sure < 1 and form[0] == name[-1]:
            best = max(best, 0.6)
    return best


# --- organisations ------------------------------------------------------------------------------


def _spelt_out(parts: list[str]) -> list[str]:
    return [w for p in parts for w in SHORT_WORDS.get(p, p).split()]


@lru_cache(maxsize=100_000)
def office_forms(value: str) -> tuple[tuple[str, ...], ...]:
    """Readings of a typed organisation's name, as tokens."""
    text = tidy(value)
    forms = [tokens(text)]
    head, dash, tail = text.partition(" - ")
    if dash:
        forms.append(tokens(tail) + tokens(head))
    head, comma, tail = text.rpartition(",")
    if comma and (_spelt_out(tokens(tail)) or [""])[0] in ("ui", "hoi", "bo"):
        forms.append(tokens(head))
    out = []
    for f in forms:
        out += [tuple(_spelt_out(f)), tuple(f)]
    return tuple(dict.fromkeys(f for f in out if f))


def _without_level(parts: tuple[str, ...]) -> str:
    return "".join(p for p in parts if p not in ("tinh", "huien"))


@lru_cache(maxsize=20_000)
def abbreviations(name: str) -> frozenset[str]:
    """Forms of an organisation's name or a title of which a tail, or all, is given by initials."""
    parts = tokens(tidy(name))
    return frozenset("".join(parts[:k]) + "".join(p[0] for p in parts[k:] if p != "va") for k in range(len(parts) - 1))


def office_score(value: str, name: str, short_name: str | None) -> float:
    own = registered(name)
    whole, bare = "".join(own), _without_level(own)
    best = 0.0
    for form in office_forms(value):
        typed = "".join(form)
        slips = 2 if min(len(typed), len(whole)) > 24 else 1
        if close(typed, whole, slips):
            best = max(best, ratio(typed, whole))
        elif close(_without_level(form), bare) and len(bare) > 8:
            best = max(best, 0.97 * ratio(_without_level(form), bare))
        elif short_name and (typed == canonical(short_name) or typed in abbreviations(name)):
            best = max(best, 0.9)
    return best


# --- titles -------------------------------------------------------------------------------------


@lru_cache(maxsize=20_000)
def title_forms(value: str) -> tuple[tuple[str, ...], ...]:
    """Readings of a typed title; of one signed for another, the signer's own is the last part."""
    text = tidy(value)
    plain = tokens(text)
    parts = tokens(text.rpartition(" - ")[2]) if plain[:1] in (["kt"], ["tm"], ["tl"], ["tuq"]) else plain
    return tuple(dict.fromkeys((tuple(_spelt_out(parts)), tuple(parts))))


def _same_short_words(value: str, name: str) -> bool:
    """Whether no word of two letters or fewer is another one: such a word differs in one letter at most, accents counted."""
    mine, theirs = (re.findall(r"[^\W_]+", tidy(x).lower()) for x in (value, name))
    if len(mine) != len(theirs):
        return True
    return all(len(b) > 2 or canonical(a) == canonical(b) or close(a, b) and a[-1] == b[-1] for a, b in zip(mine, theirs))


def title_score(value: str, name: str) -> float:
    own = registered(name)
    whole = "".join(own)
    best = 0.0
    for form in title_forms(value):
        typed = "".join(form)
        if close(typed, whole, 2 if len(whole) > 20 else 1) and _same_short_words(value, name):
            best = max(best, ratio(typed, whole))
        elif len(form) == 1 and typed in abbreviations(name) or len(form) == 1 and typed == "".join(t[0] for t in own):
            best = max(best, 0.9)
        elif form[:1] in (("kt",), ("tm",), ("tl",), ("tuq",)) and len(form) > len(own):
            tail = "".join(form[-len(own) :])
            if close(tail, whole):  # the longest title that the name ends with is the signer's own
                best = max(best, 0.8 * ratio(tail, whole) + len(whole) / 1000)
    return best


# --- joins --------------------------------------------------------------------------------------


def suffixes(parts: tuple[str, ...] | list[str]) -> set[str]:
    """The tokens and their proper suffixes of `LEAST` letters or more."""
    return {p[i:] for p in parts for i in range(len(p)) if i == 0 or len(p) - i >= LEAST}


def together(parts: tuple[str, ...] | list[str]) -> set[str]:
    """Pairs of tokens that are at most `APART` apart, in whatever order."""
    return {"+".join(sorted((a, b))) for i, a in enumerate(parts) for b in parts[i + 1 : i + 1 + APART] if len(a) > 1 and len(b) > 1 and a != b}


_KINDS = {"string": pa.string(), "double": pa.float64(), "bigint": pa.int64()}


def _mapped(df: DataFrame, f: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """What `f` makes of the rows of each partition."""
    names, kinds = zip(*((c.split()[0], _KINDS[c.split()[1]]) for c in schema.split(", ")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = f(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        while rows := list(islice(out, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

    return df.mapInArrow(run, schema)


# Keys begin with the kind of register: a name of an office meets no title.
OFFICE, TITLE, PERSON = "office", "title", "person"


def _keys(kind: str, suffix: str, fields: tuple[str, ...]) -> Iterator[str]:
    """The key of a suffix alone and those of it with each field."""
    yield f"{kind}:{suffix}"
    for f in fields:
        yield f"{kind}:{suffix}|{f}"


def _entry_keys(rows: Iterator[tuple]) -> Iterator[tuple]:
    for kind, entity, name, short, office, title in rows:
        parts = registered(name)
        exact: set[str] = set()
        if kind == PERSON:
            fields: tuple[str, ...] = (f"office {office}", f"title {title}")
            exact = {"".join(parts)}
        else:
            fields = (parts[0],) if parts else ()
            exact = abbreviations(name) | {"".join(p[0] for p in parts)} | ({canonical(short)} if short else set())
        for s in suffixes(parts) | {"=" + e for e in exact}:
            for key in _keys(kind, s, fields):
                yield key, kind, entity, name, short, office, title
        for pair in together(parts):
            yield f"{kind}:{pair}", kind, entity, name, short, office, title


_ENTRY = "kind string, entity_id string, name string, short_name string, office string, title string"


def register_index(register: DataFrame) -> DataFrame:
    """(key, and the columns of the register) for the keys by which an entry is found.

    register: (kind, entity_id, name, short_name, office, title). A suffix alone is a key while at most `COMMON` entries have
    it, twice as many for persons; with a field while at most twice as many have both.
    """
    keys = _mapped(register.where("name is not null and entity_id is not null"), _entry_keys, f"key string, {_ENTRY}").distinct()
    most = F.lit(COMMON) * F.when(F.col("key").startswith(PERSON), 2).otherwise(1) * F.when(F.col("key").rlike("[|+]"), 2).otherwise(1)
    usable = keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") <= most).select("key")
    return keys.join(usable, "key")


def _typed_keys(rows: Iterator[tuple]) -> Iterator[tuple]:
    for kind, value, ctx, office, title in rows:
        seen: set[str] = set()
        if kind == PERSON:
            forms = [f for f, _ in person_forms(value)]
            field = f"office {office}" if office is not None else f"title {title}"
            for s in suffixes([p for f in forms for p in f if len(p) > 1]) | {"=" + "".join(f) for f in forms}:
                seen.update(_keys(kind, s, (field,)))
            seen.update(f"{kind}:{pair}" for f in forms for pair in together(f))
        else:
            for f in (office_forms if kind == OFFICE else title_forms)(value):
                for s in {"=" + "".join(f)} | suffixes(f):
                    seen.update(_keys(kind, s, (f[0],)))
                seen.update(f"{kind}:{pair}" for pair in together(f))
        for key in seen:
            yield key, value, ctx, office, title


def _accented(value: str, name: str) -> float:
    """A small bonus for the same accents, to tell entries apart that differ in nothing else."""
    return ratio(tidy(value).lower().replace(" ", ""), tidy(name).lower().replace(" ", "")) / 1000


def _score(kind: str, value: str, ctx: str, name: str, short: str | None) -> float:
    """How well a value denotes an entry; 0 if it doesn't. ctx: the states of the office and the title beside a person's name."""
    if kind == OFFICE:
        s = office_score(value, name, short)
    elif kind == TITLE:
        s = title_score(value, name)
    else:
        state, title_state = ctx.split("|", 2)[:2]
        s = person_score(value, registered(name), state == "linked")
        if s < 0.97 and (title_state == "unknown" or state == "unknown"):
            return 0.0
    return s + _accented(value, name) if s > 0 else 0.0


def _best(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The best entry of each value, whose rows follow each other; null where several are equally good, with their number."""
    for (kind, value, ctx), group in groupby(rows, key=lambda r: r[:3]):
        entries = {entity: (name, short) for _, _, _, entity, name, short in group}  # they meet on several keys
        scores = {entity: _score(kind, value, ctx, *entry) for entity, entry in entries.items()}
        top = max(scores.values())
        found = [(entity, entries[entity][0]) for entity, s in scores.items() if s >= top - 1e-9]
        if top > 0:
            yield kind, value, ctx, *(found[0] if len(found) == 1 else (None, None)), len(found)


def link_values(values: DataFrame, index: DataFrame) -> DataFrame:
    """(kind, value, ctx, entity_id, name, n) for the values that denote entries of `index`, see `register_index`.

    values: (kind, value, ctx, office, title), distinct; ctx, office and title are those of persons. n is the number of
    entries that fit equally well; where it is more than one, entity_id is null. Values that no entry fits give no row; so do
    nulls and empty tables. A person is looked for in the linked organisation; where none is given the name must
    be whole and fit one person only, of the linked title if there is one; under an organisation or a title
    that no entry has it must have no slip either.
    """
    typed = _mapped(values.where("value is not null").select("kind", "value", "ctx", "office", "title"), _typed_keys, "key string, value string, ctx string, asked_office string, asked_title string")
    met = typed.join(index, "key").where("(asked_office is null or asked_office = office) and (asked_title is null or title is null or asked_title = title)")
    rows = met.select("kind", "value", "ctx", "entity_id", "name", "short_name").repartition("value", "ctx").sortWithinPartitions("kind", "value", "ctx")
    return _mapped(rows, _best, "kind string, value string, ctx string, entity_id string, name string, n bigint")


def _spellings(column: Column) -> Column:
    """The value, or null for an empty name."""
    return F.when(~F.trim(column).isin("", "--"), column)


def resolve_documents(docs: DataFrame, officials: DataFrame, agencies: DataFrame, titles: DataFrame) -> DataFrame:
    """(record_id, field, value, entity_id, name, n) for every signer, issuer and signer_title that an entry fits.

    entity_id and name are null where n > 1 entries fit equally well. Each distinct spelling is linked once, so a
    name that a third of the rows carry costs no more than another. Nulls, blanks and ``--`` are no names. The
    registers and the docs may be empty. The registers are indexed once, and two passes follow: organisations and titles,
    then persons, whose organisation and title are known from the first.
    """
    none = F.lit(None).cast("string")
    rows = docs.select("record_id", *(_spellings(F.col(c)).alias(c) for c in ("signer", "issuer", "signer_title")))
    register = (
        agencies.select(F.lit(OFFICE).alias("kind"), F.col("agency_id").alias("entity_id"), "name", "short_name", none.alias("office"), none.alias("title"))
        .unionByName(titles.select(F.lit(TITLE).alias("kind"), F.col("title_id").alias("entity_id"), F.col("title").alias("name"), none.alias("short_name"), none.alias("office"), none.alias("title")))
        .unionByName(officials.select(F.lit(PERSON).alias("kind"), F.col("person_id").alias("entity_id"), F.col("full_name").alias("name"), none.alias("short_name"), F.col("agency_id").alias("office"), F.col("title_id").alias("title")))
    )
    index = checkpointed(register_index(register))
    sides = F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value")) for kind, c in ((OFFICE, "issuer"), (TITLE, "signer_title"))))
    asked = rows.select(F.explode(sides).alias("s")).select("s.*").where("value is not null").distinct()
    beside = checkpointed(link_values(asked.select("kind", "value", F.lit("").alias("ctx"), none.alias("office"), none.alias("title")), index))

    def linked(kind: str, column: str, name: str) -> DataFrame:
        return beside.where(F.col("kind") == kind).select(F.col("value").alias(column), F.struct("entity_id", "name", "n").alias(name))

    def state(column: str, found: str) -> Column:
        return F.when(F.col(f"{found}.entity_id").isNotNull(), "linked").when(F.col(column).isNull(), "empty").otherwise("unknown")

    known = rows.join(linked(OFFICE, "issuer", "office"), "issuer", "left").join(linked(TITLE, "signer_title", "title"), "signer_title", "left")
    ctx = F.concat_ws("|", state("issuer", "office"), state("signer_title", "title"), F.coalesce("office.entity_id", F.lit("")), F.coalesce("title.entity_id", F.lit("")))
    known = known.withColumn("ctx", ctx)
    people = known.where("signer is not null").select(F.lit(PERSON).alias("kind"), F.col("signer").alias("value"), "ctx", F.col("office.entity_id").alias("office"), F.col("title.entity_id").alias("title")).distinct()
    persons = checkpointed(link_values(people, index)).select(F.col("value").alias("signer"), "ctx", F.struct("entity_id", "name", "n").alias("person"))
    found = known.join(persons, ["signer", "ctx"], "left")
    fields = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("value"), F.col(x).alias("found")) for c, x in (("signer", "person"), ("issuer", "office"), ("signer_title", "title"))))
    return found.select("record_id", F.explode(fields).alias("f")).where("f.found is not null").select("record_id", "f.field", "f.value", "f.found.*")


def link_documents(docs: DataFrame, officials: DataFrame, agencies: DataFrame, titles: DataFrame) -> DataFrame:
    """(record_id, field, value, entity_id, name) of `resolve_documents`, where one entry fits best."""
    return resolve_documents(docs, officials, agencies, titles).where("entity_id is not null").drop("n")


def ambiguous_names(docs: DataFrame, officials: DataFrame, agencies: DataFrame, titles: DataFrame) -> DataFrame:
    """(record_id, field, value, n) of `resolve_documents`, where n entries fit equally well and none is given."""
    return resolve_documents(docs, officials, agencies, titles).where("entity_id is null").select("record_id", "field", "value", "n")
