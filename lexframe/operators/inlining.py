"""Deeply nested records as related flat tables, by shared inlining.

The schema is read as a graph: a node for each struct, an edge for each field. A descendant
that occurs once per record is inlined as columns of its owner; a descendant that repeats
(an array or a map) gets a table of its own, whose rows carry the key of the record, the place of their owner and their
own place. Elements with the same columns that are reached by several ways can be kept in one table, with the way
that each row came by. A schema is finite, so an element that contains itself is spelled out level by level; as its levels
have the same columns, they come together in such a table, too.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import bound

SEP = "__"


@dataclass
class Table:
    """One flat table of the plan.

    name: path of field names; parent: the owning table; columns: output name -> path from the
    row of this table; source: path of the array or map in the owner's row, empty for the root.
    """

    name: str
    parent: str | None
    source: tuple[str, ...]
    kind: str = "root"
    columns: dict[str, tuple[str, ...]] = field(default_factory=dict)
    shape: str = ""
    shared: bool = False


def _shape(kind: T.DataType) -> str:
    """What elements are told alike by: the names and types of the columns that they become, whatever repeats below them."""
    if isinstance(kind, T.StructType):
        return "struct<" + ",".join(f"{f.name}:{_shape(f.dataType)}" for f in kind.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType))) + ">"
    return kind.simpleString()


def inline_schema(schema: T.StructType, root: str = "record") -> dict[str, Table]:
    """The tables for `schema`, in order of depth.

    Arrays of structs that become the same columns, wherever they stand, are marked `shared`: `flatten_records` can keep their
    rows in one table, told apart by the path they came from.
    """
    tables: dict[str, Table] = {root: Table(root, None, ())}

    def walk(owner: Table, kind: T.DataType, path: tuple[str, ...], name: str) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(owner, f.dataType, (*path, f.name), f"{name}{SEP}{f.name}" if name else f.name)
        elif isinstance(kind, (T.ArrayType, T.MapType)):
            child = Table(f"{owner.name}.{name or 'value'}", owner.name, path, "array" if isinstance(kind, T.ArrayType) else "map")
            tables[child.name] = child
            element = kind.elementType if isinstance(kind, T.ArrayType) else kind.valueType
            child.shape = _shape(element)
            if isinstance(element, T.StructType):
                walk(child, element, (), "")
            elif isinstance(element, (T.ArrayType, T.MapType)):
                walk(child, element, (), "value")
            else:
                child.columns["value"] = ()
        else:
            column = name or "value"
            while column in owner.columns:
                column += "_"
            owner.columns[column] = path

    walk(tables[root], schema, (), "")
    shapes = Counter(t.shape for t in tables.values() if t.shape.startswith("struct"))
    for t in tables.values():
        t.shared = shapes[t.shape] > 1
    return tables


def _get(base: Column, path: tuple[str, ...]) -> Column:
    for name in path:
        base = base.getField(name)
    return base


def flatten_records(
    df: DataFrame, key: str, columns: list[str] | None = None, root: str = "record", carry: dict[str, list[str]] | None = None, shared: bool = False
) -> dict[str, DataFrame]:
    """The flat tables of `df`, by name; `key` identifies a record.

    `carry` names, for a child table, columns of its owner that its rows repeat (with a leading
    ``_``), where a join over the foreign key would cost a shuffle.

    With `shared`, tables whose elements have the same columns are one, under the name of the first; its rows have
    `_path`, the name of the table that each would stand in.

    Each child row has `_key` (of the record), `_parent_place` (places of its owners, joined by
    ``.``; empty below the root), `_place` (1 for the first, null entries counted) and, for maps,
    `_map_key`. Null entries of an array give no row but keep their place; null and empty arrays
    give no rows; repeated records give repeated rows. Columns of the input that are called like
    these get a trailing ``_``. Nothing is shuffled: every table is a projection and explode of
    the same scan, of which Spark reads only the columns needed.
    """
    columns = columns or [c for c in df.columns if c != key]
    schema = T.StructType([df.schema[c] for c in columns])
    plan = inline_schema(schema, root)
    record = F.struct(*[F.col(f"`{c}`") for c in columns])
    made: dict[str, DataFrame] = {}
    rows: dict[str, DataFrame] = {}
    for t in plan.values():
        if t.parent is None:
            rows[t.name] = df.select(F.col(f"`{key}`").alias("_key"), F.lit("").alias("_places"), record.alias("_row"))
            made[t.name] = rows[t.name].select("_key", *[_get(F.col("_row"), p).alias(_free(c)) for c, p in t.columns.items()])
            continue
        base = rows[t.parent]
        owner = _get(F.col("_row"), t.source)
        names = (carry or {}).get(t.name, [])
        kept = [_get(F.col("_row"), plan[t.parent].columns[c]).alias(f"_{c}") for c in names]
        if t.kind == "array":
            out = base.select("_key", F.col("_places").alias("_parent_place"), *kept, F.posexplode(owner).alias("_pos", "_row"))
            out = out.where(F.col("_row").isNotNull()).withColumn("_place", F.col("_pos") + 1).drop("_pos")
            extra: list[str] = []
        else:
            out = base.select("_key", F.col("_places").alias("_parent_place"), *kept, F.explode(owner).alias("_map_key", "_row"))
            out = out.where(F.col("_row").isNotNull()).withColumn("_place", F.col("_map_key").cast("string"))
            extra = ["_map_key"]
        here = F.when(F.col("_parent_place") == "", F.col("_place").cast("string")).otherwise(F.concat_ws(".", "_parent_place", F.col("_place").cast("string")))
        rows[t.name] = out.withColumn("_places", here)
        made[t.name] = out.select("_key", "_parent_place", "_place", *extra, *[f"_{c}" for c in names], *[_get(F.col("_row"), p).alias(_free(c)) for c, p in t.columns.items()])
    return _together(made, plan) if shared else made


def _together(made: dict[str, DataFrame], plan: dict[str, Table]) -> dict[str, DataFrame]:
    """The tables with those of one shape united."""
    out: dict[str, DataFrame] = {}
    first: dict[str, str] = {}
    for name, df in made.items():
        t = plan[name]
        if not t.shared:
            out[name] = df
            continue
        rows = df.withColumn("_path", F.lit(name)).withColumn("_place", F.col("_place").cast("string"))
        rows = rows if "_map_key" in df.columns else rows.withColumn("_map_key", F.lit(None).cast("string"))
        rows = rows.withColumn("_map_key", F.col("_map_key").cast("string"))
        owner = first.setdefault(t.shape, name)
        out[owner] = out[owner].unionByName(rows, allowMissingColumns=True) if owner in out else rows
    return out


def _free(name: str) -> str:
    return name + "_" if name in ("_key", "_parent_place", "_place", "_map_key", "_path") else name


#: Members of the relationship diagram and the direction that each stands for.
DIRECTIONS = {"outgoing": "documentNamesByType", "incoming": "documentNamesBySource"}
CODES = tuple(str(i) for i in range(1, 16))


def diagram_relations(raw: Column) -> Column:
    """The diagram, as JSON text, in the form of `relations`: array<struct<code, direction, ids>>.

    `ids` holds, in order, the id of each entry of the list, null for an entry that is no object or
    has none. Lists that are none, codes outside 1 to 15 and unreadable JSON give nothing.

    The text is read once and bound; of each member the lists that are there are taken, not every code that could be.
    """

    def lists(body: Column, direction: str) -> Column:
        members = F.map_entries(F.try_variant_get(body, f"$.{DIRECTIONS[direction]}", "map<string,variant>"))
        known = F.filter(members, lambda m: m["key"].isin(*CODES) & F.schema_of_variant(m["value"]).startswith("ARRAY"))
        made = F.transform(known, lambda m: F.struct(m["key"].alias("code"), F.lit(direction).alias("direction"), F.transform(F.try_variant_get(m["value"], "$", "array<variant>"), _entry_id).alias("ids")))
        return F.coalesce(made, F.array().cast("array<struct<code:string,direction:string,ids:array<string>>>"))

    def relations(body: Column) -> Column:
        return F.concat(*(lists(body, d) for d in DIRECTIONS))

    def body(whole: Column) -> Column:
        inner = F.try_variant_get(whole, "$.data", "variant")
        return F.when(F.schema_of_variant(inner).startswith("OBJECT"), inner).otherwise(whole)

    return bound(F.try_parse_json(raw), lambda whole: bound(body(whole), relations))


def _entry_id(entry: Column) -> Column:
    def text(name: str) -> Column:
        v = F.try_variant_get(entry, f"$.{name}", "variant")
        return bound(v, lambda x: F.when(F.schema_of_variant(x).rlike("^(STRING|BIGINT|DECIMAL|DOUBLE)"), F.nullif(F.try_variant_get(x, "$", "string"), F.lit(""))))

    return F.coalesce(text("id"), text("docId"))
