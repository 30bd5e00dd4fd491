"""Weak labels: attribute values that stand in the text, the schema they induce, splits and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from . import spans

# Paths that are labels whatever their match, and endings of paths that never are.
FORCED = {"schema_json.relations[].relation_type": "LOAI_QUAN_HE_VAN_BAN", "schema_json.relations[].documents[].title": "VAN_BAN_LIEN_QUAN"}
NEVER = ("item_id", "url_toanvan")
METADATA = ("attribute_json.metadata.", "schema_json.current_document.")
# End of the fixed values.


#: Rows that are ranked together.
RANKED = 65_536


def json_depth(df: DataFrame, column: str) -> int:
    """The most containers within each other in the JSON texts of a column; 0 where there are none. Brackets in strings don't count."""
    marks = F.col(column)
    for pattern in (r"(?s)\\.", r'(?s)"[^"]*"', r"[^\[\]{}]"):
        marks = F.regexp_replace(marks, F.lit(pattern), F.lit(""))
    step = lambda a, m: F.when(m.isin("{", "["), a["now"] + 1).otherwise(a["now"] - 1)
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    deepest = F.aggregate(F.split(marks, ""), start, lambda a, m: F.when(m == "", a).otherwise(F.struct(step(a, m).alias("now"), F.greatest(a["most"], step(a, m)).alias("most"))), lambda a: a["most"])
    return df.where(F.try_parse_json(F.col(column)).isNotNull()).select(F.max(deepest)).first()[0] or 0


def flatten_json(df: DataFrame, column: str, keys: list[str], depth: int | None = None, first: bool = False) -> DataFrame:
    """(keys, path, value, type) of the leaves of JSON texts, `[]` in a path for the entries of an array.

    Null leaves are kept, empty containers and unreadable texts have none. Without
    `depth` every level is read, as many as the deepest text has, which is looked for first; else what
    is nested deeper comes as one leaf, JSON text of its type. With `first` only the first entry of an array is looked at, and
    empty containers are leaves, too. Levels are arrays of one row, so there is one scan and one explode, and no shuffle.
    """
    depth = json_depth(df, column) if depth is None else depth
    leaf = "struct<path:string,value:string,type:string>"
    kind = lambda n: F.schema_of_variant(n["v"])
    inner = lambda n: kind(n).rlike("^(OBJECT|ARRAY)")

    def children(n: Column) -> Column:
        head = F.when(n["path"] == "", F.lit("")).otherwise(F.concat(n["path"], F.lit(".")))
        members = F.transform(F.map_entries(F.try_variant_get(n["v"], "$", "map<string,variant>")), lambda m: F.struct(F.concat(head, m["key"]).alias("path"), m["value"].alias("v")))
        listed = F.try_variant_get(n["v"], "$", "array<variant>")
        entries = F.transform(F.slice(listed, 1, 1) if first else listed, lambda e: F.struct(F.concat(n["path"], F.lit("[]")).alias("path"), e.alias("v")))
        return F.when(kind(n).startswith("OBJECT"), members).otherwise(entries)

    def ends(level: Column, last: bool) -> Column:
        chosen = level if last else F.filter(level, lambda n: ~inner(n) | (F.size(children(n)) == 0) if first else ~inner(n))
        return F.transform(chosen, lambda n: F.struct(n["path"].alias("path"), F.try_variant_get(n["v"], "$", "string").alias("value"), F.lower(F.regexp_extract(kind(n), "^([A-Z]+)", 1)).alias("type")))

    rows = df.select(*keys, F.array(F.struct(F.lit("").alias("path"), F.try_parse_json(F.col(column)).alias("v"))).alias("_level"), F.expr(f"cast(array() as array<{leaf}>)").alias("_ends")).where("_level[0].v is not null")
    for d in range(depth + 1):
        level = F.col("_level")
        rows = rows.select(*keys, F.concat("_ends", ends(level, d == depth)).alias("_ends"), *([] if d == depth else [F.flatten(F.transform(F.filter(level, inner), children)).alias("_level")]))
    return rows.select(*keys, F.inline("_ends"))


def json_shapes(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """(keys, shape): the structure of JSON texts: paths and types, one to a line, sorted, of arrays the first entry's; unreadable texts have none."""
    leaves = flatten_json(df, column, keys, first=True).select(*keys, F.concat_ws(":", "path", "type").alias("leaf"))
    return leaves.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list("leaf")), "\n").alias("shape"))  # of one text


def record_leaves(df: DataFrame, columns: dict[str, str], keys: list[str]) -> DataFrame:
    """(keys, path, value) of attribute columns, as if flattened from their export; null, blank and `--` are none."""
    pairs = F.array(*[F.struct(F.lit(p).alias("path"), F.col(c).alias("value")) for c, p in columns.items()])
    rows = df.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.path", "p.value")
    return rows.where(F.col("value").isNotNull() & ~F.trim("value").isin("", "--"))


def path_profile(leaves: DataFrame, texts: DataFrame, text: str, keys: list[str], examples: int = 5) -> DataFrame:
    """(path, documents, document_rate, values, exact_match_rate, normalized_match_rate, combined_match_rate, average_length, examples).

    A value matches exactly when one of its variants stands in the text, otherwise it may match with case
    folded. Examples are the first values in order, shortened to 200 characters.
    """
    total = texts.agg(F.greatest(F.count("*"), F.lit(1)).alias("n"))
    rows = leaves.join(texts.select(*keys, F.col(text).alias("_text"), F.lower(text).alias("_low")), keys)
    exact = lambda vs: F.exists(vs, lambda v: F.contains(F.col("_text"), v))
    folded = lambda vs: F.exists(vs, lambda v: F.contains(F.col("_low"), F.lower(v)))
    hits = X.bound(X.value_variants(F.col("value")), lambda vs: F.struct(exact(vs).alias("e"), folded(vs).alias("f")))
    rows = rows.select(*keys, "path", "value", hits.alias("h")).select(*keys, "path", "value", "h.e", "h.f")
    mean = lambda c: F.avg(c.cast("double"))
    found = rows.groupBy("path").agg(
        F.countDistinct(*keys).alias("documents"),
        F.count("*").alias("values"),
        mean(F.col("e")).alias("exact_match_rate"),
        mean(~F.col("e") & F.col("f")).alias("normalized_match_rate"),
        mean(F.col("e") | F.col("f")).alias("combined_match_rate"),
        F.avg(F.length("value")).alias("average_length"),
    )
    first = rows.groupBy("path", F.substring("value", 1, 200).alias("value")).agg(F.lit(1).alias("_"))
    top = first.withColumn("_n", F.row_number().over(Window.partitionBy("path").orderBy("value"))).where(F.col("_n") <= examples)
    shown = top.groupBy("path").agg(F.array_join(F.array_sort(F.collect_list("value")), " | ").alias("examples"))
    return found.join(shown, "path", "left").select("path", "documents", (F.col("documents") / total.select("n").scalar()).alias("document_rate"), "values", "exact_match_rate", "normalized_match_rate", "combined_match_rate", "average_length", "examples")


def induced_labels(profile: DataFrame, least: float = 0.20, longest: float = 250.0) -> DataFrame:
    """The profile with `is_span_entity`, `name` of the label and `role` (label, metadata or ignored)."""
    path = F.col("path")
    never = F.lit(False)
    for end in NEVER:
        never = never | path.endswith(end)
    metadata = F.lit(False)
    for start in METADATA:
        metadata = metadata | path.startswith(start)
    candidate = ~path.startswith("schema_json.") | path.endswith("documents[].title")
    forced = F.create_map(*[F.lit(x) for pair in FORCED.items() for x in pair])
    name = F.try_element_at(forced, path)
    entity = ((F.col("combined_match_rate") >= least) & (F.col("average_length") <= longest) & ~never & ~metadata & candidate) | name.isNotNull()
    label = F.coalesce(name, F.replace(F.replace(F.upper(path), F.lit("."), F.lit("_")), F.lit("[]"), F.lit("")))
    return profile.withColumn("is_span_entity", entity).withColumn("name", F.when(entity, label)).withColumn("role", F.when(entity, "label").when(metadata, "metadata").otherwise("ignored"))


def weak_spans(leaves: DataFrame, labels: DataFrame, texts: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, path, label, start_char, end_char) of the values of labelled paths in their texts.

    labels: (path, name, allow_multiple). Where a label doesn't allow several, the first span of each value counts.
    """
    wanted = leaves.join(labels.select("path", "name", "allow_multiple"), "path")
    found = wanted.join(texts.select(*keys, F.col(text).alias("_text"), spans.folded(F.col(text)).alias("_low")), keys)
    variants = found.select(*keys, "path", "name", "allow_multiple", "value", "_text", "_low", F.explode(X.value_variants(F.col("value"))).alias("variant"))
    at = variants.select(*keys, "path", "name", "allow_multiple", "value", F.length("variant").alias("_n"), F.explode(spans.occurrences(F.col("_text"), F.col("variant"), F.col("_low"))).alias("start_char"))
    every = at.select(*keys, "path", "name", "allow_multiple", "value", "start_char", (F.col("start_char") + F.col("_n")).alias("end_char")).distinct()
    one = every.where("not allow_multiple").groupBy(*keys, "path", "name", "value").agg(F.min(F.struct("start_char", "end_char")).alias("s")).select(*keys, "path", F.col("name").alias("label"), "s.start_char", "s.end_char")
    return one.unionByName(every.where("allow_multiple").select(*keys, "path", F.col("name").alias("label"), "start_char", "end_char"))


# --- samples and splits -------------------------------------------------------------------------


def ranked_by(df: DataFrame, order: list[Column]) -> DataFrame:
    """`df` with `_rank`, the dense place from 0 in a total order, without sorting in one task.

    The first key is cut into ranges by its first four characters; counts of the ranges are summed up and the
    rows ranked within each. `order[0]` must be a string that spreads evenly, such as a digest.
    """
    head = F.substring(order[0], 1, 4)
    rows = df.withColumn("_range", head)
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # at most 65,536 ranges of four hexadecimal digits
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return rows.withColumn("_own", own).join(starts, "_range").withColumn("_rank", F.col("_start") + F.col("_own")).drop("_range", "_own", "_start")


def digest_order(key: Column, seed: int = 42) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), key.cast("string")).cast("binary"), 256)


def split_by_digest(df: DataFrame, key: str, ratios: tuple[float, float, float] = (0.70, 0.15, 0.15), seed: int = 42) -> DataFrame:
    """(key, split): train, validation and test of exact sizes, in the order of a seeded digest of the key.

    Sizes are the integer parts of n times the ratio, test has the rest. Rows are keyed: equal keys stay together
    only if they are one row.
    """
    rows = df.select(key).withColumn("_d", digest_order(F.col(key), seed))
    ranked = ranked_by(rows, [F.col("_d"), F.col(key)])
    n = df.agg(F.count("*").alias("n")).select("n").scalar()
    train, validation = F.floor(n * F.lit(ratios[0])), F.floor(n * F.lit(ratios[1]))
    return ranked.select(key, F.when(F.col("_rank") < train, "train").when(F.col("_rank") < train + validation, "validation").otherwise("test").alias("split"))


def systematic_sample(df: DataFrame, key: str, size: int) -> DataFrame:
    """Every n/size-th row in the order of the key, a number: places floor(i * n / size); all rows where there are no more than `size`.

    Rows are ranked in ranges of keys that would hold `RANKED` rows each if the keys were spread evenly, so there are as many
    ranges as the rows need, however far apart the keys lie. Rows with a null key come first.
    """
    sums = df.agg(F.count("*").alias("n"), F.min(key).cast("double").alias("low"), F.max(key).cast("double").alias("high"))
    n, low, high = (sums.select(c).scalar() for c in ("n", "low", "high"))
    width = F.greatest((high - low) / F.greatest(F.ceil(n / F.lit(RANKED)), F.lit(1)), F.lit(1.0))
    ranked = df.withColumn("_range", F.coalesce(F.floor((F.col(key).cast("double") - low) / width), F.lit(-1).cast("bigint")))
    sizes = ranked.groupBy("_range").agg(F.count("*").alias("_n"))
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1
    placed = ranked.withColumn("_own", own).join(starts, "_range").withColumn("_rank", F.col("_start") + F.col("_own"))
    step = n.cast("double") / size
    nearest = F.ceil(F.col("_rank") / step)
    taken = (n <= size) | ((F.floor(nearest * step) == F.col("_rank")) & (nearest < size))
    return placed.where(taken).drop("_range", "_own", "_start", "_rank")


def sampled_negatives(df: DataFrame, key: str, positive: Column, ratio: float, seed: int = 42) -> DataFrame:
    """All positive rows, and of the others the first floor(positives * ratio) in the order of a seeded digest."""
    rows = df.withColumn("_pos", positive).withColumn("_d", digest_order(F.col(key), seed))
    wanted = rows.agg(F.floor(F.sum(F.col("_pos").cast("bigint")) * F.lit(ratio)).alias("n")).select("n").scalar()
    negatives = ranked_by(rows.where("not _pos"), [F.col("_d"), F.col(key)]).where(F.col("_rank") < wanted).drop("_rank")
    return rows.where("_pos").unionByName(negatives).drop("_pos", "_d")


def dataset_manifest(rows: DataFrame, key: str, digest: str, split: str = "split") -> DataFrame:
    """One row: documents, their number in each split, and a hash over the sorted pairs of key and digest.

    The hash is made of the hashes of 65,536 ranges, so no task sees all documents.
    """
    sums = rows.agg(F.count("*").alias("documents"), *[F.sum((F.col(split) == s).cast("bigint")).alias(s) for s in ("train", "validation", "test")])
    line = F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(digest), F.lit("")))
    ranges = rows.select(line.alias("l")).select("l", F.substring(F.md5("l"), 1, 4).alias("r")).groupBy("r").agg(F.md5(F.array_join(F.array_sort(F.collect_list("l")), "\n")).alias("h"))
    whole = ranges.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "h"))), lambda x: x["h"]), ""), 256).alias("dataset_hash"))
    return sums.withColumn("dataset_hash", whole.select("dataset_hash").scalar())
