"""Orphan references: keys that are referred to while no record of them exists.

References made and withdrawn are signed changes of a reference count, records and removals such of an existence
count. A key whose reference count is positive while its existence count is zero is an orphan.
`count_deltas` and `merge_counts` keep both counts per key from batches of changes, in whatever order these come;
`orphan_references` runs the same counts over time, for the references that were orphans when they were made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import BLANKS

#: Identifiers at the end of an address: a UUID, or digits after two hyphens.
URL_ID = r"(?i)(?:([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})|--([0-9]+))/*\s*$"


def same_id(column: Column) -> Column:
    """The form under which ids are compared: trimmed, lower case; null stays null."""
    return F.lower(F.regexp_replace(column, f"^[{BLANKS}\n\r]+|[{BLANKS}\n\r]+$", ""))


def id_of_url(column: Column) -> Column:
    """The id at the end of an address, or null."""
    found = F.coalesce(
        F.nullif(F.regexp_extract(column, URL_ID, 1), F.lit("")),
        F.nullif(F.regexp_extract(column, URL_ID, 2), F.lit("")),
    )
    return F.lower(found)


#: What a change says of its key.
REFERENCE, WITHDRAWN, RECORD, REMOVAL = "reference", "withdrawn", "record", "removal"
#: The time of records and references without one: after all others.
FINAL = "9999-12-31 23:59:59"


def change_log(refs: DataFrame, records: DataFrame, removals: DataFrame, withdrawn: DataFrame | None = None) -> DataFrame:
    """(ref_id, change, ts) from tables with (ref_id, ts); nulls as ids are dropped, and so are removals without a time."""
    final = F.lit(FINAL).cast("timestamp_ntz")
    parts = [(refs, REFERENCE), (records, RECORD), (removals, REMOVAL)] + ([(withdrawn, WITHDRAWN)] if withdrawn is not None else [])
    out = None
    for df, change in parts:
        at = F.col("ts").cast("timestamp_ntz")
        rows = df.where("ref_id is not null").select("ref_id", F.lit(change).alias("change"), at.alias("ts") if change == REMOVAL else F.coalesce(at, final).alias("ts"))
        rows = rows.where("ts is not null")
        out = rows if out is None else out.unionByName(rows)
    return out


def _per_key(changes: DataFrame, *keys: str) -> DataFrame:
    """(keys, d_ref, state): the change of the reference count, and what the last record (1) or removal (0) says, with its time.

    Combined before the shuffle: a key that a third of the changes have is one row for each task. At one instant a record
    wins over a removal.
    """
    sign = F.when(F.col("change") == REFERENCE, 1).when(F.col("change") == WITHDRAWN, -1).otherwise(0).cast("bigint")
    exists = F.when(F.col("change") == RECORD, 1).when(F.col("change") == REMOVAL, 0)
    state = F.when(exists.isNotNull(), F.struct(F.col("ts").alias("at"), exists.alias("exists")))
    return changes.groupBy(*keys).agg(F.sum(sign).alias("d_ref"), F.max(state).alias("state"), F.max(F.col("change") == RECORD).alias("fetched"))


def count_deltas(changes: DataFrame, counts: DataFrame | None) -> DataFrame:
    """Signed deltas (ref_id, d_ref, d_exist, exist_at) of a batch of `changes` (ref_id, change, ts) against the counts kept so far.

    The existence count of a key is one from a record on and zero from a removal on; its delta is the difference
    from the count that is kept, so a removal of an earlier batch's record counts -1 and a record fetched again 0.
    A change older than the one that made the count (`exist_at`) comes late and makes no difference.
    """
    batch = _per_key(changes, "ref_id")
    if counts is None:
        kept = F.lit(None).cast("struct<at:timestamp_ntz,exists:int>")
    else:
        old = counts.select("ref_id", F.when(F.col("exist_at").isNotNull(), F.struct(F.col("exist_at").alias("at"), F.col("n_exist").cast("int").alias("exists"))).alias("kept"))
        batch, kept = batch.join(old, "ref_id", "left"), F.col("kept")
    news = F.col("state").isNotNull() & (kept.isNull() | (F.col("state") > kept))
    before = F.coalesce(kept["exists"], F.lit(0))
    return batch.select(
        "ref_id",
        "d_ref",
        F.when(news, F.col("state.exists") - before).otherwise(0).cast("bigint").alias("d_exist"),
        F.when(news, F.col("state.at")).alias("exist_at"),
    )


def merge_counts(counts: DataFrame | None, deltas: DataFrame) -> DataFrame:
    """The counts per key (ref_id, n_ref, n_exist, exist_at) after the deltas of a batch.

    `counts` is the table kept so far, or null at the start. A key stays while it has references or ever was fetched or
    removed, as a late change is told by the time of the last one.
    """
    rows = deltas.select("ref_id", F.col("d_ref").alias("n_ref"), F.col("d_exist").alias("n_exist"), "exist_at")
    if counts is not None:
        rows = rows.unionByName(counts.select("ref_id", "n_ref", "n_exist", "exist_at"))
    merged = rows.groupBy("ref_id").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_exist").alias("n_exist"), F.max("exist_at").alias("exist_at"))
    return merged.where("n_ref <> 0 or exist_at is not null")


def current_orphans(counts: DataFrame) -> DataFrame:
    """Keys with references and without existence (ref_id, n_ref)."""
    return counts.where("n_ref > 0 and n_exist <= 0").select("ref_id", "n_ref")


def orphan_instants(changes: DataFrame, bucket: str = "hour") -> DataFrame:
    """(ref_id, at, n_ref, kind) for the instants at which a key is referred to while its existence count is zero.

    The signed changes (ref_id, change, ts) of one key and instant are summed up first (map-side), so references of one instant
    are one row; the counts run over them in two steps, as a key can carry a third of all rows and no window
    may hold all its instants: sums of a `bucket` of time are carried from bucket to bucket, and
    only the instants within one are put in order. kind as in `orphan_references`.
    """
    instants = _per_key(changes, "ref_id", "ts").select("ref_id", F.col("ts").alias("at"), "d_ref", F.col("state.exists").alias("state"), "fetched", F.date_trunc(bucket, "ts").cast("timestamp_ntz").alias("bucket"))
    by_time = Window.partitionBy("ref_id").orderBy("bucket")
    earlier = by_time.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        instants.groupBy("ref_id", "bucket")
        .agg(F.sum("d_ref").alias("d_ref"), F.max_by("state", F.when(F.col("state").isNotNull(), F.col("at"))).alias("last"), F.max("fetched").alias("fetched"), F.max(F.col("d_ref") > 0).alias("asked"))
        .select(
            "ref_id",
            "bucket",
            "asked",
            F.coalesce(F.sum("d_ref").over(earlier), F.lit(0)).alias("n_ref"),
            F.coalesce(F.last("last", ignorenulls=True).over(earlier), F.lit(0)).alias("n_exist"),
            F.coalesce(F.max("fetched").over(earlier), F.lit(False)).alias("seen"),
            F.max("fetched").over(Window.partitionBy("ref_id")).alias("ever"),
        )
        .where("asked")
        .select("ref_id", "bucket", F.lit(None).cast("timestamp_ntz").alias("at"), F.col("n_ref").alias("d_ref"), F.col("n_exist").cast("int").alias("state"), F.col("seen").alias("fetched"), "ever")
    )
    rows = carried.unionByName(instants.withColumn("ever", F.lit(None).cast("boolean")))
    within = Window.partitionBy("ref_id", "bucket").orderBy(F.asc_nulls_first("at"))  # what earlier buckets left comes first
    so_far, before = within.rowsBetween(Window.unboundedPreceding, Window.currentRow), within.rowsBetween(Window.unboundedPreceding, -1)
    was = F.coalesce(F.last("state", ignorenulls=True).over(before), F.lit(0))
    counted = rows.withColumn("d_exist", F.coalesce(F.col("state") - was, F.lit(0)))
    counted = counted.select(
        "ref_id",
        "at",
        "d_ref",
        F.sum("d_ref").over(so_far).alias("n_ref"),
        F.sum("d_exist").over(so_far).alias("n_exist"),
        F.max("fetched").over(so_far).alias("seen"),
        F.max("ever").over(so_far).alias("ever"),
    ).where("at is not null and d_ref > 0 and n_ref > 0 and n_exist = 0")
    kind = F.when(~F.col("ever"), "missing").when(~F.col("seen"), "late").otherwise("deleted")
    return counted.select("ref_id", "at", "n_ref", kind.alias("kind"))


def orphan_references(refs: DataFrame, records: DataFrame, removals: DataFrame, bucket: str = "hour") -> DataFrame:
    """The orphan ones of `refs` (table_name, row_id, ref_id, ts), each judged at its own time.

    `records` and `removals` are (ref_id, ts). Result: the columns of `refs` with `kind` and
    `period` (yyyy-MM of ts):

    * ``missing``: there is no record of the id at all;
    * ``late``: every record of the id is later than the reference;
    * ``deleted``: the existence count was set to zero after the last record not later than the
      reference, by a removal not later than it either. A removal at the instant of a record
      does not outlast it.

    References with a null id are none and are dropped; a reference with a null time can't be
    ordered and is judged by the final state, with a null period. A record with a null time exists,
    but came at no time: references to it alone are late, but for those without a time. Removals without a time are none.
    Repeated rows stay.

    The counts are kept per key and instant (`orphan_instants`); references get what holds at theirs by an equi-join,
    in which a key and instant has one row on one side, so a hot one can be split on the other.
    """
    refs = refs.where("ref_id is not null").select("table_name", "row_id", "ref_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    orphans = orphan_instants(change_log(refs, records, removals), bucket)
    found = refs.withColumn("at", F.coalesce("ts", F.lit(FINAL).cast("timestamp_ntz"))).join(orphans, ["ref_id", "at"])
    return found.select("table_name", "row_id", "ref_id", "kind", F.date_format("ts", "yyyy-MM").alias("period"))


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphan references per referring table, period and kind."""
    return orphans.groupBy("table_name", "period", "kind").agg(F.count("*").alias("n_refs"), F.countDistinct("ref_id").alias("n_ids"))
