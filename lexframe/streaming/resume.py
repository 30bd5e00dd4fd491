"""Incremental runs: new files are read once, and each batch is merged into a table by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm.org.apache.hadoop.fs.Path(path))


class KeyedTable:
    """A table with one row for each key, in parquet, kept in versions of buckets of keys.

    A merge rewrites only the buckets that its rows fall into, as parts of the next version, and then writes the mark
    that makes them current, so a run that ends in between, or a batch that comes again, leaves the table as it
    was. Parts that a later version replaces are removed once `kept` more versions are there, for readers that still
    use them. Rows win by the greatest `order`. `buckets` must stay the same for a table.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str, order: str, buckets: int = 64, kept: int = 2):
        self.spark, self.folder, self.key, self.order, self.buckets, self.kept = spark, folder, key, order, buckets, kept

    def _marks(self) -> list[tuple[int, list[int]]]:
        """(version, its buckets), ascending."""
        marks = f"{self.folder}/_current"
        rows = self.spark.read.schema("version int, buckets array<int>").json(marks).distinct().collect() if _exists(self.spark, marks) else []
        return sorted((r.version, list(r.buckets)) for r in rows)

    def _part(self, version: int, bucket: int) -> str:
        return f"{self.folder}/v{version}/_bucket={bucket}"

    def _read(self, buckets: list[int] | None = None) -> DataFrame | None:
        current = {b: v for v, own in self._marks() for b in own if buckets is None or b in buckets}
        if not current:
            return None
        return self.spark.read.option("mergeSchema", "true").parquet(*(self._part(v, b) for b, v in sorted(current.items())))

    def read(self) -> DataFrame | None:
        return self._read()

    def merge(self, rows: DataFrame, batch: int) -> None:
        """The table with `rows` merged in; a batch that is already part of it changes nothing."""
        marks = self._marks()
        version = batch + 1
        if marks and version <= marks[-1][0]:
            return
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        rows = rows.where(F.col(self.key).isNotNull())
        touched = sorted(r[0] for r in rows.select(bucket).distinct().collect())  # at most `buckets` rows
        old = self._read(touched) if touched else None
        every = rows if old is None else old.unionByName(rows, allowMissingColumns=True)
        rest = [c for c in every.columns if c != self.key]
        merged = every.groupBy(self.key).agg(F.max_by(F.struct(*rest), F.struct(self.order, F.xxhash64(*rest))).alias("_r")).select(self.key, "_r.*")
        if touched:
            merged.withColumn("_bucket", bucket).write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.folder}/v{version}")
        self.spark.createDataFrame([(version, touched)], "version int, buckets array<int>").coalesce(1).write.mode("append").json(f"{self.folder}/_current")
        self._clear([*marks, (version, touched)])

    def _clear(self, marks: list[tuple[int, list[int]]]) -> None:
        """Removes parts that one of the versions before the last `kept` ones replaced."""
        jvm = self.spark.sparkContext._jvm
        settled = marks[: -self.kept] if self.kept else marks
        newest = {b: v for v, own in settled for b in own}
        for version, own in settled:
            for b in own:
                if newest[b] > version:
                    path = jvm.org.apache.hadoop.fs.Path(self._part(version, b))
                    path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ingest_listing(spark: SparkSession, source: str, schema: str, target: KeyedTable, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Reads the JSON-lines files that came since the last run into `target`; returns the number of rows read.

    The stream's checkpoint knows which files were read. Lines that can't be parsed come with a null key and are
    left out by the merge.
    """
    lines = spark.readStream.schema(schema).option("mode", "PERMISSIVE").json(source)
    read = [0]

    def put(batch: DataFrame, number: int) -> None:
        rows = transform(batch) if transform else batch
        rows = rows.persist()
        read[0] += rows.count()
        target.merge(rows, number)
        rows.unpersist()

    query = lines.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return read[0]


def orphan_counts_stream(spark: SparkSession, source: str, target: KeyedTable, checkpoint: str) -> None:
    """Signed counts per id from files of changes (ref_id, change, ts), kept in `target` (ref_id, n_ref, n_exist, exist_at, batch).

    change: reference, withdrawn, record or removal; see `operators.references`. Each batch is counted against what the
    table holds, and only the rows of the ids that it names are merged in.
    """
    from ..operators import references

    changes = spark.readStream.schema("ref_id string, change string, ts timestamp_ntz").json(source)

    def put(batch: DataFrame, number: int) -> None:
        old = target.read()
        batch = batch.where("ref_id is not null and ts is not null")
        kept = None if old is None else old.select("ref_id", "n_ref", "n_exist", "exist_at").join(batch.select("ref_id").distinct(), "ref_id", "left_semi")
        deltas = references.count_deltas(batch, kept)
        rows = deltas.select("ref_id", F.col("d_ref").alias("n_ref"), F.col("d_exist").alias("n_exist"), "exist_at")
        if kept is not None:
            rows = rows.unionByName(kept)
        rows = rows.groupBy("ref_id").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_exist").alias("n_exist"), F.max("exist_at").alias("exist_at"))
        target.merge(rows.withColumn("batch", F.lit(number)), number)

    changes.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
