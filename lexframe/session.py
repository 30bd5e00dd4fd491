"""Session helpers shared by all operators."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster the session is the caller's."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lexframe")
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.adaptive.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return importable(spark)


def importable(spark: SparkSession) -> SparkSession:
    """The session, whose Python workers find this package where the driver found it.

    Workers import the package that a function comes from, but only know their own path. On machines where the package
    lies elsewhere it has to be installed or sent with the job, as usual.
    """
    root = str(Path(__file__).resolve().parent.parent)
    known = spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str, spread: str | None = None) -> DataFrame:
    """A supplied table: one parquet file, or a folder of them; see `spread_out` for `spread`."""
    df = importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return df if spread is None else spread_out(df, spread)


def spread_out(scan: DataFrame, key: str, least: int = 2 << 20) -> DataFrame:
    """A scan for work that takes long on each row: where its files make fewer tasks than there are cores, rows are dealt out by `key`.

    A collection of many files, or one below `least` bytes, is left as it is, so at scale nothing is shuffled. Filters and
    the choice of columns still reach the scan.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    size = int(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size < least or scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, key)


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` written once to the shared checkpoint folder, with its lineage cut.

    The folder is the one named by ``spark.checkpoint.dir``. Only where that is unset, as in
    local tests, a temporary folder is used; a cluster without a shared folder is refused,
    because files on one machine are lost with it.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix=f"lexframe-{os.getpid()}-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
