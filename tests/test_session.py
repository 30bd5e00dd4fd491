"""Session helpers."""

import pytest

from lexframe import session


def test_small_and_split_inputs_are_left_alone(spark, tmp_path):
    spark.range(20_000).selectExpr("id", "repeat(sha2(cast(id as string), 512), 2) as t").coalesce(1).write.parquet(str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    cores = spark.sparkContext.defaultParallelism
    assert session.spread_out(one, "id", least=1).rdd.getNumPartitions() == cores
    assert session.spread_out(one, "id", least=1 << 40) is one
    one.repartition(cores).write.parquet(str(tmp_path / "many"))
    many = spark.read.option("maxPartitionBytes", "1").parquet(str(tmp_path / "many"))
    if many.rdd.getNumPartitions() >= cores:
        assert session.spread_out(many, "id", least=1) is many
    plan = session.spread_out(one, "id", least=1).where("id = 3").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,3)]" in plan and "ReadSchema: struct<id:bigint>" in plan


def test_checkpoints_are_written_to_the_folder_of_the_context(spark):
    df = session.checkpointed(spark.range(5))
    assert df.count() == 5 and spark.sparkContext.getCheckpointDir()


def test_a_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    class Frame:
        sparkSession = Session()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpointed(Frame())
