"""Files that the workload derives from its tables."""

import os

import pytest
from pyspark.sql import functions as F

from workload import inputs, stages


@pytest.fixture
def tables(spark, tmp_path):
    """An events table in twelve files, each read by a task of its own."""
    e = F.col("id")
    events = spark.range(240).select(
        e.alias("event_id"),
        F.timestamp_seconds(1704067200 + e * 60).alias("ts"),
        (e % 7).alias("user_id"),
        F.lit("click").alias("event_type"),
        (e * 1.5).alias("value"),
        F.to_json(F.struct((e % 5).alias("k"))).alias("props"),
    )
    events.repartition(12).write.parquet(str(tmp_path / "events.parquet"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    yield str(tmp_path)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_are_written_by_the_tasks_that_read_the_table(spark, tables):
    path = stages.copies_dir(spark, tables)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) >= 24
    assert spark.read.json(path).count() == inputs.clickstream_with_copies(spark, tables).count()
    assert stages._per_batch(spark, path, 3) == -(-len(files) // 3)


def test_a_small_table_makes_several_files(spark, sf_dir):
    path = stages.copies_dir(spark, sf_dir)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) >= 6
