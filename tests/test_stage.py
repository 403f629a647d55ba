"""Written stages leave no shuffle files behind."""

import time

import pytest
from pyspark.sql import functions as F

from stockout.stage import write_stage


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


@pytest.mark.parametrize("bucket_by", [None, ("k",)])
def test_a_stage_frees_what_its_plan_shuffled(spark, bucket_by):
    sums = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n"))
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffle_files(spark), spark.conf.get(setting)
    stage = write_stage(sums, "freed", bucket_by=bucket_by)
    for _ in range(50):  # files are removed in the background
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before
    assert spark.conf.get(setting) == was
    want = sorted((k, sum(range(k, 1000, 7))) for k in range(7))
    assert sorted(map(tuple, stage.collect())) == want
    assert sorted(map(tuple, sums.collect())) == want  # the plan still runs again
