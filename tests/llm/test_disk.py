"""What jobs leave on the executors' disks while a query goes on."""

import os
import time

from pyspark.sql import functions as F

from riskloom.llm.common import written
from riskloom.llm.components import components


def shuffle_files(spark) -> set[str]:
    top = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {x for folder in top for _, _, names in os.walk(folder) for x in names if x.startswith("shuffle_")}


def new_files(spark, before: set[str]) -> set[str]:
    for _ in range(50):  # files go in the background
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_a_written_frame_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    held = written(df, "test-held")
    assert new_files(spark, before) == set()
    assert {tuple(r) for r in held.collect()} == {tuple(r) for r in df.collect()}  # the frame itself can be run again
    assert spark.conf.get(CLEANUP, "false") == "false"


def test_rounds_of_components_leave_few_tasks_and_no_shuffle_files(spark):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    own = {n: spark.conf.get(n) for n in names}
    try:
        spark.conf.set(names[0], "60")
        spark.conf.set(names[1], "false")
        chain = [(i, i + 1) for i in range(100, 140)] + [(1000, i) for i in range(1001, 1100)] + [(7, 7), (5, 3), (3, 5)]
        edges = written(spark.createDataFrame(chain, "a long, b long"), "test-edges")
        before = shuffle_files(spark)
        found = components(edges)
        assert new_files(spark, before) == set()
        assert found.rdd.getNumPartitions() == 1  # not one for each of the session's shuffle partitions
        want = {i: 100 for i in range(100, 141)} | {i: 1000 for i in range(1000, 1100)} | {3: 3, 5: 3}
        assert dict(map(tuple, found.collect())) == want
    finally:
        for n, v in own.items():
            spark.conf.set(n, v)
    assert components(edges.where("false")).count() == 0
