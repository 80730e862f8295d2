"""What the driver and its workers hold while queries run on tables larger than the test tables."""

import threading
import time

import numpy as np
import pandas as pd
import psutil
from pyspark.sql import functions as F

from riskloom.llm import common, cross_polytope


class LargestWorker:
    """MB of the largest Python worker while the block runs."""

    def __enter__(self):
        self.mb, self.on = 0.0, True
        self.watch = threading.Thread(target=self.run, daemon=True)
        self.watch.start()
        return self

    def run(self):
        while self.on:
            for p in psutil.Process().children(recursive=True):
                try:
                    if "pyspark.daemon" in " ".join(p.cmdline()):
                        self.mb = max(self.mb, p.memory_info().rss / 2**20)
                except psutil.Error:
                    pass
            time.sleep(0.02)

    def __exit__(self, *_):
        self.on = False
        self.watch.join()


def vectors(spark, n: int, d: int = 64):
    rng = np.random.default_rng(7)
    return spark.createDataFrame(pd.DataFrame({"vec_id": range(n), "embedding": rng.normal(size=(n, d)).tolist()}))


def test_queries_of_a_large_table_are_not_held_at_once(spark, monkeypatch):
    """Three rotations a table and 4,000 buckets probed, as for a million rows: a query goes to hundreds of groups."""
    monkeypatch.setattr(cross_polytope, "plan", lambda rows, dim, tables, reach: (3, 4000))
    df = vectors(spark, 1000).repartition(1)
    with LargestWorker() as largest:
        got = cross_polytope.nearest(df, F.lit(True), tables=2).toPandas()
    assert len(got) == 5000
    assert largest.mb < 400


def test_turns_and_parts_do_not_change_the_nearest(spark, monkeypatch):
    monkeypatch.setattr(cross_polytope, "plan", lambda rows, dim, tables, reach: (3, 1000))
    df = vectors(spark, 600, 16).unionByName(vectors(spark, 40, 5).withColumn("vec_id", F.col("vec_id") + 1000))
    df = df.withColumn("embedding", F.col("embedding").cast("array<float>")).localCheckpoint()

    def found(**kw):
        return cross_polytope.nearest(df, F.col("vec_id") % 9 == 0, **kw).toPandas().sort_values(["query_id", "rank"]).reset_index(drop=True)

    want = found()
    monkeypatch.setattr(cross_polytope, "PASS_BYTES", 1)  # one table at a time
    monkeypatch.setattr(cross_polytope, "PAIRS", 1)
    pd.testing.assert_frame_equal(found(part=7), want)


def test_the_driver_gives_back_what_jobs_have_left(spark):
    jvm = spark.sparkContext._jvm
    driver = psutil.Process(jvm.java.lang.ProcessHandle.current().pid())

    def mb():
        return driver.memory_info().rss / 2**20

    text, out = (spark.sparkContext._gateway.new_array(jvm.byte, n) for n in (70_000, 100))
    for _ in range(2):
        common.written(spark.range(10), "test-before")
    before = mb()
    native = [jvm.java.util.zip.Deflater() for _ in range(1200)]  # each holds memory outside the heap
    for x in native:
        x.setInput(text)
        x.deflate(out)
    grown = mb() - before
    for i, x in enumerate(native):
        if i % 20:  # what stays keeps the freed memory between it from going back by itself
            x.end()
    common.written(spark.range(10), "test-after")
    assert grown > 100
    assert mb() - before < grown / 2


def test_the_drivers_heap_is_collected_when_it_has_grown():
    class Jvm:
        def __init__(self, total):
            self.total, self.collected = total, 0
            self.java = self.lang = self.Runtime = self.System = self

        def getRuntime(self):
            return self

        def totalMemory(self):
            return self.total

        def maxMemory(self):
            return 100

        def gc(self):
            self.collected += 1

        @property
        def Class(self):
            raise common.Py4JError("no command")

    class Spark:
        def __init__(self, total):
            self.sparkContext, self._jvm = self, Jvm(total)

    for total, times in ((40, 0), (60, 1)):
        common.driver_gives_back(s := Spark(total))
        assert s._jvm.collected == times
