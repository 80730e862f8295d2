"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Words are maximal runs of anything but blank, tab, newline, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of every job are removed as soon as the job has ended, instead of when the driver
    next happens to collect its garbage: for jobs whose result is stored, so that nothing reads these files again. At
    the end the driver gives back the memory that it took to plan and run them."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, own)
        driver_gives_back(spark)


def written(df: DataFrame, what: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet into the shared folder of ``spark.checkpoint.dir`` and
    read it back. Unlike a checkpoint the copy is columnar and compressed; a lost executor re-reads it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(docs: DataFrame, most: int = 4 << 20) -> DataFrame:
    """``docs``, whose whole texts go to Python: lowers the session's limit on the bytes of an Arrow batch to
    ``most`` (a smaller limit stays), so that neither the send buffers of an executor nor its Python workers hold
    ten thousand long texts at a time. A longer text is a batch of its own."""
    conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    own = conf.get(name).rstrip("b")  # "67108864b", unless the session has set it in other units
    if not own.isdigit() or not 0 < int(own) <= most:
        conf.set(name, str(most))
    return docs


def give_back() -> None:
    """Return the memory that this Python worker has freed to the system: workers wait for their next task, and what
    they keep counts as the executor's while JVM stages run."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def driver_gives_back(spark: SparkSession) -> None:
    """The same for the driver, over a long row of jobs: planning, compiling and event logs leave freed memory with the
    JVM's allocator, which keeps it, and a heap that has once grown shrinks only in a full collection (done when the heap
    takes more than half of what it may)."""
    give_back()
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the driver is another process
        return
    jvm = sc._jvm
    runtime = jvm.java.lang.Runtime.getRuntime()
    if 2 * runtime.totalMemory() > runtime.maxMemory():
        jvm.java.lang.System.gc()
    try:  # malloc_trim, by the JVM's own diagnostic command; its class is not open to py4j, so by reflection
        call = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServerConnection").getMethods() if m.getName() == "invoke")
        args = sc._gateway.new_array(jvm.java.lang.Object, 4)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        call.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:  # other JVMs, and those before 17.0.9, have no such command
        pass


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` also folds other scripts)."""
    return F.translate(c, UPPER, LOWER)


def n_words(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_order(*cols: str, seed: int = 0) -> Column:
    """A repeatable pseudo-random long per row that depends on the values only, not on the partitioning."""
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in cols])
