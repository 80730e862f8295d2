"""Folders that micro-batches write, merged from time to time.

A batch writes ``<path>/<part>/batch_id=<n>``, replacing what an earlier run of the same batch left there. ``close``
merges all batches of a part up to one into ``<path>-closed/<part>/upto=<n>``; from then on readers take the closed
folder with the highest number and the batches after it. The change is the appearance of that folder's ``_SUCCESS``
file, so a merge that dies half way changes nothing, and removing the merged folders is mere tidying.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none if there is no folder), in any store that Spark reaches."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class BatchFolders:
    """Rows of ``schema`` (DDL), by part (a value of the column ``part``) and batch."""

    def __init__(self, spark: SparkSession, path: str, schema: str, part: str):
        self.spark, self.path, self.schema, self.part = spark, path.rstrip("/"), schema, part

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Add the rows of ``df`` (with the column ``part``), a folder per part."""
        (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(self.part, "batch_id").parquet(self.path))

    def parts(self) -> list[str]:
        found = names(self.spark, self.path) + names(self.spark, f"{self.path}-closed")
        return sorted({n.partition("=")[2] for n in found if n.startswith(f"{self.part}=")})

    def _closed(self, part: str) -> int:
        """The batch up to which a part is closed; -1: it is not."""
        at = f"{self.path}-closed/{self.part}={part}"
        done = [n for n in names(self.spark, at) if n.startswith("upto=") and "_SUCCESS" in names(self.spark, f"{at}/{n}")]
        return max((int(n.partition("=")[2]) for n in done), default=-1)

    def _batches(self, part: str) -> list[int]:
        return sorted(int(n.partition("=")[2]) for n in names(self.spark, f"{self.path}/{self.part}={part}") if n.startswith("batch_id="))

    def folders(self, part: str) -> list[str]:
        upto = self._closed(part)
        closed = [f"{self.path}-closed/{self.part}={part}/upto={upto}"] if upto >= 0 else []
        return closed + [f"{self.path}/{self.part}={part}/batch_id={b}" for b in self._batches(part) if b > upto]

    def read(self, parts: Sequence[str]) -> DataFrame:
        """Rows of the given parts; no other folder is listed or opened."""
        found = [f for p in parts for f in self.folders(p)]
        return self.spark.read.schema(self.schema).parquet(*found) if found else self.spark.createDataFrame([], self.schema)

    def close(self, part: str, merge=None) -> None:
        """Merge the part's folders into one; ``merge`` maps its rows to fewer rows of the same meaning."""
        batches, upto = self._batches(part), self._closed(part)
        if not [b for b in batches if b > upto] or len(self.folders(part)) < 2:
            return
        rows = self.read([part])
        rows = merge(rows) if merge else rows
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}-closed/{self.part}={part}/upto={batches[-1]}")
        for b in batches:
            remove(self.spark, f"{self.path}/{self.part}={part}/batch_id={b}")
        if upto >= 0:
            remove(self.spark, f"{self.path}-closed/{self.part}={part}/upto={upto}")
