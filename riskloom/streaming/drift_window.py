"""The scheduled drift check on counts that are kept by day.

The current sample is the newest n rows of the log. Their tests need only how often each column has each value, and
such counts add up: every micro-batch is counted once, by day, and a check sums the counts of the days that lie
in the window as a whole. Only the day that the window's edge cuts is read row by row, for the rows it still lacks. As the
window moves, days enter and leave the sum; no row of a whole day is read or unpivoted again, and the reference sample
is counted once, before the first check. Days before the window's are closed: their folders are merged into one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import drift as dr
from ..operators.common import materialize
from ..plans import monitor
from ..sources.batches import BatchFolders

COUNTS = "column_name string, value double, _w long"
NO_DAY = "0000-00-00"  # rows without a time are older than all others


def day_of(ts: str) -> Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit(NO_DAY))


def value_counts(df: DataFrame, columns: Sequence[str], by: Sequence[Column] = ()) -> DataFrame:
    """column_name, value, _w (rows) per value of each of ``columns``, over the rows that have them all."""
    names = [f"_by{i}" for i in range(len(by))]
    d = dr.complete_rows(df, columns).select(*[b.alias(n) for b, n in zip(by, names, strict=True)],
                                           *[F.col(c).cast("double").alias(c) for c in columns])
    long = d.unpivot(names, list(columns), "column_name", "value")
    return long.groupBy(*names, "column_name", "value").agg(F.count(F.lit(1)).alias("_w"))


class DriftWindow:
    """The log, its counts by day and its days' sizes under ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, columns: Sequence[str], ts: str = "timestamp", key: str = "prediction_id"):
        self.spark, self.columns, self.ts, self.key = spark, list(columns), ts, key
        self.log = BatchFolders(spark, f"{path}/log", schema, "day")
        self.counts = BatchFolders(spark, f"{path}/counts", COUNTS, "day")
        self.sizes = BatchFolders(spark, f"{path}/sizes", "day string, n long", "kind")

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Log a micro-batch and its counts; a batch that is run again replaces what its first run wrote."""
        batch = batch.withColumn("day", day_of(self.ts)).persist()
        self.log.write(batch, batch_id)
        self.counts.write(value_counts(batch, self.columns, [F.col("day")]).withColumnRenamed("_by0", "day"), batch_id)
        n = batch.groupBy("day").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("rows"))
        self.sizes.write(n.coalesce(1), batch_id)
        batch.unpersist()

    def window(self, n: int) -> tuple[list[str], str | None, int]:
        """The days that the newest ``n`` rows take as a whole, the day they take a part of, and how many rows of it."""
        per_day = self.sizes.read(["rows"]).groupBy("day").agg(F.sum("n").alias("n")).orderBy(F.desc("day")).collect()  # a row per day
        whole, left = [], n
        for r in per_day:
            if left <= 0:
                break
            if r["n"] > left:
                return whole, r["day"], left
            whole.append(r["day"])
            left -= r["n"]
        return whole, None, 0

    def newest_counts(self, n: int) -> DataFrame:
        """column_name, value, _w of the newest ``n`` rows."""
        whole, cut, k = self.window(n)
        parts = self.counts.read(whole)
        if cut is not None:
            parts = parts.unionByName(value_counts(monitor.newest(self.log.read([cut]), k, self.ts, self.key), self.columns))
        return parts.groupBy("column_name", "value").agg(F.sum("_w").alias("_w"))

    def close_days(self, n: int) -> None:
        """Merge the folders of all days before the newest day of the window (counts are added up)."""
        whole, cut, _ = self.window(n)
        newest = max([*whole, *([cut] if cut else [])], default=NO_DAY)
        for day in self.log.parts():
            if day < newest:
                self.log.close(day)
                self.counts.close(day, lambda d: d.groupBy("column_name", "value").agg(F.sum("_w").alias("_w")))
        self.sizes.close("rows", lambda d: d.groupBy("day").agg(F.sum("n").alias("n")))


def window_check_query(src: DataFrame, ref: DataFrame, columns: Sequence[str], path: str, n_recent: int, report_path: str, trigger_path: str,
                       checkpoint: str, trigger: dict | None = None, ts: str = "timestamp", key: str = "prediction_id",
                       close_every: int = 16) -> StreamingQuery:
    """Every micro-batch is logged and counted, then the newest ``n_recent`` rows are tested against ``ref`` by
    their counts. Every ``close_every`` batches the folders of past days are merged."""
    spark = ref.sparkSession
    ref_counts = materialize(value_counts(ref, columns).withColumn("sample", F.lit("ref")))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields)

    def per_batch(df: DataFrame, batch_id: int) -> None:
        window = DriftWindow(spark, path, fields, columns, ts, key)
        window.add(df, batch_id)
        newest = df.agg(F.max(ts)).first()[0]
        as_of = F.lit(newest).cast("timestamp") if newest is not None else F.current_timestamp()
        counts = ref_counts.unionByName(window.newest_counts(n_recent).withColumn("sample", F.lit("cur")))
        monitor.recorded(spark, lambda: monitor.drift_check_counts(counts, columns, exact_ks=True), report_path, trigger_path, as_of)
        if batch_id % close_every == close_every - 1:
            window.close_days(n_recent)

    return (src.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
