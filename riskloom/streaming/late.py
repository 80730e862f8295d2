"""Streams with late input: labels that arrive after the prediction (J6), rows behind the watermark.

``late_labels`` is a stream-stream outer join. Both sides carry a watermark and the label must lie within a bound
after the prediction, so Spark knows when a prediction can no longer match: it then comes out once, without a label,
and leaves the state.

``split_late`` cuts every micro-batch at the watermark before the batch: rows on time and late rows go to folders of
their own, and one row of counts a batch. The watermark is that of the counts already written, so a batch that is
run again after a failure is cut at the same place, and its files replace those of the first run. Nothing is
dropped: the rows of both folders are the rows of the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

COUNTS = "batch_id long, watermark timestamp, newest timestamp, n_on_time long, n_late long"


def within(pred_ts: Column, label_ts: Column, bound: str) -> Column:
    """A label counts for a prediction from the prediction's time on, up to ``bound`` later."""
    return (label_ts >= pred_ts) & (label_ts <= pred_ts + F.expr(f"INTERVAL {bound}"))


def late_labels(preds: DataFrame, labels: DataFrame, key: str, label: str = "Class", pred_ts: str = "event_time",
                label_ts: str = "label_time", bound: str = "7 days", delay: str = "1 hour") -> DataFrame:
    """Predictions with the label that arrived within ``bound``; null ``label`` and ``label_ts`` if none did. As streams
    (both with an event time of type TIMESTAMP) every prediction comes out once; as tables it is the batch twin.

    Several labels within the bound give a row each, as in any join; a null key or time never matches."""
    found = labels.select(F.col(key).alias("_key"), F.col(label), F.col(label_ts))
    if preds.isStreaming:
        preds, found = preds.withWatermark(pred_ts, delay), found.withWatermark(label_ts, delay)
    cond = (F.col(key) == F.col("_key")) & within(F.col(pred_ts), F.col(label_ts), bound)
    return preds.join(found, cond, "left_outer").drop("_key")


def late_labels_query(preds: DataFrame, labels: DataFrame, key: str, out_path: str, checkpoint: str, trigger: dict | None = None,
                      **kw) -> StreamingQuery:
    """``late_labels`` as a query that appends to the Parquet folder ``out_path`` (each row once, by its checkpoint)."""
    out = late_labels(preds, labels, key, **kw)
    return (out.writeStream.outputMode("append").format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


# ---- rows behind the watermark ------------------------------------------------------------------------------------------

def _before(spark: SparkSession, path: str, batch_id: int) -> dict | None:
    """The newest event time of all batches before ``batch_id``: the counts of the last one carry it on."""
    if batch_id == 0:
        return None
    return spark.read.schema(COUNTS).parquet(f"{path}/counts/batch_id={batch_id - 1}").first()


def split_late(src: DataFrame, path: str, checkpoint: str, ts: str = "event_time", delay: str = "1 hour",
               trigger: dict | None = None) -> StreamingQuery:
    """Write the rows of ``src`` to ``path``/on_time and ``path``/late (a folder per batch) and their counts to
    ``path``/counts. A row is late if its time is before the newest time of the batches before, less ``delay``; a
    row without a time is late."""
    def per_batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        before = _before(spark, path, batch_id)
        newest = before["newest"] if before else None
        mark = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")  # null before the first time is known
        late = F.col(ts).isNull() | F.coalesce(F.col(ts) < mark, F.lit(False))
        df = df.withColumn("_late", late).persist()
        for name, part in (("on_time", df.where("NOT _late")), ("late", df.where("_late"))):
            part.drop("_late").write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
        counts = df.agg(F.count_if(~F.col("_late")).alias("n_on_time"), F.count_if(F.col("_late")).alias("n_late"), F.max(ts).alias("_max"))
        counts = counts.select(F.lit(batch_id).cast("long").alias("batch_id"), mark.alias("watermark"),
                               F.greatest(F.lit(newest).cast("timestamp"), F.col("_max").cast("timestamp")).alias("newest"), "n_on_time", "n_late")
        counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/counts/batch_id={batch_id}")
        df.unpersist()

    return (src.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def late_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts of all batches, however many there were and however often the query was started anew."""
    return spark.read.schema(COUNTS).parquet(f"{path}/counts")


def batch_split_late(df: DataFrame, batch: str, ts: str, delay: str = "1 hour") -> DataFrame:
    """The batch twin of ``split_late``: ``df`` with ``late`` for rows that carry the number of their micro-batch.
    Newest times run over one row per micro-batch."""
    from pyspark.sql import Window

    per = df.groupBy(batch).agg(F.max(ts).alias("_max"))
    before = Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col(batch).alias("_batch"), (F.max("_max").over(before) - F.expr(f"INTERVAL {delay}")).alias("_mark"))
    late = F.col(ts).isNull() | F.coalesce(F.col(ts) < F.col("_mark"), F.lit(False))
    return df.join(per, F.col(batch).eqNullSafe(F.col("_batch"))).withColumn("late", late).drop("_batch", "_mark")


class DroppedRows(StreamingQueryListener):
    """Rows that stateful operators dropped as late, summed per query over its whole run (``recentProgress`` keeps a
    hundred batches only). Register with ``spark.streams.addListener``."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}
        self.batches: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802 - the listener's interface
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.dropped[str(p.id)] = self.dropped.get(str(p.id), 0) + sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
        self.batches[str(p.id)] = self.batches.get(str(p.id), 0) + 1

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
