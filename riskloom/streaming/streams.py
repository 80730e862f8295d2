"""Structured Streaming forms of scoring, logging, rollups and the drift check.

Event time must be TIMESTAMP (not TIMESTAMP_NTZ) for a watermark; sources
cast it. Every query takes a checkpoint location, so a restarted query (or a
lost executor) resumes from the last committed batch.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import validate as va
from ..operators import features as fe
from ..operators import models as mo
from ..plans import monitor
from ..sources.idlog import IdLog
from ..sources.versions import ModelVersions


def event_time(df: DataFrame, col: str = "ts", out: str = "event_time") -> DataFrame:
    """Cast an NTZ event time to TIMESTAMP (session time zone UTC) for watermarks."""
    return df.withColumn(out, F.col(col).cast("timestamp"))


def scoring_query(src: DataFrame, model, stats: DataFrame, rules, out_path: str, quarantine_path: str,
                  checkpoint: str, threshold: float = 0.5, key: Sequence[str] = ("tx_id",),
                  trigger: dict | None = None, model_version: str = "stream") -> StreamingQuery:
    """T1 + T2: validate -> v2 features with stored stats -> score -> threshold -> id + time -> log.

    Each micro-batch overwrites its own ``batch_id`` folder, so a replayed batch does not duplicate rows.
    Rejected rows go to the quarantine folder with their errors.
    """
    stats_row = stats  # small fitted-stats table (one row per feature)

    def per_batch(df: DataFrame, batch_id: int) -> None:
        # the batch feeds two writes (log and quarantine): read the source once
        tagged = va.tag_errors(df, rules).persist()
        ok = tagged.where(F.size("errors") == 0).drop("errors")
        bad = tagged.where(F.size("errors") > 0)
        feats = fe.features_v2(ok, stats_row, drop=())
        scored = mo.score(model, feats, threshold, keep=[*key, "Amount", "event_time"])
        log = scored.select(
            F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in key]), 256).alias("prediction_id"),
            F.col("event_time").cast("timestamp_ntz").alias("timestamp"), F.col("Amount").alias("amount"),
            "fraud_probability", "is_fraud", F.lit(model_version).alias("model_version"))
        log.write.mode("overwrite").parquet(os.path.join(out_path, f"batch_id={batch_id}"))
        bad.write.mode("overwrite").parquet(os.path.join(quarantine_path, f"batch_id={batch_id}"))
        tagged.unpersist()

    w = src.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def served_scoring_query(src: DataFrame, versions: ModelVersions, name: str, rules, out_path: str, quarantine_path: str,
                         checkpoint: str, threshold: float = 0.5, key: Sequence[str] = ("tx_id",), stage: str = "Production",
                         trigger: dict | None = None) -> StreamingQuery:
    """T1 with the version served at the time: every micro-batch asks the registry for the version of ``name`` at ``stage``
    (M11), so a promotion takes effect with the next batch, without a restart. A version is loaded once. Features are
    made with the version's own statistics and checked against its own signature. Nothing at the stage ends the
    query with ``RegistryError``; the batch is not committed and runs when a version is there again."""
    def per_batch(df: DataFrame, batch_id: int) -> None:
        served = versions.serving(name, stage)
        tagged = va.tag_errors(df, rules).persist()
        ok = tagged.where(F.size("errors") == 0).drop("errors")
        feats = ok if served.stats is None else fe.features_v2(ok, served.stats, drop=())
        va.check_signature(feats, list(served.signature))
        scored = mo.score(served.model, feats, threshold, keep=[*key, "Amount", "event_time"])
        log = scored.select(
            F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in key]), 256).alias("prediction_id"),
            F.col("event_time").cast("timestamp_ntz").alias("timestamp"), F.col("Amount").alias("amount"),
            "fraud_probability", "is_fraud", F.lit(served.version).alias("model_version"))
        log.write.mode("overwrite").parquet(os.path.join(out_path, f"batch_id={batch_id}"))
        tagged.where(F.size("errors") > 0).write.mode("overwrite").parquet(os.path.join(quarantine_path, f"batch_id={batch_id}"))
        tagged.unpersist()

    return (src.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def idempotent_log_query(src: DataFrame, log: IdLog, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """T5 over the full history: every micro-batch adds the ids that the log has never seen (see ``sources.idlog``), however
    long ago the first of them came. A batch that runs again adds nothing."""
    def per_batch(df: DataFrame, batch_id: int) -> None:
        log.append(df, batch_id)

    return (src.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def rollup_stream(src: DataFrame, ts: str = "event_time", every: str = "1 day", slide: str | None = None,
                  watermark: str = "1 hour") -> DataFrame:
    """T4: count, fraud rate, mean probability per tumbling (or sliding) event-time window, closed by a watermark."""
    win = F.window(ts, every, slide) if slide else F.window(ts, every)
    return (src.withWatermark(ts, watermark).groupBy(win.alias("w"))
            .agg(F.count(F.lit(1)).alias("count"), F.avg(F.col("is_fraud").cast("int")).alias("fraud_rate"),
                 F.avg("fraud_probability").alias("avg_probability"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "count", "fraud_rate", "avg_probability"))


def session_stream(src: DataFrame, key: str, ts: str = "event_time", gap: str = "30 minutes",
                   watermark: str = "1 hour") -> DataFrame:
    """T4 session form: activity sessions per key that close after ``gap`` of silence."""
    return (src.withWatermark(ts, watermark).groupBy(key, F.session_window(ts, gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("count"), F.avg("fraud_probability").alias("avg_probability"))
            .select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    "count", "avg_probability"))


def dedupe_stream(src: DataFrame, key: str = "prediction_id", ts: str = "event_time",
                  watermark: str = "1 hour") -> DataFrame:
    """T5: idempotent ingest — the first row per id within the watermark is kept."""
    return src.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key])


ROLLING_OUT = T.StructType([
    T.StructField("model_version", T.StringType()), T.StructField("count", T.LongType()),
    T.StructField("fraud_rate", T.DoubleType()), T.StructField("avg_probability", T.DoubleType()),
    T.StructField("last_ts", T.TimestampType()),
])
ROLLING_STATE = T.StructType([
    T.StructField("ts", T.ArrayType(T.TimestampType())), T.StructField("pid", T.ArrayType(T.StringType())),
    T.StructField("flag", T.ArrayType(T.IntegerType())), T.StructField("prob", T.ArrayType(T.DoubleType())),
])


def _rolling_fn(n: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            ts, pid, flag, prob = state.get
            buf = pd.DataFrame({"ts": list(ts), "pid": list(pid), "flag": list(flag), "prob": list(prob)})
        else:
            buf = pd.DataFrame({"ts": [], "pid": [], "flag": [], "prob": []})
        for pdf in pdfs:
            add = pd.DataFrame({"ts": pdf["event_time"], "pid": pdf["prediction_id"],
                                "flag": pdf["is_fraud"].astype("int64"), "prob": pdf["fraud_probability"]})
            # newest n by (time desc, id asc), after every Arrow batch: neither the task nor the state holds
            # more than n rows per key besides the batch at hand
            buf = pd.concat([buf, add], ignore_index=True).sort_values(["ts", "pid"], ascending=[False, True]).head(n)
        state.update((buf["ts"].tolist(), buf["pid"].tolist(), [int(x) for x in buf["flag"]],
                      [float(x) for x in buf["prob"]]))
        yield pd.DataFrame({"model_version": [key[0]], "count": [len(buf)],
                            "fraud_rate": [float(buf["flag"].mean()) if len(buf) else None],
                            "avg_probability": [float(buf["prob"].mean()) if len(buf) else None],
                            "last_ts": [buf["ts"].max() if len(buf) else None]})
    return fn


def _local_newest(n: int):
    """Per input partition, keep only the newest n rows of every key (older rows can never be in a
    key's newest n), so a hot key sends at most partitions x n rows to its state task per batch. The rows
    held are trimmed after every Arrow batch: n per key, whatever the partition's size."""
    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            pdf = pdf.sort_values(["event_time", "prediction_id"], ascending=[False, True])
            held = pdf.groupby("model_version", sort=False, dropna=False).head(n)
        if held is not None and len(held):
            yield held
    return fn


def rolling_metrics_stream(src: DataFrame, n: int = 100, key: str = "model_version") -> DataFrame:
    """Per key, count / fraud rate / mean probability over its newest n predictions, kept as bounded
    state (n rows per key) by applyInPandasWithState; each partition first drops rows that cannot be in
    a key's newest n."""
    d = src.select(F.col(key).alias("model_version"), "prediction_id", "event_time", "is_fraud", "fraud_probability")
    d = d.mapInPandas(_local_newest(n), d.schema)
    return d.groupBy("model_version").applyInPandasWithState(
        _rolling_fn(n), ROLLING_OUT, ROLLING_STATE, "update", GroupStateTimeout.NoTimeout)


def scan_bound(batch: DataFrame, log: DataFrame, n: int, ts: str = "timestamp", hours: int = 1) -> Column | None:
    """A literal event time at or after which ``log`` holds at least ``n`` rows, so that its newest n need no
    older row: the batch's newest time less a span that widens sixteen-fold until it holds n rows (every look
    is a filtered scan that stops at n rows). None when no span up to a century does, or without event times."""
    kind = log.schema[ts].dataType
    while hours < 24 * 366 * 120:
        at = batch.agg((F.max(ts) - F.make_dt_interval(hours=F.lit(hours))).cast("string").alias("at")).first()["at"]  # one row
        if at is None:
            return None
        bound = F.lit(at).cast(kind)
        if log.where(F.col(ts) >= bound).limit(n).count() >= n:
            return bound
        hours *= 16
    return None


def drift_check_query(src: DataFrame, ref: DataFrame, numeric: Sequence[str], log_path: str, n_recent: int,
                      report_path: str, trigger_path: str, checkpoint: str,
                      trigger: dict | None = None, ts_col: str = "timestamp") -> StreamingQuery:
    """Each micro-batch appends to the log, then runs the drift check on the newest n of the log. The log
    is read from ``scan_bound`` on, so a check reads recent row groups and not the whole log."""
    def per_batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()  # written to the log and read for its newest event time
        df.write.mode("overwrite").parquet(os.path.join(log_path, f"batch_id={batch_id}"))
        spark = df.sparkSession
        log = spark.read.parquet(log_path)
        # the check is stamped with the batch's newest event time, so a replayed batch rewrites the
        # same report and trigger partitions instead of adding new ones
        newest_ts = df.agg(F.max(ts_col)).collect()[0][0] if ts_col in df.columns else None
        as_of = F.lit(newest_ts).cast("timestamp") if newest_ts is not None else None
        since = scan_bound(df, log, n_recent, ts_col) if newest_ts is not None else None
        df.unpersist()
        monitor.run_monitor(spark, ref, log, numeric, n_recent, report_path, trigger_path, as_of=as_of, since=since,
                            ts=ts_col).collect()

    w = src.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows the stateful operators dropped as late, summed over the query's recent progress (the last hundred
    batches; ``late.DroppedRows`` sums them all, ``late.split_late`` keeps the rows themselves).

    Spark counts after partial aggregation, so for a windowed aggregate this is
    the number of late (window, input partition) groups, not of input rows.
    """
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else []:
            total += int(op.get("numRowsDroppedByWatermark", 0))
    return total


def file_source(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1) -> DataFrame:
    """A Parquet folder as a stream, in file-time order, one file per micro-batch by default."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path))
