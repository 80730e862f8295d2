"""The newest n rows per key as list state that dies (T3 on ``transformWithState``).

``applyInPandasWithState`` keeps every key for ever. Here a key's rows are a list in the state store, and a timer in
event time runs out when the key has been silent for ``ttl``: the rows then leave the store, and a key that comes
back later starts anew. Needs the RocksDB state store (``use_rocksdb``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .streams import ROLLING_OUT, _local_newest

ROWS = "ts timestamp, pid string, flag int, prob double"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class NewestRows(StatefulProcessor):
    def __init__(self, n: int, ttl_ms: int):
        self.n, self.ttl_ms = n, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", ROWS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        held = pd.DataFrame(list(self.rows.get()) if self.rows.exists() else [], columns=["ts", "pid", "flag", "prob"])
        for pdf in rows:
            add = pd.DataFrame({"ts": pdf["event_time"], "pid": pdf["prediction_id"], "flag": pdf["is_fraud"].astype("int32"),
                                "prob": pdf["fraud_probability"]})
            held = add if not len(held) else pd.concat([held, add], ignore_index=True)
            held = held.sort_values(["ts", "pid"], ascending=[False, True]).head(self.n)
        self.rows.put([(t.to_pydatetime(), p, int(f), float(x)) for t, p, f, x in zip(pd.to_datetime(held["ts"]), held["pid"], held["flag"], held["prob"], strict=True)])
        newest = pd.to_datetime(held["ts"]).max()
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(int(newest.timestamp() * 1000) + self.ttl_ms)
        yield pd.DataFrame({"model_version": [key[0]], "count": [len(held)], "fraud_rate": [float(held["flag"].mean())],
                            "avg_probability": [float(held["prob"].mean())], "last_ts": [newest]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        self.rows.clear()
        return iter([])

    def close(self) -> None:
        pass


def newest_metrics_stream(src: DataFrame, n: int = 100, key: str = "model_version", ts: str = "event_time", delay: str = "1 hour",
                          ttl_hours: float = 24.0) -> DataFrame:
    """Per key, count / fraud rate / mean probability over its newest ``n`` predictions after every micro-batch that has
    rows of it, as ``streams.rolling_metrics_stream``; a key that is silent for ``ttl_hours`` of event time leaves the
    state. Rows behind the watermark are dropped by Spark."""
    d = src.withWatermark(ts, delay).select(F.col(key).alias("model_version"), "prediction_id", F.col(ts).alias("event_time"), "is_fraud", "fraud_probability")
    d = d.mapInPandas(_local_newest(n), d.schema)
    return d.groupBy("model_version").transformWithStateInPandas(
        NewestRows(n, int(ttl_hours * 3_600_000)), ROLLING_OUT, "update", "eventTime")
