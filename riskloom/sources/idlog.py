"""A prediction log that grows for ever and takes every id once (S6, J4, T5 over the full history).

Rows lie in ``data/segment=<batch>/bucket=<n>``: a segment is what one batch added, a bucket holds the ids of one
hash class. Beside every such file lies a Bloom filter of its ids. A batch is checked against the log in three steps:

1. Its ids meet the filters of their buckets, which tells the (segment, bucket) pairs that may hold one of them.
   A filter takes about ``BITS_PER_ID`` bits an id, so this reads a small part of what the log holds.
2. Only these pairs are read, by a filter on the partition columns (``PartitionFilters`` of the scan), one column of
   them, and an anti join takes the known ids out. An id that the filters let through by mistake (about one of a
   hundred) costs a file, not a row.
3. New rows become the batch's segment, and a commit adds it to the list of live segments.

A batch has a number. One that is sent again after its commit adds nothing, neither to the log nor to the
quarantine (whose folder is the batch's own and is overwritten); one whose first run died before its commit is
written anew over what it left. Two writers cannot commit on the same state (``StaleWriterError``).

``compact`` merges segments into one, so the number of files stays bounded; ``vacuum`` removes segments no longer live.

Defined cases: rows that break a NOT NULL field go to the quarantine; of equal ids within a batch the first arrival
wins (ties: the smallest hash of the row); an empty batch commits an empty segment.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.common import materialize
from .logs import PREDICTION_LOG, accepted_rows, conform, not_null_violations
from .snapshots import SnapshotTable

BITS_PER_ID, PROBES = 10, 7
SEGMENTS = "segment string, buckets int, rows long"
BLOOMS = "segment string, bucket int, rows long, bits binary"
#: Two hashes of an id; the probed bits are first + i * second.
_HASHES = ("_h1", "_h2")


def _hashes(key: str) -> list[Column]:
    return [F.xxhash64(F.lit(s), F.col(key)).alias(h) for s, h in enumerate(_HASHES)]


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(7), F.col(key)), F.lit(buckets)).cast("int")


def _probed(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each id, one row of ``PROBES`` an id."""
    first, second = first.astype(np.int64).view(np.uint64), second.astype(np.int64).view(np.uint64) | np.uint64(1)
    return (first[:, None] + np.arange(PROBES, dtype=np.uint64) * second[:, None]) % np.uint64(bits)


def bloom(first: np.ndarray, second: np.ndarray) -> bytes:
    """Bloom filter of the ids with these hashes."""
    bits = max(64, -(-len(first) * BITS_PER_ID // 8) * 8)
    on = np.zeros(bits, dtype=bool)
    on[_probed(first, second, bits).ravel().astype(np.int64)] = True
    return np.packbits(on, bitorder="little").tobytes()


def may_hold(filter_: bytes, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """For each id: may it be among those the filter was made of."""
    raw = np.frombuffer(filter_, dtype=np.uint8)
    at = _probed(first, second, 8 * len(raw)).astype(np.int64)
    return ((raw[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


class IdLog:
    """The log under ``path``. ``buckets`` counts for a new log; an old one keeps its own."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = PREDICTION_LOG, key: str = "prediction_id",
                 arrival: str = "timestamp", buckets: int = 64):
        self.spark, self.path, self.schema, self.key, self.arrival = spark, path.rstrip("/"), schema, key, arrival
        self.segments = SnapshotTable(spark, f"{self.path}/segments")
        live = self._live()
        self.buckets = live[0]["buckets"] if live else buckets

    def _live(self) -> list:
        """Live segments (one row per segment: bounded by ``compact``)."""
        v = self.segments.version()
        return self.segments.read(v).orderBy("segment").collect() if v else []

    # ---- reading ----------------------------------------------------------------------------------------------------

    def _data(self, names: Sequence[str]) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField("segment", T.StringType()), T.StructField("bucket", T.IntegerType())])
        if not names:
            return self.spark.createDataFrame([], stored)
        return (self.spark.read.schema(stored).option("basePath", f"{self.path}/data")
                .parquet(*[f"{self.path}/data/segment={n}" for n in names]))

    def read(self) -> DataFrame:
        """All rows of the log, with the ``segment`` that added them."""
        return self._data([r["segment"] for r in self._live() if r["rows"]]).drop("bucket")

    def blooms(self) -> DataFrame:
        names = [r["segment"] for r in self._live() if r["rows"]]
        if not names:
            return self.spark.createDataFrame([], BLOOMS)
        reader = self.spark.read.schema(BLOOMS).option("basePath", f"{self.path}/blooms")
        return reader.parquet(*[f"{self.path}/blooms/segment={n}" for n in names])

    def candidates(self, ids: DataFrame) -> list[tuple[str, int]]:
        """(segment, bucket) pairs that may hold one of ``ids`` (column ``key``), by the filters of their buckets."""
        asked = ids.select(bucket_of(self.key, self.buckets).alias("bucket"), *_hashes(self.key))
        asked = asked.groupBy("bucket").agg(*[F.collect_list(h).alias(h) for h in _HASHES])  # a bucket's share of the batch

        def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:  # a filter and the ids of its bucket per row
                hit = [may_hold(f, np.asarray(a), np.asarray(b)).any() for f, a, b in zip(pdf["bits"], *(pdf[h] for h in _HASHES), strict=True)]
                yield pdf.loc[np.array(hit, dtype=bool), ["segment", "bucket"]]

        found = self.blooms().join(asked, "bucket").select("segment", "bucket", "bits", *_HASHES)
        found = found.mapInPandas(probe, "segment string, bucket int")
        return sorted((r["segment"], r["bucket"]) for r in found.collect())  # one row per file at most

    def pairs(self, pairs: Sequence[tuple[str, int]]) -> DataFrame:
        """Rows of the given (segment, bucket) pairs only: the filter is on partition columns, so other files stay unread."""
        by_segment: dict[str, list[int]] = {}
        for s, b in pairs:
            by_segment.setdefault(s, []).append(b)
        if not by_segment:
            return self._data([])
        wanted = reduce(or_, [(F.col("segment") == s) & F.col("bucket").isin(bs) for s, bs in by_segment.items()])
        return self._data(list(by_segment)).where(wanted)

    # ---- writing ----------------------------------------------------------------------------------------------------

    def append(self, batch: DataFrame, batch_id: int | str) -> int:
        """Add the rows of ``batch`` whose id is new; returns their number (that of the first run, if it is a replay)."""
        version, live = self.segments.version(), self._live()
        name = f"{batch_id:012d}" if isinstance(batch_id, int) else batch_id
        done = {r["segment"]: r["rows"] for r in live} | self._merged()
        if name in done:
            return done[name]
        rows = materialize(conform(batch, self.schema))
        not_null_violations(rows, self.schema).write.mode("overwrite").parquet(f"{self.path}/quarantine/segment={name}")
        order = Window.partitionBy(self.key).orderBy(F.asc(self.arrival), F.xxhash64(*[c for c in rows.columns]))
        first = accepted_rows(rows, self.schema).withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")
        known = self.pairs(self.candidates(first)).select(self.key) if live else None
        fresh = first if known is None else first.join(known, self.key, "left_anti")
        n = self._write(fresh, name)
        self._commit([(r["segment"], r["buckets"], r["rows"]) for r in live] + [(name, self.buckets, n)], version)
        return n

    def _write(self, rows: DataFrame, name: str) -> int:
        """One file per bucket, then its filters, read off the written ids."""
        put = rows.withColumn("bucket", bucket_of(self.key, self.buckets)).repartition("bucket")
        put.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/segment={name}")

        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "rows": [len(pdf)], "bits": [bloom(*(pdf[c].to_numpy() for c in _HASHES))]})

        stored = self._data([name]).select("bucket", *_hashes(self.key))
        filters = stored.groupBy("bucket").applyInPandas(build, "bucket int, rows long, bits binary")
        filters.write.mode("overwrite").parquet(f"{self.path}/blooms/segment={name}")
        made = self.spark.read.schema("rows long").parquet(f"{self.path}/blooms/segment={name}")
        return made.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    def _commit(self, live: list[tuple], expected: int) -> None:
        self.segments.commit(self.spark.createDataFrame(live, SEGMENTS).coalesce(1), expected)

    # ---- upkeep -----------------------------------------------------------------------------------------------------

    def _merged(self) -> dict[str, int]:
        """Batches whose segment was merged into another, with their rows: a replay of them adds nothing either."""
        merged = SnapshotTable(self.spark, f"{self.path}/merged")
        v = merged.version()
        return {r["segment"]: r["rows"] for r in merged.read(v).collect()} if v else {}

    def compact(self, keep: int = 8) -> int:
        """Merge all live segments but the newest ``keep`` into one; returns the number merged. Batches are added in
        the order of their names, so the newest are the last. ``bits`` of the new filters are as few an id as before."""
        version, live = self.segments.version(), self._live()
        old = live[:max(0, len(live) - keep)]
        if len(old) < 2:
            return 0
        # sorts before every batch still to come, after what was merged before it
        name = f"{old[-1]['segment']}-merged"
        n = self._write(self._data([r["segment"] for r in old if r["rows"]]).drop("segment", "bucket"), name)
        merged = SnapshotTable(self.spark, f"{self.path}/merged")
        gone = self._merged() | {r["segment"]: r["rows"] for r in old}
        merged.commit(self.spark.createDataFrame(list(gone.items()), "segment string, rows long").coalesce(1), merged.version())
        kept = [(r["segment"], r["buckets"], r["rows"]) for r in live[len(old):]]
        self._commit([(name, self.buckets, n), *kept], version)
        return len(old)

    def vacuum(self) -> int:
        """Remove the folders of segments that are no longer live (no reader must still use them); returns their number."""
        live = {r["segment"] for r in self._live()}
        n = 0
        for part in ("data", "blooms"):
            fs, root = self.segments._fs(), self.segments._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
            for s in fs.listStatus(root) if fs.exists(root) else ():
                name = s.getPath().getName().removeprefix("segment=")
                if name not in live and name in self._merged():
                    fs.delete(s.getPath(), True)
                    n += part == "data"
        return n
