"""Per-key recency windows (W1, W2, A14 keyed).

A window partitioned only by the key sends a hot key (a third of all rows)
to one task. ``last_n_per_key`` relies on Spark's window group limit (each
task keeps its local top n before the shuffle). ``trailing_rows`` keeps
ordinary keys in an ordinary window and splits hot keys: exact per-key
ranks, fixed-size chunks, and the last n-1 rows of a chunk copied into the
next one as a halo, so every task holds at most ``chunk_rows + n - 1`` rows
whatever the key skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checked_broadcast, null_safe_join
from .prefix import DEFAULT_BUCKETS, prefix_sums


def last_n_per_key(df: DataFrame, key: str, ts: str, tie: str, n: int) -> DataFrame:
    """The newest ``n`` rows per key with their recency rank ``rn`` (1 = newest)."""
    w = Window.partitionBy(key).orderBy(F.desc(ts), F.asc(tie))
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)


def _order_of(df: DataFrame, order_value: Column, tie: Sequence[str] = ()) -> Column:
    """The order within a key: the order value (null first), tied rows by ``tie`` and a hash of the row. Rows
    that are equal in all of these are the same row, so any order of them gives the same result."""
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.struct(order_value.alias("o"), *tie, F.xxhash64(*plain).alias("_t"))


def exact_rank(df: DataFrame, key: str, order_value: Column, n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """1-based rank of each row within its key, one rank per row: by ``order_value`` (null first), ties as
    in ``_order_of``; a null key is a key like any other.

    Uses the bucketed prefix count, so no task holds a whole key; only rows that are equal in every
    column are numbered together.
    """
    return _ranked(df.withColumn("_ov", _order_of(df, order_value)), key, n_buckets).drop("_ov")


def _ranked(d: DataFrame, key: str, n_buckets: int | None) -> DataFrame:
    """``exact_rank`` of rows that carry their order ``_ov``."""
    counts = d.groupBy(key, "_ov").agg(F.count(F.lit(1)).alias("_c"))
    before = prefix_sums(counts, "_ov", ["_c"], by=[key], n_buckets=n_buckets, few_groups=False).select(
        key, "_ov", (F.col("cum__c") - F.col("_c")).alias("_before"))
    same = F.row_number().over(Window.partitionBy(key, "_ov").orderBy(F.lit(0)))
    return null_safe_join(d, before, [key, "_ov"]).withColumn("_rank", F.col("_before") + same).drop("_before")


def _cold_hot(d: DataFrame, key: str, chunk_rows: int, max_hot_keys: int) -> tuple[DataFrame, DataFrame]:
    """The rows of keys with at most ``chunk_rows`` rows, and those of the others (hot keys). The hot-key
    list is bounded by rows / chunk_rows and its size is checked before it is broadcast."""
    sizes = d.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot_keys = checked_broadcast(sizes.where(F.col("_n") > chunk_rows).select(key, F.lit(True).alias("_hot")), max_hot_keys)
    flagged = null_safe_join(d, hot_keys, [key], "left")
    return flagged.where(F.col("_hot").isNull()).drop("_hot"), flagged.where(F.col("_hot")).drop("_hot")


def _chunked(r: DataFrame, key: str, n: int, aggs: dict[str, Column], chunk_rows: int) -> DataFrame:
    """Trailing-n aggregates over rows that carry an exact per-key ``_rank``: fixed-size chunks per key,
    the last n-1 rows of every chunk copied into the next one as its halo."""
    pos = F.col("_rank") - 1
    chunk = F.floor(pos / chunk_rows)
    own = F.struct(chunk.alias("_chunk"), F.lit(False).alias("_halo"))
    halo = F.struct((chunk + 1).alias("_chunk"), F.lit(True).alias("_halo"))
    copies = F.when((pos % chunk_rows) >= chunk_rows - (n - 1), F.array(own, halo)).otherwise(F.array(own))
    both = r.select("*", F.explode(copies).alias("_ch")).select("*", "_ch._chunk", "_ch._halo").drop("_ch")
    w = Window.partitionBy(key, "_chunk").orderBy("_rank").rowsBetween(-(n - 1), 0)
    out = both.select("*", *[a.over(w).alias(name) for name, a in aggs.items()])
    return out.where(~F.col("_halo")).drop("_chunk", "_halo", "_rank")


def trailing_rows(df: DataFrame, key: str, order_value: Column, n: int, aggs: dict[str, Column],
                  chunk_rows: int = 1_000_000, n_buckets: int | None = DEFAULT_BUCKETS,
                  max_hot_keys: int = 100_000, tie: Sequence[str] = ()) -> DataFrame:
    """Aggregates over the trailing ``n`` rows (this row and n-1 before it) per key, at every row.

    ``aggs`` maps output names to aggregate expressions (e.g. ``{"avg_x": F.avg("x")}``), evaluated
    over ``rowsBetween(-(n-1), 0)`` in ``order_value`` order (null first; tied rows by ``tie``, then a hash of the row). Keys are split by size:
    a key with at most ``chunk_rows`` rows is one window partition (bounded by construction); a hot key
    is ranked exactly with the bucketed prefix count and cut into chunks with an (n-1)-row halo, so no
    task holds more than ``chunk_rows + n - 1`` rows whatever the skew. The hot-key list is bounded by
    rows / chunk_rows and its size is checked before it is broadcast.
    """
    if chunk_rows < n:
        raise ValueError("chunk_rows must be at least n")
    d = df.withColumn("_ov", _order_of(df, order_value, tie))
    cold, hot = _cold_hot(d, key, chunk_rows, max_hot_keys)
    w = Window.partitionBy(key).orderBy("_ov").rowsBetween(-(n - 1), 0)
    cold_out = cold.select("*", *[a.over(w).alias(name) for name, a in aggs.items()]).drop("_ov")
    ranked = _ranked(hot, key, n_buckets).drop("_ov")
    return cold_out.unionByName(_chunked(ranked, key, n, aggs, chunk_rows))


def sessions(df: DataFrame, key: str, ts: str, gap_seconds: int, aggs: dict[str, Column],
             chunk_rows: int = 1_000_000, n_buckets: int | None = DEFAULT_BUCKETS,
             max_hot_keys: int = 100_000) -> DataFrame:
    """Activity sessions per key: a session ends after ``gap_seconds`` without an event (T4 session
    form, batch). Output: key, session_start (first event), session_end (last event + gap) and ``aggs``
    over the session's rows. Rows without a time form one session per key, without start and end.

    The same split as ``trailing_rows``: ordinary keys use plain per-key windows; a hot key is ranked
    exactly, cut into chunks (a one-row halo gives each chunk's first row its predecessor), and the
    session id (the start time of the row's session, a running max) is carried across chunks by a
    per-chunk maxima table.
    """
    gap_us = int(gap_seconds) * 1_000_000
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    d = df.withColumn("_ov", _order_of(df, us)).withColumn("_us", us)
    cold, hot = _cold_hot(d, key, chunk_rows, max_hot_keys)

    def start_of(prev: Column) -> Column:
        return F.when(prev.isNull() | (F.col("_us") - prev >= gap_us), F.col("_us"))

    wk = Window.partitionBy(key).orderBy("_ov")
    cold_s = (cold.withColumn("_start", start_of(F.lag("_us").over(wk)))
              .withColumn("_sid", F.max("_start").over(wk.rowsBetween(Window.unboundedPreceding, 0))))

    r = _ranked(hot, key, n_buckets)
    pos = F.col("_rank") - 1
    chunk = F.floor(pos / chunk_rows)
    own = F.struct(chunk.alias("_chunk"), F.lit(False).alias("_halo"))
    halo = F.struct((chunk + 1).alias("_chunk"), F.lit(True).alias("_halo"))
    copies = F.when(pos % chunk_rows == chunk_rows - 1, F.array(own, halo)).otherwise(F.array(own))
    both = r.select("*", F.explode(copies).alias("_ch")).select("*", "_ch._chunk", "_ch._halo").drop("_ch")
    wc = Window.partitionBy(key, "_chunk").orderBy("_rank")
    local = (both.withColumn("_start", start_of(F.lag("_us").over(wc))).where(~F.col("_halo"))
             .withColumn("_lmax", F.max("_start").over(wc.rowsBetween(Window.unboundedPreceding, 0))))
    chunk_max = local.groupBy(key, "_chunk").agg(F.max("_start").alias("_cm"))  # rows / chunk_rows rows
    offsets = chunk_max.select(key, "_chunk", F.max("_cm").over(
        Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)).alias("_off"))
    hot_s = (null_safe_join(local, offsets, [key, "_chunk"])
             .withColumn("_sid", F.greatest("_lmax", "_off"))
             .drop("_rank", "_chunk", "_halo", "_lmax", "_off"))

    rows = cold_s.unionByName(hot_s)
    return rows.groupBy(key, "_sid").agg(
        F.min(ts).alias("session_start"),
        (F.max(ts) + F.make_interval(secs=F.lit(int(gap_seconds)))).alias("session_end"),
        *[a.alias(n) for n, a in aggs.items()]).drop("_sid")


def running_max(df: DataFrame, key: str, order_value: Column, col: str, out: str, inclusive: bool = True,
                chunk_rows: int = 1_000_000, n_buckets: int | None = DEFAULT_BUCKETS,
                max_hot_keys: int = 100_000) -> DataFrame:
    """Running maximum of ``col`` per key in ``order_value`` order (ties by a hash of the row), up to and including
    the row, or only the rows before it with ``inclusive=False`` (W4).

    Ordinary keys use a plain per-key window. A hot key (more than ``chunk_rows`` rows) is ranked
    exactly, cut into chunks, and the maximum of all earlier chunks comes from a per-chunk maxima table.
    """
    end = Window.currentRow if inclusive else -1
    d = df.withColumn("_ov", _order_of(df, order_value))
    cold, hot = _cold_hot(d, key, chunk_rows, max_hot_keys)
    wk = Window.partitionBy(key).orderBy("_ov").rowsBetween(Window.unboundedPreceding, end)
    cold_out = cold.withColumn(out, F.max(col).over(wk)).drop("_ov")

    r = _ranked(hot, key, n_buckets).drop("_ov").withColumn(
        "_chunk", F.floor((F.col("_rank") - 1) / chunk_rows))
    wc = Window.partitionBy(key, "_chunk").orderBy("_rank").rowsBetween(Window.unboundedPreceding, end)
    local = r.withColumn("_lmax", F.max(col).over(wc))
    chunk_max = r.groupBy(key, "_chunk").agg(F.max(col).alias("_cm"))  # rows / chunk_rows rows
    offsets = chunk_max.select(key, "_chunk", F.max("_cm").over(
        Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)).alias("_off"))
    hot_out = (null_safe_join(local, offsets, [key, "_chunk"]).withColumn(out, F.greatest("_lmax", "_off"))
               .drop("_rank", "_chunk", "_lmax", "_off"))
    return cold_out.unionByName(hot_out)
