"""Exact ordered prefix sums without a single-partition window (K1, K2, K3).

A plain ``Window.orderBy(x)`` puts every row in one task. Here the ordered
domain is cut into value ranges ("buckets") by Spark's range partitioner,
each bucket's totals are turned into offsets in a table of at most
``n_buckets + groups`` rows, and the running sum inside a bucket is a window
partitioned by (group, bucket). The result is exact whatever the bucket
bounds are; the bounds only decide how even the tasks are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from .common import checked_broadcast, materialize, null_safe_join

DEFAULT_BUCKETS = None  # None: one bucket per shuffle partition (spark.sql.shuffle.partitions)


def resolve_buckets(spark, n_buckets: int | None) -> int:
    """The bucket count: as given, else the session's shuffle partition count, the knob a cluster
    already sizes so that one partition of the data fits a task."""
    if n_buckets:
        return int(n_buckets)
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _unsign(c, descending: bool):
    return -c if descending else c


def prefix_sums(df: DataFrame, order_col: str, sum_cols: Sequence[str], by: Sequence[str] = (),
                descending: bool = False, n_buckets: int | None = DEFAULT_BUCKETS, with_next: bool = False,
                with_totals: bool = False, materialized: bool = False, few_groups: bool = True) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` in the order of ``order_col`` within ``by``.

    ``df`` must hold one row per (by, order_col) value, i.e. be pre-aggregated.
    The offsets table holds at most ``n_buckets + groups`` rows. It is broadcast
    when ``by`` is of low cardinality (column names, a class label); with
    ``few_groups=False`` (groups defined by the data) the join is left to the planner.
    Adds ``cum_<c>`` for every sum column; with ``with_next`` also
    ``next_<order_col>`` (the following value in the order, null at the end);
    with ``with_totals`` also ``tot_<c>`` (the group total).

    Buckets come from ``repartitionByRange`` on (by, order): Spark samples the
    bounds and places every row by binary search in the JVM, and the partition
    index is the bucket. The bucketed rows are written once by a checkpoint, so
    every branch (bucket totals, running sums) sees the same bucket and the
    upstream is computed once (``materialized=True`` when the input already is).
    """
    by = list(by)
    n_buckets = resolve_buckets(df.sparkSession, n_buckets)
    # negation keeps the column type (no cast of large integers to double)
    d = df.where(F.col(order_col).isNotNull()).withColumn(
        "_k", -F.col(order_col) if descending else F.col(order_col))
    src = d if materialized else d.persist(StorageLevel.MEMORY_AND_DISK)  # read by the sampling and the write
    bucketed = materialize(src.repartitionByRange(n_buckets, *[F.col(c) for c in by], F.col("_k"))
                           .withColumn("_bucket", F.spark_partition_id()))
    if not materialized:
        src.unpersist()

    totals = bucketed.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols],
                                                  F.min("_k").alias("_bmin"))
    wb = Window.partitionBy(*by).orderBy("_bucket")
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_bucket",
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sum_cols],
        *[F.sum(f"_t_{c}").over(Window.partitionBy(*by)).alias(f"tot_{c}") for c in sum_cols],
        F.lead("_bmin").over(wb).alias("_next_bmin"),
    )
    # at most n_buckets + groups rows: range partitions are contiguous in (by, order)
    out = null_safe_join(bucketed, F.broadcast(offsets) if few_groups else offsets, [*by, "_bucket"])

    w = Window.partitionBy(*by, "_bucket").orderBy("_k")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = [F.col(f"_o_{c}") + F.sum(c).over(upto) for c in sum_cols]
    return out.select(*df.columns, *[c.alias(f"cum_{n}") for c, n in zip(cols, sum_cols)],
                      *([_unsign(F.coalesce(F.lead("_k").over(w), F.col("_next_bmin")), descending)
                         .alias(f"next_{order_col}")] if with_next else []),
                      *([F.col(f"tot_{c}") for c in sum_cols] if with_totals else []))


def stratified_rank(df: DataFrame, strata: Sequence[str], key_cols: Sequence[str], seed: int | str,
                    hex_digits: int | None = None, max_strata: int = 16, rows_per_bucket: int = 1_000_000) -> DataFrame:
    """Exact 1-based rank of each row inside its stratum, in seeded md5 order (K2).

    The order key is ``md5(seed|key...)``. Its first ``hex_digits`` hex digits
    (16^digits buckets; by default as many digits as the counted rows need for
    ``rows_per_bucket`` rows in each, 3 at least) split every stratum evenly, so a
    stratum holding nearly all rows still spreads over many tasks. Null is a stratum of its own. Adds
    ``_order`` (the md5 text), ``stratum_rank`` and ``stratum_n``.
    """
    strata = list(strata)
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key_cols]))
    if hex_digits is None:
        hex_digits, n = 3, df.count()
        while 16 ** hex_digits * rows_per_bucket < n:
            hex_digits += 1
    d = df.withColumn("_order", key).withColumn(
        "_bucket", F.conv(F.substring("_order", 1, hex_digits), 16, 10).cast("int"))
    counts = d.groupBy(*strata, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    ws = Window.partitionBy(*strata).orderBy("_bucket")
    offsets = counts.select(
        *strata, "_bucket",
        F.coalesce(F.sum("_n").over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy(*strata)).alias("stratum_n"),
    )
    # Size bound: strata x 16^digits rows; the number of strata is data-defined, so check it.
    offsets = checked_broadcast(offsets, max_strata * 16 ** hex_digits)
    w = Window.partitionBy(*strata, "_bucket").orderBy("_order", *key_cols)
    return (null_safe_join(d, offsets, [*strata, "_bucket"])
            .withColumn("stratum_rank", F.col("_off") + F.row_number().over(w))
            .drop("_bucket", "_off"))


def ecdf_diff(long_df: DataFrame, sample_col: str = "sample", group_col: str = "column_name",
              value_col: str = "value", ref_tag: str = "ref", cur_tag: str = "cur",
              n_buckets: int | None = DEFAULT_BUCKETS, weight_col: str | None = None) -> DataFrame:
    """Per group and distinct value: the two ECDFs and the gap to the next value (K3).

    Input is long: (sample, group, value), one row per observation or, with
    ``weight_col``, pre-aggregated rows carrying their count. Output has group, value, the
    per-value counts, the sample sizes, the reference mean, F_ref and F_cur
    (ECDFs at the value) and dx (distance to the next distinct value of the
    pooled sample, 0 at the last one).
    """
    is_ref = F.col(sample_col) == ref_tag
    is_cur = F.col(sample_col) == cur_tag
    w = F.col(weight_col).cast("long") if weight_col else F.lit(1).cast("long")
    counts = (long_df.where(F.col(value_col).isNotNull())
              .groupBy(group_col, value_col)
              .agg(F.sum(F.when(is_ref, w).otherwise(0)).alias("c_ref"),
                   F.sum(F.when(is_cur, w).otherwise(0)).alias("c_cur"))
              .withColumn("cv_ref", F.col("c_ref") * F.col(value_col)))
    ps = prefix_sums(counts, value_col, ["c_ref", "c_cur", "cv_ref"], by=[group_col], n_buckets=n_buckets,
                     with_next=True, with_totals=True)
    return (ps.withColumnRenamed("tot_c_ref", "n_ref").withColumnRenamed("tot_c_cur", "n_cur")
            .select(group_col, value_col, "c_ref", "c_cur", "n_ref", "n_cur",
                    F.try_divide(F.col("tot_cv_ref"), F.col("n_ref")).alias("mean_ref"),
                    F.try_divide(F.col("cum_c_ref"), F.col("n_ref")).alias("F_ref"),
                    F.try_divide(F.col("cum_c_cur"), F.col("n_cur")).alias("F_cur"),
                    F.coalesce(F.col(f"next_{value_col}") - F.col(value_col), F.lit(0.0)).alias("dx")))
