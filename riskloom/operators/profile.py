"""Table profiling.

Everything is one or two aggregate passes. Wide results (one value per
column) are built as a single-row aggregate and exploded, so a table with
many columns still costs one scan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import nan_as_null, null_safe_join
from .prefix import DEFAULT_BUCKETS, prefix_sums


def shape(df: DataFrame) -> DataFrame:
    """n_rows, n_cols."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def _explode_structs(row_df: DataFrame, structs: list) -> DataFrame:
    return row_df.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def column_info(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column_name, position, dtype, non_null, nulls per column in one scan; NaN counts as null."""
    cols = list(columns or df.columns)
    dtypes = dict(df.dtypes)
    agg = nan_as_null(df, cols).agg(F.count(F.lit(1)).alias("__n"), *[F.count(F.col(c)).alias(f"__nn_{i}") for i, c in enumerate(cols)])
    structs = [F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("position"), F.lit(dtypes[c]).alias("dtype"),
                        F.col(f"__nn_{i}").alias("non_null"), (F.col("__n") - F.col(f"__nn_{i}")).alias("nulls"))
               for i, c in enumerate(cols)]
    return _explode_structs(agg, structs)


def class_balance(df: DataFrame, label: str = "Class", by: Sequence[str] = ()) -> DataFrame:
    """Counts per class and their share of the group total."""
    by = list(by)
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    # the window runs over the (groups x classes) count table, never over data rows
    return counts.withColumn("share", F.col("count") / F.sum("count").over(w))


def imbalance(df: DataFrame, label: str = "Class") -> DataFrame:
    """n_neg, n_pos, ratio n_neg / n_pos; no positives gives null (A2, M3)."""
    y = F.col(label).cast("int") == 1
    return df.agg(F.count_if(~y).alias("n_neg"), F.count_if(y).alias("n_pos")).withColumn(
        "ratio", F.try_divide(F.col("n_neg").cast("double"), F.when(F.col("n_pos") > 0, F.col("n_pos"))))


def prevalence(df: DataFrame, label: str = "Class") -> DataFrame:
    """n, positives, prevalence (A3)."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label).cast("int") == 1).alias("positives"),
                  F.avg(F.col(label).cast("double")).alias("prevalence"))


def mean_std(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, n, mean, std_pop per column, one pass (A4, K4)."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.count(c).alias(f"n{i}"), F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
    row = nan_as_null(df, columns).agg(*aggs)
    return _explode_structs(row, [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"),
                                           F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std_pop"))
                                  for i, c in enumerate(columns)])


def hour_of_time(seconds_col: str = "Time"):
    """Hour of day from seconds since the first event."""
    return (F.floor(F.col(seconds_col) / 3600) % 24).cast("int")


def hour_class_counts(df: DataFrame, label: str = "Class", time_col: str = "Time") -> DataFrame:
    """Counts by hour of day and class (A5)."""
    return df.groupBy(hour_of_time(time_col).alias("hour"), F.col(label)).agg(F.count(F.lit(1)).alias("count"))


PAIRS_PER_PASS = 800  # column pairs in one aggregate


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, long form (a, b, r), diagonal included.

    Pairwise complete rows at any width (NaN counts as null). Each unordered pair is computed once and
    mirrored; pairs go in blocks, one aggregate pass per block. Columns with no variance give null, as in pandas.
    """
    cols = list(columns)
    d = nan_as_null(df, cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    blocks = []
    for at in range(0, len(pairs), PAIRS_PER_PASS):
        some = pairs[at:at + PAIRS_PER_PASS]
        row = d.agg(*[(F.corr(cols[i], cols[j]) if i < j else F.stddev_pop(cols[i])).alias(f"c{i}_{j}") for i, j in some])
        structs = []
        for i, j in some:
            r = F.col(f"c{i}_{j}") if i < j else F.when(F.col(f"c{i}_{j}") > 0, F.lit(1.0))
            structs += [F.struct(F.lit(cols[a]).alias("a"), F.lit(cols[b]).alias("b"), r.alias("r"))
                        for a, b in dict.fromkeys([(i, j), (j, i)])]
        blocks.append(_explode_structs(row, structs))
    return reduce(DataFrame.unionByName, blocks)


def top_corr_with(df: DataFrame, target: str, columns: Sequence[str], k: int = 5) -> DataFrame:
    """The k columns most correlated (by |r|) with ``target``, target itself excluded (D3)."""
    cols = [c for c in columns if c != target]
    row = nan_as_null(df, [target, *cols]).agg(*[F.corr(c, target).alias(f"c{i}") for i, c in enumerate(cols)])
    long = _explode_structs(row, [F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("r"))
                                  for i, c in enumerate(cols)])
    return long.where(F.col("r").isNotNull()).orderBy(F.desc(F.abs("r")), "feature").limit(k)


def histogram(df: DataFrame, column: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram as a density (A15): bin, lo, hi, count, density.

    Edges span [min, max] of each group; the top edge falls in the last bin;
    empty bins are kept; densities integrate to 1. A constant column puts
    every row in bin 0 with width 0 and density null.
    """
    by = list(by)
    x = F.col(column)
    d = nan_as_null(df.select(*by, column), [column]).where(x.isNotNull())
    stats = d.groupBy(*by).agg(F.min(x).alias("_mn"), F.max(x).alias("_mx"), F.count(F.lit(1)).alias("_n"))
    width = (F.col("_mx") - F.col("_mn")) / F.lit(float(bins))
    if by:  # one row of edges per group; the planner broadcasts it where it is small
        joined = null_safe_join(d, stats, by)
        mn, mx = F.col("_mn"), F.col("_mx")
    else:  # the edges as a scalar subquery
        e = stats.select(F.struct("_mn", "_mx")).scalar()
        joined, mn, mx = d, e["_mn"], e["_mx"]
    pos = F.when(mx > mn, F.least(F.floor((x - mn) / (mx - mn) * bins), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    counts = joined.groupBy(*by, pos.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = stats.select(*by, "_mn", "_mx", "_n", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = null_safe_join(grid, counts, [*by, "bin"], "left").na.fill(0, ["count"])
    return out.select(
        *by, "bin",
        (F.col("_mn") + width * F.col("bin")).alias("lo"),
        (F.col("_mn") + width * (F.col("bin") + 1)).alias("hi"),
        "count",
        F.try_divide(F.col("count"), F.col("_n") * F.when(width > 0, width)).alias("density"),
    )


def exact_percentiles(df: DataFrame, column: str, qs: Sequence[float],
                      n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Interpolated percentiles (like quantile_cont), exact and distributed.

    Distinct values are counted and ranked through the bucketed prefix sum;
    each distinct value knows its rank range, and only the values whose range
    holds a target rank floor(h) or ceil(h), h = q * (n - 1), are kept. No
    aggregate buffer holds the whole column. Output: q, value.
    """
    x = F.col(column)
    counts = nan_as_null(df.select(column), [column]).where(x.isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("c"))
    ps = prefix_sums(counts, column, ["c"], n_buckets=n_buckets)  # cum_c = rows with value <= v
    n = counts.agg(F.sum("c").alias("n"))
    targets = n.select(F.array(*[F.struct(F.lit(float(q)).alias("q"), (F.lit(float(q)) * (F.col("n") - 1)).alias("h"))
                                 for q in qs])).scalar()  # the requested levels and their ranks
    first, last = F.col("cum_c") - F.col("c"), F.col("cum_c") - 1
    # one row per (distinct value, requested level), kept only where the level's rank falls in the value's range
    hits = (ps.select(x.alias("v"), F.explode(targets).alias("t"), first.alias("first"), last.alias("last"))
            .where(((F.floor("t.h") >= F.col("first")) & (F.floor("t.h") <= F.col("last")))
                   | ((F.ceil("t.h") >= F.col("first")) & (F.ceil("t.h") <= F.col("last")))))
    lo_hit = (F.floor("t.h") >= F.col("first")) & (F.floor("t.h") <= F.col("last"))
    hi_hit = (F.ceil("t.h") >= F.col("first")) & (F.ceil("t.h") <= F.col("last"))
    per_q = hits.groupBy(F.col("t.q").alias("q")).agg(
        F.first("t.h").alias("h"), F.max(F.when(lo_hit, F.col("v"))).alias("v_lo"),
        F.max(F.when(hi_hit, F.col("v"))).alias("v_hi"))
    return per_q.select("q", (F.col("v_lo") + (F.col("h") - F.floor("h")) * (F.col("v_hi") - F.col("v_lo"))).alias("value"))


#: Size of the quantile sketches: a rank is off by 2.296 / k**0.9021 of the rows at most, in 99 of 100 cases (the bound
#: published for these sketches); ``RANK_ERROR`` is four times that, which no case of practice passes.
SKETCH_K = 2000
RANK_ERROR = 4 * 2.296 / SKETCH_K ** 0.9021


def percentile_sketches(df: DataFrame, column: str, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """One mergeable quantile sketch per group (A16 for many groups): ``by``, ``sketch``, ``n``. A sketch holds a few
    times ``k`` values whatever the group's size, is built on both sides of the shuffle and can be stored, say
    per day and key. Missing values and NaN are left out; a group without values has no sketch."""
    d = nan_as_null(df.select(*by, column), [column]).where(F.col(column).isNotNull())
    return d.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(column).cast("double"), k).alias("sketch"), F.count(F.lit(1)).alias("n"))


def merged_sketches(sketches: DataFrame, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """Stored sketches summed to coarser groups: no value is read again."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("n").alias("n"))


def sketch_percentiles(sketches: DataFrame, qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by``, q, value, n: a value of the group whose rank is within ``RANK_ERROR`` * n of q * n."""
    each = [F.struct(F.lit(float(q)).alias("q"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias("value")) for q in qs]
    return sketches.select(*by, "n", F.explode(F.array(*each)).alias("_x")).select(*by, "_x.q", "_x.value", "n")


def success_throughput(df: DataFrame, ok: str = "ok", ts: str = "ts", latency: str = "latency") -> DataFrame:
    """n, success_rate, mean latency, elapsed seconds and rows per second over a request log."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    r = df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(ok).cast("double")).alias("success_rate"),
               F.avg(latency).alias("mean_latency"),
               ((F.max(micros) - F.min(micros)) / 1e6).alias("elapsed_s"))
    return r.withColumn("throughput", F.try_divide(F.col("n").cast("double"), F.when(F.col("elapsed_s") > 0, F.col("elapsed_s"))))


def kde(df: DataFrame, column: str, label: str = "Class", bins: int = 200, grid: int = 100) -> DataFrame:
    """Per-class gaussian kernel density on a fixed grid, from a histogram.

    Bandwidth = n^(-1/5) * sample std (Scott's rule). Rows are binned first, so
    the cost is bins x grid per class and not rows x grid. Output: label, x, density.
    """
    x = F.col(column)
    d = nan_as_null(df.select(label, column), [column]).where(x.isNotNull())
    rng = d.agg(F.struct(F.min(x).alias("gmin"), F.max(x).alias("gmax"))).scalar()  # scalar subquery
    gmin, gmax = rng["gmin"], rng["gmax"]
    per_class = d.groupBy(label).agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp(x).alias("_sd"))
    w = (gmax - gmin) / bins
    b = F.when(gmax > gmin, F.least(F.floor((x - gmin) / (gmax - gmin) * bins), F.lit(bins - 1))).otherwise(
        F.lit(0)).cast("int")
    hist = d.groupBy(label, b.alias("_bin")).agg(F.count(F.lit(1)).alias("_c"))
    centers = hist.select(label, "_c", (gmin + w * (F.col("_bin") + 0.5)).alias("_xc"))
    h = F.pow(F.col("_n").cast("double"), F.lit(-0.2)) * F.col("_sd")
    # the bins of one class are at most `bins` rows by construction, so one array per class is bounded
    per = null_safe_join(centers.groupBy(label).agg(F.collect_list(F.struct("_xc", "_c")).alias("_hist")),
                         per_class, [label]).withColumn("_h", h)
    pts = (per.select(label, "_hist", "_n", "_h", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("_g"))
           .withColumn("x", gmin + (gmax - gmin) * F.col("_g") / F.lit(grid - 1)))
    norm = F.col("_n") * F.col("_h") * F.lit(math.sqrt(2 * math.pi))
    dens = F.aggregate("_hist", F.lit(0.0), lambda acc, b: acc + b["_c"] * F.exp(
        F.lit(-0.5) * F.pow((F.col("x") - b["_xc"]) / F.col("_h"), 2)))
    return pts.select(label, "x", (dens / norm).alias("density"))
