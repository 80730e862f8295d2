"""Exact classifier evaluation.

Every metric starts from the per-score pre-aggregate (one row per distinct
score with its positive and negative counts), so a hot score value costs one
row, and ordered sums go through the bucketed prefix sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import literal_bucket, materialize, zero_div
from .prefix import DEFAULT_BUCKETS, prefix_sums


def _label(label: str):
    return F.col(label).cast("int") == 1


def score_counts(df: DataFrame, label: str = "Class", score: str = "p") -> DataFrame:
    """One row per distinct score: pos, neg (map-side partial aggregation)."""
    return (df.where(F.col(score).isNotNull())
            .groupBy(score)
            .agg(F.count_if(_label(label)).alias("pos"), F.count_if(~_label(label)).alias("neg")))


def confusion(df: DataFrame, label: str = "Class", score: str = "p", threshold: float = 0.5) -> DataFrame:
    """tn, fp, fn, tp at ``score >= threshold``; all four cells always present."""
    hit = F.col(score) >= F.lit(threshold)
    y = _label(label)
    return df.agg(
        F.count_if(~y & ~hit).alias("tn"), F.count_if(~y & hit).alias("fp"),
        F.count_if(y & ~hit).alias("fn"), F.count_if(y & hit).alias("tp"),
    )


def with_rates(conf: DataFrame) -> DataFrame:
    """precision, recall, f1 from the confusion cells; a zero denominator gives 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return conf.select(
        "*",
        zero_div(tp, tp + fp).alias("precision"),
        zero_div(tp, tp + fn).alias("recall"),
        zero_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def cumulative_counts(df: DataFrame, label: str = "Class", score: str = "p",
                      n_buckets: int | None = DEFAULT_BUCKETS, counts: DataFrame | None = None) -> DataFrame:
    """Per distinct score, descending: pos, neg, the running TP, FP at that score (W5) and the totals
    n_pos, n_neg. ``counts`` may pass an already materialized ``score_counts`` table."""
    sc = counts if counts is not None else score_counts(df, label, score)
    ps = prefix_sums(sc.where(F.col(score).isNotNull()), score, ["pos", "neg"], descending=True,
                     n_buckets=n_buckets, with_totals=True, materialized=counts is not None)
    return (ps.withColumnRenamed("cum_pos", "tp").withColumnRenamed("cum_neg", "fp")
            .withColumnRenamed("tot_pos", "n_pos").withColumnRenamed("tot_neg", "n_neg"))


def auc_ap(df: DataFrame, label: str = "Class", score: str = "p",
           n_buckets: int | None = DEFAULT_BUCKETS, counts: DataFrame | None = None) -> DataFrame:
    """Exact ROC-AUC (ties at half weight) and average precision in one row.

    AUC = sum_i neg_i * (TP_i - pos_i / 2) / (P * N); AP = sum_i pos_i * TP_i / (TP_i + FP_i) / P,
    with TP_i, FP_i the counts at scores >= s_i. One class only gives null.
    """
    cc = cumulative_counts(df, label, score, n_buckets, counts)
    parts = cc.agg(
        F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)).alias("_auc_num"),
        F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("_ap_num"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
    )
    P, N = F.col("n_pos"), F.col("n_neg")
    return parts.select(
        F.when((P > 0) & (N > 0), F.col("_auc_num") / (P * N)).alias("roc_auc"),
        F.when(P > 0, F.col("_ap_num") / P).alias("average_precision"),
    )


def roc_curve(df: DataFrame, label: str = "Class", score: str = "p",
              n_buckets: int | None = DEFAULT_BUCKETS, ends: bool = False) -> DataFrame:
    """One ROC point per distinct score: threshold, fpr, tpr; with ``ends`` also the start (null threshold: above
    every score, 0, 0), so that the area under the points is the AUC (A11). Totals come with the running sums."""
    return _roc_points(cumulative_counts(df, label, score, n_buckets), score, ends)


def _with_start(cc: DataFrame, start: Column, own: Column, ends: bool) -> DataFrame:
    """``own`` as a row per score, and with ``ends`` ``start`` once, before the highest score (whose running counts are its own)."""
    if not ends:
        return cc.select(own.alias("_p")).select("_p.*")
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    return cc.select(F.explode(F.when(first, F.array(start, own)).otherwise(F.array(own))).alias("_p")).select("_p.*")


def _roc_points(cc: DataFrame, score: str, ends: bool) -> DataFrame:
    def point(threshold: Column, fp: Column, tp: Column) -> Column:
        return F.struct(threshold.alias("threshold"), F.try_divide(fp, F.col("n_neg")).alias("fpr"),
                        F.try_divide(tp, F.col("n_pos")).alias("tpr"))

    nothing = F.lit(0).cast("long")
    none = F.lit(None).cast(cc.schema[score].dataType)
    return _with_start(cc, point(none, nothing, nothing), point(F.col(score), F.col("fp"), F.col("tp")), ends)


def roc_curve_thinned(df: DataFrame, label: str = "Class", score: str = "p",
                      n_buckets: int | None = DEFAULT_BUCKETS, ends: bool = False) -> DataFrame:
    """ROC points without the intermediate ones (A11 thinning for plots): a point is kept when the
    second difference of FP or of TP at it is non-zero, or it is the first or the last point. With ``ends``
    also the start (0, 0), as in ``roc_curve``.

    Neighbours are found by equi-joins on the next distinct score (the prefix sums carry it), so the
    thinning is distributed like the curve itself; no ordered window over all points.
    """
    cc = cumulative_counts_next(df, label, score, n_buckets)
    nxt = cc.select(F.col(score).alias("_nv"), F.col("tp").alias("tp_next"), F.col("fp").alias("fp_next"))
    prv = cc.select(F.col("next_" + score).alias("_pv_key"), F.col("tp").alias("tp_prev"),
                    F.col("fp").alias("fp_prev"))
    j = (cc.join(nxt, cc["next_" + score] == nxt["_nv"], "left")
         .join(prv, cc[score] == prv["_pv_key"], "left"))
    d2 = lambda a, p_, n_: F.col(n_) - 2 * F.col(a) + F.col(p_)
    keep = (F.col("tp_prev").isNull() | F.col("tp_next").isNull()
            | (d2("fp", "fp_prev", "fp_next") != 0) | (d2("tp", "tp_prev", "tp_next") != 0))
    return _roc_points(j.where(keep), score, ends)


def cumulative_counts_next(df: DataFrame, label: str = "Class", score: str = "p",
                           n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """``cumulative_counts`` plus ``next_<score>``: the next lower distinct score (null at the end)."""
    sc = score_counts(df, label, score)
    ps = prefix_sums(sc, score, ["pos", "neg"], descending=True, n_buckets=n_buckets, with_totals=True,
                     with_next=True)
    return (ps.withColumnRenamed("cum_pos", "tp").withColumnRenamed("cum_neg", "fp")
            .withColumnRenamed("tot_pos", "n_pos").withColumnRenamed("tot_neg", "n_neg"))


def pr_curve(df: DataFrame, label: str = "Class", score: str = "p",
             n_buckets: int | None = DEFAULT_BUCKETS, ends: bool = False) -> DataFrame:
    """One PR point per distinct score: threshold, precision, recall, baseline prevalence; with ``ends`` also the
    end (null threshold: above every score, precision 1, recall 0) (A12)."""
    cc = cumulative_counts(df, label, score, n_buckets)
    base = F.try_divide(F.col("n_pos"), F.col("n_pos") + F.col("n_neg")).alias("baseline")
    own = F.struct(F.col(score).alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                   F.try_divide(F.col("tp"), F.col("n_pos")).alias("recall"), base)
    none = F.lit(None).cast(cc.schema[score].dataType)
    return _with_start(cc, F.struct(none.alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), base), own, ends)


def threshold_sweep(df: DataFrame, thresholds: Sequence[float], label: str = "Class",
                    score: str = "p") -> DataFrame:
    """Confusion cells and rates at each threshold of a list, in one pass.

    Each row falls into the range between consecutive thresholds (an equality
    group of at most len(thresholds)+1 keys), then the ranges are summed from
    the top; no join of rows with thresholds.
    """
    ths = sorted({float(t) for t in thresholds})
    T = len(ths)
    cuts = F.array(*[F.lit(t) for t in ths])
    # bin b = number of thresholds <= score: the row is a hit for thresholds 0..b-1
    b = literal_bucket(F.col(score), ths, inclusive=True)
    spark = df.sparkSession
    per_bin = (df.where(F.col(score).isNotNull())
               .groupBy(b.alias("bin"))
               .agg(F.count_if(_label(label)).alias("pos"), F.count_if(~_label(label)).alias("neg")))
    dense = spark.range(0, T + 1).select(F.col("id").cast("int").alias("bin"))
    w = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    suffix = (dense.join(per_bin, "bin", "left").na.fill(0, ["pos", "neg"])  # T+1 rows
              .select("bin", F.sum("pos").over(w).alias("s_pos"), F.sum("neg").over(w).alias("s_neg"),
                      F.sum("pos").over(Window.partitionBy()).alias("n_pos"),
                      F.sum("neg").over(Window.partitionBy()).alias("n_neg")))
    th = F.element_at(cuts, F.col("bin"))  # threshold j (1-based) pairs with bin j
    conf = suffix.where(F.col("bin") >= 1).select(
        th.alias("threshold"),
        (F.col("n_neg") - F.col("s_neg")).alias("tn"), F.col("s_neg").alias("fp"),
        (F.col("n_pos") - F.col("s_pos")).alias("fn"), F.col("s_pos").alias("tp"))
    return with_rates(conf)


def with_late_labels(scored: DataFrame, labels: DataFrame, key: str, label: str = "Class") -> DataFrame:
    """Logged predictions joined to labels that arrive later, by id (J6); unlabelled rows are left out.
    A keyed equi-join: the planner / AQE choose the strategy and split skewed keys."""
    return scored.join(labels.select(key, label), key, "inner")


def last_n(df: DataFrame, n: int, ts: str = "timestamp", key: str = "prediction_id") -> DataFrame:
    """Newest ``n`` rows, newest first; the id breaks timestamp ties."""
    return df.orderBy(F.desc(ts), F.asc(key)).limit(n)


def last_n_rollup(df: DataFrame, n: int = 100, ts: str = "timestamp", key: str = "prediction_id",
                  flag: str = "is_fraud", prob: str = "fraud_probability") -> DataFrame:
    """count, fraud_rate, avg_probability over the newest n; empty gives (0, null, null)."""
    recent = last_n(df.select(ts, key, flag, prob), n, ts, key)
    return recent.agg(
        F.count(F.lit(1)).alias("count"),
        F.round(F.avg(F.col(flag).cast("int")), 4).alias("fraud_rate"),
        F.round(F.avg(prob), 4).alias("avg_probability"),
    )


def evaluate(df: DataFrame, label: str = "Class", score: str = "p", threshold: float = 0.5,
             model_version: str | None = None, path: str | None = None,
             n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """One metric row for a scored table (M8): counts, prevalence, AUC, AP, confusion, rates.

    The raw table is scanned once: its per-score counts (null scores kept as their own group) are
    materialized, and the counts, confusion cells and the ordered AUC / AP sums all read that table.
    """
    sc = materialize(df.groupBy(score).agg(F.count_if(_label(label)).alias("pos"),
                                           F.count_if(~_label(label)).alias("neg")))
    hit = F.col(score) >= F.lit(threshold)
    n = F.sum(F.col("pos") + F.col("neg"))
    base = with_rates(sc.agg(  # counts and the confusion cells from the per-score table
        n.alias("n"), F.sum("pos").alias("positives"), (F.sum("pos") / n).alias("prevalence"),
        F.sum(F.when(~hit, F.col("neg")).otherwise(0)).alias("tn"), F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~hit, F.col("pos")).otherwise(0)).alias("fn"), F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp")))
    m = auc_ap(df, label, score, n_buckets, counts=sc).select(F.struct("roc_auc", "average_precision")).scalar()
    return (base.select("*", m["roc_auc"].alias("roc_auc"), m["average_precision"].alias("average_precision"))
            .withColumn("threshold", F.lit(float(threshold)))
            .withColumn("improvement_over_random", F.try_divide(F.col("average_precision"), F.col("prevalence")))
            .withColumn("model_version", F.lit(model_version).cast("string"))
            .withColumn("path", F.lit(path).cast("string")))


COMPARE_METRICS = ["roc_auc", "average_precision", "precision", "recall", "f1", "prevalence"]


def compare_versions(run_metrics: DataFrame, versions: Sequence[str],
                     metrics: Sequence[str] = tuple(COMPARE_METRICS)) -> DataFrame:
    """Metric report for model versions side by side.

    ``run_metrics`` holds one row per version (the output of ``evaluate``). The
    result has one row per metric, one column per version and ``change`` from
    the first to the last version. The pivot values are given, so Spark does
    not run a distinct job to find them.
    """
    long = run_metrics.select("model_version", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])).alias("s"))
    wide = (long.select("model_version", "s.*").groupBy("metric")
            .pivot("model_version", list(versions)).agg(F.first("value")))
    return wide.withColumn("change", F.col(versions[-1]) - F.col(versions[0]))
