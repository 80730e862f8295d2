"""Two-sample drift tests for every column in one job.

Both samples are unpivoted to one long table (sample, column_name, value) and
every statistic is a grouped aggregate by column_name, so adding columns adds
groups, not jobs. Numeric columns use the exact two-sample ECDF difference
of ``prefix.ecdf_diff``; categorical columns use a contingency count.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import nan_as_null, zero_div
from .prefix import DEFAULT_BUCKETS, ecdf_diff, stratified_rank

# Test names as they appear in drift reports, and decision rules.
KS_NAME = "K-S p_value"
WASSERSTEIN_NAME = "Wasserstein distance (normed)"
CHISQUARE_NAME = "chi-square p_value"
SMALL_REFERENCE_ROWS = 1000      # reference rows at or below this use K-S, above it Wasserstein
WASSERSTEIN_MIN_NORM = 0.001     # floor on the reference std used as divisor
DATASET_DRIFT_SHARE = 0.5        # dataset drift when share of drifted columns >= 0.5
RETRAIN_SHARE = 0.3              # retrain when share of drifted columns > 0.3
MIN_SAMPLE_ROWS = 30             # warn below this many rows
# Fixed text of a fired decision: part of the trigger's format, which readers may match.
REASON_TEXT = "drift_share (%.4f) exceeded threshold (%.2f).  %d feature(s) showed statistically significant drift."
KS_SERIES_TERMS = 100
FRAUD_PROFILE = {"V1": (-5.0, 0.5), "V2": (3.5, 0.5)}  # mean and sd of the overwritten rows of a full shift (F8)
FULL_SHIFT_NOISE = ("V1", "V2", "V3")


def full_shift(df: DataFrame, key: str, seed: int = 99, overwrite_fraction: float = 0.2) -> DataFrame:
    """The whole declared shift (F8): Amount times ten, noise on V1 to V3, and one row in five overwritten with the profile
    of a fraud in V1, V2 and Amount."""
    return inject_shift(df, key, seed, overwrite_fraction=overwrite_fraction, noise_cols=FULL_SHIFT_NOISE, profile=FRAUD_PROFILE)


def to_long(df: DataFrame, columns: Sequence[str], sample: str, value_type: str = "double") -> DataFrame:
    """(sample, column_name, value) rows for the given columns; NaN counts as null (U4 input)."""
    d = nan_as_null(df.select(*columns), columns).select(*[F.col(c).cast(value_type).alias(c) for c in columns])
    return (d.unpivot([], list(columns), "column_name", "value")
            .select(F.lit(sample).alias("sample"), "column_name", "value"))


def stack(ref_long: DataFrame, cur_long: DataFrame) -> DataFrame:
    """Both samples in one table, tagged (U4)."""
    return ref_long.unionByName(cur_long)


def ks_pvalue(lam: Column) -> Column:
    """Asymptotic Kolmogorov p-value 2 * sum_{k>=1} (-1)^(k-1) exp(-2 k^2 lam^2), clipped to [0, 1].

    For lam < 0.1 the distribution function is 0 to double precision, so p = 1.
    """
    series = F.aggregate(F.sequence(F.lit(1), F.lit(KS_SERIES_TERMS)), F.lit(0.0),
                         lambda acc, k: acc + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
                         * F.exp(F.lit(-2.0) * k * k * lam * lam))
    return F.when(lam.isNull(), F.lit(None)).when(lam < 0.1, F.lit(1.0)).otherwise(
        F.least(F.greatest(F.lit(2.0) * series, F.lit(0.0)), F.lit(1.0)))


EXACT_KS_ROWS = 10_000  # samples of up to this many rows have an exact K-S p-value


def ks_exact(d: float, m: int, n: int) -> float:
    """P(D >= d) of the two-sample K-S statistic for samples of ``m`` and ``n`` rows without ties, exactly.

    Every order of the pooled rows is a lattice path from (0, 0) to (m, n), all equally likely, and D >= d when the path
    leaves the band |i/m - j/n| < d. Paths are counted by the point where they leave it for the first time: the paths
    inside the band to that point times all paths from there. All terms are positive, so small p-values keep
    their digits. One row of the lattice is held at a time, scaled to stay within a double."""
    if m > n:
        m, n = n, m
    g = math.gcd(m, n)
    dm, dn = m // g, n // g
    edge = round(d * dm * n)  # in steps of 1 / lcm(m, n)
    if edge <= 0:
        return 1.0
    fact = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, m + n + 1)))])
    total = fact[m + n] - fact[m] - fact[n]

    def rest(i: int, j: np.ndarray) -> np.ndarray:
        """log of the paths from (i, j) to the end."""
        return fact[m - i + n - j] - fact[m - i] - fact[n - j]

    p, scale = 0.0, 0.0
    inside, first = np.ones(1), 0  # paths to (i, first), (i, first + 1), ... inside the band, over exp(scale)
    for i in range(m + 1):
        low = max(0, -((edge - 1 - i * dn) // dm))  # smallest j with i * dn - j * dm <= edge - 1
        high = min(n, (i * dn + edge - 1) // dm)
        if i:
            out = np.arange(first, min(low, first + len(inside)))  # a step in i leaves the band below
            if len(out):
                p += float(np.sum(inside[:len(out)] * np.exp(scale + rest(i, out) - total)))
            inside, first = inside[len(out):], max(first, low)
        if low > high or not len(inside):
            return min(1.0, p)
        wide = np.zeros(high - first + 1)
        wide[:len(inside)] = inside[:len(wide)]
        inside = np.cumsum(wide)  # steps in j
        if high < n:  # one more step in j leaves the band above
            p += float(inside[-1] * np.exp(scale + rest(i, np.array([high + 1]))[0] - total))
        top = inside.max()
        inside, scale = inside / top, scale + math.log(top)
    return min(1.0, p)


@F.pandas_udf(T.DoubleType())
def ks_exact_pvalue(d: pd.Series, m: pd.Series, n: pd.Series) -> pd.Series:
    """``ks_exact``, one value per column tested (small helper)."""
    return pd.Series([None if pd.isna(x) else ks_exact(float(x), int(a), int(b)) for x, a, b in zip(d, m, n, strict=True)], dtype="float64")


def numeric_tests(long: DataFrame, threshold: float = 0.05, ref_tag: str = "ref", cur_tag: str = "cur",
                  n_buckets: int | None = DEFAULT_BUCKETS, weight_col: str | None = None, exact_ks: bool = False) -> DataFrame:
    """Per numeric column: KS statistic and p-value, normed Wasserstein-1, the chosen test and verdict.

    ``exact_ks``: where the K-S test is the chosen one and the samples have at most ``EXACT_KS_ROWS`` rows, its p-value is
    that of the exact distribution instead of the series. Test choice follows the reference size: at most 1,000 reference rows -> K-S
    (drift when p < threshold), else normed Wasserstein (drift when score >= threshold).
    """
    e = ecdf_diff(long, ref_tag=ref_tag, cur_tag=cur_tag, n_buckets=n_buckets, weight_col=weight_col)
    gap = F.abs(F.col("F_ref") - F.col("F_cur"))
    # one aggregate over the per-value table: KS, Wasserstein-1 and the reference population std
    # (two-pass: the reference mean comes with every row from the prefix-sum totals)
    per = e.groupBy("column_name").agg(
        F.max(gap).alias("ks_stat"), F.sum(gap * F.col("dx")).alias("wasserstein"),
        F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur"),
        F.sqrt(F.try_divide(F.sum(F.col("c_ref") * F.pow(F.col("value") - F.col("mean_ref"), 2)),
                            F.first("n_ref"))).alias("std_ref"))
    n, m = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    lam = F.col("ks_stat") * F.sqrt(n * m / (n + m))
    out = (per.where((F.col("n_ref") > 0) & (F.col("n_cur") > 0))
           .withColumn("ks_pvalue", ks_pvalue(lam))
           .withColumn("wasserstein_normed",
                       F.col("wasserstein") / F.greatest(F.col("std_ref"), F.lit(WASSERSTEIN_MIN_NORM))))
    use_ks = F.col("n_ref") <= SMALL_REFERENCE_ROWS
    if exact_ks:
        small = use_ks & (F.greatest("n_ref", "n_cur") <= EXACT_KS_ROWS)
        out = out.withColumn("ks_pvalue", F.coalesce(ks_exact_pvalue(F.when(small, F.col("ks_stat")), "n_ref", "n_cur"), F.col("ks_pvalue")))
    return out.select(
        "column_name", F.lit("num").alias("column_type"),
        F.when(use_ks, F.lit(KS_NAME)).otherwise(F.lit(WASSERSTEIN_NAME)).alias("stattest_name"),
        F.lit(float(threshold)).alias("stattest_threshold"),
        F.when(use_ks, F.col("ks_pvalue")).otherwise(F.col("wasserstein_normed")).alias("drift_score"),
        F.when(use_ks, F.col("ks_pvalue") < threshold).otherwise(F.col("wasserstein_normed") >= threshold)
        .alias("drift_detected"),
        "n_ref", "n_cur", "ks_stat", "ks_pvalue", "wasserstein", "std_ref", "wasserstein_normed",
    )


def _gammaincc(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularized upper incomplete gamma Q(a, x): series below a + 1, continued fraction above. Near x = a both
    need a few times sqrt(a) steps; a value that has not converged by then is an error, not a result."""
    out = np.full(a.shape, np.nan)
    for i, (ai, xi) in enumerate(zip(a, x)):
        if not (ai > 0) or xi is None or np.isnan(xi) or xi < 0:
            continue
        if xi == 0:
            out[i] = 1.0
            continue
        lg = math.lgamma(ai)
        steps = 1000 + int(100 * math.sqrt(ai))
        if xi < ai + 1:
            term = total = 1.0 / ai
            ap = ai
            for _ in range(steps):
                ap += 1
                term *= xi / ap
                total += term
                if abs(term) < abs(total) * 1e-16:
                    break
            else:
                raise ArithmeticError(f"incomplete gamma({ai}, {xi}) did not converge")
            out[i] = max(0.0, 1.0 - total * math.exp(-xi + ai * math.log(xi) - lg))
        else:
            b = xi + 1 - ai
            c = 1e300
            d = 1 / b
            h = d
            for k in range(1, steps):
                an = -k * (k - ai)
                b += 2
                d = an * d + b
                d = 1e-300 if abs(d) < 1e-300 else d
                c = b + an / c
                c = 1e-300 if abs(c) < 1e-300 else c
                d = 1 / d
                delta = d * c
                h *= delta
                if abs(delta - 1) < 1e-15:
                    break
            else:
                raise ArithmeticError(f"incomplete gamma({ai}, {xi}) did not converge")
            out[i] = math.exp(-xi + ai * math.log(xi) - lg) * h
    return out


@F.pandas_udf(T.DoubleType())
def chi2_sf(stat: pd.Series, dof: pd.Series) -> pd.Series:
    """Chi-squared survival function, one value per column tested (small helper)."""
    a = dof.astype("float64").to_numpy() / 2.0
    x = stat.astype("float64").to_numpy() / 2.0
    return pd.Series(_gammaincc(a, x))


def categorical_tests(long: DataFrame, threshold: float = 0.05, ref_tag: str = "ref",
                      cur_tag: str = "cur") -> DataFrame:
    """Per categorical column: chi-squared goodness of fit of current counts to scaled reference counts.

    expected_c = ref_count_c * n_cur / n_ref over the categories seen in either
    sample; a category absent from the reference but present now means p = 0.
    """
    d = long.where(F.col("value").isNotNull())
    counts = d.groupBy("column_name", "value").agg(
        F.count_if(F.col("sample") == ref_tag).alias("c_ref"), F.count_if(F.col("sample") == cur_tag).alias("c_cur"))
    tot = d.groupBy("column_name").agg(F.count_if(F.col("sample") == ref_tag).alias("n_ref"),
                                       F.count_if(F.col("sample") == cur_tag).alias("n_cur"))
    exp = F.col("c_ref") * F.col("n_cur") / F.col("n_ref")
    per = (counts.join(F.broadcast(tot), "column_name").where((F.col("n_ref") > 0) & (F.col("n_cur") > 0))
           .groupBy("column_name").agg(
               F.sum(F.when(exp > 0, F.pow(F.col("c_cur") - exp, 2) / exp)).alias("chi2_stat"),
               F.count(F.lit(1)).alias("k"),
               F.count_if((exp == 0) & (F.col("c_cur") > 0)).alias("new_categories"),
               F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur")))
    p = F.when(F.col("new_categories") > 0, F.lit(0.0)).when(F.col("k") < 2, F.lit(1.0)).otherwise(
        chi2_sf(F.coalesce(F.col("chi2_stat"), F.lit(0.0)), (F.col("k") - 1).cast("double")))
    return per.select(
        "column_name", F.lit("cat").alias("column_type"), F.lit(CHISQUARE_NAME).alias("stattest_name"),
        F.lit(float(threshold)).alias("stattest_threshold"), p.alias("drift_score"),
        (p < threshold).alias("drift_detected"), "n_ref", "n_cur", "chi2_stat", "k", "new_categories")


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows without a missing value in any of ``columns`` (F5); NaN is missing too."""
    return nan_as_null(df, columns).na.drop(subset=list(columns))


def drift_table(ref: DataFrame, cur: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
                threshold: float = 0.05, n_buckets: int | None = DEFAULT_BUCKETS, whole_rows: bool = False,
                exact_ks: bool = False) -> DataFrame:
    """One row per tested column: column_name, column_type, stattest_name, stattest_threshold,
    drift_score, drift_detected, n_ref, n_cur (R5). Rows with nulls in a column are left out of
    that column's test, or of every test with ``whole_rows`` (F5)."""
    if whole_rows:
        ref, cur = (complete_rows(d, [*numeric, *categorical]) for d in (ref, cur))
    cols = ["column_name", "column_type", "stattest_name", "stattest_threshold", "drift_score",
            "drift_detected", "n_ref", "n_cur"]
    parts = []
    if numeric:
        long = stack(to_long(ref, numeric, "ref"), to_long(cur, numeric, "cur"))
        parts.append(numeric_tests(long, threshold, n_buckets=n_buckets, exact_ks=exact_ks).select(*cols))
    if categorical:
        long_c = stack(to_long(ref, categorical, "ref", "string"), to_long(cur, categorical, "cur", "string"))
        parts.append(categorical_tests(long_c, threshold).select(*cols))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drift_histograms(ref: DataFrame, cur: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Both samples' densities per column on shared equal-width edges of the pooled range.

    Output: column_name, sample, bin, lo, hi, count, density (the report's small distributions).
    """
    return histograms_from_long(stack(to_long(ref, columns, "reference"), to_long(cur, columns, "current")), bins)


def histograms_from_long(long: DataFrame, bins: int = 10, weight_col: str | None = None) -> DataFrame:
    """``drift_histograms`` over a long (sample, column_name, value) table, one row per observation or,
    with ``weight_col``, pre-aggregated rows carrying their count."""
    long = long.where(F.col("value").isNotNull())
    w = F.col(weight_col).cast("long") if weight_col else F.lit(1).cast("long")
    edges = long.groupBy("column_name").agg(F.min("value").alias("mn"), F.max("value").alias("mx"))
    sizes = long.groupBy("column_name", "sample").agg(F.sum(w).alias("n"))
    span = F.col("mx") - F.col("mn")
    pos = F.when(span > 0, F.least(F.floor((F.col("value") - F.col("mn")) / span * bins), F.lit(bins - 1))
                 ).otherwise(F.lit(0)).cast("int")
    counts = (long.join(F.broadcast(edges), "column_name")  # one row per column
              .groupBy("column_name", "sample", pos.alias("bin")).agg(F.sum(w).alias("count")))
    grid = (sizes.join(F.broadcast(edges), "column_name")
            .select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")))
    width = span / F.lit(float(bins))
    out = grid.join(counts, ["column_name", "sample", "bin"], "left").na.fill(0, ["count"])
    return out.select("column_name", "sample", "bin", (F.col("mn") + width * F.col("bin")).alias("lo"),
                      (F.col("mn") + width * (F.col("bin") + 1)).alias("hi"), "count",
                      F.try_divide(F.col("count"), F.col("n") * F.when(width > 0, width)).alias("density"))


def drift_summary(table: DataFrame, share_threshold: float = DATASET_DRIFT_SHARE) -> DataFrame:
    """number_of_columns, number_of_drifted_columns, share_of_drifted_columns, dataset_drift.

    An empty table gives zeros and no dataset drift (R8, R10).
    """
    s = table.agg(F.count(F.lit(1)).alias("number_of_columns"),
                  F.count_if(F.col("drift_detected")).alias("number_of_drifted_columns"))
    share = zero_div(F.col("number_of_drifted_columns").cast("double"), F.col("number_of_columns"))
    return s.select("number_of_columns", "number_of_drifted_columns", share.alias("share_of_drifted_columns"),
                    (share >= share_threshold).alias("dataset_drift"),
                    F.lit(float(share_threshold)).alias("dataset_drift_threshold"))


def sample_warnings(ref: DataFrame, cur: DataFrame, expected: Sequence[str] = (),
                    sizes: DataFrame | None = None) -> DataFrame:
    """One row: n_reference, n_current, warnings array (R7, R8, R9, R10). ``sizes`` may pass the
    one-row (n_reference, n_current) already known, so the samples are not counted again."""
    missing_ref = [c for c in expected if c not in ref.columns]
    missing_cur = [c for c in expected if c not in cur.columns]
    testable = [c for c in expected if c in ref.columns and c in cur.columns]
    if sizes is not None:
        n = sizes.select("n_reference", "n_current")
    else:
        n = ref.agg(F.count(F.lit(1)).alias("n_reference")).withColumn(
            "n_current", cur.agg(F.count(F.lit(1))).scalar())  # the current size as a scalar subquery
    msgs = [
        F.when(F.col("n_current") == 0, F.lit("current sample is empty; drift not computed")),
        F.when((F.col("n_current") > 0) & (F.col("n_current") < MIN_SAMPLE_ROWS),
               F.format_string("current sample has only %d rows (< %d); results may be unreliable",
                               F.col("n_current"), F.lit(MIN_SAMPLE_ROWS))),
        F.when(F.col("n_reference") < MIN_SAMPLE_ROWS,
               F.format_string("reference sample has only %d rows (< %d); results may be unreliable",
                               F.col("n_reference"), F.lit(MIN_SAMPLE_ROWS))),
    ]
    if missing_ref:
        msgs.append(F.lit(f"columns missing from reference: {', '.join(missing_ref)}"))
    if missing_cur:
        msgs.append(F.lit(f"columns missing from current: {', '.join(missing_cur)}"))
    if expected and not testable:
        msgs.append(F.lit("no column in common between reference and current"))
    return n.select("n_reference", "n_current", F.array_compact(F.array(*msgs)).alias("warnings"))


def retrain_decision(summary: DataFrame, threshold: float = RETRAIN_SHARE) -> DataFrame:
    """triggered = share > threshold (strict), with the reason text."""
    share = F.col("share_of_drifted_columns")
    reason = F.format_string(REASON_TEXT, share, F.lit(float(threshold)), F.col("number_of_drifted_columns"))
    return summary.select("*", F.lit(float(threshold)).alias("retrain_threshold"),
                          (share > threshold).alias("triggered"),
                          F.when(share > threshold, reason).alias("reason"))


def trigger_payload(decision: DataFrame, table: DataFrame, warnings: DataFrame, as_of: Column,
                    report_path: Column | None = None) -> DataFrame:
    """The retrain trigger record (R13): triggered, reason, drift_metrics struct (with
    ``report_json_path``, where the report of the check lies; null if none was written), timestamp (ISO UTC).

    Only decisions that fired produce a row (S11).
    """
    scores = table.agg(F.map_from_entries(F.collect_list(F.struct(  # one entry per tested column
        "column_name", F.round("drift_score", 6))))).scalar()
    warn = warnings.select(F.struct("n_current", "warnings")).scalar()
    rec = decision.select("*", scores.alias("feature_drift_scores"), warn["n_current"].alias("n_current"),
                          warn["warnings"].alias("warnings"))
    metrics = F.struct(
        F.col("share_of_drifted_columns").alias("drift_share"), F.col("dataset_drift").alias("dataset_drift_detected"),
        F.col("number_of_drifted_columns").alias("number_of_drifted_features"),
        "feature_drift_scores", (F.lit(None).cast("string") if report_path is None else report_path).alias("report_json_path"),
        F.col("n_current").alias("current_sample_size"), "warnings")
    return rec.where("triggered").select(
        "triggered", "reason", metrics.alias("drift_metrics"),
        F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"))


def inject_shift(df: DataFrame, key: str, seed: int = 99, scale_col: str = "Amount", factor: float = 10.0,
                 overwrite_fraction: float = 0.2, low: float = 1000.0, high: float = 5000.0,
                 noise_cols: Sequence[str] = (), noise_sd: float = 2.0,
                 profile: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Declared shift for drift sensitivity analysis (F8).

    ``profile`` overwrites further columns of the same rows with gaussian values of a (mean, sd) each.
    scale_col *= factor; then exactly floor(n * overwrite_fraction) rows, those
    lowest in md5(seed|key) order, get scale_col = low + (high - low) * u with u
    a uniform taken from the row's md5. Optional gaussian noise (Box-Muller over two
    such uniforms) depends on the key alone, so it is the same on every partitioning.
    """
    r = stratified_rank(df.withColumn("_all", F.lit(0)), ["_all"], [key], seed)

    def uniform(name: str) -> Column:
        digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(name), F.col(key).cast("string")))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(16 ** 8))

    def normal(name: str) -> Column:
        radius = F.sqrt(F.lit(-2.0) * F.log(uniform(f"{name}|r") + F.lit(0.5 / 16 ** 8)))  # never the log of 0
        return radius * F.cos(F.lit(2 * math.pi) * uniform(f"{name}|a"))

    u = uniform("u")
    hit = F.col("stratum_rank") <= F.floor(F.col("stratum_n") * F.lit(overwrite_fraction))
    out = r.withColumn("_hit", hit).withColumn(scale_col, F.when(hit, F.lit(low) + F.lit(high - low) * u)
                                               .otherwise(F.col(scale_col) * F.lit(factor)))
    for c in noise_cols:
        out = out.withColumn(c, F.col(c) + normal(c) * F.lit(noise_sd))
    for c, (mean, sd) in (profile or {}).items():  # overwritten after the noise
        out = out.withColumn(c, F.when(F.col("_hit"), F.lit(float(mean)) + normal(f"{c}|profile") * F.lit(float(sd))).otherwise(F.col(c)))
    return out.drop("_all", "_order", "_hit", "stratum_rank", "stratum_n")


def scores_by_name(table: DataFrame) -> DataFrame:
    """column_name, drift_score, ordered by name (D5); one row per column."""
    return table.select("column_name", "drift_score").orderBy("column_name")


def compare_runs(before: DataFrame, after: DataFrame) -> DataFrame:
    """Before / after drift scores per column, full outer by name; highlight = after > 2 * before."""
    b = before.select("column_name", F.col("drift_score").alias("before_score"))
    a = after.select("column_name", F.col("drift_score").alias("after_score"))
    return b.join(a, "column_name", "full_outer").withColumn(
        "highlight", F.coalesce(F.col("after_score"), F.lit(0.0)) > F.coalesce(F.col("before_score"), F.lit(0.0)) * 2)
