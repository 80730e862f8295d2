"""The monitoring job: newest predictions against the reference -> drift table -> summary -> decision
-> report and trigger (R5-R14, S9, S11). Every step is a lazy DataFrame; one action writes the report."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drift as dr
from ..operators.common import materialize
from ..sources import logs

TABLE_COLUMNS = ["column_name", "column_type", "stattest_name", "stattest_threshold", "drift_score",
                 "drift_detected", "n_ref", "n_cur"]


@dataclass
class DriftResult:
    table: DataFrame
    summary: DataFrame
    warnings: DataFrame
    decision: DataFrame
    histograms: DataFrame


def normalise_names(df: DataFrame, canonical: Sequence[str]) -> DataFrame:
    """Case-insensitive column names mapped to their canonical spelling."""
    canon = {c.lower(): c for c in canonical}
    return df.toDF(*[canon.get(c.lower(), c) for c in df.columns])


def drift_check(ref: DataFrame, cur: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
                threshold: float = 0.05, retrain_threshold: float = dr.RETRAIN_SHARE,
                bins: int = 10, whole_rows: bool = False, exact_ks: bool = False) -> DriftResult:
    """R5 -> R6 -> R7..R10 -> R12 over the columns both samples have (P5, U3). ``whole_rows``: rows with a null in any
    tested column are left out before the tests (F5), as the scheduled job does; ``exact_ks``: see ``numeric_tests``."""
    expected = list(numeric) + list(categorical)
    ref = normalise_names(ref, expected)
    cur = normalise_names(cur, expected)
    num = [c for c in numeric if c in ref.columns and c in cur.columns]
    cat = [c for c in categorical if c in ref.columns and c in cur.columns]
    if (num or cat) and whole_rows:
        ref, cur = dr.complete_rows(ref, num + cat), dr.complete_rows(cur, num + cat)
    if num or cat:
        parts, hist, sizes = [], None, None
        if num:
            # one scan of both samples: weighted (sample, column, value) counts, checkpointed, feed the
            # tests, the histograms and the sample sizes
            long = dr.stack(dr.to_long(ref, num, "ref"), dr.to_long(cur, num, "cur"))
            agg = materialize(long.groupBy("sample", "column_name", "value").agg(F.count(F.lit(1)).alias("_w")))
            tests, hist, sizes = _numeric_parts(agg, num, threshold, bins, exact_ks)
            parts.append(tests)
        if cat:
            parts.append(dr.drift_table(ref, cur, [], cat, threshold))
        table = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        warnings = dr.sample_warnings(ref, cur, expected, sizes)
    else:
        warnings = dr.sample_warnings(ref, cur, expected)
        spark = ref.sparkSession
        table = spark.createDataFrame([], "column_name string, column_type string, stattest_name string, "
                                          "stattest_threshold double, drift_score double, drift_detected boolean, "
                                          "n_ref long, n_cur long")
        hist = None
    if hist is None:
        hist = ref.sparkSession.createDataFrame([], "column_name string, sample string, bin int, lo double, "
                                                    "hi double, count long, density double")
    summary = dr.drift_summary(table)
    decision = dr.retrain_decision(summary, retrain_threshold)
    return DriftResult(table, summary, warnings, decision, hist)


def _numeric_parts(agg: DataFrame, num: Sequence[str], threshold: float, bins: int, exact_ks: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tests, histograms and sample sizes from (sample, column_name, value, _w) counts of "ref" and "cur"."""
    tests = dr.numeric_tests(agg, threshold, weight_col="_w", exact_ks=exact_ks).select(*TABLE_COLUMNS)
    tagged = agg.withColumn("sample", F.when(F.col("sample") == "ref", F.lit("reference"))
                            .otherwise(F.lit("current")))
    first = agg.where(F.col("column_name") == num[0])  # every row of a sample has each column
    sizes = first.agg(
        F.coalesce(F.sum(F.when(F.col("sample") == "ref", F.col("_w")).otherwise(0)), F.lit(0)).alias("n_reference"),
        F.coalesce(F.sum(F.when(F.col("sample") == "cur", F.col("_w")).otherwise(0)), F.lit(0)).alias("n_current"))
    return tests, dr.histograms_from_long(tagged, bins, "_w"), sizes


def drift_check_counts(counts: DataFrame, numeric: Sequence[str], threshold: float = 0.05,
                       retrain_threshold: float = dr.RETRAIN_SHARE, bins: int = 10, exact_ks: bool = False) -> DriftResult:
    """``drift_check`` of samples that are counted already: ``counts`` has (sample, column_name, value, _w), with the
    samples "ref" and "cur" and a row for null values too."""
    agg = materialize(counts.select("sample", "column_name", "value", "_w"))
    table, hist, sizes = _numeric_parts(agg, list(numeric), threshold, bins, exact_ks)
    layout = counts.sparkSession.createDataFrame([], ", ".join(f"`{c}` double" for c in numeric))
    summary = dr.drift_summary(table)
    return DriftResult(table, summary, dr.sample_warnings(layout, layout, list(numeric), sizes),
                       dr.retrain_decision(summary, retrain_threshold), hist)


def newest(df: DataFrame, n: int, ts: str = "timestamp", key: str = "prediction_id") -> DataFrame:
    """The monitor's current sample: the newest n rows (a top-k by design, S8)."""
    return df.orderBy(F.desc(ts), F.asc(key)).limit(n)


def run_monitor(spark: SparkSession, ref: DataFrame, log: DataFrame, numeric: Sequence[str], n_recent: int,
                report_path: str, trigger_path: str, as_of: Column | None = None,
                threshold: float = 0.05, retrain_threshold: float = dr.RETRAIN_SHARE,
                since: Column | None = None, ts: str = "timestamp") -> DataFrame:
    """One scheduled check (T6 body): returns the one-row decision; writes the report, and the trigger
    when it fires. A failure becomes a row (triggered = false, error) instead of an exception (R14).

    ``since`` bounds the log scan (``ts >= since`` is pushed into the Parquet scan); without it the
    newest-n selection is a top-k over the whole log (each task keeps its local top n).
    """
    as_of = as_of if as_of is not None else F.current_timestamp()

    def check() -> DriftResult:
        recent_log = log.where(F.col(ts) >= since) if since is not None else log
        return drift_check(ref, newest(recent_log, n_recent, ts), numeric, (), threshold, retrain_threshold,
                           whole_rows=True, exact_ks=True)

    return recorded(spark, check, report_path, trigger_path, as_of)


def recorded(spark: SparkSession, check: Callable[[], DriftResult], report_path: str, trigger_path: str, as_of: Column) -> DataFrame:
    """Run ``check``, write its report and, when it fires, the trigger, which names the report; the one-row decision.
    What goes wrong with the data or the store is a row too (R14); an error of the program itself is raised."""
    try:
        res = check()
        report = logs.report_rows(res.table, res.summary, res.histograms, as_of)
        logs.write_report(report, report_path)
        at = F.concat(F.lit(f"{report_path.rstrip('/')}/run_ts="), F.date_format(as_of, "yyyyMMdd'T'HHmmss'Z'"))
        payload = dr.trigger_payload(res.decision, res.table, res.warnings, as_of, at)
        logs.write_trigger(payload, trigger_path)
        return res.decision.withColumn("error", F.lit(None).cast("string"))
    except (TypeError, AttributeError, NameError):
        raise
    except Exception as exc:  # noqa: BLE001 - the decision records the failure
        return spark.createDataFrame([(False, f"{type(exc).__name__}: {exc}")], "triggered boolean, error string")
