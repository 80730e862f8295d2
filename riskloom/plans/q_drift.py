"""Registered drift queries: numeric drift table (K-S and normed Wasserstein), chi-squared statistic,
histograms, summary, retrain decision, shift injection, before / after comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as dr
from ..sources import fixtures as fx
from .registry import query
from .registry import round_cols as _r

THRESHOLD = 0.05
TX_NUM = ["Amount", "Time"]
FEAT_NUM = [f"V{i}" for i in range(1, 29)] + ["Amount"]


def long_sql(ref: str, cur: str, cols, value_type: str = "DOUBLE") -> str:
    parts = [f"SELECT '{s}' AS sample, '{c}' AS column_name, CAST(\"{c}\" AS {value_type}) AS value FROM {v}"
             for s, v in (("ref", ref), ("cur", cur)) for c in cols]
    return " UNION ALL ".join(parts)


def numeric_drift_sql(ref: str, cur: str, cols, threshold: float = THRESHOLD, pre: str = "") -> str:
    """CTE chain ending in `{pre}dt`: the numeric drift table as the oracle states it."""
    return f"""{pre}lng AS ({long_sql(ref, cur, cols)}),
{pre}cnt AS (SELECT column_name, value, count_if(sample = 'ref') AS c_ref, count_if(sample = 'cur') AS c_cur
        FROM {pre}lng WHERE value IS NOT NULL GROUP BY 1, 2),
{pre}tot AS (SELECT column_name, count_if(sample = 'ref') AS n_ref, count_if(sample = 'cur') AS n_cur
        FROM {pre}lng WHERE value IS NOT NULL GROUP BY 1),
{pre}e AS (SELECT c.column_name, value,
             sum(c_ref) OVER w / n_ref AS f_ref, sum(c_cur) OVER w / n_cur AS f_cur,
             coalesce(lead(value) OVER (PARTITION BY c.column_name ORDER BY value) - value, 0.0) AS dx
      FROM {pre}cnt c JOIN {pre}tot USING (column_name)
      WINDOW w AS (PARTITION BY c.column_name ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{pre}per AS (SELECT column_name, max(abs(f_ref - f_cur)) AS ks_stat, sum(abs(f_ref - f_cur) * dx) AS w1
        FROM {pre}e GROUP BY 1),
{pre}sd AS (SELECT column_name, stddev_pop(value) AS std_ref FROM {pre}lng
        WHERE sample = 'ref' AND value IS NOT NULL GROUP BY 1),
{pre}x AS (SELECT p.*, n_ref, n_cur, std_ref,
             ks_stat * sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) AS lam,
             w1 / greatest(std_ref, 0.001) AS wn
      FROM {pre}per p JOIN {pre}tot USING (column_name) LEFT JOIN {pre}sd USING (column_name)
      WHERE n_ref > 0 AND n_cur > 0),
{pre}kp AS (SELECT column_name,
              CASE WHEN any_value(lam) < 0.1 THEN 1.0
                   ELSE least(greatest(2.0 * sum(CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END
                                               * exp(-2.0 * k * k * lam * lam)), 0.0), 1.0) END AS p
       FROM {pre}x, range(1, 101) t(k) GROUP BY column_name),
{pre}dt AS (SELECT column_name, 'num' AS column_type,
              CASE WHEN n_ref <= 1000 THEN '{dr.KS_NAME}' ELSE '{dr.WASSERSTEIN_NAME}' END AS stattest_name,
              CAST({threshold} AS DOUBLE) AS stattest_threshold,
              CASE WHEN n_ref <= 1000 THEN p ELSE wn END AS drift_score,
              CASE WHEN n_ref <= 1000 THEN p < {threshold} ELSE wn >= {threshold} END AS drift_detected,
              CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, ks_stat, p AS ks_pvalue, w1, std_ref, wn
       FROM {pre}x JOIN {pre}kp USING (column_name))"""


def _table_out(df):
    return _r(df.select("column_name", "column_type", "stattest_name", "stattest_threshold", "drift_score",
                        "drift_detected", "n_ref", "n_cur"), ["drift_score"])


_DT_COLS = """column_name, column_type, stattest_name, stattest_threshold, round(drift_score, 6) AS drift_score,
       drift_detected, n_ref, n_cur"""


@query("r2_r5_drift_table", f"""WITH {numeric_drift_sql('ref', 'cur', TX_NUM)}
SELECT {_DT_COLS} FROM dt""", ("ref", "cur"))
def r2_r5_drift_table(spark, sf):
    ref, cur = fx.ref_cur(spark, sf)
    return _table_out(dr.drift_table(ref, cur, TX_NUM, threshold=THRESHOLD))


@query("r1_ks_statistics", f"""WITH {numeric_drift_sql('fref', 'fcur', FEAT_NUM)}
SELECT column_name, n_ref, n_cur, round(ks_stat, 6) AS ks_stat, round(ks_pvalue, 6) AS ks_pvalue,
       round(w1, 6) AS wasserstein, round(wn, 6) AS wasserstein_normed FROM dt""", ("fref", "fcur"))
def r1_ks_statistics(spark, sf):
    ref, cur = fx.feat_ref_cur(spark, sf)
    long = dr.stack(dr.to_long(ref, FEAT_NUM, "ref"), dr.to_long(cur, FEAT_NUM, "cur"))
    t = dr.numeric_tests(long, THRESHOLD)
    return _r(t.select("column_name", "n_ref", "n_cur", "ks_stat", "ks_pvalue", "wasserstein", "wasserstein_normed"),
              ["ks_stat", "ks_pvalue", "wasserstein", "wasserstein_normed"])


@query("r16_vector_drift_table", f"""WITH {numeric_drift_sql('fref', 'fcur', FEAT_NUM)}
SELECT {_DT_COLS} FROM dt""", ("fref", "fcur"))
def r16_vector_drift_table(spark, sf):
    ref, cur = fx.feat_ref_cur(spark, sf)
    return _table_out(dr.drift_table(ref, cur, FEAT_NUM, threshold=THRESHOLD))


@query("r3_chisquare_statistic", f"""
WITH lng AS ({long_sql('refe', 'cure', ['event_type'], 'VARCHAR')}),
cnt AS (SELECT column_name, value, count_if(sample = 'ref') AS c_ref, count_if(sample = 'cur') AS c_cur
        FROM lng WHERE value IS NOT NULL GROUP BY 1, 2),
tot AS (SELECT column_name, count_if(sample = 'ref') AS n_ref, count_if(sample = 'cur') AS n_cur
        FROM lng WHERE value IS NOT NULL GROUP BY 1),
j AS (SELECT cnt.*, n_ref, n_cur, c_ref * n_cur / n_ref AS ex FROM cnt JOIN tot USING (column_name))
SELECT column_name, round(sum(CASE WHEN ex > 0 THEN pow(c_cur - ex, 2) / ex END), 6) AS chi2_stat,
       CAST(count(*) AS BIGINT) AS k, CAST(count_if(ex = 0 AND c_cur > 0) AS BIGINT) AS new_categories,
       CAST(any_value(n_ref) AS BIGINT) AS n_ref, CAST(any_value(n_cur) AS BIGINT) AS n_cur
FROM j GROUP BY column_name""", ("refe", "cure"))
def r3_chisquare_statistic(spark, sf):
    ref, cur = fx.ref_cur(spark, sf, fx.tx_typed(spark, sf))
    long = dr.stack(dr.to_long(ref, ["event_type"], "ref", "string"), dr.to_long(cur, ["event_type"], "cur", "string"))
    t = dr.categorical_tests(long, THRESHOLD)
    return _r(t.select("column_name", "chi2_stat", "k", "new_categories", "n_ref", "n_cur"), ["chi2_stat"])


def _chi2_sql(ref: str, cur: str, cols, threshold: float = THRESHOLD) -> str:
    """CTE chain ending in `ct`: the categorical rows of the drift table. The chi-squared survival
    function is written in closed form for an even number of degrees of freedom,
    exp(-x/2) * sum_{i < dof/2} (x/2)^i / i!; an odd count gives null (no such column here)."""
    return f"""clng AS ({long_sql(ref, cur, cols, 'VARCHAR')}),
ccnt AS (SELECT column_name, value, count_if(sample = 'ref') AS c_ref, count_if(sample = 'cur') AS c_cur
         FROM clng WHERE value IS NOT NULL GROUP BY 1, 2),
ctot AS (SELECT column_name, count_if(sample = 'ref') AS n_ref, count_if(sample = 'cur') AS n_cur
         FROM clng WHERE value IS NOT NULL GROUP BY 1),
cj AS (SELECT ccnt.*, n_ref, n_cur, c_ref * n_cur / n_ref AS ex FROM ccnt JOIN ctot USING (column_name)
       WHERE n_ref > 0 AND n_cur > 0),
cst AS (SELECT column_name, coalesce(sum(CASE WHEN ex > 0 THEN pow(c_cur - ex, 2) / ex END), 0.0) AS x,
               count(*) AS k, count_if(ex = 0 AND c_cur > 0) AS new_cats,
               any_value(n_ref) AS n_ref, any_value(n_cur) AS n_cur FROM cj GROUP BY column_name),
cp AS (SELECT column_name, CASE WHEN new_cats > 0 THEN 0.0 WHEN k < 2 THEN 1.0
                                WHEN (k - 1) % 2 = 0 THEN exp(-x / 2) * sum(pow(x / 2, i) / factorial(CAST(i AS INTEGER)))
                           END AS p
       FROM cst, range(0, 200) t(i) WHERE i < greatest((k - 1) / 2, 1) GROUP BY column_name, x, k, new_cats),
ct AS (SELECT column_name, 'cat' AS column_type, '{dr.CHISQUARE_NAME}' AS stattest_name,
              CAST({threshold} AS DOUBLE) AS stattest_threshold, p AS drift_score, p < {threshold} AS drift_detected,
              CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur FROM cst JOIN cp USING (column_name))"""


@query("r5_drift_table_mixed", f"""WITH {numeric_drift_sql('refe', 'cure', TX_NUM)}, {_chi2_sql('refe', 'cure', ['event_type'])}
SELECT {_DT_COLS} FROM dt UNION ALL SELECT {_DT_COLS} FROM ct""", ("refe", "cure"))
def r5_drift_table_mixed(spark, sf):
    """Numeric and categorical columns in one table (K-S / Wasserstein and chi-squared)."""
    ref, cur = fx.ref_cur(spark, sf, fx.tx_typed(spark, sf))
    return _table_out(dr.drift_table(ref, cur, TX_NUM, ["event_type"], threshold=THRESHOLD))


@query("r5_drift_histograms", f"""
WITH lng AS ({long_sql('ref', 'cur', TX_NUM)}),
l2 AS (SELECT CASE WHEN sample = 'ref' THEN 'reference' ELSE 'current' END AS sample, column_name, value
       FROM lng WHERE value IS NOT NULL),
ed AS (SELECT column_name, min(value) AS mn, max(value) AS mx FROM l2 GROUP BY 1),
sz AS (SELECT column_name, sample, count(*) AS n FROM l2 GROUP BY 1, 2),
c AS (SELECT column_name, sample,
             CAST(CASE WHEN mx - mn > 0 THEN least(floor((value - mn) / (mx - mn) * 10), 9) ELSE 0 END AS INTEGER) AS bin,
             count(*) AS cnt FROM l2 JOIN ed USING (column_name) GROUP BY 1, 2, 3),
g AS (SELECT sz.column_name, sample, n, mn, mx, CAST(b AS INTEGER) AS bin FROM sz JOIN ed USING (column_name), range(0, 10) t(b))
SELECT g.column_name, g.sample, g.bin, round(mn + (mx - mn) / 10.0 * g.bin, 6) AS lo,
       round(mn + (mx - mn) / 10.0 * (g.bin + 1), 6) AS hi, CAST(coalesce(cnt, 0) AS BIGINT) AS count,
       round(coalesce(cnt, 0) / (n * CASE WHEN (mx - mn) / 10.0 > 0 THEN (mx - mn) / 10.0 END), 9) AS density
FROM g LEFT JOIN c ON g.column_name = c.column_name AND g.sample = c.sample AND g.bin = c.bin""", ("ref", "cur"))
def r5_drift_histograms(spark, sf):
    ref, cur = fx.ref_cur(spark, sf)
    return _r(_r(dr.drift_histograms(ref, cur, TX_NUM, 10), ["lo", "hi"]), ["density"], 9)


_SUMMARY = """number_of_columns, number_of_drifted_columns, round(share_of_drifted_columns, 6) AS share_of_drifted_columns,
       dataset_drift, dataset_drift_threshold"""


def summary_sql(table: str = "dt") -> str:
    return f"""sm AS (SELECT CAST(count(*) AS BIGINT) AS number_of_columns,
                 CAST(coalesce(count_if(drift_detected), 0) AS BIGINT) AS number_of_drifted_columns,
                 CASE WHEN count(*) = 0 THEN 0.0 ELSE coalesce(count_if(drift_detected), 0) / count(*) END AS share_of_drifted_columns,
                 CASE WHEN count(*) = 0 THEN 0.0 ELSE coalesce(count_if(drift_detected), 0) / count(*) END >= 0.5 AS dataset_drift,
                 CAST(0.5 AS DOUBLE) AS dataset_drift_threshold FROM {table})"""


@query("r6_drift_summary", f"""WITH {numeric_drift_sql('fref', 'fcur', FEAT_NUM)}, {summary_sql()}
SELECT {_SUMMARY} FROM sm""", ("fref", "fcur"))
def r6_drift_summary(spark, sf):
    ref, cur = fx.feat_ref_cur(spark, sf)
    return _r(dr.drift_summary(dr.drift_table(ref, cur, FEAT_NUM, threshold=THRESHOLD)), ["share_of_drifted_columns"])


@query("r12_retrain_decision", f"""WITH {numeric_drift_sql('fref', 'fcur', FEAT_NUM)}, {summary_sql()}
SELECT {_SUMMARY}, CAST(0.3 AS DOUBLE) AS retrain_threshold, share_of_drifted_columns > 0.3 AS triggered,
       CASE WHEN share_of_drifted_columns > 0.3 THEN
         printf('{dr.REASON_TEXT}',
                share_of_drifted_columns, 0.3, number_of_drifted_columns) END AS reason
FROM sm""", ("fref", "fcur"))
def r12_retrain_decision(spark, sf):
    ref, cur = fx.feat_ref_cur(spark, sf)
    d = dr.retrain_decision(dr.drift_summary(dr.drift_table(ref, cur, FEAT_NUM, threshold=THRESHOLD)))
    return _r(d, ["share_of_drifted_columns"])


@query("r7_sample_warnings", """
WITH n AS (SELECT (SELECT CAST(count(*) AS BIGINT) FROM ref) AS n_reference,
                  (SELECT CAST(count(*) AS BIGINT) FROM (SELECT * FROM cur ORDER BY ts DESC, tx_id LIMIT 20) c) AS n_current)
SELECT n_reference, n_current, list_filter([
  CASE WHEN n_current = 0 THEN 'current sample is empty; drift not computed' END,
  CASE WHEN n_current > 0 AND n_current < 30 THEN printf('current sample has only %d rows (< %d); results may be unreliable', n_current, 30) END,
  CASE WHEN n_reference < 30 THEN printf('reference sample has only %d rows (< %d); results may be unreliable', n_reference, 30) END
], lambda x: x IS NOT NULL) AS warnings FROM n""", ("ref", "cur"))
def r7_sample_warnings(spark, sf):
    """Warnings for a current sample of the newest 20 rows (a top-k by design: the monitor's newest-n window)."""
    ref, cur = fx.ref_cur(spark, sf)
    return dr.sample_warnings(ref, cur.orderBy(F.desc("ts"), "tx_id").limit(20), TX_NUM)


@query("f8_inject_shift", """
WITH r AS (SELECT tx_id, "Amount",
                  row_number() OVER (ORDER BY md5(concat_ws('|', '99', CAST(tx_id AS VARCHAR))), tx_id) AS rk,
                  count(*) OVER () AS n FROM cur)
SELECT tx_id, round(CASE WHEN rk <= floor(n * CAST(0.2 AS DOUBLE))
  THEN 1000.0 + 4000.0 * CAST(CAST('0x' || substr(md5(concat_ws('|', '99', 'u', CAST(tx_id AS VARCHAR))), 1, 8) AS UBIGINT) AS DOUBLE) / 4294967296.0
  ELSE "Amount" * 10.0 END, 6) AS "Amount" FROM r""", ("cur",))
def f8_inject_shift(spark, sf):
    _, cur = fx.ref_cur(spark, sf)
    s = dr.inject_shift(cur.select("tx_id", "Amount"), "tx_id", seed=99)
    return _r(s, ["Amount"])


def _shifted_sql():
    return """shifted AS (
  SELECT * EXCLUDE ("Amount", rk, n), CASE WHEN rk <= floor(n * CAST(0.2 AS DOUBLE))
    THEN 1000.0 + 4000.0 * CAST(CAST('0x' || substr(md5(concat_ws('|', '99', 'u', CAST(tx_id AS VARCHAR))), 1, 8) AS UBIGINT) AS DOUBLE) / 4294967296.0
    ELSE "Amount" * 10.0 END AS "Amount"
  FROM (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '99', CAST(tx_id AS VARCHAR))), tx_id) AS rk,
               count(*) OVER () AS n FROM cur) r)"""


@query("r15_before_after", f"""WITH {numeric_drift_sql('ref', 'cur', TX_NUM, pre='b_')}, {_shifted_sql()},
{numeric_drift_sql('ref', 'shifted', TX_NUM, pre='a_')}
SELECT coalesce(b.column_name, a.column_name) AS column_name, round(b.drift_score, 6) AS before_score,
       round(a.drift_score, 6) AS after_score, coalesce(a.drift_score, 0.0) > coalesce(b.drift_score, 0.0) * 2 AS highlight
FROM b_dt b FULL OUTER JOIN a_dt a ON b.column_name = a.column_name""", ("ref", "cur"))
def r15_before_after(spark, sf):
    """Drift of the current sample before and after the declared shift, side by side."""
    ref, cur = fx.ref_cur(spark, sf)
    before = dr.drift_table(ref, cur, TX_NUM, threshold=THRESHOLD)
    shifted = dr.inject_shift(cur, "tx_id", seed=99)
    after = dr.drift_table(ref, shifted, TX_NUM, threshold=THRESHOLD)
    return _r(dr.compare_runs(before, after), ["before_score", "after_score"])


@query("r11_prediction_drift", f"""WITH {numeric_drift_sql('pref', 'pcur', ['fraud_probability'])}
SELECT {_DT_COLS} FROM dt""", ("pref", "pcur"))
def r11_prediction_drift(spark, sf):
    p = fx.pred(spark, sf)
    cut = F.lit(fx.DRIFT_SPLIT_TS).cast("timestamp_ntz")
    ref, cur = p.where(F.col("timestamp") < cut), p.where(F.col("timestamp") >= cut)
    return _table_out(dr.drift_table(ref, cur, ["fraud_probability"], threshold=THRESHOLD))
