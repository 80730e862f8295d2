"""Registered evaluation queries: confusion, rates, exact AUC / AP, curves, sweep, rollups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..sources import fixtures as fx
from .registry import query
from .registry import round_cols as _r6

# Fixed query parameters.
THRESHOLD = 0.25
SWEEP = [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5]
LAST_N = 100


_SC = """sc AS (SELECT p, count_if("Class" = 1) AS pos, count_if("Class" <> 1) AS neg
             FROM scored WHERE p IS NOT NULL GROUP BY p),
cc AS (SELECT p, pos, neg,
         sum(pos) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
         sum(neg) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM sc),
tot AS (SELECT sum(pos) AS n_pos, sum(neg) AS n_neg FROM sc)"""


@query("a14_last_n_rollup", """
SELECT CAST(count(*) AS BIGINT) AS count,
       round(avg(CAST(is_fraud AS INTEGER)), 4) AS fraud_rate,
       round(avg(fraud_probability), 4) AS avg_probability
FROM (SELECT * FROM pred ORDER BY "timestamp" DESC, prediction_id ASC LIMIT 100) t""", ("pred",))
def a14_last_n_rollup(spark, sf):
    return ev.last_n_rollup(fx.pred(spark, sf), LAST_N)


@query("s8_recent_predictions", """
SELECT prediction_id, "timestamp", amount, round(fraud_probability, 6) AS fraud_probability, is_fraud, model_version
FROM pred ORDER BY "timestamp" DESC, prediction_id ASC LIMIT 100""", ("pred",))
def s8_recent_predictions(spark, sf):
    return _r6(ev.last_n(fx.pred(spark, sf), LAST_N), ["fraud_probability"])


@query("a7_confusion", """
SELECT CAST(count_if("Class" <> 1 AND p < 0.25) AS BIGINT) AS tn, CAST(count_if("Class" <> 1 AND p >= 0.25) AS BIGINT) AS fp,
       CAST(count_if("Class" = 1 AND p < 0.25) AS BIGINT) AS fn, CAST(count_if("Class" = 1 AND p >= 0.25) AS BIGINT) AS tp
FROM scored""", ("scored",))
def a7_confusion(spark, sf):
    return ev.confusion(fx.scored(spark, sf), "Class", "p", THRESHOLD)


@query("a8_precision_recall_f1", """
WITH c AS (SELECT count_if("Class" <> 1 AND p >= 0.25) AS fp, count_if("Class" = 1 AND p < 0.25) AS fn,
                  count_if("Class" = 1 AND p >= 0.25) AS tp FROM scored)
SELECT round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1
FROM c""", ("scored",))
def a8_precision_recall_f1(spark, sf):
    r = ev.with_rates(ev.confusion(fx.scored(spark, sf), "Class", "p", THRESHOLD))
    return _r6(r.select("precision", "recall", "f1"), ["precision", "recall", "f1"])


@query("a9_a10_auc_ap", f"""
WITH {_SC}
SELECT round(CASE WHEN n_pos > 0 AND n_neg > 0 THEN (SELECT sum(neg * (tp - pos / 2.0)) FROM cc) / (n_pos * n_neg) END, 6) AS roc_auc,
       round(CASE WHEN n_pos > 0 THEN (SELECT sum(pos * tp / (tp + fp)) FROM cc) / n_pos END, 6) AS average_precision
FROM tot""", ("scored",))
def a9_a10_auc_ap(spark, sf):
    return _r6(ev.auc_ap(fx.scored(spark, sf), "Class", "p"), ["roc_auc", "average_precision"])


@query("a11_roc_curve", f"""
WITH {_SC}
SELECT p AS threshold, round(fp / n_neg, 6) AS fpr, round(tp / n_pos, 6) AS tpr FROM cc, tot
UNION ALL SELECT NULL, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM tot""", ("scored",))
def a11_roc_curve(spark, sf):
    return _r6(ev.roc_curve(fx.scored(spark, sf), "Class", "p", ends=True), ["fpr", "tpr"])


@query("a11_roc_curve_thinned", f"""
WITH {_SC},
nb AS (SELECT p, tp, fp, lag(tp) OVER (ORDER BY p DESC) AS tp_prev, lead(tp) OVER (ORDER BY p DESC) AS tp_next,
              lag(fp) OVER (ORDER BY p DESC) AS fp_prev, lead(fp) OVER (ORDER BY p DESC) AS fp_next FROM cc)
SELECT p AS threshold, round(fp / n_neg, 6) AS fpr, round(tp / n_pos, 6) AS tpr FROM nb, tot
WHERE tp_prev IS NULL OR tp_next IS NULL OR fp_next - 2 * fp + fp_prev <> 0 OR tp_next - 2 * tp + tp_prev <> 0""",
       ("scored",))
def a11_roc_curve_thinned(spark, sf):
    return _r6(ev.roc_curve_thinned(fx.scored(spark, sf), "Class", "p"), ["fpr", "tpr"])


@query("a12_pr_curve", f"""
WITH {_SC}
SELECT p AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / n_pos, 6) AS recall,
       round(n_pos / (n_pos + n_neg), 6) AS baseline FROM cc, tot
UNION ALL SELECT NULL, CAST(1 AS DOUBLE), CAST(0 AS DOUBLE), round(n_pos / (n_pos + n_neg), 6) FROM tot""", ("scored",))
def a12_pr_curve(spark, sf):
    return _r6(ev.pr_curve(fx.scored(spark, sf), "Class", "p", ends=True), ["precision", "recall", "baseline"])


_SWEEP_SQL = ", ".join(f"({t})" for t in SWEEP)


@query("a13_threshold_sweep", f"""
WITH th(threshold) AS (VALUES {_SWEEP_SQL}),
c AS (SELECT CAST(th.threshold AS DOUBLE) AS threshold,
         count_if(s."Class" <> 1 AND s.p < th.threshold) AS tn, count_if(s."Class" <> 1 AND s.p >= th.threshold) AS fp,
         count_if(s."Class" = 1 AND s.p < th.threshold) AS fn, count_if(s."Class" = 1 AND s.p >= th.threshold) AS tp
      FROM th, scored s GROUP BY th.threshold)
SELECT threshold, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp,
       round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1
FROM c""", ("scored",))
def a13_threshold_sweep(spark, sf):
    r = ev.threshold_sweep(fx.scored(spark, sf), SWEEP, "Class", "p")
    return _r6(r, ["precision", "recall", "f1"])


@query("m8_evaluate", f"""
WITH {_SC},
b AS (SELECT count(*) AS n, count_if("Class" = 1) AS positives, avg(CAST("Class" AS DOUBLE)) AS prevalence,
             count_if("Class" <> 1 AND p < 0.25) AS tn, count_if("Class" <> 1 AND p >= 0.25) AS fp,
             count_if("Class" = 1 AND p < 0.25) AS fn, count_if("Class" = 1 AND p >= 0.25) AS tp FROM scored),
m AS (SELECT CASE WHEN n_pos > 0 AND n_neg > 0 THEN (SELECT sum(neg * (tp - pos / 2.0)) FROM cc) / (n_pos * n_neg) END AS auc,
             CASE WHEN n_pos > 0 THEN (SELECT sum(pos * tp / (tp + fp)) FROM cc) / n_pos END AS ap FROM tot)
SELECT CAST(n AS BIGINT) AS n, CAST(positives AS BIGINT) AS positives, round(prevalence, 6) AS prevalence,
       round(auc, 6) AS roc_auc, round(ap, 6) AS average_precision,
       CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp,
       round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1,
       CAST(0.25 AS DOUBLE) AS threshold, round(ap / prevalence, 6) AS improvement_over_random,
       'scored-v1' AS model_version, 'fixture:scored' AS path
FROM b, m""", ("scored",))
def m8_evaluate(spark, sf):
    r = ev.evaluate(fx.scored(spark, sf), "Class", "p", THRESHOLD, model_version="scored-v1", path="fixture:scored")
    return _r6(r, ["prevalence", "roc_auc", "average_precision", "precision", "recall", "f1",
                   "improvement_over_random"])


def _metrics_sql(score: str, pre: str) -> str:
    """CTE chain ending in `{pre}m`: the metric row of the scored view for one score expression."""
    return f"""{pre}s AS (SELECT "Class", {score} AS p FROM scored),
{pre}sc AS (SELECT p, count_if("Class" = 1) AS pos, count_if("Class" <> 1) AS neg FROM {pre}s WHERE p IS NOT NULL GROUP BY p),
{pre}cc AS (SELECT p, pos, neg,
         sum(pos) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
         sum(neg) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM {pre}sc),
{pre}t AS (SELECT sum(pos) AS n_pos, sum(neg) AS n_neg FROM {pre}sc),
{pre}c AS (SELECT avg(CAST("Class" AS DOUBLE)) AS prevalence, count_if("Class" <> 1 AND p >= 0.25) AS fp,
                  count_if("Class" = 1 AND p < 0.25) AS fn, count_if("Class" = 1 AND p >= 0.25) AS tp FROM {pre}s),
{pre}m AS (SELECT (SELECT sum(neg * (tp - pos / 2.0)) FROM {pre}cc) / (n_pos * n_neg) AS roc_auc,
                  (SELECT sum(pos * tp / (tp + fp)) FROM {pre}cc) / n_pos AS average_precision,
                  CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
                  CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
                  CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1, prevalence
           FROM {pre}t, {pre}c)"""


_M12 = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, round(a.{m}, 6) AS v1, round(b.{m}, 6) AS v2, round(b.{m} - a.{m}, 6) AS change "
    f"FROM a_m a, b_m b" for m in ev.COMPARE_METRICS)


@query("m12_version_comparison", f"""WITH {_metrics_sql('p', 'a_')},
{_metrics_sql('l_discount * 5.0', 'b_')}
{_M12}""", ("scored",))
def m12_version_comparison(spark, sf):
    """Two scores of the same rows as versions v1 (price score) and v2 (discount score), side by side."""
    s = fx.scored(spark, sf)
    v1 = ev.evaluate(s, "Class", "p", THRESHOLD, model_version="v1")
    v2 = ev.evaluate(s.withColumn("p", F.col("l_discount") * 5.0), "Class", "p", THRESHOLD, model_version="v2")
    cmp = ev.compare_versions(v1.unionByName(v2), ["v1", "v2"])
    return _r6(cmp, ["v1", "v2", "change"])


_LL = """ll AS (SELECT p.prediction_id, p.fraud_probability, t."Class" FROM pred p JOIN tx t
              ON p.prediction_id = CAST(t.tx_id AS VARCHAR)),
lsc AS (SELECT fraud_probability AS p, count_if("Class" = 1) AS pos, count_if("Class" <> 1) AS neg FROM ll GROUP BY 1),
lcc AS (SELECT p, pos, neg,
         sum(pos) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
         sum(neg) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM lsc),
ltot AS (SELECT sum(pos) AS n_pos, sum(neg) AS n_neg FROM lsc)"""


@query("j6_late_label_metrics", f"""WITH {_LL}
SELECT CAST((SELECT count(*) FROM ll) AS BIGINT) AS n_labelled,
       round(CASE WHEN n_pos > 0 AND n_neg > 0 THEN (SELECT sum(neg * (tp - pos / 2.0)) FROM lcc) / (n_pos * n_neg) END, 6) AS roc_auc,
       round(CASE WHEN n_pos > 0 THEN (SELECT sum(pos * tp / (tp + fp)) FROM lcc) / n_pos END, 6) AS average_precision
FROM ltot""", ("pred", "tx"))
def j6_late_label_metrics(spark, sf):
    """The prediction log evaluated against labels that arrive later (the transactions' Class), by id."""
    p = fx.pred(spark, sf).select("prediction_id", "fraud_probability")
    labels = fx.tx(spark, sf).select(F.col("tx_id").cast("string").alias("prediction_id"), "Class")
    j = ev.with_late_labels(p, labels, "prediction_id")
    m = ev.auc_ap(j, "Class", "fraud_probability")
    return _r6(m.select(j.agg(F.count(F.lit(1))).scalar().alias("n_labelled"), "roc_auc", "average_precision"),
               ["roc_auc", "average_precision"])
