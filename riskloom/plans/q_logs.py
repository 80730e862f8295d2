"""Registered queries of what is kept over time: the log that takes every id once, late labels and late rows, counts of
the drift window, quantile sketches, run records, committed registry snapshots, rejected lines.

They write their tables under the session's shared checkpoint folder and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import drift as dr
from ..operators import evaluate as ev
from ..operators import profile as pr
from ..operators import registry as rg
from ..session import ensure_checkpoint_dir
from ..sources import fixtures as fx
from ..sources import logs
from ..sources import tables as tb
from ..sources.idlog import IdLog
from ..sources.snapshots import SnapshotTable
from .q_drift import THRESHOLD, TX_NUM, numeric_drift_sql
from .q_eval import THRESHOLD as SCORE_THRESHOLD
from .registry import query
from .registry import round_cols as _r


def _scratch(spark, what: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


# ---- S6, J4, T5: the full-history log -----------------------------------------------------------------------------------

_BATCHES = """sent AS (
  SELECT prediction_id, "timestamp", CASE WHEN CAST(prediction_id AS BIGINT) % 11 = 0 THEN NULL ELSE amount END AS amount, fraud_probability,
         CASE WHEN "timestamp" < TIMESTAMP '2024-01-10 00:00:00' THEN 0 WHEN "timestamp" < TIMESTAMP '2024-01-20 00:00:00' THEN 1 ELSE 2 END AS batch FROM pred
  UNION ALL
  SELECT prediction_id, "timestamp" + INTERVAL 1 HOUR, amount, 1 - fraud_probability, 2 FROM pred
  WHERE "timestamp" >= TIMESTAMP '2024-01-20 00:00:00' AND CAST(prediction_id AS BIGINT) % 5 = 0
  UNION ALL
  SELECT prediction_id, "timestamp" + INTERVAL 40 DAY, 0.0, 1 - fraud_probability, 3 FROM pred WHERE CAST(prediction_id AS BIGINT) % 7 = 0)"""


def _sent(spark, sf):
    """Four batches: three stretches of time (some rows without an amount), the last with copies of its own ids, then
    re-sends of ids from all of the past."""
    p = fx.pred(spark, sf)
    number, ts = F.col("prediction_id").cast("long"), F.col("timestamp")
    broken = p.withColumn("amount", F.when(number % 11 != 0, F.col("amount")))
    again = p.withColumn("fraud_probability", 1 - F.col("fraud_probability"))
    first, second = _at("2024-01-10 00:00:00"), _at("2024-01-20 00:00:00")
    copies = again.where((ts >= second) & (number % 5 == 0)).withColumn("timestamp", ts + F.expr("INTERVAL 1 HOUR"))
    late = again.where(number % 7 == 0).withColumn("timestamp", ts + F.expr("INTERVAL 40 DAY")).withColumn("amount", F.lit(0.0))
    return [broken.where(ts < first), broken.where((ts >= first) & (ts < second)), broken.where(ts >= second).unionByName(copies), late]


def _logged(spark, sf) -> IdLog:
    log = IdLog(spark, _scratch(spark, "idlog"), buckets=16)
    for i, batch in enumerate(_sent(spark, sf)):
        log.append(batch, i)
        if i == 1:
            log.append(batch, i)  # the batch runs a second time
        if i == 2:
            log.compact(keep=1)
    return log


@query("s6_full_history_log", f"""WITH {_BATCHES},
r AS (SELECT *, row_number() OVER (PARTITION BY prediction_id ORDER BY batch, "timestamp") AS rn FROM sent WHERE amount IS NOT NULL)
SELECT prediction_id, "timestamp", round(amount, 6) AS amount, round(fraud_probability, 6) AS fraud_probability FROM r WHERE rn = 1""", ("pred",))
def s6_full_history_log(spark, sf):
    """Ids re-sent long after their first arrival are ignored; a rejected row's id is still new."""
    return _r(_logged(spark, sf).read().select("prediction_id", "timestamp", "amount", "fraud_probability"), ["amount", "fraud_probability"])


@query("s6_quarantine", f"""WITH {_BATCHES}
SELECT prediction_id, "timestamp", round(fraud_probability, 6) AS fraud_probability FROM sent WHERE amount IS NULL""", ("pred",))
def s6_quarantine(spark, sf):
    """Rows without a required field, once each although a batch ran twice."""
    log = _logged(spark, sf)
    return _r(spark.read.parquet(f"{log.path}/quarantine").select("prediction_id", "timestamp", "fraud_probability"), ["fraud_probability"])


# ---- J6, T7: late labels and late rows ------------------------------------------------------------------------------------

def _labels(spark, sf):
    """Labels that arrive up to eleven days after their prediction, or a day before it."""
    t = fx.tx(spark, sf)
    late = F.make_dt_interval(days=(F.col("tx_id") % 12 - 1).cast("int"))
    return t.select(F.col("tx_id").cast("string").alias("prediction_id"), "Class", (F.col("ts") + late).alias("label_time"))


@query("j6_labels_within_bound", """
SELECT p.prediction_id, round(p.fraud_probability, 6) AS fraud_probability, l."Class", l.label_time
FROM pred p LEFT JOIN (SELECT CAST(tx_id AS VARCHAR) AS prediction_id, "Class", ts + to_days(CAST(tx_id % 12 - 1 AS INTEGER)) AS label_time FROM tx) l
  ON p.prediction_id = l.prediction_id AND l.label_time >= p."timestamp" AND l.label_time <= p."timestamp" + INTERVAL 7 DAY""", ("pred", "tx"))
def j6_labels_within_bound(spark, sf):
    """Batch twin of ``late.late_labels``: predictions with the label that came within seven days, or none."""
    from ..streaming.late import late_labels

    p = fx.pred(spark, sf).select("prediction_id", "fraud_probability", "timestamp")
    out = late_labels(p, _labels(spark, sf), "prediction_id", pred_ts="timestamp", bound="7 days")
    return _r(out.select("prediction_id", "fraud_probability", "Class", "label_time"), ["fraud_probability"])


@query("t7_late_rows", """
WITH a AS (SELECT "timestamp" AS ts, CAST(floor(epoch_us("timestamp") / 86400000000) AS BIGINT) + CAST(prediction_id AS BIGINT) % 4 AS batch FROM pred),
b AS (SELECT batch, max(ts) AS newest FROM a GROUP BY 1),
m AS (SELECT batch, max(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 DAY AS mark FROM b)
SELECT batch, CAST(count_if(NOT coalesce(ts < mark, false)) AS BIGINT) AS n_on_time, CAST(count_if(coalesce(ts < mark, false)) AS BIGINT) AS n_late
FROM a JOIN m USING (batch) GROUP BY batch""", ("pred",))
def t7_late_rows(spark, sf):
    """Batch twin of ``late.split_late``: rows that arrive up to three days late, in daily batches, under a delay of one day."""
    from ..streaming.late import batch_split_late

    day = F.floor(F.unix_micros(F.col("timestamp").cast("timestamp")) / 86_400_000_000) + F.col("prediction_id").cast("long") % 4
    d = batch_split_late(fx.pred(spark, sf).withColumn("batch", day), "batch", "timestamp", "1 day")
    return d.groupBy("batch").agg(F.count_if(~F.col("late")).alias("n_on_time"), F.count_if("late").alias("n_late"))


# ---- T6: the drift window by day ------------------------------------------------------------------------------------------

N_RECENT = 1500  # the newest rows that a scheduled check compares


@query("t6_window_counts", f"""
WITH w AS (SELECT * FROM pred ORDER BY "timestamp" DESC, prediction_id LIMIT {N_RECENT}),
l AS (SELECT 'amount' AS column_name, amount AS value FROM w UNION ALL SELECT 'fraud_probability', fraud_probability FROM w)
SELECT column_name, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT value) AS BIGINT) AS n_values, round(sum(value), 4) AS total,
       round(min(value), 6) AS least, round(max(value), 6) AS most FROM l GROUP BY 1""", ("pred",))
def t6_window_counts(spark, sf):
    """Counts kept by day, summed over the newest rows, after four batches that each span all days and a merge."""
    from ..streaming.drift_window import DriftWindow

    columns = ["amount", "fraud_probability"]
    p = fx.pred(spark, sf).select("prediction_id", "timestamp", *columns)
    w = DriftWindow(spark, _scratch(spark, "window"), "prediction_id string, timestamp timestamp_ntz, amount double, fraud_probability double", columns)
    for i in range(4):
        w.add(p.where(F.col("prediction_id").cast("long") % 4 == i), i)
        if i == 2:
            w.close_days(N_RECENT)
    c, value = w.newest_counts(N_RECENT), F.col("value")
    out = c.groupBy("column_name").agg(F.sum("_w").alias("n"), F.count("value").alias("n_values"), F.round(F.sum(value * F.col("_w")), 4).alias("total"),
                                       F.min("value").alias("least"), F.max("value").alias("most"))
    return _r(out, ["least", "most"])


# ---- A16: sketches ---------------------------------------------------------------------------------------------------------

LEVELS = (0.01, 0.25, 0.5, 0.75, 0.95, 0.99)


@query("a16_sketch_percentiles", f"""
SELECT model_version, q, CAST(count(*) AS BIGINT) AS n, true AS within_bound
FROM pred, (SELECT unnest([{', '.join(f'CAST({q} AS DOUBLE)' for q in LEVELS)}]) AS q) t GROUP BY 1, 2""", ("pred",))
def a16_sketch_percentiles(spark, sf):
    """Percentiles per model version from sketches stored per day and version; the true rank of every value is within
    the stated error."""
    p = fx.pred(spark, sf).withColumn("day", F.to_date("timestamp"))
    path = _scratch(spark, "sketches")
    pr.percentile_sketches(p, "amount", ["day", "model_version"]).write.parquet(path)
    merged = pr.merged_sketches(spark.read.parquet(path), ["model_version"])
    found = pr.sketch_percentiles(merged, LEVELS, ["model_version"])  # levels x versions rows
    ranks = (p.select("model_version", "amount").join(F.broadcast(found), "model_version").groupBy("model_version", "q", "n")
             .agg(F.count_if(F.col("amount") < F.col("value")).alias("below"), F.count_if(F.col("amount") <= F.col("value")).alias("upto")))
    room = F.col("n") * F.lit(pr.RANK_ERROR)
    aim = F.col("q") * F.col("n")
    return ranks.select("model_version", "q", "n", ((F.col("below") <= aim + room) & (F.col("upto") >= aim - room)).alias("within_bound"))


# ---- F5, F8, D5: the drift job's steps -----------------------------------------------------------------------------------

_HOLES = """hole AS (SELECT tx_id, split, "Amount", CASE WHEN tx_id % 3 <> 0 THEN V1 END AS V1, CASE WHEN tx_id % 5 <> 0 THEN V2 END AS V2 FROM fspl),
href AS (SELECT * FROM hole WHERE split = 'train' AND V1 IS NOT NULL AND V2 IS NOT NULL),
hcur AS (SELECT * FROM hole WHERE split = 'test' AND V1 IS NOT NULL AND V2 IS NOT NULL)"""


@query("f5_drift_whole_rows", f"""WITH {_HOLES}, {numeric_drift_sql('href', 'hcur', ['V1', 'V2', 'Amount'])}
SELECT column_name, stattest_name, round(drift_score, 6) AS drift_score, drift_detected, n_ref, n_cur FROM dt""", ("fspl",))
def f5_drift_whole_rows(spark, sf):
    """Drift tests over the rows that have every tested column, on samples with holes."""
    def holes(d):
        return d.withColumn("V1", F.when(F.col("tx_id") % 3 != 0, F.col("V1"))).withColumn("V2", F.when(F.col("tx_id") % 5 != 0, F.col("V2")))

    ref, cur = fx.feat_ref_cur(spark, sf)
    t = dr.drift_table(holes(ref), holes(cur), ["V1", "V2", "Amount"], threshold=THRESHOLD, whole_rows=True)
    return _r(t.select("column_name", "stattest_name", "drift_score", "drift_detected", "n_ref", "n_cur"), ["drift_score"])


def _uniform(name: str) -> str:
    return (f"CAST(CAST('0x' || substr(md5(concat_ws('|', '99', '{name}', CAST(tx_id AS VARCHAR))), 1, 8) AS UBIGINT) AS DOUBLE) / 4294967296.0")


def _normal(name: str) -> str:
    return f"sqrt(-2.0 * ln({_uniform(name + '|r')} + 0.5 / 4294967296.0)) * cos(2 * pi() * {_uniform(name + '|a')})"


def _full_shift_sql() -> str:
    cols = []
    for c in ("V1", "V2", "V3"):
        noisy = f"{c} + {_normal(c)} * 2.0"
        if c in dr.FRAUD_PROFILE:
            mean, sd = dr.FRAUD_PROFILE[c]
            noisy = f"CASE WHEN hit THEN {mean} + {_normal(c + '|profile')} * {sd} ELSE {noisy} END"
        cols.append(f"round({noisy}, 6) AS {c}")
    return f"""
WITH r AS (SELECT tx_id, V1, V2, V3, "Amount",
                  row_number() OVER (ORDER BY md5(concat_ws('|', '99', CAST(tx_id AS VARCHAR))), tx_id) <= floor(count(*) OVER () * CAST(0.2 AS DOUBLE)) AS hit FROM fcur)
SELECT tx_id, {', '.join(cols)}, round(CASE WHEN hit THEN 1000.0 + 4000.0 * {_uniform('u')} ELSE "Amount" * 10.0 END, 6) AS "Amount" FROM r"""


@query("f8_full_shift", _full_shift_sql(), ("fcur",))
def f8_full_shift(spark, sf):
    """Amount scaled, noise on three components, one row in five overwritten in V1, V2 and Amount."""
    _, cur = fx.feat_ref_cur(spark, sf)
    return _r(dr.full_shift(cur.select("tx_id", "V1", "V2", "V3", "Amount"), "tx_id"), ["V1", "V2", "V3", "Amount"])


@query("d5_scores_by_name", f"""WITH {numeric_drift_sql('ref', 'cur', TX_NUM)}
SELECT column_name, round(drift_score, 6) AS drift_score FROM dt ORDER BY column_name""", ("ref", "cur"))
def d5_scores_by_name(spark, sf):
    ref, cur = fx.ref_cur(spark, sf)
    return dr.scores_by_name(_r(dr.drift_table(ref, cur, TX_NUM, threshold=THRESHOLD), ["drift_score"]))


# ---- M8, M10, S1: run records, committed snapshots, rejected lines --------------------------------------------------------

@query("m8_run_metrics", f"""
WITH c AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(count_if("Class" = 1) AS BIGINT) AS pos,
                  CAST(count_if("Class" = 1 AND p >= {SCORE_THRESHOLD}) AS BIGINT) AS tp, CAST(count_if("Class" <> 1 AND p >= {SCORE_THRESHOLD}) AS BIGINT) AS fp,
                  CAST(count_if("Class" <> 1 AND p < {SCORE_THRESHOLD}) AS BIGINT) AS tn, CAST(count_if("Class" = 1 AND p < {SCORE_THRESHOLD}) AS BIGINT) AS fn FROM scored)
SELECT 'eval-scored-v3' AS run_name, 'test_set' AS evaluation_type, 'scored' AS model_name, '3' AS model_version, 'Production' AS model_stage,
       CAST(17 AS BIGINT) AS source_run_id, 'fixture:scored' AS test_data_path, n AS test_n_samples, pos AS test_n_fraud,
       CAST({SCORE_THRESHOLD} AS DOUBLE) AS threshold, tp, fp, tn, fn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall FROM c""", ("scored",))
def m8_run_metrics(spark, sf):
    """An evaluation's run record, logged twice and read back once."""
    path = _scratch(spark, "runs")
    m = ev.evaluate(fx.scored(spark, sf), "Class", "p", SCORE_THRESHOLD, model_version="3", path="fixture:scored")
    row = logs.run_row(m, "scored", "Production", 17, F.lit("2024-02-01 00:00:00").cast("timestamp"))
    for _ in range(2):
        logs.write_run_metrics(row, path)
    back = logs.read_run_metrics(spark, path)
    return _r(back.drop("logged_at", "roc_auc", "average_precision", "f1"), ["precision", "recall"])


@query("m10_committed_promotion", """
WITH w AS (SELECT name, version AS win FROM (
    SELECT v.name, v.version, row_number() OVER (PARTITION BY v.name ORDER BY r.average_precision DESC, CAST(v.version AS BIGINT) ASC) AS rn
    FROM versions v JOIN runs r USING (run_id) WHERE r.average_precision IS NOT NULL) t WHERE rn = 1)
SELECT CAST(2 AS BIGINT) AS committed, v.name, v.version,
       CASE WHEN v.version = w.win THEN 'Production' WHEN v.stage = 'Production' THEN 'Archived' ELSE v.stage END AS stage
FROM versions v LEFT JOIN w ON v.name = w.name""", ("versions", "runs"))
def m10_committed_promotion(spark, sf):
    """Promotion of every model as a commit on the snapshot it was made from."""
    table = SnapshotTable(spark, _scratch(spark, "versions"))
    at = table.commit(fx.versions(spark, sf), 0)
    known = table.read(at)
    at = table.commit(rg.promote(known, rg.best_versions(known, fx.runs(spark, sf), "average_precision")), at)
    return table.read().select(F.lit(at).cast("long").alias("committed"), "name", "version", "stage")


@query("s1_rejected_lines", """
SELECT kind, CAST(count(*) AS BIGINT) AS n, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM (
  SELECT CASE WHEN tx_id % 7 = 0 THEN 'rejected' WHEN tx_id % 13 = 0 THEN 'rejected' ELSE 'accepted' END AS kind,
         CASE WHEN tx_id % 7 = 0 THEN 'line ' || tx_id || ' is no transaction' WHEN tx_id % 13 = 0 THEN tx_id || ',1.0' END AS line FROM feat) t
GROUP BY kind""", ("feat",))
def s1_rejected_lines(spark, sf):
    """Transactions as text in which some lines do not parse: accepted and rejected lines are all lines."""
    f = fx.feat(spark, sf)
    line = F.when(F.col("tx_id") % 7 == 0, F.format_string("line %d is no transaction", "tx_id")).when(
        F.col("tx_id") % 13 == 0, F.format_string("%d,1.0", "tx_id")).otherwise(F.concat_ws(",", "Time", *tb.FEATURES, "Class"))
    path = _scratch(spark, "lines")
    f.select(line.alias("value")).write.text(path)
    accepted, rejected = tb.read_transaction_lines(spark, path, header=False)
    counts = accepted.agg(F.count(F.lit(1)).alias("n")).select(F.lit("accepted").alias("kind"), "n", F.lit(None).cast("long").alias("n_chars"))
    return counts.unionByName(rejected.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("line")).alias("n_chars")).select(F.lit("rejected").alias("kind"), "n", "n_chars"))
