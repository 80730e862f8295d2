"""Sources, sinks and the streaming forms (each compared with its batch twin)."""

import os

import pandas as pd
import pytest
from replay import write_replay
from pyspark.sql import functions as F

from riskloom.functions.validate import SchemaMismatchError
from riskloom.operators import drift as dr
from riskloom.operators import features as fe
from riskloom.operators import models as mo
from riskloom.plans import monitor
from riskloom.sources import fixtures as fx
from riskloom.sources import logs
from riskloom.sources import tables as tb
from riskloom.streaming import streams as st

SF = "/root/testdata/sf0.001"


def test_csv_transactions_read_with_fixed_schema(spark, tmp_dir):
    f = fx.feat(spark, SF).select("Time", *[f"V{i}" for i in range(1, 29)], "Amount", "Class")
    path = os.path.join(tmp_dir, "tx_csv")
    f.write.option("header", True).csv(path)
    got = tb.read_transactions(spark, path)
    assert got.schema == tb.TX_SCHEMA
    assert got.count() == f.count()


def test_split_sink_and_pruned_read(spark, tmp_dir):
    s = fe.stratified_split(fx.tx(spark, SF), "Class", "tx_id", 42)
    path = os.path.join(tmp_dir, "splits")
    tb.write_splits(s, path)
    test = tb.read_split(spark, path, "test")
    assert test.count() == s.where("split = 'test'").count()
    assert "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().executedPlan().toString()


def test_missing_source_is_reported(spark, tmp_dir):
    with pytest.raises(tb.MissingSourceError, match="nowhere"):
        tb.load_table(spark, os.path.join(tmp_dir, "nowhere"))


def test_report_round_trip_and_history(spark, tmp_dir):
    ref, cur = fx.ref_cur(spark, SF)
    res = monitor.drift_check(ref, cur, ["Amount", "Time"])
    rep = logs.report_rows(res.table, res.summary, res.histograms, F.lit("2026-03-07 15:53:12").cast("timestamp"))
    path = os.path.join(tmp_dir, "reports")
    logs.write_report(rep, path)
    back = logs.read_reports(spark, path)
    rows = {r.column_name: r for r in back.collect()}
    table = {r.column_name: r for r in res.table.collect()}
    assert set(rows) == {"Amount", "Time"}
    for c in rows:
        assert rows[c].drift_score == pytest.approx(table[c].drift_score)
        assert rows[c].run_ts == "20260307T155312Z"
    assert logs.drift_history(back).count() == 2
    nested = spark.read.json(path).select(F.explode("metrics").alias("m")).where("m.metric = 'DataDriftTable'")
    x = nested.select(F.col("m.result.drift_by_columns.Amount.current.small_distribution.x").alias("x")).collect()[0].x
    assert len(x) == 11


def test_trigger_written_only_when_fired(spark, tmp_dir):
    ref, cur = fx.ref_cur(spark, SF)
    res = monitor.drift_check(ref, cur, ["Amount", "Time"])
    payload = dr.trigger_payload(res.decision, res.table, res.warnings, F.current_timestamp())
    fired = res.decision.collect()[0].triggered
    n = logs.write_trigger(payload, os.path.join(tmp_dir, "trigger"))
    assert n == (1 if fired else 0)
    quiet = dr.trigger_payload(dr.retrain_decision(res.summary, 1.0), res.table, res.warnings, F.current_timestamp())
    assert logs.write_trigger(quiet, os.path.join(tmp_dir, "trigger2")) == 0


def test_run_monitor_end_to_end_and_failure_row(spark, tmp_dir):
    ref, _ = fx.ref_cur(spark, SF)
    log = fx.pred(spark, SF).withColumnRenamed("amount", "Amount")
    out = monitor.run_monitor(spark, ref, log, ["Amount"], 500, os.path.join(tmp_dir, "r"), os.path.join(tmp_dir, "t"))
    row = out.collect()[0]
    assert row.error is None and row.number_of_columns == 1
    blocker = os.path.join(tmp_dir, "blocker")
    open(blocker, "w").close()  # a file where the report folder should go: the write fails
    bad = monitor.run_monitor(spark, ref, log, ["Amount"], 500, os.path.join(blocker, "reports"),
                              os.path.join(tmp_dir, "t2")).collect()[0]
    assert bad.triggered is False and bad.error


def test_append_predictions_is_idempotent(spark, tmp_dir):
    batch = fx.pred(spark, SF).limit(50)
    path = os.path.join(tmp_dir, "log")
    assert logs.append_predictions(batch, path) == 50
    assert logs.append_predictions(batch, path) == 0
    assert logs.not_null_violations(spark.read.parquet(path)).count() == 0


@pytest.fixture(scope="module")
def replay(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("replay"))
    p = fx.pred(spark, SF)
    write_replay(p, path, "timestamp", 4)
    return path, p.schema


def _drain(q):
    q.awaitTermination(300)
    assert q.exception() is None


def test_tumbling_stream_equals_batch_twin(spark, replay, tmp_dir):
    path, schema = replay
    src = st.event_time(st.file_source(spark, path, schema), "timestamp")
    out = st.rollup_stream(src, every="1 day", watermark="1 hour")
    q = (out.writeStream.outputMode("append").format("memory").queryName("tumbling_t")
         .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start())
    _drain(q)
    got = {r.window_start.replace(tzinfo=None): r["count"] for r in spark.table("tumbling_t").collect()}
    batch = fx.pred(spark, SF).groupBy(F.window("timestamp", "1 day").alias("w")).count()
    want = {r.w.start: r["count"] for r in batch.collect()}
    last = max(want)
    assert last not in got  # the open window is not emitted in append mode
    assert got == {k: v for k, v in want.items() if k != last}


def test_dedupe_stream_drops_resent_ids(spark, replay, tmp_dir):
    path, schema = replay
    src = st.event_time(st.file_source(spark, path, schema, files_per_trigger=10), "timestamp")
    doubled = src.unionByName(src)
    q = (st.dedupe_stream(doubled).writeStream.format("memory").queryName("dedupe_t")
         .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start())
    _drain(q)
    assert spark.table("dedupe_t").count() == fx.pred(spark, SF).count()


def test_rolling_state_equals_last_n_batch_twin(spark, replay, tmp_dir):
    path, schema = replay
    src = st.event_time(st.file_source(spark, path, schema), "timestamp")
    q = (st.rolling_metrics_stream(src, 100).writeStream.outputMode("update").format("memory")
         .queryName("rolling_t").option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .trigger(availableNow=True).start())
    _drain(q)
    final = {}
    for r in spark.table("rolling_t").collect():
        if r.model_version not in final or r.last_ts >= final[r.model_version].last_ts:
            final[r.model_version] = r
    import __spark_entry__ as E

    twin = {r.model_version: r for r in E.queries()["a14_keyed_rollup"](spark, SF).collect()}
    assert set(final) == set(twin)
    for k, r in final.items():
        assert r["count"] == twin[k]["count"]
        assert round(r.fraud_rate, 4) == twin[k].fraud_rate
        assert round(r.avg_probability, 4) == twin[k].avg_probability


def test_scoring_stream_logs_every_valid_row(spark, tmp_path_factory, tmp_dir):
    feats = [f"V{i}" for i in range(1, 29)] + ["Amount"]
    s = fe.stratified_split(fx.feat(spark, SF), "Class", "tx_id", 42)
    train = s.where("split = 'train'")
    stats = fe.fit_stats(train, ["Amount"])
    quick = mo.GBTParams(max_depth=2, step_size=0.1, max_iter=3)
    model = mo.fit_gbt(fe.class_weight(fe.features_v2(train, stats)), feats + ["amount_log", "amount_zscore"],
                       "Class", quick)
    src_dir = str(tmp_path_factory.mktemp("score_src"))
    rows = fx.feat(spark, SF).drop("split")
    write_replay(rows, src_dir, "ts", 2)
    src = st.event_time(st.file_source(spark, src_dir, rows.schema), "ts")
    rules = [("Amount must be >= 0", F.col("Amount") >= 0), ("Amount must be < 300", F.col("Amount") < 300)]
    out, bad = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "bad")
    q = st.scoring_query(src, model, stats, rules, out, bad, os.path.join(tmp_dir, "ck"))
    _drain(q)
    log = spark.read.parquet(out)
    rejected = spark.read.parquet(bad)
    assert log.count() == rows.where("Amount < 300").count()
    assert rejected.count() == rows.where("Amount >= 300").count() > 0
    assert {tuple(r.errors) for r in rejected.select("errors").collect()} == {("Amount must be < 300",)}
    assert log.where("fraud_probability < 0 or fraud_probability > 1").count() == 0


def test_session_stream_matches_closed_batch_sessions(spark, replay, tmp_dir):
    path, schema = replay
    src = st.event_time(st.file_source(spark, path, schema), "timestamp")
    q = (st.session_stream(src, "model_version", gap="30 minutes", watermark="1 hour").writeStream
         .outputMode("append").format("memory").queryName("session_t")
         .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start())
    _drain(q)
    got = {(r.model_version, r.session_start.replace(tzinfo=None)): r["count"] for r in spark.table("session_t").collect()}
    batch = (fx.pred(spark, SF).groupBy("model_version", F.session_window("timestamp", "30 minutes").alias("s"))
             .count().collect())
    want = {(r.model_version, r.s.start): r["count"] for r in batch}
    assert got and all(want[k] == v for k, v in got.items())


def test_late_rows_are_counted(spark, tmp_path_factory, tmp_dir):
    path = str(tmp_path_factory.mktemp("late"))
    p = fx.pred(spark, SF)
    cut = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    write_replay(p.where(F.col("timestamp") >= cut), path, "timestamp", 2)
    late_dir = os.path.join(tmp_dir, "late_tmp")
    p.where(F.col("timestamp") < cut).coalesce(1).write.parquet(late_dir)
    for name in os.listdir(late_dir):
        if name.endswith(".parquet"):
            dst = os.path.join(path, "part-00009.parquet")
            os.replace(os.path.join(late_dir, name), dst)
            os.utime(dst, (1_700_000_100, 1_700_000_100))
    src = st.event_time(st.file_source(spark, path, p.schema), "timestamp")
    q = (st.rollup_stream(src, every="1 day", watermark="1 hour").writeStream.outputMode("append")
         .format("memory").queryName("late_t").option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .trigger(availableNow=True).start())
    _drain(q)
    # the operator counts dropped rows after partial aggregation: one per late window and input partition
    late_days = p.where(F.col("timestamp") < cut).select(F.to_date("timestamp")).distinct().count()
    assert st.dropped_by_watermark(q) == late_days
    emitted = {r.window_start.replace(tzinfo=None) for r in spark.table("late_t").collect()}
    assert min(emitted).day >= 5  # late windows never reach the output


def test_drift_check_stream_writes_report(spark, replay, tmp_dir):
    path, schema = replay
    src = st.event_time(st.file_source(spark, path, schema, files_per_trigger=2), "timestamp").drop("event_time")
    ref, _ = fx.ref_cur(spark, SF)
    log_path, rep, trig = (os.path.join(tmp_dir, x) for x in ("log", "rep", "trig"))
    q = st.drift_check_query(src.withColumnRenamed("amount", "Amount"), ref, ["Amount"], log_path, 200, rep, trig,
                             os.path.join(tmp_dir, "ck"))
    _drain(q)
    assert spark.read.parquet(log_path).count() == fx.pred(spark, SF).count()
    assert logs.read_reports(spark, rep).count() == 2  # one report per micro-batch, one column each


def test_scan_bound_keeps_the_newest_rows(spark):
    """The bound holds at least n rows, leaves the newest n as they are, and gives way on short logs."""
    log = fx.pred(spark, SF).select("prediction_id", "timestamp")
    for n in (1, 50, 700):
        bound = st.scan_bound(log, log, n, hours=1)
        want = [r.prediction_id for r in monitor.newest(log, n).collect()]
        assert [r.prediction_id for r in monitor.newest(log.where(F.col("timestamp") >= bound), n).collect()] == want
    assert st.scan_bound(log, log, log.count() + 1) is None
    assert st.scan_bound(log.where("false"), log, 1) is None


def test_local_newest_trims_every_batch():
    t = pd.to_datetime("2024-01-01")
    rows = pd.DataFrame({"model_version": ["a", None] * 30, "prediction_id": [f"{i:02d}" for i in range(60)],
                         "event_time": [t + pd.Timedelta(minutes=i % 7) for i in range(60)]})
    whole = rows.sort_values(["event_time", "prediction_id"], ascending=[False, True]).groupby("model_version", dropna=False).head(3)
    got = list(st._local_newest(3)(iter([rows[:20], rows[20:20], rows[20:50], rows[50:]])))
    assert len(got) == 1 and sorted(got[0].prediction_id) == sorted(whole.prediction_id)
    assert list(st._local_newest(3)(iter([]))) == []


def test_score_names_missing_inputs(spark):
    s = fx.feat(spark, SF).select("tx_id", "Class", "V1", "V2")
    model = mo.fit_gbt(s.withColumn("weight", F.lit(1.0)), ["V1", "V2"], "Class", mo.GBTParams(max_depth=1, step_size=0.1, max_iter=1))
    with pytest.raises(SchemaMismatchError, match="V2"):
        mo.score(model, s.drop("V2"), keep=["tx_id"])


def test_gbt_with_validation_indicator(spark):
    feats = [f"V{i}" for i in range(1, 29)] + ["Amount"]
    s = fe.stratified_split(fx.feat(spark, SF), "Class", "tx_id", 42)
    tv = s.where("split <> 'test'").withColumn("is_val", F.col("split") == "val")
    model = mo.fit_gbt(fe.class_weight(tv), feats, "Class", mo.GBTParams(max_depth=2, step_size=0.1, max_iter=3),
                       validation_col="is_val")
    scored = mo.score(model, s.where("split = 'test'"), keep=["tx_id"])
    assert scored.count() == s.where("split = 'test'").count()
    imp = mo.importances(model, feats, 15).collect()
    assert len(imp) == 15 and all(r.importance >= 0 for r in imp)


def test_restarted_scoring_query_adds_nothing(spark, tmp_path_factory, tmp_dir):
    feats = [f"V{i}" for i in range(1, 29)] + ["Amount"]
    s = fe.stratified_split(fx.feat(spark, SF), "Class", "tx_id", 42)
    train = s.where("split = 'train'")
    stats = fe.fit_stats(train, ["Amount"])
    model = mo.fit_gbt(fe.class_weight(fe.features_v2(train, stats)), feats + ["amount_log", "amount_zscore"],
                       "Class", mo.GBTParams(max_depth=2, step_size=0.1, max_iter=2))
    src_dir = str(tmp_path_factory.mktemp("restart_src"))
    rows = fx.feat(spark, SF)
    write_replay(rows, src_dir, "ts", 2)
    out, bad, ck = (os.path.join(tmp_dir, x) for x in ("log", "bad", "ck"))
    for _ in range(2):  # the second run resumes from the checkpoint: every file is already committed
        src = st.event_time(st.file_source(spark, src_dir, rows.schema), "ts")
        _drain(st.scoring_query(src, model, stats, [], out, bad, ck))
    log = spark.read.parquet(out)
    assert log.count() == rows.count()
    assert log.select("prediction_id").distinct().count() == rows.count()
