"""What is kept over time: snapshots with commits, the full-history log, late labels and rows, the drift window, sketches."""

import datetime as dt
import math
import os
import tempfile
from itertools import combinations

import pytest
from pyspark.sql import functions as F
from replay import write_replay

from riskloom.functions.validate import SchemaMismatchError
from riskloom.operators import drift as dr
from riskloom.operators import features as fe
from riskloom.operators import models as mo
from riskloom.operators import profile as pr
from riskloom.operators import registry as rg
from riskloom.plans import monitor
from riskloom.sources import fixtures as fx
from riskloom.sources import idlog, logs
from riskloom.sources import tables as tb
from riskloom.sources.idlog import IdLog
from riskloom.sources.snapshots import SnapshotTable, StaleWriterError
from riskloom.sources.versions import ModelVersions
from riskloom.streaming import drift_window as dw
from riskloom.streaming import late, newest_state
from riskloom.streaming import streams as st

SF = "/root/testdata/sf0.001"


def _drain(q):
    q.awaitTermination(600)
    assert q.exception() is None


# ---- snapshots and the registry -------------------------------------------------------------------------------------------

def test_second_commit_from_the_same_snapshot_is_refused(spark, tmp_dir):
    t = SnapshotTable(spark, os.path.join(tmp_dir, "t"))
    assert t.version() == 0
    with pytest.raises(tb.MissingSourceError):
        t.read()
    assert t.commit(spark.range(3), 0) == 1
    with pytest.raises(StaleWriterError):
        t.commit(spark.range(5), 0)
    assert t.commit(spark.range(4), 1) == 2
    assert t.read().count() == 4 and t.read(1).count() == 3  # old snapshots stay whole
    folders = [n for n in os.listdir(t.path) if n.startswith("snapshot-")]
    assert len(folders) == 2  # a refused writer leaves nothing behind


def test_two_writers_of_the_same_number(spark, tmp_dir):
    """Both have seen version 0 when they write: the rename lets one through."""
    a, b = (SnapshotTable(spark, os.path.join(tmp_dir, "t")) for _ in range(2))
    real = b.version
    seen = [0]
    b.version = lambda: seen.pop() if seen else real()
    a.commit(spark.range(1), 0)
    with pytest.raises(StaleWriterError):
        b.commit(spark.range(2), 0)
    assert a.read().count() == 1


def _quick_model(spark, n_features=2):
    s = fx.feat(spark, SF).select("tx_id", "ts", "Amount", "Class", "V1", "V2").withColumn("weight", F.lit(1.0))
    return mo.fit_gbt(s, ["V1", "V2"][:n_features], "Class", mo.GBTParams(max_depth=1, step_size=0.1, max_iter=1))


def test_registry_errors_and_stale_promotion(spark, tmp_dir):
    v = ModelVersions(spark, os.path.join(tmp_dir, "models"))
    runs = spark.createDataFrame([(1, 0.5), (2, 0.7), (3, None)], "run_id long, average_precision double")
    with pytest.raises(rg.RegistryError, match="no version of model 'risk' found"):
        v.promote("risk", runs, "average_precision")
    model = _quick_model(spark)
    assert v.publish("risk", model, None, 3) == "1"
    with pytest.raises(rg.RegistryError, match="with metric 'average_precision'"):
        v.promote("risk", runs, "average_precision")
    with pytest.raises(rg.RegistryError, match="at stage 'Production'"):
        v.serving("risk")
    assert [v.publish("risk", model, None, r) for r in (1, 2)] == ["2", "3"]
    at = v.table.version()
    assert v.promote("risk", runs, "average_precision", expected=at) == "3"
    with pytest.raises(StaleWriterError):
        v.promote("risk", runs, "average_precision", expected=at)
    assert {r.version: r.stage for r in v.rows().collect()} == {"1": "None", "2": "None", "3": "Production"}
    served = v.serving("risk")
    assert served.version == "3" and [c for c, _ in served.signature] == ["V1", "V2"] and v.serving("risk") is served


def test_promotion_between_batches_changes_the_served_version(spark, tmp_path_factory, tmp_dir):
    v = ModelVersions(spark, os.path.join(tmp_dir, "models"))
    runs = spark.createDataFrame([(1, 0.5), (2, 0.7)], "run_id long, average_precision double")
    v.publish("risk", _quick_model(spark), None, 1)
    v.promote("risk", runs, "average_precision")
    src_dir = str(tmp_path_factory.mktemp("served"))
    rows = fx.feat(spark, SF).select("tx_id", "ts", "Amount", "V1", "V2")
    write_replay(rows, src_dir, "ts", 3)
    out, bad, ck = (os.path.join(tmp_dir, x) for x in ("log", "bad", "ck"))
    seen = []
    real = v.serving

    def serving(*a):
        if len(seen) == 1:  # after the first batch a better version is published and promoted
            v.publish("risk", _quick_model(spark, 1), None, 2)
            v.promote("risk", runs, "average_precision")
        seen.append(real(*a).version)
        return real(*a)

    v.serving = serving
    src = st.event_time(st.file_source(spark, src_dir, rows.schema), "ts")
    _drain(st.served_scoring_query(src, v, "risk", [], out, bad, ck))
    log = spark.read.parquet(out)
    assert seen == ["1", "2", "2"] and log.count() == rows.count()
    per = {r.batch_id: r.model_version for r in log.select("batch_id", "model_version").distinct().collect()}
    assert per == {0: "1", 1: "2", 2: "2"}


def test_served_version_checks_its_signature(spark, tmp_path_factory, tmp_dir):
    v = ModelVersions(spark, os.path.join(tmp_dir, "models"))
    v.publish("risk", _quick_model(spark), None, 1, stage="Production")
    src_dir = str(tmp_path_factory.mktemp("sig"))
    rows = fx.feat(spark, SF).select("tx_id", "ts", "Amount", "V1")
    write_replay(rows, src_dir, "ts", 1)
    q = st.served_scoring_query(st.event_time(st.file_source(spark, src_dir, rows.schema), "ts"), v, "risk", [],
                                os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "bad"), os.path.join(tmp_dir, "ck"))
    with pytest.raises(Exception, match="V2"):
        q.awaitTermination(300)
    assert SchemaMismatchError.__name__ in str(q.exception())


# ---- the full-history log -------------------------------------------------------------------------------------------------

def _pred(spark):
    return fx.pred(spark, SF)


def test_log_reads_only_files_that_may_hold_the_ids(spark, tmp_dir):
    p = _pred(spark).withColumn("day", F.dayofmonth("timestamp"))
    log = IdLog(spark, os.path.join(tmp_dir, "log"), buckets=16)
    for i in range(4):
        log.append(p.where(F.col("day") % 4 == i).drop("day"), i)
    assert log.read().count() == p.count()
    files = log._data([r["segment"] for r in log._live()])
    all_files = files.select(F.input_file_name().alias("f")).distinct().count()
    assert all_files == 64
    some = p.where(F.col("day") % 4 == 1).orderBy("prediction_id").limit(5)
    pairs = log.candidates(some)
    assert 1 <= len(pairs) <= 10  # five ids: five files, and the few let through by mistake
    read = log.pairs(pairs)
    assert read.select(F.input_file_name().alias("f")).distinct().count() == len(pairs)
    plan = read.select("prediction_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "segment" in plan.split("PartitionFilters: [")[1].split("]")[0]
    strangers = spark.range(200).select(F.concat(F.lit("never "), "id").alias("prediction_id"))
    assert len(log.candidates(strangers)) < 64
    assert log.append(some.drop("day"), 9) == 0


def test_replayed_batch_adds_nothing(spark, tmp_dir):
    p = _pred(spark)
    broken = p.withColumn("amount", F.when(F.col("prediction_id").cast("long") % 10 != 0, F.col("amount")))
    log = IdLog(spark, os.path.join(tmp_dir, "log"), buckets=4)
    good = broken.where("amount IS NOT NULL").count()
    assert [log.append(broken, 0), log.append(broken, 0)] == [good, good]
    again = IdLog(spark, log.path)  # another process
    assert again.buckets == 4 and again.append(broken, 0) == good
    assert again.read().count() == good
    assert spark.read.parquet(f"{log.path}/quarantine").count() == p.count() - good
    # a first run that died before its commit: its files are there, the commit is not
    log._write(p.limit(7), f"{1:012d}")
    assert log.read().count() == good
    assert log.append(p, 1) == p.count() - good and log.read().count() == p.count()
    assert log.append(p.limit(0), 2) == 0 and log.append(p, 3) == 0


def test_compaction_keeps_rows_and_batch_numbers(spark, tmp_dir):
    p = _pred(spark)
    log = IdLog(spark, os.path.join(tmp_dir, "log"), buckets=4)
    for i in range(5):
        log.append(p.where(F.col("prediction_id").cast("long") % 5 == i), i)
    before = sorted(r.prediction_id for r in log.read().collect())
    assert log.compact(keep=2) == 3 and len(log._live()) == 3
    assert sorted(r.prediction_id for r in log.read().collect()) == before
    assert log.append(p.where(F.col("prediction_id").cast("long") % 5 == 1), 1) > 0  # the first run's count: nothing is added
    assert log.append(p, 7) == 0 and log.read().count() == p.count()
    assert log.vacuum() == 3 and log.read().count() == p.count()


def test_bloom_filter_misses_nothing():
    import numpy as np

    rng = np.random.default_rng(0)
    a, b = (rng.integers(-2**63, 2**63 - 1, 5000) for _ in range(2))
    f = idlog.bloom(a, b)
    assert idlog.may_hold(f, a, b).all() and len(f) <= 5000 * idlog.BITS_PER_ID // 8 + 8
    c, d = (rng.integers(-2**63, 2**63 - 1, 20000) for _ in range(2))
    assert idlog.may_hold(f, c, d).mean() < 0.02


def test_idempotent_log_stream(spark, tmp_path_factory, tmp_dir):
    """Re-sends far outside any watermark, and a second query over the same source."""
    src_dir = str(tmp_path_factory.mktemp("resent"))
    p = _pred(spark)
    twice = p.unionByName(p.where(F.col("prediction_id").cast("long") % 3 == 0).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 90 DAY")))
    write_replay(twice, src_dir, "timestamp", 3)
    log = IdLog(spark, os.path.join(tmp_dir, "log"), buckets=4)
    for ck in ("ck1", "ck2"):  # the second query sends every batch again
        _drain(st.idempotent_log_query(st.file_source(spark, src_dir, p.schema), log, os.path.join(tmp_dir, ck)))
    got = sorted((r.prediction_id, r.timestamp) for r in log.read().collect())
    assert got == sorted((r.prediction_id, r.timestamp) for r in p.collect())


def test_quarantine_of_the_plain_log_is_idempotent(spark, tmp_dir):
    batch = _pred(spark).limit(20).withColumn("amount", F.when(F.col("amount") > 1e9, F.col("amount")))
    path = os.path.join(tmp_dir, "log")
    assert [logs.append_predictions(batch, path) for _ in range(2)] == [0, 0]
    assert spark.read.parquet(f"{path}-rejected").count() == 20


# ---- late labels and late rows --------------------------------------------------------------------------------------------

def test_late_label_stream_equals_its_batch_twin(spark, tmp_path_factory, tmp_dir):
    import __spark_entry__ as E
    from riskloom.plans.q_logs import _labels

    preds = st.event_time(_pred(spark).select("prediction_id", "fraud_probability", "timestamp"), "timestamp").drop("timestamp")
    labels = _labels(spark, SF).withColumn("label_time", F.col("label_time").cast("timestamp"))
    # one row far ahead on each side lets the watermark pass the last bound
    ahead = dt.datetime(2030, 1, 1)
    preds = preds.unionByName(spark.createDataFrame([("end", 0.0, ahead)], preds.schema))
    labels = labels.unionByName(spark.createDataFrame([("other end", 0, ahead)], labels.schema))
    p_dir, l_dir = str(tmp_path_factory.mktemp("p")), str(tmp_path_factory.mktemp("l"))
    write_replay(preds, p_dir, "event_time", 4)
    write_replay(labels, l_dir, "label_time", 4)
    out = os.path.join(tmp_dir, "out")
    q = late.late_labels_query(st.file_source(spark, p_dir, preds.schema), st.file_source(spark, l_dir, labels.schema), "prediction_id",
                               out, os.path.join(tmp_dir, "ck"), bound="7 days", delay="10 days")
    _drain(q)
    got = sorted((r.prediction_id, r.Class is None, r.Class or 0) for r in spark.read.parquet(out).where("prediction_id <> 'end'").collect())
    twin = E.queries()["j6_labels_within_bound"](spark, SF).collect()
    assert got == sorted((r.prediction_id, r.Class is None, r.Class or 0) for r in twin)
    assert 0 < sum(1 for r in got if r[1]) < len(got)


def test_late_rows_are_kept_apart_over_many_batches_and_a_restart(spark, tmp_path_factory, tmp_dir):
    """More than a hundred micro-batches in two runs: late and on-time rows are all rows, cut as the batch twin cuts them."""
    import __spark_entry__ as E

    src_dir = str(tmp_path_factory.mktemp("late"))
    day = F.floor(F.unix_micros(F.col("timestamp").cast("timestamp")) / 86_400_000_000) + F.col("prediction_id").cast("long") % 4
    rows = _pred(spark).withColumn("batch", day)
    numbers = sorted(r.batch for r in rows.select("batch").distinct().collect())
    # every daily batch as several files of which the last holds its rows: empty micro-batches in between
    at, schema = 0, rows.schema

    def put(df):
        nonlocal at
        tmp = tempfile.mkdtemp(dir=tmp_dir)
        df.coalesce(1).write.mode("overwrite").parquet(tmp)
        name = next(n for n in os.listdir(tmp) if n.endswith(".parquet"))
        dst = os.path.join(src_dir, f"part-{at:05d}.parquet")
        os.replace(os.path.join(tmp, name), dst)
        os.utime(dst, (1_700_000_000 + at, 1_700_000_000 + at))
        at += 1

    out, ck = os.path.join(tmp_dir, "split"), os.path.join(tmp_dir, "ck")

    def run():
        _drain(late.split_late(st.event_time(st.file_source(spark, src_dir, schema), "timestamp"), out, ck, delay="1 day"))

    half = len(numbers) // 2
    empty = rows.where("false").cache()
    rows = rows.cache()
    for n in numbers[:half]:
        for df in (empty, empty, rows.where(F.col("batch") == n)):
            put(df)
    run()
    for n in numbers[half:]:
        for df in (empty, empty, rows.where(F.col("batch") == n)):
            put(df)
    for _ in range(3):
        put(empty)
    run()
    assert at > 100 and late.late_counts(spark, out).count() == at
    got = {}
    for name in ("on_time", "late"):
        for r in spark.read.schema(schema).parquet(f"{out}/{name}").groupBy("batch").count().collect():
            got.setdefault(r.batch, {})[name] = r["count"]
    twin = {r.batch: (r.n_on_time, r.n_late) for r in E.queries()["t7_late_rows"](spark, SF).collect()}
    assert {b: (c.get("on_time", 0), c.get("late", 0)) for b, c in got.items()} == twin
    total = late.late_counts(spark, out).agg(F.sum("n_on_time"), F.sum("n_late")).first()
    assert sum(total) == rows.count() and total[1] == sum(v[1] for v in twin.values()) > 0


def test_listener_counts_beyond_recent_progress(spark, tmp_path_factory, tmp_dir):
    path = str(tmp_path_factory.mktemp("dropped"))
    p = _pred(spark)
    write_replay(p, path, "timestamp", 3)
    listener = late.DroppedRows()
    spark.streams.addListener(listener)
    try:
        src = st.event_time(st.file_source(spark, path, p.schema), "timestamp")
        q = (st.rollup_stream(src).writeStream.outputMode("append").format("memory").queryName("dropped_t")
             .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start())
        _drain(q)
        for _ in range(100):
            if listener.batches.get(str(q.id), 0) >= 3:
                break
            import time

            time.sleep(0.1)
        assert listener.batches[str(q.id)] >= 3 and listener.dropped[str(q.id)] == st.dropped_by_watermark(q)
    finally:
        spark.streams.removeListener(listener)


# ---- the drift window -----------------------------------------------------------------------------------------------------

def test_window_check_equals_the_row_check_after_every_batch(spark, tmp_path_factory, tmp_dir):
    src_dir = str(tmp_path_factory.mktemp("window"))
    p = _pred(spark).withColumn("amount", F.when(F.col("prediction_id").cast("long") % 9 != 0, F.col("amount")))
    write_replay(p, src_dir, "timestamp", 4)
    ref, _ = fx.ref_cur(spark, SF)
    ref = ref.select(F.col("Amount").alias("amount"))
    path, rep, trig = (os.path.join(tmp_dir, x) for x in ("w", "rep", "trig"))
    q = dw.window_check_query(st.file_source(spark, src_dir, p.schema), ref, ["amount"], path, 200, rep, trig, os.path.join(tmp_dir, "ck"), close_every=2)
    _drain(q)
    reports = {r.run_ts: r for r in logs.read_reports(spark, rep).collect()}
    assert len(reports) == 4
    so_far = None
    for name in sorted(n for n in os.listdir(src_dir) if n.endswith(".parquet")):
        batch = spark.read.schema(p.schema).parquet(os.path.join(src_dir, name))
        so_far = batch if so_far is None else so_far.unionByName(batch)
        stamp = batch.agg(F.date_format(F.max("timestamp"), "yyyyMMdd'T'HHmmss'Z'")).first()[0]
        want = monitor.drift_check(ref, monitor.newest(so_far, 200), ["amount"], whole_rows=True, exact_ks=True).table.first()
        assert reports[stamp].drift_score == pytest.approx(want.drift_score) and reports[stamp].drift_detected == want.drift_detected
    w = dw.DriftWindow(spark, path, p.schema.simpleString()[7:-1].replace(":", " "), ["amount"])
    days = w.log.parts()
    assert w.log.read(days).count() == p.count()
    newest = max(d for d in days if d in w.window(200)[0] + [w.window(200)[1]])
    assert all(len(w.log.folders(d)) == 1 for d in days if d < newest)  # a day is one folder, not one per batch


def test_a_merge_that_died_changes_nothing(spark, tmp_dir):
    from riskloom.sources.batches import BatchFolders

    b = BatchFolders(spark, os.path.join(tmp_dir, "b"), "x long", "part")
    for i in range(3):
        b.write(spark.range(i * 10, i * 10 + 5).select(F.col("id").alias("x"), F.lit("a").alias("part")), i)
    b.write(spark.range(20, 25).select(F.col("id").alias("x"), F.lit("a").alias("part")), 2)  # batch 2 runs again
    assert b.read(["a"]).count() == 15
    os.makedirs(f"{b.path}-closed/part=a/upto=1/_temporary")  # died before its _SUCCESS
    assert b.read(["a"]).count() == 15
    b.close("a")
    assert len(b.folders("a")) == 1 and b.read(["a"]).count() == 15
    b.write(spark.range(50, 52).select(F.col("id").alias("x"), F.lit("a").alias("part")), 3)
    assert b.read(["a"]).count() == 17 and b.parts() == ["a"] and b.read(["none"]).count() == 0


# ---- state that dies ------------------------------------------------------------------------------------------------------

def test_newest_rows_state_equals_the_rollup_and_expires(spark, tmp_path_factory, tmp_dir):
    import __spark_entry__ as E

    newest_state.use_rocksdb(spark)
    try:
        src_dir = str(tmp_path_factory.mktemp("tws"))
        p = _pred(spark)
        far = spark.createDataFrame([("late key", dt.datetime(2024, 6, 1), 1.0, 0.5, False, "9")], p.schema)
        later = spark.createDataFrame([("last", dt.datetime(2024, 6, 2), 1.0, 0.5, False, "9")], p.schema)
        write_replay(p.unionByName(far).unionByName(later), src_dir, "timestamp", 4)
        src = st.event_time(st.file_source(spark, src_dir, p.schema), "timestamp")
        got = {}
        ck = os.path.join(tmp_dir, "ck")
        q = (newest_state.newest_metrics_stream(src, 100, ttl_hours=48).writeStream.outputMode("update").format("memory").queryName("tws_t")
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        _drain(q)
        for r in spark.table("tws_t").collect():
            if r.model_version not in got or r.last_ts >= got[r.model_version].last_ts:
                got[r.model_version] = r
        twin = {r.model_version: r for r in E.queries()["a14_keyed_rollup"](spark, SF).collect()}
        assert set(got) == set(twin) | {"9"}
        for k, r in twin.items():
            assert got[k]["count"] == r["count"] and round(got[k].fraud_rate, 4) == r.fraud_rate
        rows = [o["numRowsTotal"] for pr_ in q.recentProgress for o in pr_["stateOperators"]]
        assert rows[0] == 3 and max(rows) == 4 and rows[-1] == 1  # three keys have left, one is alive
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


# ---- sketches, exact K-S, lines, run records --------------------------------------------------------------------------------

def test_merged_sketches_keep_the_stated_rank_error(spark):
    d = spark.range(60_000).select((F.col("id") % 7).alias("day"), (F.hash("id") % 10_000).cast("double").alias("x"))
    parts = pr.percentile_sketches(d, "x", ["day"], k=200)
    merged = pr.merged_sketches(parts, k=200)
    assert merged.first()["n"] == 60_000
    values = sorted(r.x for r in d.select("x").collect())
    for r in pr.sketch_percentiles(merged, [0.05, 0.5, 0.95]).collect():
        below = sum(v < r.value for v in values)
        upto = sum(v <= r.value for v in values)
        room = 4 * 2.296 / 200 ** 0.9021 * 60_000
        assert below - room <= r.q * 60_000 <= upto + room
    assert pr.percentile_sketches(d.where("false"), "x", ["day"]).count() == 0


@pytest.mark.parametrize("m,n", [(1, 1), (1, 6), (2, 5), (3, 3), (4, 6), (5, 5), (6, 7)])
def test_exact_ks_equals_enumeration(m, n):
    seen = {}
    for pos in combinations(range(m + n), m):
        i = j = worst = 0
        for k in range(m + n):
            i, j = (i + 1, j) if k in pos else (i, j + 1)
            worst = max(worst, abs(i * n - j * m))
        seen[worst] = seen.get(worst, 0) + 1
    for w in seen:
        want = sum(c for d, c in seen.items() if d >= w) / math.comb(m + n, m)
        assert dr.ks_exact(w / (m * n), m, n) == pytest.approx(want, rel=1e-12)
        assert dr.ks_exact(w / (m * n), n, m) == pytest.approx(want, rel=1e-12)
    assert dr.ks_exact(0.0, m, n) == 1.0


def test_exact_ks_is_used_where_the_test_and_the_sizes_allow(spark):
    ref = spark.range(40).select((F.col("id") * 3 % 40).cast("double").alias("x"))
    cur = spark.range(30).select((F.col("id") * 1.7 + 5).alias("x"))
    series, exact = (dr.drift_table(ref, cur, ["x"], exact_ks=e).first() for e in (False, True))
    stat = dr.numeric_tests(dr.stack(dr.to_long(ref, ["x"], "ref"), dr.to_long(cur, ["x"], "cur"))).first().ks_stat
    assert exact.drift_score == pytest.approx(dr.ks_exact(stat, 40, 30)) and exact.drift_score != series.drift_score
    many = spark.range(dr.EXACT_KS_ROWS + 1).select((F.col("id") % 31).cast("double").alias("x"))
    assert dr.drift_table(ref, many, ["x"], exact_ks=True).first().drift_score == dr.drift_table(ref, many, ["x"]).first().drift_score
    assert dr.ks_exact(0.05, 1000, 10_000) == pytest.approx(dr.ks_exact(0.05, 10_000, 1000))


def test_run_metrics_sink_replaces_a_run_logged_again(spark, tmp_dir):
    from riskloom.operators import evaluate as ev

    m = ev.evaluate(fx.scored(spark, SF), "Class", "p", 0.25, model_version="2", path="x")
    path = os.path.join(tmp_dir, "runs")
    for day in ("2024-01-01", "2024-01-02", "2024-01-01"):
        logs.write_run_metrics(logs.run_row(m, "risk", "Staging", 5, F.lit(day).cast("timestamp")), path)
    rows = logs.read_run_metrics(spark, path).collect()
    assert len(rows) == 2 and {r.run_name for r in rows} == {"eval-risk-v2"} and rows[0].roc_auc == pytest.approx(m.first().roc_auc)


def test_trigger_names_its_report_and_program_errors_are_raised(spark, tmp_dir):
    ref = spark.range(500).select((F.col("id") * 1.0).alias("amount"))
    log = _pred(spark).withColumn("amount", F.col("amount") + 1e6)
    rep, trig = os.path.join(tmp_dir, "rep"), os.path.join(tmp_dir, "trig")
    assert monitor.run_monitor(spark, ref, log, ["amount"], 200, rep, trig, as_of=F.lit("2024-03-01 10:00:00").cast("timestamp")).first().triggered
    path = spark.read.json(trig).first().drift_metrics.report_json_path
    assert path == f"{rep}/run_ts=20240301T100000Z" and os.path.isdir(path)

    def broken():
        raise TypeError("a bug")

    with pytest.raises(TypeError):
        monitor.recorded(spark, broken, rep, trig, F.current_timestamp())


def test_whole_rows_and_full_shift(spark):
    rows = [(float(i), float(-i) if i % 4 else None, float("nan") if i % 10 == 0 else 1.0 * i) for i in range(100)]
    d = spark.createDataFrame(rows, "a double, b double, c double")
    t = dr.drift_table(d, d, ["a", "b", "c"], whole_rows=True).collect()
    want = sum(1 for a, b, c in rows if b is not None and c == c)
    assert {r.n_ref for r in t} == {want}
    s = fx.feat(spark, SF).select("tx_id", "V1", "V2", "V3", "Amount")
    out = dr.full_shift(s, "tx_id")
    hit = out.where("Amount >= 1000 and V1 < -2 and V2 > 1")
    assert out.columns == s.columns and hit.count() >= math.floor(s.count() * 0.2)
