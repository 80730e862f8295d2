"""Hand-made micro cases: ties, one class, empty samples, small samples, null metrics, duplicates,
constant columns, bad rows, version ordering."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import validate as va
from riskloom.operators import drift as dr
from riskloom.operators import evaluate as ev
from riskloom.operators import features as fe
from riskloom.operators import profile as pr
from riskloom.operators import registry as rg
from riskloom.sources import logs


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    tot = 0.0
    for p in pos:
        for n in neg:
            tot += 1.0 if p > n else 0.5 if p == n else 0.0
    return tot / (len(pos) * len(neg))


def brute_ap(rows):
    P = sum(y for _, y in rows)
    ap = 0.0
    for s in sorted({s for s, _ in rows}, reverse=True):
        tp = sum(1 for x, y in rows if x >= s and y == 1)
        fp = sum(1 for x, y in rows if x >= s and y == 0)
        pos_here = sum(1 for x, y in rows if x == s and y == 1)
        ap += pos_here * tp / (tp + fp)
    return ap / P


TIED = [(0.9, 1), (0.9, 0), (0.8, 1), (0.5, 0), (0.5, 0), (0.5, 1), (0.3, 0), (0.3, 1), (0.1, 0), (0.1, 0), (0.9, 1)]


@pytest.mark.parametrize("buckets", [1, 2, 3, 64])
def test_auc_ap_with_ties_match_brute_force(spark, buckets):
    df = spark.createDataFrame(TIED, "p double, Class int")
    r = ev.auc_ap(df, "Class", "p", n_buckets=buckets).collect()[0]
    assert r.roc_auc == pytest.approx(brute_auc(TIED), abs=1e-12)
    assert r.average_precision == pytest.approx(brute_ap(TIED), abs=1e-12)


def test_one_class_gives_null_auc(spark):
    df = spark.createDataFrame([(0.2, 1), (0.4, 1)], "p double, Class int")
    r = ev.auc_ap(df).collect()[0]
    assert r.roc_auc is None
    assert r.average_precision == pytest.approx(1.0)


def test_confusion_has_all_cells_when_a_class_is_absent(spark):
    df = spark.createDataFrame([(0.2, 0), (0.7, 0)], "p double, Class int")
    r = ev.with_rates(ev.confusion(df, "Class", "p", 0.5)).collect()[0]
    assert (r.tn, r.fp, r.fn, r.tp) == (1, 1, 0, 0)
    assert (r.precision, r.recall, r.f1) == (0.0, 0.0, 0.0)


def test_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(0.5, 1)], "p double, Class int")
    assert ev.confusion(df, "Class", "p", 0.5).collect()[0].tp == 1


def test_threshold_sweep_equals_single_thresholds(spark):
    df = spark.createDataFrame(TIED, "p double, Class int")
    sweep = {r.threshold: r for r in ev.threshold_sweep(df, [0.1, 0.5, 0.95, 0.3]).collect()}
    for t in (0.1, 0.3, 0.5, 0.95):
        c = ev.confusion(df, "Class", "p", t).collect()[0]
        s = sweep[t]
        assert (s.tn, s.fp, s.fn, s.tp) == (c.tn, c.fp, c.fn, c.tp)


def test_last_n_rollup_empty_is_zero_and_nulls(spark):
    empty = spark.createDataFrame([], logs.PREDICTION_LOG)
    r = ev.last_n_rollup(empty, 100).collect()[0]
    assert (r["count"], r.fraud_rate, r.avg_probability) == (0, None, None)


def _sample(spark, values, name="x"):
    return spark.createDataFrame([(float(v),) for v in values], f"{name} double")


def test_empty_current_gives_zero_summary_and_warning(spark):
    ref = _sample(spark, range(50))
    cur = ref.limit(0)
    t = dr.drift_table(ref, cur, ["x"])
    s = dr.drift_summary(t).collect()[0]
    assert (s.number_of_columns, s.number_of_drifted_columns, s.share_of_drifted_columns, s.dataset_drift) == \
        (0, 0, 0.0, False)
    w = dr.sample_warnings(ref, cur, ["x"]).collect()[0]
    assert any("empty" in m for m in w.warnings)


@pytest.mark.parametrize("n,warn", [(29, True), (30, False)])
def test_small_sample_warning_edge(spark, n, warn):
    ref = _sample(spark, range(100))
    cur = _sample(spark, range(n))
    w = dr.sample_warnings(ref, cur, ["x"]).collect()[0]
    assert any("current sample has only" in m for m in w.warnings) is warn


def test_missing_column_warning_and_no_common_column(spark):
    ref = _sample(spark, range(40), "a")
    cur = _sample(spark, range(40), "b")
    w = dr.sample_warnings(ref, cur, ["a"]).collect()[0].warnings
    assert any("missing from current" in m for m in w)
    assert any("no column in common" in m for m in w)


def brute_ks_w1(a, b):
    xs = sorted(set(a) | set(b))

    def F_(s, x):
        return sum(1 for v in s if v <= x) / len(s)

    d = max(abs(F_(a, x) - F_(b, x)) for x in xs)
    w = sum(abs(F_(a, x) - F_(b, x)) * (xs[i + 1] - x) for i, x in enumerate(xs[:-1]))
    return d, w


@pytest.mark.parametrize("buckets", [1, 2, 7, 32])
def test_ks_and_wasserstein_match_brute_force(spark, buckets):
    a = [1, 2, 2, 3, 5, 8, 13, 13, 13, 21]
    b = [2, 3, 3, 4, 4, 4, 9, 10, 30]
    long = dr.stack(dr.to_long(_sample(spark, a), ["x"], "ref"), dr.to_long(_sample(spark, b), ["x"], "cur"))
    r = dr.numeric_tests(long, n_buckets=buckets).collect()[0]
    d, w = brute_ks_w1(a, b)
    assert r.ks_stat == pytest.approx(d)
    assert r.wasserstein == pytest.approx(w)
    mean = sum(a) / len(a)
    std = math.sqrt(sum((v - mean) ** 2 for v in a) / len(a))
    assert r.wasserstein_normed == pytest.approx(w / std)
    assert r.stattest_name == dr.KS_NAME  # 10 reference rows <= 1000


def test_ks_pvalue_known_values(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (0.05,)], "lam double")
    got = [r.p for r in df.select(dr.ks_pvalue(F.col("lam")).alias("p")).collect()]
    assert got[0] == pytest.approx(0.9639452436648751, abs=1e-12)
    assert got[1] == pytest.approx(0.26999967167735456, abs=1e-12)
    assert got[2] == 1.0


def test_chi_square_pvalue_against_closed_form(spark):
    # 2 degrees of freedom: survival function is exp(-x / 2)
    df = spark.createDataFrame([(3.0, 2.0), (0.5, 2.0), (10.0, 4.0)], "s double, k double")
    got = [r.p for r in df.select(dr.chi2_sf("s", "k").alias("p")).collect()]
    assert got[0] == pytest.approx(math.exp(-1.5), rel=1e-10)
    assert got[1] == pytest.approx(math.exp(-0.25), rel=1e-10)
    assert got[2] == pytest.approx(math.exp(-5) * (1 + 5), rel=1e-10)  # 4 dof: e^{-x/2}(1 + x/2)


def test_new_category_means_drift(spark):
    ref = spark.createDataFrame([("a",)] * 10 + [("b",)] * 10, "c string")
    cur = spark.createDataFrame([("a",)] * 10 + [("z",)] * 3, "c string")
    t = dr.drift_table(ref, cur, [], ["c"]).collect()[0]
    assert t.drift_score == 0.0 and t.drift_detected


def test_constant_column_scales_by_one(spark):
    df = _sample(spark, [5.0] * 4, "Amount")
    stats = fe.fit_stats(df, ["Amount"])
    out = [r.Amount for r in fe.standard_scale(df, stats, ["Amount"]).collect()]
    assert out == [0.0] * 4


def test_zscore_and_log(spark):
    df = _sample(spark, [0.0, 10.0], "Amount")
    v2 = fe.features_v2(df, fe.fit_stats(df, ["Amount"]), drop=()).orderBy("amount_log").collect()
    assert v2[1].amount_log == pytest.approx(math.log(11.0))
    assert v2[1].amount_zscore == pytest.approx(1.0, abs=1e-8)


def test_class_weight_no_positives(spark):
    df = spark.createDataFrame([(0,), (0,)], "Class int")
    assert {r.weight for r in fe.class_weight(df).collect()} == {1.0}


def test_validation_rejects_negative_amount_and_missing_field(spark):
    rows = [(1.0, 149.62), (None, 10.0), (0.5, -50.0)]
    df = spark.createDataFrame(rows, "V1 double, Amount double")
    rules = va.required(["V1", "Amount"]) + [("Amount must be >= 0", F.col("Amount") >= 0)]
    ok, bad = va.split_valid(df, rules)
    assert ok.count() == 1
    errs = sorted(tuple(r.errors) for r in bad.collect())
    assert errs == [("Amount must be >= 0",), ("V1 is required",)]


def test_signature_check_names_missing_columns(spark):
    df = spark.createDataFrame([(1.0,)], "Amount double")
    with pytest.raises(va.SchemaMismatchError, match="V1"):
        va.check_signature(df, [("V1", T.DoubleType()), ("Amount", T.DoubleType())])


def test_duplicate_prediction_id_first_arrival_wins(spark):
    batch = spark.createDataFrame(
        [("a", "2024-01-01 00:00:02", 0.9), ("a", "2024-01-01 00:00:01", 0.1), ("b", "2024-01-01 00:00:03", 0.5)],
        "prediction_id string, timestamp string, fraud_probability double").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz"))
    log = spark.createDataFrame([("b",)], "prediction_id string")
    out = logs.new_predictions(batch, log).collect()
    assert [(r.prediction_id, r.fraud_probability) for r in out] == [("a", 0.1)]


def test_version_nine_before_ten_and_null_metric_skipped(spark):
    versions = spark.createDataFrame([("m", "9", 9, "Production"), ("m", "10", 10, "Production"),
                                      ("m", "11", 11, "None")], "name string, version string, run_id long, stage string")
    runs = spark.createDataFrame([(9, 0.8), (10, 0.8), (11, None)], "run_id long, average_precision double")
    assert rg.resolve(versions).collect()[0].version == "10"
    assert rg.latest(versions).collect()[0].latest_version == "11"
    best = rg.best_versions(versions, runs, "average_precision").collect()[0]
    assert (best.best_version, best.n_candidates) == ("9", 2)  # tie -> lowest version; null metric skipped
    promoted = {r.version: r.stage for r in rg.promote(versions, rg.best_versions(versions, runs,
                                                                                   "average_precision")).collect()}
    assert promoted == {"9": "Production", "10": "Archived", "11": "None"}


def test_exact_percentiles_match_numpy(spark):
    import numpy as np

    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, 5.0, 3.0, 5.0]
    df = _sample(spark, vals)
    got = {r.q: r.value for r in pr.exact_percentiles(df, "x", [0.0, 0.5, 0.95, 1.0], n_buckets=3).collect()}
    for q in (0.0, 0.5, 0.95, 1.0):
        assert got[q] == pytest.approx(float(np.quantile(vals, q)))


def test_histogram_density_integrates_to_one(spark):
    df = _sample(spark, [0, 1, 1, 2, 3, 10])
    h = pr.histogram(df, "x", 5).collect()
    assert sum(r["count"] for r in h) == 6
    assert sum(r.density * (r.hi - r.lo) for r in h) == pytest.approx(1.0)


def test_column_names_normalised_case_insensitively(spark):
    from riskloom.plans import monitor

    df = spark.createDataFrame([(1.0, 2.0)], "AMOUNT double, v1 double")
    assert monitor.normalise_names(df, ["Amount", "V1"]).columns == ["Amount", "V1"]


def test_nulls_are_left_out_of_a_columns_test(spark):
    ref = spark.createDataFrame([(float(v),) for v in range(40)] + [(None,)] * 5, "x double")
    cur = spark.createDataFrame([(float(v),) for v in range(35)] + [(None,)] * 9, "x double")
    t = dr.drift_table(ref, cur, ["x"]).collect()[0]
    assert (t.n_ref, t.n_cur) == (40, 35)


def test_missing_timestamp_defaults_to_as_of(spark):
    rows = [("a", None, 1.0, 0.2, False, "1")]
    df = spark.createDataFrame(rows, "prediction_id string, timestamp timestamp_ntz, amount double, "
                                     "fraud_probability double, is_fraud boolean, model_version string")
    out = logs.conform(df, as_of=F.lit("2026-03-07 15:53:12").cast("timestamp_ntz")).collect()[0]
    assert str(out.timestamp) == "2026-03-07 15:53:12"


def test_timestamp_texts(spark):
    from riskloom.functions import scalars as sc

    df = spark.createDataFrame([("2026-03-07 15:53:12",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    r = df.select(sc.compact_stamp("t").alias("a"), sc.iso_utc("t").alias("b")).collect()[0]
    assert r.a == "20260307T155312Z"
    assert r.b == "2026-03-07T15:53:12.000000Z"


def test_exact_rank_keeps_large_integer_order(spark):
    from riskloom.operators import rolling as ro

    base = 2 ** 60
    df = spark.createDataFrame([("k", base + i) for i in (3, 1, 2, 0)], "key string, o long")
    got = {r.o - base: r._rank for r in ro.exact_rank(df, "key", F.col("o"), 2).collect()}
    assert got == {0: 1, 1: 2, 2: 3, 3: 4}


def test_single_scan_drift_check_equals_separate_operators(spark):
    from riskloom.plans import monitor
    from riskloom.sources import fixtures as fx

    ref, cur = fx.ref_cur(spark, "/root/testdata/sf0.001")
    res = monitor.drift_check(ref, cur, ["Amount", "Time"])
    a = {r.column_name: (r.drift_score, r.n_ref, r.n_cur) for r in res.table.collect()}
    b = {r.column_name: (r.drift_score, r.n_ref, r.n_cur) for r in dr.drift_table(ref, cur, ["Amount", "Time"]).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][1:] == b[k][1:] and a[k][0] == pytest.approx(b[k][0], rel=1e-12)
    h1 = {(r.column_name, r.sample, r.bin): r["count"] for r in res.histograms.collect()}
    h2 = {(r.column_name, r.sample, r.bin): r["count"] for r in dr.drift_histograms(ref, cur, ["Amount", "Time"]).collect()}
    assert h1 == h2
    w = res.warnings.collect()[0]
    assert (w.n_reference, w.n_current) == (ref.count(), cur.count())


def test_roc_thinning_drops_collinear_points(spark):
    rows = [(0.9, 1), (0.8, 1), (0.7, 1), (0.6, 0), (0.5, 0), (0.4, 0)]
    df = spark.createDataFrame(rows, "p double, Class int")
    got = sorted(r.threshold for r in ev.roc_curve_thinned(df, n_buckets=2).collect())
    assert got == [0.4, 0.7, 0.9]
    whole = ev.roc_curve_thinned(df, n_buckets=2, ends=True).orderBy("fpr", "tpr").collect()
    assert (whole[0].threshold, whole[0].fpr, whole[0].tpr) == (None, 0.0, 0.0) and len(whole) == 4
    area = sum((b.fpr - a.fpr) * (a.tpr + b.tpr) / 2 for a, b in zip(whole, whole[1:]))
    assert area == pytest.approx(ev.auc_ap(df).collect()[0].roc_auc)
    assert ev.roc_curve(df).count() == 6


def test_checked_broadcast_falls_back_above_the_bound(spark):
    from riskloom.operators.common import checked_broadcast

    big = spark.range(100).withColumnRenamed("id", "k")
    data = spark.range(1000).select((F.col("id") % 100).alias("k"), F.col("id").alias("v"))
    over = data.join(checked_broadcast(big, 10), "k")
    under = data.join(checked_broadcast(big, 1000), "k")
    assert over.count() == under.count() == 1000
    assert "BroadcastHashJoin" in under._jdf.queryExecution().executedPlan().toString()
