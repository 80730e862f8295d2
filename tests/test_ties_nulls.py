"""Results do not depend on the size of a key, a tie, a null or a NaN."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom.operators import drift as dr
from riskloom.operators import evaluate as ev
from riskloom.operators import features as fe
from riskloom.operators import profile as pr
from riskloom.operators import rolling as ro
from riskloom.sources import logs


@pytest.fixture(scope="module")
def tied(spark):
    """Times in steps of 20 minutes, four rows each; one null time and a null key among them."""
    i = F.col("id")
    return spark.range(60).select(
        i, F.when(i % 3 != 0, F.concat(F.lit("k"), i % 3)).alias("k"), (i * 7 % 11).alias("v"),
        F.when(i != 31, F.timestamp_seconds(F.floor(i / 12) * 1200)).alias("ts")).cache()


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("chunk", [5, 7])
def test_hot_equals_cold_with_ties_and_nulls(tied, chunk):
    order = F.unix_micros("ts")
    cold = ro.trailing_rows(tied, "k", order, 4, {"s": F.sum("v"), "n": F.count(F.lit(1))}, tie=["id"])
    assert cold.count() == 60
    hot = ro.trailing_rows(tied, "k", order, 4, {"s": F.sum("v"), "n": F.count(F.lit(1))}, chunk_rows=chunk, tie=["id"])
    assert _rows(hot.select(*cold.columns)) == _rows(cold)
    whole = ro.running_max(tied, "k", order, "v", "m")
    assert whole.count() == 60
    assert _rows(ro.running_max(tied, "k", order, "v", "m", chunk_rows=chunk).select(*whole.columns)) == _rows(whole)
    one = ro.sessions(tied, "k", "ts", 1200, {"n": F.count(F.lit(1))})
    assert one.agg(F.sum("n")).first()[0] == 60
    assert _rows(ro.sessions(tied, "k", "ts", 1200, {"n": F.count(F.lit(1))}, chunk_rows=chunk).select(*one.columns)) == _rows(one)


def test_null_class_is_kept(spark):
    d = spark.range(1000).select("id", F.when(F.col("id") % 10 != 0, F.col("id") % 2).alias("Class"), F.col("id").cast("double").alias("x"))
    assert fe.stratified_split(d, "Class", "id", 1).count() == 1000
    assert pr.histogram(d, "x", 5, by=["Class"]).where("Class IS NULL").agg(F.sum("count")).first()[0] == 100
    assert pr.kde(d, "x", "Class", bins=20, grid=10).where("Class IS NULL").count() == 10


def test_nan_is_missing_and_wide_correlation_is_pairwise(spark):
    x = F.when(F.col("id") % 7 == 0, F.lit(float("nan"))).otherwise(F.sin(F.col("id").cast("double")))
    d = spark.range(200).select("id", x.alias("x"), *[F.when(F.col("id") % (c + 3) != 0, F.cos(F.col("id") * (c + 1))).alias(f"c{c}") for c in range(45)])
    info = {r.column_name: r.nulls for r in pr.column_info(d, ["id", "x"]).collect()}
    assert info == {"id": 0, "x": 29}
    two = pr.corr_matrix(d, ["c0", "c1"]).where("a = 'c0' AND b = 'c1'").first().r
    wide = pr.corr_matrix(d, [f"c{c}" for c in range(45)])
    assert wide.count() == 45 * 45
    assert wide.where("a = 'c0' AND b = 'c1'").first().r == pytest.approx(two, abs=1e-12)
    t = dr.drift_table(d, d.where("id < 150"), ["x"]).first()
    assert t.n_ref == 171 and not math.isnan(t.drift_score)


@pytest.mark.parametrize("dof,p", [(2e5, 0.49958), (1e6, 0.49981), (1e7, 0.49994)])
def test_chi_squared_converges_at_many_categories(dof, p):
    import numpy as np

    assert dr._gammaincc(np.array([dof / 2]), np.array([dof / 2]))[0] == pytest.approx(p, abs=2e-5)


def test_curves_have_their_end_points(spark):
    d = spark.range(300).select((F.col("id") * 37 % 101 / 101).alias("p"), (F.col("id") % 3 == 0).cast("int").alias("Class"))
    pts = sorted((r.fpr, r.tpr) for r in ev.roc_curve(d, "Class", "p", ends=True).collect())
    assert pts[0] == (0.0, 0.0) and pts[-1] == (1.0, 1.0)
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(pts, pts[1:]))
    assert area == pytest.approx(ev.auc_ap(d, "Class", "p").first().roc_auc, abs=1e-12)
    assert ev.pr_curve(d, "Class", "p", ends=True).where("threshold IS NULL AND precision = 1 AND recall = 0").count() == 1


def test_log_rejects_nulls_and_keeps_reruns_out(spark, tmp_path):
    batch = spark.range(6).select(
        F.when(F.col("id") > 1, F.concat(F.lit("p"), "id")).alias("prediction_id"), F.lit("2024-01-01 00:00:00").alias("timestamp"),
        F.when(F.col("id") != 2, F.lit(1.0)).alias("amount"), F.lit(0.5).alias("fraud_probability"), F.lit(True).alias("is_fraud"),
        F.lit("1").alias("model_version"))
    path = str(tmp_path / "log")
    assert [logs.append_predictions(batch, path) for _ in range(2)] == [3, 0]
    assert spark.read.parquet(path).count() == 3
    assert spark.read.parquet(path + "-rejected").distinct().count() == 2


def test_shift_noise_does_not_follow_the_partitioning(spark):
    d = spark.range(100).select("id", F.lit(1.0).alias("Amount"), F.lit(0.0).alias("V1"))
    one, four = (dr.inject_shift(d.repartition(n), "id", noise_cols=["V1"]) for n in (1, 4))
    assert _rows(one.select("id", F.round("V1", 9))) == _rows(four.select("id", F.round("V1", 9)))
    s = one.agg(F.avg("V1").alias("m"), F.stddev("V1").alias("s")).first()
    assert abs(s.m) < 0.8 and 1.5 < s.s < 2.5
