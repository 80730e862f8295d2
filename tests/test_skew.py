"""Results stay exact when one value, key or stratum holds a large share of the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import drift as dr
from riskloom.operators import evaluate as ev
from riskloom.operators import features as fe
from riskloom.operators import rolling as ro
from riskloom.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def _auc_ap_numpy(scores, labels):
    order = np.argsort(-scores, kind="stable")
    s, y = scores[order], labels[order]
    uniq, idx = np.unique(-s, return_index=True)
    pos = np.add.reduceat(y, idx)
    neg = np.add.reduceat(1 - y, idx)
    tp, fp = np.cumsum(pos), np.cumsum(neg)
    P, N = pos.sum(), neg.sum()
    auc = float(np.sum(neg * (tp - pos / 2.0)) / (P * N))
    ap = float(np.sum(pos * tp / (tp + fp)) / P)
    return auc, ap


@pytest.mark.parametrize("parts", ["1", "64"])
def test_auc_with_a_hot_score(spark, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        s = fx.scored(spark, SF).withColumn(
            "p", F.when(F.abs(F.hash("l_extendedprice", "l_quantity")) % 3 == 0, F.lit(0.25)).otherwise(F.col("p")))
        got = ev.auc_ap(s).collect()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    pdf = s.select("p", "Class").toPandas()
    assert (pdf.p == 0.25).mean() > 0.3
    auc, ap = _auc_ap_numpy(pdf.p.to_numpy(), pdf.Class.to_numpy())
    assert got.roc_auc == pytest.approx(auc, abs=1e-12)
    assert got.average_precision == pytest.approx(ap, abs=1e-12)


def test_drift_with_a_hot_value(spark):
    ref, cur = fx.ref_cur(spark, SF)
    hot = F.when(F.col("tx_id") % 3 == 0, F.lit(50.0)).otherwise(F.col("Amount"))
    ref, cur = ref.withColumn("Amount", hot), cur.withColumn("Amount", F.col("Amount") * 1.1)
    long = dr.stack(dr.to_long(ref, ["Amount"], "ref"), dr.to_long(cur, ["Amount"], "cur"))
    got = dr.numeric_tests(long).collect()[0]
    a = np.sort(ref.select("Amount").toPandas().Amount.to_numpy())
    b = np.sort(cur.select("Amount").toPandas().Amount.to_numpy())
    xs = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(a, xs, side="right") / len(a)
    fb = np.searchsorted(b, xs, side="right") / len(b)
    assert got.ks_stat == pytest.approx(np.max(np.abs(fa - fb)))
    assert got.wasserstein == pytest.approx(np.sum(np.abs(fa - fb)[:-1] * np.diff(xs)))
    assert got.std_ref == pytest.approx(np.std(a))


def test_split_with_a_99_percent_stratum(spark):
    t = fx.tx(spark, SF).withColumn("Class", (F.col("tx_id") % 100 == 0).cast("int"))
    s = fe.stratified_split(t.select("tx_id", "Class"), "Class", "tx_id", 7)
    counts = {(r.Class, r.split): r["count"] for r in s.groupBy("Class", "split").count().collect()}
    import math

    for cls in (0, 1):
        n = sum(v for (c, _), v in counts.items() if c == cls)
        rest = math.ceil(0.3 * n)
        assert counts.get((cls, "train"), 0) == n - rest
        assert counts.get((cls, "val"), 0) == rest // 2
    assert s.select("tx_id").distinct().count() == t.count()


def test_last_n_with_a_single_key(spark):
    p = fx.pred(spark, SF).withColumn("model_version", F.lit("only"))
    got = [r.prediction_id for r in ro.last_n_per_key(p, "model_version", "timestamp", "prediction_id", 5)
           .orderBy("rn").collect()]
    want = [r.prediction_id for r in p.orderBy(F.desc("timestamp"), "prediction_id").limit(5).collect()]
    assert got == want
