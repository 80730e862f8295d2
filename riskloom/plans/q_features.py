"""Registered feature queries: exact stratified split, fitted stats, v1 / v2 features, class weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as fe
from ..operators import profile as pr
from ..sources import fixtures as fx
from .registry import query
from .registry import round_cols as _r

SEED = 42
VCOLS = [f"V{i}" for i in range(1, 29)]


def split_sql(view: str, seed: int = SEED) -> str:
    """CTE `spl`: the view with its split column, as the oracle states it."""
    rest = 'ceil(CAST(0.3 AS DOUBLE) * n)'
    return f"""spl AS (
  SELECT * EXCLUDE (rk, n), CASE WHEN rk <= n - {rest} THEN 'train'
                  WHEN rk <= n - {rest} + floor({rest} * CAST(0.5 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY "Class" ORDER BY md5(concat_ws('|', '{seed}', CAST(tx_id AS VARCHAR))), tx_id) AS rk,
               count(*) OVER (PARTITION BY "Class") AS n FROM {view}) r)"""


@query("d6_stratified_split", f"""WITH {split_sql('tx')} SELECT tx_id, "Class", split FROM spl""", ("tx",))
def d6_stratified_split(spark, sf):
    return fe.stratified_split(fx.tx(spark, sf).select("tx_id", "Class"), "Class", "tx_id", SEED)


@query("w6_split_class_share", f"""WITH {split_sql('tx')}
SELECT split, "Class", CAST(count(*) AS BIGINT) AS count,
       round(count(*) / sum(count(*)) OVER (PARTITION BY split), 6) AS share FROM spl GROUP BY split, "Class" """, ("tx",))
def w6_split_class_share(spark, sf):
    s = fe.stratified_split(fx.tx(spark, sf).select("tx_id", "Class"), "Class", "tx_id", SEED)
    return _r(pr.class_balance(s, "Class", by=["split"]), ["share"])


@query("k4_fitted_stats", f"""WITH {split_sql('feat')}
SELECT 'Amount' AS column_name, CAST(count("Amount") AS BIGINT) AS n, round(avg("Amount"), 6) AS mean,
       round(stddev_pop("Amount"), 6) AS std_pop FROM spl WHERE split = 'train'""", ("feat",))
def k4_fitted_stats(spark, sf):
    s = fe.stratified_split(fx.feat(spark, sf), "Class", "tx_id", SEED)
    return _r(fe.fit_stats(s.where(F.col("split") == "train"), ["Amount"]), ["mean", "std_pop"])


_V = ", ".join(VCOLS)


@query("m1_features_v1", f"""WITH {split_sql('feat')},
st AS (SELECT avg("Amount") AS m, stddev_pop("Amount") AS s FROM spl WHERE split = 'train')
SELECT tx_id, ts, {_V}, round(("Amount" - m) / CASE WHEN s > 0 THEN s ELSE 1.0 END, 6) AS "Amount", "Class", split
FROM spl, st""", ("feat",))
def m1_features_v1(spark, sf):
    s = fe.stratified_split(fx.feat(spark, sf), "Class", "tx_id", SEED)
    stats = fe.fit_stats(s.where(F.col("split") == "train"), ["Amount"])
    return _r(fe.features_v1(s, stats), ["Amount"])


@query("m2_features_v2", f"""WITH {split_sql('feat')},
st AS (SELECT avg("Amount") AS m, stddev_pop("Amount") AS s FROM spl WHERE split = 'train')
SELECT tx_id, ts, {_V}, round(("Amount" - m) / CASE WHEN s > 0 THEN s ELSE 1.0 END, 6) AS "Amount", "Class", split,
       round(ln(1 + "Amount"), 6) AS amount_log, round(("Amount" - m) / (s + 1e-9), 6) AS amount_zscore
FROM spl, st""", ("feat",))
def m2_features_v2(spark, sf):
    s = fe.stratified_split(fx.feat(spark, sf), "Class", "tx_id", SEED)
    stats = fe.fit_stats(s.where(F.col("split") == "train"), ["Amount"])
    return _r(fe.features_v2(s, stats), ["Amount", "amount_log", "amount_zscore"])


@query("m3_class_weight", """
WITH r AS (SELECT CASE WHEN count_if("Class" = 1) > 0 THEN count_if("Class" <> 1) / count_if("Class" = 1) END AS ratio FROM tx)
SELECT tx_id, "Class", round(CASE WHEN "Class" = 1 AND ratio IS NOT NULL THEN ratio ELSE 1.0 END, 6) AS weight
FROM tx, r""", ("tx",))
def m3_class_weight(spark, sf):
    return _r(fe.class_weight(fx.tx(spark, sf).select("tx_id", "Class")), ["weight"])


@query("j5_x2_amount_zscore", """
WITH st AS (SELECT avg("Amount") AS m, stddev_pop("Amount") AS s FROM tx)
SELECT tx_id, round(("Amount" - m) / (s + 1e-9), 6) AS amount_zscore, round(ln(1 + "Amount"), 6) AS amount_log
FROM tx, st""", ("tx",))
def j5_x2_amount_zscore(spark, sf):
    t = fx.tx(spark, sf).select("tx_id", "Amount")
    stats = fe.fit_stats(t, ["Amount"])  # fit_on="all": the reference's full-set fit
    z = fe.zscore(t, stats, "Amount", "amount_zscore").withColumn("amount_log", F.log1p("Amount"))
    return _r(z.select("tx_id", "amount_zscore", "amount_log"), ["amount_zscore", "amount_log"])
