"""Registered model queries: fit boosted trees on the train split, score the test split, importances,
evaluate the scores. Model fits are not SQL, so these carry no oracle SQL."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import features as fe
from ..operators import models as mo
from ..sources import fixtures as fx
from .registry import query

FEATS = [f"V{i}" for i in range(1, 29)] + ["Amount"]
V2_FEATS = FEATS + ["amount_log", "amount_zscore"]


def _splits(spark, sf):
    s = fe.stratified_split(fx.feat(spark, sf), "Class", "tx_id", 42)
    stats = fe.fit_stats(s.where(F.col("split") == "train"), ["Amount"])
    v2 = fe.features_v2(s, stats)
    return v2.where(F.col("split") != "test"), v2.where(F.col("split") == "test")


#: Models of this process by session, tables and settings: the queries below share one fit of each.
_FITTED: dict[tuple, PipelineModel] = {}


def _fit(spark, sf, params=mo.V2_PARAMS, features=tuple(V2_FEATS)):
    """Fitted on train, the val split decides when to stop (M4, M5); with the v2 settings unless others are given."""
    fit, test = _splits(spark, sf)
    key = (spark.sparkContext.applicationId, sf, params, features)
    if key not in _FITTED:
        weighted = fe.class_weight(fit).withColumn("is_val", F.col("split") == "val")
        _FITTED[key] = mo.fit_gbt(weighted, list(features), "Class", params, weight_col="weight", validation_col="is_val")
    return _FITTED[key], test


@query("m4_m6_gbt_scores")
def m4_m6_gbt_scores(spark, sf):
    """Fit v2 features with class weights on train, score the test split."""
    model, test = _fit(spark, sf)
    return mo.score(model, test, 0.5, keep=["tx_id", "Class"])


@query("m7_d4_feature_importance")
def m7_d4_feature_importance(spark, sf):
    model, _ = _fit(spark, sf)
    return mo.importances(model, V2_FEATS, 15)


@query("m8_evaluate_model")
def m8_evaluate_model(spark, sf):
    model, test = _fit(spark, sf)
    scored = mo.score(model, test, 0.5, keep=["Class"])
    return ev.evaluate(scored, "Class", "fraud_probability", 0.5, model_version="v2", path="memory")


#: What any right model gives for every row of the test split: its key, a probability, and the flag of that probability.
_VALID_SQL = """SELECT tx_id, "Class", true AS in_range, true AS flag_agrees FROM fcur"""


def _valid(scored):
    p = F.col("fraud_probability")
    return scored.select("tx_id", "Class", ((p >= 0) & (p <= 1) & ~F.isnan(p)).alias("in_range"), (F.col("is_fraud") == (p >= 0.5)).alias("flag_agrees"))


@query("m6_scores_valid", _VALID_SQL, ("fcur",))
def m6_scores_valid(spark, sf):
    """Every test row is scored once by the v2 model, with a probability and the flag of the threshold."""
    model, test = _fit(spark, sf)
    return _valid(mo.score(model, test, 0.5, keep=["tx_id", "Class"]))


@query("m4_v1_scores_valid", _VALID_SQL, ("fcur",))
def m4_v1_scores_valid(spark, sf):
    """The v1 settings (29 features, 300 trees of depth 5) fitted, and every test row scored."""
    model, test = _fit(spark, sf, mo.V1_PARAMS, tuple(FEATS))
    return _valid(mo.score(model, test, 0.5, keep=["tx_id", "Class"]))


@query("m7_importances_valid", """
SELECT CAST(15 AS BIGINT) AS n, CAST(15 AS BIGINT) AS n_names, true AS known, true AS in_range, (SELECT count(*) FROM fspl WHERE split <> 'test') AS n_fitted""", ("fspl",))
def m7_importances_valid(spark, sf):
    """Fifteen features of the model, each with its share of the importance."""
    model, _ = _fit(spark, sf)
    fit, _ = _splits(spark, sf)
    top = mo.importances(model, V2_FEATS, 15)
    return top.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("feature").alias("n_names"), F.bool_and(F.col("feature").isin(V2_FEATS)).alias("known"),
                   F.bool_and((F.col("importance") >= 0) & (F.col("importance") <= 1)).alias("in_range")).withColumn(
                       "n_fitted", fit.agg(F.count(F.lit(1))).scalar())


@query("m8_model_cells", """
SELECT CAST(count(*) AS BIGINT) AS n, CAST(count_if("Class" = 1) AS BIGINT) AS positives, CAST(count(*) AS BIGINT) AS n_cells,
       CAST(count_if("Class" = 1) AS BIGINT) AS n_positive_cells FROM fcur""", ("fcur",))
def m8_model_cells(spark, sf):
    """The model's confusion cells cover the test split and its positives."""
    model, test = _fit(spark, sf)
    m = ev.evaluate(mo.score(model, test, 0.5, keep=["Class"]), "Class", "fraud_probability", 0.5)
    return m.select("n", "positives", (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("n_cells"), (F.col("tp") + F.col("fn")).alias("n_positive_cells"))
