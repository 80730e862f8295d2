"""Boosted-tree fit, batch scoring and importances with Spark ML.

Spark's GBT picks a feature subset per node (not per tree) and has no
column-sample-by-tree knob, so scores differ from other libraries: compare
metrics, not values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.validate import check_signature


@dataclass(frozen=True)
class GBTParams:
    """Fixed training settings. v1: depth 5, rate 0.01, 300 trees, subsample 0.8, feature share 0.8, seed 42."""
    max_depth: int = 5
    step_size: float = 0.01
    max_iter: int = 300
    subsample: float = 0.8
    feature_share: str = "0.8"
    seed: int = 42


V1_PARAMS = GBTParams()
V2_PARAMS = GBTParams(max_depth=6, step_size=0.05, max_iter=200)


def fit_gbt(train: DataFrame, features: Sequence[str], label: str = "Class", params: GBTParams = V1_PARAMS,
            weight_col: str | None = "weight", validation_col: str | None = None) -> PipelineModel:
    """Fit assembler + GBT (M4, M5); ``weight_col`` carries the class weight (M3)."""
    from pyspark.ml import Pipeline

    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxDepth=params.max_depth, stepSize=params.step_size,
                        maxIter=params.max_iter, subsamplingRate=params.subsample,
                        featureSubsetStrategy=params.feature_share, seed=params.seed)
    if weight_col:
        gbt = gbt.setWeightCol(weight_col)
    if validation_col:
        gbt = gbt.setValidationIndicatorCol(validation_col)
    d = train.withColumn(label, F.col(label).cast("double"))
    return Pipeline(stages=[asm, gbt]).fit(d)


def score(model: PipelineModel, df: DataFrame, threshold: float = 0.5, keep: Sequence[str] = ()) -> DataFrame:
    """Batch scoring (M6): fraud_probability = P(class 1) (X7), is_fraud = p >= threshold (F7). Input columns
    that the model was fitted on and ``df`` lacks raise ``SchemaMismatchError`` before anything runs (P7)."""
    check_signature(df, [(c, DoubleType()) for s in model.stages[:1] for c in s.getInputCols()])
    out = model.transform(df)
    p = vector_to_array(F.col("probability"))[1]
    return out.select(*keep, p.alias("fraud_probability"), (p >= threshold).alias("is_fraud"))


def importances(model: PipelineModel, features: Sequence[str], k: int = 15) -> DataFrame:
    """Top-k feature importances (M7, D4); the importance vector has one entry per feature."""
    from pyspark.sql import SparkSession

    vec = model.stages[-1].featureImportances.toArray().tolist()  # one value per feature: bounded by the schema
    df = SparkSession.getActiveSession().createDataFrame(list(zip(features, [float(v) for v in vec])), "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(k)
