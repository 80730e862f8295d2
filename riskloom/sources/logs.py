"""Prediction log, drift reports and retrain triggers as tables (S5-S11, J4, T5 batch form)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.common import materialize
from .tables import MissingSourceError, load_table

# Prediction log layout; every field is required.
PREDICTION_LOG = T.StructType([
    T.StructField("prediction_id", T.StringType(), False),
    T.StructField("timestamp", T.TimestampNTZType(), False),
    T.StructField("amount", T.DoubleType(), False),
    T.StructField("fraud_probability", T.DoubleType(), False),
    T.StructField("is_fraud", T.BooleanType(), False),
    T.StructField("model_version", T.StringType(), False),
])

_SMALL_DIST = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType())),
                            T.StructField("y", T.ArrayType(T.DoubleType()))])
_COLUMN_RESULT = T.StructType([
    T.StructField("column_name", T.StringType()), T.StructField("column_type", T.StringType()),
    T.StructField("stattest_name", T.StringType()), T.StructField("stattest_threshold", T.DoubleType()),
    T.StructField("drift_score", T.DoubleType()), T.StructField("drift_detected", T.BooleanType()),
    T.StructField("current", T.StructType([T.StructField("small_distribution", _SMALL_DIST)])),
    T.StructField("reference", T.StructType([T.StructField("small_distribution", _SMALL_DIST)])),
])
# Drift report layout (nested): metrics[] of {metric, result{..., drift_by_columns map}}.
DRIFT_REPORT = T.StructType([T.StructField("metrics", T.ArrayType(T.StructType([
    T.StructField("metric", T.StringType()),
    T.StructField("result", T.StructType([
        T.StructField("drift_share", T.DoubleType()),
        T.StructField("number_of_columns", T.LongType()),
        T.StructField("number_of_drifted_columns", T.LongType()),
        T.StructField("share_of_drifted_columns", T.DoubleType()),
        T.StructField("dataset_drift", T.BooleanType()),
        T.StructField("drift_by_columns", T.MapType(T.StringType(), _COLUMN_RESULT)),
    ])),
])))])


def conform(df: DataFrame, schema: T.StructType = PREDICTION_LOG, as_of: Column | None = None) -> DataFrame:
    """Cast to the log layout; a missing timestamp becomes ``as_of`` (default: now)."""
    ts_default = as_of if as_of is not None else F.localtimestamp()
    cols = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if f.name == "timestamp":
            c = F.coalesce(c, ts_default.cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def not_null_violations(df: DataFrame, schema: T.StructType = PREDICTION_LOG) -> DataFrame:
    """Rows breaking a NOT NULL field of the layout."""
    cond = None
    for f in schema.fields:
        if not f.nullable:
            c = F.col(f.name).isNull()
            cond = c if cond is None else (cond | c)
    return df.where(cond) if cond is not None else df.limit(0)


def new_predictions(batch: DataFrame, log: DataFrame, key: str = "prediction_id", arrival: str = "timestamp",
                    tie: str | None = None) -> DataFrame:
    """INSERT OR IGNORE semantics (S6, J4): within the batch the first arrival per id wins,
    and ids already in the log are left out (anti join)."""
    order = [F.asc(arrival)] + ([F.asc(tie)] if tie else [])
    w = Window.partitionBy(key).orderBy(*order)
    first = batch.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    # distinct ids first (partial aggregation before the shuffle): copies of one id in the log
    # collapse to one row instead of forming a hot join key
    return first.join(log.select(key).distinct(), key, "left_anti")


def accepted_rows(df: DataFrame, schema: T.StructType = PREDICTION_LOG) -> DataFrame:
    """Rows with every NOT NULL field of the layout present (S5): all but ``not_null_violations``."""
    return df.na.drop(subset=[f.name for f in schema.fields if not f.nullable])


def append_predictions(batch: DataFrame, path: str, key: str = "prediction_id", quarantine: str | None = None) -> int:
    """Append the batch rows whose id is new to the Parquet log at ``path``; returns rows written.

    Rows that break a NOT NULL field go to ``quarantine`` (default: the log's path with ``-rejected``), into a folder
    that is named after the rows, so that a batch appended again replaces its own, and never to the log. Only a missing
    path counts as "no log yet"; any other read error is raised. Every id of the log is read; ``sources.idlog`` holds a
    log that need not."""
    spark = batch.sparkSession
    try:
        log = load_table(spark, path, schema=PREDICTION_LOG)
    except MissingSourceError:
        log = spark.createDataFrame([], PREDICTION_LOG)
    rows = materialize(conform(batch))
    broken = not_null_violations(rows)
    if not broken.isEmpty():
        # a sum of row hashes: the same rows give the same folder, in any order
        name = broken.agg(F.sum(F.xxhash64(*broken.columns).cast("decimal(20,0)")).cast("string")).first()[0]
        broken.write.mode("overwrite").parquet(f"{(quarantine or path.rstrip('/') + '-rejected')}/batch={name}")
    fresh = materialize(new_predictions(accepted_rows(rows), log, key))
    fresh.write.mode("append").parquet(path)
    return fresh.count()


def report_rows(table: DataFrame, summary: DataFrame, hist: DataFrame, run_ts: Column) -> DataFrame:
    """The drift result as one nested report row (S9): metrics array with the dataset block and the
    per-column map including both small distributions."""
    def dist(sample):
        h = hist.where(F.col("sample") == sample)
        g = h.groupBy("column_name").agg(
            F.sort_array(F.collect_list(F.struct("bin", "lo", "hi", "density"))).alias("b"))  # <= bins per column
        return g.select("column_name", F.struct(
            F.concat(F.transform("b", lambda s: s["lo"]), F.array(F.element_at(F.col("b"), -1)["hi"])).alias("x"),
            F.transform("b", lambda s: s["density"]).alias("y")).alias(sample))
    cols = (table.join(dist("current"), "column_name", "left").join(dist("reference"), "column_name", "left")
            .select("column_name", F.struct(
                "column_name", "column_type", "stattest_name", "stattest_threshold", "drift_score", "drift_detected",
                F.struct(F.col("current").alias("small_distribution")).alias("current"),
                F.struct(F.col("reference").alias("small_distribution")).alias("reference")).alias("r")))
    by_col = cols.agg(F.map_from_entries(F.collect_list(F.struct("column_name", "r")))).scalar()
    s = summary.withColumn("drift_by_columns", by_col)
    ds = F.struct(F.col("dataset_drift_threshold").alias("drift_share"), "number_of_columns",
                  "number_of_drifted_columns", "share_of_drifted_columns", "dataset_drift",
                  F.lit(None).cast(DRIFT_REPORT["metrics"].dataType.elementType["result"].dataType["drift_by_columns"]
                                   .dataType).alias("drift_by_columns"))
    tb = F.struct(F.lit(None).cast("double").alias("drift_share"), "number_of_columns", "number_of_drifted_columns",
                  "share_of_drifted_columns", "dataset_drift", "drift_by_columns")
    return s.select(F.array(F.struct(F.lit("DatasetDriftMetric").alias("metric"), ds.alias("result")),
                            F.struct(F.lit("DataDriftTable").alias("metric"), tb.alias("result"))).alias("metrics"),
                    F.date_format(run_ts, "yyyyMMdd'T'HHmmss'Z'").alias("run_ts"))


def write_report(report: DataFrame, path: str) -> None:
    """Drift-report sink (S9): JSON partitioned by the run stamp. Only the run's own partition is
    replaced, so a re-run of the same check does not leave a duplicate report."""
    (report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_ts").json(path))


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Drift-report source (S10) -> one row per (report, column): run_ts, column_name and its result."""
    raw = spark.read.schema(DRIFT_REPORT).option("multiLine", True).json(path)
    if "run_ts" not in raw.columns:  # plain files: the stamp is in the file's name
        stamp = F.regexp_extract(F.col("_metadata.file_path"), r"(\d{8}[T_-]?\d{6}Z?)[^/]*$", 1)
        raw = raw.withColumn("run_ts", F.nullif(stamp, F.lit("")))
    m = raw.select("run_ts", F.explode("metrics").alias("m")).where(F.col("m.result.drift_by_columns").isNotNull())
    return m.select("run_ts", F.explode("m.result.drift_by_columns").alias("column_name", "r")).select(
        "run_ts", "column_name", "r.stattest_name", "r.drift_score", "r.drift_detected")


def drift_history(reports: DataFrame) -> DataFrame:
    """Newest report per day and column."""
    d = reports.withColumn("day", F.substring("run_ts", 1, 8))
    w = Window.partitionBy("day", "column_name").orderBy(F.desc("run_ts"))
    return d.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


#: What an evaluation run leaves behind: its tags, its parameters and its metrics (M8).
RUN_METRICS = ("run_name string, evaluation_type string, model_name string, model_version string, model_stage string, "
               "source_run_id long, test_data_path string, test_n_samples long, test_n_fraud long, threshold double, "
               "roc_auc double, average_precision double, precision double, recall double, f1 double, "
               "tp long, fp long, tn long, fn long, logged_at timestamp")


def run_row(metrics: DataFrame, model_name: str, stage: str, source_run_id: int, as_of: Column) -> DataFrame:
    """The run record of an ``evaluate`` row (M8)."""
    kinds = {f.name: f.dataType for f in T.StructType.fromDDL(RUN_METRICS).fields}
    values = {"run_name": F.concat(F.lit(f"eval-{model_name}-v"), F.col("model_version")), "evaluation_type": F.lit("test_set"),
              "model_name": F.lit(model_name), "model_stage": F.lit(stage), "source_run_id": F.lit(source_run_id),
              "test_data_path": F.col("path"), "test_n_samples": F.col("n"), "test_n_fraud": F.col("positives"), "logged_at": as_of}
    return metrics.select(*[values.get(c, F.col(c)).cast(k).alias(c) for c, k in kinds.items()])


def write_run_metrics(rows: DataFrame, path: str) -> None:
    """Sink of run records, one folder per model, version and time: a run that is logged again replaces its record."""
    stamped = rows.withColumn("run", F.concat_ws("-", "run_name", F.date_format("logged_at", "yyyyMMdd'T'HHmmssSSS")))
    (stamped.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path))


def read_run_metrics(spark: SparkSession, path: str) -> DataFrame:
    return load_table(spark, path, schema=T.StructType.fromDDL(RUN_METRICS)).drop("run")


def write_trigger(payload: DataFrame, path: str) -> int:
    """Retrain-trigger sink (S11): writes only fired decisions, partitioned by their timestamp so a
    re-run replaces its own record instead of adding a second one; returns rows written."""
    fired = materialize_small(payload.where("triggered"))
    n = fired.count()
    if n:
        (fired.withColumn("fired_at", F.col("timestamp")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("fired_at").json(path))
    return n


def materialize_small(df: DataFrame, max_rows: int = 1000) -> DataFrame:
    """A result of at most a few rows, computed once (a trigger record): fetched with a bound and
    planned as a local relation, so counting and writing it do not evaluate it twice."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"expected at most {max_rows} rows")
    return df.sparkSession.createDataFrame(rows, df.schema)
