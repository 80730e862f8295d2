"""Stand-in views over the driver's test tables.

The risk operators need a transactions table, a scored table, a prediction
log, a latency log and a model registry. These views derive each of them from
the given tables, so every query's work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import fixture_table

# Fixed values of the fixture definitions.
DRIFT_SPLIT_TS = "2024-01-16 00:00:00"   # ref = before, cur = at or after
STAGES = ["None", "Staging", "Production"]  # stage = STAGES[p_partkey % 3]
PROBABILITY_OFFSET = 50.0                 # fraud_probability = value / (value + 50)
NUM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _epoch_micros(c):
    # Timestamps are read as TIMESTAMP_NTZ; the session time zone is UTC.
    return F.unix_micros(c.cast("timestamp"))


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions: tx_id, ts, user_id, Time (s since first event), Amount, Class."""
    ev = fixture_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    t0 = ev.agg(F.min(_epoch_micros(F.col("ts")))).scalar()  # scalar subquery: the first event time
    return (
        ev.select(
            F.col("event_id").alias("tx_id"),
            "ts",
            "user_id",
            ((_epoch_micros(F.col("ts")) - t0) / F.lit(1_000_000.0)).alias("Time"),
            F.col("value").alias("Amount"),
            (F.col("event_type") == "error").cast("int").alias("Class"),
        )
    )


def tx_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`tx` plus the categorical event_type (for the categorical drift test)."""
    ev = fixture_table(spark, sf_dir, "events").select(F.col("event_id").alias("tx_id"), "event_type")
    return tx(spark, sf_dir).join(ev, "tx_id")


def num(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four numeric lineitem columns and Class = returned."""
    li = fixture_table(spark, sf_dir, "lineitem")
    return li.select(*NUM_FEATURES, (F.col("l_returnflag") == "R").cast("int").alias("Class"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`num` with a tie-heavy score p = round(l_extendedprice, -2) / 200000."""
    return num(spark, sf_dir).withColumn("p", F.round("l_extendedprice", -2) / F.lit(200000.0))


def feat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 29-column request layout: V1..V28 from embeddings, Amount and Time from events."""
    emb = fixture_table(spark, sf_dir, "embeddings")
    t = tx(spark, sf_dir).select("tx_id", "ts", "Time", "Amount")
    vcols = [F.col("embedding")[i].cast("double").alias(f"V{i + 1}") for i in range(28)]
    return (
        emb.join(t, emb.vec_id == t.tx_id, "inner")
        .select("tx_id", "ts", "Time", *vcols, "Amount",
                (F.col("label") == 0).cast("int").alias("Class"))
    )


def pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction log: prediction_id, timestamp, amount, fraud_probability, is_fraud, model_version."""
    ev = fixture_table(spark, sf_dir, "events")
    p = F.col("value") / (F.col("value") + F.lit(PROBABILITY_OFFSET))
    return ev.select(
        F.col("event_id").cast("string").alias("prediction_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("amount"),
        p.alias("fraud_probability"),
        (p >= 0.5).alias("is_fraud"),
        (F.lit(1) + F.col("user_id") % 3).cast("string").alias("model_version"),
    )


def lat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log: ok, latency (s), ts."""
    ev = fixture_table(spark, sf_dir, "events")
    return ev.select((F.col("event_type") != "error").alias("ok"),
                     (F.col("value") / 1000.0).alias("latency"), "ts")


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model registry rows: name, version (text), run_id, stage."""
    part = fixture_table(spark, sf_dir, "part")
    stage = F.element_at(F.array(*[F.lit(s) for s in STAGES]), (F.col("p_partkey") % 3 + 1).cast("int"))
    return part.select(F.col("p_brand").alias("name"), F.col("p_partkey").cast("string").alias("version"),
                       F.col("p_partkey").alias("run_id"), stage.alias("stage"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run metrics: run_id, average_precision (null = not logged)."""
    part = fixture_table(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("run_id"),
                       F.when(F.col("p_size") > 5, F.col("p_retailprice")).alias("average_precision"))


def uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_table(spark, sf_dir, "pages").select("page_id", "url")


def feat_ref_cur(spark: SparkSession, sf_dir: str, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Reference = train split, current = test split of `feat` (the monitor compares training data with new rows)."""
    from ..operators.features import stratified_split

    s = stratified_split(feat(spark, sf_dir), "Class", "tx_id", seed)
    return s.where(F.col("split") == "train"), s.where(F.col("split") == "test")


def ref_cur(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Reference (before the split time) and current (at or after) samples of `tx`."""
    t = source if source is not None else tx(spark, sf_dir)
    cut = F.lit(DRIFT_SPLIT_TS).cast("timestamp_ntz")
    return t.where(F.col("ts") < cut), t.where(F.col("ts") >= cut)
