"""Feature building, fitted statistics and the exact stratified split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix import stratified_rank
from .profile import mean_std

ZSCORE_EPS = 1e-9  # fixed: z = (x - mean) / (std_pop + 1e-9)


def stratified_split(df: DataFrame, label: str = "Class", key: str = "tx_id", seed: int = 42,
                     test_size: float = 0.3, val_share: float = 0.5, split_col: str = "split") -> DataFrame:
    """Seeded, exact stratified train / val / test split.

    Per stratum of n rows, in md5(seed|key) order: rest = ceil(test_size * n),
    val = floor(rest * val_share), test = rest - val, train = n - rest.
    Repeatable on any partitioning; a stratum with most rows is spread over
    4,096 md5 buckets.
    """
    r = stratified_rank(df, [label], [key], seed)
    n = F.col("stratum_n")
    rest = F.ceil(F.lit(test_size) * n)
    val = F.floor(rest * F.lit(val_share))
    rank = F.col("stratum_rank")
    split = (F.when(rank <= n - rest, F.lit("train"))
             .when(rank <= n - rest + val, F.lit("val"))
             .otherwise(F.lit("test")))
    return r.withColumn(split_col, split).drop("_order", "stratum_rank", "stratum_n")


def fit_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fitted-stats table (K4): column_name, n, mean, std_pop. Store it beside the model."""
    return mean_std(df, columns)


def _wide(stats: DataFrame, columns: Sequence[str]):
    """The long stats table as one struct-valued scalar subquery: <c>__mean, <c>__std per column."""
    fields = []
    for c in columns:
        fields += [F.max(F.when(F.col("column_name") == c, F.col("mean"))).alias(f"{c}__mean"),
                   F.max(F.when(F.col("column_name") == c, F.col("std_pop"))).alias(f"{c}__std")]
    return stats.agg(F.struct(*fields)).scalar()


def standard_scale(df: DataFrame, stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """x -> (x - mean) / std_pop with fitted stats; std = 0 divides by 1."""
    w = _wide(stats, columns)
    out = df
    for c in columns:
        sd = w[f"{c}__std"]
        out = out.withColumn(c, (F.col(c) - w[f"{c}__mean"]) / F.when(sd > 0, sd).otherwise(F.lit(1.0)))
    return out


def zscore(df: DataFrame, stats: DataFrame, column: str, out: str) -> DataFrame:
    """out = (x - mean) / (std_pop + 1e-9) with fitted stats."""
    w = _wide(stats, [column])
    return df.withColumn(out, (F.col(column) - w[f"{column}__mean"]) / (w[f"{column}__std"] + F.lit(ZSCORE_EPS)))


def features_v1(df: DataFrame, stats: DataFrame, amount: str = "Amount", drop: Sequence[str] = ("Time",)) -> DataFrame:
    """v1 features (M1): drop Time, scale Amount with stats fitted on train."""
    return standard_scale(df.drop(*drop), stats, [amount])


def features_v2(df: DataFrame, stats: DataFrame, amount: str = "Amount", drop: Sequence[str] = ("Time",)) -> DataFrame:
    """v2 features (M2): amount_log = log1p(raw Amount), amount_zscore from raw Amount, then scale Amount."""
    d = df.withColumn("amount_log", F.log1p(F.col(amount)))
    d = zscore(d, stats, amount, "amount_zscore")
    return standard_scale(d.drop(*drop), stats, [amount])


def class_weight(df: DataFrame, label: str = "Class", out: str = "weight") -> DataFrame:
    """weight = n_neg / n_pos for positives, 1 otherwise (M3); no positives gives weight 1."""
    y = F.col(label).cast("int") == 1
    ratio = df.agg(F.try_divide(F.count_if(~y).cast("double"),
                                F.when(F.count_if(y) > 0, F.count_if(y)))).scalar()
    return df.withColumn(out, F.when(y & ratio.isNotNull(), ratio).otherwise(F.lit(1.0)))
