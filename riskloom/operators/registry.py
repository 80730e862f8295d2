"""Model-version tables: metric lookup, winner choice, promotion, serving resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ARCHIVED = "Archived"  # fixed stage name given to displaced versions


class RegistryError(RuntimeError):
    """No version, or no version with the metric."""


def version_number(col: str = "version"):
    """Version text as a number, so "10" sorts after "9" (X15)."""
    return F.col(col).cast("long")


def with_metric(versions: DataFrame, runs: DataFrame, metric: str) -> DataFrame:
    """Each version with its run's metric; versions without the metric are skipped.

    One join replaces the per-version lookup; AQE broadcasts the smaller side
    when its measured size allows.
    """
    return (versions.join(runs.select("run_id", metric), "run_id", "left")
            .where(F.col(metric).isNotNull()))


def best_versions(versions: DataFrame, runs: DataFrame, metric: str) -> DataFrame:
    """Per model name: the version with the highest metric; ties go to the lowest version number."""
    m = with_metric(versions, runs, metric)
    key = F.struct(F.col(metric), (-version_number()).alias("neg_version"))
    return m.groupBy("name").agg(
        F.max_by(F.col("version"), key).alias("best_version"),
        F.max(metric).alias(f"best_{metric}"),
        F.count(F.lit(1)).alias("n_candidates"))


def running_best(versions: DataFrame, runs: DataFrame, metric: str, chunk_rows: int = 1_000_000) -> DataFrame:
    """Per version in version order: is it strictly better than every earlier version of the name."""
    from .rolling import running_max

    m = with_metric(versions, runs, metric)
    # best of the earlier versions of the name; a name with very many versions is split into chunks
    r = running_max(m, "name", version_number(), metric, "_prev", inclusive=False, chunk_rows=chunk_rows)
    prev = F.col("_prev")
    return r.select("name", "version", metric, (prev.isNull() | (F.col(metric) > prev)).alias("is_best_so_far"))


def promote(versions: DataFrame, winners: DataFrame, target: str = "Production") -> DataFrame:
    """New snapshot of the versions table: winners move to ``target``, others at ``target`` are archived."""
    w = winners.select("name", F.col("best_version").alias("_win"))
    j = versions.join(w, "name", "left")
    is_win = F.col("version") == F.col("_win")
    return j.select(*[c for c in versions.columns if c != "stage"],
                    F.when(is_win, F.lit(target)).when(F.col("stage") == target, F.lit(ARCHIVED))
                    .otherwise(F.col("stage")).alias("stage"))


def resolve(versions: DataFrame, stage: str = "Production", name: str | None = None) -> DataFrame:
    """The version to serve per name: the highest version number at ``stage``."""
    v = versions.where(F.col("stage") == stage)
    if name is not None:
        v = v.where(F.col("name") == name)
    return v.groupBy("name").agg(F.max_by("version", version_number()).alias("version"),
                                 F.max_by("run_id", version_number()).alias("run_id"))


def latest(versions: DataFrame) -> DataFrame:
    """The newest version per name, any stage."""
    return versions.groupBy("name").agg(F.max_by("version", version_number()).alias("latest_version"),
                                        F.max_by("stage", version_number()).alias("stage"))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail with a message when a registry result is empty (M9/M11 error paths)."""
    if df.isEmpty():
        raise RegistryError(f"no {what} found")
    return df


def choose(versions: DataFrame, runs: DataFrame, metric: str, name: str) -> DataFrame:
    """``best_versions`` of one model; an unknown model, or one without the metric, is an error (M9)."""
    mine = require_rows(versions.where(F.col("name") == name), f"version of model '{name}'")
    return require_rows(best_versions(mine, runs, metric), f"version of model '{name}' with metric '{metric}'")


def serving(versions: DataFrame, name: str, stage: str = "Production") -> DataFrame:
    """``resolve`` for one model; nothing at the stage is an error."""
    return require_rows(resolve(versions, stage, name), f"version of model '{name}' at stage '{stage}'")
