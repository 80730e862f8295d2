"""The model registry as a table of snapshots (M9-M11), with the models' files beside it.

A row is a version: name, version, run_id, stage, and what serving needs of it: the folder of the fitted pipeline, the
folder of the feature statistics it was fitted with, and its signature (input columns and types, P7). Every change
is a commit on the version of the table that it was made from; a writer whose view is old is refused
(``StaleWriterError``) and may read again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import registry as rg
from .snapshots import SnapshotTable

LAYOUT = ("name string, version string, run_id long, stage string, model_path string, stats_path string, "
          "signature array<struct<name: string, type: string>>")


@dataclass(frozen=True)
class Served:
    """A version as it is served: the fitted pipeline, its feature statistics and its signature."""
    version: str
    model: PipelineModel
    stats: DataFrame | None
    signature: tuple[tuple[str, T.DataType], ...]


class ModelVersions:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.table = SnapshotTable(spark, f"{self.path}/versions")
        self._loaded: dict[tuple[str, str], Served] = {}

    def rows(self, version: int | None = None) -> DataFrame:
        """The versions as of a commit (default: now)."""
        if self.table.version() == 0:
            return self.spark.createDataFrame([], LAYOUT)
        return self.table.read(version)

    def publish(self, name: str, model: PipelineModel, stats: DataFrame | None, run_id: int, stage: str = "None") -> str:
        """Store a fitted pipeline as the model's next version; returns the version."""
        at = self.table.version()
        known = self.rows(at) if at else self.rows()
        number = known.where(F.col("name") == name).agg(F.coalesce(F.max(rg.version_number()), F.lit(0))).first()[0] + 1
        folder = f"{self.path}/models/{name}/{number}-{at + 1}"
        model.write().overwrite().save(folder)
        stats_path = None
        if stats is not None:
            stats_path = f"{folder}-stats"
            stats.coalesce(1).write.mode("overwrite").parquet(stats_path)  # one row per feature
        inputs = [(c, "double") for s in model.stages[:1] for c in s.getInputCols()]
        row = self.spark.createDataFrame([(name, str(number), run_id, stage, folder, stats_path, inputs)], LAYOUT)
        self.table.commit(known.unionByName(row), at)
        return str(number)

    def promote(self, name: str, runs: DataFrame, metric: str, target: str = "Production", expected: int | None = None) -> str:
        """Move the version with the best ``metric`` to ``target`` and archive those there before; returns the version.
        ``expected``: the commit that the caller looked at (default: the newest); a later one refuses the change."""
        at = self.table.version() if expected is None else expected
        known = self.rows(at) if at else self.rows()
        best = rg.choose(known, runs, metric, name)
        self.table.commit(rg.promote(known, best, target).select(*known.columns), at)
        return best.first()["best_version"]

    def serving(self, name: str, stage: str = "Production") -> Served:
        """The version to serve now (M11). A version is loaded once and kept: its files never change."""
        known = self.rows()
        row = rg.serving(known, name, stage).select("name", "version").join(known, ["name", "version"]).first()
        key = (name, row["version"])
        if key not in self._loaded:
            stats = None if row["stats_path"] is None else self.spark.read.parquet(row["stats_path"])
            signature = tuple((f.name, f.dataType) for s in row["signature"]
                              for f in T.StructType.fromDDL(f"`{s['name']}` {s['type']}"))
            self._loaded[key] = Served(row["version"], PipelineModel.load(row["model_path"]), stats, signature)
        return self._loaded[key]
