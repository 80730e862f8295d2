"""Table sources and sinks.

Every reader takes an explicit schema or a Parquet footer; nothing is
inferred inside a job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

FEATURES = [f"V{i}" for i in range(1, 29)] + ["Amount"]

# Raw transaction layout: Time, V1..V28, Amount as doubles, Class as int.
TX_SCHEMA = T.StructType(
    [T.StructField("Time", T.DoubleType())]
    + [T.StructField(f"V{i}", T.DoubleType()) for i in range(1, 29)]
    + [T.StructField("Amount", T.DoubleType()), T.StructField("Class", T.IntegerType())]
)


class MissingSourceError(RuntimeError):
    """A required input does not exist."""


def load_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None, **options) -> DataFrame:
    """Read one table; a missing path stops the job with the path in the message."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.load(path)
        # Resolve the file listing now so a missing source fails here, not later.
        df.schema  # noqa: B018
        return df
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise MissingSourceError(f"required source missing: {path}") from exc
        raise


def fixture_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's test tables."""
    return load_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_transactions(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Raw transactions with header (S1); CSV is read with the fixed schema."""
    if fmt == "csv":
        return load_table(spark, path, "csv", schema=TX_SCHEMA, header="true", mode="FAILFAST")
    return load_table(spark, path, fmt)


CORRUPT = "_corrupt_line"


def read_transaction_lines(spark: SparkSession, path: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Raw transactions as (accepted rows, rejected lines) (S1 with P6): a line that does not parse against the layout (a
    value of another type, too few or too many fields) is rejected with its text and an ``errors`` array, as rows that
    break a rule are. ``read_transactions`` fails on such a line instead."""
    from ..operators.common import materialize

    schema = T.StructType([*TX_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    lines = load_table(spark, path, "csv", schema=schema, header=str(header).lower(), mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    lines = materialize(lines)  # parsed once, with all fields of a line, whatever a later step selects
    accepted = lines.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    rejected = lines.where(F.col(CORRUPT).isNotNull())
    return accepted, rejected.select(F.col(CORRUPT).alias("line"), F.array(F.lit("line does not parse")).alias("errors"))


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """Split sink (S4): one Parquet dataset partitioned by split name."""
    df.write.partitionBy(split_col).mode("overwrite").parquet(path)


def read_split(spark: SparkSession, path: str, name: str, split_col: str = "split") -> DataFrame:
    """One processed split (S2); the equality on the partition column prunes directories."""
    return load_table(spark, path).where(F.col(split_col) == F.lit(name))
