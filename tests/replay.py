"""Ordered replay of a table as a file stream on the local disk (for tests)."""

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_replay(df: DataFrame, path: str, ts: str, n_files: int) -> list[str]:
    """Write ``df`` as ``n_files`` Parquet directories in event-time order with increasing mtimes, so a
    file source with maxFilesPerTrigger=1 replays them in time order (test and backfill helper).

    Cut points come from approxQuantile (n_files - 1 numbers); every range is written by Spark.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    d = df.withColumn("_us", micros)
    cuts = d.approxQuantile("_us", [i / n_files for i in range(1, n_files)], 0.0) if n_files > 1 else []
    edges = [None, *cuts, None]
    out = []
    for i in range(n_files):
        lo, hi = edges[i], edges[i + 1]
        part = d
        if lo is not None:
            part = part.where(F.col("_us") > F.lit(int(lo)))
        if hi is not None:
            part = part.where(F.col("_us") <= F.lit(int(hi)))
        p = os.path.join(path, f"part-{i:05d}")
        part.drop("_us").coalesce(1).write.mode("overwrite").parquet(p + ".tmp")
        # move the single data file into the source folder with an increasing mtime
        for name in os.listdir(p + ".tmp"):
            if name.endswith(".parquet"):
                dst = os.path.join(path, f"part-{i:05d}.parquet")
                os.replace(os.path.join(p + ".tmp", name), dst)
                os.utime(dst, (1_700_000_000 + i, 1_700_000_000 + i))
                out.append(dst)
    return out
