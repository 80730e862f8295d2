"""Catalog of registered queries and their DuckDB twins."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .oracle_views import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a (spark, sf_dir) -> DataFrame callable, with its oracle SQL when SQL can state it."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the fixture timestamps are NTZ and the epoch arithmetic assumes a UTC session
            if spark.conf.get("spark.sql.session.timeZone") != "UTC":
                spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_views(sql, views)
        return fn

    return deco


def round_cols(df: DataFrame, cols, places: int = 6) -> DataFrame:
    """Round the named float columns (both engines agree after rounding; the rest pass through)."""
    return df.select(*[F.round(c, places).alias(c) if c in cols else F.col(c) for c in df.columns])
