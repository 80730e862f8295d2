"""Registered model-registry queries: metric lookup, winner, running best, promotion, serving, latest."""

from __future__ import annotations


from ..operators import registry as rg
from ..sources import fixtures as fx
from .registry import query

METRIC = "average_precision"


@query("j2_version_metrics", """
SELECT v.run_id, v.name, v.version, v.stage, r.average_precision
FROM versions v LEFT JOIN runs r ON v.run_id = r.run_id WHERE r.average_precision IS NOT NULL""", ("versions", "runs"))
def j2_version_metrics(spark, sf):
    return rg.with_metric(fx.versions(spark, sf), fx.runs(spark, sf), METRIC)


@query("m9_a19_best_version", """
WITH m AS (SELECT v.*, r.average_precision FROM versions v JOIN runs r USING (run_id) WHERE r.average_precision IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY average_precision DESC, CAST(version AS BIGINT) ASC) AS rn,
             count(*) OVER (PARTITION BY name) AS n FROM m)
SELECT name, version AS best_version, average_precision AS best_average_precision, CAST(n AS BIGINT) AS n_candidates
FROM r WHERE rn = 1""", ("versions", "runs"))
def m9_a19_best_version(spark, sf):
    return rg.best_versions(fx.versions(spark, sf), fx.runs(spark, sf), METRIC)


@query("w4_running_best", """
WITH m AS (SELECT v.*, r.average_precision FROM versions v JOIN runs r USING (run_id) WHERE r.average_precision IS NOT NULL)
SELECT name, version, average_precision,
       coalesce(average_precision > max(average_precision) OVER (PARTITION BY name ORDER BY CAST(version AS BIGINT)
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS is_best_so_far
FROM m""", ("versions", "runs"))
def w4_running_best(spark, sf):
    return rg.running_best(fx.versions(spark, sf), fx.runs(spark, sf), METRIC)


_WIN = """w AS (SELECT name, version AS win FROM (
    SELECT v.name, v.version, row_number() OVER (PARTITION BY v.name ORDER BY r.average_precision DESC,
           CAST(v.version AS BIGINT) ASC) AS rn
    FROM versions v JOIN runs r USING (run_id) WHERE r.average_precision IS NOT NULL) t WHERE rn = 1)"""


@query("m10_promote", f"""WITH {_WIN}
SELECT v.name, v.version, v.run_id,
       CASE WHEN v.version = w.win THEN 'Production' WHEN v.stage = 'Production' THEN 'Archived' ELSE v.stage END AS stage
FROM versions v LEFT JOIN w ON v.name = w.name""", ("versions", "runs"))
def m10_promote(spark, sf):
    v = fx.versions(spark, sf)
    return rg.promote(v, rg.best_versions(v, fx.runs(spark, sf), METRIC), "Production")


@query("m11_f6_resolve_serving", """
SELECT name, arg_max(version, CAST(version AS BIGINT)) AS version, arg_max(run_id, CAST(version AS BIGINT)) AS run_id
FROM versions WHERE stage = 'Production' GROUP BY name""", ("versions",))
def m11_f6_resolve_serving(spark, sf):
    return rg.resolve(fx.versions(spark, sf), "Production")


@query("w3_x15_latest_version", """
SELECT name, arg_max(version, CAST(version AS BIGINT)) AS latest_version, arg_max(stage, CAST(version AS BIGINT)) AS stage
FROM versions GROUP BY name""", ("versions",))
def w3_x15_latest_version(spark, sf):
    return rg.latest(fx.versions(spark, sf))


@query("m11_serving_after_promotion", f"""WITH {_WIN},
p AS (SELECT v.name, v.version, v.run_id,
       CASE WHEN v.version = w.win THEN 'Production' WHEN v.stage = 'Production' THEN 'Archived' ELSE v.stage END AS stage
      FROM versions v LEFT JOIN w ON v.name = w.name)
SELECT name, arg_max(version, CAST(version AS BIGINT)) AS version, arg_max(run_id, CAST(version AS BIGINT)) AS run_id
FROM p WHERE stage = 'Production' GROUP BY name""", ("versions", "runs"))
def m11_serving_after_promotion(spark, sf):
    v = fx.versions(spark, sf)
    promoted = rg.promote(v, rg.best_versions(v, fx.runs(spark, sf), METRIC), "Production")
    return rg.resolve(promoted, "Production")
