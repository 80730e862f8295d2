"""Registered profile queries: shape, column info, balance, stats, correlation, histogram, percentiles, KDE."""

from __future__ import annotations


from ..operators import profile as pr
from ..sources import fixtures as fx
from ..sources.tables import fixture_table
from .registry import query
from .registry import round_cols as _r

FEATS = [f"V{i}" for i in range(1, 29)] + ["Amount"]
NUM_COLS = fx.NUM_FEATURES + ["Class"]
PCTS = [0.5, 0.95, 0.99]

# Parquet column types of lineitem, as Spark names them (stated for the oracle).
LINEITEM_TYPES = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
    ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
    ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
]


@query("p1_shape", """SELECT CAST(count(*) AS BIGINT) AS n_rows, 6 AS n_cols FROM tx""", ("tx",))
def p1_shape(spark, sf):
    return pr.shape(fx.tx(spark, sf))


_P2 = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {i} AS position, '{t}' AS dtype, CAST(count({c}) AS BIGINT) AS non_null, "
    f"CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM lineitem" for i, (c, t) in enumerate(LINEITEM_TYPES))


@query("p2_p3_column_info", _P2)
def p2_p3_column_info(spark, sf):
    return pr.column_info(fixture_table(spark, sf, "lineitem"))


@query("a1_class_balance", """
SELECT "Class", CAST(count(*) AS BIGINT) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM tx GROUP BY "Class" """, ("tx",))
def a1_class_balance(spark, sf):
    return _r(pr.class_balance(fx.tx(spark, sf)), ["share"])


@query("a2_imbalance", """
SELECT CAST(count_if("Class" <> 1) AS BIGINT) AS n_neg, CAST(count_if("Class" = 1) AS BIGINT) AS n_pos,
       round(CASE WHEN count_if("Class" = 1) > 0 THEN count_if("Class" <> 1) / count_if("Class" = 1) END, 6) AS ratio
FROM tx""", ("tx",))
def a2_imbalance(spark, sf):
    return _r(pr.imbalance(fx.tx(spark, sf)), ["ratio"])


@query("a3_prevalence", """
SELECT CAST(count(*) AS BIGINT) AS n, CAST(count_if("Class" = 1) AS BIGINT) AS positives,
       round(avg(CAST("Class" AS DOUBLE)), 6) AS prevalence FROM num""", ("num",))
def a3_prevalence(spark, sf):
    return _r(pr.prevalence(fx.num(spark, sf)), ["prevalence"])


@query("a4_mean_std", """
SELECT 'Amount' AS column_name, CAST(count("Amount") AS BIGINT) AS n, round(avg("Amount"), 6) AS mean,
       round(stddev_pop("Amount"), 6) AS std_pop FROM tx
UNION ALL
SELECT 'Time', CAST(count("Time") AS BIGINT), round(avg("Time"), 6), round(stddev_pop("Time"), 6) FROM tx""", ("tx",))
def a4_mean_std(spark, sf):
    return _r(pr.mean_std(fx.tx(spark, sf), ["Amount", "Time"]), ["mean", "std_pop"])


@query("a5_hour_class", """
SELECT CAST(floor("Time" / 3600) % 24 AS INTEGER) AS hour, "Class", CAST(count(*) AS BIGINT) AS count
FROM tx GROUP BY 1, 2""", ("tx",))
def a5_hour_class(spark, sf):
    return pr.hour_class_counts(fx.tx(spark, sf))


def _corr_sql():
    parts = []
    for a in NUM_COLS:
        for b in NUM_COLS:
            r = (f"CASE WHEN stddev_pop(\"{a}\") > 0 THEN 1.0 END" if a == b else f"corr(\"{a}\", \"{b}\")")
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, round({r}, 6) AS r FROM num")
    return " UNION ALL ".join(parts)


@query("a6_corr_matrix", _corr_sql(), ("num",))
def a6_corr_matrix(spark, sf):
    return _r(pr.corr_matrix(fx.num(spark, sf), NUM_COLS), ["r"])


_D3 = " UNION ALL ".join(f"SELECT '{c}' AS feature, corr(\"{c}\", \"Class\") AS r FROM feat" for c in FEATS)


@query("d3_topk_corr", f"""
SELECT feature, round(r, 6) AS r FROM ({_D3}) t WHERE r IS NOT NULL ORDER BY abs(r) DESC, feature LIMIT 5""", ("feat",))
def d3_topk_corr(spark, sf):
    return _r(pr.top_corr_with(fx.feat(spark, sf), "Class", FEATS, 5), ["r"])


@query("a15_histogram", """
WITH d AS (SELECT "Amount" AS x FROM tx WHERE "Amount" IS NOT NULL),
s AS (SELECT min(x) AS mn, max(x) AS mx, count(*) AS n FROM d),
c AS (SELECT CAST(CASE WHEN mx > mn THEN least(floor((x - mn) / (mx - mn) * 10), 9) ELSE 0 END AS INTEGER) AS bin,
             count(*) AS cnt FROM d, s GROUP BY 1),
g AS (SELECT CAST(b AS INTEGER) AS bin, mn, mx, n FROM s, range(0, 10) t(b))
SELECT g.bin, round(mn + (mx - mn) / 10.0 * g.bin, 6) AS lo, round(mn + (mx - mn) / 10.0 * (g.bin + 1), 6) AS hi,
       CAST(coalesce(cnt, 0) AS BIGINT) AS count,
       round(coalesce(cnt, 0) / (n * CASE WHEN (mx - mn) / 10.0 > 0 THEN (mx - mn) / 10.0 END), 9) AS density
FROM g LEFT JOIN c ON g.bin = c.bin""", ("tx",))
def a15_histogram(spark, sf):
    h = pr.histogram(fx.tx(spark, sf), "Amount", 10)
    return _r(_r(h, ["lo", "hi"]), ["density"], 9)


@query("a16_percentiles", " UNION ALL ".join(
    f"SELECT CAST({q} AS DOUBLE) AS q, round(quantile_cont(latency, {q}), 9) AS value FROM lat" for q in PCTS), ("lat",))
def a16_percentiles(spark, sf):
    return _r(pr.exact_percentiles(fx.lat(spark, sf), "latency", PCTS), ["value"], 9)


@query("a17_success_throughput", """
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(CAST(ok AS DOUBLE)), 6) AS success_rate,
       round(avg(latency), 9) AS mean_latency,
       round((max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6, 6) AS elapsed_s,
       round(count(*) / ((max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6), 6) AS throughput FROM lat""", ("lat",))
def a17_success_throughput(spark, sf):
    r = pr.success_throughput(fx.lat(spark, sf))
    return _r(_r(r, ["success_rate", "elapsed_s", "throughput"]), ["mean_latency"], 9)


@query("a18_kde", """
WITH d AS (SELECT "Amount" AS x, "Class" FROM feat WHERE "Amount" IS NOT NULL),
rng AS (SELECT min(x) AS gmin, max(x) AS gmax FROM d),
pc AS (SELECT "Class", count(*) AS n, stddev_samp(x) AS sd FROM d GROUP BY 1),
hist AS (SELECT "Class", CAST(CASE WHEN gmax > gmin THEN least(floor((x - gmin) / (gmax - gmin) * 200), 199) ELSE 0 END AS INTEGER) AS bin,
                count(*) AS c, any_value(gmin) AS gmin, any_value(gmax) AS gmax FROM d, rng GROUP BY 1, 2),
ctr AS (SELECT "Class", c, gmin + (gmax - gmin) / 200 * (bin + 0.5) AS xc FROM hist),
grid AS (SELECT gmin + (gmax - gmin) * g / 99 AS x FROM rng, range(0, 100) t(g)),
per AS (SELECT ctr.*, pc.n, pow(CAST(pc.n AS DOUBLE), -0.2) * pc.sd AS h FROM ctr JOIN pc USING ("Class"))
SELECT "Class", round(grid.x, 6) AS x,
       round(sum(c * exp(-0.5 * pow((grid.x - xc) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 9) AS density
FROM per, grid GROUP BY "Class", grid.x""", ("feat",))
def a18_kde(spark, sf):
    k = pr.kde(fx.feat(spark, sf), "Amount", "Class", bins=200, grid=100)
    return _r(_r(k, ["x"]), ["density"], 9)


@query("a15_latency_histogram", """
WITH d AS (SELECT latency AS x FROM lat WHERE latency IS NOT NULL),
s AS (SELECT min(x) AS mn, max(x) AS mx, count(*) AS n FROM d),
c AS (SELECT CAST(CASE WHEN mx > mn THEN least(floor((x - mn) / (mx - mn) * 30), 29) ELSE 0 END AS INTEGER) AS bin,
             count(*) AS cnt FROM d, s GROUP BY 1),
g AS (SELECT CAST(b AS INTEGER) AS bin, mn, mx, n FROM s, range(0, 30) t(b))
SELECT g.bin, round(mn + (mx - mn) / 30.0 * g.bin, 9) AS lo, round(mn + (mx - mn) / 30.0 * (g.bin + 1), 9) AS hi,
       CAST(coalesce(cnt, 0) AS BIGINT) AS count,
       round(coalesce(cnt, 0) / (n * CASE WHEN (mx - mn) / 30.0 > 0 THEN (mx - mn) / 30.0 END), 6) AS density
FROM g LEFT JOIN c ON g.bin = c.bin""", ("lat",))
def a15_latency_histogram(spark, sf):
    """The load-test latency histogram: 30 equal-width bins as a density."""
    h = pr.histogram(fx.lat(spark, sf), "latency", 30)
    return _r(_r(h, ["lo", "hi"], 9), ["density"], 6)
