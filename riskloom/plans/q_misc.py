"""Registered queries for scalars, filters, sampling, recency windows, validation, idempotent append,
time-window rollups and column-set reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as sc
from ..functions import validate as va
from ..operators import features as fe
from ..operators import rolling as ro
from ..sources import fixtures as fx
from ..sources import logs
from ..sources.tables import FEATURES, fixture_table
from .registry import query
from .registry import round_cols as _r


@query("x9_row_uid", """
SELECT event_id, sha256(concat_ws('|', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), event_type)) AS uid
FROM events""")
def x9_row_uid(spark, sf):
    ev = fixture_table(spark, sf, "events")
    return ev.select("event_id", sc.row_uid(["event_id", "user_id", "event_type"]).alias("uid"))


@query("x10_compact_stamp", """
SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS stamp, CAST(floor(epoch_us(ts) / 3600000000) % 24 AS INTEGER) AS hour
FROM events""")
def x10_compact_stamp(spark, sf):
    ev = fixture_table(spark, sf, "events")
    return ev.select("event_id", sc.compact_stamp("ts").alias("stamp"), F.hour("ts").alias("hour"))


@query("x12_uri_rewrite", """
SELECT page_id, regexp_replace(url, '^http://', 'https://') AS url, regexp_replace(url, '^http://', 'https://') <> url AS changed
FROM pages""")
def x12_uri_rewrite(spark, sf):
    u = fx.uris(spark, sf)
    new = sc.rewrite_prefix("url", "^http://", "https://")
    return u.select("page_id", new.alias("url"), (new != F.col("url")).alias("changed"))


@query("x12_uri_rewrite_count", """
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count_if(regexp_replace(url, '^http://', 'https://') <> url) AS BIGINT) AS n_changed FROM pages""")
def x12_uri_rewrite_count(spark, sf):
    u = fx.uris(spark, sf)
    new = sc.rewrite_prefix("url", "^http://", "https://")
    return u.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(new != F.col("url")).alias("n_changed"))


@query("x13_uri_parts", r"""
SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS protocol, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
       regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path,
       nullif(regexp_extract(url, '\?([^#]*)', 1), '') AS query
FROM pages""")
def x13_uri_parts(spark, sf):
    u = fx.uris(spark, sf)
    return u.select("page_id", sc.uri_part("url", "PROTOCOL").alias("protocol"), sc.uri_part("url", "HOST").alias("host"),
                    sc.uri_part("url", "PATH").alias("path"), sc.uri_part("url", "QUERY").alias("query"))


@query("x14_props_default", """
SELECT event_id, coalesce(CAST(json_extract(props, '$.k') AS INTEGER), -1) AS k,
       coalesce(CAST(json_extract(props, '$.z') AS INTEGER), 0) AS z FROM events""")
def x14_props_default(spark, sf):
    ev = fixture_table(spark, sf, "events")
    m = F.from_json("props", T.MapType(T.StringType(), T.IntegerType()))
    return ev.select("event_id", sc.map_get_or(m, "k", -1).alias("k"), sc.map_get_or(m, "z", 0).alias("z"))


@query("f3_filter_class", """
SELECT CAST(count(*) AS BIGINT) AS n, round(sum("Amount"), 6) AS amount FROM tx WHERE "Class" = 1""", ("tx",))
def f3_filter_class(spark, sf):
    t = fx.tx(spark, sf).where(F.col("Class") == 1)
    return _r(t.agg(F.count(F.lit(1)).alias("n"), F.sum("Amount").alias("amount")), ["amount"])


@query("f4_amount_filter_raw_vs_scaled", """
WITH st AS (SELECT avg("Amount") AS m, stddev_pop("Amount") AS s FROM tx),
z AS (SELECT "Amount", ("Amount" - m) / CASE WHEN s > 0 THEN s ELSE 1.0 END AS scaled FROM tx, st)
SELECT CAST(count_if("Amount" >= 0) AS BIGINT) AS raw_kept, CAST(count_if(NOT ("Amount" >= 0)) AS BIGINT) AS raw_dropped,
       CAST(count_if(scaled >= 0) AS BIGINT) AS scaled_kept, CAST(count_if(NOT (scaled >= 0)) AS BIGINT) AS scaled_dropped
FROM z""", ("tx",))
def f4_amount_filter_raw_vs_scaled(spark, sf):
    """The Amount >= 0 filter with its dropped count, on raw and on scaled Amount (the latter is the
    reference's defect: it removes every below-mean row)."""
    t = fx.tx(spark, sf).select("Amount")
    z = fe.standard_scale(t.withColumn("raw", F.col("Amount")), fe.fit_stats(t, ["Amount"]), ["Amount"])
    return z.agg(F.count_if(F.col("raw") >= 0).alias("raw_kept"), F.count_if(~(F.col("raw") >= 0)).alias("raw_dropped"),
                 F.count_if(F.col("Amount") >= 0).alias("scaled_kept"),
                 F.count_if(~(F.col("Amount") >= 0)).alias("scaled_dropped"))


_FEATS = ", ".join(f'"{c}"' for c in FEATURES)


@query("f1_f2_feature_projection", f"""SELECT tx_id, {_FEATS} FROM feat""", ("feat",))
def f1_f2_feature_projection(spark, sf):
    return fx.feat(spark, sf).drop("Time", "Class", "ts").select("tx_id", *FEATURES)


@query("d2_s3_seeded_sample", """
SELECT tx_id, "Amount", "Class" FROM tx
ORDER BY md5(concat_ws('|', '42', CAST(tx_id AS VARCHAR))), tx_id LIMIT 500""", ("tx",))
def d2_s3_seeded_sample(spark, sf):
    """Seeded sample of min(500, rows): the 500 lowest md5(seed|key) rows, a top-k by design."""
    t = fx.tx(spark, sf)
    key = F.md5(F.concat_ws("|", F.lit("42"), F.col("tx_id").cast("string")))
    return t.orderBy(key, "tx_id").limit(500).select("tx_id", "Amount", "Class")


@query("w1_last_n_per_key", """
SELECT model_version, prediction_id, "timestamp", rn FROM (
  SELECT *, row_number() OVER (PARTITION BY model_version ORDER BY "timestamp" DESC, prediction_id) AS rn FROM pred) t
WHERE rn <= 5""", ("pred",))
def w1_last_n_per_key(spark, sf):
    p = fx.pred(spark, sf)
    return ro.last_n_per_key(p, "model_version", "timestamp", "prediction_id", 5).select(
        "model_version", "prediction_id", "timestamp", "rn")


@query("a14_keyed_rollup", """
SELECT model_version, CAST(count(*) AS BIGINT) AS count, round(avg(CAST(is_fraud AS INTEGER)), 4) AS fraud_rate,
       round(avg(fraud_probability), 4) AS avg_probability FROM (
  SELECT *, row_number() OVER (PARTITION BY model_version ORDER BY "timestamp" DESC, prediction_id) AS rn FROM pred) t
WHERE rn <= 100 GROUP BY model_version""", ("pred",))
def a14_keyed_rollup(spark, sf):
    p = fx.pred(spark, sf)
    last = ro.last_n_per_key(p, "model_version", "timestamp", "prediction_id", 100)
    return last.groupBy("model_version").agg(
        F.count(F.lit(1)).alias("count"), F.round(F.avg(F.col("is_fraud").cast("int")), 4).alias("fraud_rate"),
        F.round(F.avg("fraud_probability"), 4).alias("avg_probability"))


@query("w2_trailing_metrics", """
SELECT prediction_id, model_version,
       CAST(count(*) OVER w AS BIGINT) AS trailing_n,
       round(avg(CAST(is_fraud AS INTEGER)) OVER w, 4) AS trailing_fraud_rate,
       round(avg(fraud_probability) OVER w, 4) AS trailing_avg_probability
FROM pred WINDOW w AS (PARTITION BY model_version ORDER BY "timestamp" ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)""",
       ("pred",))
def w2_trailing_metrics(spark, sf):
    """What the rolling /metrics would have said after each prediction, per model version. Chunks of 2,000
    rows per key (several chunks per key at this scale, so the halo path is exercised)."""
    p = fx.pred(spark, sf).select("prediction_id", "model_version", "timestamp", "is_fraud", "fraud_probability")
    out = ro.trailing_rows(p, "model_version", F.unix_micros(F.col("timestamp").cast("timestamp")), 100, {
        "trailing_n": F.count(F.lit(1)),
        "trailing_fraud_rate": F.avg(F.col("is_fraud").cast("int")),
        "trailing_avg_probability": F.avg("fraud_probability")}, chunk_rows=2000)
    return _r(out.select("prediction_id", "model_version", "trailing_n", "trailing_fraud_rate", "trailing_avg_probability"),
              ["trailing_fraud_rate", "trailing_avg_probability"], 4)


def rules():
    """Validation rules of the lineitem check (built per call: Columns need an active session)."""
    return [
        ("l_quantity must be > 0", F.col("l_quantity") > 0),
        ("l_discount must be in [0, 0.1)", (F.col("l_discount") >= 0) & (F.col("l_discount") < 0.1)),
        ("l_tax must be <= 0.08", F.col("l_tax") <= 0.08),
    ]


@query("p6_validation_counts", """
WITH c AS (SELECT count(*) AS n_rows,
  count_if(NOT (coalesce(l_quantity > 0, false) AND coalesce(l_discount >= 0 AND l_discount < 0.1, false)
                AND coalesce(l_tax <= 0.08, false))) AS n_rejected,
  count_if(NOT coalesce(l_quantity > 0, false)) AS r0,
  count_if(NOT coalesce(l_discount >= 0 AND l_discount < 0.1, false)) AS r1,
  count_if(NOT coalesce(l_tax <= 0.08, false)) AS r2 FROM lineitem)
SELECT CAST(n_rows AS BIGINT) AS n_rows, CAST(n_rejected AS BIGINT) AS n_rejected, 'l_quantity must be > 0' AS rule,
       CAST(r0 AS BIGINT) AS violations FROM c
UNION ALL SELECT n_rows, n_rejected, 'l_discount must be in [0, 0.1)', r1 FROM c
UNION ALL SELECT n_rows, n_rejected, 'l_tax must be <= 0.08', r2 FROM c""")
def p6_validation_counts(spark, sf):
    return va.error_counts(fixture_table(spark, sf, "lineitem"), rules())


@query("p6_rejected_rows", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, list_filter([
  CASE WHEN NOT coalesce(l_quantity > 0, false) THEN 'l_quantity must be > 0' END,
  CASE WHEN NOT coalesce(l_discount >= 0 AND l_discount < 0.1, false) THEN 'l_discount must be in [0, 0.1)' END,
  CASE WHEN NOT coalesce(l_tax <= 0.08, false) THEN 'l_tax must be <= 0.08' END], lambda x: x IS NOT NULL) AS errors
FROM lineitem WHERE NOT (coalesce(l_quantity > 0, false) AND coalesce(l_discount >= 0 AND l_discount < 0.1, false)
                         AND coalesce(l_tax <= 0.08, false))""")
def p6_rejected_rows(spark, sf):
    li = fixture_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    _, rejected = va.split_valid(li, rules())
    return rejected


@query("j4_s6_insert_or_ignore", """
WITH b AS (SELECT prediction_id, "timestamp", fraud_probability FROM pred WHERE "timestamp" >= TIMESTAMP '2024-01-18 00:00:00'
           UNION ALL
           SELECT prediction_id, "timestamp" + INTERVAL 1 HOUR, 1 - fraud_probability FROM pred
           WHERE "timestamp" >= TIMESTAMP '2024-01-25 00:00:00'),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY prediction_id ORDER BY "timestamp") AS rn FROM b) t WHERE rn = 1)
SELECT prediction_id, "timestamp", round(fraud_probability, 6) AS fraud_probability FROM f
WHERE NOT EXISTS (SELECT 1 FROM pred l WHERE l."timestamp" < TIMESTAMP '2024-01-20 00:00:00' AND l.prediction_id = f.prediction_id)""",
       ("pred",))
def j4_s6_insert_or_ignore(spark, sf):
    """A batch overlapping the log, with late re-sends of the same ids: first arrival wins, logged ids are ignored."""
    p = fx.pred(spark, sf).select("prediction_id", "timestamp", "fraud_probability")
    ts = F.col("timestamp")
    log = p.where(ts < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    batch = p.where(ts >= F.lit("2024-01-18 00:00:00").cast("timestamp_ntz")).unionByName(
        p.where(ts >= F.lit("2024-01-25 00:00:00").cast("timestamp_ntz"))
        .select("prediction_id", (ts + F.expr("INTERVAL 1 HOUR")).alias("timestamp"),
                (F.lit(1.0) - F.col("fraud_probability")).alias("fraud_probability")))
    return _r(logs.new_predictions(batch, log), ["fraud_probability"])


@query("t4_tumbling_rollup", """
SELECT time_bucket(INTERVAL 1 DAY, "timestamp") AS window_start, CAST(count(*) AS BIGINT) AS count,
       round(avg(CAST(is_fraud AS INTEGER)), 6) AS fraud_rate, round(avg(fraud_probability), 6) AS avg_probability
FROM pred GROUP BY 1""", ("pred",))
def t4_tumbling_rollup(spark, sf):
    """Batch twin of the streaming daily rollup (count, fraud rate, mean probability per window)."""
    p = fx.pred(spark, sf)
    g = p.groupBy(F.window("timestamp", "1 day").alias("w")).agg(
        F.count(F.lit(1)).alias("count"), F.avg(F.col("is_fraud").cast("int")).alias("fraud_rate"),
        F.avg("fraud_probability").alias("avg_probability"))
    return _r(g.select(F.col("w.start").alias("window_start"), "count", "fraud_rate", "avg_probability"),
              ["fraud_rate", "avg_probability"])


@query("w7_daily_trend", """
WITH d AS (SELECT time_bucket(INTERVAL 1 DAY, "timestamp") AS window_start, avg(CAST(is_fraud AS INTEGER)) AS fraud_rate
           FROM pred GROUP BY 1)
SELECT window_start, round(fraud_rate, 6) AS fraud_rate,
       round(fraud_rate - lag(fraud_rate) OVER (ORDER BY window_start), 6) AS change FROM d""", ("pred",))
def w7_daily_trend(spark, sf):
    """Daily fraud rate and its change from the previous day (lag over the per-day table: one row per day)."""
    from pyspark.sql import Window

    p = fx.pred(spark, sf)
    d = p.groupBy(F.window("timestamp", "1 day").alias("w")).agg(
        F.avg(F.col("is_fraud").cast("int")).alias("fraud_rate")).select(F.col("w.start").alias("window_start"),
                                                                         "fraud_rate")
    out = d.withColumn("change", F.col("fraud_rate") - F.lag("fraud_rate").over(Window.orderBy("window_start")))
    return _r(out, ["fraud_rate", "change"])


@query("t4_sliding_rollup", """
WITH w AS (SELECT time_bucket(INTERVAL 6 HOUR, "timestamp") - k * INTERVAL 6 HOUR AS window_start, fraud_probability
           FROM pred, range(0, 4) t(k))
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, CAST(count(*) AS BIGINT) AS count,
       round(avg(fraud_probability), 6) AS avg_probability FROM w GROUP BY window_start""", ("pred",))
def t4_sliding_rollup(spark, sf):
    """Batch twin of the sliding form: 1-day windows every 6 hours."""
    p = fx.pred(spark, sf)
    g = p.groupBy(F.window("timestamp", "1 day", "6 hours").alias("w")).agg(
        F.count(F.lit(1)).alias("count"), F.round(F.avg("fraud_probability"), 6).alias("avg_probability"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "count", "avg_probability")


@query("t4_session_rollup", """
WITH e AS (SELECT user_id, ts, value / (value + 50.0) AS p,
                  CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE
                       THEN 0 ELSE 1 END AS brk, event_id FROM events),
s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, CAST(count(*) AS BIGINT) AS count,
       round(avg(p), 6) AS avg_probability FROM s GROUP BY user_id, sid""")
def t4_session_rollup(spark, sf):
    """Batch twin of the session form: per user, activity sessions closed by 30 minutes of silence
    (hot users split into chunks, see ``rolling.sessions``)."""
    ev = fixture_table(spark, sf, "events").withColumn("p", F.col("value") / (F.col("value") + F.lit(50.0)))
    s = ro.sessions(ev, "user_id", "ts", 30 * 60, {"count": F.count(F.lit(1)), "avg_probability": F.avg("p")})
    return _r(s.select("user_id", "session_start", "session_end", "count", "avg_probability"), ["avg_probability"])


# The fixture layouts as the oracle states them (see sources/fixtures.py).
FEAT_COLUMNS = ["tx_id", "ts", "Time"] + [f"V{i}" for i in range(1, 29)] + ["Amount", "Class"]
TX_COLUMNS = ["tx_id", "ts", "user_id", "Time", "Amount", "Class"]
EXPECTED_REQUEST = FEATURES + ["fraud_probability"]


def _p5_sql():
    names = list(dict.fromkeys(EXPECTED_REQUEST + FEAT_COLUMNS + TX_COLUMNS))
    rows = []
    for n in names:
        e, r, c = n in EXPECTED_REQUEST, n in FEAT_COLUMNS, n in TX_COLUMNS
        ref = f'(SELECT CAST(count("{n}") AS BIGINT) FROM feat)' if r else "CAST(NULL AS BIGINT)"
        cur = f'(SELECT CAST(count("{n}") AS BIGINT) FROM tx)' if c else "CAST(NULL AS BIGINT)"
        rows.append(f"SELECT '{n}' AS column_name, {str(e).lower()} AS expected, {str(r).lower()} AS in_reference, "
                    f"{str(c).lower()} AS in_current, {str(e and r and c).lower()} AS testable, "
                    f"{str(e and not r).lower()} AS missing_from_reference, {ref} AS ref_non_null, {cur} AS cur_non_null")
    return " UNION ALL ".join(rows)


@query("p5_u1_u3_column_sets", _p5_sql(), ("feat", "tx"))
def p5_u1_u3_column_sets(spark, sf):
    """Expected request columns against the reference sample (feat) and a current sample (tx):
    union (U1), missing (U2) and testable intersection (U3) as set operations on column-name frames,
    with each sample's non-null count per column from one aggregate pass over its rows (P2, P5)."""
    from ..operators.profile import column_info

    expected = EXPECTED_REQUEST
    ref_info = column_info(fx.feat(spark, sf)).select("column_name", F.col("non_null").alias("ref_non_null"))
    cur_info = column_info(fx.tx(spark, sf)).select("column_name", F.col("non_null").alias("cur_non_null"))
    e = spark.createDataFrame([(c,) for c in expected], "column_name string")
    r, c = ref_info.select("column_name"), cur_info.select("column_name")
    allc = e.union(r).union(c).distinct()                       # U1
    testable = e.intersect(r).intersect(c)                     # U3
    missing_ref = e.subtract(r)                                # U2
    return (allc.join(testable.withColumn("testable", F.lit(True)), "column_name", "left")
            .join(missing_ref.withColumn("missing_from_reference", F.lit(True)), "column_name", "left")
            .join(ref_info, "column_name", "left").join(cur_info, "column_name", "left")
            .select("column_name", F.col("column_name").isin(expected).alias("expected"),
                    F.col("ref_non_null").isNotNull().alias("in_reference"),
                    F.col("cur_non_null").isNotNull().alias("in_current"),
                    F.coalesce("testable", F.lit(False)).alias("testable"),
                    F.coalesce("missing_from_reference", F.lit(False)).alias("missing_from_reference"),
                    "ref_non_null", "cur_non_null"))


V2_SIGNATURE = [(c, T.DoubleType()) for c in FEATURES] + [("amount_log", T.DoubleType()),
                                                         ("amount_zscore", T.DoubleType())]


def _p7_sql():
    rows = []
    for n, t in V2_SIGNATURE:
        if n in FEAT_COLUMNS:
            rows.append(f"SELECT '{n}' AS column_name, '{t.simpleString()}' AS expected_type, 'double' AS actual_type, "
                        f'CAST(count("{n}") AS BIGINT) AS non_null, CAST(count(*) - count("{n}") AS BIGINT) AS nulls, '
                        f'count(*) - count("{n}") = 0 AS ok FROM feat')
        else:
            rows.append(f"SELECT '{n}', '{t.simpleString()}', CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), "
                        f"CAST(NULL AS BIGINT), false")
    return " UNION ALL ".join(rows)


@query("p7_signature_report", _p7_sql(), ("feat",))
def p7_signature_report(spark, sf):
    """The v2 signature (31 inputs) against the feat layout: the two derived inputs are missing."""
    return va.signature_report(fx.feat(spark, sf), V2_SIGNATURE)
