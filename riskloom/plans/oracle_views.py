"""DuckDB twins of the fixture views, as CTEs for the oracle SQL.

Each definition mirrors a function in ``riskloom.sources.fixtures``; the
arithmetic is written in the same order so both engines round alike.
"""

from __future__ import annotations

_V = ", ".join(f"CAST(e.embedding[{i}] AS DOUBLE) AS V{i}" for i in range(1, 29))

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "tx": ((), """SELECT event_id AS tx_id, ts, user_id,
        CAST(epoch_us(ts) - min(epoch_us(ts)) OVER () AS DOUBLE) / 1000000.0 AS "Time",
        value AS "Amount", CAST(event_type = 'error' AS INTEGER) AS "Class" FROM events"""),
    "txe": (("tx",), """SELECT tx.*, e.event_type FROM tx JOIN events e ON tx.tx_id = e.event_id"""),
    "num": ((), """SELECT l_quantity, l_extendedprice, l_discount, l_tax,
        CAST(l_returnflag = 'R' AS INTEGER) AS "Class" FROM lineitem"""),
    "scored": (("num",), """SELECT *, round(l_extendedprice, -2) / 200000.0 AS p FROM num"""),
    "feat": (("tx",), f"""SELECT t.tx_id, t.ts, t."Time", {_V}, t."Amount",
        CAST(e.label = 0 AS INTEGER) AS "Class" FROM embeddings e JOIN tx t ON e.vec_id = t.tx_id"""),
    "pred": ((), """SELECT CAST(event_id AS VARCHAR) AS prediction_id, ts AS "timestamp", value AS amount,
        value / (value + 50.0) AS fraud_probability, value / (value + 50.0) >= 0.5 AS is_fraud,
        CAST(1 + user_id % 3 AS VARCHAR) AS model_version FROM events"""),
    "lat": ((), """SELECT event_type <> 'error' AS ok, value / 1000.0 AS latency, ts FROM events"""),
    "versions": ((), """SELECT p_brand AS name, CAST(p_partkey AS VARCHAR) AS version, p_partkey AS run_id,
        ['None', 'Staging', 'Production'][p_partkey % 3 + 1] AS stage FROM part"""),
    "runs": ((), """SELECT p_partkey AS run_id,
        CASE WHEN p_size > 5 THEN p_retailprice END AS average_precision FROM part"""),
    "uris": ((), """SELECT page_id, url FROM pages"""),
    "ref": (("tx",), """SELECT * FROM tx WHERE ts < TIMESTAMP '2024-01-16 00:00:00'"""),
    "cur": (("tx",), """SELECT * FROM tx WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'"""),
    "refe": (("txe",), """SELECT * FROM txe WHERE ts < TIMESTAMP '2024-01-16 00:00:00'"""),
    "cure": (("txe",), """SELECT * FROM txe WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'"""),
    "fspl": (("feat",), """SELECT * EXCLUDE (rk, n), CASE WHEN rk <= n - ceil(CAST(0.3 AS DOUBLE) * n) THEN 'train'
        WHEN rk <= n - ceil(CAST(0.3 AS DOUBLE) * n) + floor(ceil(CAST(0.3 AS DOUBLE) * n) * CAST(0.5 AS DOUBLE)) THEN 'val'
        ELSE 'test' END AS split
        FROM (SELECT *, row_number() OVER (PARTITION BY "Class"
                          ORDER BY md5(concat_ws('|', '42', CAST(tx_id AS VARCHAR))), tx_id) AS rk,
                     count(*) OVER (PARTITION BY "Class") AS n FROM feat) r"""),
    "fref": (("fspl",), """SELECT * FROM fspl WHERE split = 'train'"""),
    "fcur": (("fspl",), """SELECT * FROM fspl WHERE split = 'test'"""),
    "pref": (("pred",), """SELECT * FROM pred WHERE "timestamp" < TIMESTAMP '2024-01-16 00:00:00'"""),
    "pcur": (("pred",), """SELECT * FROM pred WHERE "timestamp" >= TIMESTAMP '2024-01-16 00:00:00'"""),
}


def with_views(sql: str, names: tuple[str, ...] | list[str] = ()) -> str:
    """Prefix ``sql`` with the CTEs it names (and their dependencies), in order."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        ordered.append(n)

    for n in names:
        visit(n)
    if not ordered:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in ordered)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
