"""Hard-negative mining by threshold joins over an inverted index with suffix bounds (after L2AP).

Rows are dealt into blocks of ``block`` rows, each packed once; anchors are packed in groups. A search asks, for
every anchor, the rows whose score (inner product) reaches the anchor's threshold:

1. Dimensions are put in one order, those with the least energy first. In a block, a row leaves out of the inverted
   index as many of its first dimensions as its norm over them, times an anchor's norm over them, stays below that
   anchor's threshold, whatever the anchor of the group. Rows are kept sorted by the number of dimensions left out,
   so the list of a dimension is a run of them.
2. Partial scores are accumulated from the dimension with the most energy down, list by list; a pair is dropped as
   soon as its partial score and the product of both remaining norms stay below the threshold. The dimensions left
   out of the index are added for the pairs that are left, so every score is the whole one.
3. A block hands on, per anchor and window, its ``k`` best rows only. Anchors whose windows are not full ask
   again with a lower threshold; a window whose lower end has been reached, or whose threshold is at the
   smallest score possible, is closed. Thresholds only decide how much is pruned, never what is found.

There are two searches: the positives (the window has no lower end: thresholds fall from an estimate on a bounded
sample until it is full), then the negatives, one window per positive.

Defined cases: rows with a null label or a vector that is null or holds null entries take no part; vectors of
different lengths are never compared; ties go to the smaller vec_id, a null vec_id last, then by row; repeated ids
are rows of their own (an anchor is not its own positive, a copy with its id is); other columns are ignored; an
empty table gives no row. Scores are exact: in double precision as long as the product of the largest norms is below
2**52, in whole numbers of any size beyond; a score that no long holds raises ``OverflowError``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

NO_ID = 2**63 - 1  # stands for a null vec_id: last among ties
BLOCK = "dim int, block int, n int, row binary, id binary, label binary, vectors binary"
FOUND = "anchor long, win int, row long, id long, score long"
#: Rows of a block, and anchors of a group, that scores are accumulated for at a time.
STRIP = 256


def _blocks(rows: DataFrame, size: int, kind: str) -> DataFrame:
    """``rows`` in packed blocks of about ``size`` rows, one row per block."""
    count = rows.groupBy("dim").agg(F.ceil(F.count("*") / size).cast("int").alias("_n"))  # one row per vector length
    dealt = rows.join(F.broadcast(count), "dim").withColumn(kind, F.pmod(F.xxhash64("row"), "_n").cast("int"))

    def pack(t: pa.Table) -> pa.Table:
        def raw(c: str) -> bytes:
            c = t.column(c).combine_chunks()
            return (c.flatten() if c.type != pa.int64() else c).to_numpy().astype("<i8").tobytes()

        one = {"dim": t["dim"][0].as_py(), kind: t[kind][0].as_py(), "n": t.num_rows, "row": raw("row"), "id": raw("id"),
               "label": raw("label"), "vectors": raw("vector")}
        kinds = [pa.int32()] * 3 + [pa.binary()] * 4
        return pa.table({c: pa.array([v], k) for (c, v), k in zip(one.items(), kinds, strict=True)})

    return dealt.drop("_n").groupBy("dim", kind).applyInArrow(pack, BLOCK.replace("block", kind))


class Index:
    """Inverted index of one block for thresholds of at least ``floor`` times an anchor's norm."""

    def __init__(self, x: np.ndarray, order: np.ndarray, floor: float):
        norm = np.sqrt(np.cumsum(x[:, order].astype(np.float64) ** 2, axis=1))
        # a row leaves out its first dimensions as long as their norm is below the floor (with room for rounding)
        out = (norm * (1 + 1e-9) < floor).sum(axis=1)
        self.rows = np.argsort(out, kind="stable")
        self.out = out[self.rows]
        self.x = x[self.rows][:, order].astype(np.float64)
        self.x[np.arange(x.shape[1]) < self.out[:, None]] = 0.0
        self.before = np.c_[np.zeros(len(x)), norm[self.rows]]  # norm of the first j dimensions
        self.lists = np.searchsorted(self.out, np.arange(x.shape[1]), "right")  # rows in the list of each dimension

    def search(self, a: np.ndarray, least: np.ndarray, step: int = 8) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (anchor, row of the block) that may reach ``least[anchor]``; ``a``: anchors in the index's order."""
        before = np.c_[np.zeros(len(a)), np.sqrt(np.cumsum(a ** 2, axis=1))]
        least = least - 1e-9 * (1 + before[:, -1] * (self.before[:, -1].max() if len(self.rows) else 0.0))  # room for rounding
        at, acc = a.shape[1], np.zeros((len(a), len(self.rows)))
        i = j = score = None
        while at > 0:
            at, high = max(0, at - step), at
            rest = np.maximum(at, self.out)  # dimensions not added yet: those before, and those left out of the index
            norms = self.before[np.arange(len(rest)), rest]
            if i is None:  # whole lists, all anchors at once, while most pairs are open
                n = int(self.lists[high - 1])  # the lists of the dimensions before are no longer
                acc[:, :n] += a[:, at:high] @ self.x[:n, at:high].T
                open_ = acc + before[:, rest] * norms >= least[:, None]
                if open_.mean() < 0.1:
                    i, j = np.nonzero(open_)
                    score = acc[i, j]
            else:
                for s in range(0, len(i), 1 << 17):
                    part = slice(s, s + (1 << 17))
                    score[part] += np.einsum("ij,ij->i", a[i[part], at:high], self.x[j[part], at:high])
                on = score + before[i, rest[j]] * norms[j] >= least[i]
                i, j, score = i[on], j[on], score[on]
        if i is None:
            i, j = np.nonzero(acc + before[:, self.out] * self.before[np.arange(len(self.out)), self.out] >= least[:, None])
        return i, self.rows[j]


def _scores(a: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whole inner products of the pairs (a[i], x[j])."""
    size = max((np.sqrt((v.astype(np.float64) ** 2).sum(axis=1)).max() if v.size else 0.0) for v in (a, x))
    if size * size >= 2.0 ** 52:
        exact = [sum(p * q for p, q in zip(u, v, strict=True)) for u, v in zip(a[i].tolist(), x[j].tolist(), strict=True)]
        return np.array(exact, dtype=np.int64)  # raises OverflowError beyond a long
    out = np.empty(len(i), np.int64)
    for s in range(0, len(i), 1 << 15):
        part = slice(s, s + (1 << 15))
        out[part] = np.einsum("ij,ij->i", a[i[part]].astype(np.float64), x[j[part]].astype(np.float64))
    return out


def _searched(order: dict[int, np.ndarray], k: int, same: bool):
    """One block against one group of anchors and their open windows (win, low, high): the k best rows of the
    block for each window, with the anchors' label (``same``) or another one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                yield pd.DataFrame(_block_best(r, order[r.dim], k, same), columns=["anchor", "win", "row", "id", "score"])

    return run


def _block_best(r, order: np.ndarray, k: int, same: bool) -> list[tuple]:
    x = np.frombuffer(r.vectors, "<i8").reshape(r.n, r.dim)
    row, ids, label = (np.frombuffer(b, "<i8") for b in (r.row, r.id, r.label))
    a = np.frombuffer(r.a_vectors, "<i8").reshape(r.a_n, r.dim)
    a_row, a_label = np.frombuffer(r.a_row, "<i8"), np.frombuffer(r.a_label, "<i8")
    # windows of this group, sorted by anchor
    w_row, win, low, high = (np.asarray(v, dtype=np.int64) for v in (r.w_row, r.w_win, r.w_low, r.w_high))
    order_w = np.lexsort((win, w_row))
    w_row, win, low, high = w_row[order_w], win[order_w], low[order_w], high[order_w]
    by_row = np.argsort(a_row)
    asked, first = np.unique(w_row, return_index=True)
    a, a_label = a[by_row[np.searchsorted(a_row[by_row], asked)]], a_label[by_row[np.searchsorted(a_row[by_row], asked)]]
    least = np.minimum.reduceat(low, first).astype(np.float64)
    ends = np.r_[first[1:], len(w_row)]
    norm = np.sqrt((a.astype(np.float64) ** 2).sum(axis=1))
    ratio = np.where(norm > 0, least / np.where(norm > 0, norm, 1.0), np.where(least > 0, np.inf, 0.0))
    out: list[tuple] = []
    near = np.argsort(-ratio)  # anchors with like thresholds share an index
    for at in range(0, len(asked), STRIP):
        some = near[at:at + STRIP]
        index = Index(x, order, max(0.0, float(ratio[some].min())))
        i, j = index.search(a[some][:, order].astype(np.float64), least[some])
        u = some[i]
        ok = (row[j] != asked[u]) & ((label[j] == a_label[u]) == same)
        u, j = u[ok], j[ok]
        score = _scores(a, x, u, j)
        ranked = np.lexsort((row[j], ids[j], -score, u))
        u, j, score = u[ranked], j[ranked], score[ranked]
        begin, end = np.searchsorted(u, some), np.searchsorted(u, some, "right")
        for anchor, b, e in zip(some.tolist(), begin.tolist(), end.tolist(), strict=True):
            s = score[b:e]
            for w in range(first[anchor], ends[anchor]):
                f = b + int(np.searchsorted(-s, -high[w]))  # first score within the window
                for at_row in range(f, min(f + k, e)):
                    if score[at_row] < low[w]:
                        break
                    out.append((asked[anchor], win[w], row[j[at_row]], ids[j[at_row]], score[at_row]))
    return out


def _round(blocks: DataFrame, anchors: DataFrame, windows: DataFrame, order: dict[int, np.ndarray], k: int, same: bool) -> DataFrame:
    """``windows`` (dim, grp, anchor, win, low, high): the ``k`` best rows of every window over all blocks."""
    packed = windows.groupBy("dim", "grp").agg(*[F.collect_list(F.col(c)).alias(f"w_{n}")  # windows of one group of anchors
                                                 for c, n in (("anchor", "row"), ("win", "win"), ("low", "low"), ("high", "high"))])
    asks = anchors.join(packed, ["dim", "grp"]).select("dim", F.col("n").alias("a_n"), F.col("row").alias("a_row"), F.col("label").alias("a_label"),
                                                       F.col("vectors").alias("a_vectors"), "w_row", "w_win", "w_low", "w_high")
    numbers = blocks.select("dim", "block")
    tasks = blocks.join(asks.join(numbers, "dim"), ["dim", "block"])
    found = tasks.mapInPandas(_searched(order, k, same), FOUND)
    best = Window.partitionBy("anchor", "win").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _search(blocks: DataFrame, anchors: DataFrame, windows: DataFrame, order: dict[int, np.ndarray], k: int, same: bool, between: Column) -> DataFrame:
    """``windows`` (dim, grp, anchor, win, floor, high, low): best ``k`` rows with floor <= score <= high of each. The
    first threshold is ``low``; windows that are not full ask again from ``between``, then from ``floor``."""
    done, open_ = None, windows
    for lower in (between, F.col("floor"), None):
        found = written(_round(blocks, anchors, open_.drop("floor"), order, k, same), "mining-round")
        n = found.groupBy("anchor", "win").agg(F.count("*").alias("_n"))
        state = written(open_.join(n, ["anchor", "win"], "left"), "mining-windows")
        closed = (F.coalesce("_n", F.lit(0)) >= k) | (F.col("low") <= F.col("floor"))
        kept = found.join(state.where(closed).select("anchor", "win"), ["anchor", "win"])
        done = kept if done is None else done.unionByName(kept)
        if lower is None:
            break
        open_ = state.where(~closed).drop("_n").withColumn("low", lower)
        if open_.isEmpty():
            break
    return done


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
         block: int = 4096, group: int = 1024, sample: int = 2048) -> DataFrame:
    """``rows`` (vec_id, vector of whole numbers, label) -> anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score: for each anchor and each of its ``positives`` best rows of its label the best ``negatives`` rows
    of other labels whose score is ``low`` to ``high`` percent of the positive's."""
    v = F.col("vector")
    used = rows.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("id"), v.cast("array<long>").alias("vector"),
                       F.col("label").cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("_asks"))
    used = used.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull()))
    used = written(used.withColumn("row", F.monotonically_increasing_id()).withColumn("dim", F.size("vector")), "mining-rows")
    asking = used.where("_asks")
    blocks = written(_blocks(used.drop("_asks"), block, "block"), "mining-blocks")
    anchors = written(_blocks(asking.drop("_asks"), group, "grp"), "mining-anchors")
    groups = anchors.select("dim", "grp", "row").groupBy("dim", "grp").applyInPandas(
        lambda pdf: pd.DataFrame({"dim": pdf["dim"].iloc[0], "grp": pdf["grp"].iloc[0], "anchor": np.frombuffer(pdf["row"].iloc[0], "<i8")}),
        "dim int, grp int, anchor long")

    order, first = _started(used, sample, positives)
    least = -(2**62)
    wide = groups.select("*", F.lit(0).alias("win"), F.lit(least).alias("floor"), F.lit(2**63 - 1).alias("high"))
    known = asking.select(F.col("row").alias("anchor"), "label", F.col("id").alias("anchor_id"),
                          F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x).alias("_sq"))
    start = F.coalesce(F.least(F.sqrt("_sq") * first[F.col("dim")], F.lit(2.0**61)), F.lit(0.0)).cast("long")
    wide = wide.join(known.select("anchor", "_sq"), "anchor").withColumn("low", start).drop("_sq")
    pos = _search(blocks, anchors, wide, order, positives, True, F.shiftright("low", 1))
    pos = written(pos.select("anchor", F.col("rank").alias("win"), F.col("id").alias("pos"), F.col("score").alias("positive_score")), "mining-positives")

    p = F.col("positive_score").cast("decimal(38,0)")
    bottom = F.ceil(p * low / 100).cast("long")  # whole scores of at least low percent
    top = F.floor(p * high / 100).cast("long")
    wins = pos.join(groups, "anchor").select("dim", "grp", "anchor", "win", bottom.alias("floor"), top.alias("high")).where("floor <= high")
    # most windows fill near their upper end
    wins = wins.withColumn("low", F.col("high") - F.shiftright(F.col("high") - F.col("floor"), 2))
    neg = _search(blocks, anchors, wins, order, negatives, False, F.shiftright("floor", 1) + F.shiftright("low", 1))
    ids = known.select("anchor", "anchor_id")
    out = neg.join(pos, ["anchor", "win"]).join(ids, "anchor")

    def own(c: str) -> Column:
        return F.when(F.col(c) != NO_ID, F.col(c))

    return out.select(F.col("anchor_id"), own("pos").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                      own("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _started(used: DataFrame, sample: int, k: int) -> tuple[dict[int, np.ndarray], Column]:
    """Per vector length, the order of its dimensions and a first threshold for positives in parts of an anchor's
    norm, both estimated on a sample of at most ``sample`` rows in hash order. They decide how much is pruned, not
    what is found."""
    some = used.orderBy(F.xxhash64("row")).limit(sample).select("dim", "label", "vector").toPandas()  # bounded
    total = {r["dim"]: r["count"] for r in used.groupBy("dim").count().collect()}  # one row per vector length
    order, start = {}, {}
    for dim, n in total.items():
        mine = some[some["dim"] == dim]
        x = np.array([np.asarray(v, np.float64) for v in mine["vector"]]).reshape(len(mine), dim)
        order[dim] = np.argsort((x ** 2).sum(axis=0), kind="stable") if len(x) else np.arange(dim)
        start[dim] = 0.0
        if len(x) > 1 and dim:
            norm = np.sqrt((x ** 2).sum(axis=1))
            a = x[:256] / np.where(norm[:256] > 0, norm[:256], 1.0)[:, None]
            s = a @ x.T
            s[np.arange(len(a)), np.arange(len(a))] = -np.inf
            alike = mine["label"].to_numpy()[None, :] == mine["label"].to_numpy()[:len(a), None]
            # the share of all rows that a threshold should let through: four times what a window needs
            share = min(1.0, 4 * k / max(n, 1))
            found = s[alike & np.isfinite(s)]
            if len(found):
                start[dim] = float(np.quantile(found, max(0.0, 1 - share / max(alike.mean(), 1e-9))))
    pairs = [z for d, t in start.items() for z in (F.lit(d), F.lit(t))]
    return order, F.create_map(*pairs) if pairs else F.create_map().cast("map<int,double>")
