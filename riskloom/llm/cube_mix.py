"""Mixing sources to target weights by cube-method balanced sampling.

Every source gets a target share of all words. A document of a source with ratio ``r = target / size``
is taken ``floor(r)`` times, and once more with probability ``r - floor(r)``. Those fractional
probabilities are rounded by the cube method: a flight moves the probabilities of a block of documents
along directions that leave the block's expected number of documents and of words unchanged, until all
but two are 0 or 1. The rest of all blocks of a source fly again together, level by level, until one
block holds them. With the first block of the source, which has waited, they are settled longest first; each
landing is followed by a flight of shorter documents that makes up for what it missed.

Blocks hold at most ``block`` rows whatever the size of the source; each level keeps two rows per block.

Defined cases: null text has size 0; a null source ranks last; documents of size 0 are never needed to
meet a target but are balanced like all others (taken = 0 words); repeated rows are mixed one by one;
a block flies its longest documents first, so that those left for the landing are short, equal sizes in order of
a hash of the whole row: reruns and other partitionings agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, written

_EPS = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """(source, size) rows -> one row per source: source_size, rank, weight, target.

    Sources in code point order, null last, weigh ``weights``, repeating, and share all words; a target
    above ``cap`` times its source's size stops there, and the excess goes to the others by weight until
    none is above. The windows run over one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    ranked = per.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    t = ranked.withColumn("weight", weight).withColumn("_cap", cap * F.col("source_size"))
    # capped sources are those with the smallest cap per weight: raise the level until the next one is not reached
    by = Window.orderBy(F.col("_cap") / F.col("weight"), "_rank")
    below = by.rowsBetween(Window.unboundedPreceding, -1)
    everything = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(below), F.lit(0.0))
    room = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0.0))
    t = t.withColumn("_level", left / room)
    open_ = F.col("_cap") > F.col("_level") * F.col("weight")
    # the level that holds is the one of the first source that is not capped (null: all are)
    level = F.min(F.when(open_, F.struct("_pos", "_level"))).over(everything)["_level"]
    t = t.withColumn("_pos", F.row_number().over(by)).withColumn("_hold", level)
    target = F.when(F.col("_hold").isNull(), F.col("_cap")).otherwise(F.least("_cap", F.col("_hold") * F.col("weight")))
    return t.select("source", "source_size", "n_docs", "weight", target.alias("target"))


def flight(pi: np.ndarray, size: np.ndarray, pick: np.random.Generator) -> np.ndarray:
    """Flight phase: move ``pi`` inside the unit cube, keeping sum(pi) and sum(pi * size), until fewer than
    three entries (or only entries of one size: two) lie strictly between 0 and 1."""
    pi = pi.copy()
    live: list[int] = []
    draws = pick.random(len(pi))
    for i in range(len(pi)):
        if _EPS < pi[i] < 1 - _EPS:
            live.append(i)
        else:
            pi[i] = round(pi[i])
        while len(live) == 3:
            a, b, c = live
            u = (size[b] - size[c], size[c] - size[a], size[a] - size[b])  # null space of (1, size)
            if u == (0, 0, 0):
                u = (1.0, -1.0, 0.0)
            up = min((1 - pi[j]) / x if x > 0 else pi[j] / -x for j, x in zip(live, u, strict=True) if x)
            down = min(pi[j] / x if x > 0 else (1 - pi[j]) / -x for j, x in zip(live, u, strict=True) if x)
            step = up if draws[i] * (up + down) < down else -down
            for j, x in zip(live, u, strict=True):
                pi[j] = min(1.0, max(0.0, pi[j] + step * x))
            rest = [j for j in live if _EPS < pi[j] < 1 - _EPS]
            for j in live:
                if j not in rest:
                    pi[j] = round(pi[j])
            live = rest
    return pi


def land(pi: np.ndarray, size: np.ndarray, want: float) -> np.ndarray:
    """Landing: settle the fractional entries (two at most after a flight) so that the words taken come
    nearest to ``want``, then the number of documents to its expectation; ties take fewer."""
    out = pi.copy()
    open_ = np.flatnonzero((pi > _EPS) & (pi < 1 - _EPS))
    rest, docs = want - float(np.delete(pi, open_) @ np.delete(size, open_)), pi[open_].sum()
    choices = [[(c >> j) & 1 for j in range(len(open_))] for c in range(2 ** len(open_))]
    best = min(choices, key=lambda x: (round(abs(float(np.dot(x, size[open_])) - rest), 6), round(abs(sum(x) - docs), 6), sum(x)))
    out[open_] = best
    return np.round(out)


def settle(pi: np.ndarray, size: np.ndarray, pick: np.random.Generator) -> np.ndarray:
    """Flight and landing of one source's last rows, longest first: groups of half of what is left, each with
    its own flight and landing. What a landing misses moves the probabilities of the next, shorter group, so
    the words taken end within about one of the shortest documents of what was expected."""
    pi, at, missed = pi.copy(), 0, 0.0
    while at < len(pi):
        end = len(pi) if len(pi) - at <= 16 else at + (len(pi) - at) // 2
        p, s = pi[at:end], size[at:end]
        want = float((p * s).sum()) + missed
        free = (p > _EPS) & (p < 1 - _EPS)
        words = float(s[free].sum())
        if words:
            p[free] = np.clip(p[free] + missed / words, 0, 1)
        out = land(flight(p, s, pick), s, want)
        missed = want - float((out * s).sum())
        pi[at:end], at = out, end
    return pi


def _fly(last: bool, seed: int, columns: list[str]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[columns].sort_values(["size", "_order", "_key"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        pi, size = pdf["_pi"].to_numpy(float), pdf["size"].to_numpy(float)
        pick = np.random.default_rng([seed, len(pdf), int(size.sum()), int(pdf["_order"].iloc[0]) & 0x7FFFFFFF])
        pdf["_pi"] = settle(pi, size, pick) if last else flight(pi, size, pick)
        return pdf

    return run


def round_balanced(rows: DataFrame, block: int = 1024, seed: int = 11) -> DataFrame:
    """Rows with source, size, _order, _key and _pi (a probability): the same rows with _pi 0 or 1. Each
    level flies in blocks of about ``block`` rows of a source; two fractional rows a block go on. The first block of
    every source waits for the last step, in which it balances what the others left."""
    counts = rows.groupBy(F.col("source").alias("_s")).agg(F.ceil(F.count("*") / block).alias("_blocks"))
    numbered = (rows.join(counts, F.col("source").eqNullSafe(F.col("_s")))
                .withColumn("_block", F.pmod(F.xxhash64("_order"), "_blocks")).drop("_s", "_blocks"))
    held, flown = numbered.where("_block = 0").drop("_block"), numbered.where("_block > 0")
    done, level = None, 0
    while True:
        flown = written(flown.groupBy("source", "_block").applyInPandas(_fly(False, seed + level, rows.columns), rows.schema), "cube-flight")
        settled = flown.where("_pi IN (0.0, 1.0)")
        done, left = settled if done is None else done.unionByName(settled), flown.where("_pi NOT IN (0.0, 1.0)")
        counts = left.groupBy(F.col("source").alias("_s")).agg(F.ceil(F.count("*") / block).alias("_blocks"))
        level += 1
        if counts.agg(F.max("_blocks")).first()[0] in (None, 1):
            break
        flown = (left.join(counts, F.col("source").eqNullSafe(F.col("_s")))
                 .withColumn("_block", F.pmod(F.xxhash64(F.lit(level), "_order"), "_blocks")).drop("_s", "_blocks"))
    end = held.unionByName(left).groupBy("source").applyInPandas(_fly(True, seed + level, rows.columns), rows.schema)
    return done.unionByName(written(end, "cube-landing"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0, block: int = 1024,
        seed: int = 11) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) -> one row per document: doc_id, row_hash (of the whole row),
    source, size, source_size, target, copies and taken = copies * size."""
    sizes = written(docs.select(
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("_key"), F.col("doc_id").isNull().alias("_no_id"),
        F.xxhash64(*docs.columns).alias("row_hash"), "source", n_words(F.col("text")).alias("size")), "cube-sizes")
    targets = written(source_targets(sizes, weights, cap), "cube-targets").withColumnRenamed("source", "_src")
    ratio = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(cap))).otherwise(F.lit(0.0))
    whole = F.floor(F.col("ratio") + _EPS)
    ready = (sizes.join(targets, F.col("source").eqNullSafe(F.col("_src"))).withColumn("ratio", ratio)
             .select("_key", "_no_id", "row_hash", "source", "size", "source_size", "target",
                     whole.cast("long").alias("_whole"), F.greatest(F.col("ratio") - whole, F.lit(0.0)).alias("_pi"),
                     F.xxhash64(F.lit(seed), "_key", "row_hash", "size").alias("_order")))
    copies = F.col("_whole") + F.col("_pi").cast("long")
    return round_balanced(ready, block, seed).select(
        F.when(~F.col("_no_id"), F.col("_key")).alias("doc_id"), "row_hash", "source", "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **kw) -> DataFrame:
    """The documents themselves, each as many times as the mix takes it (same columns). Identical rows share
    their copies out evenly."""
    share = mix(docs, **kw).groupBy(F.col("row_hash").alias("_h")).agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows"))
    names = docs.columns
    hashed = docs.withColumn("_h", F.xxhash64(*names))
    number = F.row_number().over(Window.partitionBy("_h").orderBy("_h"))
    own = F.floor(F.col("_copies") / F.col("_rows")) + F.when(F.col("_n") <= F.col("_copies") % F.col("_rows"), 1).otherwise(0)
    return (hashed.join(share.where("_copies > 0"), "_h").withColumn("_n", number).withColumn("_times", own.cast("int"))
            .where("_times > 0").withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*names))
