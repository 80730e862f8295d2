"""Embedding near-dedup with a pivot-permutation index.

A vector is described by its nearest reference points (pivots), in order, as seen from the mean of all unit vectors:
embeddings share a direction, which would bring every vector near every pivot. Pivots are kept apart (no two have a
cosine above ``apart``), so a crowded region holds a few and not its share of them. Inverted lists hold the vectors
of each pivot, in two ways:

- A vector whose nearest pivot has a cosine of ``apart`` at least has that pivot as its home. Two unit vectors that link
  are at most d = sqrt(2 - 2 threshold) apart, so from the mean they are seen under an angle of at most
  asin(d / r), r being the distance of either one from the mean. Whatever links with a vector therefore lies
  within that angle and the angle of its home, is in the home's list, and the vector is compared with all of that list:
  every link of a vector with a home is found.
- Vectors without a home, in thin regions, are in the lists of their first ``prefix`` pivots, and two of them are
  candidates when they share at least ``shared`` of these. Only links between two such vectors can be missed.

Candidates are verified by their cosine in double precision. A pair is looked at in one list: that of the smaller
home, or of its smallest shared pivot. The lists are split into blocks, and pairs of blocks are compared as
matrices, so a crowded pivot is many tasks and no row is made per pair: a pair of blocks returns a count per
vector and a spanning forest of its links.

The reference points are a sample: ``pivots`` vectors, by hash order of their values, more for larger
tables (the square root of the rows times ``per_root``), ``most`` at most, less those too near to one before.
Every vector is indexed. Equal vectors are one class, indexed once, and its copies are counted as links of each
other.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components have no link and are a
component of their own; vectors of different lengths are never compared; a null vec_id takes part but
names no component; repeated ids are vectors of their own; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components
from .vectors import matrix, unit, usable


def _apart(points: np.ndarray, most: float) -> np.ndarray:
    """The unit vectors ``points`` without those whose cosine to one before is above ``most``."""
    out = points[:0]
    for p in points:
        if not (out @ p > most).any():
            out = np.vstack([out, p])
    return out


def _seen(x: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors as directions from ``mean``, and their distances from it (one at the mean has no direction)."""
    away = unit(x) - mean
    far = np.sqrt((away * away).sum(axis=1))
    return away / np.where(far > 0, far, 1.0)[:, None], far


def _described(classes: DataFrame, means: dict[int, np.ndarray], pivots: dict[int, np.ndarray], prefix: int, apart: float,
               threshold: float) -> DataFrame:
    """Add ``near``: numbers of the ``prefix`` nearest pivots, nearest first (ties: the smaller number), ``home``:
    the first of them if its cosine is ``apart`` at least, else -1, and ``lists``: the pivots in whose lists the
    vector is, those whose homes may hold a vector linked with it and, without a home, the ``prefix`` nearest."""
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, same in pdf.groupby("dim"):
                for at in range(0, len(same), 2048):
                    some = same.iloc[at:at + 2048].copy()
                    x, far = _seen(matrix(some["embedding"]), means[dim])
                    cos = (x @ pivots[dim].T).round(12)
                    angle = np.arccos(apart) + np.arcsin(np.minimum(1.0, reach / np.maximum(far, 1e-300)))
                    within = np.where(far > reach, np.cos(np.minimum(np.pi, angle)) - 1e-9, -2.0)
                    near = np.argsort(-cos, axis=1, kind="stable")[:, :prefix].astype(np.int32)
                    housed = np.take_along_axis(cos, near[:, :1].astype(int), 1)[:, 0] >= apart
                    listed = cos >= within[:, None]
                    listed[np.flatnonzero(~housed)[:, None], near[~housed]] = True
                    some["near"], some["home"] = list(near), np.where(housed, near[:, 0], -1).astype(np.int32)
                    some["lists"] = [np.flatnonzero(x).astype(np.int32) for x in listed]
                    yield some

    return classes.mapInPandas(run, "dim int, cls long, copies long, embedding array<double>, near array<int>, home int, lists array<int>")


def _means(classes: DataFrame) -> dict[int, np.ndarray]:
    """The mean of the unit vectors of each length, from one sum a task and length."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            for dim, same in pdf.groupby("dim"):
                total[dim] = total.get(dim, 0.0) + unit(matrix(same["embedding"])).sum(axis=0)
        yield pd.DataFrame([(d, i, x) for d, v in total.items() for i, x in enumerate(v)], columns=["dim", "i", "x"])

    n = {r["dim"]: r["count"] for r in classes.groupBy("dim").count().collect()}  # one row per vector length
    sums = classes.select("dim", "embedding").mapInPandas(run, "dim int, i int, x double").groupBy("dim", "i").agg(F.sum("x").alias("x"))
    out = {d: np.zeros(d) for d in n}
    for r in sums.collect():  # a row per dimension
        out[r["dim"]][r["i"]] = r["x"] / n[r["dim"]]
    return out


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges (positions) that connect what the links a[i] - b[i] among n nodes connect: every node with the
    smallest it reaches."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            nodes = np.flatnonzero(label != np.arange(n))
            return list(zip(nodes.tolist(), label[nodes].tolist(), strict=True))
        label = new


def _compare(threshold: float, shared: dict[int, int]):
    """One pair of blocks of a pivot's list: links as counts per class and a spanning forest. ``shared``: by
    vector length."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pivot, least = int(pdf["pivot"].iloc[0]), shared[int(pdf["dim"].iloc[0])]
        first, second = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        same = not len(second)
        if same:
            second = first
        xs, ys = unit(matrix(first["embedding"])), unit(matrix(second["embedding"]))
        px, py = np.stack(first["near"]).astype(int), np.stack(second["near"]).astype(int)
        none = np.iinfo(np.int32).max
        hx, hy = (np.where(h < 0, none, h) for h in (first["home"].to_numpy(), second["home"].to_numpy()))
        close = xs @ ys.T >= threshold - 1e-9
        if same:
            close = np.triu(close, 1)
        i, j = np.nonzero(close)
        ok = np.zeros(len(i), bool)
        for at in range(0, len(i), 1 << 15):
            s = slice(at, at + (1 << 15))
            u, v = i[s], j[s]
            home = np.minimum(hx[u], hy[v])
            mine = home == pivot
            free = np.flatnonzero(home == none)
            both = (px[u[free]][:, :, None] == py[v[free]][:, None, :]).any(2)
            mine[free] = (both.sum(1) >= least) & (np.where(both, px[u[free]], none).min(1) == pivot)
            ok[s] = mine & (np.einsum("ij,ij->i", xs[u], ys[v]) >= threshold)
        i, j = i[ok], j[ok]
        cx, cy = first["cls"].to_numpy(), second["cls"].to_numpy()
        wx, wy = first["copies"].to_numpy(), second["copies"].to_numpy()
        count = {}
        for c, w in ((cx, np.bincount(i, weights=wy[j], minlength=len(cx))), (cy, np.bincount(j, weights=wx[i], minlength=len(cy)))):
            for k in np.flatnonzero(w):
                count[c[k]] = count.get(c[k], 0) + int(w[k])
        nodes = np.concatenate([cx, cy]) if not same else cx
        edges = _forest(i, j if same else j + len(cx), len(nodes))
        rows = [(c, None, n) for c, n in count.items()] + [(nodes[a], nodes[b], 0) for a, b in edges]
        return pd.DataFrame(rows, columns=["a", "b", "links"]).astype({"b": "Int64"})

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.95, prefix: int = 8, shared: int = 2, pivots: int = 64,
                 per_root: float = 2.0, most: int = 4096, block: int = 512, apart: float = 0.7) -> DataFrame:
    """``vectors`` (vec_id, embedding) -> vec_id, n_links, component_id, kept, one row per vector."""
    rows = written(vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
                   .withColumn("dim", F.when(usable(F.col("embedding")), F.size("embedding"))), "vectors")
    good = rows.where("dim IS NOT NULL")
    classes = good.groupBy("dim", "embedding").agg(F.count("*").alias("copies"))
    classes = written(classes.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    total = classes.count()
    wanted = int(min(most, max(pivots, per_root * np.sqrt(total))))
    chosen = classes.orderBy(F.xxhash64("embedding"), "cls").limit(wanted).select("dim", "embedding").collect()  # bounded sample
    by_dim: dict[int, list] = {}
    for r in chosen:
        by_dim.setdefault(r["dim"], []).append(r["embedding"])
    for r in classes.groupBy("dim").agg(F.min_by("embedding", F.xxhash64("embedding")).alias("e")).collect():  # one per vector length
        by_dim.setdefault(r["dim"], [r["e"]])
    means = _means(classes)
    points = {d: _apart(_seen(matrix(v), means[d])[0], apart) for d, v in by_dim.items()}

    described = _described(classes.select("dim", "cls", "copies", "embedding"), means, points, prefix, apart, threshold)
    listed = written(described, "vector-pivots")
    entries = listed.select("*", F.explode("lists").alias("pivot")).drop("lists")
    # blocks grow with the root of a crowded list, up to four times their size
    wide = F.greatest(F.lit(float(block)), F.least(F.lit(4.0 * block), 2 * F.sqrt(F.count("*"))))
    sizes = entries.groupBy("dim", "pivot").agg(F.ceil(F.count("*") / wide).cast("int").alias("_blocks"))  # a row per pivot
    own = F.pmod(F.xxhash64("cls", "pivot"), F.col("_blocks")).cast("int")
    put = entries.join(sizes, ["dim", "pivot"]).withColumn("_own", own)
    # block pair (x, y), x <= y: side 0 is block x, side 1 block y; a pair (x, x) has side 0 alone
    put = put.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    put = put.select("dim", "pivot", F.least("_own", "_other").alias("x"), F.greatest("_own", "_other").alias("y"),
                     (F.col("_own") > F.col("_other")).cast("int").alias("side"), "cls", "copies", "embedding", "near", "home")
    found = written(put.groupBy("dim", "pivot", "x", "y").applyInPandas(
        _compare(threshold, {d: min(shared, prefix, len(p)) for d, p in points.items()}), "a long, b long, links long"), "vector-links")
    part = components(found.where("b IS NOT NULL").select("a", "b"))
    linked = found.where("b IS NULL").groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("_links"))

    per_class = (classes.select("dim", "embedding", "cls", "copies")
                 .join(linked, "cls", "left").join(part.withColumnRenamed("node", "cls"), "cls", "left")
                 .select("embedding", (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("_n"),
                         F.coalesce("component", "cls").alias("_group")))
    known = good.select("vec_id", "embedding").join(per_class, "embedding")
    smallest = known.groupBy("_group").agg(F.min("vec_id").alias("_least"))
    out = known.join(smallest, "_group").select("vec_id", F.col("_n").alias("n_links"), F.col("_least").alias("component_id"))
    alone = rows.where("dim IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
