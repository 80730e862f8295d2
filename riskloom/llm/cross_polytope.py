"""Approximate nearest neighbours by cross-polytope hashing.

A rotation of unit vectors by sign flips and fast Hadamard transforms (three rounds, padded to a power of two) assigns
a vector to its nearest signed axis: the coordinate of largest magnitude with its sign. A table joins the axes of
two rotations or more, so that a bucket holds a bounded number of rows however many there are. A query probes the
buckets of each table in order of the sum of its coordinates along their axes, as many as hold about ``reach`` times
the square root of the rows in all: the share of the rows that is reranked falls as the table grows.

Rows are sent by their first axes only, as many as make groups of a few parts; the other axes are looked up inside
the group, so a query is sent once per group and not once per bucket. Tables take turns, as many at a time as move about
``PASS_BYTES`` of members: what lies on disk is the rows once, with their buckets, and one turn's shuffle. Groups
are split into parts that a Python worker can hold (``part`` vectors at least, ``PART_BYTES`` at most), so a crowded axis is
many tasks; the queries of a part follow its members in the sorted partition and pass by in batches, so their number takes
no memory. Each part reranks its candidates exactly (cosine on the original vectors) and hands on the best ``k`` per query,
so a group of many queries or many equal vectors stays small. Queries that found fewer than ``k`` rows are searched again,
exactly, against all rows in blocks.

Measured on the test tables (README): recall above 0.95 at the default parameters.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows with
a null vec_id; vectors are compared only with those of the same length; ties go to the smaller vec_id; repeated ids
are candidates of their own, but never of a query with the same id, and copies of one id count once; fewer candidates
than ``k`` give fewer rows, all of them; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import give_back, small_batches, written
from .vectors import unit, usable
from .wordhash import mix

PART_BYTES = 1 << 25  # of the members that a Python worker holds at a time, as doubles
PASS_BYTES = 1 << 28  # of the members that one turn's tables send
SENT_BYTES = 1 << 22  # of an Arrow batch on its way to the parts
PAIRS = 1 << 15  # of queries and members scored at a time


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the columns (length a power of two), scaled to keep lengths."""
    n, h = len(x), 1
    x = x.copy()
    while h < n:
        y = x.reshape(n // (2 * h), 2, h, -1)
        less = y[:, 0] - y[:, 1]
        y[:, 0] += y[:, 1]
        y[:, 1] = less
        h *= 2
    x /= np.sqrt(n)
    return x


def rotated(x: np.ndarray, number: int, seed: int) -> np.ndarray:
    """Coordinates of unit vectors along the 2d signed axes of a rotation."""
    d = 1 << max(0, (x.shape[1] - 1).bit_length())
    y = np.zeros((d, len(x)))  # a column for each vector: sums of whole rows are several times faster
    y[:x.shape[1]] = x.T
    signs = np.random.default_rng([seed, number, d])
    for _ in range(3):
        y = hadamard(y * signs.choice([-1.0, 1.0], d)[:, None])
    return np.ascontiguousarray(np.concatenate([y, -y]).T)


@lru_cache(maxsize=8)
def _leading(n: int, m: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The places (i, j) in two falling orders of ``n`` and ``m`` among which the ``most`` largest sums are."""
    each = np.minimum(n, most // np.arange(1, m + 1))
    j = np.repeat(np.arange(m), each)
    return np.arange(len(j)) - np.repeat(np.cumsum(each) - each, each), j


def probed(along: list[np.ndarray], probes: int) -> np.ndarray:
    """The ``probes`` buckets with the largest sum of coordinates, for one vector; ``along``: its coordinates in each
    rotation of a table. A prefix of a bucket among the best is among the best prefixes, so each step keeps that many."""
    code, total = np.zeros(1, np.int64), np.zeros(1)
    for y in along:
        if len(code) * len(y) > 1 << 16:  # the i-th best prefix with the j-th best axis has i * j better ones before it
            i, j = _leading(len(code), len(y), probes)
            first, then = np.argsort(-total, kind="stable")[i], np.argsort(-y, kind="stable")[j]
            sums, codes = total[first] + y[then], code[first] * len(y) + then
        else:
            sums = (total[:, None] + y[None, :]).ravel()
            codes = (code[:, None] * len(y) + np.arange(len(y))[None, :]).ravel()
        if len(sums) > probes:
            best = np.argpartition(-sums, probes - 1)[:probes]
            sums, codes = sums[best], codes[best]
        code, total = codes, sums
    return code


def plan(rows: int, dim: int, tables: int, reach: float, bucket: int = 16) -> tuple[int, int]:
    """(rotations a table joins, buckets probed a table) for a number of rows of one vector length."""
    wide = 2 << max(0, (dim - 1).bit_length())
    joined = 2
    while wide ** joined * bucket < rows:
        joined += 1
    wanted = reach * np.sqrt(max(rows, 1)) / max(rows, 1) / tables  # share of the buckets
    return joined, int(min(wide ** joined, max(1, np.ceil(wanted * wide ** joined))))


def lead(rows: int, dim: int, joined: int, part: int) -> int:
    """Number of first axes by which rows are sent: groups of eight parts at most, if rows are spread evenly."""
    wide, n = 2 << max(0, (dim - 1).bit_length()), 1
    while n < joined - 1 and wide ** n * part * 8 < rows:
        n += 1
    return n


# ---- Arrow columns ---------------------------------------------------------------------------------------------------------

def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary column without nulls."""
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def _binary(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary column of pieces of ``flat`` that end at ``ends`` (numbers of its items)."""
    offs = np.concatenate([[0], ends * flat.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(flat))])


def _rows(x: np.ndarray) -> pa.Array:
    return _binary(x.ravel(), np.arange(1, len(x) + 1) * x.shape[1])


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))


def _ints(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


# ---- buckets ---------------------------------------------------------------------------------------------------------------

#: ``slots``: by table, the number of the group (table and first axes); ``rests``: the other axes. ``part`` and ``blocks``: of the length.
MEMBERS = "dim int, part int, blocks int, asks boolean, vec_id long, slots array<long>, rests array<int>, vector binary"
SENT = "dim int, slot long, part int, kind int, vec_id long, rests binary, vector binary"


class Buckets:
    """Where rows of one length go: rotations a table joins, buckets probed a table, first axes that make the group."""

    def __init__(self, rows: int, dim: int, tables: int, reach: float, part: int) -> None:
        self.joined, self.probes = plan(rows, dim, tables, reach)
        self.part = max(part, min(rows // 64, PART_BYTES // (8 * dim)))  # vectors a part
        self.blocks = -(-rows // self.part)
        self.wide = 2 << max(0, (dim - 1).bit_length())
        self.space = self.wide ** (self.joined - lead(rows, dim, self.joined, self.part))  # buckets of a group

    def along(self, x: np.ndarray, table: int, seed: int) -> list[np.ndarray]:
        return [rotated(x, table * self.joined + j, seed) for j in range(self.joined)]


def _members(rows: DataFrame, buckets: dict[int, Buckets], tables: int, seed: int, item: str) -> DataFrame:
    """``rows`` (dim, asks, vec_id, embedding) with their own bucket in every table; vectors as bytes of ``item``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = _ints(batch.column(0))
            for dim in np.unique(dims).tolist():
                b, at = buckets[dim], np.flatnonzero(dims == dim)
                for i in range(0, len(at), most := max(1, SENT_BYTES // (8 * b.wide))):
                    some = batch.take(pa.array(at[i:i + most]))
                    raw = _ints(some.column(3).flatten()).reshape(-1, dim)
                    x, codes = unit(raw), np.zeros((len(raw), tables), np.int64)
                    for t in range(tables):
                        for y in b.along(x, t, seed):
                            codes[:, t] = codes[:, t] * b.wide + y.argmax(axis=1)
                    same = [pa.array(np.full(len(raw), n, np.int32)) for n in (dim, b.part, b.blocks)]
                    columns = [*same, some.column(1), some.column(2), _lists(codes // b.space * tables + np.arange(tables)),
                               _lists((codes % b.space).astype(np.int32)), _rows(raw.astype(item))]
                    yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in MEMBERS.split(", ")])
        give_back()

    return rows.select("dim", "asks", "vec_id", "embedding").mapInArrow(run, MEMBERS)


def _sent(members: DataFrame, buckets: dict[int, Buckets], crowded: dict[int, tuple[np.ndarray, np.ndarray]], some: range,
          tables: int, seed: int, item: str) -> DataFrame:
    """What the tables ``some`` send to the parts: members (kind 0) with the rest of their bucket, queries (kind 1) with
    those of the buckets that they probe in the group."""

    def parts(dim: int, slot: np.ndarray) -> np.ndarray:
        known, n = crowded.get(dim, (np.zeros(0, np.int64),) * 2)
        at = np.searchsorted(known, slot)
        hit = np.flatnonzero(at < len(known))
        hit = hit[known[at[hit]] == slot[hit]]
        out = np.ones(len(slot), np.int64)
        out[hit] = n[at[hit]]
        return out

    def batch(dim, raw, ids, at, slot, part, kind, flat, ends) -> Iterator[pa.RecordBatch]:
        most = max(1, SENT_BYTES // (8 * dim + 64))
        for i in range(0, len(at), most):
            s, before = slice(i, i + most), ends[i - 1] if i else 0
            own = at[s]
            columns = [np.full(len(own), dim, np.int32), slot[s], part[s].astype(np.int32), np.full(len(own), kind, np.int32), ids[own]]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), _binary(flat[before:ends[s][-1]], ends[s] - before), _rows(raw[own])],
                                             names=[c.split()[0] for c in SENT.split(", ")])

    def asked(b: Buckets, dim: int, x: np.ndarray, t: int) -> tuple[np.ndarray, ...]:
        """(row, slot, part, rests, their ends) of the queries ``x`` in one table."""
        along = b.along(x, t, seed)
        found = [np.sort(probed([y[i] for y in along], b.probes)) for i in range(len(x))]
        at, code = np.repeat(np.arange(len(x)), [len(f) for f in found]), np.concatenate(found)
        group, rest = code // b.space, (code % b.space).astype(np.int32)
        begin = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (group[1:] != group[:-1])])
        size, at, slot = np.diff(np.r_[begin, len(code)]), at[begin], group[begin] * tables + t
        n = parts(dim, slot)
        again = np.repeat(np.arange(len(at)), n)  # to every part
        part = np.arange(len(again)) - np.repeat(np.cumsum(n) - n, n)
        size, ends = size[again], np.cumsum(size[again])
        return at[again], slot[again], part, rest[np.repeat(begin[again] - (ends - size), size) + np.arange(ends[-1])], ends

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            dims, asks, ids = (_ints(rows.column(i)) for i in (0, 1, 2))
            slots, rests = (_ints(rows.column(i).flatten()).reshape(-1, tables) for i in (3, 4))
            data, offs = _bytes(rows.column(5))
            for dim in np.unique(dims).tolist():
                b, all_ = buckets[dim], np.flatnonzero(dims == dim)
                width = dim * np.dtype(item).itemsize
                raw = data[(offs[all_][:, None] + np.arange(width)).ravel()].view(item).reshape(-1, dim)
                own = np.arange(len(all_))
                for t in some:
                    slot = slots[all_, t]
                    n = parts(dim, slot)
                    part = (mix(ids[all_].astype(np.uint64)) % n.astype(np.uint64)).astype(np.int64)
                    yield from batch(dim, raw, ids[all_], own, slot, part, 0, rests[all_, t], own + 1)
                which = np.flatnonzero(asks[all_])
                for i in range(0, len(which), most := max(1, SENT_BYTES // (4 * b.probes + 8 * b.wide * b.joined))):
                    q = which[i:i + most]
                    x = unit(raw[q].astype(np.float64))
                    for t in some:
                        at, slot, part, flat, ends = asked(b, dim, x, t)
                        yield from batch(dim, raw[q], ids[all_][q], at, slot, part, 1, flat, ends)
        give_back()

    return members.select("dim", "asks", "vec_id", "slots", "rests", "vector").mapInArrow(run, SENT)


# ---- reranking -------------------------------------------------------------------------------------------------------------

class Part:
    """The members of one part, by the rest of their bucket and then by their id."""

    def __init__(self, ids: np.ndarray, rests: np.ndarray, x: np.ndarray) -> None:
        self.ids, self.x, self.order = ids, x, np.lexsort((ids, rests))
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(rests))])

    def nearest(self, k: int, own: np.ndarray, rests: np.ndarray, ends: np.ndarray, q: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(query_id, vec_id, score) of the best ``k`` members of every query among those in its buckets."""
        last = len(self.begin) - 1
        low, high = self.begin[np.minimum(rests, last)], self.begin[np.minimum(rests + 1, last)]
        upto = np.cumsum(high - low)[ends - 1]  # pairs up to a query
        i = 0
        while i < len(own):
            done = upto[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(upto, done + PAIRS, "right")))
            s = slice(ends[i - 1] if i else 0, ends[j - 1])
            n = high[s] - low[s]
            at = self.order[np.repeat(low[s] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            by = np.repeat(np.arange(i, j), np.diff(np.r_[done, upto[i:j]]))
            other = self.ids[at] != own[by]
            at, by = at[other], by[other]
            if len(at):
                score = np.einsum("ij,j->i", self.x[at], q[i]) if j == i + 1 else np.einsum("ij,ij->i", self.x[at], q[by])
                best = _best(k, by, score, self.ids[at])
                yield own[by[best]], self.ids[at[best]], score[best]
            i = j


def _best(k: int, by: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places of the ``k`` largest scores of each run of equal ``by``, the smaller id first among equals."""
    begin = np.flatnonzero(np.r_[True, by[1:] != by[:-1]])
    size, left = np.diff(np.r_[begin, len(by)]), score.copy()
    for _ in range(k):  # the k largest different values, and so the k largest, are at or above the last of these
        kth = np.repeat(np.maximum.reduceat(left, begin), size)
        left[left == kth] = -np.inf
    some = np.flatnonzero(score >= kth)
    some = some[np.lexsort((ids[some], -score[some], by[some]))]
    begin = np.flatnonzero(np.r_[True, by[some][1:] != by[some][:-1]])
    return some[np.arange(len(some)) - np.repeat(begin, np.diff(np.r_[begin, len(some)])) < k]


def _searched(sent: DataFrame, k: int, item: str) -> DataFrame:
    """(query_id, vec_id, score): in every part the members come first, then its queries batch by batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, members = None, [], None
        for rows in batches:
            dims, slots, parts, kinds, ids = (_ints(rows.column(i)) for i in range(5))
            (rests, upto), (data, offs) = _bytes(rows.column(5)), _bytes(rows.column(6))
            new = np.r_[True, np.any([c[1:] != c[:-1] for c in (dims, slots, parts, kinds)], axis=0)]
            for a, b in zip(np.flatnonzero(new), np.r_[np.flatnonzero(new)[1:], len(ids)], strict=True):
                key = (dims[a], slots[a], parts[a])
                if key != now:
                    now, held, members = key, [], None
                x = unit(data[offs[a]:offs[b]].view(item).reshape(b - a, -1).astype(np.float64))
                rest, ends = rests[upto[a]:upto[b]].view(np.int32), (upto[a + 1:b + 1] - upto[a]) // 4
                if kinds[a] == 0:
                    held.append((ids[a:b], rest, x))
                    continue
                if held:
                    members, held = Part(*(np.concatenate(c) for c in zip(*held, strict=True))), []
                if members is not None:
                    for found in members.nearest(k, ids[a:b], rest, ends, x):
                        yield pa.RecordBatch.from_arrays([*map(pa.array, found)], names=["query_id", "vec_id", "score"])
        give_back()

    key = ["dim", "slot", "part"]
    return sent.repartition(*key).sortWithinPartitions(*key, "kind").mapInArrow(run, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, tables: int = 10, reach: float = 20.0, part: int = 2000,
            seed: int = 5) -> DataFrame:
    """``vectors`` (vec_id, embedding) -> query_id, rank, vec_id, score: the k nearest found of every query."""
    kind = vectors.schema["embedding"].dataType
    item = "<f4" if isinstance(getattr(kind, "elementType", None), FloatType) else "<f8"  # bytes as short as the values are
    rows = small_batches(vectors).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"),
                                         F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).withColumn("dim", F.size("embedding"))
    counts = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}  # one row per vector length
    buckets = {d: Buckets(n, d, tables, reach, part) for d, n in counts.items()}
    members = written(_members(rows, buckets, tables, seed, item), "axis-members")
    sizes = members.select("dim", "part", F.explode("slots").alias("slot")).groupBy("dim", "slot").agg(F.count("*").alias("n"), F.first("part").alias("part"))
    crowded = sizes.where("n > part").select("dim", "slot", F.ceil(F.col("n") / F.col("part")).alias("parts")).orderBy("dim", "slot").toPandas()  # few: a part's rows each
    crowded = {int(d): (g["slot"].to_numpy(), g["parts"].to_numpy()) for d, g in crowded.groupby("dim")}
    moved = sum(n * (d * np.dtype(item).itemsize + 40) for d, n in counts.items())
    step, found = int(max(1, min(tables, PASS_BYTES // max(1, moved)))), []
    for t in range(0, tables, step):
        sent = _sent(members, buckets, crowded, range(t, min(tables, t + step)), tables, seed, item)
        found.append(written(_ranked(_searched(sent, k, item), k), "axis-found"))
    if len(found) > 1:
        found = [written(_ranked(reduce(DataFrame.unionByName, found), k), "axis-found")]
    found = found[0]

    queries = members.where("asks")
    enough = found.groupBy("query_id").agg(F.count("*").alias("_n")).where(F.col("_n") >= k).select(F.col("query_id").alias("vec_id"))
    short = written(queries.select("dim", "blocks", "vec_id", "vector").join(enough, "vec_id", "left_anti"), "axis-short")
    if short.isEmpty():
        return found
    any_ = F.lit(bytearray(4)).alias("rests")  # one bucket that holds all
    block = F.pmod(F.xxhash64("vec_id"), "blocks").cast("int")
    all_ = members.select("dim", F.lit(-1).cast("long").alias("slot"), block.alias("part"), F.lit(0).alias("kind"), "vec_id", any_, "vector")
    to_all = short.select("dim", F.lit(-1).cast("long").alias("slot"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"),
                          F.lit(1).alias("kind"), "vec_id", any_, "vector")
    exact = _searched(all_.unionByName(to_all), k, item)
    again = short.select(F.col("vec_id").alias("query_id")).distinct()
    return found.join(again, "query_id", "left_anti").unionByName(_ranked(exact, k))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
