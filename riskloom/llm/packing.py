"""Best-fit packing with Martello-Toth dominance reduction.

Documents become token pieces of at most ``capacity`` tokens. Piece lengths are whole numbers up to the
capacity, so the instance is its histogram: at most ``capacity`` counts, whatever the number of pieces.
The histogram is reduced first: for the largest remaining length, a small set of lengths that provably
dominates every alternative (an exact complement, the largest partner when only one more piece fits, the
largest partner when no pair fills more) is fixed for as many sequences as the counts allow. What remains
is packed best-fit, again by counts. The plan (runs of equal sequences) is bounded by the capacity and is
joined back to the pieces by their length and rank, so all pieces are placed in parallel.

Defined cases: null or empty text is one piece holding the end id alone; a null doc_id is kept; repeated rows
are packed one by one; a document longer than the capacity is cut into full pieces, its first piece being
the shorter one; an empty table gives no row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, small_batches, written

#: Blank, controls and separators that the vocabulary's split pattern takes as white space.
_WS = "\t-\r \x85\xa0  -     　"
#: The vocabulary's added token, which is one id wherever a text holds it, and never part of a unit.
ADDED, ADDED_ID = "<|endoftext|>", 50256
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class TokenBytes(dict):
    """Text unit -> its ids as little-endian unsigned 32-bit bytes. A unit is a run without white space and
    the blank before it, or the white space left over: the vocabulary's split pattern never joins two units,
    so the units' ids in order are the text's ids. At most ``most`` units are remembered."""

    def __init__(self, tokenizer_path: str, most: int = 300_000):
        import re

        self.unit, self.most = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"), most
        if tokenizer_path.endswith(".tiktoken"):  # the vocabulary as ranks
            import base64

            import public_tokenizers
            import tiktoken

            with open(tokenizer_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
            self.encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                            special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(tokenizer_path)
            t.encode_special_tokens = True
            self.encode = lambda unit: t.encode(unit, add_special_tokens=False).ids

    def __missing__(self, unit: str) -> bytes:
        ids = np.array(self.encode(unit), dtype="<u4").tobytes()
        if len(self) < self.most:
            self[unit] = ids
        return ids

    def of(self, text: str) -> bytes:
        """Ids of a text that is all plain text."""
        return b"".join(map(self.__getitem__, self.unit.findall(text)))

    def ids(self, text: str) -> bytes:
        """Ids of a text that may hold the added token."""
        return np.array([ADDED_ID], dtype="<u4").tobytes().join(map(self.of, text.split(ADDED)))


def cut(n: int, capacity: int) -> list[int]:
    """Piece lengths of a document of ``n`` ids: full ones, preceded by what is left over."""
    first = n % capacity
    return ([first] if first else []) + [capacity] * (n // capacity)


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = TokenBytes(tokenizer_path)
        for pdf in batches:
            out = []
            for i, text in zip(pdf["_id"], pdf["text"], strict=True):
                ids, at = tokens.ids(text) + end, 0
                for k, n in enumerate(cut(len(ids) // 4, capacity)):
                    out.append((i, k, at, n, zlib.crc32(ids[4 * at:4 * (at + n)])))
                    at += n
            yield pd.DataFrame(out, columns=["_id", "piece", "start", "length", "ids_crc32"])
        del tokens
        give_back()

    rows = small_batches(docs).select(F.col("doc_id").cast("string").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    return (rows.mapInPandas(run, PIECES.replace("doc_id long", "_id string"))
            .select(F.col("_id").cast("long").alias("doc_id"), "piece", "start", "length", "ids_crc32"))


# ---- the plan: runs of equal sequences, from the histogram of lengths ---------------------------------------------------

Run = tuple[int, list[int]]  # how many sequences, the lengths in each


def _largest(count: np.ndarray, most: int) -> int:
    """Largest length up to ``most`` that is left (0: none)."""
    left = np.flatnonzero(count[1:most + 1])
    return int(left[-1]) + 1 if len(left) else 0


def _best_pair(count: np.ndarray, room: int) -> int:
    """Largest sum up to ``room`` of two pieces that are left (0: no two fit together)."""
    best, sizes = 0, np.flatnonzero(count[:room])
    low, high = 0, len(sizes) - 1
    while low <= high:
        a, b = int(sizes[low]), int(sizes[high])
        if low == high and count[a] < 2:
            break
        if a + b > room:
            high -= 1
        else:
            best, low = max(best, a + b), low + 1
    return best


def reduce_dominated(count: np.ndarray, capacity: int) -> tuple[list[Run], np.ndarray]:
    """Fix the sets that dominate every other set holding the same largest piece; (fixed runs, counts left).

    For a piece s with room r = capacity - s and k the largest other piece that fits: nothing fits -> {s};
    k = r -> {s, k}; the two smallest pieces exceed r -> {s, k}; the three smallest exceed r and no pair
    sums to more than k -> {s, k}. Each replaces any feasible set holding s without needing more sequences."""
    count, runs = count.copy(), []
    for s in range(capacity, 0, -1):
        while count[s]:
            count[s] -= 1
            room = capacity - s
            k = _largest(count, room) if room else 0
            count[s] += 1
            if not k:
                times = 1 if 2 * s <= capacity else int(count[s])
                runs.append((times, [s]))
                count[s] -= times
                continue
            fixed = k == room
            if not fixed:
                count[s] -= 1
                small = np.flatnonzero(count)[:3]
                least = [int(x) for x in np.repeat(small, np.minimum(count[small], 3))[:3]]
                fixed = sum(least[:2]) > room or (sum(least) > room and _best_pair(count, room) <= k)
                count[s] += 1
            if not fixed:
                break
            times = int(min(count[s], count[k])) if s != k else int(count[s]) // 2
            if k != room:  # the test holds as long as both lengths are there: one sequence short of using either up
                times = max(1, times)
            runs.append((times, [s, k]))
            count[s] -= times
            count[k] -= times
    return runs, count


def best_fit(count: np.ndarray, capacity: int) -> list[Run]:
    """Best-fit decreasing by counts: every piece goes to the fullest open sequence it fits. Sequences with
    equal contents are one run, so a length is placed in a few steps whatever its count."""
    count, by_room = count.copy(), {}  # room -> runs [times, lengths]
    for s in range(capacity, 0, -1):
        left = int(count[s])
        while left:
            room = min((r for r in by_room if r >= s), default=None)
            if room is None:
                room = capacity
                by_room.setdefault(room, []).append([-(-left // (capacity // s)), []])
            times, lengths = by_room[room].pop()
            each = min(room // s, left)  # once it holds one, the fullest takes the next of the same length too
            use = min(times, left // each)
            if use < times:
                by_room[room].append([times - use, lengths])
            if not by_room[room]:
                del by_room[room]
            by_room.setdefault(room - each * s, []).append([use, lengths + [s] * each])
            left -= use * each
    return [(t, x) for runs in by_room.values() for t, x in runs if x]


def plan(count: np.ndarray, capacity: int) -> list[Run]:
    fixed, rest = reduce_dominated(count, capacity)
    return fixed + best_fit(rest, capacity)


def slots(runs: list[Run]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, offset, each): the pieces of a length with a rank in
    [first, last] go, ``each`` to a sequence, one after the other, to the sequences from the first on."""
    used: dict[int, int] = {}
    out, seq = [], 0
    for times, lengths in runs:
        at = 0
        for s, same in groupby(lengths):
            each, first = len(list(same)), used.get(s, 0)
            used[s] = first + times * each
            out.append((s, first, used[s] - 1, seq, at, each))
            at += s * each
        seq += times
    return out


def rank_within_length(rows: DataFrame, per_task: int = 20_000) -> DataFrame:
    """Add ``rank`` (0, 1, ... within a length). Every length is split into salted parts, ranked part by part
    and shifted by the counts of the parts before, so a common length is no single task."""
    parts = max(64, -(-rows.count() // per_task))
    salted = rows.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = salted.groupBy("length", "_part").agg(F.count("*").alias("_n")).select(
        "length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    own = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32")
    return (salted.withColumn("_r", F.row_number().over(own) - 1).join(shift, ["length", "_part"])
            .withColumn("rank", F.col("_r") + F.col("_shift")).drop("_r", "_shift", "_part"))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of ``docs``."""
    spark = docs.sparkSession
    cut_up = written(pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    count = np.zeros(capacity + 1, dtype=np.int64)
    for r in cut_up.groupBy("length").count().collect():  # at most ``capacity`` rows
        count[r["length"]] = r["count"]
    table = slots(plan(count, capacity))
    placed = pd.DataFrame(table or [(0, 0, 0, 0, 0, 1)], columns=["length", "_first", "_last", "_seq", "_at", "_each"]).astype("int64")
    where = F.broadcast(spark.createDataFrame(placed))  # a few rows per length: bounded by the capacity
    ranked = rank_within_length(cut_up)
    at = (ranked["length"] == where["length"]) & (ranked["rank"] >= where["_first"]) & (ranked["rank"] <= where["_last"])
    nth = F.col("rank") - F.col("_first")
    return ranked.join(where, at).select(
        "doc_id", "piece", "start", ranked["length"], "ids_crc32",
        (F.col("_seq") + F.floor(nth / F.col("_each"))).alias("sequence_id"),
        (F.col("_at") + nth % F.col("_each") * ranked["length"]).alias("offset"))
