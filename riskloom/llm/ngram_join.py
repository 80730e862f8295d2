"""Near duplicates by Jaccard similarity of word shingles: token-combination prefixes, then verification.

Tokens (distinct shingles of a document) are ordered by document frequency. Two sets with similarity t share
all but floor((1 - t) n) tokens of either one, so documents can be found through a prefix of that order:
rare tokens are indexed one by one, tokens of frequent classes only in combinations of k of a group, which
makes the prefix longer (a group may lose k - 1 tokens) and the lists short. Every pair above the threshold
shares an index entry; every pair found is verified on the full sets.

How it runs:
1. Texts become chunks of token arrays; every token goes to the block of its hash, packed, at 7 bytes.
2. A block counts document frequencies and sends back, to the token's chunk, only tokens of two or more texts.
   Tokens that several texts of a chunk share are counted there before, so a token of a third of all texts
   costs a block one entry per chunk.
3. A chunk drops texts that share too few tokens to have a partner, and builds prefixes and index entries of
   the others. Texts with equal sets form one class with a single key, so copies meet as one class.
4. Every index entry has a leader among its classes, the first in a random order. For each of a few orders a class
   is verified against two leaders of its entries at most (linear in the classes, however many entries they share);
   the components of these links settle nearly all entries. Classes that share an entry but are still in
   different components are then compared in blocks of whole sets (the largest component of a cluster only with
   the classes outside of it), so no link between components is lost and no row is made per candidate pair.

Limits of the arithmetic: tokens are 64-bit hashes (40 bits and the block number during the search and the
verification) and a class is known by the 64-bit sum of its mixed tokens.

Defined cases: null or empty texts and texts without words have no shingle and link with nothing; a text of
fewer than ``k`` words is one shingle; repeated rows are one class; a null doc_id is kept, with a null
component if its text links with nothing else that has an id; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, small_batches, written
from .components import components
from .wordhash import mix, shingles, text_buffer, text_slices, word_hashes

CHUNK_TOKENS = 1 << 18
CHUNK_TEXTS = 60_000  # texts of a chunk are numbered in 16 bits
REM_BITS = np.uint64(40)
REM = np.uint64((1 << 40) - 1)
#: Fixed frequency classes: tokens of up to this many documents are indexed alone, up to the next in pairs, others in threes.
CLASS_LIMITS = (16, 2048)
#: Random orders of the classes, by which leaders are chosen; they decide the work, not the result.
ORDERS = 2


def _pack(x: np.ndarray) -> bytes:
    """40-bit numbers, 5 bytes each."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpack(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(b, dtype=np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


# ---- 1: texts to chunks ---------------------------------------------------------------------------------------------------

CHUNKS = "k int, chunk long, kind int, block int, b1 binary, b2 binary, b3 binary, b4 binary, b5 binary"
_CHUNK_ARROW = pa.schema([("k", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("block", pa.int32())]
                         + [(f"b{i}", pa.binary()) for i in range(1, 6)])


def _chunk_rows(chunk: int, ids: np.ndarray, tok: np.ndarray, own: np.ndarray, bits: int) -> list[tuple]:
    """Rows of one chunk: kind 0 to its own reducer (texts, classes, sizes, tokens shared inside the chunk) and
    kind 1 to every block (tokens of one text with its number, shared tokens with their count)."""
    order = np.argsort(tok, kind="stable")
    tok, own = tok[order], own[order]
    new = np.ones(len(tok), dtype=bool)
    new[1:] = (tok[1:] != tok[:-1]) | (own[1:] != own[:-1])  # texts are in order within a token
    tok, own = tok[new], own[new]
    size = np.bincount(own, minlength=len(ids)).astype(np.int64)
    cls = np.zeros(len(ids), dtype=np.uint64)
    np.add.at(cls, own, mix(tok))
    cls = mix(cls + size.astype(np.uint64))
    _, first = np.unique(cls, return_index=True)
    rep = np.zeros(len(ids), dtype=bool)
    rep[first] = True
    keep = rep[own]
    t, own = tok[keep] >> np.uint64(64 - 40 - bits), own[keep]
    start = np.flatnonzero(np.r_[True, t[1:] != t[:-1]]) if len(t) else np.zeros(0, np.int64)
    count = np.diff(np.r_[start, len(t)])
    alone = count == 1
    single, single_own = t[start[alone]], own[start[alone]]
    shared, shared_n = t[start[~alone]], count[~alone]
    inner = np.repeat(~alone, count)
    rows = [(int(mix(np.array([chunk], np.uint64))[0] >> np.uint64(64 - bits)) if bits else 0, chunk, 0, -1, ids.astype("<i8").tobytes(),
             cls.tobytes(), size.astype("<i8").tobytes(), t[inner].tobytes(), own[inner].astype("<u2").tobytes())]
    edges = np.arange((1 << bits) + 1, dtype=np.uint64) << REM_BITS
    a, b = np.searchsorted(single, edges), np.searchsorted(shared, edges)
    for p in range(1 << bits):
        s, g = slice(a[p], a[p + 1]), slice(b[p], b[p + 1])
        if a[p] < a[p + 1] or b[p] < b[p + 1]:
            rows.append((p, chunk, 1, p, _pack(single[s] & REM), single_own[s].astype("<u2").tobytes(),
                         _pack(shared[g] & REM), shared_n[g].astype("<u4").tobytes(), None))
    return rows


def _arrow(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), _CHUNK_ARROW, strict=True)],
                                      schema=_CHUNK_ARROW)


def _to_chunks(k: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n_chunks = TaskContext.get().partitionId() << 24, 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        texts = tokens = 0

        def flush():
            nonlocal n_chunks, texts, tokens
            shift = np.cumsum([0] + [len(i) for i, _, _ in held])
            ids, tok = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            own = np.concatenate([h[2] + s for h, s in zip(held, shift, strict=False)])
            out = _arrow(_chunk_rows(base + n_chunks, ids, tok, own, bits))
            n_chunks, texts, tokens = n_chunks + 1, 0, 0
            held.clear()
            return out

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offs = text_buffer(batch.column(1))
            for a, b in text_slices(offs, 1 << 21):
                words, owner = word_hashes(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                for c in range(a, b, CHUNK_TEXTS // 2):  # a slice may hold very many empty texts
                    d = min(b, c + CHUNK_TEXTS // 2)
                    x, y = np.searchsorted(owner, [c - a, d - a])
                    tok, own = shingles(words[x:y], owner[x:y] - (c - a), d - c, k)
                    held.append((ids[c:d], tok, own))
                    texts, tokens = texts + d - c, tokens + len(tok)
                    if tokens >= CHUNK_TOKENS or texts >= CHUNK_TEXTS // 2:
                        yield flush()
        if held:
            yield flush()
        give_back()

    return run


# ---- 2: document frequencies ---------------------------------------------------------------------------------------------

def _count_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Frequencies in one block; back to each chunk go its tokens of two or more texts, with their counts."""
    own_rows = pdf[pdf["kind"] == 0]
    rows = pdf[pdf["kind"] == 1]
    out = [own_rows]
    if len(rows):
        single, shared = [_unpack(b) for b in rows["b1"]], [_unpack(b) for b in rows["b3"]]
        weight = [np.frombuffer(b, "<u4") for b in rows["b4"]]
        tokens = np.concatenate(single + shared)
        times = np.concatenate([np.ones(sum(map(len, single)), np.int64)] + [w.astype(np.int64) for w in weight])
        _, inv = np.unique(tokens, return_inverse=True)
        df = np.bincount(inv, weights=times).astype(np.int64)[inv]
        df = np.minimum(df, 2**32 - 1).astype("<u4")
        at, back = np.cumsum([0] + [len(x) for x in single + shared]), []
        for i, (chunk, block, numbers) in enumerate(zip(rows["chunk"], rows["block"], rows["b2"], strict=True)):
            d, g = df[at[i]:at[i + 1]], df[at[len(single) + i]:at[len(single) + i + 1]]
            hit = d >= 2
            if hit.any() or len(g):
                back.append((0, chunk, 1, block, _pack(single[i][hit]), np.frombuffer(numbers, "<u2")[hit].tobytes(),
                             d[hit].tobytes(), _pack(shared[i]), g.tobytes()))
        out.append(pd.DataFrame(back, columns=pdf.columns))
    give_back()
    return pd.concat(out, ignore_index=True)


# ---- 3: prefixes and index entries ---------------------------------------------------------------------------------------

def _needed(n: np.ndarray | int, percent: int):
    """Smallest overlap of a set of n tokens with any set at the threshold."""
    return -(-n * percent // 100)


def _bands(n: int, percent: int) -> list[int]:
    """Powers of two between which a set's size, and its largest partner's, lies."""
    return sorted({n.bit_length() - 1, (n * 100 // percent).bit_length() - 1})


def index_entries(tok: np.ndarray, df: np.ndarray, n: int, percent: int, limits: tuple[int, ...] = CLASS_LIMITS) -> np.ndarray:
    """Index entries of one set of ``n`` tokens from those with partners, ordered by (df, token).

    A class of tokens that is indexed in combinations of k is split into groups by the token's hash. A prefix
    holds enough tokens as soon as more of them would have to be missing than a partner may miss: a token
    counts unless it is one of the first k - 1 of its group."""
    need = n - _needed(n, percent) + 1 - (n - len(tok))  # tokens of one document are first in the order
    if need <= 0:
        return np.zeros(0, np.uint64)
    kind = np.searchsorted(np.asarray(limits), df, "left")
    out = []
    for band in _bands(n, percent):
        combine = kind if band >= 3 else np.zeros_like(kind)  # a set this small has no token to spare
        groups = np.array([1, max(1, (1 << band) // 8), max(1, (1 << band) // 16)])[combine]
        group = (mix(tok) % groups.astype(np.uint64)).astype(np.int64) + combine * (1 << 40)
        order = np.argsort(group, kind="stable")
        g = group[order]
        begin = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        nth = np.empty(len(tok), np.int64)
        nth[order] = np.arange(len(tok)) - np.repeat(begin, np.diff(np.r_[begin, len(tok)]))
        counted = np.cumsum((combine == 0) | (nth >= combine))
        m = int(np.searchsorted(counted, need)) + 1
        salt = np.uint64((band + 1) * 0x9E3779B97F4A7C15 % 2**64)
        single = combine[:m] == 0
        out.append(mix(tok[:m][single] + salt))
        for k in range(1, len(limits) + 1):
            for x in np.unique(group[:m][combine[:m] == k]):
                members = np.sort(tok[:m][group[:m] == x])
                if len(members) > k:
                    pick = np.array(list(combinations(range(len(members)), k + 1)))
                    total = np.zeros(len(pick), np.uint64)
                    for j in range(k + 1):
                        total += mix(members[pick[:, j]] + np.uint64(j))
                    out.append(mix(total ^ salt))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


SETS = "doc_id long, no_id boolean, cls long, n long, tokens binary, entries array<long>"


def _chunk_sets(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[pdf["kind"] == 0].iloc[0]
        ids, cls, size = np.frombuffer(own["b1"], "<i8"), np.frombuffer(own["b2"], "<u8"), np.frombuffer(own["b3"], "<i8")
        back = pdf[pdf["kind"] == 1]
        high = [np.uint64(p) << REM_BITS for p in back["block"]]
        tok = [_unpack(b) | h for b, h in zip(back["b1"], high, strict=True)]
        num = [np.frombuffer(b, "<u2").astype(np.int64) for b in back["b2"]]
        df = [np.frombuffer(b, "<u4") for b in back["b3"]]
        inner = [_unpack(b) | h for b, h in zip(back["b4"], high, strict=True)]
        inner_df = [np.frombuffer(b, "<u4") for b in back["b5"]]
        mine, mine_num = np.frombuffer(own["b4"], "<u8"), np.frombuffer(own["b5"], "<u2").astype(np.int64)
        if len(mine):
            known, known_df = np.concatenate(inner), np.concatenate(inner_df)
            order = np.argsort(known)
            tok.append(mine)
            num.append(mine_num)
            df.append(known_df[order][np.searchsorted(known[order], mine)])
        tokens = [None] * len(ids)
        entries = [None] * len(ids)
        if tok:
            tok, num, df = np.concatenate(tok), np.concatenate(num), np.concatenate(df)
            order = np.lexsort((tok, df, num))
            tok, num, df = tok[order], num[order], df[order]
            has = np.bincount(num, minlength=len(ids))
            end = np.cumsum(has)
            for i in np.flatnonzero((has >= _needed(size, percent)) & (size > 0)):
                s = slice(end[i] - has[i], end[i])
                e = index_entries(tok[s], df[s], int(size[i]), percent)
                if len(e):
                    tokens[i], entries[i] = np.sort(tok[s]).astype("<u8").tobytes(), e.view(np.int64)
        give_back()
        return pd.DataFrame({"doc_id": ids, "no_id": ids == NO_ID, "cls": cls.view(np.int64), "n": size, "tokens": tokens, "entries": entries})

    return run


#: Stands for a null doc_id inside the chunks.
NO_ID = -(2**63)


# ---- 4: verification and components --------------------------------------------------------------------------------------

def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets reach the threshold."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    sets = sets.join(asked, "cls")
    left = sets.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    right = sets.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))
    both = pairs.join(right, "b").join(left, "a").where(_close(percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            ok, last, left_set = [], None, None
            for a, b, m, n, x, y in zip(rows["a"], rows["b"], rows["n_a"], rows["n_b"], rows["t_a"], rows["t_b"], strict=True):
                if a != last:
                    last, left_set = a, np.frombuffer(x, "<u8")
                other = np.frombuffer(y, "<u8")
                at = np.searchsorted(left_set, other)
                at[at == len(left_set)] = 0
                common = int((left_set[at] == other).sum())
                if 100 * common >= percent * (m + n - common):
                    ok.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in ok], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return both.select("a", "b", "n_a", "n_b", "t_a", "t_b").mapInArrow(run, "a long, b long")


def _close(percent: int):
    return F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent


def _open_lists(lists: DataFrame, what: str) -> DataFrame:
    """The index lists (entry, cls, n, component) that still hold more than one component."""
    ends = lists.groupBy("entry").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi")).where("_lo < _hi")
    return written(lists.join(ends.select("entry"), "entry"), what)


def _labelled(lists: DataFrame, part: DataFrame) -> DataFrame:
    known = lists.drop("component").join(part.withColumnRenamed("node", "cls"), "cls", "left")
    return known.select("entry", "cls", "n", F.coalesce("component", "cls").alias("component"))


def _to_leaders(lists: DataFrame, percent: int, seed: int) -> DataFrame:
    """Pairs (a, b) of a class and a leader of one of its lists: the first and the last in the order of the leaders, so
    two rows a class at most. Lists led by the same class share that row."""
    order = F.xxhash64(F.lit(seed), "cls")
    lead = F.min(F.struct(order.alias("o"), F.col("cls").alias("c"), F.col("n").alias("m"), F.col("component").alias("g"))).alias("_x")
    near = lists.join(lists.groupBy("entry").agg(lead), "entry").where("component <> _x.g").withColumns({"n_a": F.col("n"), "n_b": F.col("_x.m")})
    ends = near.where(_close(percent)).groupBy("cls").agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"))
    pairs = ends.select("cls", F.explode(F.array("lo", "hi")).alias("_x"))
    return pairs.select(F.least("cls", "_x.c").alias("a"), F.greatest("cls", "_x.c").alias("b")).distinct()


def _between(lists: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the components of the open lists.

    Classes that share lists, directly or through others, form a cluster. In each cluster the largest component
    is left as it is; every class outside of it (x) is held against the classes it shares a list with (y). Both
    sides are dealt into blocks that grow with the root of their number, and a pair of blocks is compared as a
    whole: what is shuffled is whole sets, not pairs, and only links come out."""
    star = lists.join(lists.groupBy("entry").agg(F.min("cls").alias("_c")), "entry").select(F.col("_c").alias("a"), F.col("cls").alias("b"))
    cluster = components(star).withColumnRenamed("node", "cls").withColumnRenamed("component", "cluster")
    nodes = written(lists.select("cls", "component").distinct().join(cluster, "cls"), "shingle-nodes")
    sizes = nodes.groupBy("cluster", "component").agg(F.count("*").alias("_n"))
    main = sizes.groupBy("cluster").agg(F.max(F.struct("_n", "component")).alias("_main"), F.sum("_n").alias("_all"))

    def blocks(n, least: int):
        return F.ceil(n / F.greatest(F.lit(float(least)), 2 * F.sqrt(n))).cast("int")

    side = nodes.join(main, "cluster").select(
        "cls", "component", "cluster", (F.col("component") != F.col("_main.component")).alias("outer"),
        F.pmod(F.xxhash64("cls"), blocks(F.greatest(F.col("_all") - F.col("_main._n"), F.lit(1)), 32)).cast("int").alias("x"),
        blocks(F.col("_all"), 64).alias("_ny")).withColumn("y", F.pmod(F.xxhash64("cls", "cluster"), "_ny").cast("int"))
    side = written(side, "shingle-sides")
    asked = lists.select("entry", "cls").join(side.where("outer"), "cls").select("entry", "x").distinct()
    sent = lists.select("entry", "cls").join(asked, "entry").select("cls", "x").distinct()
    key = ["cluster", "x", "y"]
    theirs = sent.join(side.select("cls", "component", "cluster", "y"), "cls").join(classes, "cls")
    ours = side.where("outer").withColumn("y", F.explode(F.sequence(F.lit(0), F.col("_ny") - 1))).join(classes, "cls")
    columns = [*key, "cls", "component", "n", "tokens"]

    def run(_, ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        """The links that bring components of this block together: one fewer than its components at most."""
        found: list[tuple[int, int]] = []
        top: dict[int, int] = {}

        def root(g: int) -> int:
            while top.setdefault(g, g) != g:
                top[g] = g = top[top[g]]
            return g

        if len(ours) and len(theirs):
            sets = [np.frombuffer(t, "<u8") for t in ours["tokens"]]
            tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(t) for t in sets])
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], owner[order]
            size, group, cls = (ours[c].to_numpy() for c in ("n", "component", "cls"))
            for c, g, n, t in zip(theirs["cls"], theirs["component"], theirs["n"], theirs["tokens"], strict=True):
                t = np.frombuffer(t, "<u8")
                a, b = np.searchsorted(tokens, t), np.searchsorted(tokens, t, "right")
                hit = np.repeat(a - np.cumsum(np.r_[0, (b - a)[:-1]]), b - a) + np.arange((b - a).sum())
                common = np.bincount(owner[hit], minlength=len(sets))
                for i in np.flatnonzero((100 * common >= percent * (size + n - common)) & (group != g)):
                    a, b = root(int(group[i])), root(int(g))
                    if a != b:
                        top[a] = b
                        found.append((cls[i], c))
        return pd.DataFrame(found, columns=["a", "b"])

    return ours.select(*columns).toDF(*columns).groupBy(*key).cogroup(theirs.select(*columns).toDF(*columns).groupBy(*key)).applyInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` (doc_id, text) -> one row per document: doc_id, n_shingles, cls (equal sets have equal cls),
    component_id (smallest doc_id reachable by links of 100 * |A & B| >= percent * |A | B|)."""
    rows = small_batches(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text")
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    bits = min(24, max(7, int(size // (8 << 20)).bit_length()))  # about 8 MB of text per block, 128 at least
    chunks = rows.mapInArrow(_to_chunks(k, bits), CHUNKS)
    counted = chunks.groupBy("k").applyInPandas(_count_block, CHUNKS)
    sets = written(counted.groupBy("chunk").applyInPandas(_chunk_sets(percent), SETS), "shingle-sets")

    found = sets.where("tokens IS NOT NULL")
    classes = found.groupBy("cls").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    classes = written(classes, "shingle-classes")
    entries = found.select(F.explode("entries").alias("entry"), "cls", "n", F.col("cls").alias("component"))
    lists = _open_lists(entries, "shingle-lists")
    pairs = reduce(DataFrame.unionByName, [_to_leaders(lists, percent, seed) for seed in range(ORDERS)]).distinct()
    links = written(_verified(pairs, classes, percent), "shingle-links")
    lists = _open_lists(_labelled(lists, components(links)), "shingle-rest")
    part = components(links.unionByName(_between(lists, classes, percent)))

    members = sets.select(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "cls", "n")
    grouped = members.join(part.select(F.col("node").alias("cls"), "component"), "cls", "left").select(
        "doc_id", "cls", "n", F.when(F.col("n") > 0, F.coalesce("component", "cls")).alias("_group"))
    smallest = grouped.where("_group IS NOT NULL").groupBy("_group").agg(F.min("doc_id").alias("_least"))
    return grouped.join(smallest, "_group", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "cls",
        F.when(F.col("_group").isNull(), F.col("doc_id")).otherwise(F.col("_least")).alias("component_id"))


def one_of_each_group(docs: DataFrame, **kw) -> DataFrame:
    """The documents without near duplicates: of every group one row stays, that with the smallest doc_id (nulls
    last; among repeated ids the smallest hash); documents without words all stay. Rows are told apart by a
    64-bit hash of all their columns, not by doc_id: a null or repeated id takes no other row along. Rows equal
    in every column are one."""
    names = docs.columns
    # the hash skips nulls, so it also takes which columns are null
    keyed = docs.withColumn("_key", F.xxhash64(*names, *[F.col(c).isNull() for c in names]))
    found = near_duplicates(keyed.select(F.col("_key").alias("doc_id"), "text"), **kw).where("n_shingles > 0")
    found = found.groupBy(F.col("doc_id").alias("_key")).agg(F.min("component_id").alias("_group"), F.count("*").alias("_rows"))
    members = written(found.join(keyed.select("_key", "doc_id").distinct(), "_key"), "shingle-members")
    first = members.groupBy("_group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "_key")).alias("_first"))
    members = members.join(first, "_group").withColumn("_stays", F.col("_key") == F.col("_first._key"))
    kept = keyed.join(members.where("NOT _stays").select("_key"), "_key", "left_anti")
    repeated = members.where("_stays AND _rows > 1").select("_key")
    again = kept.join(repeated, "_key").dropDuplicates(["_key"]).select(*names)
    return kept.join(repeated, "_key", "left_anti").select(*names).unionByName(again)
