"""Hard negatives, id shards and whitening against brute force, and on awkward input."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm import byte_bpe
from riskloom.llm import hard_negatives as hn
from riskloom.llm import id_shards as ids
from riskloom.llm import queries as Q
from riskloom.llm import whitening as wh

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
VECTORS = "vec_id long, vector array<long>, label int, row string"


# ---- hard negatives -------------------------------------------------------------------------------------------------------

def brute_negatives(rows, every, k=5):
    """rows: (vec_id, vector, label); a null id counts as the largest."""
    rows = [(float("inf") if i is None else i, v, c) for i, v, c in rows if c is not None and v is not None and None not in v]
    out = []
    for at, (a, va, ca) in enumerate(rows):
        if a == float("inf") or a % every:
            continue
        scored = [(-sum(p * q for p, q in zip(va, v, strict=True)), i, j, c) for j, (i, v, c) in enumerate(rows) if j != at and len(v) == len(va)]
        for neg, i, _, _ in sorted(s for s in scored if s[3] == ca)[:k]:
            p = -neg
            near = sorted(s for s in scored if s[3] != ca and 80 * p <= -100 * s[0] <= 100 * p)[:k]
            out += [(a, i, r + 1, n[1], p, -n[0]) for r, n in enumerate(near)]
    return sorted(out)


def mined(df, every, **kw):
    out = hn.mine(df, F.col("vec_id") % every == 0, **kw).collect()
    return sorted((r.anchor_id, float("inf") if r.positive_id is None else r.positive_id, r.rank,
                   float("inf") if r.negative_id is None else r.negative_id, r.positive_score, r.negative_score) for r in out)


@pytest.mark.parametrize("spread", [3, 40, 10**6])
def test_hard_negatives_equal_brute_force(spark, spread):
    """Small whole numbers give many ties; groups of near copies give windows without negatives."""
    rng = np.random.default_rng(spread)
    heart = rng.integers(-spread, spread + 1, (6, 12))
    rows = []
    for i in range(400):
        v = heart[i % 6] + rng.integers(-1, 2, 12) if i % 3 else rng.integers(-spread, spread + 1, 12)
        rows.append((i, v.tolist(), int(rng.integers(0, 3))))
    df = spark.createDataFrame([(*r, "other") for r in rows], VECTORS).repartition(5)
    want = brute_negatives(rows, 9)
    assert want and mined(df, 9) == want
    assert mined(df, 9, block=37, group=5, sample=20) == want  # many blocks, a poor estimate


def test_hard_negatives_of_awkward_rows(spark):
    rows = [(0, [5, 5], 1), (0, [5, 5], 1), (0, [4, 4], 2), (2, [5, 5], 1), (4, [4, 5], 2), (4, [4, 5], 2), (None, [4, 5], 2), (None, [5, 5], 1),
            (6, [5, 5], None), (8, None, 1), (10, [5, None], 1), (12, [0, 0], 1), (14, [0, 0], 2), (16, [], 1), (18, [], 2), (20, [], 1),
            (22, [-5, -5], 3), (24, [1, 2, 3], 1), (26, [1, 2, 3], 1), (28, [1, 2, 3], 2), (30, [9], 7)]
    df = spark.createDataFrame([(*r, "x") for r in rows], VECTORS)
    assert mined(df, 2) == brute_negatives(rows, 2)
    assert mined(df.where("false"), 2) == []
    assert mined(df.where("vec_id = 30"), 2) == []


def test_hard_negatives_beyond_doubles(spark):
    big = 3 * 10**8
    rows = [(0, [big, 1], 1), (1, [big, 2], 1), (2, [big, 0], 2), (3, [big - 1, 5], 2), (4, [big, 3], 2)]
    assert mined(spark.createDataFrame([(*r, "x") for r in rows], VECTORS), 2) == brute_negatives(rows, 2)


def test_a_threshold_leaves_dimensions_out():
    rng = np.random.default_rng(0)
    x = rng.integers(-50, 50, (500, 16))
    order = np.argsort((x ** 2).sum(axis=0))
    a = x[:3][:, order].astype(float)
    least = np.array([20000.0, 21000.0, 22000.0])
    floor = float((least / np.sqrt((a ** 2).sum(axis=1))).min())
    index = hn.Index(x, order, floor)
    assert index.out.min() > 0 and index.lists[0] == 0 and (np.diff(index.lists) >= 0).all()
    found = set(zip(*(z.tolist() for z in index.search(a, least)), strict=True))
    true = {(i, j) for i in range(3) for j in range(500) if x[i] @ x[j] >= least[i]}
    assert true <= found and len(found) < 100


# ---- id shards ------------------------------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, offset string, part int"


def written_ids(rows):
    """Plain version: (doc_id, start, n, crc) in the order of doc_id, null ids last."""
    t, out, n = Tokenizer.from_file(BPE), [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        x = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        out.append((i, n, len(x), zlib.crc32(x.tobytes())))
        n += len(x)
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[1:])


def test_ids_of_the_table_equal_the_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in Q.QUERIES["op12_id_shards"](spark, SF).collect()]
    assert sorted(got, key=key) == written_ids(rows)


def test_ids_in_many_small_shards(spark, tmp_dir):
    """Nulls, empty and very long texts, ids out of order over many parts, shards and index files."""
    rng = np.random.default_rng(1)
    rows = [(int(i), "word %d\n" % i * int(rng.integers(0, 40))) for i in rng.permutation(300) - 100]
    rows += [(500, None), (501, ""), (502, "long text \x00ü\n" * 20000), (2**62, "a <|endoftext|> b"), (-2**63, "least")]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], DOCS).repartition(6)
    path = os.path.join(tmp_dir, "store")
    got = ids.write_and_read_back(df, BPE, 2, path=path, shard_ids=2000, part_rows=10, index_keys=20)
    assert sorted((tuple(r) for r in got.collect()), key=key) == written_ids(rows)
    store = ids.Store(spark, path)
    assert store.shards.count() > 20 and store.indexes.count() > 5
    t = Tokenizer.from_file(BPE)
    for i, text in (rows[0], rows[17], rows[-1], (501, "")):
        assert store.get(i).tolist() == t.encode(text, add_special_tokens=False).ids + [2]
    assert store.get(10**9) is None and store.get(501, 1) is None


def test_ids_of_repeated_and_null_keys(spark, tmp_dir):
    """A third of all rows with one id, another third without: the same documents, one after another."""
    rows = [(7, f"hot {i % 5}") for i in range(200)] + [(None, f"none {i % 3}") for i in range(200)] + [(i, f"doc {i}") for i in range(200)]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], DOCS).repartition(5)
    path = os.path.join(tmp_dir, "store")
    got = [tuple(r) for r in ids.write_and_read_back(df, BPE, 2, path=path, shard_ids=50, part_rows=30, index_keys=64).collect()]
    want = written_ids(rows)
    assert sorted(((r[0], *r[2:]) for r in got), key=key) == sorted(((r[0], *r[2:]) for r in want), key=key)
    run = sorted(got, key=lambda r: r[1])
    assert [r[0] for r in run] == [r[0] for r in want]
    assert [r[1] for r in run] == np.cumsum([0] + [r[2] for r in run])[:-1].tolist()
    store = ids.Store(spark, path)
    parts = {r.part for r in store.records().where("doc_id = 7").join(store.shards, "shard").collect()}
    assert store.look_up(spark.createDataFrame([(7, 200), (7, 201), (-5, 0)], "doc_id long, copy long")).where("shard IS NULL").count() == 2
    assert len(parts) > 3  # one id is no single task


def test_ids_of_an_empty_table(spark, tmp_dir):
    df = spark.createDataFrame([], DOCS)
    path = os.path.join(tmp_dir, "store")
    assert ids.write_and_read_back(df, BPE, 2, path=path).collect() == []
    assert ids.Store(spark, path).get(1) is None


@pytest.mark.parametrize("text", ["", " ", "a  b\n\n c\t\u00a0d\u3000 e", "don't we'll I'M 12 ab12cd ...!?", "x <|endoftext|><|endoftext|>y <|endoftext", "naïve \x00 \U0001f600é ñ" * 50,
                                  "-" * 70000, "深い学び 文字 \u200b\ufeff \x85 \x1f\x1c", " \n" * 3000 + "end "])
def test_units_of_one_text(text):
    for most in (300_000, 3):  # 3: hardly anything is remembered
        tokens = byte_bpe.Ids(BPE, 2, most)
        assert tokens.byte_level
        for _ in range(2):
            assert np.frombuffer(tokens.of(text), "<u2").tolist() == Tokenizer.from_file(BPE).encode(text, add_special_tokens=False).ids


class Counted(byte_bpe.Ids):
    """Counts the units that are not remembered."""

    asked = 0

    def __missing__(self, unit):
        self.asked += 1
        return super().__missing__(unit)


def test_units_that_repeat_stay_remembered_beside_many_that_do_not():
    def letters(n):
        return "".join("abcdefghij"[int(x)] for x in str(n))

    tokens, model = Counted(BPE, 2, 400), Tokenizer.from_file(BPE)
    often = "".join(f" q{letters(i)}" for i in range(300))
    tokens.of(often)
    for k in range(5):
        before, rare = tokens.asked, "".join(f" z{letters(1000 * (k + 1) + i)}" for i in range(300))
        text = rare + often
        assert np.frombuffer(tokens.of(text), "<u2").tolist() == model.encode(text, add_special_tokens=False).ids
        assert tokens.asked - before == 300  # the rare ones alone
        assert len(tokens) <= 400


def test_remembered_units_follow_texts_that_change():
    tokens = Counted(BPE, 2, 10, renew=50)
    first, second = (" ".join(f"{x}{y}" for x in s for y in "abcdefghij") for s in ("q", "z"))
    tokens.of(first)
    for _ in range(6):
        tokens.of(second)
    before = tokens.asked
    tokens.of(second)
    assert tokens.asked == before


@pytest.mark.parametrize("text", ["word, word. word-word word's it'll ab12 word_word 'tis", "e\u0301te\u0301 caf\u00e9, na\u00efve\u0301 \u00e9\u6587x x\u00b2 a\u00aab \u00d7a a\u00f7 \u00ff\u0100",
                                  "a\u0300, \u0141\u00f3d\u017a. x\u00a0y don\u2019t don't,can't", "ABC<|endoftext|>abc<|endoftext|>, z",
                                  "a   b     c  ", "  ", "   x  <|endoftext|>   "])
def test_units_end_behind_letters(text):
    got = np.frombuffer(byte_bpe.Ids(BPE, 2).of(text), "<u2").tolist()
    assert got == Tokenizer.from_file(BPE).encode(text, add_special_tokens=False).ids


def test_other_tokenizers_take_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokens = byte_bpe.Ids(path, 4)
    assert not tokens.byte_level
    assert np.frombuffer(tokens.of("Some  Words"), "<u4").tolist() == Tokenizer.from_file(path).encode("Some  Words", add_special_tokens=False).ids


def test_a_word_of_the_vocabulary_is_one_id():
    t = Tokenizer.from_file(BPE)
    assert all([x.id for x in t.model.tokenize(w)] == [i] for w, i in t.get_vocab().items() if w != "<|endoftext|>")


@pytest.mark.parametrize("n", [0, 1, 2, 100, 20000])
def test_index_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    doc, copy = rng.permutation(np.arange(n) * 3 - 50), rng.integers(0, 3, n)
    h = ids.key_hash(doc, copy)
    file = ids.index_file(3, 8, h, np.arange(n), np.arange(n) * 2, np.arange(n) + 1)
    index = ids.Index(file)
    ok, slot = index.find(h)
    assert ok.all() and sorted(slot.tolist()) == list(range(n))
    assert (index.slots["shard"][slot] == np.arange(n)).all() and (index.slots["length"][slot] == np.arange(n) + 1).all()
    ok, _ = index.find(ids.key_hash(np.arange(10**6, 10**6 + 20000), np.zeros(20000)))
    assert not ok.any()
    assert len(file) <= 200 + 17 * n  # 16 bytes a slot and a few bits a key


# ---- whitening ------------------------------------------------------------------------------------------------------------

EMBEDDINGS = "vec_id long, embedding array<float>, component string"


def check_whitened(rows, got, k=8):
    """Against numpy's own solver: every contract column."""
    x = np.array([np.floor(1024 * np.asarray(v, np.float64)).astype(np.int64) + 100000 for _, v in rows])
    n, sums = len(x), x.sum(axis=0)
    c = x - sums / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    rank = int((values > values.sum() * 1e-12).sum())
    width = min(k, rank)
    assert sorted(got["component"].unique()) == list(range(1, width + 1))
    assert len(got) == len(rows) * width and (got["n"] == n).all()
    w = got.sort_values(["vec_id", "component"])
    order = np.argsort([i for i, _ in rows])
    assert w["deviation"].astype("int64").tolist() == np.repeat(((n * x - sums) ** 2).sum(axis=1)[order], width).tolist()
    y = w["whitened"].to_numpy().reshape(-1, width)
    want = (c @ vectors[:, :width] / np.sqrt(values[:width]))[order]
    sign = np.sign((y * want).sum(axis=0))
    assert np.abs(y * sign - want).max() < 1e-8
    np.testing.assert_allclose(w["explained"].to_numpy()[:width], values[:width] / values.sum(), rtol=1e-9)
    assert w["identity_error"].nunique() == 1 and w["identity_error"].iloc[0] < 1e-9


def test_whitening_of_the_table(spark):
    got = Q.QUERIES["op13_whitening"](spark, SF).toPandas()
    assert got["deviation"].dtype == np.int64
    check_whitened([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()], got)


@pytest.mark.parametrize("dim,n", [(1, 7), (2, 9), (3, 40), (12, 5)])
def test_whitening_of_small_tables(spark, dim, n):
    rng = np.random.default_rng(dim)
    rows = [(i, rng.standard_normal(dim).astype(np.float32).tolist()) for i in range(n)]
    df = spark.createDataFrame([(*r, "x") for r in rows], EMBEDDINGS).repartition(4)
    check_whitened(rows, wh.whiten(df).toPandas())


def test_whitening_of_awkward_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, (rng.standard_normal(4) * [3, 1, 1, 0]).astype(np.float32).tolist()) for i in range(30)]
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0, 3.0]), (93, [1.0, float("nan"), 2.0, 3.0]), (94, [float("inf"), 1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(*r, "x") for r in good + bad], EMBEDDINGS)
    check_whitened(good, wh.whiten(df).toPandas())
    assert wh.whiten(df.where("false")).collect() == []
    assert wh.whiten(df.where("vec_id = 1")).collect() == []  # one vector has no direction
    same = spark.createDataFrame([(i, [1.0, 2.0], "x") for i in range(5)], EMBEDDINGS)
    assert wh.whiten(same).collect() == []
    two = spark.createDataFrame([(i, [float(i)] * (1 + i % 2), "x") for i in range(8)] + [(None, [3.0], "x"), (None, [3.0], "x")], EMBEDDINGS)
    got = wh.whiten(two).toPandas()
    assert sorted(got.groupby("n").size().items()) == [(4, 4), (6, 6)] and got["vec_id"].isna().sum() == 2


def test_deviation_beyond_a_long(spark):
    rows = [(0, [1e9, 0.0]), (1, [-1e9, 0.0]), (2, [0.0, 1.0])]
    got = {r.vec_id: int(r.deviation) for r in wh.whiten(spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, component string")).collect()}
    x = [[1024 * int(c) + 100000 for c in v] for _, v in rows]
    s = [sum(c) for c in zip(*x, strict=True)]
    assert got == {i: sum((3 * c - t) ** 2 for c, t in zip(v, s, strict=True)) for i, v in enumerate(x)}


@pytest.mark.parametrize("kind", ["random", "equal", "clusters", "zero", "graded"])
@pytest.mark.parametrize("n", [1, 2, 3, 8, 64])
def test_eigensolver(kind, n):
    rng = np.random.default_rng(n)
    q = np.linalg.qr(rng.standard_normal((n, n)))[0]
    values = {"random": rng.standard_normal(n) ** 2, "equal": np.full(n, 3.0), "zero": np.zeros(n), "graded": 10.0 ** -np.arange(n),
              "clusters": np.repeat([5.0, 1.0], [n // 2, n - n // 2]) + 1e-9 * rng.standard_normal(n)}[kind]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    got, x = wh.leading_eigen(a, 8)
    size = max(values.max(), 1e-300)
    assert np.abs(got - np.sort(values)[::-1][:8]).max() <= 1e-13 * size
    assert np.abs(a @ x - x * got).max() <= 1e-13 * size
    assert np.abs(x.T @ x - np.eye(x.shape[1])).max() < 1e-12
