"""Token ids as raw binary shards with a minimal perfect hash index over the document keys.

Writing. Texts go to ranges of doc_id (and of the row, so an id of very many rows fills several ranges), are sorted
there, encoded one after another and written as shard files of about ``shard_ids`` ids: header, raw ids (2 bytes each
where the vocabulary allows, else 4, little endian), table of documents. A shard is one task's own file, committed by Spark's writer, so a lost executor or a
task that ran twice leaves no partial file and no second one.

Index. Keys (doc_id and number of the copy among equal ids) are dealt by hash into index files of about
``index_keys`` keys. Each is a cascade of bit arrays: a key that is alone at its hashed place of a level sets the
bit, the others go to the next level. The rank of a key's bit is its slot, so n keys have the slots 0 .. n - 1. A slot
holds a 32-bit fingerprint of the key, the shard, the offset in ids and the length. A look-up reads one bit per
level (two on average) and one slot: constant time, whatever the number of documents. A key that was never stored
passes for a stored one with a probability of 2**-32.

Files are written and read with Spark's ``text`` (one record a file, its bytes as they are) and ``binaryFile``
formats, so they can lie in any store that Spark reaches.

Defined cases: a null or empty text is the end id alone; rows with a null doc_id come last, are listed by scans and
have no key; repeated ids are stored one after another and keyed by their copy number; a document longer than a
shard is one shard of its own; an empty table writes no shard and gives no row; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import byte_bpe
from .common import small_batches, written
from .wordhash import mix

SHARD, INDEX = b"IDSHARD1", b"IDINDEX1"
#: magic, bytes an id, part, number in the part, documents, ids
SHARD_HEAD = "<8sIIIIQ"
#: magic, index file, index files, keys, levels
INDEX_HEAD = "<8sIIII"
SHARD_HEAD_SIZE, INDEX_HEAD_SIZE = struct.calcsize(SHARD_HEAD), struct.calcsize(INDEX_HEAD)
DOC = np.dtype([("doc_id", "<i8"), ("length", "<u4"), ("has_id", "<u4")])
SLOT = np.dtype([("print", "<u4"), ("shard", "<u4"), ("offset", "<u4"), ("length", "<u4")])
RECORDS = "part int, seq int, rec int, doc_id long, offset long, length long, ids_crc32 long, file string"


# ---- ids and shard files --------------------------------------------------------------------------------------------------

def vocabulary_size(tokenizer_path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path).get_vocab_size()


def shard_file(part: int, seq: int, width: int, docs: list[tuple[int, bool, bytes]]) -> bytes:
    table = np.array([(i, len(b) // width, has) for i, has, b in docs], dtype=DOC)
    payload = b"".join(b for _, _, b in docs)
    return struct.pack(SHARD_HEAD, SHARD, width, part, seq, len(docs), len(payload) // width) + payload + table.tobytes()


def shard_content(file: bytes) -> tuple[int, int, int, np.ndarray, np.ndarray]:
    """(part, number in the part, bytes an id, ids, table of documents) of a shard file."""
    magic, width, part, seq, n_docs, n_ids = struct.unpack_from(SHARD_HEAD, file)
    if magic != SHARD:
        raise ValueError("not a shard of ids")
    ids = np.frombuffer(file, f"<u{width}", n_ids, SHARD_HEAD_SIZE)
    return part, seq, width, ids, np.frombuffer(file, DOC, n_docs, SHARD_HEAD_SIZE + n_ids * width)


def _files(tokenizer_path: str, end_id: int, width: int, shard_ids: int):
    """Texts sorted by doc_id -> one row per shard file; a task holds one shard at a time."""
    end = np.array([end_id], dtype=f"<u{width}").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = byte_bpe.ids(tokenizer_path, width), TaskContext.get().partitionId()
        held: list[tuple[int, bool, bytes]] = []
        seq = n = 0

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([shard_file(part, seq, width, held)], pa.binary())], names=["file"])
            held.clear()
            return out

        for batch in batches:
            ids, has = (batch.column(i).to_pylist() for i in range(2))
            for i, h, text in zip(ids, has, batch.column(2), strict=True):
                made = tokens.of(text.as_py()) + end
                if held and n + len(made) // width > shard_ids:
                    yield flush()
                    seq, n = seq + 1, 0
                n += len(made) // width
                held.append((i, h, made))
        if held:
            yield flush()

    return run


def write_shards(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, shard_ids: int = 1 << 21, part_rows: int = 2048) -> None:
    """``docs`` (doc_id, text) as shard files in ``path``, in ascending order of doc_id; ranges of about ``part_rows`` rows."""
    width = 2 if max(vocabulary_size(tokenizer_path), end_id + 1) <= 1 << 16 else 4
    rows = small_batches(docs).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.col("doc_id").isNotNull().alias("has_id"),
        F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("has_id").desc(), "doc_id", "row"]
    sorted_ = rows.repartitionByRange(1 + docs.count() // part_rows, *order).sortWithinPartitions(*order)
    files = sorted_.select("doc_id", "has_id", "text").mapInArrow(_files(tokenizer_path, end_id, width, shard_ids), "file binary")
    files.select(F.col("file").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def records(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the shard files: where it is and the checksum of its ids (as 32-bit numbers), in order; a
    file's first document also names the file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, name in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                part, seq, _, ids, table = shard_content(memoryview(file.as_buffer()))
                raw = memoryview(ids.astype("<u4").tobytes())
                ends = np.cumsum(table["length"].astype(np.int64))
                begins = ends - table["length"]
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                n = len(table)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part), pa.int32()), pa.array(np.full(n, seq), pa.int32()), pa.array(np.arange(n), pa.int32()),
                     pa.array(table["doc_id"], pa.int64(), mask=table["has_id"] == 0), pa.array(begins, pa.int64()),
                     pa.array(table["length"].astype(np.int64)), pa.array(crc, pa.int64()), pa.array([name] + [None] * (n - 1), pa.string())],
                    names=["part", "seq", "rec", "doc_id", "offset", "length", "ids_crc32", "file"])

    return spark.read.format("binaryFile").load(path).select("content", "path").mapInArrow(run, RECORDS)


# ---- minimal perfect hash -------------------------------------------------------------------------------------------------

def key_hash(doc_id: np.ndarray, copy: np.ndarray) -> np.ndarray:
    return mix(mix(doc_id.astype(np.int64).view(np.uint64)) + copy.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _place(h: np.ndarray, level: int, size: int) -> np.ndarray:
    return mix(h + np.uint64((level + 1) * 0xD1B54A32D192ED03 % 2**64)) % np.uint64(size)


def index_file(number: int, of: int, h: np.ndarray, shard: np.ndarray, offset: np.ndarray, length: np.ndarray, room: float = 2.0) -> bytes:
    """The index of the keys with the (distinct) hashes ``h``."""
    slot, left, bits, before = np.zeros(len(h), np.int64), np.arange(len(h)), [], 0
    while len(left):
        size = max(64, -(-int(room * len(left)) // 64) * 64)
        place = _place(h[left], len(bits), size).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        own = alone[place]
        slot[left[own]] = before + (np.cumsum(alone) - 1)[place[own]]
        bits.append(np.packbits(alone, bitorder="little"))
        before += int(alone.sum())
        left = left[~own]
    slots = np.zeros(len(h), SLOT)
    for name, values in (("print", h >> np.uint64(32)), ("shard", shard), ("offset", offset), ("length", length)):
        slots[name][slot] = values
    sizes = np.array([8 * len(b) for b in bits], dtype="<u8")
    return struct.pack(INDEX_HEAD, INDEX, number, of, len(h), len(bits)) + sizes.tobytes() + b"".join(b.tobytes() for b in bits) + slots.tobytes()


class Index:
    """One index file: hashes of keys -> their slots."""

    def __init__(self, file: bytes):
        magic, self.number, self.of, n, levels = struct.unpack_from(INDEX_HEAD, file)
        if magic != INDEX:
            raise ValueError("not an index of ids")
        at = INDEX_HEAD_SIZE
        self.sizes = np.frombuffer(file, "<u8", levels, at).astype(np.int64)
        at += 8 * levels
        self.bits, self.ranks, before = [], [], 0
        for size in self.sizes.tolist():
            words = np.frombuffer(file, "<u8", size // 64, at)
            ones = np.bitwise_count(words).astype(np.int64)
            self.bits.append(words)
            self.ranks.append(before + np.cumsum(ones) - ones)  # bits set before each word
            before += int(ones.sum())
            at += size // 8
        self.slots = np.frombuffer(file, SLOT, n, at)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, slot) of each hash."""
        slot, open_ = np.full(len(h), -1, np.int64), np.arange(len(h))
        for level, size in enumerate(self.sizes.tolist()):
            place = _place(h[open_], level, size)
            word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            w = self.bits[level][word]
            hit = (w >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(w & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            slot[open_[hit]] = (self.ranks[level][word] + below)[hit]
            open_ = open_[~hit]
        ok = slot >= 0
        ok[ok] = self.slots["print"][slot[ok]] == (h[ok] >> np.uint64(32))
        return ok, slot


def _index_of(h: np.ndarray, of: int) -> np.ndarray:
    return (mix(h ^ np.uint64(0xA24BAED4963EE407)) % np.uint64(of)).astype(np.int32)


class Store:
    """Shards and index of a corpus under ``path``; ``Store.write`` makes one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        #: shard, part, seq, n_docs, n_ids, start, file: one row per shard file
        self.shards = spark.read.parquet(f"{self.path}/shards-table")
        #: number, of, file: one row per index file
        self.indexes = spark.read.parquet(f"{self.path}/index-table")

    @classmethod
    def write(cls, docs: DataFrame, path: str, tokenizer_path: str, end_id: int, shard_ids: int = 1 << 21, part_rows: int = 2048,
              index_keys: int = 1 << 18) -> Store:
        spark, path = docs.sparkSession, path.rstrip("/")
        write_shards(docs, f"{path}/shards", tokenizer_path, end_id, shard_ids, part_rows)
        found = written(records(spark, f"{path}/shards"), "id-records")
        cls._number_shards(spark, found, path)
        shards = spark.read.parquet(f"{path}/shards-table").select("part", "seq", "shard", F.col("start").alias("_start"))
        _copies(found).join(shards, ["part", "seq"]).select(
            "doc_id", "copy", "shard", "offset", "length", (F.col("_start") + F.col("offset")).alias("start"), "ids_crc32").write.parquet(f"{path}/records")
        keyed = spark.read.parquet(f"{path}/records").where("copy IS NOT NULL")
        of = 1 + keyed.count() // index_keys

        def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield pdf.assign(number=_index_of(key_hash(pdf["doc_id"].to_numpy(), pdf["copy"].to_numpy()), of))

        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            h = key_hash(pdf["doc_id"].to_numpy(), pdf["copy"].to_numpy())
            if len(np.unique(h)) < len(h):
                raise ValueError("two keys with one 64-bit hash")
            return pd.DataFrame({"file": [index_file(int(pdf["number"].iloc[0]), of, h, *(pdf[c].to_numpy() for c in ("shard", "offset", "length")))]})

        entries = keyed.select("doc_id", "copy", F.col("shard").cast("long").alias("shard"), "offset", "length")
        entries = entries.mapInPandas(numbered, "doc_id long, copy long, shard long, offset long, length long, number int")
        files = entries.groupBy("number").applyInPandas(build, "file binary")
        files.select(F.col("file").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(f"{path}/index")

        def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                found = [struct.unpack_from(INDEX_HEAD, c) for c in pdf["content"]]
                yield pd.DataFrame({"number": [x[1] for x in found], "of": [x[2] for x in found], "file": pdf["path"]})

        (spark.read.format("binaryFile").load(f"{path}/index").select("path", "content").mapInPandas(heads, "number int, of int, file string")
         .write.parquet(f"{path}/index-table"))
        return cls(spark, path)

    @staticmethod
    def _number_shards(spark: SparkSession, found: DataFrame, path: str) -> None:
        """The table of shards, numbered in the order of doc_id, with the ids of all shards before (one row a file)."""
        got = found.groupBy("part", "seq").agg(
            F.count("*").alias("n_docs"), F.sum("length").alias("n_ids"), F.max("file").alias("file"))
        order = Window.orderBy("part", "seq")  # one row per file of ``shard_ids`` ids
        got = got.withColumn("shard", F.row_number().over(order) - 1)
        got.withColumn("start", F.sum("n_ids").over(order) - F.col("n_ids")).write.parquet(f"{path}/shards-table")

    def records(self) -> DataFrame:
        """doc_id, copy (null without an id), shard, offset, length, start, ids_crc32, as a scan of the shards gave them."""
        return self.spark.read.parquet(f"{self.path}/records")

    def look_up(self, keys: DataFrame) -> DataFrame:
        """``keys`` (doc_id, copy) -> doc_id, copy, shard, offset, length by the index; nulls for keys that are not stored."""
        known = self.indexes.select("of").first()
        of = known["of"] if known else 1

        def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield pdf.assign(number=_index_of(key_hash(pdf["doc_id"].to_numpy(), pdf["copy"].to_numpy()), of))

        def find(asked: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
            out = asked[["doc_id", "copy"]].reset_index(drop=True)
            columns = {c: pd.array([None] * len(out), dtype="Int64") for c in ("shard", "offset", "length")}
            if len(index) and len(asked):
                index = Index(index["content"].iloc[0])
                ok, slot = index.find(key_hash(asked["doc_id"].to_numpy(), asked["copy"].to_numpy()))
                for c in columns:
                    columns[c][ok] = index.slots[c][slot[ok]].astype(np.int64)
            return out.assign(**columns)

        asked = keys.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("copy").cast("long").alias("copy"))
        asked = asked.mapInPandas(numbered, "doc_id long, copy long, number int")
        files = (self.spark.read.format("binaryFile").load(f"{self.path}/index").select(F.col("path").alias("file"), "content")
                 .join(self.indexes.select("number", "file"), "file"))
        return (asked.groupBy("number").cogroup(files.select("number", "content").groupBy("number"))
                .applyInPandas(find, "doc_id long, copy long, shard long, offset long, length long"))

    def get(self, doc_id: int, copy: int = 0) -> np.ndarray | None:
        """Ids of one document: one index file, one slot, one piece of one shard file."""
        h = key_hash(np.array([doc_id]), np.array([copy]))
        known = self.indexes.select("of").first()
        if known is None:
            return None
        name = self.indexes.where(F.col("number") == int(_index_of(h, known["of"])[0])).first()
        if name is None:
            return None
        ok, slot = (index := Index(self._bytes(name["file"]))).find(h)
        if not ok[0]:
            return None
        s = index.slots[slot[0]]
        file = self.shards.where(F.col("shard") == int(s["shard"])).first()["file"]
        content = self.spark.read.format("binaryFile").load(file)
        width = struct.unpack(SHARD_HEAD, bytes(content.select(F.substring("content", 1, SHARD_HEAD_SIZE)).first()[0]))[1]
        at = SHARD_HEAD_SIZE + int(s["offset"]) * width
        return np.frombuffer(bytes(content.select(F.substring("content", at + 1, int(s["length"]) * width)).first()[0]), f"<u{width}")

    def _bytes(self, file: str) -> bytes:
        return bytes(self.spark.read.format("binaryFile").load(file).first()["content"])


def _copies(rows: DataFrame) -> DataFrame:
    """Records with ``copy``: their number among records of the same id, in the order of the files (null without an id).
    A file's records of one id are numbered in the file; the window holds one row per id and file."""
    spans = rows.where("doc_id IS NOT NULL").groupBy("doc_id", "part", "seq").agg(F.count("*").alias("_n"), F.min("rec").alias("_first"))
    files = Window.partitionBy("doc_id").orderBy("part", "seq")
    spans = spans.withColumn("_before", F.sum("_n").over(files) - F.col("_n")).drop("_n")
    # rows without an id find no span
    return rows.join(spans, ["doc_id", "part", "seq"], "left").withColumn("copy", F.col("_before") + F.col("rec") - F.col("_first")).drop("_before", "_first")


def write_and_read_back(docs: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None, **kw) -> DataFrame:
    """Write ``docs`` as a store, then read every document back: those with an id by their key through the index (a
    key that is not found gives nulls), the others by a scan. doc_id, start, n_tokens, ids_crc32."""
    path = path or f"{ensure_checkpoint_dir(docs.sparkSession)}/ids-{uuid.uuid4().hex}"
    store = Store.write(docs, path, tokenizer_path, end_id, **kw)
    keys = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.count("*").alias("_n")).where("doc_id IS NOT NULL")
    found = store.look_up(keys.select("doc_id", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("copy")))
    at = store.records()
    by_key = found.join(at.drop("doc_id", "copy"), ["shard", "offset", "length"], "left").select("doc_id", "start", "length", "ids_crc32")
    out = by_key.unionByName(at.where("doc_id IS NULL").select("doc_id", "start", "length", "ids_crc32"))
    return out.select("doc_id", "start", F.col("length").alias("n_tokens"), "ids_crc32")
