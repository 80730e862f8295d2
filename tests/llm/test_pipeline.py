"""Every stage on what the stage before kept, and planted cases."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from test_llm import WORD, brute_components, plain_base
from tokenizers import Tokenizer

import corpus_pipeline
from riskloom.llm import packing, secret_grammar, toxicity
from riskloom.llm.common import table, written

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    names, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == names
        sizes.append(docs.count())
        if name in ("toxicity", "ngram_join"):
            assert docs.join(before, names, "left_semi").count() == docs.count()
        if name == "secret_grammar":
            assert docs.count() == before.count() and docs.where(F.col("text").rlike("AKIA[A-Z0-9]{14,}")).count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.where("piece = 0").count() == docs.count()
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3]


def test_run_equals_plain_versions_of_its_stages(spark):
    """``run()`` against plain Python: groups by brute force, redaction by the base patterns, ids by the tokenizer."""
    d = pq.read_table(f"{SF}/documents.parquet").to_pandas()
    scored = toxicity.scored(table(spark, SF, "documents"), table(spark, SF, "labels")).toPandas().set_index("doc_id")
    clean = d[[scored.predicted[i] == 0 for i in d.doc_id]]
    groups = brute_components(clean.text, clean.doc_id)
    single = clean[[not groups[i][0] or groups[i][1] == i for i in clean.doc_id]]

    kept = spark.createDataFrame(single)
    spans = {r["doc_id"]: r["spans"] for r in secret_grammar.find_secrets(kept).collect()}
    texts = {}
    for i, text in zip(single.doc_id, single.text, strict=True):
        assert set(plain_base(text).split(",")) <= set(spans[i].split(","))
        out, at = "", 0
        for s, e in sorted(tuple(map(int, x.split(":")[1:])) for x in spans[i].split(",") if x):
            if s >= at:
                out += text[at:s] + "[SECRET]"
            at = max(at, e)
        texts[i] = out + text[at:]

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = corpus_pipeline.run(spark, SF).toPandas()
    copies = got[got.piece == 0].groupby("doc_id").size().to_dict()
    assert set(copies) <= set(texts)
    words = {i: len(WORD.findall(x)) for i, x in texts.items()}
    source = dict(zip(single.doc_id, single.source, strict=True))
    per = {}
    for i in texts:
        per.setdefault(source[i], [0, 0])[0] += words[i]
        per[source[i]][1] += copies.get(i, 0) * words[i]
        assert copies.get(i, 0) <= 3
    # targets: weights 5, 2, 1 over the sources by code point, capped at three times the size
    order, total = sorted(per), sum(v[0] for v in per.values())
    weight, open_, target = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, set(order), {}
    while True:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * per[s][0]}
        if not over:
            target.update(share)
            break
        target.update({s: 3 * per[s][0] for s in over})
        open_ -= over
    assert all(abs(per[s][1] - target[s]) <= max(words.values()) for s in per)

    want = Counter()
    for i, n in copies.items():
        ids = np.array(t.encode(texts[i], add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for k, size in enumerate(packing.cut(len(ids), 2048)):
            want[(i, k, at, size, zlib.crc32(ids[at:at + size].tobytes()))] += n
            at += size
    assert Counter(map(tuple, got[["doc_id", "piece", "start", "length", "ids_crc32"]].to_numpy().tolist())) == want
    seq = got.sort_values(["sequence_id", "offset"])
    assert (seq.groupby("sequence_id").length.cumsum() - seq.length == seq.offset).all() and seq.groupby("sequence_id").length.sum().max() <= 2048


def test_stages_on_null_and_repeated_ids_and_no_rows(spark):
    """Every stage keeps its columns and ends; rows without an id or with one id are rows of their own."""
    def text(word):
        return " ".join(f"{word}{i}" for i in range(40))

    rows = [(None, text("a"), "en", "s", 1), (None, text("b"), "en", None, 1), (1, text("c"), None, "s", 1), (1, text("d"), "en", "s", 1),
            (2, None, "en", "s", 0), (2, "", "en", "s", 0), (3, text("e"), "en", "s", 1), (3, text("e"), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for given, most in ((docs, 7), (docs.where("false"), 0)):
        out = given
        for name, stage in corpus_pipeline.STAGES:
            out = written(stage(spark, out, SF), f"test-{name}")
            if name == "ngram_join":
                assert out.count() == most  # the repeated row goes
            if name != "best_fit_packing":
                assert out.columns == docs.columns
        assert out.count() == 0 if not most else out.where("piece = 0").count() > 0
