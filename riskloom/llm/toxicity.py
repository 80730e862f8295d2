"""Toxicity by weak supervision.

Many voters look at a text: words and word beginnings from a lexicon, and patterns of shouting. The lexicon is
mined from labelled rows (units that are far more frequent in toxic texts) and joined to a short fixed
list. A generative label model with one hidden class (toxic or not) estimates, over the votes of all
documents, how often each voter fires in either class, and from the pairs of voters how far they repeat each
other; votes of voters that fire together within the classes count less. A linear classifier
(logistic regression) is trained on the label model's posteriors and gives the scores.

Bounds: the lexicon is mined from at most ``sample`` labelled rows, chosen by a hash of the id; at most
``most`` voters of a kind. Votes, their counts and all scores cover all documents and whole texts.

Defined cases: null text is empty; an empty text fires no voter and gets the lowest score any text without
a vote gets; rows without an id or label teach nothing; repeated rows are scored one by one, and equal texts get
equal scores; with no labelled toxic row the fixed lexicon and a prior of one percent are used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, small_batches, written
from .wordhash import hash_of, text_buffer, text_slices, word_hashes

#: Fixed list of common insults, in the languages of the corpus.
INSULTS = (
    "idiot idiots moron morons stupid dumb dumbass loser losers scum trash garbage worthless pathetic disgusting clown "
    "imbecile jerk bastard bitch asshole fool retard "
    "dummkopf arschloch trottel abschaum versager connard imbécile salaud ordure crétin idiota estúpido imbécil basura escoria").split()

#: Words for the lexicon: runs of letters and digits; bytes above ASCII count as letters.
_SEPARATOR = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
STEMS = (4, 5, 6)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


class Voters:
    """The voters: lexicon words, lexicon beginnings, the fixed list, and two patterns."""

    def __init__(self, words: list[str], stems: list[str]) -> None:
        self.words, self.stems = words, stems
        self.names = [f"word {w}" for w in words] + [f"stem {s}" for s in stems] + ["fixed list", "capitals", "exclamations"]
        known = [(hash_of(w), i) for i, w in enumerate(words)]
        known += [(hash_of(s, stem=True), len(words) + i) for i, s in enumerate(stems)]
        known += [(hash_of(s), len(words) + i) for i, s in enumerate(stems)]  # the beginning itself as a word
        known += [(hash_of(w), len(words) + len(stems)) for w in INSULTS]
        known.sort()
        self.keys, self.voter = np.array([k for k, _ in known], np.uint64), np.array([i for _, i in known])
        self.lengths = tuple(sorted({len(s.encode()) for s in stems}))

    def votes(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bit mask of the voters that fire, number of lexicon hits) per text."""
        n, lexicon = len(offs) - 1, len(self.words) + len(self.stems) + 1
        mask, hits = np.zeros(n, np.int64), np.zeros(n, np.int64)
        unit, owner = word_hashes(data, offs, _SEPARATOR, self.lengths)
        count = np.bincount(owner, minlength=n)  # words and beginnings
        at = np.searchsorted(self.keys, unit)
        at[at == len(self.keys)] = 0
        hit = np.flatnonzero(self.keys[at] == unit) if len(self.keys) else np.zeros(0, int)
        first, doc = at[hit], owner[hit]
        hits += np.bincount(doc, minlength=n)
        same = self.keys
        while len(first):  # a unit may belong to several voters, next to each other in the key order
            np.bitwise_or.at(mask, doc, np.int64(1) << self.voter[first].astype(np.int64))
            nxt = first + 1
            more = np.flatnonzero((nxt < len(same)) & (same[np.minimum(nxt, len(same) - 1)] == same[first]))
            first, doc = nxt[more], doc[more]
        upper = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
        shout = np.concatenate([[0], np.cumsum(data == 33)])
        size = np.maximum(1, offs[1:] - offs[:-1])
        mask |= ((upper[offs[1:]] - upper[offs[:-1]]) > 0.3 * size).astype(np.int64) << lexicon
        mask |= ((shout[offs[1:]] - shout[offs[:-1]]) > 0.02 * size).astype(np.int64) << (lexicon + 1)
        return mask, np.where(count > 0, hits, 0)

    def of(self, text: Column) -> Column:
        """struct(mask, hits) of a text column."""

        @F.arrow_udf("struct<mask: bigint, hits: bigint>")
        def run(texts: pa.Array) -> pa.Array:
            data, offs = text_buffer(texts)
            found = [self.votes(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a]) for a, b in text_slices(offs, 1 << 19)]
            mask, hits = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))
            return pa.StructArray.from_arrays([pa.array(mask, pa.int64()), pa.array(hits, pa.int64())], names=["mask", "hits"])

        return run(text)


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` labelled training rows (text, toxic), chosen by a hash of the id. ``sketch`` is the
    smallest hash of a sentence, which near copies mostly share: they count as one row for the lexicon."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), "toxic")
    sentences = F.filter(F.split("text", r"[.\n]"), lambda s: F.length(s) > 20)
    sketch = F.coalesce(F.array_min(F.transform(sentences, lambda s: F.xxhash64(s))), F.xxhash64("text"))
    return rows.withColumn("sketch", sketch)


def mine_lexicon(rows: DataFrame, most: int = 28, precision: float = 0.9, support: float = 0.01,
                 units: int = 50_000) -> tuple[list[str], list[str], float]:
    """(words, stems, share of toxic rows): units by how many toxic rows hold them, whose rows are toxic with
    at least ``precision`` (lower end of two standard errors); a unit that adds little to one that it begins, or
    that begins it, is left out.
    A unit must be in ``support`` of the toxic rows; the ``units`` most frequent ones of the toxic rows are counted in the others."""
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    words = F.split(F.translate("text", UPPER, LOWER), _GAP)
    toxic = rows.where("toxic = 1").select("sketch", F.explode(words).alias("w")).where("w <> ''").distinct()
    part = [F.struct(F.lit(0).alias("stem"), F.col("w").alias("unit"))]
    part += [F.when(F.length("w") > m, F.struct(F.lit(m).alias("stem"), F.substring("w", 1, m).alias("unit"))) for m in STEMS]
    each = toxic.select("sketch", F.explode(F.array(*part)).alias("_u")).where("_u IS NOT NULL").distinct()
    counts = each.groupBy("_u").agg(F.count("*").alias("t"))
    least = max(3, support * total["t"])
    found = [(r["_u"]["stem"], r["_u"]["unit"], r["t"])
             for r in counts.where(F.col("t") >= least).orderBy(F.desc("t"), "_u").limit(units).collect()]
    clean = _rows_with([hash_of(u, stem=bool(m)) for m, u, _ in found], {len(u.encode()) for m, u, _ in found if m}, rows.where("toxic <> 1"))
    good = []
    for (m, u, t), n in zip(found, clean, strict=True):
        rate = (t + 0.5) / (t + n + 1)
        sure = rate - 2 * math.sqrt(rate * (1 - rate) / (t + n + 1))
        if sure >= precision:
            good.append((m, u, t, t * sure))
    words, stems, taken = [], [], {}
    for m, unit, t, _ in sorted(good, key=lambda x: (-x[3], x[0], x[1])):
        alike = (n for u, n in taken.items() if unit.startswith(u) or (m and u.startswith(unit)))
        if 1.1 * max(alike, default=0) >= t:  # a word or beginning chosen before stands for it
            continue
        if len(stems if m else words) < most:
            (stems if m else words).append(unit)
            taken[unit] = t
    return words, stems, (total["t"] + 0.01) / (total["n"] + 1)


def _rows_with(hashes: list, lengths: set[int], rows: DataFrame) -> np.ndarray:
    """How many ``rows`` hold each unit; every task counts all its rows before anything is sent."""
    keys = np.array(hashes, np.uint64)
    order = np.argsort(keys, kind="stable")
    known, stems = keys[order], tuple(sorted(lengths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            data, offs = text_buffer(batch.column(0))
            for a, b in text_slices(offs, 1 << 19):
                unit, owner = word_hashes(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a], _SEPARATOR, stems)
                at = np.searchsorted(known, unit)
                at[at == len(known)] = 0
                hit = known[at] == unit
                once = np.unique(at[hit] * (b - a) + owner[hit]) // (b - a)
                total += np.bincount(once, minlength=len(known))
        i = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(total[i], pa.int64())], names=["i", "n"])

    out = np.zeros(len(known), np.int64)
    if len(known):
        for r in rows.select("text").mapInArrow(run, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():  # bounded by ``units``
            out[order[r["i"]]] = r["n"]
    return out


class LabelModel:
    """Two-class model of voters that fire or abstain: P(fires | toxic), P(fires | clean), and the weight of each
    voter after allowing for the voters that repeat it. An abstention says nothing; a text in which no voter
    fires is toxic with probability ``quiet``."""

    def __init__(self, prior: float, quiet: float, fire: np.ndarray, weight: np.ndarray) -> None:
        self.prior, self.quiet, self.fire, self.weight = prior, quiet, fire, weight

    def bias_and_gain(self) -> tuple[float, np.ndarray]:
        a, b = self.fire
        return math.log(self.prior / (1 - self.prior)), np.log(a / b) * self.weight

    def posterior(self, mask: Column) -> Column:
        bias, gain = self.bias_and_gain()
        z = F.lit(float(bias))
        for j, g in enumerate(gain):
            z = z + F.shiftright(mask, j).bitwiseAND(F.lit(1)) * F.lit(float(g))
        return F.when(mask == 0, F.lit(self.quiet)).otherwise(1 / (1 + F.exp(-z)))


def _bit(mask: Column, j: int) -> Column:
    return F.shiftright(mask, j).bitwiseAND(F.lit(1))


def _moments(patterns: DataFrame, model: LabelModel, n_voters: int) -> tuple[np.ndarray, np.ndarray]:
    """(expected toxic documents in which voters i and j both fire, the same for clean ones): one aggregation. The
    last voter, which always fires, carries the totals. Each task sums up its patterns first."""
    bias, gain = model.bias_and_gain()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = np.zeros((2, n_voters + 1, n_voters + 1))
        for pdf in batches:
            fired = (pdf["mask"].to_numpy()[:, None] >> np.arange(n_voters)) & 1
            p = np.where(pdf["mask"].to_numpy() == 0, model.quiet, 1 / (1 + np.exp(-(bias + fired @ gain))))
            x = np.concatenate([fired, np.ones((len(fired), 1))], axis=1)
            n = pdf["n"].to_numpy(float)
            both[0] += x.T @ (x * (p * n)[:, None])
            both[1] += x.T @ (x * ((1 - p) * n)[:, None])
        y, i, j = np.nonzero(both)
        yield pd.DataFrame({"y": y, "i": i, "j": j, "s": both[y, i, j]})

    out = np.zeros((2, n_voters + 1, n_voters + 1))
    for r in patterns.select("mask", "n").mapInPandas(run, "y int, i int, j int, s double").groupBy("y", "i", "j").agg(F.sum("s").alias("s")).collect():
        out[r["y"], r["i"], r["j"]] = round(r["s"], 6)  # voters squared rows; rounded, as sums come in any order
    return out[0], out[1]


def fit_label_model(patterns: DataFrame, seen: DataFrame, n_voters: int, prior: float, quiet: float,
                    rounds: int = 4) -> LabelModel:
    """``patterns``: (mask, n) over all documents; ``seen``: (mask, toxic) of the labelled sample, whose rates start
    the estimate and stay as prior counts. Every round is one aggregation over the patterns."""
    bits = [F.sum(_bit(F.col("mask"), j).cast("double")).alias(f"v{j}") for j in range(n_voters)]
    known = {int(r["toxic"]): r for r in seen.groupBy("toxic").agg(F.count("*").alias("n"), *bits).collect()}
    base = np.array([[(known[y][f"v{j}"] if y in known else 0.0) for j in range(n_voters)] for y in (1, 0)])
    size = np.array([float(known[y]["n"]) if y in known else 0.0 for y in (1, 0)])[:, None]
    guess = np.array([[0.2], [0.002]])

    def model(fired: np.ndarray, total: np.ndarray, weight: np.ndarray) -> LabelModel:
        return LabelModel(prior, quiet, np.clip((fired + 2 * guess) / (total + 2), 1e-5, 1 - 1e-5), weight)

    now = model(base, size, np.ones(n_voters))
    for _ in range(rounds):
        both = _moments(patterns, now, n_voters)
        total = np.array([[x[-1, -1]] for x in both])
        fired = np.array([np.diag(x)[:-1] for x in both])
        keep = np.minimum(1.0, total / np.maximum(size, 1))  # the labelled rates weigh as much as the sample does
        now = model(fired + base * keep, total + size * keep, now.weight)
    joint = _moments(patterns, now, n_voters)[0]
    mass, weight = joint[-1, -1], np.ones(n_voters)
    if mass > 1:  # correlations within the toxic class, where the voters fire
        mean = np.diag(joint)[:-1] / mass
        spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
        r = (joint[:-1, :-1] / mass - np.outer(mean, mean)) / np.outer(spread, spread)
        np.fill_diagonal(r, 0)
        weight = 1 / (1 + np.where(r > 0.5, r, 0).sum(axis=1))  # weaker dependence is left to the classifier
    return LabelModel(prior, quiet, now.fire, weight)


class Scorer:
    """Voters and the classifier's coefficients."""

    def __init__(self, voters: Voters, bias: float, gain: list[float]) -> None:
        self.voters, self.bias, self.gain = voters, bias, gain

    def score(self, found: Column) -> Column:
        z = F.lit(self.bias)
        for x, g in zip(features(found, len(self.voters.names)), self.gain, strict=True):
            z = z + x * F.lit(g)
        return 1 / (1 + F.exp(-z))


def features(found: Column, n_voters: int) -> list[Column]:
    """What the classifier sees: every vote, whether any lexicon voter fires, and how many hits there are."""
    mask, lexicon = found["mask"], (1 << (n_voters - 2)) - 1
    votes = [_bit(mask, j).cast("double") for j in range(n_voters)]
    return [*votes, (mask.bitwiseAND(F.lit(lexicon)) != 0).cast("double"), F.log1p(found["hits"].cast("double"))]


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000, most: int = 28) -> Scorer:
    rows = written(labelled_sample(small_batches(docs), labels, sample), "toxic-sample")
    words, stems, prior = mine_lexicon(rows, most)
    voters = Voters(words, stems)
    n = len(voters.names)
    # votes of all documents: no label enters them (labels of the held-out documents stay out of the sample)
    found = written(docs.select(voters.of(F.col("text")).alias("v")).select("v.mask", "v.hits")
                    .groupBy("mask", "hits").agg(F.count("*").alias("n")), "toxic-votes")
    patterns = found.groupBy("mask").agg(F.sum("n").alias("n"))
    seen = written(rows.select(voters.of(F.col("text"))["mask"].alias("mask"), "toxic"), "toxic-seen")
    none = seen.where("mask = 0").agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    quiet = ((none["t"] or 0) + 2 * prior) / (none["n"] + 2)
    model = fit_label_model(patterns, seen, n, prior, min(quiet, prior))
    p = model.posterior(F.col("mask"))
    weighed = found.select(F.struct("mask", "hits").alias("v"), "n", p.alias("p"))
    both = weighed.select("v", F.explode(F.array(F.struct(F.lit(1.0).alias("label"), (F.col("p") * F.col("n")).alias("weight")),
                                                 F.struct(F.lit(0.0).alias("label"), ((1 - F.col("p")) * F.col("n")).alias("weight")))).alias("_y"))
    both = both.where("_y.weight > 1e-9").select(
        F.col("_y.label").alias("label"), F.col("_y.weight").alias("weight"),
        array_to_vector(F.array(*features(F.col("v"), n))).alias("features"))
    if found.limit(1).count() == 0:
        return Scorer(voters, -5.0, [0.0] * (n + 2))
    fit = LogisticRegression(weightCol="weight", regParam=1e-5, maxIter=60, standardization=False).fit(both)
    return Scorer(voters, float(fit.intercept), [float(x) for x in fit.coefficients])


def scored(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",), **kw) -> DataFrame:
    """Columns ``keep`` of every document, held_out, score and predicted."""
    scorer = train(docs, labels, **kw)
    found = docs.select(*keep, scorer.voters.of(F.col("text")).alias("_v"), held_out(F.col("doc_id")).alias("held_out"))
    return found.withColumn("score", scorer.score(F.col("_v"))).select(
        *keep, "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """The documents that are not predicted toxic."""
    scorer = train(docs, labels, **kw)
    found = docs.withColumn("_v", scorer.voters.of(F.col("text")))
    return found.where(scorer.score(F.col("_v")) < 0.5).select(*docs.columns)
