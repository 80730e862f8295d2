"""Secret scans with inferred credential grammars.

Base patterns find the labelled credentials. From them one probabilistic automaton per kind is inferred: a prefix
tree with counts whose states are merged as long as their continuation frequencies agree within a Hoeffding bound.
States of equal depth are tried first, so formats keep their length and their order; states of different depth
are only merged when both have so many arrivals that the bound means something, and so become the loops of formats
without a fixed length. Every other candidate string of every text is then scored by how much likelier an
automaton makes it, per character, than a bigram model of ordinary text. An automaton has no say in strings that it
does not accept (a step that no credential took, an end where none ended). Candidates above a level that follows
from held-out credentials are reported as ``grammar``.

A candidate is a run of 12 characters or more of those that the base pattern of an assignment takes, without full
stops at its ends; what a base span covers of it is cut out, and pieces of 12 characters or more are scored. The
bigrams are counted in the runs that are too short for a candidate: no credential teaches what is ordinary.

Bounded by parameters: the automata see at most ``sample`` credentials a kind, chosen by hash, of at most
``longest`` characters; one in ``held_out`` of them sets the level instead. Bigram counts cover all texts, and all
candidates of all texts are scored.

Defined cases: null text is empty and has no span; base spans of different kinds may overlap, a grammar span
never overlaps a base span; repeated rows are scanned one by one; without labelled credentials no grammar
span is reported.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

#: Fixed patterns of the labelled credentials.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "grammar")
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{2,}")
SHORTEST = 12  # characters of a candidate


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, credential) of the base patterns, ordered by start, then kind."""
    found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def outside(candidates: list[tuple[int, int]], base: list[tuple[int, int, int, str]], shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """What the base spans leave of the candidates (both in order of their start), in pieces of ``shortest`` or more."""
    starts: list[int] = []
    ends: list[int] = []
    for s, _, e, _ in base:  # overlapping base spans as one
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    out = []
    for s, e in candidates:
        i = bisect_right(ends, s)  # the first base span that ends behind the candidate's start
        while i < len(starts) and starts[i] < e:
            if starts[i] - s >= shortest:
                out.append((s, starts[i]))
            s = max(s, ends[i])
            i += 1
        if e - s >= shortest:
            out.append((s, e))
    return out


def runs(text: str) -> tuple[list[tuple[int, int]], list[str]]:
    """Candidates (start, end) of a text, and the runs that are too short for one."""
    long, short = [], []
    for m in RUN.finditer(text):
        if m.end() - m.start() < SHORTEST:
            short.append(m[0])
            continue
        word = m[0].lstrip(".")
        start = m.end() - len(word)
        word = word.rstrip(".")
        if len(word) >= SHORTEST:
            long.append((start, start + len(word)))
    return long, short


def scan(text: Column) -> Column:
    """struct(base, credentials, candidates) of one text: ``kind:start:end`` comma-joined, and one line
    ``kind<tab>credential`` or ``start:end:string`` each. Candidates overlap no base span."""

    @F.pandas_udf("base string, credentials string, candidates string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                base = base_spans(t)
                cand = outside(runs(t)[0], base)
                rows.append((",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in base),
                             "\n".join(f"{KINDS[k]}\t{v}" for _, k, _, v in base),
                             "\n".join(f"{s}:{e}:{t[s:e]}" for s, e in cand)))
            yield pd.DataFrame(rows, columns=["base", "credentials", "candidates"])

    return run(F.coalesce(text, F.lit("")))


def bigrams(docs: DataFrame) -> dict[str, int]:
    """How often each character follows each other in the short runs of all texts ("^": at the start)."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        two: Counter = Counter()
        for pdf in batches:
            words = Counter(w for t in pdf["text"] for w in runs(t)[1])
            for w, n in words.items():
                for a, b in zip("^" + w, w, strict=False):
                    two[a + b] += n
        yield pd.DataFrame(list(two.items()), columns=["pair", "n"])

    texts = docs.where(F.col("text").isNotNull()).select("text")
    pairs = texts.mapInPandas(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return {r["pair"]: r["n"] for r in pairs.collect()}  # 68 x 67 rows at most


# ---- grammar inference ------------------------------------------------------------------------------------------------------

#: Symbols: classes of characters that credential formats tell apart, and how many characters each holds.
CLASS_SIZE = {"9": 10, "h": 6, "l": 20, "H": 6, "U": 20}


def symbol(c: str) -> str:
    if "0" <= c <= "9":
        return "9"
    if "a" <= c <= "z":
        return "h" if c <= "f" else "l"
    if "A" <= c <= "Z":
        return "H" if c <= "F" else "U"
    return c


class Automaton:
    """Probabilistic deterministic automaton: per state the count of arrivals, of ends, and of each next symbol."""

    def __init__(self) -> None:
        self.arrive, self.end = [0], [0]
        self.next: list[dict[str, int]] = [{}]
        self.count: list[Counter] = [Counter()]

    def add(self, word: str) -> None:
        at = 0
        self.arrive[0] += 1
        for c in word:
            self.count[at][c] += 1
            if c not in self.next[at]:
                self.next[at][c] = len(self.arrive)
                self.arrive.append(0)
                self.end.append(0)
                self.next.append({})
                self.count.append(Counter())
            at = self.next[at][c]
            self.arrive[at] += 1
        self.end[at] += 1

    def _agree(self, a: int, b: int, slack: float) -> bool:
        """Do two states continue alike? Hoeffding test on ends and symbols, followed down both trees."""
        todo, seen = [(a, b)], set()
        while todo:
            a, b = todo.pop()
            if a == b or (a, b) in seen:
                continue
            seen.add((a, b))
            m, n = self.arrive[a], self.arrive[b]
            if not m or not n:
                continue
            bound = slack * (1 / math.sqrt(m) + 1 / math.sqrt(n))
            if bound >= 1:
                continue  # too few arrivals to differ, here and below
            if abs(self.end[a] / m - self.end[b] / n) > bound:
                return False
            for c in self.count[a].keys() | self.count[b].keys():
                if abs(self.count[a][c] / m - self.count[b][c] / n) > bound:
                    return False
                if c in self.next[a] and c in self.next[b]:
                    todo.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Merge the tree below ``b`` into ``a``, state by state."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if a == b:
                continue
            self.arrive[a] += self.arrive[b]
            self.end[a] += self.end[b]
            self.count[a].update(self.count[b])
            for c, to in self.next[b].items():
                if c in self.next[a]:
                    todo.append((self.next[a][c], to))
                else:
                    self.next[a][c] = to

    def merge_states(self, alpha: float = 0.05, loops: float = 0.2) -> None:
        """Level by level: a state joins the first of its level that it agrees with. Then a state joins the first one
        of an earlier level that it agrees with, provided that the bound of the two is below ``loops``."""
        slack = math.sqrt(0.5 * math.log(2 / alpha))
        levels, level = [[0]], [0]
        while level:
            kept: list[int] = []
            for parent in level:
                for c in sorted(self.next[parent], key=lambda c, p=parent: (-self.count[p][c], c)):
                    state = self.next[parent][c]
                    if state in kept:
                        continue
                    match = next((k for k in kept if self._agree(k, state, slack)), None)
                    if match is None:
                        kept.append(state)
                    else:
                        self.next[parent][c] = match
                        self._fold(match, state)
            levels.append(kept)
            level = kept
        need = (2 * slack / loops) ** 2  # arrivals of each that bring the bound below ``loops``
        place = {s: d for d, states in enumerate(levels) for s in states}
        for d in range(1, len(levels)):
            for state in levels[d]:
                if self.arrive[state] < need or state not in self._reached():
                    continue
                before = [s for s in sorted(self._reached(), key=lambda s: (place.get(s, d), s)) if place.get(s, d) < d and self.arrive[s] >= need]
                match = next((s for s in before if self._agree(s, state, slack)), None)
                if match is not None:
                    for nexts in self.next:
                        for c, to in nexts.items():
                            if to == state:
                                nexts[c] = match
                    self._fold(match, state)

    def _reached(self) -> set[int]:
        found, todo = {0}, [0]
        while todo:
            for to in self.next[todo.pop()].values():
                if to not in found:
                    found.add(to)
                    todo.append(to)
        return found

    def compact(self) -> Automaton:
        """Only the states that the merges have left."""
        number, order = {0: 0}, [0]
        for s in order:
            for to in self.next[s].values():
                if to not in number:
                    number[to] = len(order)
                    order.append(to)
        out = Automaton()
        out.arrive, out.end = [self.arrive[s] for s in order], [self.end[s] for s in order]
        out.next = [{c: number[to] for c, to in self.next[s].items()} for s in order]
        out.count = [self.count[s] for s in order]
        return out

    def log_likelihood(self, word: str) -> float:
        """Per character, the end included; minus infinity for a word that no credentials make likely."""
        at, total = 0, 0.0
        for ch in word:
            c = symbol(ch)
            if not self.count[at][c]:
                return -math.inf
            total += math.log(self.count[at][c] / self.arrive[at] / CLASS_SIZE.get(c, 1))
            at = self.next[at][c]
        if not self.end[at]:
            return -math.inf
        return (total + math.log(self.end[at] / self.arrive[at])) / max(1, len(word))


def infer(words: list[str], alpha: float = 0.05) -> Automaton:
    a = Automaton()
    for w in sorted(words):
        a.add("".join(map(symbol, w)))
    a.merge_states(alpha)
    return a.compact()


class Bigrams:
    """Ordinary strings: smoothed character bigrams."""

    def __init__(self, counts: dict[str, int]) -> None:
        self.two, self.one = counts, defaultdict(int)
        for k, v in counts.items():
            self.one[k[0]] += v

    def log_likelihood(self, word: str) -> float:
        total = 0.0
        for a, b in zip("^" + word, word, strict=False):
            total += math.log((self.two.get(a + b, 0) + 0.2) / (self.one.get(a, 0) + 0.2 * 67))
        return total / max(1, len(word))


class Grammar:
    """The automata of all kinds, the model of ordinary strings and the level that reports a candidate."""

    def __init__(self, automata: dict[str, Automaton], ordinary: Bigrams, level: float) -> None:
        self.automata, self.ordinary, self.level = automata, ordinary, level

    def score(self, word: str) -> float:
        best = max((a.log_likelihood(word) for a in self.automata.values()), default=-math.inf)
        return best if best == -math.inf else best - self.ordinary.log_likelihood(word)

    def spans(self, base: str, candidates: str) -> str:
        """All spans of a text: the base ones and the candidates that score as credentials."""
        found = [(int(s), KINDS.index(k), int(e)) for k, s, e in (x.split(":") for x in base.split(",") if x)]
        for s, e, v in (x.split(":", 2) for x in candidates.split("\n") if x):
            if self.score(v) >= self.level:
                found.append((int(s), 3, int(e)))
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))


def learn(scanned: DataFrame, ordinary: dict[str, int], sample: int = 1500, longest: int = 128, alpha: float = 0.05, share: float = 0.05,
          margin: float = 0.5, held_out: int = 5) -> Grammar:
    """``scanned``: a column ``found`` of :func:`scan`; ``ordinary``: counts of :func:`bigrams`. The level lies half-way
    between ``margin`` nats a character and what all but ``share`` of the held-out credentials reach that an automaton accepts."""
    lines = scanned.select(F.explode(F.split("found.credentials", "\n")).alias("_x")).where("_x <> ''").distinct()
    kind, value = F.split_part("_x", F.lit("\t"), F.lit(1)), F.split_part("_x", F.lit("\t"), F.lit(2))
    lines = lines.select(kind.alias("kind"), value.alias("value")).where(F.length("value") <= longest)
    words = {k: [r["value"] for r in lines.where(F.col("kind") == k).orderBy(F.xxhash64("value"), "value").limit(sample).collect()]
             for k in KINDS[:3]}  # a bounded sample of labelled credentials
    automata = {k: infer([x for i, x in enumerate(w) if i % held_out], alpha) for k, w in words.items() if len(w) > 1}
    grammar = Grammar(automata, Bigrams(ordinary), math.inf)
    reached = sorted(s for w in words.values() for x in w[::held_out] if (s := grammar.score(x)) > -math.inf)
    if reached:
        grammar.level = max(margin, (margin + reached[int(share * len(reached))]) / 2)
    return grammar


def all_spans(grammar: Grammar, found: Column) -> Column:
    """Column of all spans, from the struct that :func:`scan` gave."""

    @F.pandas_udf("string")
    def run(base: pd.Series, candidates: pd.Series) -> pd.Series:
        return pd.Series([grammar.spans(b, c) if c else b for b, c in zip(base, candidates, strict=True)], dtype=object)

    return run(found["base"], found["candidates"])


def find_secrets(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), **kw) -> DataFrame:
    """Columns ``keep`` of every document, base (spans of the patterns) and spans (all)."""
    scanned = written(small_batches(docs).select(*keep, scan(F.col("text")).alias("found")), "secret-scan")
    grammar = learn(scanned, bigrams(docs), **kw)
    return scanned.select(*keep, F.col("found.base").alias("base"), all_spans(grammar, F.col("found")).alias("spans"))


def redacted_documents(docs: DataFrame, mark: str = "[SECRET]", **kw) -> DataFrame:
    """The documents with every span (overlapping ones together) replaced by ``mark``; n_chars follows."""
    names = docs.columns
    # own names beside the user's columns, whatever these are called
    rows = small_batches(docs).select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    scanned = written(rows.withColumn("found", scan(F.col("text"))), "secret-scan")
    grammar = learn(scanned, bigrams(scanned), **kw)

    @F.pandas_udf("string")
    def hide(texts: pd.Series, base: pd.Series, candidates: pd.Series) -> pd.Series:
        """The text without its spans; null where it has none."""
        out = []
        for text, b, c in zip(texts, base, candidates, strict=True):
            found = grammar.spans(b, c) if c else b
            parts, at = [], 0
            for s, e in sorted((int(x.split(":")[1]), int(x.split(":")[2])) for x in found.split(",") if x):
                if s >= at:
                    parts += [text[at:s], mark]
                at = max(at, e)
            out.append("".join(parts) + text[at:] if found else None)
        return pd.Series(out, dtype=object)

    clean = scanned.select("doc", hide(F.col("text"), F.col("found.base"), F.col("found.candidates")).alias("clean"))
    hit = F.col("clean").isNotNull()
    new = {"text": F.when(hit, F.col("clean")).otherwise(F.col("doc.text"))}
    if "n_chars" in names:
        new["n_chars"] = F.when(hit, F.length("clean").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("doc.n_chars"))
    return clean.select(*[new[c].alias(c) if c in new else F.col("doc").getField(c).alias(c) for c in names])
