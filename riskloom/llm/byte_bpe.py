"""Ids of whole texts by a byte-level BPE tokenizer of the ``tokenizers`` library, from units that repeat.

A text is cut at its added tokens, then into units (a run without white space and the blank before it, cut behind
leading letters where a mark or digit follows, or white space left over) that the vocabulary's split pattern never
joins, so the units' ids in order are the text's ids. Up to ``most`` units and words inside them are remembered, the
first ones seen, as nearly all that repeat are among these; other words go to the library's model. After ``renew``
units that were not known all are forgotten, so what is remembered follows texts that change. Tokenizers of another
kind (a normalizer, another pre-tokenizer) encode every text as a whole."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

from .packing import _WS

#: Letters of ASCII and Latin-1; what may follow them where a unit ends (no letter of any script).
_LETTERS, _NO_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ", r"\x00-@\[-`{-\x7F"


def _byte_letters() -> dict[int, int]:
    """Byte -> the character that stands for it in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}


class Ids(dict):
    """Unit or word -> its ids, ``width`` bytes each, little endian (a word alone is a unit too)."""

    def __init__(self, tokenizer_path: str, width: int, most: int = 500_000, renew: int = 10_000_000):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.most, self.renew, self.unknown = Tokenizer.from_file(tokenizer_path), most, renew, 0
        self.pieces = self.tokenizer.model.tokenize
        made = json.loads(self.tokenizer.to_str())
        before = made.get("pre_tokenizer") or {}
        self.byte_level = (made.get("normalizer") is None and before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
                           and made["model"]["type"] == "BPE")
        self.kind = np.dtype(f"<u{width}")
        vocabulary = self.tokenizer.get_vocab()
        added = {t["content"]: t["id"] for t in made.get("added_tokens", [])}
        self.added = {t: self._raw([i]) for t, i in added.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")").split if added else None
        self.unit = re.compile(f" ?[{_LETTERS}]++(?=[{_NO_LETTER}]|\\Z)| ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+").findall
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.letters = _byte_letters()
        self.blank = chr(self.letters[32])
        self.one = {w: self._raw([i]) for w, i in vocabulary.items() if w not in added}
        self.raw = {i: self._raw([i]) for i in vocabulary.values()}

    def _raw(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.kind).tobytes()

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():  # only blanks have another letter
            letters = word.replace(" ", self.blank)
        else:
            letters = word.encode().decode("latin-1").translate(self.letters)
        ids = self.one.get(letters)  # a word of the vocabulary is one id
        if ids is None:
            raw = self.raw
            ids = b"".join([raw[t.id] for t in self.pieces(letters)])
        return ids

    def __missing__(self, unit: str) -> bytes:
        # most units are letters alone: the split pattern keeps these together
        if unit.isalpha() or (unit[0] == " " and unit[1:].isalpha()) or len(words := self.split(unit)) == 1:
            ids = self._word(unit)
        else:
            ids = b"".join([self[w] for w in words])
        self.unknown += 1
        if self.unknown >= self.renew:
            self.clear()
            self.unknown = 0
        if len(self) < self.most:
            self[unit] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.unit(text)))

    def of(self, text: str) -> bytes:
        if not self.byte_level:
            return self._raw(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if self.cut is None:
            return self._plain(text)
        return b"".join(self.added[part] if part in self.added else self._plain(part) for part in self.cut(text))


@lru_cache(maxsize=2)
def ids(tokenizer_path: str, width: int) -> Ids:
    """One per worker process: tasks that follow each other share what it remembers."""
    return Ids(tokenizer_path, width)
