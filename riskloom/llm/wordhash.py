"""Word and shingle hashes of Arrow text columns, computed on whole batches with numpy.

A word is a maximal run of bytes that are not blank, tab, newline, vertical tab, form feed or return; A-Z
count as a-z. Words are hashed by a polynomial over random 64-bit byte codes, read off prefix sums, so no
Python string is made."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240917)
_CODE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_CODE[ord("A"):ord("Z") + 1] = _CODE[ord("a"):ord("z") + 1]
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_STEP = _RNG.integers(0, 2**64, 16, dtype=np.uint64) | np.uint64(1)
BLOCK = 1 << 18
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Final mixing of 64-bit values (every input bit reaches every output bit)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _times(n: int, step: int) -> np.uint64:
    return np.uint64(n * int(_STEP[step]) % 2**64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for the largest block seen."""
    if not _POWERS or len(_POWERS[0]) < n:
        m = max(n, BLOCK + (1 << 16))
        up, down = np.full(m, _BASE, dtype=np.uint64), np.full(m, pow(_BASE, -1, 2**64), dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _POWERS[0], _POWERS[1]


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def word_hashes(data: np.ndarray, offs: np.ndarray, separators: np.ndarray | None = None,
                stems: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every word of the texts, in order; with ``stems``, also the hashes of the words'
    first bytes, of each of these lengths, where a word is longer. Works in blocks of about a quarter megabyte, cut
    at separators or the end of a text, so the working memory does not follow the text's length."""
    gap = SPACE if separators is None else separators
    hashes, owner, at, n = [], [], 0, len(data)
    while at < n:
        end = min(n, at + BLOCK)
        while end < n:  # to the next place where no word is cut
            rest = np.flatnonzero(gap[data[end:end + 4096]])
            stop = offs[np.searchsorted(offs, end)]
            if len(rest) or stop <= end + 4096:
                end = min(end + int(rest[0]) if len(rest) else n, int(stop), n)
                break
            end += 4096
        end = min(end, n)
        b = data[at:end]
        word = ~gap[b]
        fresh = np.zeros(len(b) + 1, dtype=bool)  # a text starts here
        inside = offs[np.searchsorted(offs, at):np.searchsorted(offs, end, "right")] - at
        fresh[inside] = True
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1] | fresh[1:-1]
        last[:-1] &= ~word[1:] | fresh[1:-1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        up, down = _powers(len(b))
        total = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(_CODE[b] * up[:len(b)], out=total[1:])
        hashes.append(mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * _STEP[0]))
        owner.append(np.searchsorted(offs, s + at, "right") - 1)
        for m in stems:
            has = e - s > m
            t = s[has]
            hashes.append(mix((total[t + m] - total[t]) * down[t] + _times(m, 11)))
            owner.append(owner[-1 - stems.index(m)][has])
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owner)


def shingles(words: np.ndarray, owner: np.ndarray, n_texts: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every k-word shingle; a text of 1 to k - 1 words gives its whole sequence."""
    count = np.bincount(owner, minlength=n_texts)
    start = np.cumsum(count) - count
    out_h, out_o = [], []
    m = len(words) - k + 1
    if m > 0:
        total = np.zeros(m, dtype=np.uint64)
        for i in range(k):
            total += words[i:m + i] * _STEP[i + 1]
        whole = owner[:m] == owner[k - 1:]
        out_h.append(mix(total[whole]))
        out_o.append(owner[:m][whole])
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        total = count[short].astype(np.uint64) * _STEP[10]
        for i in range(k - 1):
            has = count[short] > i
            total[has] += words[start[short[has]] + i] * _STEP[i + 1]
        out_h.append(mix(total))
        out_o.append(short)
    if not out_h:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out_h), np.concatenate(out_o)


def text_slices(offs: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together (a longer text alone)."""
    a = 0
    while a < len(offs) - 1:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + most, "right")) - 1)
        yield a, b
        a = b


def hash_of(word: str, stem: bool = False) -> np.uint64:
    """The hash that :func:`word_hashes` gives to this word (separators left aside), or to words starting with it."""
    raw = np.frombuffer(word.encode(), dtype=np.uint8)
    up, _ = _powers(len(raw))
    total = (_CODE[raw] * up[:len(raw)]).sum(dtype=np.uint64)
    return mix(np.array([total]) + _times(len(raw), 11 if stem else 0))[0]
