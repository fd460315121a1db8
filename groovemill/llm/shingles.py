"""Shingle sets of many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute

WORDS = 5
#: Bytes of text and texts taken at once.
BYTES = 1 << 20
ROWS = 10_000
_BASE, _MUL = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
_NIL, _ONE = np.zeros(1, np.uint64), np.ones(1, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of h."""
    h = (h ^ (h >> np.uint64(32))) * _MUL
    h = (h ^ (h >> np.uint64(32))) * _MUL
    return h ^ (h >> np.uint64(32))


def _byte_values() -> np.ndarray:
    """A number for each byte: 0 for the six blanks, one number for both cases of A-Z."""
    value = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    value[65:91] = value[97:123]
    value[[9, 10, 11, 12, 13, 32]] = 0
    return value


_VALUES = _byte_values()
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2 ** 64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BYTES + (1 << 16))
        inverse = pow(_BASE, -1, 1 << 64)
        _powers[:] = [np.cumprod(np.concatenate([_ONE, np.full(size - 1, b, np.uint64)])) for b in (_BASE, inverse)]
    return _powers[0][:n], _powers[1][:n]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of each word; data: UTF-8 bytes of all texts, offsets: where each begins, and the end."""
    value = _VALUES[data]
    word = value != 0
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1] | first[1:-1]
    ends[:-1] &= ~word[1:] | first[1:-1]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _power(len(data))
    total = np.concatenate([_NIL, np.cumsum(value * up)])
    h = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
    return h, np.searchsorted(offsets, s, "right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the ascending distinct shingle hashes of each text. A text of fewer words than `size` has its
    whole sequence as one, a text without words none."""
    n = len(offsets) - 1
    h, text = word_hashes(data, offsets)
    words = np.bincount(text, minlength=n)
    begin = np.cumsum(words) - words
    many = np.where(words >= size, words - size + 1, np.minimum(words, 1))
    ends = np.cumsum(many)
    owner = np.repeat(np.arange(n), many)
    at = begin[owner] + np.arange(ends[-1] if n else 0) - np.repeat(ends - many, many)
    length = np.minimum(words[owner], size)
    acc = length.astype(np.uint64) * np.uint64(_BASE)
    padded = np.concatenate([h, np.zeros(size, np.uint64)])
    for k in range(size):
        acc = np.where(k < length, mix(acc + padded[at + k]), acc)
    for a, b in zip((ends - many).tolist(), ends.tolist(), strict=True):
        if b - a > 1:
            acc[a:b].sort()
    keep = np.ones(len(acc), bool)
    keep[1:] = (acc[1:] != acc[:-1]) | (owner[1:] != owner[:-1])
    return acc[keep], np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=n))]).astype(np.int64)


def of_batch(texts: pa.Array):
    """(first row, hashes, offsets) of runs of at most ROWS rows of a string column, about BYTES of text each; null is empty."""
    texts = texts.cast(pa.large_binary())
    ends = np.concatenate([[0], np.cumsum(np.array(pa.compute.coalesce(pa.compute.binary_length(texts), 0)))]).astype(np.int64)
    row = 0
    while row < len(texts):
        upto = min(row + ROWS, max(row + 1, int(np.searchsorted(ends, ends[row] + BYTES, "right")) - 1))
        data = np.frombuffer(b"".join(x or b"" for x in texts.slice(row, upto - row).to_pylist()), np.uint8)
        yield row, *shingle_sets(data, ends[row : upto + 1] - ends[row])
        row = upto


def signatures(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set, as signed longs: equal for equal sets."""
    out = []
    for salt in (1, 2):
        total = np.concatenate([_NIL, np.cumsum(mix(hashes + np.uint64(salt * _BASE % (1 << 64))))])
        out.append((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64))
    return out[0], out[1]
