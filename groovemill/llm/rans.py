"""A static range asymmetric numeral system over token ids: interleaved lanes, independent blocks, checkpoints, checksums."""

from __future__ import annotations

import zlib

import numpy as np

#: Frequencies sum to 2 ** SCALE; a state is in [2 ** 31, 2 ** 63) and gives up 32 bits at a time.
SCALE = 18
LANES = 2048
#: Ids of a block, about, and steps between checkpoints.
BLOCK_IDS = 1 << 20
CHECK_STEPS = 128
_LOW = np.uint64(1 << 31)
_U = np.uint64
_MASK32, _TOP = _U(0xFFFFFFFF), _U(63 - SCALE)


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to sum to 2 ** SCALE, at least 1 where there is a count."""
    total, whole = int(counts.sum()), 1 << SCALE
    if not total:
        return np.zeros(len(counts), np.uint32)
    f = np.where(counts > 0, np.maximum(1, counts.astype(np.float64) * whole // total), 0).astype(np.int64)
    for i in np.argsort(-f, kind="stable"):
        d = whole - int(f.sum())
        if not d:
            break
        f[i] += max(d, 1 - int(f[i]))
    return f.astype(np.uint32)


class Table:
    """The shared frequencies with what coding needs. One number holds a symbol's frequency and what precedes it, and
    the symbols by slot are 16-bit, so that both stay in a core's cache; the latter are made when first decoding."""

    def __init__(self, freq: np.ndarray):
        if len(freq) > 1 << 16:
            raise ValueError("ids have 16 bits at most")
        wide = freq.astype(np.uint64)
        self.freq = wide
        self.packed = (wide << _U(32)) | (np.cumsum(wide) - wide)
        self._symbol: np.ndarray | None = None
        self.pad = int(freq.argmax())

    @property
    def symbol(self) -> np.ndarray:
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint16), self.freq.astype(np.int64))
        return self._symbol


def encode(ids: np.ndarray, table: Table, lanes: int = LANES, every: int = CHECK_STEPS) -> tuple[bytes, bytes, int]:
    """(words, checkpoints, checksum) of one block. Id i is in lane i % lanes; the last step is padded.

    A checkpoint holds, for a step, where its words begin and all lanes' states, so decoding can begin there.
    """
    steps = -(-len(ids) // lanes)
    grid = np.full(steps * lanes, table.pad, np.uint16)
    grid[: len(ids)] = ids
    grid = grid.reshape(steps, lanes)
    if (np.bincount(ids, minlength=len(table.freq))[: len(table.freq)] > 0)[table.freq == 0].any() or (len(ids) and ids.max() >= len(table.freq)):
        raise ValueError("an id has no frequency")
    x = np.full(lanes, _LOW)
    words, marks = [None] * steps, []
    for t in range(steps - 1, -1, -1):
        p = table.packed[grid[t]]
        f = p >> _U(32)
        over = x >= f << _TOP
        words[t] = x[over].astype(np.uint32)
        x = np.where(over, x >> _U(32), x)
        q = x // f
        x = (q << _U(SCALE)) + (x - q * f) + (p & _MASK32)
        if t % every == 0:
            marks.append((t, x))
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype("<u8")
    checks = b"".join(at[t : t + 1].tobytes() + x.astype("<u8").tobytes() for t, x in reversed(marks))
    stream = np.concatenate(words).astype("<u4").tobytes() if steps else b""
    return stream, checks, zlib.crc32(ids.astype("<u4").tobytes())


def decode(stream: bytes, checks: bytes, n: int, table: Table, checksum: int | None = None, lanes: int = LANES, every: int = CHECK_STEPS, segment: int | None = None) -> np.ndarray:
    """The n ids of a block, or only those from checkpoint `segment` to the next; ValueError if the checksum differs."""
    steps = -(-n // lanes)
    words = np.frombuffer(stream, "<u4")
    marks = np.frombuffer(checks, "<u8").reshape(-1, lanes + 1)
    first, last = (0, steps) if segment is None else (segment * every, min(steps, (segment + 1) * every))
    out = np.empty((last - first, lanes), np.uint16)
    if last > first:
        mark = marks[first // every]
        at, x = int(mark[0]), mark[1:].astype(np.uint64)
        mask = _U((1 << SCALE) - 1)
        for t in range(first, last):
            slot = x & mask
            s = table.symbol[slot]
            out[t - first] = s
            p = table.packed[s]
            x = (p >> _U(32)) * (x >> _U(SCALE)) + slot - (p & _MASK32)
            low = np.flatnonzero(x < _LOW)
            x[low] = (x[low] << _U(32)) | words[at : at + len(low)]
            at += len(low)
    ids = out.reshape(-1)[: n - first * lanes]
    if segment is None and checksum is not None and zlib.crc32(ids.astype("<u4").tobytes()) != checksum:
        raise ValueError("checksum differs")
    return ids
