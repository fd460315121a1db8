"""Packing by vector bin packing with the dot-product heuristic."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, documents, give_back
from .tokens import encoded, encoder, vocabulary

SEQUENCE_TOKENS = 1024
SEQUENCE_SEGMENTS = 64
END_ID = 0
#: Pieces that wait to be packed at once.
POOL = 1024
#: Words cached while packing: workers that wait for later stages keep them.
PACK_WORDS = 500_000
#: Rows given out at once; with ids a row has up to four bytes a token.
BATCH_ROWS = 4_000


def loss_before(ranges: list[int] | None, tokens: int) -> np.ndarray:
    """How many of a document's first 0, 1, .. tokens bear loss, by ranges start, end, start, end, .. of those that do."""
    if ranges and len(ranges) % 2:
        raise ValueError("a range of loss-bearing tokens has no end")
    bears = np.zeros(tokens, bool)
    for a, b in zip((ranges or [])[::2], (ranges or [])[1::2], strict=True):
        bears[max(a, 0) : max(b, 0)] = True
    return np.concatenate([np.zeros(1, np.int32), np.cumsum(bears, dtype=np.int32)])


def pack_pool(sizes: np.ndarray, limits: np.ndarray, cut: bool, before: list[np.ndarray] | None = None) -> list[list[tuple[int, int, int]]]:
    """Bins of (item, start, tokens). sizes: tokens, segments, loss-bearing tokens of each item; limits: of a bin.

    Bins are filled one after another. Of the items that fit into what a bin has left in every dimension the one with
    the largest dot product with it goes in, both in units of the limits; of equal ones the first of the largest in
    tokens. With cut, an item that doesn't fit is cut so that the bin gets full, the rest staying in the pool: all bins
    but the last are full then, unless a segment or loss limit binds. Of an item that is cut loss counts by its part, or
    with before, loss_before() of each item, by its tokens. An item beyond a limit is refused with ValueError.
    """
    if len(sizes) and (sizes > limits).any():
        raise ValueError("an item is larger than a sequence")
    order = np.argsort(-sizes[:, 0], kind="stable")
    sizes, bins = sizes[order].astype(np.float64), []
    unit = sizes / limits
    start, free, live = np.zeros(len(order), np.int64), np.ones(len(order), bool), len(order)
    while live:
        left, own = limits.astype(np.float64), []
        while live:
            fits = free & (sizes <= left).all(axis=1)
            i = int(np.where(fits, unit @ (left / limits), -1.0).argmax())
            if not fits[i]:
                break
            own.append((int(order[i]), int(start[i]), int(sizes[i, 0])))
            left -= sizes[i]
            free[i] = False
            live -= 1
            if left[:2].min() < 1:
                break
        if cut and live and left[:2].min() >= 1:
            score = np.where(free, unit @ (left / limits), -1.0)
            for i in [int(score.argmax())] if before is None else np.argsort(-score, kind="stable")[:live].tolist():
                rate = sizes[i, 2] / sizes[i, 0]
                if before is None:
                    n = int(min(left[0], left[2] // rate if rate else left[0]))
                else:
                    sums = before[order[i]]
                    n = int(min(left[0], np.searchsorted(sums, sums[start[i]] + left[2], "right") - 1 - start[i]))
                if 0 < n < sizes[i, 0]:
                    own.append((int(order[i]), int(start[i]), n))
                    start[i] += n
                    sizes[i, 0] -= n
                    sizes[i, 2] = np.ceil(rate * sizes[i, 0]) if before is None else sums[-1] - sums[start[i]]
                    unit[i] = sizes[i] / limits
                    break
        bins.append(own)
        if live < 0.9 * len(free):
            sizes, unit, start, order, free = sizes[free], unit[free], start[free], order[free], free[free]
    return bins


class _Out:
    """Collects the rows of pieces and gives them out in batches."""

    NAMES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "segments", "loss_tokens")

    def __init__(self, with_ids: bool):
        self.rows: list[tuple] = []
        self.ids: list[bytes] | None = [] if with_ids else None
        self.schema = pa.schema([(n, pa.int64()) for n in self.NAMES] + ([("ids", pa.binary())] if with_ids else []))

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            cols = [pa.array(c, pa.int64()) for c in zip(*self.rows, strict=True)]
            if self.ids is not None:
                cols.append(pa.array(self.ids, pa.binary()))
                self.ids = []
            self.rows = []
            yield pa.RecordBatch.from_arrays(cols, schema=self.schema)


def packer(path: str, end_id: int, limits: tuple[int, int, int], loss_share: float, cut: bool, with_ids: bool, by_ranges: bool = False):
    """The function for mapInArrow. Each task packs what it reads: no shuffle, and no more than POOL pieces in memory.

    With by_ranges the first column of a batch is a struct of doc_id and the ranges of loss-bearing tokens."""
    most, bound = limits[0], np.array(limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out = encoder(path, PACK_WORDS), _Out(with_ids)
        task = TaskContext.get()
        seq = (task.partitionId() if task else 0) << 33
        pool: list[tuple] = []  # document, ids of the piece, its start, tokens of the document, its sums of loss
        share = lambda n: int(np.ceil(n * loss_share))
        loss = lambda ids, sums: share(len(ids)) if sums is None else int(sums[-1] - sums[0])

        def put(own: list[tuple]) -> None:
            nonlocal seq
            offset = 0
            total = sum(loss(ids, sums) for _, ids, _, _, sums in own)
            for doc, ids, start, tokens, _ in own:
                raw = ids.astype("<u4").tobytes()
                out.rows.append((doc, start, len(ids), zlib.crc32(raw), tokens, seq, offset, len(own), total))
                if out.ids is not None:
                    out.ids.append(raw)
                offset += len(ids)
            seq += 1

        def flush(last: bool) -> None:
            nonlocal pool
            if not pool:
                return
            sizes = np.array([(len(ids), 1, loss(ids, sums)) for _, ids, _, _, sums in pool])
            part = lambda i, s, n: (pool[i][0], pool[i][1][s : s + n], pool[i][2] + s, pool[i][3], pool[i][4][s : s + n + 1] if by_ranges else None)
            bins = [[part(*x) for x in b] for b in pack_pool(sizes, bound, cut, [x[4] for x in pool] if by_ranges else None)]
            rest = [] if last else bins.pop()
            for b in bins:
                put(b)
            pool = rest

        def add(doc, ids: np.ndarray, ranges: list[int] | None) -> None:
            sums = loss_before(ranges, len(ids)) if by_ranges else None
            s = 0
            while s < len(ids):
                n = min(most, len(ids) - s)
                if sums is not None:
                    n = min(n, int(np.searchsorted(sums, sums[s] + limits[2], "right")) - 1 - s)
                elif share(n) > limits[2]:
                    n = int(limits[2] / loss_share)
                    n -= share(n) > limits[2]
                    if n < 1:
                        raise ValueError("a token has more loss than a sequence")
                if not cut and n < min(most, len(ids) - s):
                    raise ValueError("an item is larger than a sequence")
                piece = (doc, ids[s : s + n], s, len(ids), sums[s : s + n + 1] if by_ranges else None)
                if n == most:
                    put([piece])
                else:
                    pool.append(piece)
                    if len(pool) >= POOL:
                        flush(False)
                s += n

        for docs, flat, ends in encoded(batches, enc, end_id):
            for doc, ids in zip(docs, np.split(flat, ends[:-1]), strict=True):
                if by_ranges:
                    add(doc["doc_id"], ids, doc["loss"])
                else:
                    add(doc, ids, None)
                yield from out.batches(BATCH_ROWS)
        flush(True)
        yield from out.batches(1)
        give_back()

    return run


def pack(
    docs: DataFrame, path: str | None = None, end_id: int = END_ID, tokens: int = SEQUENCE_TOKENS, segments: int = SEQUENCE_SEGMENTS, loss_tokens: int | None = None, loss_share: float = 1.0, cut: bool = True, with_ids: bool = False, loss: str | None = None
) -> DataFrame:
    """The pieces of docs(doc_id, text) in sequences of at most `tokens` tokens, `segments` pieces and `loss_tokens` loss-bearing tokens.

    A document's ids end with end_id, so an empty or null text is one id. Whole sequences are cut off long documents;
    what remains is packed by the dot-product heuristic within the task that read it. loss names a column of docs of type
    array<long>: the ranges start, end, start, end, .. of the document's tokens that bear loss, ends exclusive, none if
    null ([prompt tokens, all tokens] for a prompt with its response); each piece counts its own. Without it loss_share
    of a piece's tokens, rounded up, bear loss. What is beyond the loss limit is cut, with cut=False refused. With with_ids, `ids` holds the piece as little-endian unsigned 32-bit ids. Sequence ids are
    unique, from the task and a running number. Repeated rows are packed as often as they occur; a null doc_id stays
    null; an empty table gives no rows; other columns are left out.
    """
    bounded_batches(docs.sparkSession)
    limits = (tokens, segments, loss_tokens or tokens)
    run = packer(path or vocabulary(), end_id, limits, loss_share, cut, with_ids, loss is not None)
    schema = ", ".join(f"{n} long" for n in _Out.NAMES) + (", ids binary" if with_ids else "")
    doc = docs["doc_id"].cast("long")
    if loss is not None:
        doc = F.struct(doc.alias("doc_id"), docs[loss].cast("array<long>").alias("loss"))
    return docs.select(doc.alias("doc_id"), "text").mapInArrow(run, schema)


def op1(spark, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
