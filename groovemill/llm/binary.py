"""Token ids in files of range-coded blocks, in ascending doc_id order."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rans
from .common import bounded_batches, count_below, documents, drop_folder, give_back, shuffles_dropped, staging
from .tokens import encoded, encoder, vocabulary

END_ID = 2
#: Ids have 16 bits; the table of frequencies has an entry for each. A vocabulary with larger ids is refused.
VOCABULARY = 1 << 16
#: Bytes of text that a range of documents should have.
RANGE_BYTES = 64 << 20
IDS = "part int, seq long, doc_id long, start long, n long, ids binary, counts binary"
BLOCKS = "part int, start long, n_ids long, doc_ids binary, no_id binary, sizes binary, words binary, checkpoints binary, checksum long"


def _tokenise(path: str, end_id: int):
    """Rows of documents with their ids, and at the end of each task one row with its counts of ids, seq -1."""
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    schema = pa.schema(list(zip(("part", "seq", "doc_id", "start", "n", "ids", "counts"), kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seq, start = encoder(path), TaskContext.get().partitionId(), 0, 0
        counts = np.zeros(VOCABULARY, "<i8")
        for docs, flat, ends in encoded(batches, enc, end_id):
            if len(flat) and int(flat.max()) >= VOCABULARY:
                raise ValueError("ids have 16 bits at most")
            counts += np.bincount(flat, minlength=VOCABULARY)
            raw, edges = flat.astype("<u2").tobytes(), [0, *ends.tolist()]
            k = range(len(docs))
            cols = [[part] * len(docs), [seq + i for i in k], docs, [start + edges[i] for i in k], [edges[i + 1] - edges[i] for i in k], [raw[2 * edges[i] : 2 * edges[i + 1]] for i in k], [None] * len(docs)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
            seq, start = seq + len(docs), start + edges[-1]
        if seq:
            last = (part, -1, None, start, 0, None, counts.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(last, schema, strict=True)], schema=schema)

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(VOCABULARY, np.int64)
    for batch in batches:
        for own in batch.column(0):
            total += np.frombuffer(own.as_buffer(), "<i8")
    have = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(have, pa.int32()), pa.array(total[have], pa.int64())], names=["id", "n"])


def _encode(freq: np.ndarray, bases: dict[int, int]):
    schema = pa.schema([("part", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()), *[(k, pa.binary()) for k in ("doc_ids", "no_id", "sizes", "words", "checkpoints")], ("checksum", pa.int64())])

    def block(rows: list[tuple], table: rans.Table) -> pa.RecordBatch:
        ids = np.concatenate([np.frombuffer(r[4], "<u2") for r in rows])
        words, checks, checksum = rans.encode(ids, table)
        docs = np.array([r[2] or 0 for r in rows], "<i8").tobytes()
        none = np.packbits([r[2] is None for r in rows]).tobytes()
        sizes = np.array([len(r[4]) // 2 for r in rows], "<u4").tobytes()
        row = (rows[0][0], bases[rows[0][0]] + rows[0][3], len(ids), docs, none, sizes, words, checks, checksum)
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, rows, size = rans.Table(freq), [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):  # part, seq, doc_id, start, ids
                if rows and (size >= rans.BLOCK_IDS or row[:2] != (rows[-1][0], rows[-1][1] + 1)):
                    yield block(rows, table)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4]) // 2
        if rows:
            yield block(rows, table)
        give_back()

    return run


def _decode(freq: np.ndarray, with_ids: bool):
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table(freq)
        for batch in batches:
            for b in batch.to_pylist():
                ids = rans.decode(b["words"], b["checkpoints"], b["n_ids"], table, b["checksum"]).astype("<u4")
                sizes = np.frombuffer(b["sizes"], "<u4").astype(np.int64)
                ends = np.cumsum(sizes)
                none = np.unpackbits(np.frombuffer(b["no_id"], np.uint8), count=len(sizes)).astype(bool)
                raw = [ids[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)]
                cols = [pa.array(np.frombuffer(b["doc_ids"], "<i8"), pa.int64(), mask=none), pa.array(b["start"] + ends - sizes), pa.array(sizes), pa.array([zlib.crc32(r) for r in raw], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols + ([pa.array(raw, pa.binary())] if with_ids else []), names=names + ["ids"] * with_ids)

    return run


def write_ids(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> None:
    """Writes the ids of docs(doc_id, text), each document's closed by end_id, below folder.

    `blocks` has self-contained blocks of whole documents in ascending doc_id order (rows that tie by text, nulls first),
    in a folder for each range of documents: folders by number, and files within one by their first start, ascend.
    `table` has the frequencies that all blocks share, which are counted over all ids. A null or empty text is the end
    id alone; an empty table writes no blocks. Both are Parquet containers, so any store that Spark reaches will do.
    There are at least spark.sql.shuffle.partitions ranges, and more by the bytes of the texts.
    On the way `ids` has the plain ids; the texts' shuffle is removed before blocks are written, and `ids` after.
    """
    bounded_batches(docs.sparkSession)
    spark = docs.sparkSession
    doc = F.col("doc_id").cast("long")
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    # the bounds come from a scan of doc_id alone; ranging by Spark would sample a scan of the texts
    bounds = docs.agg(F.percentile_approx(doc, [i / n for i in range(1, n)] or [0.5], 10 * n).alias("b")).first().b or []
    ordered = docs.select(doc.alias("doc_id"), "text").repartitionById(n, count_below(sorted(set(bounds)) if n > 1 else [], F.col("doc_id"))).sortWithinPartitions("doc_id", "text")
    # zstd takes a third off the 16-bit ids; a higher level costs twice the time for a tenth more
    with shuffles_dropped(spark):
        ordered.mapInArrow(_tokenise(path or vocabulary(), end_id), IDS).write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "1").parquet(f"{folder}/ids")
    ids = spark.read.schema(IDS).parquet(f"{folder}/ids")
    counts = ids.filter("counts IS NOT NULL").select("counts").mapInArrow(_count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts.write.parquet(f"{folder}/table")
    freq = _table(spark, folder)
    total, bases = 0, {}
    for r in ids.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():  # a row for each partition written
        bases[r.part], total = total, total + r.n
    blocks = ids.filter("seq >= 0").select("part", "seq", "doc_id", "start", "ids").mapInArrow(_encode(freq, bases), BLOCKS)
    blocks.sortWithinPartitions("part", "start").write.partitionBy("part").option("compression", "none").parquet(f"{folder}/blocks")
    drop_folder(spark, f"{folder}/ids")


def _table(spark, folder: str) -> np.ndarray:
    """The frequencies; as many rows as the vocabulary at most."""
    counts = np.zeros(VOCABULARY, np.int64)
    for r in spark.read.schema("id int, n long").parquet(f"{folder}/table").collect():
        counts[r.id] = r.n
    return rans.frequencies(counts)


def read_ids(spark, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document (and ids) decoded from the files; a bad checksum is an error."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").select("start", "n_ids", "doc_ids", "no_id", "sizes", "words", "checkpoints", "checksum")
    return blocks.mapInArrow(_decode(_table(spark, folder), with_ids), "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def op3(spark, sf_dir: str) -> DataFrame:
    folder = f"{staging(spark)}/ids-{uuid.uuid4().hex}"
    write_ids(documents(spark, sf_dir), folder)
    return read_ids(spark, folder)
