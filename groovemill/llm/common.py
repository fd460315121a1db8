"""What the training-data operators share: the shared folder, written tables, sized joins and word rules."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the word rule: a word is a run of other characters than these six.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: A side is broadcast only after its rows have been counted and are at most this many.
BROADCAST_ROWS = 200_000

#: Bytes of a batch between the engine and a Python worker.
BATCH_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where that is unset and driver
    and executors are one process (tests). Elsewhere it has to be set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = os.path.join(tempfile.gettempdir(), "checkpoints")
    return found.rstrip("/")


def staging(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_dir(spark)}/groovemill/{spark.sparkContext.applicationId}"


def drop_staged(spark: SparkSession) -> bool:
    """Removes all tables that this application has staged; results that still read them are lost."""
    return drop_folder(spark, staging(spark))


def drop_folder(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within, the shuffles of a query are removed as it ends, not when the driver next collects garbage. For writes: what
    is read again is in files."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    found = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if found is None else spark.conf.set(key, found)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Writes df as Parquet under the shared folder and reads it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{staging(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most so many rows; reads no more than one row beyond that."""
    return df.limit(rows + 1).count() <= rows


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df, marked for broadcast if a count shows it small; beyond that the join shuffles and adaptive execution splits hot keys."""
    return F.broadcast(df) if is_small(df, rows) else df


class IdFilter:
    """A Bloom filter over longs with at most MOST_BITS bits, built by partial bitmaps: whatever is in it passes, and of
    other values less than one in 200 while it is sharp. It goes to tasks inside their function."""

    MOST_BITS = 1 << 29
    HASHES = 4

    def __init__(self, bits: int, sharp: bool):
        self.bits, self.sharp, self.data = bits, sharp, np.zeros(bits // 8, np.uint8)

    @classmethod
    def of(cls, ids: DataFrame) -> IdFilter:
        """The filter of a column of longs that aren't null."""
        n = ids.count()
        out = cls(min(cls.MOST_BITS, max(1 << 15, 1 << (16 * n).bit_length())), 12 * n <= cls.MOST_BITS)
        places, bits = out.places, out.bits

        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array(places(batch.column(0).to_numpy(zero_copy_only=False), bits).ravel() + 1)], names=["place"])

        found = ids.mapInArrow(run, "place long").groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        for r in found.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("part")).toLocalIterator():
            out.data[(r.bucket - 1) * 4096 : r.bucket * 4096] |= np.frombuffer(r.part, np.uint8)
        return out

    @staticmethod
    def places(ids: np.ndarray, bits: int) -> np.ndarray:
        """The places of each value, bits being a power of two."""
        h = ids.astype(np.int64).view(np.uint64)[:, None] + np.arange(1, IdFilter.HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for _ in range(2):
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return ((h ^ (h >> np.uint64(32))) & np.uint64(bits - 1)).astype(np.int64)

    def has(self, ids: np.ndarray) -> np.ndarray:
        at = self.places(ids, self.bits)
        return ((self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def count_below(bounds: list[int], value: Column) -> Column:
    """How many of the ascending bounds are less than value, by halving in an array literal; none for a null."""
    if not bounds:
        return F.lit(0)
    ends = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda acc, s: F.when(F.get(ends, acc + s - 1) < value, acc + s).otherwise(acc))


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def guarded(df: DataFrame, *needed: str):
    """(df, back): df with all columns but the needed ones under names that nothing else has, and a function that selects
    df's own columns again, in their order, with new ones after them; a new column replaces an own one of its name."""
    hidden = {c: f"gm_own_{i}" for i, c in enumerate(df.columns) if c not in needed}

    def back(out: DataFrame, *new: str) -> DataFrame:
        own = [F.col(f"`{hidden.get(c, c)}`").alias(c) for c in df.columns if c not in new]
        return out.select(*own, *[F.col(f"`{c}`") for c in new])

    return df.select(*[F.col(f"`{c}`").alias(hidden.get(c, c)) for c in df.columns]), back


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the bytes of a batch that goes to a Python worker: by default only rows are bounded tightly, and long
    texts make batches of hundreds of megabytes on both sides."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    found = spark.conf.get(key, None)
    if not found or not found.isdigit() or int(found) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def give_back() -> None:
    """Returns memory that a Python worker has freed to the system; workers live on between stages."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries than glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
