"""Structured streaming into a store: micro-batches that converge like whole imports and are recorded in the ledger once."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import converge, merge_upsert
from ..plans.files import Files


def files(spark: SparkSession, folder: str, schema: str, per_trigger: int = 16) -> DataFrame:
    """Parquet files as they arrive, so many at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


class BatchTarget:
    """A Parquet table that micro-batches are merged into: each batch writes a new version and then creates the state of
    its number, which can be there once, so a batch that is delivered again changes nothing."""

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.files, self.schema = spark, Files(spark, folder), schema

    def state(self) -> dict:
        last = max((n for n in self.files.names() if n.startswith("_batch-")), default=None)
        return json.loads(self.files.read(last)) if last else {"batch": -1, "version": None, "items": 0}

    def read(self) -> DataFrame:
        version = self.state()["version"]
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.files.path(version))

    def apply(self, batch: int, rows: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> bool:
        """Merges the batch unless it has been; returns whether it did."""
        now = self.state()
        if batch <= now["batch"]:
            return False
        version = f"v={batch}-{os.urandom(4).hex()}"
        merge(self.read(), rows).write.parquet(self.files.path(version))
        state = {"batch": batch, "version": version, "items": now["items"] + rows.count()}
        return self.files.create(f"_batch-{batch:012d}.json", json.dumps(state))


def upsert_stream(stream: DataFrame, target: BatchTarget, key: list[str], order: list[str], checkpoint: str, touched: str | None = None) -> StreamingQuery:
    """Upserts a stream by key until it has been read; of rows with one key in a batch the last by order counts."""

    def each(rows: DataFrame, batch: int) -> None:
        rest = [c for c in rows.columns if c not in key]
        last = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*key, "r.*").select(*rows.columns)
        target.apply(batch, last, lambda old, new: merge_upsert(old, new, key, touched, None))

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def converge_stream(stream: DataFrame, target: BatchTarget, root: str, key: list[str], checkpoint: str) -> StreamingQuery:
    """Replaces the relation sets of the roots that each batch brings; a row whose key columns are null only says that
    its root has no rows."""

    def each(rows: DataFrame, batch: int) -> None:
        touched = rows.select(F.col(root).alias("root")).distinct()
        rest = [c for c in key if c != root]
        target.apply(batch, rows.filter(F.coalesce(*[F.col(c).cast("string") for c in rest]).isNotNull()), lambda old, new: converge(old, new, root, key, touched))

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
