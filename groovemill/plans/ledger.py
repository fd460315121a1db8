"""The ledger of chunks: what has been committed, whether all of it is, and what a resumed run may skip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import chunk_count
from ..operators.merge import insert_ignore

CHUNK_KEY = ("import_run_id", "entity_type", "chunk_index")


def record(ledger: DataFrame, chunks: DataFrame) -> DataFrame:
    """The ledger with chunks it lacks: recording twice is recording once."""
    return insert_ignore(ledger, chunks, CHUNK_KEY)


def of_run(ledger: DataFrame, run: int, entity: str) -> DataFrame:
    return ledger.filter((F.col("import_run_id") == run) & (F.col("entity_type") == entity))


def completed(ledger: DataFrame, run: int, entity: str) -> DataFrame:
    """Chunks that a run has committed, by index."""
    return of_run(ledger, run, entity).orderBy("chunk_index")


def summary(ledger: DataFrame) -> DataFrame:
    """total_chunks and total_items of each run and entity."""
    return ledger.groupBy("import_run_id", "entity_type").agg(F.count("*").alias("total_chunks"), F.coalesce(F.sum("item_count"), F.lit(0)).alias("total_items"))


def invalid_chunk(total: Column, size: Column) -> Column:
    """Whether a chunk lies outside the expected windows or isn't as long as its window."""
    chunks = chunk_count(total, size)
    wanted = F.when(F.col("chunk_index") == chunks - 1, total - F.col("first_item_index")).otherwise(size)
    return (F.col("chunk_index") >= chunks) | (F.col("first_item_index") != F.col("chunk_index") * size) | (F.col("item_count") != wanted)


def coverage(ledger: DataFrame, totals: DataFrame) -> DataFrame:
    """For totals(import_run_id, entity_type, total, chunk_size): completed_chunks, completed_items, invalid_chunks and
    is_complete, true if the chunks cover exactly the source items. No items need no chunks."""
    keys = ["import_run_id", "entity_type"]
    rows = totals.join(ledger, keys, "left")
    here = F.col("chunk_index").isNotNull()
    out = rows.groupBy(*keys, "total", "chunk_size").agg(
        F.count("chunk_index").alias("completed_chunks"),
        F.coalesce(F.sum("item_count"), F.lit(0)).alias("completed_items"),
        F.count_if(here & invalid_chunk(F.col("total"), F.col("chunk_size"))).alias("invalid_chunks"),
    )
    full = (F.col("completed_chunks") == chunk_count(F.col("total"), F.col("chunk_size"))) & (F.col("completed_items") == F.col("total")) & (F.col("invalid_chunks") == 0)
    return out.withColumn("is_complete", full)


def remaining(rows: DataFrame, done: DataFrame) -> DataFrame:
    """rows(chunk_index, ...) of chunks that aren't done."""
    return rows.join(done.select("chunk_index"), "chunk_index", "left_anti")


def mismatched(chunks: DataFrame, done: DataFrame) -> DataFrame:
    """Chunks whose window differs from the one on record: a reason not to resume."""
    d = done.select("chunk_index", F.col("first_item_index").alias("d_first"), F.col("item_count").alias("d_count"))
    return chunks.join(d, "chunk_index").filter("first_item_index <> d_first OR item_count <> d_count").drop("d_first", "d_count")


def transferred(ledger: DataFrame, source: int, target: int) -> DataFrame:
    """The ledger after a failed run's chunks have gone over to the run that resumes it."""
    moved = F.when(F.col("import_run_id") == source, F.lit(target)).otherwise(F.col("import_run_id"))
    return ledger.withColumn("import_run_id", moved.cast("long"))


def progress(done: int, total: int | None, seconds: float) -> dict[str, float | None]:
    """Items per second and percent; of no items all are done."""
    percent = None if total is None else 100.0 if total == 0 else 100.0 * done / total
    return {"items_per_second": done / seconds if seconds > 0 else 0.0, "percent": percent}
