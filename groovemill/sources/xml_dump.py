"""Scans of XML dumps and their windows of source items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import chunk_count
from ..schemas import DUMP


def read_dump(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """The root elements of a dump, gzip or plain, every leaf a string, with `ordinal`, their place in the source.

    Unknown elements are ignored. A gzip file is one partition, so the ordinal is its row number; parts of a plain file
    are told apart by partition and still ascend in source order.
    """
    rows = spark.read.schema(DUMP[entity]).option("rowTag", entity).xml(path)
    return rows.withColumn("ordinal", F.monotonically_increasing_id())


def dense_ordinals(rows: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """rows with gapless ordinals from 0: counts by partition are summed on the driver, rows are never gathered."""
    part = F.shiftright(F.col(ordinal), 33)
    counts = {r["p"]: r["n"] for r in rows.groupBy(part.alias("p")).count().withColumnRenamed("count", "n").collect()}
    base, before = {}, 0
    for p in sorted(counts):
        base[p], before = before, before + counts[p]
    if list(base) in ([], [0]):  # as of a gzip dump: the stored column itself, whose filters reach the scan
        return rows
    shift = F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in base.items() for x in kv]), part)
    return rows.withColumn(ordinal, shift + F.col(ordinal).bitwiseAND((1 << 33) - 1))


def chunk_index(ordinal: Column, size: int) -> Column:
    return F.floor(ordinal / F.lit(size)).cast("long")


def source_chunks(rows: DataFrame, size: int, ordinal: str = "ordinal") -> DataFrame:
    """(chunk_index, first_item_index, item_count): contiguous windows of source items by count."""
    if size < 1:
        raise ValueError("a chunk holds at least one item")
    index = chunk_index(F.col(ordinal), size).alias("chunk_index")
    return rows.groupBy(index).agg(F.min(ordinal).alias("first_item_index"), F.count("*").alias("item_count"))


def expected_chunks(total: Column, size: int) -> Column:
    return chunk_count(total, size)
