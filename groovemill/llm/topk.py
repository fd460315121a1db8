"""Exact top-k search over binary codes by incremental multi-index hashing."""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sized, staged

K = 10
BITS = 64
#: Codes and queries of a task at most; fuller cells of the index are split, and a cell that more queries probe is searched by
#: several tasks.
BLOCK_CODES = 32_768
BLOCK_QUERIES = 32_768
#: Candidates held at once.
CHUNK = 2_000_000


def sign_code(vector: Column, bits: int = BITS) -> Column:
    """The signs of the first `bits` components as a long, the first in the lowest bit; a component that isn't positive,
    null or missing is 0, NaN is 1 as it is ordered above all numbers. A null vector gives null."""
    bit = lambda i: F.when(F.get(vector, F.lit(i)) > 0, F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long"))
    out = bit(0)
    for i in range(1, bits):
        out = out.bitwiseOR(bit(i))
    return F.when(vector.isNotNull(), out)


def segments(n: int, bits: int = BITS) -> list[tuple[int, int]]:
    """(shift, width) of the segments: about log2(n) bits each, from 4 to 16."""
    width = min(16, max(4, int(np.log2(max(n, 2)))))
    count = -(-bits // width)
    edges = [bits * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def probe(codes: np.ndarray, low: np.ndarray, queries: np.ndarray, bound: np.ndarray, part: tuple[int, int], radius: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, code, distance) indexes of the k best codes of each query, by distance and then low, among those whose
    segment `part` differs from the query's in exactly `radius` bits and which are within the query's bound."""
    shift, width = part
    cut = lambda x: ((x >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
    value = cut(codes)
    order = np.argsort(value, kind="stable")
    values, starts = np.unique(value[order], return_index=True)
    starts = np.append(starts, len(order))
    few = math.comb(width, radius) < len(values)
    masks = np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], np.int64) if few else None
    out, step = [], max(1, CHUNK // max(1, len(codes)))
    for at in range(0, len(queries), step):
        own = queries[at : at + step]
        if few:
            asked = cut(own)[:, None] ^ masks
            place = np.minimum(np.searchsorted(values, asked), len(values) - 1)
            q, column = np.nonzero(values[place] == asked)
            found = place[q, column]
        else:
            q, found = np.nonzero(np.bitwise_count(cut(own)[:, None] ^ values) == radius)
        size = starts[found + 1] - starts[found]
        ends = np.cumsum(size)
        code = order[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[found] - ends + size, size)]
        q = np.repeat(q, size) + at
        d = np.bitwise_count(codes[code] ^ queries[q]).astype(np.int64)
        keep = d <= bound[q]
        q, code, d = q[keep], code[keep], d[keep]
        best = np.lexsort((low[code], d, q))
        q, code, d = q[best], code[best], d[best]
        first = np.concatenate([[0], np.cumsum(np.bincount(q - at, minlength=len(own)))])
        keep = np.arange(len(q)) - first[q - at] < k
        out.append((q[keep], code[keep], d[keep]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else tuple(np.empty(0, np.int64) for _ in range(3))


_FOUND = "query long, code long, n long, low long, distance long"


def _task(parts: list[tuple[int, int]], radius: int, k: int):
    def run(table: pa.Table) -> pa.Table:
        asks = table["bound"].is_valid().to_numpy(zero_copy_only=False)
        code = table["code"].to_numpy().view(np.uint64)
        rows, own = np.flatnonzero(~asks), np.flatnonzero(asks)
        n, low, bound = (pa.compute.fill_null(table[c], 0).to_numpy() for c in ("n", "low", "bound"))
        q, c, d = probe(code[rows], low[rows], code[own], bound[own], parts[table["seg"][0].as_py()], radius, k) if len(rows) and len(own) else [np.empty(0, np.int64)] * 3
        names = ("query", "code", "n", "low", "distance")
        cols = (code[own][q].view(np.int64), code[rows][c].view(np.int64), n[rows][c], low[rows][c], d)
        return pa.table({k: pa.array(v, pa.int64()) for k, v in zip(names, cols, strict=True)})

    return run


def _index(entries: DataFrame, parts: list[tuple[int, int]], high: int) -> DataFrame:
    """entries once for each segment: seg, part (the high bits of the segment's value), cell, code, n, low, written to the
    shared folder. A part with more than BLOCK_CODES codes is dealt into cells by their hash."""
    rows = entries.withColumn("at", F.explode(F.array(*[F.struct(F.lit(i).alias("seg"), _part(F.col("code"), p, high).alias("part")) for i, p in enumerate(parts)])))
    rows = rows.select("at.seg", "at.part", "code", "n", "low")
    cells = staged(rows.groupBy("seg", "part").agg(F.ceil(F.count("*") / BLOCK_CODES).cast("int").alias("cells")), "cells")
    rows = rows.join(sized(cells), ["seg", "part"])
    return staged(rows.select("seg", "part", F.pmod(F.xxhash64("code"), F.col("cells")).cast("int").alias("cell"), "code", "n", "low"), "index")


def _part(code: Column, part: tuple[int, int], high: int) -> Column:
    shift, width = part
    return F.shiftrightunsigned(code, shift + width - high).bitwiseAND(F.lit((1 << high) - 1)).cast("int")


def _probes(active: DataFrame, cells: DataFrame, parts: list[tuple[int, int]], high: int, radius: int) -> DataFrame:
    """seg, part, cell, code, bound: the cells that may hold codes whose segment differs from a query's in radius bits."""
    masks = F.sequence(F.lit(0), F.lit((1 << high) - 1))
    near = lambda i, p: F.transform(F.filter(masks, lambda x: (F.bit_count(x) <= radius) & (F.bit_count(x) >= radius - p[1] + high)), lambda x: F.struct(F.lit(i).alias("seg"), x.bitwiseXOR(_part(F.col("code"), p, high)).alias("part")))
    where = F.concat(*[near(i, p) for i, p in enumerate(parts)])
    asked = active.withColumn("at", F.explode(where)).select("at.seg", "at.part", "code", "bound")
    return asked.join(sized(cells.select("seg", "part", "cell")), ["seg", "part"])


def top_k(rows: DataFrame, queries: DataFrame, k: int = K, bits: int = BITS) -> DataFrame:
    """The k nearest rows of each query by Hamming distance: query_id, rank from 1, row_id, distance; ties go to the smaller row_id.

    rows and queries have (id, code). Rows with one code are one entry with their number and their smallest id. The index
    holds each distinct code once for each segment, in the cell of the segment's high bits. In round s each open query
    goes to the cells that can hold codes whose segment differs from its own in s bits; they are verified there and the
    k best of a cell come back: k codes by distance and smallest id hold the k best rows. After round s with m segments
    every code within m * (s + 1) - 1 has been met, so a query is done, and leaves the search, once its kth row is within
    that distance. With fewer than k rows all are returned. Rows with a null id or code are left out; a row is
    among its own results if it is in rows; a repeated row is there as often as it occurs; empty tables give no rows.
    """
    spark = rows.sparkSession
    rows, queries = (x.filter("id IS NOT NULL AND code IS NOT NULL").select("id", "code") for x in (rows, queries))
    entries = staged(rows.groupBy("code").agg(F.count("*").alias("n"), F.min("id").alias("low")), "codes")
    size = entries.agg(F.count("*").alias("codes"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    parts = segments(size.codes, bits)
    most = min(w for _, w in parts)
    wanted = max(size.codes / BLOCK_CODES, 2 * spark.sparkContext.defaultParallelism / len(parts), 1)
    high = min(most, math.ceil(math.log2(wanted)))
    index = _index(entries, parts, high)
    cells = staged(index.select("seg", "part", "cell").distinct(), "cells")
    active = staged(queries.select("code").distinct().withColumn("bound", F.lit(bits).cast("long")), "asked")
    best, done = spark.createDataFrame([], _FOUND), []
    nearer = Window.partitionBy("query").orderBy("distance", "low")
    for radius in range(max(w for _, w in parts) + 1):
        probes = staged(_probes(active, cells, parts, high, radius), "probes")
        load = probes.groupBy("seg", "part", "cell").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("blocks"))
        load = sized(staged(load, "load"))
        at = ["seg", "part", "cell"]
        left = index.join(load, at).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*at, "block", "code", "n", "low", F.lit(None).cast("long").alias("bound"))
        none = F.lit(None).cast("long")
        right = probes.join(load, at).select(*at, F.pmod(F.xxhash64("code"), F.col("blocks")).cast("int").alias("block"), "code", none.alias("n"), none.alias("low"), "bound")
        found = left.unionByName(right).groupBy(*at, "block").applyInArrow(_task(parts, radius, k), _FOUND)
        both = best.unionByName(found).dropDuplicates(["query", "code"])
        both = both.withColumn("place", F.row_number().over(nearer)).filter(F.col("place") <= k)
        both = staged(both.withColumn("before", F.sum("n").over(nearer) - F.col("n")).filter(F.col("before") < k).select("query", "code", "n", "low", "distance"), "best")
        state = both.groupBy("query").agg(F.sum("n").alias("have"), F.max("distance").alias("kth"))
        covered = len(parts) * (radius + 1) - 1
        state = active.select("code").join(state, F.col("code") == F.col("query"), "left")
        enough = F.coalesce(F.col("have"), F.lit(0)) >= min(k, size.rows)
        state = staged(state.select("code", F.when(enough, F.col("kth")).otherwise(F.lit(bits)).cast("long").alias("bound"), (enough & (F.coalesce(F.col("kth"), F.lit(0)) <= covered)).alias("done")), "state")
        done.append(both.join(state.filter("done").select("code"), both["query"] == state["code"], "left_semi"))
        active = state.filter("NOT done").select("code", "bound")
        if active.isEmpty():
            break
        best = both.join(active.select(F.col("code").alias("still")), F.col("query") == F.col("still"), "left_semi")
    nearest = reduce(DataFrame.unionByName, done).select(F.col("query").alias("query_code"), "code", "distance")
    smallest = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    ids = rows.withColumn("place", smallest).filter(F.col("place") <= k).select("code", F.col("id").alias("row_id"))
    closest = F.row_number().over(Window.partitionBy("query_code").orderBy("distance", "row_id"))
    out = nearest.join(ids, "code").withColumn("rank", closest).filter(F.col("rank") <= k)
    asked = queries.select(F.col("id").alias("query_id"), F.col("code").alias("query_code"))
    return asked.join(out.drop("code"), "query_code").select("query_id", "rank", "row_id", F.col("distance").cast("int").alias("distance"))


def op7(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), sign_code(F.col("embedding")).alias("code"))
    return top_k(rows, rows.filter(F.col("id") % 20 == 0))


OP7_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS b FROM embeddings
), d AS (
  SELECT q.vec_id AS query_id, r.vec_id AS row_id, list_sum(list_transform(list_zip(q.b, r.b), lambda x: abs(x[1] - x[2])))::INT AS distance
  FROM e q, e r WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, row_id)::INT AS rank, row_id, distance
FROM d QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, row_id) <= 10
"""
