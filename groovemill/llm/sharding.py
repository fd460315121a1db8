"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only."""

from __future__ import annotations

import bisect
import hashlib
import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import count_below, documents

#: Virtual nodes of a shard, and pieces into which the keys of an arc are dealt; shards * VNODES * PIECES bounds the table that is collected and broadcast.
VNODES = 64
PIECES = 16
_SPAN = 1 << 62


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(position, shard) of all virtual nodes by position. A shard's nodes don't depend on the number of shards."""
    at = lambda s, v: int.from_bytes(hashlib.sha256(f"shard {s} node {v}".encode()).digest()[:8], "big") % _SPAN
    return sorted((at(s, v), s) for s in range(shards) for v in range(vnodes))


def preferences(nodes: list[tuple[int, int]]) -> list[list[int]]:
    """For the arc that ends at each node, the shards clockwise from it, each once."""
    return [list(dict.fromkeys(s for _, s in nodes[i:] + nodes[:i])) for i in range(len(nodes))]


def fill(counts: list[int], wishes: list[list[int]], room: list[int]) -> list[list[tuple[int, int]]]:
    """(shard, keys) segments of each arc. In each round every arc offers the keys it still holds to its next shard
    clockwise; a full shard turns the rest on. Only counts of arcs are looked at, not keys."""
    left, room, out = list(counts), list(room), [[] for _ in counts]
    for r in range(len(room)):
        for arc, wish in enumerate(wishes):
            if left[arc] and (n := min(left[arc], room[wish[r]])):
                out[arc].append((wish[r], n))
                left[arc] -= n
                room[wish[r]] -= n
    return out


def capacities(total: int, shards: int, slack: float) -> list[int]:
    """Most keys of each shard: at slack 0 they sum to total and differ by one at most, else ceil((1 + slack) * mean)."""
    if slack > 0:
        return [-int(-(1 + slack) * total // shards)] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def shard(rows: DataFrame, key: str, shards: int = 8, slack: float = 0.0, vnodes: int = VNODES, pieces: int = PIECES) -> DataFrame:
    """rows with shard (int) and slot (long, gapless from 0 within each shard).

    A key's position on the ring is its hash; it belongs to the next virtual node clockwise, and keys that find a shard
    full go on clockwise to the next one with room. A shard holds at most capacities() rows, so balance is guaranteed;
    which keys of an arc overflow is decided by their hash, so reruns agree. One aggregation counts the keys of each
    piece of an arc; the table of arcs has a fixed size, and the keys are then ranked within pieces, never by shard.
    Rows with one key (copies) and null keys are dealt by rank over the pieces of an arc too. An empty table gives no rows.
    """
    if not 0 < shards * vnodes * pieces <= 200_000:
        raise ValueError("shards * vnodes * pieces must be from 1 to 200000")
    nodes = ring(shards, vnodes)
    names = rows.columns
    h = F.coalesce(F.xxhash64(F.col(key)), F.lit(0))
    at = rows.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), h.alias("h"), F.shiftrightunsigned(h, 2).alias("pos"))
    at = at.withColumn("arc", count_below([p for p, _ in nodes], F.col("pos")))
    at = at.withColumn("arc", F.pmod(F.col("arc"), F.lit(len(nodes))))
    # copies of a key are dealt over the pieces as well: the piece comes from where the row was read
    at = at.withColumn("piece", F.pmod(F.xxhash64("h", F.struct("row.*")), F.lit(pieces)).cast("int"))
    found = {(r.arc, r.piece): r.n for r in at.groupBy("arc", "piece").agg(F.count("*").alias("n")).collect()}
    counts = [sum(found.get((a, p), 0) for p in range(pieces)) for a in range(len(nodes))]
    segments = fill(counts, preferences(nodes), capacities(sum(counts), shards, slack))
    base, used = [], [0] * shards
    for a, parts in enumerate(segments):
        start, ranges = 0, []
        for s, n in parts:
            ranges.append({"first": start, "upto": start + n, "s": s, "slot": used[s] - start})
            start, used[s] = start + n, used[s] + n
        before = 0
        for p in range(pieces):
            if n := found.get((a, p), 0):
                base.append({"a": a, "p": p, "before": before, "ranges": ranges})
                before += n
    table = rows.sparkSession.range(1, numPartitions=1).select(F.explode(F.from_json(F.lit(json.dumps(base)), "array<struct<a:int,p:int,before:long,ranges:array<struct<first:long,upto:long,s:int,slot:long>>>>")).alias("t")).select("t.*")
    rank = F.row_number().over(Window.partitionBy("arc", "piece").orderBy("h", *[F.col(f"row.`{f.name}`") for f in rows.schema if f.dataType.typeName() not in ("map", "variant")])) - 1
    out = at.withColumn("rank", rank).join(F.broadcast(table), (F.col("arc") == F.col("a")) & (F.col("piece") == F.col("p")))
    out = out.withColumn("rank", F.col("rank") + F.col("before"))
    out = out.withColumn("in", F.element_at(F.filter("ranges", lambda x: (x["first"] <= F.col("rank")) & (F.col("rank") < x["upto"])), 1))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in names if c not in ("shard", "slot")], F.col("in.s").alias("shard"), (F.col("in.slot") + F.col("rank")).alias("slot"))


def owner(position: int, nodes: list[tuple[int, int]]) -> int:
    """The shard of the first node at or after the position; for tests."""
    return nodes[bisect.bisect_left(nodes, (position, -1)) % len(nodes)][1]


def op8(spark, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents(spark, sf_dir).select("doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shard(rows, "doc_id", 8).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
