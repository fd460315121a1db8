"""Operators of DataFrames: mixing, host rules, sharding, line dedup, against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from groovemill.llm import lines, mixing, quality, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fill(sizes, weights, cap):
    """Water-filling by repeated clamping and proportional redistribution."""
    total, capped = sum(sizes), [False] * len(sizes)
    target = [0.0] * len(sizes)
    while True:
        free = sum(w for w, c in zip(weights, capped) if not c)
        rest = total - sum(cap * s for s, c in zip(sizes, capped) if c)
        target = [cap * s if c else rest * w / free for s, w, c in zip(sizes, weights, capped)] if free else [float(cap * s) for s in sizes]
        over = [not c and x > cap * s for x, s, c in zip(target, sizes, capped)]
        if not any(over):
            return target
        capped = [c or o for c, o in zip(capped, over)]


@pytest.mark.parametrize("sizes", [[10, 1000, 5], [1, 1, 1, 1000], [100] * 7, [0, 5, 50], [7]])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(i, f"s{k}", 1) for k, s in enumerate(sizes) for i in range(s)] + [(0, f"s{k}", 0) for k in range(len(sizes))], "doc_id long, source string, size long")
    got = [r.target for r in mixing.source_targets(rows).orderBy("source").collect()]
    want = fill(sizes, [1 + k % 3 for k in range(len(sizes))], 3)
    assert all(math.isclose(a, b, abs_tol=1e-6) for a, b in zip(got, want, strict=True))


def test_mix(docs, nothing):
    rows = docs.select("*").drop("size").withColumn("size", F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long"))
    out = mixing.mix(rows)
    assert out.columns == [*rows.columns, "source_size", "target", "taken"]
    got = out.collect()
    assert len(got) == docs.count()
    by = defaultdict(list)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        by[r.source].append(r)
    for own in by.values():
        assert abs(sum(r.taken for r in own) - own[0].target) <= 4 and own[0].source_size == sum(r.size for r in own)
    again = mixing.mix(rows.repartition(7)).collect()
    key = lambda r: (repr(r.doc_id), repr(r.text), r.taken)
    assert sorted(map(key, again)) == sorted(map(key, got))
    assert mixing.mix(nothing.drop("size").withColumn("size", F.lit(1).cast("long"))).collect() == []


def rules(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    with_word = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(with_word) - len(set(with_word)), len(hit)


def test_base_rules(spark, docs, nothing):
    extra = [(100, "a b c d e f g h i a b c d e f g h x # $"), (101, "x y\nx y\n\n\nz"), (102, " ".join("abcdefgh") + " " + " ".join("abcdefgh")), (103, "a " * 17)]
    rows = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    for r in quality.base_rules(rows).collect():
        want = rules(r.text or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.text
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
    judged = quality.judge(docs)
    assert judged.count() == docs.count() and not judged.filter("base_failed AND kept").count()
    assert quality.judge(nothing).collect() == []


def test_host_verdicts(spark):
    rows = [("bad", True)] * 95 + [("bad", False)] * 5 + [("tiny", True)] + [(None, False)] * 50 + [(f"h{k}", k % 4 == 0) for k in range(40) for _ in range(20)]
    got = {r.host: r for r in quality.host_verdicts(spark.createDataFrame(rows, "source string, base_failed boolean")).collect()}
    assert not got["bad"].host_kept and got[None].host_kept and got["h1"].host_kept
    assert got["tiny"].shrunk_rate < 1.0 and got["bad"].n == 100
    same = quality.host_verdicts(spark.createDataFrame([("a", False), ("b", False)], "source string, base_failed boolean"))
    assert all(r.host_kept and r.shrunk_rate == 0 for r in same.collect())


def test_host_verdicts_hold_at_every_size(spark):
    """A hot host of a third of the rows that fails beside many small ones: equal shares, equal verdicts."""
    for times in (1, 20):
        rows = [("hot", k < 90 * times) for k in range(100 * times)] + [(f"h{k}", k % 10 == 0) for k in range(200 * times)]
        got = {r.host: r for r in quality.host_verdicts(spark.createDataFrame(rows, "source string, base_failed boolean")).collect()}
        assert not got["hot"].host_kept and 0.85 < got["hot"].shrunk_rate <= 0.9 and got["h1"].host_kept


@pytest.mark.parametrize("slack", [0.0, 0.25])
def test_shards(spark, docs, slack):
    rows = spark.range(0, 5003).select(F.col("id").alias("doc_id"), F.lit("x").alias("shard"))
    out = sharding.shard(rows, "doc_id", 8, slack).collect()
    assert sorted(r.doc_id for r in out) == list(range(5003))
    counts = Counter(r.shard for r in out)
    if slack:
        assert max(counts.values()) <= math.ceil(1.25 * 5003 / 8)
    else:
        assert max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in out if r.shard == s) == list(range(n))
    assert {(r.doc_id, r.shard, r.slot) for r in sharding.shard(rows.repartition(5), "doc_id", 8, slack).collect()} == {(r.doc_id, r.shard, r.slot) for r in out}


def test_shards_follow_the_ring_and_move_little(spark):
    rows = spark.range(0, 20000).select(F.col("id").alias("doc_id"), F.shiftrightunsigned(F.xxhash64("id"), 2).alias("pos"))
    loose = {r.doc_id: r for r in sharding.shard(rows, "doc_id", 8, 9.0).collect()}
    nodes = sharding.ring(8)
    assert all(r.shard == sharding.owner(r.pos, nodes) for r in loose.values())
    for slack, most in ((0.25, 0.35), (9.0, 0.2)):
        a = {r.doc_id: r.shard for r in sharding.shard(rows, "doc_id", 8, slack).collect()}
        b = {r.doc_id: r.shard for r in sharding.shard(rows, "doc_id", 9, slack).collect()}
        moved = sum(a[i] != b[i] for i in a) / len(a)
        assert moved < most
    assert sharding.fill([5, 0, 3], [[0, 1], [1, 0], [1, 0]], [4, 4]) == [[(0, 4), (1, 1)], [], [(1, 3)]]


def test_shards_of_odd_rows(docs, nothing):
    out = sharding.shard(docs, "doc_id", 4)
    counts = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert out.count() == docs.count() and max(counts) - min(counts) <= 1
    assert sharding.shard(nothing, "doc_id", 4).collect() == []
    with pytest.raises(ValueError):
        sharding.shard(docs, "doc_id", 0)


def dedup(rows, min_chars, min_docs):
    """(doc_id, text) rows to their kept texts."""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOW)
    own = [(-(2**63) if i is None else i, x or "") for i, x in rows]
    found = defaultdict(set)
    for i, x in own:
        for line in x.split("\n"):
            if len(key(line)) >= min_chars:
                found[key(line)].add(i)
    gone = {k: max(v) for k, v in found.items() if len(v) >= min_docs}
    return Counter((i, "\n".join(y for y in x.split("\n") if key(y) not in gone or gone[key(y)] == i)) for i, x in own)


@pytest.mark.parametrize("hot", [2, 10**9])
def test_lines(docs, nothing, hot):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = lines.dedup_lines(docs, hot_lines=hot)
    assert set(docs.columns) - {"d", "t"} <= set(got.columns)
    out = got.select("doc_id", "text", "gm_kept", "gm_dropped").collect()
    assert Counter((-(2**63) if r.doc_id is None else r.doc_id, r.gm_kept) for r in out) == dedup(rows, 20, 3)
    assert sum(r.gm_dropped for r in out) > 3
    assert lines.dedup_lines(nothing).collect() == []
    runs = lines.bitmaps(docs.sparkSession.createDataFrame([(1, 1, p) for p in (4, 0, 1, 9, 1)], "d long, t long, position int")).first()
    assert (runs.keep_bitmap, runs.n_dropped) == ([0, 2, 4, 5, 9, 10], 4)


def test_line_bitmap_round_trip(spark):
    for gone in ([], [0], [2], [0, 1, 2], [1, 2], [0, 2]):
        edges = [e for i in gone for e in (i, i + 1)]
        df = spark.createDataFrame([("a\n\nc", edges or None)], "text string, b array<int>")
        kept = df.select(lines.keep_lines(lines.split_lines(F.col("text")), F.col("b")).alias("k")).first().k
        assert kept == "\n".join(x for i, x in enumerate(["a", "", "c"]) if i not in gone)


def test_digests(docs):
    out = docs.select("doc_id", "text", F.crc32(F.coalesce("text", F.lit(""))).alias("c"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("s")).collect()
    assert all(r.c == zlib.crc32((r.text or "").encode()) and r.s == hashlib.sha256((r.text or "").encode()).hexdigest() for r in out)


def test_staged_tables_can_be_dropped(spark, docs):
    from groovemill.llm.common import drop_staged, staged

    df = staged(docs.select("doc_id"), "x")
    assert df.count() == docs.count()
    assert drop_staged(spark) and not drop_staged(spark)
