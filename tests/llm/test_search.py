"""URL rules, top-k search and the pipeline."""

import glob
import os
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from groovemill.llm import queries, topk, urls

from .conftest import prose

DATA = "/root/testdata/sf0.001"


def judged(url, rules=urls.RULES):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    best = None
    for action, rule in rules:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            best = max(best or (0, False, ""), (len(rule), action == "block", rule))
    return host, path, best and best[2], ("block" if best[1] else "allow") if best else "allow"


URLS = [
    None, "", "nothing", "http://", "http:///x", "HTTP://WWW.Example.COM/en/1?q#f", "https://a.example.com/en/", "https://example.com/EN/", "ftp://example.com", "x://example.com?/en/", "x://example.com#/en/", "http://notexample.com/en/x",
    "http://a.net/es/1", "http://net/fr/", "http://a.net/de/", "http://a..com/", "http://.com/", "http://user@x.com:80/en/?a://b", "http://É.NET/es/é", "a://b://c.com/", "http://www.example.com/en/\n",
]


def test_url_rules(spark):
    rows = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)], "page_id long, url string, host string, keys string")
    for r in urls.judge(rows).collect():
        assert (r.host, r.path, r.rule, r.verdict) == judged(URLS[r.page_id]), URLS[r.page_id]
    assert urls.judge(rows.limit(0)).collect() == []
    with pytest.raises(ValueError):
        urls.judge(rows, [("deny", "a/")])


def test_url_rules_on_long_hosts(spark):
    hosts = ["." * 100_000, "a." * 50_000 + "net", "b" * 100_000 + ".example.com", ".".join(["example"] * 30_000) + ".com"]
    rows = [(i, f"http://{h}/en/{'x' * 50_000}") for i, h in enumerate(hosts)]
    for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect():
        assert (r.host, r.path, r.rule, r.verdict) == judged(rows[r.page_id][1])
    with pytest.raises(ValueError):
        urls.judge(spark.createDataFrame(rows, "page_id long, url string"), [("block", f"{i}/") for i in range(urls.MOST_RULES + 1)])


def test_cascade_is_exact():
    rng = np.random.default_rng(4)
    universe = [f"k{i}" for i in range(20_000)]
    for size in (0, 1, 50, 3000):
        listed = [universe[i] for i in rng.choice(len(universe), size, replace=False)]
        own = set(listed)
        cascade = urls.Cascade.start(listed, len(universe))
        passed = cascade.levels[0].has(urls.pairs(universe, 0))
        cascade.close(listed, [k for k, p in zip(universe, passed) if p and k not in own])
        assert cascade.has(universe).tolist() == [k in own for k in universe]


def test_many_rules(spark):
    hosts = [f"h{i}.com" for i in range(60)]
    rows = spark.createDataFrame([(i, f"http://www.{h}/{'ab'[i % 2]}/{i}") for i, h in enumerate(hosts * 5)], "page_id long, url string")
    rules = [("block" if i % 3 else "allow", f"h{i}.com/{'a/' if i % 2 else ''}") for i in range(40)]
    for r in urls.judge(rows, rules).collect():
        host, path, rule, verdict = judged(f"http://www.{hosts[r.page_id % 60]}/{'ab'[r.page_id % 2]}/{r.page_id}", rules)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)


def brute(rows, asked, k):
    out = set()
    for q, c in asked:
        near = sorted((bin((c ^ x) & (2**64 - 1)).count("1"), i) for i, x in rows if x is not None)[:k]
        out |= {(q, n + 1, i, d) for n, (d, i) in enumerate(near)}
    return out


def listed(rows, query, k):
    near = sorted((bin((query[1] ^ x) & (2**64 - 1)).count("1"), i) for i, x in rows if x is not None)[:k]
    return [(query[0], n + 1, i, d) for n, (d, i) in enumerate(near)]


def test_probe_equals_brute_force():
    rng = np.random.default_rng(3)
    codes = np.unique(rng.integers(0, 2**16, 700).astype(np.uint64) * np.uint64(0x1000100010001))
    low, asked = rng.permutation(len(codes)), codes[::9] ^ np.uint64(6)
    for part in ((0, 10), (48, 16), (20, 4)):
        for radius in range(part[1] + 1):
            for bound in (64, 20):
                q, c, d = topk.probe(codes, low, asked, np.full(len(asked), bound), part, radius, 5)
                for i, x in enumerate(asked.tolist()):
                    differs = lambda y: bin(((x ^ y) >> part[0]) & ((1 << part[1]) - 1)).count("1") == radius  # noqa: E731, B023
                    want = sorted((bin(x ^ y).count("1"), int(low[j]), j) for j, y in enumerate(codes.tolist()) if differs(y) and bin(x ^ y).count("1") <= bound)[:5]
                    assert [(int(a), int(b)) for a, b in zip(d[q == i], c[q == i])] == [(w[0], w[2]) for w in want]


@pytest.mark.parametrize("blocks", [(10**6, 10**6), (40, 7)])
def test_top_k(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "BLOCK_CODES", blocks[0])
    monkeypatch.setattr(topk, "BLOCK_QUERIES", blocks[1])
    rng = np.random.default_rng(7)
    codes = [int(x) for x in rng.integers(-(2**63), 2**63 - 1, 200)] + [5] * 60 + [4, -1, 0]
    codes += [c ^ (1 << int(rng.integers(0, 63))) for c in codes[:50]]
    rows = list(enumerate(codes)) + [(9999, None)]
    df = spark.createDataFrame(rows, "id long, code long").repartition(4)
    asked = [r for r in rows if r[0] % 20 == 0 and r[1] is not None] + [(210, 5)]
    got = topk.top_k(df, df.filter("id % 20 = 0 OR id = 210"), 10)
    assert {tuple(r) for r in got.collect()} == brute(rows, sorted(set(asked)), 10)
    twice = df.union(df.filter("id < 40")).union(spark.createDataFrame([(None, 5)], "id long, code long"))
    assert Counter(map(tuple, topk.top_k(twice, df.filter("id = 20"), 10).collect())) == Counter({tuple(r): 1 for r in listed(rows + rows[:40], (20, codes[20]), 10)})
    few = df.filter("id < 3")
    assert {tuple(r) for r in topk.top_k(few, few, 10).collect()} == brute(rows[:3], rows[:3], 10)
    assert topk.top_k(df.limit(0), df.limit(0)).collect() == []


def test_sign_codes(spark):
    v = [[1.0] * 64, [-1.0] * 63 + [2.0], None, [], [float("nan"), 0.0, 3.0]]
    got = [r.c for r in spark.createDataFrame([(i, x) for i, x in enumerate(v)], "i int, e array<double>").orderBy("i").select(topk.sign_code(F.col("e")).alias("c")).collect()]
    assert got == [-1, -(2**63), None, 0, 5]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    got, want = queries.QUERIES[name](spark, DATA), con.execute(queries.ORACLES[name])
    names = [c[0] for c in want.description]
    order = sorted(names)
    assert sorted(got.columns) == order
    a = sorted(repr([r[c] for c in order]) for r in got.collect())
    b = sorted(repr([dict(zip(names, r))[c] for c in order]) for r in want.fetchall())
    assert a == b


def test_pipeline(spark, docs, nothing):
    import corpus_pipeline

    names = docs.columns
    good = [(1000 + i, prose(i + 20, 80), "en", f"s{i % 3}" if i % 5 else None, None, *[None] * 10) for i in range(80)]
    now = docs = docs.union(spark.createDataFrame(good, docs.schema))
    for step, (name, stage) in enumerate(corpus_pipeline.STAGES):
        if step < 4:
            now = stage(spark, now, DATA)
            assert now.columns == names, name
            now = spark.createDataFrame(now.collect(), docs.schema)
        else:
            assert stage(spark, now, DATA).count() > 0
        empty = stage(spark, nothing, DATA)
        assert empty.count() == 0, name
    out = corpus_pipeline.run(spark, DATA)
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(out.columns)


def test_pipeline_keeps_one_of_each_group(spark, docs):
    import corpus_pipeline

    kept = corpus_pipeline.near_duplicates(spark, docs, DATA).collect()
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert 0 in ids and not {1, 2} & set(ids) and ids.count(0) == 1
