"""Registered queries that SQL can't express, on the smallest tables, against plain versions of their contracts."""

import bisect
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from groovemill.llm import pii, sharding, tokens
from groovemill.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def ids(texts):
    own = Tokenizer.from_file(tokens.vocabulary())
    return {i: own.encode(t, add_special_tokens=False).ids for i, t in texts.items()}


def crc(x):
    return zlib.crc32(np.array(x, "<u4").tobytes())


def test_packing(spark, ids):
    got = QUERIES["op1_packing"](spark, DATA).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        own = [*ids[r.doc_id], 0]
        assert r.doc_tokens == len(own) and r.ids_crc32 == crc(own[r.start : r.start + r.length])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, own in ids.items():
        assert [a for a, _ in sorted(pieces[i])] == [0, *np.cumsum([n for _, n in sorted(pieces[i])])[:-1].tolist()] and sum(n for _, n in pieces[i]) == len(own) + 1
    for own in sequences.values():
        assert [a for a, _ in sorted(own)] == [0, *np.cumsum([n for _, n in sorted(own)])[:-1].tolist()] and sum(n for _, n in own) <= 1024
    assert 1024 * len(sequences) <= 1.05 * sum(len(x) + 1 for x in ids.values()) + 1024 * 8


def test_files(spark, ids):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op3_ans_files"](spark, DATA).collect()}
    at = 0
    for i in sorted(ids):
        own = [*ids[i], 2]
        assert got.pop(i) == (at, len(own), crc(own))
        at += len(own)
    assert not got


def test_shards(spark, texts):
    got = QUERIES["op8_sharding"](spark, DATA).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None) and 0 <= r.shard <= 7
    counts = Counter(r.shard for r in got)
    assert len(counts) == 8 and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))


@pytest.mark.parametrize("slack", [0.0, 0.05, 0.25])
def test_overflow_key_by_key(spark, slack):
    """Every key walks the ring by itself: clockwise to the next shard that has room, arcs and keys in the operator's order."""
    n, shards = 4000, 8
    rows = spark.range(n).select(F.col("id").alias("doc_id")).withColumn("h", F.xxhash64("doc_id"))
    rows = rows.withColumn("pos", F.shiftrightunsigned("h", 2)).withColumn("piece", F.pmod(F.xxhash64("h", F.struct("doc_id")), F.lit(sharding.PIECES)))
    nodes = sharding.ring(shards)
    keys = sorted((bisect.bisect_left(nodes, (r.pos, -1)) % len(nodes), r.piece, r.h, r.doc_id) for r in rows.collect())
    room, want, waiting = sharding.capacities(n, shards, slack), {}, keys
    for step in range(shards):
        still = []
        for key in waiting:
            around = list(dict.fromkeys(s for _, s in nodes[key[0] :] + nodes[: key[0]]))
            if room[around[step]]:
                room[around[step]] -= 1
                want[key[3]] = around[step]
            else:
                still.append(key)
        waiting = still
    got = {r.doc_id: r.shard for r in sharding.shard(rows.select("doc_id"), "doc_id", shards, slack).collect()}
    assert got == want


def test_personal_data(spark, texts):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    digits = lambda s: sum(c in "0123456789" for c in s)
    right = {"email": lambda s: True, "ip": lambda s: all(int(x) <= 255 for x in s.split(".")), "card": lambda s: 13 <= digits(s) <= 19 and pii.luhn(re.sub("[ -]", "", s)), "phone": lambda s: 9 <= digits(s) <= 15}
    got = {r.doc_id: r for r in QUERIES["op10_personal_data"](spark, DATA).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        spans = {k: [m.span() for m in re.finditer(p, text) if right[k](m[0])] for k, p in patterns.items()}
        base = [f"{k}:{a}:{b}" for k, v in spans.items() for a, b in v]
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(spans[k]) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(",")) | {""}
