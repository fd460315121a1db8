import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from groovemill.functions import hashing
from groovemill.operators import canonical, merge, relations


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_converge_keeps_current_rows_and_drops_stale_ones(spark):
    old = spark.createDataFrame([(1, "a", "t0"), (1, "b", "t0"), (1, None, "t0"), (2, "a", "t0"), (3, "z", "t0")], "root int, k string, at string")
    new = spark.createDataFrame([(1, "a", "t1"), (1, None, "t1"), (1, "c", "t1"), (1, "c", "t1"), (4, "n", "t1")], "root int, k string, at string")
    touched = spark.createDataFrame([(1,), (3,), (4,)], "root int")
    out = merge.converge(old, new, "root", ["root", "k"], touched)
    assert rows(out) == sorted([(1, "a", "t0"), (1, None, "t0"), (1, "c", "t1"), (2, "a", "t0"), (4, "n", "t1")], key=repr)
    assert rows(merge.converge(out, new, "root", ["root", "k"], touched)) == rows(out)
    assert rows(merge.stale_rows(old, new, "root", ["root", "k"], touched)) == [(1, "b", "t0"), (3, "z", "t0")]
    empty = new.limit(0)
    assert rows(merge.converge(old, empty, "root", ["root", "k"], touched)) == [(2, "a", "t0")]


def test_upsert_changes_only_what_differs(spark):
    s = "id int, name string, link int, created_at string, last_modified_at string"
    old = spark.createDataFrame([(1, "a", 5, "c0", "m0"), (2, "b", 5, "c0", "m0"), (3, None, None, "c0", "m0")], s)
    new = spark.createDataFrame([(1, "a", 6, "c1", "m1"), (2, None, 6, "c1", "m1"), (4, "d", 6, "c1", "m1")], s)
    out = merge.merge_upsert(old, new, ["id"], keep=("link",))
    assert rows(out) == [(1, "a", 5, "c0", "m0"), (2, None, 5, "c0", "m1"), (3, None, None, "c0", "m0"), (4, "d", 6, "c1", "m1")]


def test_reconcile_moves_clears_and_prefers_the_newest(spark):
    m = spark.createDataFrame([(1, None, "t"), (2, 20, "t"), (3, 30, "t"), (4, 41, "t")], "id int, main_release_id int, last_modified_at string")
    r = spark.createDataFrame([(10, 1, True, "1"), (11, 1, True, "2"), (12, 1, True, "2"), (20, 1, True, "0"), (30, 3, False, "1"), (41, 4, True, "1"), (50, None, True, "9")], "id int, master_id int, is_master boolean, last_modified_at string")
    assert rows(merge.reconcile_main(m, r)) == [(1, 12, "t"), (2, None, "t"), (3, None, "t"), (4, 41, "t")]
    assert sorted(x[0] for x in rows(merge.stale_links(m, r))) == [2, 3]


def test_collapse_and_conflicts(spark):
    df = spark.createDataFrame([(1, "x", 1, 0), (1, "x", 1, 1), (2, None, 2, 0), (2, None, 2, 1), (3, "y", 3, 0), (3, None, 3, 1)], "id int, pay string, hash int, place int")
    assert rows(canonical.conflicts(df, ["id"], ["pay", "hash"])) == [(3, 2)]
    fine = df.filter("id < 3")
    assert rows(canonical.collapse(fine, ["id"], ["pay", "hash"], ["place"])) == [(1, "x", 1, 0), (2, None, 2, 0)]
    with pytest.raises(PySparkException):
        canonical.collapse(df, ["id"], ["pay", "hash"], ["place"]).collect()


def test_colliding_tracks_get_slots(spark):
    spec = relations.BY_TABLE["release_item_track"]
    raw = spark.createDataFrame([(1, 0, "6", "Яд", None), (1, 1, "7", "Ад", None), (1, 2, "7", "Ад", None), (2, 0, "6", "Яд", None)], "release_item_id int, place int, position string, title string, duration string")
    out = canonical.canonical(relations.identified(raw, spec), spec)
    got = {(r.release_item_id, r.position): (r.hash, bytes(r.identity_sha256)) for r in out.collect()}
    assert len(got) == 3 and got[2, "6"][0] == 86171
    low, high = sorted([got[1, "6"], got[1, "7"]], key=lambda x: x[1])
    assert low[0] == 86171 and high[0] == hashing.slot_of("track", high[1], 0)


@given(st.lists(st.tuples(st.integers(0, 3), st.binary(min_size=1, max_size=3)), unique_by=lambda x: x[1], max_size=12))
def test_slots_are_distinct_and_keep_the_smallest(pairs):
    ask = lambda d, n: (d[0] + n) % 40
    got = canonical.allocate(pairs, ask)
    assert len(set(got)) == len(got)
    for h in {h for h, _ in pairs}:
        assert got[pairs.index((h, min(d for g, d in pairs if g == h)))] == h


def plain_slot(digest, attempt):
    head = b"catalog/release-relation-slot/v1\0track\0"
    return int.from_bytes(hashlib.sha256(head + digest + attempt.to_bytes(4, "big")).digest()[:4], "big", signed=True)


def test_slots_equal_a_plain_allocator(spark):
    """Scopes with and without collisions, null scopes among them, replayed row by row."""
    rows = [(i % 7 or None, f"t{i}", i % 5 if i % 7 < 4 else i, hashlib.sha256(bytes([i])).digest(), None if i % 2 else i) for i in range(100)]
    # the first slot that this digest asks for is another row's legacy hash, which is reserved
    taken = plain_slot(hashlib.sha256(b"z").digest(), 0)
    rows += [(9, "z", 1, hashlib.sha256(b"z").digest(), 1), (9, "y", 1, bytes(32), 1), (9, "w", taken, b"\x01" * 32, 1)]
    spec = relations.Relation("t", "release", "root", lambda: F.col("x"), lambda x, trim: {}, payload=("title", "q"), digest="track")
    got = canonical.with_slots(spark.createDataFrame(rows, "root int, title string, hash int, identity_sha256 binary, q int"), spec).collect()
    want = set()
    for root in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == root), key=lambda r: (r[2], r[3]))
        used, reserved, before = set(), {r[2] for r in own}, None
        for r in own:
            slot, attempt = r[2], 0
            while before == r[2] and (attempt == 0 or slot in used | reserved):
                slot, attempt = plain_slot(r[3], attempt), attempt + 1
            before = r[2]
            used.add(slot)
            want.add((root, r[1], slot, r[3], r[4]))
    assert {(r.root, r.title, r.hash, bytes(r.identity_sha256), r.q) for r in got} == want
    z = next(r.hash for r in got if r.title == "z")
    assert z == plain_slot(hashlib.sha256(b"z").digest(), 1)
