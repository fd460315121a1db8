import datetime as dt
import os
import sys

import pytest
from pyspark.sql import functions as F


from . import dumps as D

from groovemill.errors import Fenced, ImportRefused  # noqa: E402
from groovemill.operators.relations import RELATIONS  # noqa: E402
from groovemill.plans.importer import Importer, Plan, resume_rows, stage_dump  # noqa: E402
from groovemill.plans.store import Store  # noqa: E402
from groovemill.sources.catalog_index import sha256_of  # noqa: E402
from groovemill.sources.xml_dump import chunk_index, dense_ordinals, read_dump, source_chunks  # noqa: E402

T0 = dt.datetime(2026, 7, 2, 12)


class Clock:
    def __init__(self):
        self.t = T0

    def __call__(self):
        self.t += dt.timedelta(seconds=1)
        return self.t


def plan(paths, day=dt.date(2026, 7, 1), **more):
    return Plan(paths, dict.fromkeys(paths, day), {e: sha256_of(p) for e, p in paths.items()}, as_of=2026, chunk_size=2, **more)


def table(store, name, *columns):
    df = store.read(name)
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """A store with all four entities imported once."""
    root = tmp_path_factory.mktemp("import")
    store = Store(spark, str(root / "store"))
    engine = Importer(spark, store, str(root / "staging"), Clock())
    paths = D.write(root, **D.ALL)
    first = engine.run(plan(paths))
    return root, store, engine, paths, first


def test_first_import(world):
    _, store, _, _, first = world
    assert first["processed"] == first["items"]
    assert first["status"] == "success" and first["items"] == {"artist": 6, "label": 2, "master": 2, "release": 3}
    assert table(store, "artist", "id", "name", "real_name") == [(1, "One", None), (2, "Two", None), (3, "Three", None)]
    counts = {r.table: store.read(r.table).count() for r in RELATIONS}
    assert counts == {
        "artist_alias": 1, "artist_group": 1, "artist_member": 1, "artist_name_variation": 1, "artist_url": 1, "label_sub_label": 1, "label_url": 2,
        "master_artist": 1, "master_genre": 1, "master_style": 1, "master_video": 1, "label_release_item": 3, "release_item_artist": 1, "release_item_credited_artist": 1,
        "release_item_format": 1, "release_item_genre": 2, "release_item_identifier": 1, "release_item_style": 1, "release_item_track": 2, "release_item_video": 1, "release_item_work": 1,
    }
    assert table(store, "release_item_format", "name", "description", "quantity", "quantity_text", "text") == [("CD", "[d:LP],[d:Limited]", 2, "2", None)]
    assert table(store, "label_release_item", "label_id", "category_notation") == [(1, "SK 026"), (1, "SK026"), (1, None)]
    assert len({h for (h,) in table(store, "release_item_track", "hash")}) == 2
    got = table(store, "release_item", "id", "release_date", "has_valid_day", "has_valid_month", "has_valid_year", "is_master", "master_id")
    assert got == [(1, dt.date(1999, 3, 1), False, True, True, True, 1), (2, dt.date(1992, 10, 10), False, False, True, True, None), (3, dt.date(1992, 4, 5), True, False, True, False, 2)]
    assert table(store, "master", "id", "year", "main_release_id") == [(1, 1999, 1), (2, 0, None)]
    assert table(store, "genre") == [("Jazz",), ("Rock",)]


def test_ledger_and_states(world):
    _, store, _, _, first = world
    assert table(store, "run", "id", "status") == [(first["run"], "success")]
    assert {(e, p, t, c) for e, p, t, c in table(store, "run_dump", "entity_type", "processed_items", "total_items", "total_chunks")} == {("artist", 6, 6, 3), ("label", 2, 2, 1), ("master", 2, 2, 1), ("release", 3, 3, 2)}
    assert {s for (s,) in table(store, "entity_state", "status")} == {"ready"}
    assert len(table(store, "checkpoint")) == 4


def test_same_plan_is_skipped_and_forcing_it_changes_nothing(world):
    _, store, engine, paths, first = world
    business = ["artist", "label", "master", "release_item", "genre", "style", *(r.table for r in RELATIONS)]
    before = {t: table(store, t) for t in business}
    assert engine.run(plan(paths)) == {"run": first["run"], "status": "skipped"}
    again = engine.run(plan(paths, force=True))
    assert again["status"] == "success" and again["run"] > first["run"]
    assert {t: table(store, t) for t in business} == before


def test_refresh_converges(world, tmp_path):
    _, store, engine, _, _ = world
    keep = table(store, "artist_url", "artist_id", "url", "last_modified_at")
    text = D.ARTISTS.replace('<name id="2">Two</name><name id="9">Gone</name>', '<name id="3">Three</name>').replace("<name>Three</name></artist>", "<name>Third</name></artist>", 1).replace("<realname>  </realname>", "")
    out = engine.run(plan(D.write(tmp_path, artist=text), dt.date(2026, 8, 1)))
    assert out["status"] == "success"
    assert table(store, "artist_alias", "artist_id", "alias_id") == [(1, 3)]
    assert table(store, "artist_url", "artist_id", "url", "last_modified_at") == keep
    times = {i: (c, m) for i, c, m in table(store, "artist", "id", "created_at", "last_modified_at")}
    assert times[1][0] == times[1][1] and times[3][0] < times[3][1]
    with pytest.raises(ImportRefused, match="older"):
        engine.run(plan(D.write(tmp_path, artist=D.ARTISTS), dt.date(2026, 6, 1)))


def test_dependencies_and_failures(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    engine = Importer(spark, store, str(tmp_path / "st"), Clock())
    master = D.write(tmp_path, master=D.MASTERS)
    with pytest.raises(ImportRefused, match="artist"):
        engine.run(plan(master))
    bad = D.write(tmp_path, artist=D.ARTISTS.replace("<urls><url>http://a</url></urls>", "<urls><url>u</url><url>u&#160;</url></urls>"))
    with pytest.raises(Exception, match="conflicting payloads"):
        engine.run(plan(bad))
    assert table(store, "run", "status") == [("failed",)] and table(store, "artist") == []
    assert table(store, "entity_state", "status") == [("failed",)]
    with store.locked("artist"), pytest.raises(ImportRefused, match="locked"):
        engine.run(plan(bad))
    good = D.write(tmp_path, artist=D.ARTISTS)
    assert engine.run(plan(good))["status"] == "success"
    assert engine.run(plan(master))["status"] == "success"
    assert table(store, "master_artist", "master_id", "artist_id") == [(1, 1)]


def test_commits_are_atomic_and_fenced(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    one = spark.createDataFrame([("Rock",)], "name string")
    first = store.commit({"genre": one})
    bad = one.select(F.raise_error(F.lit("lost")).cast("string").alias("name"))
    with pytest.raises(Exception, match="lost"):
        store.commit({"style": one, "genre": bad})
    assert store.manifest() == first and table(store, "style") == []
    store.commit({"style": one})
    with pytest.raises(Fenced):
        store.commit({"genre": one}, expect=first)
    store.commit({"genre": one.limit(0)})
    assert table(store, "genre") == []
    assert store.vacuum() and table(store, "style") == [("Rock",)]


def test_scan_ordinals_and_chunks(spark, tmp_path):
    paths = D.write(tmp_path, artist=D.ARTISTS, label=D.LABELS)
    rows = read_dump(spark, paths["label"], "label")
    assert [(r.id, r.ordinal) for r in rows.orderBy("ordinal").collect()] == [("1", 0), ("2", 1)]
    many = spark.range(100, numPartitions=7).withColumn("ordinal", F.monotonically_increasing_id())
    got = [r.ordinal for r in dense_ordinals(many).orderBy("id").collect()]
    assert got == list(range(100))
    assert [tuple(r) for r in source_chunks(dense_ordinals(many), 30).orderBy("chunk_index").collect()] == [(0, 0, 30), (1, 30, 30), (2, 60, 30), (3, 90, 10)]
    staged = stage_dump(spark, paths["artist"], "artist", str(tmp_path / "st"))
    done = source_chunks(staged, 2).filter("chunk_index = 0")
    assert resume_rows(staged, staged, source_chunks(staged, 2).limit(0), 2).count() == 6
    assert resume_rows(staged, staged, done, 2).select(chunk_index(F.col("ordinal"), 2)).distinct().count() == 2
    with pytest.raises(ImportRefused):
        resume_rows(staged, staged, done.withColumn("item_count", F.lit(1)), 2)


def test_repeated_roots_and_ids(spark, tmp_path):
    from groovemill.operators.relations import valid_ids, valid_roots

    text = D.ARTISTS.replace("</artists>", "<artist><id> 2 </id><name>Two again</name></artist></artists>")
    rows = read_dump(spark, D.write(tmp_path, artist=text)["artist"], "artist")
    assert sorted((r.root_id, r.name) for r in valid_roots(rows, "artist").collect()) == [(1, "One"), (2, "Two again"), (3, "Three")]
    assert sorted(r.id for r in valid_ids(rows, "artist").collect()) == [1, 2, 3]


KILLED = """
import os, signal, sys
sys.path[:0] = {path!r}
from tests.test_import import *
from groovemill.session import session
store = Store(session(spark__ui__enabled="false", spark__sql__shuffle__partitions="4", spark__master="local[4]"), {store!r})
commits, commit = [], store.commit
def counted(frames, *more):
    out = commit(frames, *more)
    commits.append(frames)
    if sum("run_chunk" in f and "run" not in f for f in commits) == {after}:
        os.kill(os.getpid(), signal.SIGKILL)
    return out
store.commit = counted
Importer(store.spark, store, {staging!r}, Clock()).run(plan({paths!r}, commit_chunks=1))
"""


def test_killed_run_is_taken_up(spark, tmp_path):
    """A child process is killed after artists were finished and the labels' chunk was recorded but not merged: its locks
    are taken over, its run is marked as failed, and a new one does only the rest."""
    import signal
    import subprocess

    paths = D.write(tmp_path, artist=D.ARTISTS, label=D.LABELS.replace("</labels>", '<label><id>3</id><name>L3</name></label></labels>'))
    store = Store(spark, str(tmp_path / "store"))
    code = KILLED.format(path=[p for p in sys.path if p], store=str(tmp_path / "store"), staging=str(tmp_path / "st"), paths=paths, after=4)
    child = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=900)
    assert child.returncode == -signal.SIGKILL, child.stderr[-2000:]
    assert (tmp_path / "store" / "label.lock").exists() and table(store, "run", "status") == [("running",)]
    assert table(store, "label") == [] and len(table(store, "artist")) == 3 and list(store.manifest().pending) == ["1/label"]
    out = Importer(spark, store, str(tmp_path / "st"), Clock()).run(plan(paths, commit_chunks=1))
    assert out["status"] == "success" and out["resumed_from"] == 1
    assert out["items"] == {"artist": 6, "label": 3} and out["processed"] == {"artist": 0, "label": 1}
    assert table(store, "run", "id", "status") == [(1, "failed"), (2, "success")]
    assert table(store, "label", "id", "name") == [(1, "L1"), (2, "L2"), (3, "L3")] and table(store, "label_sub_label") != []
    assert len(table(store, "label_url")) == 2 and len(table(store, "artist_url")) == 1 and len(table(store, "artist")) == 3
    assert len({t for _, t in table(store, "label", "id", "last_modified_at")}) == 1
    assert store.manifest().pending == {} and store.vacuum() and len(table(store, "label")) == 3


def test_locks_are_leases(spark, tmp_path, monkeypatch):
    import json
    import time

    from groovemill.plans import store as s

    store = Store(spark, str(tmp_path / "s"))
    with store.locked("artist", "label"):
        with pytest.raises(ImportRefused), store.locked("label"):
            pass
        held = json.loads(store.files.read("label.lock"))
        store.files.replace("label.lock", json.dumps(held | {"until": time.time() - 1}))
        with store.locked("label"):
            assert json.loads(store.files.read("label.lock"))["owner"] != held["owner"]
            with pytest.raises(ImportRefused), store.locked("label"):
                pass
    store.files.create("artist.lock", json.dumps(held | {"host": "elsewhere", "pid": 1}))
    with pytest.raises(ImportRefused), store.locked("artist"):
        pass
    store.files.delete("artist.lock")
    monkeypatch.setattr(s, "LEASE_SECONDS", 0.6)
    with store.locked("artist"):
        time.sleep(1.5)
        with pytest.raises(ImportRefused), store.locked("artist"):
            pass
    assert not [n for n in store.files.names() if n.endswith(".lock")]


@pytest.mark.parametrize("local", [True, False])
def test_files(spark, tmp_path, local):
    from groovemill.plans.files import Files

    f = Files(spark, str(tmp_path / "f"), local)
    assert f.read("a") is None and list(f.names()) == [] and list(f.names("none")) == []
    assert f.create("a", "one é") and not f.create("a", "two") and f.read("a") == "one é"
    f.replace("a", "three")
    assert f.read("a") == "three" and f.create("b", "") and not f.move("a", "b") and not f.move("c", "d") and f.move("a", "c")
    assert sorted(f.names()) == ["b", "c"]
    f.delete("b")
    f.delete("b")
    assert list(f.names()) == ["c"]


def test_other_identity_shapes_are_refused(spark):
    from groovemill.operators import canonical, relations

    spec = relations.Relation("t", "label", "label_id", lambda: F.col("x"), lambda x, trim: {}, keys=("a_id", "b_id"))
    with pytest.raises(ValueError, match="int, int, int"):
        canonical.canonical(spark.createDataFrame([], "label_id int, a_id int, b_id int, place int"), spec)
    assert {r.shape for r in RELATIONS} <= set(relations.SHAPES)
