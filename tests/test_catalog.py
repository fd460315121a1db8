import datetime as dt
import hashlib

import pytest

from groovemill import cli
from groovemill.errors import DumpNotFound, FileProblem, InvalidArgument, MissingArgument
from groovemill.plans import admission, catalog, ledger
from groovemill.sources import catalog_index as ci
from groovemill.streaming.ingest import BatchTarget, converge_stream, files, upsert_stream

PAGE = """<pre>
2026-07-02 10:00:00   1.5 MB <a href="?download=data%2F2026%2Fd_20260701_artists.xml.gz">d_20260701_artists.xml.gz</a>
2026-07-02 10:00:00   2 KB <a href="?download=data%2F2026%2Fd_20260701_labels.xml.gz">other.xml.gz</a>
2026-07-02 10:00:00   2 KB <a href="?download=data%2F2026%2Fd_20260801_masters.xml.gz">d_20260801_masters.xml.gz</a>
2026-07-02 10:00:00   1 KB <a href="?download=data%2F2026%2Fd_20260701_CHECKSUM.txt">d_20260701_CHECKSUM.txt</a>
</pre><a href="?prefix=data%2F2025%2F">2025</a><a href='?prefix=data%2F2026%2F'>2026</a><a href="?prefix=data%2F2026%2F">2026</a>"""


def test_pages(spark):
    pages = spark.createDataFrame([(PAGE,), (None,), ("",)], "html string")
    assert [r.year for r in ci.year_urls(pages).collect()] == ["2026", "2025"]
    got = ci.listed_dumps(pages).collect()
    assert [(r.uri, r.entity_type, r.size_bytes, r.dump_date, r.checksum_url) for r in got] == [("data/2026/d_20260701_artists.xml.gz", "artist", 1572864, dt.date(2026, 7, 1), "?download=data%2F2026%2Fd_20260701_CHECKSUM.txt")]


def test_manifest_and_pins(spark):
    h = "AB" * 32
    lines = spark.createDataFrame([(f"{h}  d_20260701_artists.xml.gz",), ("nonsense",), ("",)], "value string")
    sums = ci.manifest(lines)
    dumps = spark.createDataFrame([("data/d_20260701_artists.xml.gz",)], "uri string")
    assert [r.checksum_sha256 for r in ci.pinned(dumps, sums).collect()] == [h.lower()]
    with pytest.raises(Exception, match="no checksum"):
        ci.pinned(spark.createDataFrame([("data/none.xml.gz",)], "uri string"), sums).collect()


def test_object_listing(spark, tmp_path):
    path = tmp_path / "list.xml"
    path.write_text("<L><Contents><Key>data/d_20080309_artists.xml.gz</Key><ETag>\"e\"</ETag><Size>12</Size><LastModified>2008-03-09T01:00:00.000Z</LastModified></Contents><Contents><Key>data/d_20080309_labels.xml.gz</Key><ETag>f</ETag><Size>x</Size></Contents><Contents><Key>data/readme.txt</Key><ETag>f</ETag><Size>1</Size></Contents></L>")
    assert [(r.etag, r.size_bytes, r.entity_type) for r in ci.object_listing(spark, str(path)).collect()] == [("e", 12, "artist")]


def test_fetch_verifies_twice(tmp_path):
    good, sent = b"abc", []
    def get(url):
        sent.append(url)
        return b"bad" if len(sent) == 1 else good
    path = str(tmp_path / "f")
    assert ci.fetch("u", path, get, hashlib.sha256(good).hexdigest()) == path and len(sent) == 2
    assert ci.fetch("u", path, get, size=3) == path and len(sent) == 2
    with pytest.raises(FileProblem):
        ci.fetch("u", path, lambda u: b"x", size=9)


@pytest.fixture
def site():
    """A catalog's address that answers with one dump of 3 MB; /none is absent, /empty has no bytes, /broken fails."""
    import http.server
    import threading

    body = bytes(range(256)) * 12_000

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            found = {"/none": (404, b""), "/empty": (200, b""), "/broken": (500, b""), "/sums": (200, b"ab  x\n")}
            code, sent = found.get(self.path, (200, body))
            self.send_response(code)
            self.send_header("Content-Length", str(len(sent)))
            self.end_headers()
            if self.command == "GET":
                self.wfile.write(sent)

        do_HEAD = do_GET

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", body
    server.shutdown()
    server.server_close()


def test_requests(site, tmp_path):
    base, body = site
    assert ci.page(f"{base}/sums") == ci.manifest_text(f"{base}/sums") == "ab  x\n"
    assert ci.manifest_text(f"{base}/none") == ""
    for call, path in ((ci.manifest_text, "broken"), (ci.page, "none"), (ci.dump_size, "none")):
        with pytest.raises(OSError):
            call(f"{base}/{path}")
    assert ci.dump_size(f"{base}/dump") == len(body)
    with pytest.raises(FileProblem):
        ci.dump_size(f"{base}/empty")
    with pytest.raises(InvalidArgument):
        ci.page("file:///etc/hostname")
    assert max(map(len, ci.parts(f"{base}/dump"))) <= ci.PART_BYTES
    path = str(tmp_path / "dump")
    assert ci.fetch(f"{base}/dump", path, checksum=hashlib.sha256(body).hexdigest()) == path
    with open(path, "rb") as f:
        assert f.read() == body


def dumps(spark, *rows):
    return spark.createDataFrame([(i, f"e{i}", dt.date.fromisoformat(d), t, f"{i:064x}", 1, f"u{i}") for i, d, t in rows], "id long, etag string, dump_date date, entity_type string, checksum_sha256 string, size_bytes long, uri string")


def test_catalog(spark):
    c = dumps(spark, (1, "2026-06-01", "artist"), (2, "2026-07-01", "artist"), (3, "2026-07-01", "label"))
    assert [r.id for r in catalog.latest_per_type(c).collect()] == [2, 3]
    assert [r.id for r in catalog.in_range(c, dt.date(2026, 6, 1), dt.date(2026, 7, 1)).collect()] == [1]
    assert catalog.top_of(c, "artist").first().id == 2 and catalog.exists(c, "e3") and not catalog.exists(c, "zz")
    assert [catalog.counts(c), catalog.counts(c, dt.date(2026, 7, 1)), catalog.counts(c, None, dt.date(2026, 6, 1)), catalog.counts(c, dt.date(2026, 6, 1), dt.date(2026, 7, 1))] == [3, 2, 1, 1]
    assert catalog.complete(c, ["artist", "label"]) and not catalog.complete(c, ["master"])
    with pytest.raises(DumpNotFound):
        catalog.require_complete(c, ["master"], "here")
    assert catalog.save(c, dumps(spark, (2, "2026-07-01", "artist"), (9, "2026-08-01", "artist"))).count() == 4
    calls = []
    def refresh(month):
        calls.append(month)
        return dumps(spark, (5, "2026-08-01", "artist"))
    _, got = catalog.resolve(c, ["artist"], refresh, "2026-07")
    assert [r.id for r in got.collect()] == [2] and not calls
    _, got = catalog.resolve(c, ["artist"], refresh)
    assert [r.id for r in got.collect()] == [5] and calls == [None]
    def offline(month):
        raise OSError("offline")
    assert [r.id for r in catalog.resolve(c, ["artist"], offline)[1].collect()] == [2]
    with pytest.raises(InvalidArgument):
        catalog.resolve(c, ["artist"], refresh, "2001-01")


def test_requirements():
    need = admission.requirements([("master", dt.date(2026, 7, 5)), ("release", dt.date(2026, 12, 1))])
    assert need == {"artist": (["master", "release"], dt.date(2027, 1, 1)), "label": (["release"], dt.date(2027, 1, 1))}
    assert admission.locks_of(["release"]) == ["artist", "label", "master", "release"] and admission.locks_of(["master"]) == ["artist", "master"]
    a = admission.fingerprint([("artist", dt.date(2026, 7, 1), "AB"), ("label", dt.date(2026, 7, 1), "cd")])
    assert a == admission.fingerprint([("label", dt.date(2026, 7, 1), "CD"), ("artist", dt.date(2026, 7, 1), "ab")])


def test_coverage(spark):
    s = "import_run_id long, entity_type string, chunk_index long, first_item_index long, item_count long"
    book = spark.createDataFrame([(1, "artist", 0, 0, 2), (1, "artist", 1, 2, 1), (2, "artist", 0, 0, 2), (3, "artist", 1, 2, 1), (3, "artist", 0, 1, 2)], s)
    totals = spark.createDataFrame([(1, "artist", 3, 2), (2, "artist", 3, 2), (3, "artist", 3, 2), (4, "artist", 0, 2)], "import_run_id long, entity_type string, total long, chunk_size int")
    got = {r.import_run_id: r.is_complete for r in ledger.coverage(book, totals).collect()}
    assert got == {1: True, 2: False, 3: False, 4: True}
    assert ledger.record(book, book.limit(1)).count() == 5
    assert ledger.transferred(book, 2, 9).filter("import_run_id = 9").count() == 1
    assert ledger.progress(0, 0, 1.0)["percent"] == 100.0 and ledger.progress(5, 10, 2.0) == {"items_per_second": 2.5, "percent": 50.0}


def test_options():
    got = cli.resolve(["--STORE=/s", "--dumps", "/d", "--chunk-size", "7", "--force"], {"GROOVEMILL_TYPES": "release, artist", "GROOVEMILL_CHUNK_SIZE": "9"})
    assert (got.store, got.dumps, got.chunk_size, got.force, got.types, got.cleanup) == ("/s", "/d", 7, True, ["artist", "release"], False)
    for bad in (["--nope=1"], ["--store=/a", "--store=/b"], ["--store=/a", "--dumps=/d", "--chunkSize=0"], ["--store=/a", "--dumps=/d", "--types=x"], ["--store=/a", "--dumps=/d", "--month=1999-01"], ["word"], ["--store="]):
        with pytest.raises(InvalidArgument):
            cli.resolve(bad, {})
    with pytest.raises(MissingArgument):
        cli.resolve([], {})


def test_streams(spark, tmp_path):
    s = "id int, name string, at int"
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, "a", 0), (1, "b", 1), (2, "x", 0)], s).coalesce(1).write.parquet(src)
    target = BatchTarget(spark, str(tmp_path / "t"), s)
    run = lambda: upsert_stream(files(spark, src, s), target, ["id"], ["at"], str(tmp_path / "cp")).awaitTermination()
    run()
    assert sorted(map(tuple, target.read().collect())) == [(1, "b", 1), (2, "x", 0)]
    spark.createDataFrame([(2, "y", 5)], s).coalesce(1).write.mode("append").parquet(src)
    run()
    assert sorted(map(tuple, target.read().collect())) == [(1, "b", 1), (2, "y", 5)] and target.state()["items"] == 3
    assert not target.apply(0, target.read(), lambda old, new: new)
    rel = "root int, k string"
    spark.createDataFrame([(1, "a"), (1, "b"), (2, "z")], rel).coalesce(1).write.parquet(str(tmp_path / "r"))
    sets = BatchTarget(spark, str(tmp_path / "rt"), rel)
    go = lambda: converge_stream(files(spark, str(tmp_path / "r"), rel), sets, "root", ["root", "k"], str(tmp_path / "cp2")).awaitTermination()
    go()
    spark.createDataFrame([(1, "b"), (2, None)], rel).coalesce(1).write.mode("append").parquet(str(tmp_path / "r"))
    go()
    assert sorted(map(tuple, sets.read().collect())) == [(1, "b")]
