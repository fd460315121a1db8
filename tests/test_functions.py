import datetime as dt
import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from groovemill.functions import dates, hashing, text


def values(spark, rows, *exprs, schema="a string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [tuple(r) if len(exprs) > 1 else r[0] for r in df.coalesce(1).select(*exprs).collect()]


def test_trims(spark):
    assert values(spark, ["  x y　", " \u0085", "", None, "​x"], text.unicode_trim(F.col("a"))) == ["x y", None, None, None, "​x"]
    assert values(spark, ["\x01 x \t", "　", " ", "  ", None], text.legacy_trim(F.col("a"))) == ["x ", None, " ", None, None]


def test_arrays(spark):
    rows = [([" a", None, "", "a", "b "],), ([" "],), (None,), ([],)]
    assert values(spark, rows, text.clean_distinct(F.col("a")), schema="a array<string>") == [["a", "b"], None, None, None]
    assert values(spark, [([" LP ", "Limited"],), ([],), (None,)], text.reduced_description(F.col("a")), schema="a array<string>") == ["[d:LP],[d:Limited]", None, None]


QUANTITIES = [("0002", "2", 2), (" 　", None, None), ("2147483647", "2147483647", 2147483647), ("2147483648", "2147483648", None), ("10000000000", "10000000000", None), ("1" + "0" * 51, "1" + "0" * 51, None), ("000", "0", 0)]


def test_quantities(spark):
    q = text.canonical_quantity(F.col("a"))
    assert values(spark, [r[0] for r in QUANTITIES], q, text.integer_quantity(q)) == [r[1:] for r in QUANTITIES]
    for bad in ("-1", "not-a-number"):
        with pytest.raises(PySparkException):
            values(spark, [bad], q)
        assert values(spark, [bad], text.canonical_quantity(F.col("a"), strict=False)) == [None]


def test_sizes_and_chunks(spark):
    rows = [("1", "B"), ("1", "KB"), ("1.5", "mb"), ("2", "GB"), ("1", "TB"), ("1", "XB"), ("x", "B")]
    assert values(spark, rows, text.display_size(F.col("a"), F.col("b")), schema="a string, b string") == [1, 1024, 1572864, 2147483648, 1099511627776, None, None]
    assert values(spark, [0, 1, 10, 11], text.chunk_count(F.col("a"), 10), schema="a long") == [0, 1, 1, 2]


def test_classification(spark):
    assert values(spark, ["x_artists.xml", "RELEASES", "masters", "labels", "artists_labels", "other"], text.classify(F.col("a"))) == ["artist", "release", "master", "label", "artist", None]


def java(s):
    h, raw = 0, s.encode("utf-16-be")
    for i in range(0, len(raw), 2):
        h = (h * 31 + int.from_bytes(raw[i : i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


def test_java_hash(spark):
    cases = ["", "Al Thompson", "C. Thompson", "6Яд", "7Ад", "a😀b", "x" * 200]
    got = values(spark, cases, hashing.java_hash(F.col("a")))
    assert got == [java(c) for c in cases]
    assert got[1] == got[2] == -1130078775 and got[3] == got[4] == 86171
    one = hashing.format_hash(F.col("a"), F.lit(None).cast("string"), F.lit("2"), F.lit(""))
    assert values(spark, ["CD"], one) == [java("CD\x00\x01\x002\x00")]
    assert values(spark, ["CD"], hashing.joined_hash(F.col("a"), F.lit(" "), F.lit(None).cast("string"), F.lit("x"))) == [java("CDx")]


def framed(owner, relation, *fields):
    kind = "release" if relation in hashing.RELEASE_RELATIONS else "non-release"
    out = f"{owner}/{kind}-relation-identity/v1\0{relation}\0".encode()
    for f in fields:
        out += b"\0" if not f else b"\1" + len(f.encode()).to_bytes(4, "big") + f.encode()
    return hashlib.sha256(out).digest()


def test_digests_and_slots(spark):
    null = F.lit(None).cast("string")
    d = hashing.digest("format", F.col("a"), null, F.lit("2"), F.lit("Compilation"), owner="someone")
    assert bytes(values(spark, [" CD　"], d)[0]) == framed("someone", "format", "CD", None, "2", "Compilation")
    d = hashing.digest("artist_url", F.col("a"))
    a, b, c = (bytes(x) for x in values(spark, ["é", None, " "], d))
    assert a == framed("catalog", "artist_url", "é") and b == c == framed("catalog", "artist_url", None)
    ab = hashing.digest("track", F.lit("AB"), F.lit("C"), null)
    assert values(spark, ["x"], ab != hashing.digest("track", F.lit("A"), F.lit("BC"), null)) == [True]
    s = hashing.slot("track", hashing.digest("track", F.col("a"), F.lit("Яд"), null), F.lit(3))
    assert values(spark, ["6"], s) == [hashing.slot_of("track", framed("catalog", "track", "6", "Яд", None), 3)]
    with pytest.raises(ValueError):
        hashing.digest("nothing", F.col("a"))


PARSED = {
    "193x-1x": "1930-10-01", "1992-1x-1c": "1992-10-10", "1992-1x": "1992-10-01", "1992-xx": "1992-01-01", "1988-03-18": "1988-03-18", "19920405": "1992-04-05",
    "20201301": "2020-01-01", "20200100": "2020-01-01", "20200231": "2020-02-01", "2020-00": "2020-01-01", "2020-13": "2020-01-01", "1999-03-00": "1999-03-01",
    "09990101": None, "99990101": None, "0999-01-01": None, "9999-01-01": None, None: None, "": None, "xxxx": None, "a1": None, "1992-_1": "1992-01-01", "1993/4/5": "1993-04-05",
}


def test_malformed_dates(spark):
    got = values(spark, list(PARSED), dates.parse_malformed(F.col("a"), 2026))
    assert [x and x.isoformat() for x in got] == list(PARSED.values())


def test_date_flags(spark):
    month = {"193x-03": True, "193x-03-00": True, "193x-3": True, "193x-002": True, None: False, "193X-33": False, "193X-3X": False, "193X-": False, "193X-00": False, "19920405": False}
    assert values(spark, list(month), dates.is_month_valid(F.col("a"))) == list(month.values())
    day = {"1931-03-28": True, "1931-0003-0028": True, None: False, "1931-03-33": False, "1931-03-": False, "1931-02-29": False, "1931-02-00": False, "09990101": False, "20201301": False, "1931-03/28": False}
    assert values(spark, list(day), dates.is_day_valid(F.col("a"), 2026)) == list(day.values())
    assert values(spark, ["1993", "1993-hello", "193x-3", None], dates.is_year_valid(F.col("a"))) == [True, True, False, False]


def test_calendar(spark):
    assert dates.month_window("2024-02") == (dt.date(2024, 2, 1), dt.date(2024, 3, 1))
    assert dates.month_window("2024-12")[1] == dt.date(2025, 1, 1)
    assert values(spark, ["data/2026/d_20260701_artists.xml.gz", "x_20261301_a", "none"], dates.path_date(F.col("a"))) == [dt.date(2026, 7, 1), None, None]
    assert values(spark, ["2026-07-01T02:00:00+02:00", "x"], dates.utc_timestamp(F.col("a"))) == [dt.datetime(2026, 7, 1), None]
    assert [text.positive_int("7"), text.schema_name("a_1")] == [7, "a_1"]
    for f, bad in ((text.positive_int, "0"), (text.positive_int, "-1"), (text.positive_int, "1 "), (text.positive_int, "2147483648"), (text.schema_name, "A"), (text.schema_name, "1a"), (text.schema_name, "a" * 64), (text.schema_name, "")):
        with pytest.raises(ValueError):
            f(bad)


def test_long_texts_take_linear_time(spark):
    import time

    long = "x" * 1_000_000
    values(spark, ["ab"], hashing.java_hash(F.col("a")))
    began = time.time()
    assert values(spark, [long], hashing.java_hash(F.col("a"))) == [java(long)]
    assert time.time() - began < 20


def test_catalog_urls():
    from groovemill.errors import InvalidArgument
    from groovemill.sources import catalog_index as c

    assert c.year_url("https://c.example", 2026) == "https://c.example/?prefix=data%2F2026%2F"
    assert c.dump_url("https://c.example/", "data/2026/x_20260701_artists.xml.gz") == "https://c.example/?download=data%2F2026%2Fx_20260701_artists.xml.gz"
    assert c.manifest_url("https://c.example/", "data/2026/x_20260701_artists.xml.gz") == "https://c.example/?download=data%2F2026%2Fx_20260701_CHECKSUM.txt"
    for bad in ("ftp://c.example", "c.example", "https://"):
        with pytest.raises(InvalidArgument):
            c.year_url(bad, 2026)
    with pytest.raises(InvalidArgument):
        c.manifest_url("https://c.example/", "data/artists.xml.gz")


def test_entries_of_many_links_take_linear_time(spark):
    import time

    from groovemill.sources.catalog_index import entries_of

    def page(n):
        days = [(dt.date(2000, 1, 1) + dt.timedelta(i)).strftime("%Y%m%d") for i in range(n)]
        rows = [f'2026-07-01 10:00:00 1 KB <a href="u?download=data%2Fx_{d}_masters.xml.gz">x_{d}_masters.xml.gz</a>' for d in days]
        return "\n".join(rows + [f'<a href="u?download=data%2Fx_{d}_CHECKSUM.txt">x_{d}_CHECKSUM.txt</a>' for d in days])

    took = []
    for n in (10, 200, 400):
        began = time.time()
        got = values(spark, [page(n)], entries_of(F.col("a")))
        assert len(got[0]) == n and all(e.checksum_url == f"u?download=data%2Fx_{e.dump_date:%Y%m%d}_CHECKSUM.txt" for e in got[0])
        took.append(time.time() - began)
    assert took[2] < 3
