"""Catalog pages, listings and checksum manifests, parsed in SQL expressions."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterable, Iterator
from urllib.error import HTTPError
from urllib.parse import quote, urlsplit
from urllib.request import Request, urlopen

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import FileProblem, InvalidArgument
from ..functions.dates import path_date, utc_timestamp
from ..functions.text import classify, display_size, file_name, let

#: The shapes of links, entries and manifest lines.
YEAR_LINK = r"""(?i)href=["']\?prefix=data%2F(\d{4})%2F["']"""
ENTRY = r"""(?im)^[ \t]*\d{4}-\d{2}-\d{2}[ \t]+\d{2}:\d{2}:\d{2}[ \t]+([\d.]+)[ \t]+(B|KB|MB|GB|TB)[ \t]+<a[ \t]+href=["']([^"']*\?download=([^"']+))["'][^>]*>([^<]+\.xml\.gz)</a>[ \t]*$"""
CHECKSUM_LINK = r"""(?i)<a[ \t]+href=["']([^"']*\?download=([^"']+))["'][^>]*>([^<]+CHECKSUM\.txt)</a>"""
MANIFEST_LINE = r"^([0-9A-Fa-f]{64})[ \t]+\*?(\S+)$"
XML_GZ = r"(?i)^[\w/_-]+\.xml\.gz$"


def _matches(text: Column, pattern: str, **groups: int) -> Column:
    """Structs of the groups of all matches, with their position."""
    lists = [F.regexp_extract_all(text, F.lit(pattern), F.lit(i)) for i in groups.values()]
    zipped = F.arrays_zip(*[x.alias(k) for k, x in zip(groups, lists, strict=True)])
    return F.transform(zipped, lambda m, i: F.struct(i.alias("pos"), *[m[str(k)].alias(name) for k, name in zip(groups, groups, strict=True)]))


def year_urls(pages: DataFrame, html: str = "html", base: str = "") -> DataFrame:
    """Distinct year listings that pages link to, latest first."""
    years = F.array_distinct(F.regexp_extract_all(F.col(html), F.lit(YEAR_LINK), F.lit(1)))
    rows = pages.select(F.explode(years).alias("year")).distinct()
    return rows.select("year", F.concat(F.lit(f"{base}?prefix=data%2F"), "year", F.lit("%2F")).alias("url")).orderBy(F.col("year").desc())


def catalog_base(base: str) -> str:
    """The catalog's address, closed by a slash; InvalidArgument unless it is one of http or https with a host."""
    found = urlsplit(base)
    if found.scheme.lower() not in ("http", "https") or not found.hostname:
        raise InvalidArgument(f"not an address of http or https: {base}")
    return base if base.endswith("/") else f"{base}/"


def year_url(base: str, year: int) -> str:
    """The listing of a year."""
    return f"{catalog_base(base)}?prefix={quote(f'data/{year}/', safe='')}"


def dump_url(base: str, uri: str) -> str:
    """The download of a dump, or of another file, by its path."""
    return f"{catalog_base(base)}?download={quote(uri, safe='')}"


def manifest_url(base: str, uri: str) -> str:
    """The download of the checksums that belong to a dump's path, which differ from it by what follows the date."""
    path = re.fullmatch(r"(.*_[0-9]{8}_)[^/]*", uri)
    if not path:
        raise InvalidArgument(f"no date in {uri}")
    return dump_url(base, f"{path[1]}CHECKSUM.txt")


def checksums_of(html: Column) -> Column:
    """(dump_date, checksum_url) of all checksum links of a page; links whose path and name differ are dropped."""
    m = F.transform(_matches(html, CHECKSUM_LINK, href=1, path=2, name=3), lambda x: F.struct(x["pos"].alias("pos"), x["href"].alias("checksum_url"), F.url_decode(x["path"]).alias("path"), x["name"].alias("name"), path_date(x["name"]).alias("dump_date")))
    return F.filter(m, lambda x: F.endswith(x["path"], F.concat(F.lit("/"), x["name"])) & x["dump_date"].isNotNull())


def entries_of(html: Column) -> Column:
    """The dumps that a page lists: uri, entity_type, size_bytes, dump_date, url and, by date, the page's last checksum_url.

    Entries are dropped whose path doesn't end with the shown name, isn't an .xml.gz path or names no entity or date."""

    def entry(x: Column, checks: Column) -> Column:
        uri, day = x["uri"], x["day"]
        last = F.try_element_at(F.filter(checks, lambda c: c["dump_date"] == day), F.lit(-1))
        return F.struct(uri.alias("uri"), classify(uri).alias("entity_type"), display_size(x["size"], x["unit"]).alias("size_bytes"), day.alias("dump_date"), x["href"].alias("url"), last["checksum_url"].alias("checksum_url"), x["name"].alias("name"))

    def dated(x: Column) -> Column:
        uri = F.url_decode(x["path"])
        return F.struct(uri.alias("uri"), path_date(uri).alias("day"), *[x[k].alias(k) for k in ("size", "unit", "href", "name")])

    found = F.transform(_matches(html, ENTRY, size=1, unit=2, href=3, path=4, name=5), dated)
    # the page's checksums are found once, not once for each entry
    rows = let(checksums_of(html), lambda checks: F.transform(found, lambda x: entry(x, checks)))
    return F.filter(rows, lambda x: F.endswith(x["uri"], F.concat(F.lit("/"), x["name"])) & x["uri"].rlike(XML_GZ) & x["entity_type"].isNotNull() & x["size_bytes"].isNotNull() & x["dump_date"].isNotNull())


def listed_dumps(pages: DataFrame, html: str = "html") -> DataFrame:
    """Dumps of year listings that have a checksum of the same date."""
    rows = pages.select(F.explode(entries_of(F.col(html))).alias("e")).select("e.*").drop("name")
    return rows.filter("checksum_url IS NOT NULL")


def object_listing(spark: SparkSession, path: str) -> DataFrame:
    """Dumps of an object listing in XML; entries without key, tag or a number as size, or of no entity, are dropped."""
    rows = spark.read.schema("Key string, ETag string, Size string, LastModified string").option("rowTag", "Contents").xml(path)
    rows = rows.select(F.col("Key").alias("uri"), F.btrim("ETag", F.lit('"')).alias("etag"), F.col("Size").try_cast("long").alias("size_bytes"), utc_timestamp(F.col("LastModified")).alias("listed_at"))
    rows = rows.withColumn("entity_type", classify(F.col("uri"))).withColumn("dump_date", path_date(F.col("uri")))
    return rows.filter(F.col("uri").rlike(XML_GZ) & F.col("etag").isNotNull() & F.col("size_bytes").isNotNull() & F.col("entity_type").isNotNull())


def manifest(lines: DataFrame, line: str = "value") -> DataFrame:
    """(file, checksum_sha256) of checksum lines; other lines are skipped."""
    text = F.btrim(line)
    return lines.filter(text.rlike(MANIFEST_LINE)).select(F.regexp_extract(text, MANIFEST_LINE, 2).alias("file"), F.lower(F.regexp_extract(text, MANIFEST_LINE, 1)).alias("checksum_sha256"))


def pinned(dumps: DataFrame, checksums: DataFrame) -> DataFrame:
    """dumps(uri, ...) with checksum_sha256 by file name; a dump without one is an error when the row is read."""
    rows = dumps.withColumn("file", file_name(F.col("uri"))).join(checksums, "file", "left")
    missing = F.raise_error(F.concat(F.lit("no checksum for "), F.col("uri")))
    return rows.withColumn("checksum_sha256", F.coalesce("checksum_sha256", missing.cast("string"))).drop("file")


def sha256_of(path: str) -> str:
    out = hashlib.sha256()
    with open(path, "rb") as f:
        while part := f.read(1 << 20):
            out.update(part)
    return out.hexdigest()


def is_valid(path: str, checksum: str | None = None, size: int | None = None) -> bool:
    """Whether a local file has the pinned checksum or, without one, the size."""
    if not os.path.isfile(path):
        return False
    return sha256_of(path) == checksum.lower() if checksum else os.path.getsize(path) == size


#: Seconds without an answer after which a request fails, and bytes of a file that are held at once.
TIMEOUT, PART_BYTES = 60.0, 1 << 20


def _open(url: str, method: str = "GET"):
    catalog_base(url)
    return urlopen(Request(url, method=method), timeout=TIMEOUT)


def page(url: str) -> str:
    """The text of a page or listing."""
    with _open(url) as answer:
        return answer.read().decode()


def manifest_text(url: str) -> str:
    """The checksum lines of a date; a date without them (404) has none. Other failures are errors."""
    try:
        return page(url)
    except HTTPError as e:
        if e.code == 404:
            return ""
        raise


def dump_size(url: str) -> int:
    """The bytes of a dump by its header; FileProblem unless it tells a positive number."""
    with _open(url, "HEAD") as answer:
        told = answer.headers.get("Content-Length") or ""
    if not re.fullmatch("0*[1-9][0-9]*", told, re.ASCII):
        raise FileProblem(f"{url} tells no size")
    return int(told)


def parts(url: str) -> Iterator[bytes]:
    """A file in parts, as fetch() takes them: dumps don't fit into memory."""
    with _open(url) as answer:
        while part := answer.read(PART_BYTES):
            yield part


def fetch(url: str, path: str, get: Callable[[str], bytes | Iterable[bytes]] = parts, checksum: str | None = None, size: int | None = None) -> str:
    """The path of a verified file: what is there if it is valid, else fetched anew, and twice at most.

    get gives the file's bytes, or parts of them that are written one after another."""
    for _ in range(2):
        if is_valid(path, checksum, size):
            return path
        if os.path.exists(path):
            os.remove(path)
        part = f"{path}.part"
        with open(part, "wb") as f:
            got = get(url)
            f.writelines([got] if isinstance(got, bytes) else got)
        os.replace(part, path)
    if is_valid(path, checksum, size):
        return path
    os.remove(path)
    raise FileProblem(f"{url} doesn't match its checksum or size")
