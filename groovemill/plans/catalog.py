"""The catalog of dumps: scans, latest dumps, completeness and resolution."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import DumpNotFound, InvalidArgument
from ..functions.dates import month_window
from ..functions.text import ENTITIES
from ..operators.merge import insert_ignore

ORDER = ("dump_date", "entity_type", "etag", "size_bytes")


def in_range(dumps: DataFrame, start: dt.date, end: dt.date, entity: str | None = None) -> DataFrame:
    """Dumps of [start, end), by date and id."""
    out = dumps.filter((F.col("dump_date") >= start) & (F.col("dump_date") < end))
    if entity:
        out = out.filter(F.col("entity_type") == entity)
    return out.orderBy("dump_date", "id")


def all_dumps(dumps: DataFrame) -> DataFrame:
    return dumps.orderBy("dump_date", "id")


def top_of(dumps: DataFrame, entity: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """The latest dump of an entity, in [start, end) if given."""
    rows = dumps.filter(F.col("entity_type") == entity)
    if start and end:
        rows = rows.filter((F.col("dump_date") >= start) & (F.col("dump_date") < end))
    return rows.orderBy(F.col("dump_date").desc(), F.col("id").desc()).limit(1)


def by_etag(dumps: DataFrame, etag: str) -> DataFrame:
    return dumps.filter(F.col("etag") == etag).limit(1)


def exists(dumps: DataFrame, etag: str) -> bool:
    return not by_etag(dumps, etag).isEmpty()


def counts(dumps: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> int:
    """Dumps from start on, up to end inclusive, or in [start, end) with both."""
    if start and end:
        dumps = dumps.filter((F.col("dump_date") >= start) & (F.col("dump_date") < end))
    elif start:
        dumps = dumps.filter(F.col("dump_date") >= start)
    elif end:
        dumps = dumps.filter(F.col("dump_date") <= end)
    return dumps.count()


def latest_per_type(dumps: DataFrame) -> DataFrame:
    """The last dump of each entity by date, entity, tag and size, entities in processing order."""
    best = dumps.groupBy("entity_type").agg(F.max_by(F.struct(*dumps.columns), F.struct(*ORDER)).alias("d"))
    rank = F.array_position(F.array(*[F.lit(e) for e in ENTITIES]), F.col("entity_type"))
    return best.select("d.*").orderBy(rank)


def complete(dumps: DataFrame, required: Sequence[str]) -> bool:
    """Whether every required entity has a dump."""
    found = {r["entity_type"] for r in dumps.select("entity_type").filter(F.col("entity_type").isin(list(required))).distinct().collect()}
    return not set(required) - found


def require_complete(dumps: DataFrame, required: Sequence[str], where: str) -> DataFrame:
    rows = latest_per_type(dumps.filter(F.col("entity_type").isin(list(required))))
    if not complete(rows, required):
        raise DumpNotFound(f"{where} lacks a dump of {', '.join(sorted(required))}")
    return rows


def save(catalog: DataFrame, dumps: DataFrame) -> DataFrame:
    """The catalog with pinned dumps it lacks; a malformed one is an error when it is read, a negative size is 0."""
    ok = F.col("etag").isNotNull() & F.col("uri").isNotNull() & F.col("dump_date").isNotNull() & F.col("entity_type").isin(*ENTITIES) & F.col("checksum_sha256").rlike("^[0-9A-Fa-f]{64}$")
    bad = F.raise_error(F.concat(F.lit("not a pinned dump: "), F.coalesce("uri", F.lit("null")))).cast("boolean")
    rows = dumps.filter(F.when(F.coalesce(ok, F.lit(False)), True).otherwise(bad)).withColumn("size_bytes", F.greatest("size_bytes", F.lit(0))).withColumn("checksum_sha256", F.lower("checksum_sha256"))
    return insert_ignore(catalog, rows, ["dump_date", "entity_type", "checksum_sha256"])


def resolve(catalog: DataFrame, required: Sequence[str], refresh: Callable[[str | None], DataFrame], month: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(catalog, chosen dumps). A month is looked up in the catalog first and fetched only if incomplete; the latest are
    fetched first and the catalog is fallen back on if that fails."""
    if month:
        start, end = month_window(month)
        if start < dt.date(2008, 3, 1) or start > dt.date.today():
            raise InvalidArgument(f"no dumps in {month}")
        if not complete(in_range(catalog, start, end), required):
            catalog = save(catalog, refresh(month))
        return catalog, require_complete(in_range(catalog, start, end), required, month)
    try:
        catalog = save(catalog, refresh(None))
    except OSError:
        if not complete(catalog, required):
            raise
    return catalog, require_complete(catalog, required, "the catalog")
