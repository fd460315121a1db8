"""URL rules looked up in a cascade of Bloom filters that is exact over all keys of the corpus."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

#: The rules of the query, as (action, rule).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: What holds where no rule fits.
DEFAULT = "allow"
#: Rules are held by the driver and their filters by each task; more are refused.
MOST_RULES = 1_000_000


class Bloom:
    """Bits for n keys at a false-positive rate; keys come as pairs of 64-bit hashes."""

    def __init__(self, n: int, rate: float):
        self.size = max(64, math.ceil(n * 1.4427 * math.log2(1 / rate)))
        self.hashes = max(1, round(self.size / max(n, 1) * 0.6931)) if n * 16 > self.size else max(1, math.ceil(math.log2(1 / rate)))
        self.bits = np.zeros(-(-self.size // 8), np.uint8)

    def places(self, pairs: np.ndarray) -> np.ndarray:
        step = np.arange(self.hashes, dtype=np.uint64)
        return ((pairs[:, :1] + step * (pairs[:, 1:] | np.uint64(1))) % np.uint64(self.size)).astype(np.int64)

    def add(self, pairs: np.ndarray) -> None:
        at = self.places(pairs).ravel()
        np.bitwise_or.at(self.bits, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))

    def has(self, pairs: np.ndarray) -> np.ndarray:
        if not len(pairs):
            return np.zeros(0, bool)
        at = self.places(pairs)
        return ((self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def pairs(keys: Iterable[str], level: int) -> np.ndarray:
    """Two hashes of each key, other ones at each level."""
    out = b"".join(xxhash.xxh3_128_digest(k.encode("utf-8", "surrogatepass"), seed=level) for k in keys)
    return np.frombuffer(out, ">u8").reshape(-1, 2).astype(np.uint64)


class Cascade:
    """Exact membership in `listed` for all keys of a universe: level 0 holds the listed keys, level 1 the universe's
    keys that pass it falsely, level 2 the listed keys that pass level 1, and so on until none passes."""

    def __init__(self, first: Bloom):
        self.levels = [first]

    @classmethod
    def start(cls, listed: Sequence[str], universe: int) -> Cascade:
        rate = min(0.5, max(len(listed), 1) / max(universe, 1) / 2)
        out = cls(Bloom(len(listed), rate))
        if listed:
            out.levels[0].add(pairs(listed, 0))
        return out

    def close(self, listed: Sequence[str], false: Sequence[str]) -> Cascade:
        """Adds levels until the listed keys and the false positives of level 0 are told apart."""
        inside, outside = list(false), list(listed)
        while inside:
            level = len(self.levels)
            bloom = Bloom(len(inside), 0.5 if level > 1 else 0.25)
            bloom.add(pairs(inside, level))
            self.levels.append(bloom)
            passed = bloom.has(pairs(outside, level))
            inside, outside = [k for k, p in zip(outside, passed, strict=True) if p], inside
        return self

    def has(self, keys: Sequence[str]) -> np.ndarray:
        found, open_ = np.zeros(len(keys), bool), np.arange(len(keys))
        for level, bloom in enumerate(self.levels):
            passed = bloom.has(pairs((keys[i] for i in open_), level))
            found[open_[~passed]] = level % 2 == 1
            open_ = open_[passed]
        found[open_] = len(self.levels) % 2 == 1
        return found


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first :// up to /, ? or #, A-Z lower-cased, and from there up to ? or #; both empty without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return ascii_lower(host), path


def keys_of(host: Column, path: Column, lengths: Sequence[int], most: int) -> Column:
    """All keys under which a rule could list the url: each suffix of the host of at most as many labels as a rule's host
    has, with each start of the path of a length that some rule's path has."""
    labels = F.split(F.substring_index(host, ".", -most), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]), lambda p: p.isNotNull())
    return F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: F.concat(s, p))))


def build(keys: DataFrame, rules: Sequence[tuple[str, str]]) -> dict[str, Cascade]:
    """A cascade for each action. keys(key): every key of the corpus, repeats allowed; the rules are held by the driver.

    Level 0 is sized by the number of distinct keys so that about half as many false positives as listed keys remain;
    only those come back to the driver."""
    universe = keys.agg(F.approx_count_distinct("key").alias("n")).first().n or 0
    all_rules = {r for _, r in rules}
    lists = {a: sorted({r for b, r in rules if a == b}) for a in ("allow", "block")}
    known = {a: frozenset(v) for a, v in lists.items()}
    out = {a: Cascade.start(v, universe) for a, v in lists.items()}

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).unique().to_pylist()
            for a, cascade in out.items():
                hit = [k for k, p in zip(found, cascade.levels[0].has(pairs(found, 0)), strict=True) if p and k not in known[a]]
                yield pa.RecordBatch.from_arrays([pa.array([a] * len(hit), pa.string()), pa.array(hit, pa.string())], names=["action", "key"])

    false: dict[str, set[str]] = {a: set() for a in out}
    for r in keys.mapInArrow(passing, "action string, key string").distinct().collect():
        false[r["action"]].add(r["key"])
    for a, cascade in out.items():
        more = [r for r, p in zip(sorted(all_rules), cascade.levels[0].has(pairs(sorted(all_rules), 0)), strict=True) if p and r not in known[a]]
        cascade.close(lists[a], sorted(false[a] | set(more)))
    return out


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule and verdict of pages(page_id, url).

    The longest rule wins that lists a suffix of the host, at a dot, and a start of the path; of equally long ones
    block wins, then the first by code point. Without a rule: null and the default. A null url, or one without ://,
    has an empty host and path, which no rule fits. An empty table gives no rows; other columns are left out.
    """
    for action, rule in rules:
        if action not in ("allow", "block") or "/" not in rule:
            raise ValueError(f"not a rule: {action} {rule}")
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    lengths = sorted({len(r) - r.index("/") for _, r in rules}) or [1]
    most = max((r.count(".", 0, r.index("/")) + 1 for _, r in rules), default=1)
    host, path = host_and_path(F.col("url"))
    rows = pages.select(pages["page_id"].cast("long"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("keys", keys_of(F.col("host"), F.col("path"), lengths, most))
    cascades = build(rows.select(F.explode("keys").alias("key")), rules)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            size = lists.value_lengths().to_numpy()
            flat = lists.flatten().to_pylist()
            hit = {a: c.has(flat) for a, c in cascades.items()}
            row = np.repeat(np.arange(len(size)), size)
            best: list[tuple | None] = [None] * len(size)
            for i in np.flatnonzero(hit["allow"] | hit["block"]):
                action = "block" if hit["block"][i] else "allow"
                rank = (len(flat[i]), action == "block", [-ord(c) for c in flat[i]])
                if best[row[i]] is None or rank > best[row[i]][0]:
                    best[row[i]] = (rank, flat[i], action)
            cols = [pa.array([b and b[1] for b in best], pa.string()), pa.array([b[2] if b else default for b in best], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *cols], names=["page_id", "host", "path", "rule", "verdict"])

    return rows.mapInArrow(look_up, "page_id long, host string, path string, rule string, verdict string")


def op5(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


OP5_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM u
), p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h
), r(action, rule, rule_host, rule_path) AS (
  VALUES ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
         ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')
)
SELECT page_id, host, path, max_by(rule, length(rule)) AS rule, coalesce(max_by(action, length(rule)), 'allow') AS verdict
FROM p LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY page_id, host, path
"""
