"""Convergent merges as joins: each returns the table's new state, so a run that repeats changes nothing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """All pairs of columns equal, nulls equal to nulls."""
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(f"{prefix}{c}") for c in df.columns])


def merge_upsert(old: DataFrame, new: DataFrame, key: Sequence[str], touched: str | None = "last_modified_at", created: str | None = "created_at", keep: Sequence[str] = ()) -> DataFrame:
    """Rows of both by key. A new row replaces an old one only if a business column differs; it takes the new time then
    and keeps the old row's creation. Columns in keep never change once stored."""
    o, n = _prefixed(old, "o_"), _prefixed(new, "n_")
    joined = o.join(n, [o[f"o_{k}"] == n[f"n_{k}"] for k in key], "full")
    skip = {*key, *keep, *(c for c in (touched, created) if c)}
    business = [c for c in old.columns if c not in skip]
    was, now = F.col(f"o_{key[0]}").isNotNull(), F.col(f"n_{key[0]}").isNotNull()
    differs = reduce(lambda a, b: a | b, [~F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}")) for c in business], F.lit(False))
    out = []
    for c in old.columns:
        o_, n_ = F.col(f"o_{c}"), F.col(f"n_{c}")
        if c in key:
            out.append(F.coalesce(o_, n_).alias(c))
        elif c in keep or c == created:
            out.append(F.when(was, o_).otherwise(n_).alias(c))
        else:
            out.append(F.when(~was, n_).when(now & differs, n_).otherwise(o_).alias(c))
    return joined.select(*out)


def insert_ignore(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """old with the rows of new whose key it lacks, null keys equal to null keys; of new rows with one key one enters."""
    n = new.dropDuplicates(list(key)).alias("n")
    o = _prefixed(old.select(*key), "o_")
    test = reduce(lambda a, b: a & b, [F.col(f"n.{k}").eqNullSafe(F.col(f"o_{k}")) for k in key])
    return old.unionByName(n.join(o, test, "left_anti").select(*old.columns))


def stale_rows(old: DataFrame, new: DataFrame, root: str, key: Sequence[str], touched: DataFrame) -> DataFrame:
    """Rows of old under a touched root that no row of new equals in all keys. touched: distinct roots, column `root`."""
    under = old.join(touched.select(F.col("root").alias("t_root")), F.col(root) == F.col("t_root"), "left_semi").alias("a")
    n = _prefixed(new.select(*key).distinct(), "b_")
    return under.join(n, reduce(lambda a, b: a & b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b_{k}")) for k in key]), "left_anti")


def converge(old: DataFrame, new: DataFrame, root: str, key: Sequence[str], touched: DataFrame) -> DataFrame:
    """The relation after an import: rows of untouched roots as they are, rows that still hold as they were stored, and
    rows that are new. A touched root without new rows loses all it had. touched: distinct roots, column `root`."""
    t = touched.select(F.col("root").alias("t_root"))
    n = _prefixed(new.select(*key).distinct(), "b_").withColumn("b_here", F.lit(True))
    a = old.join(t, F.col(root) == F.col("t_root"), "left").alias("a")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b_{k}")) for k in key])
    # one pass over the stored rows: an untouched root's rows stay, a touched root's only if they are among the new ones
    kept = a.join(n, same, "left").filter(F.col("t_root").isNull() | F.col("b_here")).select(*[F.col(f"a.`{c}`") for c in old.columns])
    o = _prefixed(old.select(*key), "o_")
    fresh = new.dropDuplicates(list(key)).alias("n")
    added = fresh.join(o, reduce(lambda x, y: x & y, [F.col(f"n.{k}").eqNullSafe(F.col(f"o_{k}")) for k in key]), "left_anti").select(*old.columns)
    return kept.unionByName(added)


def existing_roots(tables: dict[str, tuple[DataFrame, str]], roots: DataFrame) -> DataFrame:
    """(table, root) of the given roots that have rows; tables: frame and root column by name."""
    found = []
    for name, (df, column) in tables.items():
        hit = df.select(F.col(column).alias("root")).join(roots.select("root"), "root", "left_semi").distinct()
        found.append(hit.select(F.lit(name).alias("table"), "root"))
    return reduce(DataFrame.unionByName, found)


def newest(rows: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """(key, value) of the row that is last by order under each key."""
    return rows.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def reconcile_main(masters: DataFrame, releases: DataFrame) -> DataFrame:
    """masters with main_release_id set to the newest release that says it is their main one, or null without one.

    One join does what clearing stale and setting current links would; last_modified_at stays."""
    named = releases.filter("is_master AND master_id IS NOT NULL").select("master_id", "id", "last_modified_at")
    desired = newest(named, "master_id", "id", ["last_modified_at", "id"]).select(F.col("master_id").alias("d_master"), F.col("id").alias("d_release"))
    out = masters.join(desired, masters["id"] == desired["d_master"], "left")
    return out.select(*[F.col("d_release").cast(masters.schema[c].dataType).alias(c) if c == "main_release_id" else masters[c] for c in masters.columns])


def stale_links(masters: DataFrame, releases: DataFrame) -> DataFrame:
    """Masters whose main release is gone, belongs elsewhere or isn't a main one any more."""
    r = releases.filter("is_master").select(F.col("id").alias("r_id"), F.col("master_id").alias("r_master"))
    linked = masters.filter("main_release_id IS NOT NULL")
    return linked.join(r, (linked["main_release_id"] == r["r_id"]) & (linked["id"] == r["r_master"]), "left_anti")


def update_from(target: DataFrame, source: DataFrame, key: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """target with columns replaced where source has its key; values may use target's columns and source's as s_x."""
    s = _prefixed(source, "s_")
    out = target.join(s, reduce(lambda a, b: a & b, [target[k] == s[f"s_{k}"] for k in key]), "left")
    hit = F.col(f"s_{key[0]}").isNotNull()
    return out.select(*[F.when(hit, values[c]).otherwise(target[c]).alias(c) if c in values else target[c] for c in target.columns])


def missing_references(rows: DataFrame, column: str, ids: DataFrame, id_column: str = "id") -> DataFrame:
    """Rows whose reference isn't there; null references count as there."""
    keys = ids.select(F.col(id_column).alias("ref_id"))
    return rows.filter(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("ref_id"), "left_anti")
