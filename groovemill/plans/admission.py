"""Admission of runs: locks, abandoned and current runs, resumption, dependencies, downgrades and the states of entities."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import ImportRefused
from ..functions.text import ENTITIES

#: The entities that a run of each one locks, and the revision of what an import does.
LOCKS = {"artist": ("artist",), "label": ("label",), "master": ("artist", "master"), "release": ("artist", "label", "master", "release")}
REVISIONS = {"artist": 1, "label": 1, "master": 1, "release": 3}


def fingerprint(dumps: Iterable[tuple[str, dt.date, str]]) -> str:
    """SHA-256 of the sorted entity|date|checksum lines of a set of dumps."""
    lines = sorted(f"{e}|{d.isoformat()}|{c.lower()}" for e, d, c in dumps)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def locks_of(entities: Iterable[str]) -> list[str]:
    """All entities to lock, in processing order."""
    need = {x for e in entities for x in LOCKS[e]}
    return [e for e in ENTITIES if e in need]


def requirements(dumps: Iterable[tuple[str, dt.date]]) -> dict[str, tuple[list[str], dt.date]]:
    """For each entity that selected ones depend on without its being selected: who needs it and the latest horizon,
    the first day of the month after the dump's."""
    dumps = list(dumps)
    selected, out = {e for e, _ in dumps}, {}
    for entity, day in dumps:
        horizon = (day.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        for need in LOCKS[entity]:
            if need not in selected:
                who, most = out.get(need, ([], horizon))
                out[need] = (sorted({*who, entity}), max(most, horizon))
    return out


def requirement_rows(dumps: DataFrame, depends: DataFrame) -> DataFrame:
    """requirements() as DataFrames: dumps(entity_type, dump_date), depends(entity_type, dependency)."""
    rows = dumps.join(depends, "entity_type").withColumn("horizon", F.add_months(F.trunc("dump_date", "MM"), 1))
    rows = rows.join(dumps.select(F.col("entity_type").alias("dependency")).distinct(), "dependency", "left_anti")
    return rows.groupBy("dependency").agg(F.array_join(F.array_sort(F.collect_set("entity_type")), ",").alias("consumers"), F.max("horizon").alias("horizon"))


def asof(left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str, tie: str, values: Sequence[str]) -> DataFrame:
    """left with the values of right's last row under the same key strictly before left's time, null without one; of
    rows with one time the largest tie wins.

    The right side is first reduced to a row for each key and time and the left side to its distinct keys and times, both
    by partial aggregation; only these run through a window, and the left rows look their time up."""
    last = right.groupBy(F.col(by).alias("k"), F.col(right_time).alias("t")).agg(F.max_by(F.struct(*[F.col(v) for v in values]), tie).alias("v")).withColumn("side", F.lit(1))
    asked = left.select(F.col(by).alias("k"), F.col(left_time).alias("t")).distinct().withColumn("v", F.lit(None).cast(last.schema["v"].dataType)).withColumn("side", F.lit(0))
    before = Window.partitionBy("k").orderBy("t", "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = last.unionByName(asked).withColumn("v", F.last("v", ignorenulls=True).over(before)).filter("side = 0").drop("side")
    same = left[by].eqNullSafe(found["k"]) & left[left_time].eqNullSafe(found["t"])
    return left.join(found, same, "left").select(*[left[c] for c in left.columns], *[F.col(f"v.{x}").alias(f"asof_{x}") for x in values])


def abandoned(runs: DataFrame, run_dumps: DataFrame, entities: Sequence[str]) -> DataFrame:
    """Runs still marked running that touch entities whose locks are free again."""
    theirs = run_dumps.filter(F.col("entity_type").isin(list(entities))).select(F.col("import_run_id").alias("id"))
    return runs.filter("status = 'running'").join(theirs, "id", "left_semi")


def mark_abandoned(runs: DataFrame, run_dumps: DataFrame, entities: Sequence[str], now: Column) -> DataFrame:
    gone = abandoned(runs, run_dumps, entities).select(F.col("id").alias("gone"))
    out = runs.join(gone, runs["id"] == gone["gone"], "left")
    hit = F.col("gone").isNotNull()
    new = {"status": F.lit("failed"), "completed_at": now, "failure_message": F.lit("recovered after its locks were free again")}
    return out.select(*[F.when(hit, new[c]).otherwise(runs[c]).alias(c) if c in new else runs[c] for c in runs.columns])


def _revision() -> Column:
    return reduce(lambda a, kv: a.when(F.col("entity_type") == kv[0], kv[1]), list(REVISIONS.items())[1:], F.when(F.col("entity_type") == "artist", REVISIONS["artist"]))


def _other_revision(run_dumps: DataFrame, revision: Column) -> DataFrame:
    return run_dumps.filter(~F.col("import_contract_revision").eqNullSafe(revision)).select(F.col("import_run_id").alias("id"))


def _current(run_dumps: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """The dump that each entity's checkpoint stands for."""
    c = checkpoints.select(F.col("entity_type").alias("c_entity"), F.col("import_run_id").alias("c_run"), "applied_at")
    d = run_dumps.select(F.col("entity_type").alias("d_entity"), F.col("import_run_id").alias("d_run"), F.col("dump_id").alias("current_dump"), F.col("import_contract_revision").alias("current_revision"))
    return c.join(d, (F.col("c_entity") == F.col("d_entity")) & (F.col("c_run") == F.col("d_run")), "left").select("c_entity", "c_run", "applied_at", "current_dump", "current_revision")


def _of(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rows of candidate runs alone: what is looked up of a run is looked up of these few."""
    ids = candidates.select(F.col("id").alias("candidate"))
    return rows.join(ids, F.col("import_run_id") == F.col("candidate"), "left_semi")


def current_successes(runs: DataFrame, run_dumps: DataFrame, checkpoints: DataFrame, manifest: str, revision: Column | None = None) -> DataFrame:
    """Successful runs of the manifest that are what the catalog holds: same revisions, every dump current, and no
    later failure on their entities. The newest comes first."""
    out = runs.filter((F.col("manifest_sha256") == manifest) & (F.col("status") == "success"))
    theirs = _of(run_dumps, out)
    own = theirs.join(_current(run_dumps, checkpoints), F.col("entity_type") == F.col("c_entity"), "left")
    moved = own.filter(~F.col("current_dump").eqNullSafe(F.col("dump_id"))).select(F.col("import_run_id").alias("id"))
    failed = runs.filter("status = 'failed'").select(F.col("id").alias("f_id"), F.col("completed_at").alias("f_at"))
    failures = run_dumps.select(F.col("entity_type").alias("f_entity"), F.col("import_run_id").alias("f_id")).join(failed, "f_id")
    # the latest failure of an entity decides: one row per entity instead of all pairs
    worst = failures.groupBy("f_entity").agg(F.max(F.struct("f_at", "f_id")).alias("worst"))
    later = own.join(worst, F.col("entity_type") == F.col("f_entity")).filter(F.struct(F.col("worst.f_at"), F.col("worst.f_id")) > F.struct(F.col("applied_at"), F.col("c_run"))).select(F.col("import_run_id").alias("id"))
    bad = [_other_revision(theirs, _revision() if revision is None else revision), moved, later]
    return out.join(reduce(DataFrame.unionByName, bad), "id", "left_anti").orderBy(F.col("completed_at").desc(), F.col("id").desc())


def resumable_runs(runs: DataFrame, run_dumps: DataFrame, chunks: DataFrame, checkpoints: DataFrame, manifest: str, n_dumps: int, chunk_size: int, revision: Column | None = None) -> DataFrame:
    """Failed runs of the manifest that can be taken up: not forced, same revisions, dumps and chunk size, a ledger that
    adds up and fits the windows, and no other import applied since. The newest comes first."""
    out = runs.filter((F.col("manifest_sha256") == manifest) & (F.col("status") == "failed") & ~F.col("force_requested"))
    every, run_dumps, chunks = run_dumps, _of(run_dumps, out), _of(chunks, out)
    done = chunks.groupBy(F.col("import_run_id").alias("k_run"), F.col("entity_type").alias("k_entity")).agg(F.sum("item_count").alias("done"))
    sums = run_dumps.join(done, (F.col("import_run_id") == F.col("k_run")) & (F.col("entity_type") == F.col("k_entity")), "left")
    wrong_sum = sums.filter(F.col("processed_items") != F.coalesce("done", F.lit(0))).select(F.col("import_run_id").alias("id"))
    wrong_size = run_dumps.filter(~F.col("chunk_size").eqNullSafe(F.lit(chunk_size))).select(F.col("import_run_id").alias("id"))
    windows = chunks.join(run_dumps.select("import_run_id", "entity_type", "chunk_size"), ["import_run_id", "entity_type"])
    wrong_window = windows.filter("first_item_index <> chunk_index * chunk_size OR item_count > chunk_size").select(F.col("import_run_id").alias("id"))
    named = run_dumps.join(out.select(F.col("id").alias("r_id"), F.col("completed_at").alias("r_at")), F.col("import_run_id") == F.col("r_id"))
    since = named.join(_current(every, checkpoints), F.col("entity_type") == F.col("c_entity"))
    since = since.filter("(current_dump <> dump_id OR current_revision <> import_contract_revision) AND (applied_at > r_at OR (applied_at = r_at AND c_run > r_id))").select(F.col("import_run_id").alias("id"))
    right_count = run_dumps.groupBy(F.col("import_run_id").alias("id")).count().filter(F.col("count") == n_dumps).select("id")
    bad = [_other_revision(run_dumps, _revision() if revision is None else revision), wrong_size, wrong_sum, wrong_window, since]
    return out.join(right_count, "id", "left_semi").join(reduce(DataFrame.unionByName, bad), "id", "left_anti").orderBy(F.col("completed_at").desc(), F.col("id").desc())


def pruned(chunks: DataFrame, runs: DataFrame, run_dumps: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """The ledger without chunks of failed runs all of whose dumps have been applied since."""
    own = run_dumps.join(_current(run_dumps, checkpoints), F.col("entity_type") == F.col("c_entity"), "left")
    open_ = own.filter(~F.col("current_dump").eqNullSafe(F.col("dump_id")) | ~F.col("current_revision").eqNullSafe(F.col("import_contract_revision"))).select(F.col("import_run_id").alias("id"))
    gone = runs.filter("status = 'failed'").select("id").join(open_, "id", "left_anti").select(F.col("id").alias("import_run_id"))
    return chunks.join(gone, "import_run_id", "left_anti")


def downgrades(dumps: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Selected dumps older than what has been applied."""
    c = checkpoints.select("entity_type", F.col("dump_date").alias("applied_date"))
    return dumps.join(c, "entity_type").filter(F.col("dump_date") < F.col("applied_date"))


def assert_no_downgrade(dumps: DataFrame, checkpoints: DataFrame, allow: bool = False) -> None:
    found = [] if allow else downgrades(dumps, checkpoints).select("entity_type").collect()
    if found:
        raise ImportRefused(f"older than what is applied: {', '.join(sorted(r.entity_type for r in found))}")


def preflight(dumps: Iterable[tuple[str, dt.date]], run_dumps: DataFrame, catalog: DataFrame) -> None:
    """Refuses a run whose dependencies aren't applied, or are older than the catalog's last dump before the horizon."""
    for entity, (who, horizon) in requirements(dumps).items():
        whole = "entity_type = '{}' AND import_contract_revision = {} AND completed_at IS NOT NULL AND chunk_size IS NOT NULL AND total_items IS NOT NULL AND total_chunks IS NOT NULL AND processed_items = total_items"
        last = run_dumps.filter(whole.format(entity, REVISIONS[entity])).orderBy(F.col("completed_at").desc(), F.col("import_run_id").desc()).limit(1)
        have = last.join(catalog.select(F.col("id").alias("dump_id"), "dump_date", "checksum_sha256"), "dump_id").first()
        if have is None:
            raise ImportRefused(f"{', '.join(who)} needs {entity}, which isn't imported")
        if have.dump_date < horizon:
            want = catalog.filter((F.col("entity_type") == entity) & (F.col("dump_date") < horizon)).orderBy(F.col("dump_date").desc(), F.col("id").desc()).first()
            if want is None or (want.dump_date, want.checksum_sha256) != (have.dump_date, have.checksum_sha256):
                raise ImportRefused(f"{', '.join(who)} needs {entity} before {horizon}, and {have.dump_date} isn't its last dump")


def states(entity_states: DataFrame, entities: Sequence[str], run: int, status: str, now: Column, message: str | None = None) -> DataFrame:
    """Entity states after a run begins (importing), succeeds (ready) or fails (failed): a first import is a bootstrap,
    a later one a refresh. Only rows that the run holds become ready or failed."""
    mine = F.col("entity_type").isin(list(entities))
    if status != "importing":
        mine = mine & (F.col("active_import_run_id") == run)
    ready = status == "ready"
    new = {
        "status": F.lit(status),
        "operation": F.when(F.col("last_successful_import_run_id").isNull(), "bootstrap").otherwise("refresh") if status == "importing" else F.lit(None).cast("string") if ready else F.col("operation"),
        "active_import_run_id": F.lit(run if status == "importing" else None).cast("long"),
        "last_successful_import_run_id": F.lit(run).cast("long") if ready else F.col("last_successful_import_run_id"),
        "ready_at": now if ready else F.col("ready_at"),
        "updated_at": now,
        "failure_message": F.lit(message).cast("string") if status == "failed" else F.lit(None).cast("string"),
    }
    return entity_states.select(*[F.when(mine, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in entity_states.columns])


def should_seed(entity_states: DataFrame, run: int) -> bool:
    """Whether releases are imported for the first time in this run, so that masters may take links from their dump."""
    hit = (F.col("entity_type") == "release") & (F.col("status") == "importing") & (F.col("operation") == "bootstrap") & (F.col("active_import_run_id") == run)
    return not entity_states.filter(hit).isEmpty()
