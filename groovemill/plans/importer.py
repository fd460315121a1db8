"""One import from dumps to a committed snapshot: admission, roots, dictionaries, relations, links, ledger."""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..errors import Fenced, ImportRefused
from ..functions.text import ENTITIES
from ..functions.hashing import OWNER
from ..operators import canonical, merge, relations
from ..sources.xml_dump import chunk_index, dense_ordinals, read_dump, source_chunks
from . import admission, ledger
from .progress import Reporter, retrying
from .store import SCHEMAS, Store


@dataclass(frozen=True)
class Plan:
    """What to import: a dump path, date and checksum for each entity, and how. commit_chunks: chunks whose rows are
    written and recorded together; what a killed run has recorded is not done again."""

    paths: Mapping[str, str]
    dates: Mapping[str, dt.date]
    checksums: Mapping[str, str]
    chunk_size: int = 5000
    commit_chunks: int = 400
    force: bool = False
    allow_downgrade: bool = False
    reference_scope: str = "dump"
    owner: str = OWNER
    as_of: int | None = None

    @property
    def entities(self) -> list[str]:
        return [e for e in ENTITIES if e in self.paths]

    @property
    def manifest(self) -> str:
        return admission.fingerprint((e, self.dates[e], self.checksums[e]) for e in self.entities)


def stage_dump(spark: SparkSession, path: str, entity: str, folder: str) -> DataFrame:
    """The dump as Parquet with gapless ordinals, so that XML is parsed once and later reads prune columns."""
    out = f"{folder}/{entity}-{uuid.uuid4().hex}"
    read_dump(spark, path, entity).write.parquet(f"{out}/raw")
    rows = spark.read.parquet(f"{out}/raw")
    return dense_ordinals(rows)


def unraced(step):
    """The step, tried again when another run's commit has come between its reading and its commit."""

    @functools.wraps(step)
    def run(*args, **more):
        return retrying(lambda: step(*args, **more), (Fenced,))

    return run


class Importer:
    """Runs plans against a store. `now` gives the observation time, one for each entity."""

    def __init__(self, spark: SparkSession, store: Store, staging: str, now: Callable[[], dt.datetime] | None = None):
        self.spark, self.store, self.staging = spark, store, staging
        self.now = now or (lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))

    def _rows(self, table: str, *rows: dict) -> DataFrame:
        schema = self.spark.createDataFrame([], SCHEMAS[table]).schema
        return self.spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)

    def _read(self, table: str) -> DataFrame:
        return self.store.read(table)

    def run(self, plan: Plan) -> dict:
        """Imports the plan's dumps; returns the run's id, status, items and how many of them this run processed. A plan
        that the store already holds is skipped unless forced. A failed or killed run leaves the data as they were and its
        progress on record: the next run of the plan takes up its fragments and its entities that were finished."""
        if not plan.entities:
            raise ImportRefused("no entity is selected")
        self._dumps: dict[str, DataFrame] = {}
        self._processed: dict[str, int] = dict.fromkeys(plan.entities, 0)
        with self.store.locked(*admission.locks_of(plan.entities)):
            run, skipped, resumed = self._admit(plan)
            if skipped:
                return {"run": run, "status": "skipped"}
            try:
                counts = {e: self._reported(plan, run, e) for e in plan.entities}
                self._validate(plan, run)
            except Exception as e:
                self._finish(plan, run, "failed", f"{type(e).__name__}: {e}"[:500])
                raise
            self._finish(plan, run, "success")
            return {"run": run, "status": "success", "resumed_from": resumed, "items": counts, "processed": self._processed}

    @unraced
    def _admit(self, plan: Plan) -> tuple[int, bool, int | None]:
        base = self.store.manifest()
        now = F.lit(self.now()).cast("timestamp_ntz")
        runs, run_dumps, chunks, checks = (self.store.read(t, base) for t in ("run", "run_dump", "run_chunk", "checkpoint"))
        runs = admission.mark_abandoned(runs, run_dumps, plan.entities, now)
        catalog = self._read("dump")
        admission.preflight([(e, plan.dates[e]) for e in plan.entities], run_dumps, catalog)
        chosen = self.spark.createDataFrame([(e, plan.dates[e]) for e in plan.entities], "entity_type string, dump_date date")
        admission.assert_no_downgrade(chosen, checks, plan.allow_downgrade)
        if not plan.force and (hit := admission.current_successes(runs, run_dumps, checks, plan.manifest).first()):
            return hit.id, True, None
        resumed = None if plan.force else admission.resumable_runs(runs, run_dumps, chunks, checks, plan.manifest, len(plan.entities), plan.chunk_size).first()
        run = (runs.agg(F.max("id")).first()[0] or 0) + 1
        first = (catalog.agg(F.max("id")).first()[0] or 0) + 1
        new = [{"id": first + i, "etag": plan.checksums[e], "dump_date": plan.dates[e], "entity_type": e, "checksum_sha256": plan.checksums[e], "size_bytes": 0, "uri": plan.paths[e]} for i, e in enumerate(plan.entities)]
        catalog = merge.insert_ignore(catalog, self._rows("dump", *new), ["dump_date", "entity_type", "checksum_sha256"])
        ids = {r.entity_type: r.id for r in catalog.join(self._rows("dump", *new).select("dump_date", "entity_type", "checksum_sha256"), ["dump_date", "entity_type", "checksum_sha256"]).select("id", "entity_type").collect()}
        done, whole = {}, {}
        # fragments of runs that nobody will take up go; those of the resumed run become this run's
        pending = {k: v for k, v in base.pending.items() if k.split("/")[1] not in plan.entities}
        if resumed:
            done = {r.entity_type: r for r in ledger.summary(chunks.filter(F.col("import_run_id") == resumed.id)).collect()}
            whole = {r.entity_type: r for r in run_dumps.filter((F.col("import_run_id") == resumed.id) & F.col("completed_at").isNotNull()).collect()}
            chunks = ledger.transferred(chunks, resumed.id, run)
            pending |= {f"{run}/{e}": base.pending[f"{resumed.id}/{e}"] for e in plan.entities if f"{resumed.id}/{e}" in base.pending}
        row = {"id": run, "manifest_sha256": plan.manifest, "status": "running", "force_requested": plan.force, "allow_downgrade_requested": plan.allow_downgrade, "processor": "groovemill", "processor_version": "1", "resumed_from_run_id": resumed.id if resumed else None}
        dumps = [{"import_run_id": run, "entity_type": e, "dump_id": ids[e], "chunk_size": plan.chunk_size, "import_contract_revision": admission.REVISIONS[e], "processed_items": int(done[e].total_items) if e in done else 0, **{k: whole[e][k] for k in ("total_items", "total_chunks", "completed_at", "last_progress_at") if e in whole}} for e in plan.entities]
        state = self._read("entity_state")
        empty = [{"entity_type": e, "status": "ready"} for e in plan.entities]
        state = merge.insert_ignore(state, self._rows("entity_state", *empty), ["entity_type"])
        state = admission.states(state, plan.entities, run, "importing", now)
        self.store.commit({"run": runs.unionByName(self._rows("run", row)), "run_dump": run_dumps.unionByName(self._rows("run_dump", *dumps)), "run_chunk": chunks, "dump": catalog, "entity_state": state}, run, base, pending)
        return run, False, resumed.id if resumed else None

    def _dump(self, plan: Plan, entity: str) -> DataFrame:
        """The entity's dump, parsed and staged once in a run."""
        if entity not in self._dumps:
            self._dumps[entity] = stage_dump(self.spark, plan.paths[entity], entity, self.staging)
        return self._dumps[entity]

    def _references(self, plan: Plan) -> dict[str, DataFrame]:
        """Ids that references may point at: of this import's dump if the entity is selected, else of the store."""
        out = {}
        for e in ("artist", "label", "master"):
            out[e] = stored = self._read(e).select("id")
            if e in plan.paths:
                out[e] = relations.valid_ids(self._dump(plan, e), e)
                if plan.reference_scope == "store":
                    out[e] = out[e].unionByName(stored).distinct()
        for name in ("genre", "style"):
            out[name] = self._read(name)
        return out

    def _reported(self, plan: Plan, run: int, entity: str) -> int:
        """Imports one entity, with records of its beginning, its progress and its end. An entity that the resumed run
        had finished isn't imported again: nothing has been applied since, or the run couldn't be resumed."""

        def observe() -> tuple[int, int | None]:
            row = self._run_dump(run, entity).select("processed_items", "total_items").first()
            return (row.processed_items or 0, row.total_items) if row else (0, None)

        report, ok = Reporter(entity, observe), False
        report.start()
        try:
            row = self._run_dump(run, entity).filter(F.col("completed_at").isNotNull()).first()
            out = row.total_items if row else self._entity(plan, run, entity, report)
            ok = True
            return out
        finally:
            report.finish(ok)

    def _run_dump(self, run: int, entity: str) -> DataFrame:
        return self._read("run_dump").filter((F.col("import_run_id") == run) & (F.col("entity_type") == entity))

    def _fragments(self, plan: Plan, run: int, entity: str, own: DataFrame) -> dict[str, DataFrame]:
        """Rows of the entity's tables from elements, with identities, before anything of the store is needed."""
        seed = entity == "master" and admission.should_seed(self._read("entity_state"), run)
        roots = relations.root_rows(own, entity, F.lit(None).cast("timestamp_ntz"), seed, plan.as_of)
        return {relations.ROOT_TABLE[entity]: roots} | {s.table: relations.identified(relations.child_rows(own, s), s, plan.owner) for s in relations.of_entity(entity)}

    def _update_progress(self, run: int, entity: str, base, **values) -> DataFrame:
        names = {"processed_items": "long", "total_items": "long", "total_chunks": "long"}
        row = (run, entity, *(values.get(k) for k in names))
        source = self.spark.createDataFrame([row], "import_run_id long, entity_type string, " + ", ".join(f"{k} {v}" for k, v in names.items()))
        now = F.lit(self.now()).cast("timestamp_ntz")
        new = {k: F.col(f"s_{k}") for k in names if k in values} | {"last_progress_at": now}
        if "total_items" in values:
            new["completed_at"] = now
        return merge.update_from(self.store.read("run_dump", base), source, ["import_run_id", "entity_type"], new)

    def _still_running(self, run: int, base) -> None:
        """Refuses to go on for a run that isn't running as of a generation; a later change makes the commit fail."""
        if self.store.read("run", base).filter((F.col("id") == run) & (F.col("status") == "running")).isEmpty():
            raise ImportRefused(f"run {run} isn't running any more")

    def _process(self, plan: Plan, run: int, entity: str, dump: DataFrame, own: DataFrame, total: int, report: Reporter) -> None:
        """Writes the fragments of chunks that aren't on record, some chunks at a time, each time with their ledger rows."""
        size, key = plan.chunk_size, f"{run}/{entity}"
        rest = resume_rows(own, dump, ledger.of_run(self._read("run_chunk"), run, entity), size)
        have = {r.chunk_index for r in ledger.completed(self._read("run_chunk"), run, entity).collect()}  # a number a chunk
        open_ = [i for i in range(-(-total // size)) if i not in have]
        for at in range(0, len(open_), plan.commit_chunks):
            part = open_[at : at + plan.commit_chunks]
            low, high = part[0] * size, (part[-1] + 1) * size
            rows = rest.filter((F.col("ordinal") >= low) & (F.col("ordinal") < high))
            paths = self.store.fragments(key, self._fragments(plan, run, entity, rows))
            self._record(plan, run, entity, dump.filter((F.col("ordinal") >= low) & (F.col("ordinal") < high)), part, paths, total)
            items = sum(min(size, total - i * size) for i in part)
            self._processed[entity] += items
            report.report_if_due()

    @unraced
    def _record(self, plan: Plan, run: int, entity: str, dump: DataFrame, part: list[int], paths: dict[str, str], total: int) -> None:
        base = self.store.manifest()
        self._still_running(run, base)
        now = F.lit(self.now()).cast("timestamp_ntz")
        own = [F.lit(run).cast("long").alias("import_run_id"), F.lit(entity).alias("entity_type")]
        chunks = source_chunks(dump, plan.chunk_size).filter(F.col("chunk_index").isin(part))
        book = self.store.read("run_chunk", base)
        whole = ledger.record(book, chunks.select(*own, "chunk_index", "first_item_index", "item_count", now.alias("completed_at")))
        done = ledger.of_run(book, run, entity).agg(F.coalesce(F.sum("item_count"), F.lit(0))).first()[0] + sum(min(plan.chunk_size, total - i * plan.chunk_size) for i in part)
        key = f"{run}/{entity}"
        mine = {t: [*base.pending.get(key, {}).get(t, []), path] for t, path in paths.items()}
        self.store.commit({"run_chunk": whole, "run_dump": self._update_progress(run, entity, base, processed_items=int(done))}, run, base, base.pending | {key: mine})

    def _pending(self, base, key: str, table: str, schema: StructType) -> DataFrame:
        paths = base.pending.get(key, {}).get(table)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self.store.files.path(p) for p in paths])

    def _entity(self, plan: Plan, run: int, entity: str, report: Reporter) -> int:
        """Imports one entity: its fragments first, then its tables and its ledger in one step."""
        dump = self._dump(plan, entity)
        own = relations.valid_roots(dump, entity)
        total = dump.count()
        self._process(plan, run, entity, dump, own, total, report)
        self._apply(plan, run, entity, own, total)
        return total

    @unraced
    def _apply(self, plan: Plan, run: int, entity: str, own: DataFrame, total: int) -> None:
        base, key = self.store.manifest(), f"{run}/{entity}"
        self._still_running(run, base)
        observed = F.lit(self.now()).cast("timestamp_ntz")
        stored = lambda t: self.store.read(t, base)
        new = {t: self._pending(base, key, t, df.schema) for t, df in self._fragments(plan, run, entity, own).items()}
        refs = self._references(plan)
        frames: dict[str, DataFrame] = {}
        table = relations.ROOT_TABLE[entity]
        roots = new[table].withColumns(dict.fromkeys(("created_at", "last_modified_at"), observed))
        if entity == "release":
            roots = relations.with_known_master(roots, refs["master"])
        merged = merge.merge_upsert(stored(table), roots, ["id"], keep=("main_release_id",))
        if entity in ("master", "release"):
            prefix = "master" if entity == "master" else "release_item"
            for name in ("genre", "style"):
                found = relations.dictionary([new[f"{prefix}_{name}"]], name)
                frames[name] = merge.insert_ignore(stored(name), found, ["name"])
                refs[name] = frames[name]
        touched = new[table].select(F.col("id").alias("root")).distinct()
        for spec in relations.of_entity(entity):
            rows = canonical.canonical(relations.referenced(new[spec.table], spec, refs), spec, plan.owner).withColumn("last_modified_at", observed)
            frames[spec.table] = merge.converge(stored(spec.table), rows, spec.root, spec.stale_key, touched)
        frames[table] = merged
        if entity == "release":
            frames["master"] = merge.reconcile_main(stored("master"), merged)
        totals = self.spark.createDataFrame([(run, entity, total, plan.chunk_size)], "import_run_id long, entity_type string, total long, chunk_size int")
        proof = ledger.coverage(ledger.of_run(stored("run_chunk"), run, entity), totals).first()
        if not proof.is_complete:
            raise ImportRefused(f"chunks of {entity} don't cover its {total} items")
        frames["run_dump"] = self._update_progress(run, entity, base, processed_items=total, total_items=total, total_chunks=proof.completed_chunks)
        self.store.commit(frames, run, base, {k: v for k, v in base.pending.items() if k != key})

    def _validate(self, plan: Plan, run: int) -> None:
        """References of entities that are imported for the first time must all exist, as constraints would have it."""
        first = {r.entity_type for r in self._read("entity_state").filter((F.col("operation") == "bootstrap") & (F.col("active_import_run_id") == run)).collect()}
        names = {"genre": "name", "style": "name"}
        lost = [merge.missing_references(self._read(s.table), c, self._read(ref), names.get(ref, "id")).select(F.lit(f"{s.table}.{c}").alias("at")) for e in plan.entities if e in first for s in relations.of_entity(e) for c, ref in s.refs]
        if lost and (bad := functools.reduce(DataFrame.unionByName, lost).first()):
            raise ImportRefused(f"{bad['at']} refers to rows that don't exist")

    @unraced
    def _finish(self, plan: Plan, run: int, status: str, message: str | None = None) -> None:
        base = self.store.manifest()
        now = F.lit(self.now()).cast("timestamp_ntz")
        run_dumps = self._read("run_dump")
        undone = run_dumps.filter((F.col("import_run_id") == run) & (F.col("completed_at").isNull() | ~F.col("processed_items").eqNullSafe(F.col("total_items")))).count()
        if status == "success" and undone:
            status, message = "failed", f"{undone} entities aren't complete"
        source = self.spark.createDataFrame([(run,)], "id long")
        values = {"status": F.lit(status), "completed_at": now, "failure_message": F.lit(message).cast("string")}
        runs = merge.update_from(self._read("run"), source, ["id"], values)
        state = admission.states(self._read("entity_state"), plan.entities, run, "ready" if status == "success" else "failed", now, message)
        frames = {"run": runs, "entity_state": state}
        checks = self._read("checkpoint")
        if status == "success":
            new = self._rows("checkpoint", *[{"entity_type": e, "dump_date": plan.dates[e], "import_run_id": run, "applied_at": self.now()} for e in plan.entities])
            checks = checks.join(new.select("entity_type"), "entity_type", "left_anti").select(*checks.columns).unionByName(new)
            frames["checkpoint"] = checks
            frames["run_chunk"] = admission.pruned(self._read("run_chunk"), runs, run_dumps, checks)
        self.store.commit(frames, run, base)


def resume_rows(rows: DataFrame, dump: DataFrame, done: DataFrame, size: int) -> DataFrame:
    """The rows in chunks of the dump that aren't done; a window that differs from the record is refused."""
    if done.isEmpty():
        return rows
    if not ledger.mismatched(source_chunks(dump, size), done).isEmpty():
        raise ImportRefused("chunks on record don't fit this dump")
    return ledger.remaining(rows.withColumn("chunk_index", chunk_index(F.col("ordinal"), size)), done).drop("chunk_index")
