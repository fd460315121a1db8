"""Semantic identities: exact duplicates collapse, conflicts are errors, colliding hashes get slots of their own."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hashing
from .relations import SHAPES, Relation


def collapse(rows: DataFrame, identity: Sequence[str], payload: Sequence[str], order: Sequence[str], strict: bool = True) -> DataFrame:
    """The first row by order of each identity. If strict, an identity whose rows differ in payload is an error when it
    is read. Partial aggregation keeps one row per identity and task before the shuffle."""
    rest = [c for c in rows.columns if c not in identity]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("first")
    if not payload:
        return rows.groupBy(*identity).agg(first).select(*identity, "first.*")
    # min and max of the payload differ if and only if two payloads do; nulls are values inside a struct
    low, high = F.min(F.struct(*payload)), F.max(F.struct(*payload))
    out = rows.groupBy(*identity).agg(first, (~low.eqNullSafe(high)).alias("differs"))
    if strict:
        says = F.concat(F.lit("conflicting payloads for "), F.to_json(F.struct(*[F.col(c).cast("string").alias(c) if c != "identity_sha256" else F.hex(c).alias(c) for c in identity])))
        out = out.filter(F.when(F.col("differs"), F.raise_error(says).cast("boolean")).otherwise(True))
    return out.select(*identity, "first.*")


def conflicts(rows: DataFrame, identity: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Identities with more than one payload, and how many."""
    n = F.count_distinct(F.struct(*payload)).alias("n_payloads")
    return rows.groupBy(*identity).agg(n).filter("n_payloads > 1")


def allocate(rows: list[tuple[int, bytes]], ask: Callable[[bytes, int], int], attempts: int = 1 << 32) -> list[int]:
    """Slots of one scope's (legacy hash, digest) rows, in their order.

    All legacy hashes are reserved. By ascending hash, the smallest digest keeps it; each other one takes the first slot
    it asks for that is neither reserved nor taken."""
    if len({d for _, d in rows}) < len(rows):
        raise ValueError("identities must be distinct before slots are given")
    reserved, taken, out = {h for h, _ in rows}, set(), {}
    for h in sorted(reserved):
        first, *others = sorted(d for g, d in rows if g == h)
        out[first] = h
        taken.add(h)
        for d in others:
            for attempt in range(attempts):
                s = ask(d, attempt)
                if s not in reserved and s not in taken:
                    break
            else:
                raise ValueError("no slot is left")
            out[d] = s
            taken.add(s)
    return [out[d] for _, d in rows]


def with_slots(rows: DataFrame, spec: Relation, owner: str = hashing.OWNER) -> DataFrame:
    """rows with `hash` replaced by slots. One exchange brings the rows of a scope together; scopes without a collision,
    nearly all, keep their hashes in SQL; only scopes with one go to Python, each by itself."""
    if not spec.digest:
        return rows
    own = rows.repartition(*spec.scope)
    own = own.withColumn("n_same", F.count("*").over(Window.partitionBy(*spec.scope, "hash")))
    own = own.withColumn("n_same", F.max("n_same").over(Window.partitionBy(*spec.scope)))
    relation = spec.digest

    def probe(table: pa.Table) -> pa.Table:
        pairs = list(zip(table["hash"].to_pylist(), table["identity_sha256"].to_pylist(), strict=True))
        slots = allocate(pairs, lambda d, attempt: hashing.slot_of(relation, d, attempt, owner))
        at = table.schema.get_field_index("hash")
        return table.set_column(at, table.schema.field(at), pa.array(slots, table.schema.field(at).type))

    crowded = own.filter("n_same > 1").drop("n_same")
    return own.filter("n_same = 1").drop("n_same").unionByName(crowded.groupBy(*spec.scope).applyInArrow(probe, crowded.schema))


def canonical(rows: DataFrame, spec: Relation, owner: str = hashing.OWNER) -> DataFrame:
    """A relation's rows with identities, each once and with its slot. Other shapes of identities than SHAPES are refused."""
    if spec.shape not in SHAPES:
        raise ValueError(f"{spec.table} has an identity of {', '.join(spec.shape)}")
    rest = [c for c in (*spec.payload, *(["hash"] if spec.digest else [])) if c in rows.columns]
    once = collapse(rows, spec.identity, rest, ["place", *rest])
    return with_slots(once, spec, owner).select(*spec.columns)
