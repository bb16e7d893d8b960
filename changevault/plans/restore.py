"""Restore jobs: preview and CSV payload of a past state."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changevault.functions.records import stringify
from changevault.model import RESTORE_BULK_SIZE, NothingToRestore, ObjectSpec, col, is_system
from changevault.operators.latest import before, is_record, last_good_state
from changevault.operators.lineage import CANONICAL_ID, CORE, reference_edges, restore_plan, rewrite_refs_to_any
from changevault.operators.lookup import hot_among, key_counts, lookup_join
from changevault.session import checkpoint, local_frame
from changevault.sources.canonical import read_ids, register_ids
from changevault.sources.raw import read_columns, read_raw
from changevault.sources.restore_csv import write_restore_csv


def restore_preview(
    raw: DataFrame,
    spec: ObjectSpec,
    at: str | datetime,
    record_id: str | int | None = None,
) -> DataFrame:
    """``(record_json)``: each record as a JSON object of text values, keys sorted. Writes nothing."""
    rows = last_good_state(raw, spec, at, record_id)
    names = sorted(c for c in rows.columns if not is_system(c) or c == "_overflow")
    return stringify(rows, names).select(F.to_json(F.struct(*[col(c) for c in names])).alias("record_json"))


def restore_export(
    raw: DataFrame,
    spec: ObjectSpec,
    at: str | datetime,
    path: str,
    record_id: str | int | None = None,
    bulk_size: int = RESTORE_BULK_SIZE,
    exclude: Sequence[str] = (),
) -> None:
    """Write the upsert payload; an error when there is nothing to restore.

    That check asks for any version before the moment, which ends at the first one found,
    instead of ranking all of them twice.
    """
    rows = last_good_state(raw, spec, at, record_id)
    versions = before(raw, spec, at)
    if record_id is not None and record_id != "":
        versions = versions.where(is_record(raw, spec, record_id))
    if versions.isEmpty():
        raise NothingToRestore(f"object {spec.name}: no records found before {at}")
    write_restore_csv(rows.drop(*exclude), path, bulk_size)


@dataclass(frozen=True)
class RelatedPages:
    """Where one payload of an object lies; pages of a lower level go first, and of one level those of a lower wave.

    ``fills`` names the references that a payload adds to records sent before; other payloads hold whole records.
    """

    object: str
    level: int
    path: str
    wave: int = 0
    fills: tuple[str, ...] = ()


def restore_related(
    spark: SparkSession,
    specs: Sequence[ObjectSpec],
    catalog: DataFrame,
    root: str,
    at: str | datetime,
    path: str,
    bulk_size: int = RESTORE_BULK_SIZE,
) -> list[RelatedPages]:
    """Write the past state of several related objects, parents before children, in the order to send the pages.

    ``catalog`` names the references (``reference_to``). Every record carries its canonical id, and a reference to
    ``specs`` is written as the parent's canonical id, in a column for each object the field may name; other
    references stay, also those of a field that may name records of other objects besides. Ids missing so far are
    stored first.

    An object that refers to itself gets a folder for each wave of its records, managers before their staff. Where
    references form a cycle, of objects or of one object's records, the records go without them first, and a second
    payload of canonical id and references fills them in.
    """
    by_name = {s.name: s for s in specs}
    named = local_frame(spark, [(n, n) for n in by_name], "object string, parent string")
    stored = {(s.name, c.name) for s in specs for c in read_columns(spark, s, root) or ()}
    edges = reference_edges(catalog).where(F.col("object").isin(*by_name)).collect()
    edges = sorted((r for r in edges if (r.object, r.field) in stored), key=lambda r: (r.object, r.field, r.place))
    links = [r for r in edges if r.parent in by_name]
    outward = {(r.object, r.field) for r in edges if r.parent not in by_name}
    told = local_frame(spark, [(r.object, r.parent) for r in links], "object string, parent string")
    plan = {r.object: r for r in restore_plan(told.unionByName(named)).collect()}
    core = {n for n, r in plan.items() if r.place == CORE}
    for spec in specs:
        register_ids(spark, spec, root)
    pages = []
    for name in sorted(by_name):
        parents: dict[str, list[str]] = {}
        for r in links:
            if r.object == name:
                parents.setdefault(r.field, []).append(r.parent)
        job = _Payload(by_name[name], plan[name].level, f"{path}/{plan[name].level:02d}-{name}", bulk_size)
        raw = read_raw(spark, by_name[name], root)
        state, versions = last_good_state(raw, by_name[name], at), before(raw, by_name[name], at)
        own = [field for field, names in parents.items() if name in names]
        waves = _record_waves(state, by_name[name], own) if own and name not in core else None
        rows = _with_ids(spark, by_name[name], root, state)
        for field, names in parents.items():
            ids = {n: read_ids(spark, by_name[n], root) for n in names}
            # counted on all versions, at least as many as rows, for a count of the rows would rank and join them once more
            hot = hot_among(key_counts(versions, field), rows.schema)
            rows = rewrite_refs_to_any(rows, field, ids, keep_unknown=(name, field) in outward, hot=hot)
        column = {(f, n): f"{f}:{n}:{CANONICAL_ID}" for f, names in parents.items() for n in names}
        if name in core:
            pages += job.in_two_steps(rows, [c for (_, n), c in column.items() if n in core])
        elif waves is not None:
            pages += job.in_waves(rows, waves, [column[f, name] for f in own])
        else:
            pages.append(job.whole(rows))
    return sorted(pages, key=lambda p: (p.level, p.wave, p.object, bool(p.fills)))


def _with_ids(spark: SparkSession, spec: ObjectSpec, root: str, rows: DataFrame) -> DataFrame:
    """Rows, one a key, with their ids; so no key is hot."""
    ids = read_ids(spark, spec, root).withColumnRenamed(spec.primary_key, "__id_key")
    return lookup_join(rows, ids, spec.primary_key, "__id_key", hot=[]).drop("__id_key")


def _record_waves(rows: DataFrame, spec: ObjectSpec, own: Sequence[str]) -> DataFrame:
    """``(__record, place, __wave)`` of every record, by its references to records of the same state."""
    key = col(spec.primary_key).alias("object")
    keys = rows.select(key)
    kind = rows.schema[spec.primary_key].dataType
    refs = rows.select(key, F.explode(F.array(*[col(f).try_cast(kind) for f in own])).alias("parent"))
    inside = refs.join(keys.select(F.col("object").alias("parent")), "parent", "left_semi").select("object", "parent")
    plan = restore_plan(inside.unionByName(keys.select("object", F.col("object").alias("parent"))))
    return checkpoint(plan.select(F.col("object").alias("__record"), "place", F.col("level").alias(_WAVE)))


_WAVE = "_wave"


@dataclass(frozen=True)
class _Payload:
    """The pages of one object."""

    spec: ObjectSpec
    level: int
    path: str
    bulk_size: int

    def whole(self, rows: DataFrame) -> RelatedPages:
        write_restore_csv(rows, self.path, self.bulk_size)
        return RelatedPages(self.spec.name, self.level, self.path)

    def in_two_steps(self, rows: DataFrame, cyclic: Sequence[str]) -> list[RelatedPages]:
        first = self.whole(rows.withColumns({c: F.lit(None).cast("string") for c in cyclic}))
        return [first, self._filled(rows, cyclic, self.level + 1, 0)]

    def in_waves(self, rows: DataFrame, waves: DataFrame, own: Sequence[str]) -> list[RelatedPages]:
        """A folder for each wave; records on a cycle go without their own-object references at first."""
        found = sorted(waves.select(_WAVE, "place").distinct().collect())
        placed = rows.join(waves, col(self.spec.primary_key) == F.col("__record")).drop("__record")
        cyclic = [wave for wave, place in found if place == CORE]
        whole = placed.withColumns({c: F.when(F.col("place") != CORE, col(c)) for c in own}) if cyclic else placed
        write_restore_csv(whole.drop("place"), self.path, self.bulk_size, folders_by=_WAVE)
        pages = [RelatedPages(self.spec.name, self.level, f"{self.path}/{_WAVE}={w}", w) for w, _ in found]
        if cyclic:
            pages.append(self._filled(placed.where(F.col("place") == CORE), own, self.level, cyclic[0] + 1))
        return pages

    def _filled(self, rows: DataFrame, columns: Sequence[str], level: int, wave: int) -> RelatedPages:
        some = reduce(Column.__or__, [col(c).isNotNull() for c in columns])
        target = f"{self.path}-references"
        write_restore_csv(rows.where(some).select(col(CANONICAL_ID), *map(col, columns)), target, self.bulk_size)
        return RelatedPages(self.spec.name, level, target, wave, tuple(columns))
