"""Sync jobs: extract -> typed rows -> raw history, under a watermark."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass
from datetime import datetime
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from changevault.functions.coerce import coerce, required_violations
from changevault.functions.records import extract_fields, spill_overflow
from changevault.model import (
    MAX_IN_FLIGHT, PAGE, ColumnDef, DriftHalted, ObjectSpec, check_case_collisions, col, excludes_frame,
    is_system, pick_specs,
)
from changevault.operators.schema import columns_from_catalog, detect_drift, without_intentional
from changevault.operators.watermark import drop_seen, incremental, job_start_watermark
from changevault.session import from_micros, local_frame, moment, now, to_micros
from changevault.sources.extract import pick_fields, read_extract
from changevault.sources.ledger import History, history, sync_state
from changevault.sources.raw import add_columns, append_raw, ensure_table, read_commits


_STAMP = "_stamp"


@dataclass(frozen=True)
class SyncResult:
    """What one sync did. ``rows`` is 0 for an empty batch and for a repeated sync id; ``rejects`` rows were set aside."""

    object: str
    sync_id: str
    rows: int = 0
    commit_id: str | None = None
    watermark: datetime | None = None
    skipped: bool = False
    new_columns: tuple[str, ...] = ()
    removed_columns: tuple[str, ...] = ()
    type_changes: tuple[str, ...] = ()
    rejects: int = 0


@dataclass(frozen=True)
class Prepared:
    """Table columns after drift handling, and what the drift was."""

    columns: tuple[ColumnDef, ...]
    source_fields: tuple[str, ...]
    new: tuple[str, ...]
    removed: tuple[str, ...]
    changed: tuple[str, ...]


def desired_columns(catalog: DataFrame, spec: ObjectSpec) -> list[ColumnDef]:
    """One object's columns in catalog order; field metadata only, so it may reach the driver."""
    fields = catalog.where(F.col("object") == spec.name)
    if "position" not in fields.columns:
        fields = fields.withColumn("position", F.monotonically_increasing_id())
    wanted = columns_from_catalog(fields, excludes_frame(catalog.sparkSession, [spec]))
    found = sorted(wanted.collect(), key=lambda r: r.position)
    return [ColumnDef(r.name, r.type, r.required) for r in found]


def prepare_table(spark: SparkSession, spec: ObjectSpec, catalog: DataFrame, root: str) -> Prepared:
    """Create the table when missing, find drift, apply the policies, evolve the schema."""
    desired = desired_columns(catalog, spec)
    stored = ensure_table(spark, spec, root, desired)
    drift = without_intentional(
        detect_drift(_frame(spark, spec, stored), _frame(spark, spec, desired)), catalog
    )
    found = {k: [] for k in ("new", "removed", "type_change")}
    for row in drift.select("change", "name").collect():
        found[row.change].append(row.name)
    if found["removed"] and spec.removed_field_policy == "halt":
        raise DriftHalted(f"object {spec.name}: columns removed at the source: {sorted(found['removed'])}")
    if not spec.overflow:
        added = [ColumnDef(c.name, c.type) for c in desired if c.name in set(found["new"])]
        check_case_collisions(c.name for c in [*stored, *added])
        add_columns(spark, spec, root, added, start=len(stored))
        stored = [*stored, *added]
    return Prepared(
        tuple(stored),
        tuple(c.name for c in desired),
        *[tuple(sorted(found[k])) for k in ("new", "removed", "type_change")],
    )


def sync_frame(
    spark: SparkSession,
    spec: ObjectSpec,
    frame: DataFrame,
    catalog: DataFrame,
    root: str,
    sync_id: str | None = None,
    job_start: str | datetime | None = None,
    job_id: str | None = None,
    strategy: str = "batch_max",
    dedupe_overlap: bool = False,
    filter_watermark: bool = True,
    max_records_per_file: int | None = None,
    on_error: str = "fail",
) -> SyncResult:
    """Sync one object from a frame of text columns.

    ``strategy`` picks the next watermark: the newest stamp written (``batch_max``) or the
    job's start less five minutes (``job_start``); with the latter ``dedupe_overlap`` drops rows
    the previous sync already brought. ``on_error`` says what text that does not fit its column does: stop the sync,
    naming column, value and record (``fail``), become NULL (``null``), or set the whole row aside (``reject``), for
    :func:`changevault.sources.raw.read_rejects`.
    """
    if strategy not in ("batch_max", "job_start"):
        raise ValueError("strategy must be 'batch_max' or 'job_start'")
    sync_id = sync_id or uuid4().hex
    started = moment(job_start) if job_start else now()
    done, last = sync_state(spark, root, spec.name, sync_id)
    if done:
        return SyncResult(spec.name, sync_id, watermark=last, skipped=True)
    known = history(spark, root, spec.name)

    table = prepare_table(spark, spec, catalog, root)
    rows = _typed_rows(spec, frame, table, on_error)
    if filter_watermark and spec.watermark_field in rows.columns:
        rows = incremental(rows, spec, known.watermark)
    if dedupe_overlap and known.watermark is not None:
        seen = read_commits(spark, spec, root, table.columns, _overlapping(known, spec))
        rows = drop_seen(rows, seen, spec, since=known.watermark)

    watermark = job_start_watermark(started) if strategy == "job_start" else None
    if watermark is None and spec.watermark_field not in {c.name for c in table.columns}:
        watermark = _watermark_of(rows, spec)
    entry = append_raw(
        _without_stray_stamp(rows, spec, table), spec, root, sync_id, started, watermark, table.columns, job_id,
        max_records_per_file, known,
    )
    drift = dict(
        new_columns=table.new, removed_columns=table.removed, type_changes=table.changed
    )
    if entry is None:
        return SyncResult(spec.name, sync_id, watermark=known.watermark, **drift)
    return SyncResult(
        spec.name, sync_id, entry.n_rows, entry.commit_id if entry.n_rows else None, entry.watermark, **drift,
        rejects=entry.n_rejects,
    )


def sync_object(
    spark: SparkSession,
    spec: ObjectSpec,
    extract: str | Sequence[str],
    catalog: DataFrame,
    root: str,
    multi_line: bool = True,
    mixed_headers: bool = False,
    **options,
) -> SyncResult:
    """Sync one object from the CSV pages under ``extract``; options as in :func:`sync_frame`."""
    name_pages = options.get("on_error") == "reject"
    frame = read_extract(spark, extract, multi_line=multi_line, mixed_headers=mixed_headers, name_pages=name_pages)
    return sync_frame(spark, spec, frame, catalog, root, **options)


def sync_all(
    spark: SparkSession,
    specs: Sequence[ObjectSpec],
    extracts: dict[str, str] | Callable[[str], str],
    catalog: DataFrame,
    root: str,
    only: str | None = None,
    max_in_flight: int = MAX_IN_FLIGHT,
    **options,
) -> list[SyncResult]:
    """Sync several objects side by side; the first error cancels the others and is raised.

    The threads only submit Spark jobs, which the cluster runs concurrently.
    """
    chosen = pick_specs(specs, only)
    locate = extracts if callable(extracts) else extracts.__getitem__
    tag = f"changevault-{uuid4().hex}"

    def run(spec: ObjectSpec) -> SyncResult:
        spark.sparkContext.addJobTag(tag)
        try:
            return sync_object(spark, spec, locate(spec.name), catalog, root, **options)
        finally:
            spark.sparkContext.removeJobTag(tag)

    with ThreadPoolExecutor(max_workers=max_in_flight) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(run), s) for s in chosen]
        done, waiting = wait(futures, return_when=FIRST_EXCEPTION)
        failed = next((f for f in futures if f in done and f.exception()), None)
        if failed is not None:
            for future in waiting:
                future.cancel()
            while waiting:  # a running sync may submit another job after a cancel
                spark.sparkContext.cancelJobsWithTag(tag)
                waiting = wait(waiting, timeout=0.5).not_done
            raise failed.exception()
    return [f.result() for f in futures]


def sync_violations(spark: SparkSession, spec: ObjectSpec, root: str, commit_id: str) -> DataFrame:
    """``(column, n)``: NULLs in required columns of one commit. Reported, not refused."""
    columns = ensure_table(spark, spec, root, [])
    return required_violations(read_commits(spark, spec, root, columns, [commit_id]), columns)


def _typed_rows(spec: ObjectSpec, frame: DataFrame, table: Prepared, on_error: str) -> DataFrame:
    """Columns asked for, in stored types; in overflow mode the rest as one JSON column.

    A watermark field that is no table column is kept beside them, to find the new watermark.
    """
    stored = [c.name for c in table.columns]
    wanted = extract_fields([*stored, *table.source_fields], spec.watermark_field, spec.deleted_field)
    have = set(frame.columns)
    rows = pick_fields(frame, [f for f in wanted if f in have or f in set(stored)] + [c for c in (PAGE,) if c in have])
    types = list(table.columns)
    stamp = spec.watermark_field
    apart = stamp in rows.columns and stamp not in stored
    if apart:
        types.append(ColumnDef(stamp, "timestamp"))
    if spec.overflow:
        kept = rows.withColumn(_STAMP, col(stamp)) if apart else rows
        rows = spill_overflow(kept, stored)
        rows = rows.withColumnRenamed(_STAMP, stamp) if apart else rows
    return coerce(rows, types, on_error, spec.primary_key)


def _without_stray_stamp(rows: DataFrame, spec: ObjectSpec, table: Prepared) -> DataFrame:
    """A watermark field that is no table column has served its purpose once the watermark is known."""
    stored = {c.name for c in table.columns}
    return rows if spec.watermark_field in stored else rows.drop(spec.watermark_field)


def _watermark_of(rows: DataFrame, spec: ObjectSpec) -> datetime | None:
    """Newest stamp of a batch whose watermark field is no table column."""
    if not spec.watermark_field or spec.watermark_field not in rows.columns:
        return None
    return from_micros(rows.agg(F.unix_micros(F.max(col(spec.watermark_field)))).first()[0])


def _overlapping(known: History, spec: ObjectSpec) -> list[str]:
    """Live commits that hold stamps after the watermark."""
    bound = to_micros(known.watermark)
    return [c.commit_id for c in known.commits if c.max_stamp_us is None or c.max_stamp_us > bound]


def _frame(spark: SparkSession, spec: ObjectSpec, columns: Sequence[ColumnDef]) -> DataFrame:
    return local_frame(
        spark, [(spec.name, c.name, c.type, c.required) for c in columns if not is_system(c.name)],
        "object string, name string, type string, required boolean",
    )
