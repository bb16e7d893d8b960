"""Maintenance jobs on the raw history: compaction and retention. One at a time per object."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from changevault.model import COMMIT, RETENTION_DAYS, ObjectSpec, col
from changevault.operators.latest import since, table_as_of
from changevault.session import from_micros, moment, now, to_micros
from changevault.sources.ledger import IDS, MAINTENANCE, RAW, Entry, history, new_commit_id, publish
from changevault.sources.raw import Staged, read_columns, read_commits, stage, stage_split, stored_files


@dataclass(frozen=True)
class MaintenanceResult:
    """The commits replaced and what replaced them; for a dry run what would be. ``rows`` were written anew, and
    what was replaced lay in ``files`` of ``bytes`` (compaction tells these)."""

    object: str
    replaced: tuple[str, ...]
    commits: tuple[str, ...] = ()
    rows: int = 0
    files: int = 0
    bytes: int = 0

    @property
    def commit_id(self) -> str | None:
        return self.commits[0] if self.commits else None


# Sync ids of maintenance commits begin with these.
PACKED, BASELINE, KEPT = "compact-", "expire-baseline-", "expire-"
#: A packed commit is packed again once it and those not larger add up to so many times its rows.
FAN_IN = 8
#: A commit whose files are half as large as this on average stays as it is.
FILE_BYTES = 64 << 20


def compact(
    spark: SparkSession,
    spec: ObjectSpec,
    root: str,
    day: date | None = None,
    lookback_days: int = 1,
    dry_run: bool = False,
    fan_in: int = FAN_IN,
    file_bytes: int = FILE_BYTES,
) -> MaintenanceResult:
    """Pack the small commits of one data day into one; rows and their sync ids stay the same.

    A commit belongs to the UTC day of its newest stamp (without stamps, to the day it was published on), so the
    days share no commit and a finished day is never touched by another day's run. The default day is today less
    ``lookback_days``. Of that day's commits these are packed:

    * commits of syncs, unless their files are about ``file_bytes`` large already;
    * commits that maintenance wrote, once they and the chosen ones not larger than them hold ``fan_in`` times their
      rows. So a row is written again at most once for each ``fan_in``-fold growth of its day, however often the
      job runs.

    The baseline of :func:`expire` is never packed. A lone commit is rewritten only if a partition of it has several
    files. File sizes follow the session's ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
    """
    day = day or (now() - timedelta(days=lookback_days)).date()
    known = history(spark, root, spec.name)
    of_day = [c for c in known.commits if _data_day(c) == day and not c.sync_id.startswith(BASELINE)]
    if not any(c.kind == RAW for c in of_day):
        return MaintenanceResult(spec.name, ())
    stored = {r.commit_id: r for r in stored_files(spark, spec, root, [c.commit_id for c in of_day]).collect()}
    chosen = _to_pack(of_day, stored, fan_in, file_bytes)
    sizes = [stored[c.commit_id] for c in chosen]
    if len(chosen) < 2 and all(s.n_files == s.n_partitions for s in sizes):
        return MaintenanceResult(spec.name, ())
    told = dict(files=sum(s.n_files for s in sizes), bytes=sum(s.n_bytes for s in sizes))
    if dry_run:
        return MaintenanceResult(spec.name, tuple(c.commit_id for c in chosen), (), sum(c.n_rows for c in chosen), **told)
    columns = read_columns(spark, spec, root)
    rows = _rows(spark, spec, root, columns, chosen)
    return replace(_replace(spark, spec, root, chosen, [(PACKED, stage(rows, spec, root, columns))]), **told)


def _to_pack(commits: Sequence[Row], stored: dict[str, Row], fan_in: int, file_bytes: int) -> list[Row]:
    """Small commits of syncs, and of those that maintenance wrote as many as have ``fan_in`` times their rows beside
    and below them."""
    small = [c for c in commits if stored[c.commit_id].n_bytes < stored[c.commit_id].n_files * (file_bytes // 2)]
    chosen = [c for c in small if c.kind == RAW]
    packed = sorted((c for c in small if c.kind == MAINTENANCE), key=lambda c: c.n_rows)
    total, taken = sum(c.n_rows for c in chosen), 0
    for i, commit in enumerate(packed, 1):
        total += commit.n_rows
        if total >= fan_in * commit.n_rows:
            taken = i
    return chosen + packed[:taken]


def expire(
    spark: SparkSession,
    spec: ObjectSpec,
    root: str,
    keep_days: int = RETENTION_DAYS,
    as_of: str | datetime | None = None,
) -> MaintenanceResult:
    """Drop versions older than the retention window, but never a key's only past.

    The newest version of each key before the cutoff stays, so that every moment inside the
    window can still be restored. These rows are a commit of their own, the baseline. It is read
    again only with commits that newly reach back beyond the cutoff. What these hold inside the window is
    written as commits that span 1, 2, 4, ... days from the cutoff on, so a daily run rewrites the
    days next to its cutoff often and later ones seldom.
    """
    cutoff = (moment(as_of) if as_of else now()) - timedelta(days=keep_days)
    known = history(spark, root, spec.name)
    old = [c for c in known.commits if c.min_stamp_us is not None and c.min_stamp_us < to_micros(cutoff)]
    crossing = [c for c in old if not c.sync_id.startswith(BASELINE)]
    if not crossing:
        return MaintenanceResult(spec.name, ())
    columns = read_columns(spark, spec, root)
    rows = _rows(spark, spec, root, columns, old)
    baseline = stage(table_as_of(rows, spec, cutoff), spec, root, columns)
    days = (F.unix_micros(col(spec.watermark_field).cast("timestamp")) - to_micros(cutoff)) / 86_400_000_000
    span = F.floor(F.log2(days + 1)).cast("int")
    kept = stage_split(since(rows, spec, cutoff), spec, root, columns, span)
    return _replace(spark, spec, root, old, [(BASELINE, baseline), *((KEPT, s) for s in kept)])


def retained(raw: DataFrame, spec: ObjectSpec, cutoff: str | datetime, tiebreak=None) -> DataFrame:
    """Rows at or after the cutoff, rows without a stamp, and each key's newest row before it."""
    return since(raw, spec, cutoff).unionByName(table_as_of(raw, spec, cutoff, tiebreak))


def _data_day(commit: Row) -> date:
    micros = commit.committed_us if commit.max_stamp_us is None else commit.max_stamp_us
    return from_micros(micros).astimezone(timezone.utc).date()


def _rows(spark, spec, root, columns, chosen: Sequence[Row]) -> DataFrame:
    rows = read_commits(spark, spec, root, columns, [c.commit_id for c in chosen])
    return rows.drop(COMMIT)


def _replace(spark, spec, root, chosen: Sequence[Row], made: list[tuple[str, Staged]]) -> MaintenanceResult:
    """Publish the new commits in one step; they wait for a merge, or the registry, if any of what they replace does."""
    merged = not any(c.pending for c in chosen)
    replaced = tuple(c.commit_id for c in chosen)
    publish(spark, root, *[
        Entry(
            spec.name, MAINTENANCE, f"{job}{s.commit_id}", s.commit_id, s.n_rows, replaces=replaced,
            covers=[s.commit_id] if merged else [], min_stamp=s.min_stamp, max_stamp=s.max_stamp,
        )
        for job, s in made
    ])
    commits = tuple(s.commit_id for _, s in made if s.n_rows)
    if commits and all(c.registered for c in chosen):
        publish(spark, root, Entry(spec.name, IDS, None, new_commit_id(), 0, covers=commits))
    return MaintenanceResult(spec.name, replaced, commits, sum(s.n_rows for _, s in made))
