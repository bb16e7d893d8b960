"""Merge jobs: raw history -> current state."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from changevault.model import ChangeVaultError, ObjectSpec, col, pick_specs
from changevault.operators.latest import latest_per_key
from changevault.operators.merge import VERSION, empty_state, live_rows, merge_state, versioned
from changevault.sources.current import read_state, state_path, write_state
from changevault.sources.ledger import CURRENT, Entry, History, history, is_published, new_commit_id, publish
from changevault.sources.raw import read_raw

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class MergeResult:
    """Commits merged; none when the state was up to date."""

    object: str
    commit_id: str | None
    merged: tuple[str, ...] = ()


def refresh_current(
    spark: SparkSession,
    spec: ObjectSpec,
    root: str,
    full: bool = False,
    commits: Sequence[str] | None = None,
    merge_id: str | None = None,
) -> MergeResult:
    """Bring ``<object>_current`` up to date and publish it as a new version.

    Only commits no earlier merge covered are read; the state's stored versions make that equal
    to merging over everything, which ``full`` does. Where maintenance has replaced a commit that
    waited, its replacement is read: rows merged before change nothing. A ``merge_id`` already
    published is skipped. Each merge writes the whole state anew, so merge what waits at once.
    """
    if merge_id is not None and is_published(spark, root, spec.name, CURRENT, merge_id):
        return MergeResult(spec.name, None)
    known = history(spark, root, spec.name)
    if commits is None:
        commits = known.live if full else known.pending
    else:
        commits = known.waiting(commits)
    state = read_state(spark, spec, root, known)
    if not commits and state is not None:
        return MergeResult(spec.name, None)
    co_located = state is not None and known.current.buckets is not None
    merged = _merged(spark, spec, root, known, state, commits)
    commit_id = new_commit_id()
    path = state_path(root, spec, commit_id)
    n_rows = write_state(merged, spec, path, co_located and known.current.buckets == spec.current_buckets)
    publish(spark, root, Entry(
        spec.name, CURRENT, merge_id, commit_id, n_rows,
        covers=commits, buckets=spec.current_buckets,
    ))
    return MergeResult(spec.name, commit_id, tuple(commits))


def read_current(spark: SparkSession, spec: ObjectSpec, root: str, pending: bool = False) -> DataFrame:
    """Live records as of the last merge, or with ``pending`` as a merge of all that waits would leave them.

    Nothing is written: waiting commits are reduced to their newest version of each key and ranked against the
    state's stored versions, tombstones included, so late, repeated and deleting commits count as in a merge. The
    state's side is not shuffled if it is bucketed. So merges may be rare and reads still up to date.
    """
    known = history(spark, root, spec.name)
    state = read_state(spark, spec, root, known)
    if state is None and not pending:
        raise ChangeVaultError(f"object {spec.name}: not merged yet")
    if pending and (known.pending or state is None):
        state = _merged(spark, spec, root, known, state, known.pending)
    return live_rows(state)


def _merged(
    spark: SparkSession, spec: ObjectSpec, root: str, known: History, state: DataFrame | None, commits: Sequence[str]
) -> DataFrame:
    """The state with the newest versions of some commits, each key's stored version compared."""
    raw = read_raw(spark, spec, root, commits=commits)
    newest = latest_per_key(versioned(raw, spec), spec.primary_key, VERSION[0], VERSION[1:])
    if state is not None and known.current.buckets is not None:
        newest = newest.repartition(known.current.buckets, col(spec.primary_key))
    return merge_state(empty_state(newest) if state is None else state, newest, spec)


def merge_all(
    spark: SparkSession, specs: Sequence[ObjectSpec], root: str, only: str | None = None, full: bool = False
) -> list[MergeResult]:
    """Refresh one object after the other; a failure does not stop the rest, the first is raised at the end."""
    results, first_error = [], None
    for spec in pick_specs(specs, only):
        try:
            results.append(refresh_current(spark, spec, root, full))
        except Exception as error:
            log.error("merge of %s failed: %s", spec.name, error)
            first_error = first_error or error
    if first_error is not None:
        raise first_error
    return results
