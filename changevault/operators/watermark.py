"""Watermarks: what was read so far, and what to read next."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from changevault.model import REJECTS, WATERMARK_BUFFER_MINUTES, ObjectSpec, col
from changevault.operators.latest import latest_per_key, since as since_moment
from changevault.session import moment, moment_lit

_ROW = "__row"


def incremental(df: DataFrame, spec: ObjectSpec, watermark: str | datetime | None) -> DataFrame:
    """Rows stamped strictly after the watermark; without field or watermark, all rows.

    Soft-deleted rows are part of the result, and so are rows whose stamp is among their ``_rejects``: a sync must not
    lose these.
    """
    if not spec.watermark_field or not watermark:
        return df
    newer = col(spec.watermark_field) > moment_lit(watermark, df.schema[spec.watermark_field].dataType)
    if REJECTS in df.columns:
        newer |= F.exists(REJECTS, lambda cell: cell["column"] == spec.watermark_field)
    return df.where(newer)


def batch_watermark(df: DataFrame, watermark_field: str, by: Sequence[str] = ()) -> DataFrame:
    """``(watermark, n_rows)``, per group where ``by`` names one; NULL stamps are ignored."""
    return df.groupBy(*[col(c) for c in by]).agg(
        F.max(col(watermark_field)).alias("watermark"), F.count(F.lit(1)).alias("n_rows")
    )


def job_start_watermark(job_start: str | datetime) -> datetime:
    """Next lower bound when the job's start, not its newest row, is the watermark."""
    return moment(job_start) - timedelta(minutes=WATERMARK_BUFFER_MINUTES)


def with_buffer(stamp: Column) -> Column:
    """The same for a column of job starts."""
    return stamp - F.expr(f"INTERVAL {WATERMARK_BUFFER_MINUTES} MINUTES")


def watermarks(ledger: DataFrame) -> DataFrame:
    """``(object, watermark, last_job_start, last_job_id)`` per object.

    The watermark is the greatest ever committed, so it never moves back; the job columns are
    those of the newest commit.
    """
    newest = F.max_by(F.struct("last_job_start", "last_job_id"), F.struct("committed_at", "commit_id"))
    return (
        ledger.where(F.col("kind") == "raw")
        .groupBy("object")
        .agg(F.max("watermark").alias("watermark"), newest.alias("job"))
        .select("object", "watermark", "job.last_job_start", "job.last_job_id")
    )


def drop_seen(
    batch: DataFrame,
    seen: DataFrame,
    spec: ObjectSpec,
    since: str | datetime | None = None,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Batch rows whose (key, stamp) is not among ``seen``, each (key, stamp) once.

    ``since`` bounds the part of ``seen`` that can overlap (watermark less the buffer), partitions
    included. Both sides are reduced to one row per (key, stamp) before they meet, and share that
    shuffle. Rows without a stamp are all kept: a number of their own tells them apart, so that
    the batch is read once.
    """
    on = [spec.primary_key, spec.watermark_field]
    stamp = col(spec.watermark_field)
    if since is not None:
        seen = since_moment(seen, spec, since)
        seen = seen.where(stamp > moment_lit(since, seen.schema[spec.watermark_field].dataType))
    own = F.when(stamp.isNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1))
    fresh = latest_per_key(batch.withColumn(_ROW, own), [*on, _ROW], spec.watermark_field, tiebreak)
    known = seen.where(stamp.isNotNull()).select(*[col(c) for c in on]).distinct()
    return fresh.drop(_ROW).join(known, on, "left_anti").select(*[col(c) for c in batch.columns])
