"""Newest version per key, and point-in-time views built on it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from changevault.functions.records import is_valid_record_id
from changevault.model import RAW_TIEBREAK, ObjectSpec, col
from changevault.operators.partitions import TRANSFORMS, partition_column
from changevault.session import moment, moment_lit

_RANK = "__rank"


def _tiebreak(df: DataFrame, tiebreak: Sequence[str] | None) -> list[Column]:
    if tiebreak is None and set(RAW_TIEBREAK) <= set(df.columns):
        tiebreak = RAW_TIEBREAK
    if tiebreak is None:
        return [F.xxhash64(*[col(c) for c in df.columns]).desc()]
    return [col(c).desc_nulls_last() for c in tiebreak]


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order_by: str,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the one with the greatest ``order_by``, NULLs last.

    Ties go to the greatest ``tiebreak`` columns. Without any, raw rows use their sync time and
    stored row hash, other rows a hash of the whole row (which then reads every column, so name
    a tiebreak where there is one). Rank 1 is cut in the map tasks before the shuffle, so a key
    holding a large share of all rows sends one row per map task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = Window.partitionBy(*[col(k) for k in keys]).orderBy(
        col(order_by).desc_nulls_last(), *_tiebreak(df, tiebreak)
    )
    return df.withColumn(_RANK, F.row_number().over(order)).where(F.col(_RANK) == 1).drop(_RANK)


def before(df: DataFrame, spec: ObjectSpec, at: str | datetime) -> DataFrame:
    """Versions stamped strictly before a moment.

    The stamp's own partition columns, where present, get the matching bound, so that whole
    partitions are pruned; Spark does not derive that from the stamp predicate alone.
    """
    bound = moment_lit(at, df.schema[spec.watermark_field].dataType)
    kept = df.where(col(spec.watermark_field) < bound)
    for name, value in _stamp_partitions(df, spec, bound):
        kept = kept.where(col(name) <= value)
    return kept


def since(df: DataFrame, spec: ObjectSpec, at: str | datetime) -> DataFrame:
    """The complement of :func:`before`: stamped at or after a moment, or not stamped."""
    stamp = col(spec.watermark_field)
    bound = moment_lit(at, df.schema[spec.watermark_field].dataType)
    kept = df.where(stamp.isNull() | (stamp >= bound))
    for name, value in _stamp_partitions(df, spec, bound):
        kept = kept.where(col(name).isNull() | (col(name) >= value))
    return kept


def _stamp_partitions(df: DataFrame, spec: ObjectSpec, bound: Column) -> list[tuple[str, Column]]:
    """Partition columns derived from the stamp, each with the value the bound falls in."""
    present = set(df.columns)
    data_type = df.schema[spec.watermark_field].dataType
    derived = [
        partition_column(part, bound, data_type)
        for part in spec.partition_by
        if part.field == spec.watermark_field and part.transform in TRANSFORMS
    ]
    return [(name, value) for name, value in derived if name in present]


def table_as_of(
    raw: DataFrame, spec: ObjectSpec, at: str | datetime, tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """Newest version of every record before a moment; deleted versions are returned too."""
    return latest_per_key(before(raw, spec, at), spec.primary_key, spec.watermark_field, tiebreak)


def record_as_of(
    raw: DataFrame,
    spec: ObjectSpec,
    record_id: str | int,
    at: str | datetime,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Newest version of one record before a moment: at most one row."""
    versions = before(_one_record(raw, spec, record_id), spec, at)
    order = [col(spec.watermark_field).desc_nulls_last(), *_tiebreak(raw, tiebreak)]
    return versions.orderBy(*order).limit(1)


def record_history(
    raw: DataFrame, spec: ObjectSpec, record_id: str | int, tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """Every stored version of one record, newest first."""
    order = [col(spec.watermark_field).desc_nulls_last(), *_tiebreak(raw, tiebreak)]
    return _one_record(raw, spec, record_id).orderBy(*order)


def last_good_state(
    raw: DataFrame, spec: ObjectSpec, at: str | datetime, record_id: str | int | None = None
) -> DataFrame:
    """One record or the whole table as of a moment, after checking the request."""
    if at is None or at == "":
        raise ValueError("a moment to restore to is required")
    moment(at)
    if record_id is None or record_id == "":
        return table_as_of(raw, spec, at)
    return record_as_of(raw, spec, record_id, at)


def _one_record(raw: DataFrame, spec: ObjectSpec, record_id: str | int) -> DataFrame:
    if not is_valid_record_id(str(record_id)):
        raise ValueError(f"{record_id!r} is not a valid record id")
    return raw.where(is_record(raw, spec, record_id))


def is_record(raw: DataFrame, spec: ObjectSpec, record_id: str | int) -> Column:
    """The key equals an id given as text or number; the id takes the key's type, not the other way round."""
    return col(spec.primary_key) == F.lit(record_id).try_cast(raw.schema[spec.primary_key].dataType)
