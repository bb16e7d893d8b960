"""Row-level helpers: id validation, alignment, text form, overflow."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from changevault.model import OVERFLOW, ColumnDef, col, is_system, listed, quoted
from changevault.session import as_utc

RECORD_ID = r"\A[a-zA-Z0-9]+\z"
_RECORD_ID = re.compile(r"[a-zA-Z0-9]+")


def is_valid_record_id(value: str) -> bool:
    return bool(_RECORD_ID.fullmatch(value))


def valid_record_ids(df: DataFrame, id_col: str) -> DataFrame:
    """Add ``is_valid``: one or more ASCII letters and digits, nothing else."""
    return df.withColumn("is_valid", F.coalesce(col(id_col).rlike(RECORD_ID), F.lit(False)))


def extract_fields(columns: Iterable[str], watermark_field: str, deleted_field: str = "IsDeleted") -> list[str]:
    """Fields to ask the source for: the table's own, the watermark field, the deleted flag."""
    wanted = [c for c in columns if not is_system(c)]
    extras = [f for f in (watermark_field, deleted_field) if f]
    return list(dict.fromkeys(wanted + extras))


def align(df: DataFrame, columns: Sequence[ColumnDef], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the given columns in their order, absent ones as NULL of their type, then those of ``keep``."""
    present = set(df.columns)
    return df.selectExpr(*[
        quoted(c.name) if c.name in present
        else f"CAST(NULL AS {c.field.dataType.simpleString()}) AS {quoted(c.name)}"
        for c in columns
    ], *map(quoted, keep))


def spill_overflow(df: DataFrame, mapped: Iterable[str]) -> DataFrame:
    """Fold the columns without a table column into one JSON object with sorted keys.

    NULL (an absent field) is left out; a row without any such field gets NULL.
    """
    keep = set(mapped)
    kept = [c for c in df.columns if c in keep or is_system(c)]
    spilled = sorted(c for c in df.columns if c not in keep and not is_system(c))
    if not spilled:
        return df.withColumn(OVERFLOW, F.lit(None).cast("string"))
    some = " OR ".join(f"{quoted(c)} IS NOT NULL" for c in spilled)
    body = f"CASE WHEN {some} THEN to_json(struct({listed(spilled)})) END AS {OVERFLOW}"
    return df.selectExpr(*[quoted(c) for c in kept if c != OVERFLOW], body)


def as_text(name: str, data_type: T.DataType) -> Column:
    """Text that :func:`changevault.functions.coerce.coerced` reads back to the same value."""
    value = col(name)
    if isinstance(data_type, T.TimestampType):
        text = F.date_format(as_utc(value), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    elif isinstance(data_type, T.TimestampNTZType):
        text = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    elif isinstance(data_type, T.BinaryType):
        text = F.decode(value, "UTF-8")
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit("")).alias(name)


def stringify(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """All values as text, NULL as empty text, columns in the given order (default: as stored)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[as_text(name, types[name]) for name in (columns or df.columns)])


def job_status(jobs: DataFrame) -> DataFrame:
    """``(id, status, records_processed, errors)`` from ``(id, state, processed, failed, error_message)``."""
    errors = F.array_compact(F.array(
        F.when(F.col("failed") > 0, F.concat(F.col("failed").cast("string"), F.lit(" record(s) failed"))),
        F.nullif(F.col("error_message"), F.lit("")),
    ))
    return jobs.select(
        "id",
        F.col("state").alias("status"),
        F.col("processed").alias("records_processed"),
        errors.alias("errors"),
    )
