"""Object specs, column definitions and the fixed values shared by all modules."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from changevault.session import local_frame

# Source field type -> column type. Every other type becomes string.
SOURCE_TYPES = {
    "id": "string",
    "reference": "string",
    "string": "string",
    "textarea": "string",
    "picklist": "string",
    "multipicklist": "string",
    "combobox": "string",
    "email": "string",
    "phone": "string",
    "url": "string",
    "encryptedstring": "string",
    "int": "long",
    "double": "double",
    "currency": "double",
    "percent": "double",
    "boolean": "boolean",
    "date": "date",
    "datetime": "timestamp",
    "base64": "binary",
}

# Compound source types, whose scalar parts arrive as fields of their own.
COMPOUND_TYPES = ("address", "location", "complexvalue")

# Column type -> Spark type.
SPARK_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
}

DEFAULT_BATCH_ROWS = 5000
WATERMARK_BUFFER_MINUTES = 5
RETENTION_DAYS = 60
RESTORE_BULK_SIZE = 10000
MAX_IN_FLIGHT = 5

OVERFLOW = "_overflow"
SYNC_ID = "_sync_id"
SYNCED_AT = "_synced_at"
ROW_HASH = "_row_hash"
COMMIT = "_commit"

# Columns of rows with text that does not fit: what does not (column and value), the key as text, the page it came from.
REJECTS, REJECT_KEY, PAGE = "_rejects", "_reject_key", "_page"
REJECT_FIELDS = (
    T.StructField(REJECTS, T.ArrayType(T.StructType([
        T.StructField("column", T.StringType()), T.StructField("value", T.StringType()),
    ]))),
    T.StructField(REJECT_KEY, T.StringType()),
    T.StructField(PAGE, T.StringType()),
)

# System columns stored with every raw row, after the object's own columns.
SYSTEM_FIELDS = (
    T.StructField(OVERFLOW, T.StringType()),
    T.StructField(SYNC_ID, T.StringType()),
    T.StructField(SYNCED_AT, T.TimestampType()),
    T.StructField(ROW_HASH, T.LongType()),
)

# Newest version first: later sync wins a tie on the stamp, then a stored row hash decides.
RAW_TIEBREAK = (SYNCED_AT, ROW_HASH)

# What a field catalog may hold; object, name, type and nillable are needed. ``reference_to`` lists the objects whose
# records a reference may name; a frame may also hold the name of the only one as text.
CATALOG_SCHEMA = T.StructType([
    T.StructField("object", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("length", T.IntegerType()),
    T.StructField("precision", T.IntegerType()),
    T.StructField("scale", T.IntegerType()),
    T.StructField("nillable", T.BooleanType()),
    T.StructField("reference_to", T.ArrayType(T.StringType())),
])

_PATH_SAFE = re.compile(r"[A-Za-z0-9_]+")


class ChangeVaultError(Exception):
    """Base of the errors this package raises."""


class DriftHalted(ChangeVaultError):
    """A removed source field met the policy ``halt``."""


class RequiredValueMissing(ChangeVaultError):
    """The primary key of a batch holds NULLs."""


class NothingToRestore(ChangeVaultError):
    """No version exists before the requested moment."""


@dataclass(frozen=True)
class ColumnDef:
    """One table column."""

    name: str
    type: str
    required: bool = False

    @property
    def field(self) -> T.StructField:
        return T.StructField(self.name, SPARK_TYPES[self.type], True)


@dataclass(frozen=True)
class PartitionBy:
    """One partition field; the transform is day, hour, month, year or identity."""

    field: str
    transform: str = "identity"


@dataclass(frozen=True)
class ObjectSpec:
    """How one source object is synced, stored and merged.

    ``current_buckets`` stores the current-state table hashed by key into that many buckets, so
    that a merge shuffles the incoming versions only. Pick it so that a bucket of the whole table
    is a comfortable task, a few hundred MB.
    """

    name: str
    primary_key: str = "Id"
    watermark_field: str = "SystemModstamp"
    partition_by: tuple[PartitionBy, ...] = ()
    overflow: bool = False
    removed_field_policy: str = "tombstone"
    exclude_fields: tuple[str, ...] = ()
    deleted_field: str = "IsDeleted"
    current_buckets: int | None = None

    def __post_init__(self) -> None:
        if not _PATH_SAFE.fullmatch(self.name):
            raise ValueError(f"object name {self.name!r} must be letters, digits and underscores")
        object.__setattr__(self, "partition_by", tuple(self.partition_by))
        object.__setattr__(self, "exclude_fields", tuple(self.exclude_fields))


def pick_specs(specs: Sequence[ObjectSpec], only: str | None = None) -> list[ObjectSpec]:
    """All specs, or the single one named ``only``; an unknown name is an error."""
    if only is None:
        return list(specs)
    chosen = [s for s in specs if s.name == only]
    if not chosen:
        raise ValueError(f"object {only!r} is not configured")
    return chosen


def excludes_frame(spark: SparkSession, specs: Iterable[ObjectSpec]) -> DataFrame:
    """``(object, name)``, one row per excluded field."""
    return local_frame(
        spark, [(s.name, f) for s in specs for f in s.exclude_fields],
        "object string, name string",
    )


def is_system(name: str) -> bool:
    """System columns take no part in drift detection or extraction."""
    return name.startswith("_")


def quoted(name: str) -> str:
    """The name as SQL reads it, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Column by exact name."""
    return F.col(quoted(name))


def listed(names: Iterable[str]) -> str:
    """Names as a list in SQL. Wide tables are handled in SQL text: one call for all columns, not some for each."""
    return ", ".join(map(quoted, names))


def check_case_collisions(names: Iterable[str]) -> None:
    """Names that differ only in case cannot live in one Parquet table."""
    seen: dict[str, str] = {}
    for name in names:
        other = seen.setdefault(name.lower(), name)
        if other != name:
            raise ChangeVaultError(f"columns {other!r} and {name!r} differ only in case")
