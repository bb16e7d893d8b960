"""Partition columns derived from data columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from changevault.model import PartitionBy, col
from changevault.session import as_utc

TRANSFORMS = ("day", "hour", "month", "year")


def partition_column(
    part: PartitionBy, value: Column, data_type: T.DataType | None = None
) -> tuple[str, Column]:
    """Name and value of the partition column for one partition field, in UTC in any session."""
    if isinstance(data_type, T.TimestampType) and part.transform in TRANSFORMS:
        value = as_utc(value)
    if part.transform == "day":
        derived = F.to_date(value)
    elif part.transform == "hour":
        derived = F.date_format(value, "yyyy-MM-dd-HH")
    elif part.transform in ("month", "year"):
        derived = F.trunc(F.to_date(value), part.transform).cast("date")
    else:
        return f"_p_{part.field}", value
    return f"_p_{part.field}_{part.transform}", derived


def with_partitions(df: DataFrame, partition_by: Sequence[PartitionBy]) -> tuple[DataFrame, list[str]]:
    """Add the partition columns and return their names; fields the frame lacks are skipped."""
    names = []
    present = set(df.columns)
    for part in partition_by:
        if part.field in present:
            name, value = partition_column(part, col(part.field), df.schema[part.field].dataType)
            df = df.withColumn(name, value)
            names.append(name)
    return df, names


def partition_fields(schema: T.StructType, partition_by: Sequence[PartitionBy]) -> list[T.StructField]:
    """Types of the partition columns, for reading them back without inference."""
    types = {f.name: f.dataType for f in schema.fields}
    fields = []
    for part in partition_by:
        if part.field not in types:
            continue
        name, _ = partition_column(part, F.lit(None))
        if part.transform == "hour":
            data_type = T.StringType()
        elif part.transform in TRANSFORMS:
            data_type = T.DateType()
        else:
            data_type = types[part.field]
        fields.append(T.StructField(name, data_type))
    return fields
