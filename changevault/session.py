"""Session helpers: UTC, scratch space, moments in time, paths."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_RFC3339 = re.compile(r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})")


def use_utc(spark: SparkSession) -> SparkSession:
    """Day partitions and text forms are defined in UTC; set the session zone to it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00", "GMT"):
        raise ValueError(f"session time zone is {zone}; call use_utc(spark) first")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in ``spark.checkpoint.dir``.

    Where none is named, a local folder is made and set in local mode; elsewhere that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    base = tempfile.mkdtemp(prefix="changevault-")
    spark.sparkContext.setCheckpointDir(base)
    return base


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path under :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stream_id(spark: SparkSession) -> str:
    """Inside a trigger: the identity of the running stream, which its checkpoint folder keeps."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint, which survives the loss of executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def moment(value: str | datetime) -> datetime:
    """A point in time in UTC, from RFC 3339 text or a datetime (naive means UTC)."""
    if isinstance(value, datetime):
        aware = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
        return aware.astimezone(timezone.utc)
    if not isinstance(value, str) or not _RFC3339.fullmatch(value):
        raise ValueError(f"{value!r} is not an RFC 3339 timestamp")
    return datetime.fromisoformat(value).astimezone(timezone.utc)


def now() -> datetime:
    return datetime.now(timezone.utc)


def moment_lit(value: str | datetime, data_type: T.DataType | None = None) -> Column:
    """Literal for a moment, typed like the column it is compared with."""
    at = moment(value)
    text = at.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(data_type, (T.TimestampNTZType, T.DateType)):
        return F.lit(text).cast("timestamp_ntz")  # a date is compared as its midnight in UTC
    return F.lit(text + "Z").cast("timestamp")


def as_utc(value: Column) -> Column:
    """A TIMESTAMP as TIMESTAMP_NTZ in UTC, whatever the session's zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(value), epoch)


def to_micros(value: datetime) -> int:
    return (moment(value) - EPOCH) // timedelta(microseconds=1)


def from_micros(micros: int | None) -> datetime | None:
    return None if micros is None else EPOCH + timedelta(microseconds=micros)


def local_frame(spark: SparkSession, rows: Iterable[tuple], schema: str | T.StructType) -> DataFrame:
    """A few metadata rows as a frame of known size, without Python workers."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    records = [dict(zip(schema.names, row)) for row in rows]
    table = pa.Table.from_pylist(records, schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema=schema)


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """Parquet under ``path`` with a given schema, or None when the path is not there yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    return spark.read.schema(schema).parquet(path)
