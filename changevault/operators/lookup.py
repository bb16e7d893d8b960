"""Left join against a unique-key table when some keys of the left side may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from changevault.model import col
from changevault.session import local_frame

#: Bytes of one key that a task takes in its stride.
HOT_BYTES = 256 << 20
# Rough size of a value whose length its type does not tell.
_LONG_VALUE = 64


def row_bytes(schema: T.StructType) -> int:
    """About how many bytes a row of these types takes."""
    fixed = {T.BooleanType: 8, T.IntegerType: 8, T.LongType: 8, T.DoubleType: 8, T.FloatType: 8, T.DateType: 8,
             T.TimestampType: 8, T.TimestampNTZType: 8}
    return 16 + sum(fixed.get(type(f.dataType), _LONG_VALUE) for f in schema.fields)


def hot_keys(df: DataFrame, on: str, hot_bytes: int = HOT_BYTES) -> list[tuple]:
    """``(key, groups)`` of keys with more than ``hot_bytes`` of rows, NULL included, most frequent first.

    One pass over the ``on`` column alone (partial counts, then one shuffle of those).
    """
    return hot_among(key_counts(df, on), df.schema, hot_bytes)


def key_counts(df: DataFrame, on: str) -> DataFrame:
    """``(__key, count)`` of a column's values, NULL included."""
    return df.groupBy(col(on).alias("__key")).count()


def hot_among(counts: DataFrame, schema: T.StructType, hot_bytes: int = HOT_BYTES) -> list[tuple]:
    """:func:`hot_keys` of counted keys, whose rows have the types of ``schema``.

    At most as many keys count as hot as there are shuffle partitions, which bounds what is broadcast; a key
    beyond those has no more rows than an average partition.
    """
    rows = max(1, hot_bytes // row_bytes(schema))
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (
        counts.where(F.col("count") > rows)
        .orderBy(F.col("count").desc())
        .limit(partitions)
        .select("__key", F.ceil(F.col("count") / rows).cast("int").alias("__groups"))
    )
    return [tuple(r) for r in found.collect()]


def lookup_join(
    df: DataFrame, lookup: DataFrame, on: str, key: str, hot_bytes: int = HOT_BYTES, hot: list[tuple] | None = None
) -> DataFrame:
    """``df`` left-joined with ``lookup`` on ``df.on = lookup.key``; ``lookup.key`` is unique.

    Where no key is hot (:func:`hot_keys`, which callers that join in rounds count once and pass as
    ``hot``), the join is a plain one. Else the rows of each hot key are spread over salted groups of
    about ``hot_bytes`` and the lookup's row is repeated once per group. ``lookup`` must not share
    column names with ``df``.
    """
    spark = df.sparkSession
    if hot is None:
        hot = hot_keys(df, on, hot_bytes)
    if not hot:
        return df.join(lookup, col(on) == col(key), "left")
    key_type = df.schema[on].dataType.simpleString()
    listed = F.broadcast(local_frame(spark, hot, f"__hot {key_type}, __groups int"))
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *[col(c) for c in df.columns]), F.col("__groups"))
    left = df.join(listed, col(on).eqNullSafe(F.col("__hot")), "left").withColumn(
        "__salt", F.when(F.col("__groups").isNotNull(), spread).otherwise(F.lit(0)).cast("int")
    )
    right = lookup.join(listed, col(key) == F.col("__hot"), "left").select(
        *[col(c) for c in lookup.columns],
        F.explode(F.sequence(F.lit(0), F.coalesce("__groups", F.lit(1)) - 1)).alias("__lookup_salt"),
    )
    matched = (col(on) == col(key)) & (F.col("__salt") == F.col("__lookup_salt"))
    return left.join(right, matched, "left").select(
        *[col(c) for c in df.columns], *[col(c) for c in lookup.columns]
    )
