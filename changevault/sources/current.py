"""The current-state table of one object: a new version per merge, published by the ledger."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from changevault.model import COMMIT, ObjectSpec, col, quoted
from changevault.sources.ledger import History, history


def state_path(root: str, spec: ObjectSpec, commit_id: str) -> str:
    return f"{root}/current/{spec.name}/{COMMIT}={commit_id}"


def read_state(
    spark: SparkSession, spec: ObjectSpec, root: str, known: History | None = None
) -> DataFrame | None:
    """Newest published state with its tombstones, or None before the first merge."""
    newest = (known or history(spark, root, spec.name)).current
    if newest is None:
        return None
    path = state_path(root, spec, newest.commit_id)
    if newest.buckets is None:
        return spark.read.parquet(path)
    return _read_bucketed(spark, spec, path, newest.buckets)


def write_state(state: DataFrame, spec: ObjectSpec, path: str, clustered: bool) -> int:
    """Write one version of the state and tell its number of rows; ``clustered`` rows are hashed into the buckets already.

    Buckets need a table entry to be written and read with; it lives for the moment only and
    does not own the files.
    """
    buckets, seen = spec.current_buckets, Observation()
    if buckets is not None and not clustered:
        state = state.repartition(buckets, col(spec.primary_key))
    # observed where rows are written, behind the last shuffle: a task's rows count once, however often it is tried
    state = state.observe(seen, F.count(F.lit(1)).alias("n"))
    if buckets is None:
        state.write.parquet(path)
        return seen.get["n"]
    name = _entry_name()
    try:
        (
            state.write.format("parquet").bucketBy(buckets, spec.primary_key).sortBy(spec.primary_key)
            .option("path", path).saveAsTable(name)
        )
    finally:
        state.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    return seen.get["n"]


def _read_bucketed(spark: SparkSession, spec: ObjectSpec, path: str, buckets: int) -> DataFrame:
    fields = spark.read.parquet(path).schema.fields
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
    key, name = quoted(spec.primary_key), _entry_name()
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def _entry_name() -> str:
    return f"changevault_{uuid4().hex}"
