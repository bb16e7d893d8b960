"""The commit ledger: one small row makes a written batch visible and moves the watermark.

Data is written under a fresh commit id first. A row in the ledger then publishes it, so a
failed attempt is never seen and rows and watermark advance together. Rows live in one folder
per object and kind, each of which has one writer at a time: the sync (``raw``), the merge
(``current``), one maintenance job (``maintenance``) or the registry of canonical ids (``ids``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from changevault.session import from_micros, local_frame, moment, now, read_if_exists

RAW, MAINTENANCE, CURRENT, IDS = "raw", "maintenance", "current", "ids"

LEDGER_SCHEMA = T.StructType([
    T.StructField("sync_id", T.StringType()),
    T.StructField("commit_id", T.StringType()),
    T.StructField("replaces", T.ArrayType(T.StringType())),
    T.StructField("covers", T.ArrayType(T.StringType())),
    T.StructField("watermark", T.TimestampType()),
    T.StructField("last_job_start", T.TimestampType()),
    T.StructField("last_job_id", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("min_stamp", T.TimestampType()),
    T.StructField("max_stamp", T.TimestampType()),
    T.StructField("buckets", T.IntegerType()),
    T.StructField("rejects_id", T.StringType()),
    T.StructField("n_rejects", T.LongType()),
    T.StructField("committed_at", T.TimestampType()),
    T.StructField("object", T.StringType()),
    T.StructField("kind", T.StringType()),
])


@dataclass(frozen=True)
class Entry:
    """One ledger row. ``replaces`` hides older commits; ``covers`` lists commits whose rows the current state holds,
    or in rows of kind ``ids`` commits whose keys the registry holds. ``rejects_id`` names the folder of the rows
    that a sync set aside."""

    object: str
    kind: str
    sync_id: str | None
    commit_id: str
    n_rows: int
    replaces: Sequence[str] = ()
    covers: Sequence[str] = ()
    watermark: datetime | None = None
    last_job_start: datetime | None = None
    last_job_id: str | None = None
    min_stamp: datetime | None = None
    max_stamp: datetime | None = None
    buckets: int | None = None
    rejects_id: str | None = None
    n_rejects: int = 0
    committed_at: datetime = field(default_factory=now)


def new_commit_id() -> str:
    return uuid.uuid4().hex


def publish(spark: SparkSession, root: str, *entries: Entry) -> None:
    """Append the rows, of one object and kind; their single file appears in one step."""
    stored = _without(LEDGER_SCHEMA, "object", "kind")
    rows = [tuple(_stored(getattr(e, name)) for name in stored.names) for e in entries]
    frame = local_frame(spark, rows, stored).coalesce(1)
    frame.write.mode("append").parquet(f"{root}/ledger/object={entries[0].object}/kind={entries[0].kind}")


def read_ledger(spark: SparkSession, root: str, object_name: str | None = None) -> DataFrame:
    """All rows, or those of one object (only its folder is listed); empty when there are none."""
    if object_name is None:
        found = read_if_exists(spark, f"{root}/ledger", LEDGER_SCHEMA)
    else:
        found = read_if_exists(
            spark, f"{root}/ledger/object={object_name}", _without(LEDGER_SCHEMA, "object")
        )
        if found is not None:
            found = found.withColumn("object", F.lit(object_name))
    if found is None:
        return local_frame(spark, [], LEDGER_SCHEMA)
    return found.select(*LEDGER_SCHEMA.fieldNames())


def live_commits(ledger: DataFrame) -> DataFrame:
    """Ledger rows of raw data still visible: published and not replaced."""
    data = ledger.where(F.col("kind").isin(RAW, MAINTENANCE))
    replaced = data.select("object", F.explode("replaces").alias("commit_id"))
    return data.join(replaced, ["object", "commit_id"], "left_anti")


@dataclass(frozen=True)
class History:
    """What the ledger says about one object's visible state.

    ``commits`` are the rows of live commits that hold data, each with ``pending``: no merge has
    covered it, and ``registered``: the registry of canonical ids holds its keys. ``current`` is the row
    of the newest merge, or None.
    """

    commits: tuple
    watermark: datetime | None
    current: Row | None

    @property
    def live(self) -> list[str]:
        return [c.commit_id for c in self.commits]

    @property
    def pending(self) -> list[str]:
        return [c.commit_id for c in self.commits if c.pending]

    @property
    def unregistered(self) -> list[str]:
        return [c.commit_id for c in self.commits if not c.registered]

    def waiting(self, commits: Sequence[str]) -> list[str]:
        """Of these commits the live ones; for any that maintenance replaced, what waits in its place."""
        wanted, live = set(commits), set(self.live)
        replaced = not wanted <= live
        return [
            c.commit_id for c in self.commits
            if c.commit_id in wanted or (replaced and c.pending and c.kind == MAINTENANCE)
        ]


def history(spark: SparkSession, root: str, object_name: str) -> History:
    """Live commits, watermark and newest merge of one object.

    The ledger is reduced in Spark. What reaches the driver is a row for each live commit, whose
    folders it must name to read them; compaction keeps these few.
    """
    ledger = read_ledger(spark, root, object_name)
    by_ids = F.col("kind") == IDS
    covered = ledger.select(by_ids.alias("ids"), F.explode("covers").alias("commit_id")).groupBy("commit_id").agg(
        F.bool_or(~F.col("ids")).alias("__merged"), F.bool_or("ids").alias("__registered"))
    live = live_commits(ledger).where("n_rows > 0").join(covered, "commit_id", "left").select(
        "kind", "commit_id", "sync_id", "n_rows",
        F.unix_micros("min_stamp").alias("min_stamp_us"),
        F.unix_micros("max_stamp").alias("max_stamp_us"),
        F.unix_micros("committed_at").alias("committed_us"),
        (~F.coalesce("__merged", F.lit(False))).alias("pending"),
        F.coalesce("__registered", F.lit(False)).alias("registered"),
    )
    merge = F.when(F.col("kind") == CURRENT, F.struct("commit_id", "buckets"))
    order = F.when(F.col("kind") == CURRENT, F.struct("committed_at", "commit_id"))
    state = ledger.agg(
        F.unix_micros(F.max(F.when(F.col("kind") == RAW, F.col("watermark")))).alias("watermark_us"),
        F.max_by(merge, order).alias("current"),
    ).first()
    commits = sorted(live.collect(), key=lambda c: (c.committed_us, c.commit_id))
    return History(tuple(commits), from_micros(state.watermark_us), state.current)


def is_published(spark: SparkSession, root: str, object_name: str, kind: str, sync_id: str) -> bool:
    """Whether a sync or merge of this id is in the ledger."""
    rows = read_ledger(spark, root, object_name).where(F.col("kind") == kind)
    return not rows.where(F.col("sync_id") == sync_id).isEmpty()


def sync_state(
    spark: SparkSession, root: str, object_name: str, sync_id: str
) -> tuple[bool, datetime | None]:
    """Whether a sync of this id is published, and the last committed watermark, in one job."""
    rows = read_ledger(spark, root, object_name).where(F.col("kind") == RAW)
    found = rows.agg(F.bool_or(F.col("sync_id") == sync_id).alias("done"), F.unix_micros(F.max("watermark")).alias("at")).first()
    return bool(found.done), from_micros(found.at)


def get_watermark(spark: SparkSession, root: str, object_name: str) -> datetime | None:
    """Last committed watermark, or None when the object was never synced."""
    rows = read_ledger(spark, root, object_name).where(F.col("kind") == RAW)
    return from_micros(rows.agg(F.unix_micros(F.max("watermark"))).first()[0])


def _stored(value):
    if isinstance(value, datetime):
        return moment(value)
    return list(value) if isinstance(value, (tuple, list)) else value


def _without(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in names])
