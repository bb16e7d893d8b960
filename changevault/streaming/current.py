"""Continuous current state: every published raw commit is merged as it appears."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from changevault.model import ObjectSpec
from changevault.plans.current import refresh_current
from changevault.session import stream_id
from changevault.sources.ledger import LEDGER_SCHEMA, RAW


def current_stream(
    spark: SparkSession,
    spec: ObjectSpec,
    root: str,
    checkpoint_dir: str,
    name: str | None = None,
    max_commits_per_trigger: int | None = None,
    available_now: bool = True,
    interval: str = "10 minutes",
) -> StreamingQuery:
    """Follow the object's ledger and merge the commits it names.

    The stream carries ledger rows, not data: unpublished attempts and maintenance rewrites
    never show up in it. A replayed batch finds its merge id in the ledger and does nothing; the id
    holds the stream's own identity, so a new checkpoint folder starts over. Each trigger merges all
    commits that wait, in one rewrite of the state.
    """
    name = name or f"current-{spec.name}"
    stored = T.StructType([f for f in LEDGER_SCHEMA.fields if f.name not in ("object", "kind")])
    reader = spark.readStream.schema(stored)
    if max_commits_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_commits_per_trigger)

    def merge(batch: DataFrame, batch_id: int) -> None:
        commits = [r.commit_id for r in batch.select("commit_id").distinct().collect()]
        session = batch.sparkSession
        merge_id = f"{name}-{stream_id(session)}-{batch_id}"
        refresh_current(session, spec, root, commits=commits, merge_id=merge_id)

    writer = (
        reader.parquet(f"{root}/ledger/object={spec.name}/kind={RAW}")
        .writeStream.queryName(name)
        .option("checkpointLocation", checkpoint_dir)
        .foreachBatch(merge)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()
