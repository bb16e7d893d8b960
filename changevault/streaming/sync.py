"""Continuous sync: extract pages become raw commits as they land."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from changevault.model import ObjectSpec
from changevault.plans.sync import sync_object
from changevault.session import stream_id

# What Spark tells of a file; only the path is read.
_PAGES = "path string, modificationTime timestamp, length long, content binary"


def sync_stream(
    spark: SparkSession,
    spec: ObjectSpec,
    landing: str,
    catalog: DataFrame | Callable[[], DataFrame],
    root: str,
    checkpoint_dir: str,
    name: str | None = None,
    multi_line: bool = True,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    interval: str = "10 minutes",
    **options,
) -> StreamingQuery:
    """Sync every page that lands in a folder, one commit per trigger.

    The stream follows the pages' paths; each trigger reads its pages like any extract, so their
    headers may change from page to page, and new columns of a ``catalog`` given as a function, which
    is asked in every trigger, are taken up. Pages may arrive in any order: no watermark filter is
    applied, the source already did.

    The sync id is made of the stream's own identity, which lives in the checkpoint folder, and the
    batch number. So a batch replayed after a failure is skipped if it had been published, and a stream
    that begins anew with an empty checkpoint folder brings its pages again under ids of its own.
    """
    name = name or f"sync-{spec.name}"
    reader = spark.readStream.schema(_PAGES).format("binaryFile").option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        pages = sorted(r.path for r in batch.select("path").collect())
        if pages:
            sync_object(
                session, spec, pages, catalog() if callable(catalog) else catalog, root,
                sync_id=f"{name}-{stream_id(session)}-{batch_id}", filter_watermark=False,
                multi_line=multi_line, mixed_headers=True, **options,
            )

    writer = (
        reader.load(landing).select("path")
        .writeStream.queryName(name)
        .option("checkpointLocation", checkpoint_dir)
        .foreachBatch(load)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()
