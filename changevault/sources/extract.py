"""Reading CSV extracts: every field is text, empty cells are empty text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from changevault.model import PAGE, quoted

# The header is checked against the columns read, never matched by position, and a row of
# another width fails the job.
CSV_OPTIONS = {
    "header": True,
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "mode": "FAILFAST",
    "enforceSchema": False,
    "inferSchema": False,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_extract(
    spark: SparkSession,
    path: str | Sequence[str],
    fields: Sequence[str] | None = None,
    multi_line: bool = True,
    mixed_headers: bool = False,
    name_pages: bool = False,
) -> DataFrame:
    """All pages under ``path`` as one frame of text columns.

    ``fields`` picks columns by header name; a field no page has becomes NULL. Quoted line
    breaks need ``multi_line``, which makes each page one task; extracts known to have none can
    be split further by turning it off. Pages whose headers differ are an error, unless
    ``mixed_headers`` groups pages by their first line. That reads all text once more.
    ``name_pages`` adds ``_page``, the file each row came from.
    """
    paths = [path] if isinstance(path, str) else list(path)
    groups = _pages_by_header(spark, paths) if mixed_headers else [paths]
    frames = [_read(spark, g, multi_line, name_pages) for g in groups]
    if not frames:
        frame = spark.createDataFrame([], T.StructType([]))
    else:
        frame = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return frame if fields is None else pick_fields(frame, fields)


def pick_fields(frame: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The named columns as text, absent ones as NULL."""
    present = set(frame.columns)
    return frame.selectExpr(*[
        quoted(f) if f in present else f"CAST(NULL AS STRING) AS {quoted(f)}" for f in fields
    ])


def cells(frame: DataFrame, *extra: str) -> DataFrame:
    """Spark reads empty cells as NULL: make them empty text, and quoted CR LF a plain LF."""
    return frame.selectExpr(*[
        f"replace(coalesce({quoted(c)}, ''), char(13) || char(10), char(10)) AS {quoted(c)}"
        for c in frame.columns
    ], *extra)


def _read(spark: SparkSession, paths: Sequence[str], multi_line: bool, name_pages: bool = False) -> DataFrame:
    frame = spark.read.options(**CSV_OPTIONS, multiLine=multi_line).csv(list(paths))
    return cells(frame, *([f"_metadata.file_path AS {PAGE}"] if name_pages else []))


def _pages_by_header(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """Page paths grouped by their first line; only that line and the path reach the driver."""
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("page"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    headers = lines.where("start = 0").groupBy("page").agg(F.min_by("value", "at").alias("header"))
    groups: dict[str, list[str]] = {}
    for row in headers.toLocalIterator():
        groups.setdefault(row.header, []).append(unquote(row.page))
    return [sorted(groups[h]) for h in sorted(groups)]
