"""Run functions of this package over Arrow batches in Spark's tasks."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

import changevault
from changevault.llm.text import slices, texts_of

#: Rows go to Python workers in batches of about so many bytes, unless the session says otherwise: texts are long, and a
#: batch lies in memory on both sides.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors once per application, so that it need not be installed there, and bound the
    batches of the session."""
    if _BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(changevault.__file__).parent
    folder = tempfile.mkdtemp(prefix="changevault-code-")
    archive = shutil.make_archive(os.path.join(folder, package.name), "zip", package.parent, package.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def map_batches(df: DataFrame, function: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: T.StructType | str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def runs(batches: Iterable[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[tuple[int, ...], pa.RecordBatch]]:
    """Rows sorted by some whole numbers in slices that agree in them. A run may come in several slices."""
    for batch in batches:
        marks = np.stack([batch.column(c).to_numpy() for c in columns], axis=1)
        edges = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
        for start, stop in zip([0, *edges], [*edges, len(marks)]):
            if start < stop:
                yield tuple(map(int, marks[start])), batch.slice(start, stop - start)


def cells(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int, int], list[list[pa.RecordBatch]]]]:
    """From rows sorted by key, low, high and half: each (key, low, high) with the rows of its two halves."""
    cell, halves = None, [[], []]
    for batch in batches:
        marks = np.stack([batch.column(c).to_numpy() for c in ("key", "low", "high", "half")], axis=1)
        edges = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
        for start, stop in zip([0, *edges], [*edges, len(marks)]):
            if start == stop:
                continue
            key, low, high, half = map(int, marks[start])
            if (key, low, high) != cell:
                if cell is not None:
                    yield cell, halves
                cell, halves = (key, low, high), [[], []]
            halves[half].append(batch.slice(start, stop - start))
    if cell is not None:
        yield cell, halves


def per_text(spark: SparkSession, start: Callable[[], Callable[[list[str]], pa.Array]], kind: T.DataType | str,
             column: Column) -> Column:
    """A value for each text of a column. ``start()`` runs once in each task and gives the function that takes some
    texts (NULL as empty) and returns as many values. Spark keeps the rows' other columns to itself."""
    ship(spark)

    @F.arrow_udf(returnType=kind)
    def values(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        function = start()
        for array in arrays:
            parts = [function(texts_of(array.slice(at, length))) for at, length in slices(array)]
            yield pa.concat_arrays(parts) if parts else function([])

    return values(column)
