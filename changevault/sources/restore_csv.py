"""Writing the restore payload: CSV pages ready for a bulk upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame

from changevault.functions.records import stringify
from changevault.model import RESTORE_BULK_SIZE, col, is_system


def write_restore_csv(
    df: DataFrame, path: str, bulk_size: int = RESTORE_BULK_SIZE, keep_system: bool = False, folders_by: str | None = None
) -> None:
    """One page per ``bulk_size`` rows at most: sorted columns, header, LF, RFC 4180 quoting.

    NULL becomes an empty cell. System columns stay out unless asked for. ``folders_by`` names a column whose
    values get a folder each instead of a cell, all written by one job.
    """
    names = sorted(c for c in df.columns if (keep_system or not is_system(c)) and c != folders_by)
    pages = stringify(df, names)
    if folders_by:
        pages = stringify(df, [*names, folders_by]).hint("rebalance", col(folders_by))
    writer = pages.write.partitionBy(folders_by) if folders_by else pages.write
    (
        writer.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("lineSep", "\n")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", bulk_size)
        .csv(path)
    )
