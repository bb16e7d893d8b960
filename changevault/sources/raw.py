"""The append-only history table of one object, and its stored schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import (
    Column, DataFrame, DataFrameWriter, Observation, SparkSession, functions as F, types as T,
)

from changevault.functions.records import align, spill_overflow
from changevault.model import (
    COMMIT, DEFAULT_BATCH_ROWS, OVERFLOW, PAGE, REJECT_FIELDS, REJECT_KEY, REJECTS, ROW_HASH, SYNC_ID, SYNCED_AT,
    SYSTEM_FIELDS, ChangeVaultError, ColumnDef, ObjectSpec, RequiredValueMissing, check_case_collisions, col,
    is_system, listed, quoted,
)
from changevault.operators.partitions import partition_fields, with_partitions
from changevault.session import (
    from_micros, local_frame, moment_lit, now, read_if_exists, require_utc,
)
from changevault.sources.ledger import (
    RAW, Entry, History, history, new_commit_id, publish, read_ledger, sync_state,
)

_COLUMN_SCHEMA = T.StructType([
    T.StructField("position", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("required", T.BooleanType()),
])


@dataclass(frozen=True)
class Staged:
    """A written, not yet published commit."""

    commit_id: str
    n_rows: int
    min_stamp: datetime | None
    max_stamp: datetime | None


# ---- schema ---------------------------------------------------------------------------------


def read_columns(spark: SparkSession, spec: ObjectSpec, root: str) -> list[ColumnDef] | None:
    """Stored columns in order, or None when the table does not exist."""
    stored = read_if_exists(spark, f"{root}/schema/object={spec.name}", _COLUMN_SCHEMA)
    if stored is None:
        return None
    found = sorted(stored.collect(), key=lambda r: r.position)
    return [ColumnDef(r.name, r.type, r.required) for r in found] or None


def add_columns(
    spark: SparkSession, spec: ObjectSpec, root: str, columns: Sequence[ColumnDef], start: int = 0
) -> None:
    """Append columns to the stored schema; nothing to add is a no-op."""
    if not columns:
        return
    rows = [(start + i, c.name, c.type, c.required) for i, c in enumerate(columns)]
    frame = local_frame(spark, rows, _COLUMN_SCHEMA)
    frame.write.mode("append").parquet(f"{root}/schema/object={spec.name}")


def ensure_table(
    spark: SparkSession, spec: ObjectSpec, root: str, columns: Sequence[ColumnDef]
) -> list[ColumnDef]:
    """Create the table's schema when missing; return the stored columns."""
    stored = read_columns(spark, spec, root)
    if stored is not None:
        return stored
    check_case_collisions(c.name for c in columns)
    add_columns(spark, spec, root, columns)
    return list(columns)


def raw_schema(spec: ObjectSpec, columns: Sequence[ColumnDef]) -> T.StructType:
    """Everything a raw row has, partition columns last."""
    stored = T.StructType([c.field for c in columns] + list(SYSTEM_FIELDS))
    return T.StructType(
        stored.fields + partition_fields(stored, spec.partition_by) + [T.StructField(COMMIT, T.StringType())]
    )


# ---- read -----------------------------------------------------------------------------------


def read_raw(
    spark: SparkSession, spec: ObjectSpec, root: str, commits: Sequence[str] | None = None
) -> DataFrame:
    """The object's published rows under its present schema; older files read NULL for newer columns.

    Only the folders of visible commits are listed. ``commits`` narrows to some of them.
    """
    columns = read_columns(spark, spec, root)
    if columns is None:
        raise ChangeVaultError(f"object {spec.name}: no table under {root}")
    if commits is None:
        commits = history(spark, root, spec.name).live
    return read_commits(spark, spec, root, columns, commits)


def read_commits(
    spark: SparkSession, spec: ObjectSpec, root: str, columns: Sequence[ColumnDef], commits: Sequence[str]
) -> DataFrame:
    schema = raw_schema(spec, columns)
    if not commits:
        return local_frame(spark, [], schema)
    base = f"{root}/raw/{spec.name}"
    reader = spark.read.schema(schema).option("basePath", base)
    return reader.parquet(*[f"{base}/{COMMIT}={c}" for c in commits])


def stored_files(spark: SparkSession, spec: ObjectSpec, root: str, commits: Sequence[str]) -> DataFrame:
    """``(commit_id, n_partitions, n_files, n_bytes)`` of commits that hold data. Files are listed, not read."""
    paths = [f"{root}/raw/{spec.name}/{COMMIT}={c}" for c in commits]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return files.load(paths).groupBy(F.regexp_extract("path", f"/{COMMIT}=([^/]+)/", 1).alias("commit_id")).agg(
        F.countDistinct(F.regexp_replace("path", "/[^/]*$", "")).alias("n_partitions"),
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"),
    )


# ---- write ----------------------------------------------------------------------------------


def stamp_rows(
    df: DataFrame, columns: Sequence[ColumnDef], sync_id: str, synced_at: datetime
) -> DataFrame:
    """Exactly the table's columns plus the system ones, and those that tell rejects where the frame has them."""
    overflow = col(OVERFLOW) if OVERFLOW in df.columns else F.lit(None).cast("string")
    stored = [*columns, ColumnDef(OVERFLOW, "string")]
    told = [f.name for f in REJECT_FIELDS] if REJECTS in df.columns else []
    return align(df.withColumn(OVERFLOW, overflow), stored, told).select(
        "*",
        F.lit(sync_id).alias(SYNC_ID),
        moment_lit(synced_at).alias(SYNCED_AT),
        F.expr(f"xxhash64({listed(c.name for c in stored)})").alias(ROW_HASH),
    )


def stage(
    df: DataFrame,
    spec: ObjectSpec,
    root: str,
    columns: Sequence[ColumnDef],
    max_records_per_file: int | None = None,
) -> Staged:
    """Write rows under a fresh commit id; what describes them is observed by the write itself.

    Rows are rebalanced first, on the partition columns if there are any: each partition ends up
    in few files of the session's advisory size, and a partition holding most of the batch is
    split over several tasks. Rows are sorted by key within a file, so that a lookup by id
    skips most row groups. Counts are observed behind that shuffle, in the tasks that write: Spark
    takes the numbers of such a task once, however often it is tried, so retries and lost executors
    do not change them, and nothing is read back.
    """
    rows, parts = _to_store(df, spec, columns)
    commit_id, seen = new_commit_id(), Observation()
    _laid_out(rows, spec, parts, seen, _description(spec, columns), max_records_per_file).parquet(
        f"{root}/raw/{spec.name}/{COMMIT}={commit_id}")
    return _staged(spec, commit_id, seen.get)


def stage_split(
    df: DataFrame, spec: ObjectSpec, root: str, columns: Sequence[ColumnDef], label: Column
) -> list[Staged]:
    """Write rows in one job as one commit for each value of ``label``, of which there are few."""
    found = [r[0] for r in df.select(label).distinct().collect()]
    if not found:
        return []
    ids, seen = {value: new_commit_id() for value in found}, Observation()
    rows, parts = _to_store(df.withColumn(COMMIT, _lookup(label, ids)), spec, columns, COMMIT)
    measures = [
        m.alias(f"{commit_id}_{name}") for commit_id in ids.values()
        for name, m in _measures(spec, columns, F.col(COMMIT) == commit_id).items()
    ]
    _laid_out(rows, spec, [COMMIT, *parts], seen, measures, None).mode("append").parquet(f"{root}/raw/{spec.name}")
    told = seen.get
    return [
        _staged(spec, commit_id, {name: told[f"{commit_id}_{name}"] for name in ("n", "lo", "hi", "no_key")})
        for commit_id in ids.values()
    ]


def stage_apart(
    df: DataFrame, spec: ObjectSpec, root: str, columns: Sequence[ColumnDef], max_records_per_file: int | None = None
) -> tuple[Staged, Staged]:
    """Write rows that fit and rows with rejects in one job, to a commit and to a folder beside it that no reader of
    the table lists. Rejected rows are whole: their other columns are typed, ``_rejects`` has the text of the rest."""
    good, bad, seen = new_commit_id(), new_commit_id(), Observation()
    place = F.when(col(REJECTS).isNull(), good).otherwise(bad)
    rows, parts = _to_store(df.withColumn(COMMIT, place), spec, columns, COMMIT, *[f.name for f in REJECT_FIELDS])
    fits = F.col(COMMIT) == good
    measures = [*[m.alias(n) for n, m in _measures(spec, columns, fits).items()], F.count_if(~fits).alias("n_bad")]
    writer = _laid_out(rows, spec, [COMMIT, *parts], seen, measures, max_records_per_file)
    writer.mode("append").parquet(f"{root}/raw/{spec.name}")
    return _staged(spec, good, seen.get), Staged(bad, seen.get["n_bad"], None, None)


def read_rejects(spark: SparkSession, spec: ObjectSpec, root: str, sync_id: str | None = None) -> DataFrame:
    """``(sync_id, page, record_key, column, value)``: every cell that kept a row out of the table, of one sync or all.

    ``record_key`` is the key's text, which may be the rejected cell itself. Only published syncs count.
    """
    ledger = read_ledger(spark, root, spec.name).where((F.col("kind") == RAW) & (F.col("n_rejects") > 0))
    if sync_id is not None:
        ledger = ledger.where(F.col("sync_id") == sync_id)
    schema = T.StructType([T.StructField(SYNC_ID, T.StringType()), *REJECT_FIELDS])
    base = f"{root}/raw/{spec.name}"
    folders = [f"{base}/{COMMIT}={r.rejects_id}" for r in ledger.select("rejects_id").collect()]
    stored = local_frame(spark, [], schema) if not folders else (
        spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*folders))
    cells = stored.select(SYNC_ID, PAGE, REJECT_KEY, F.explode(REJECTS).alias("cell"))
    return cells.select(
        F.col(SYNC_ID).alias("sync_id"), F.col(PAGE).alias("page"), F.col(REJECT_KEY).alias("record_key"), "cell.column", "cell.value")


def _lookup(label: Column, values: dict) -> Column:
    chosen = F.lit(None).cast("string")
    for key, value in values.items():
        chosen = F.when(label.eqNullSafe(F.lit(key)), value).otherwise(chosen)
    return chosen


def _to_store(df: DataFrame, spec: ObjectSpec, columns: Sequence[ColumnDef], *extra: str) -> tuple[DataFrame, list[str]]:
    require_utc(df.sparkSession)
    stored = [f.name for f in raw_schema(spec, columns).fields if f.name != COMMIT]
    rows, parts = with_partitions(df, spec.partition_by)
    return rows.selectExpr(*map(quoted, (*stored, *extra))), parts


def _laid_out(
    rows: DataFrame, spec: ObjectSpec, parts: Sequence[str], seen: Observation, measures: Sequence[Column],
    max_records_per_file: int | None,
) -> DataFrameWriter:
    rows = rows.hint("rebalance", *[col(p) for p in parts]).observe(seen, *measures)
    order = [*parts, spec.primary_key] if spec.primary_key in rows.columns else list(parts)
    rows = rows.sortWithinPartitions(*[col(c) for c in order]) if order else rows
    writer = rows.write.partitionBy(*parts) if parts else rows.write
    if max_records_per_file is not None:
        cap = max_records_per_file if max_records_per_file > 0 else DEFAULT_BATCH_ROWS
        writer = writer.option("maxRecordsPerFile", cap)
    return writer


def _description(spec: ObjectSpec, columns: Sequence[ColumnDef]) -> list[Column]:
    return [m.alias(name) for name, m in _measures(spec, columns, F.lit(True)).items()]


def _measures(spec: ObjectSpec, columns: Sequence[ColumnDef], which: Column) -> dict[str, Column]:
    """Of the rows for which ``which`` holds: how many, first and last stamp, and how many lack a key."""
    names = {c.name: c.type for c in columns}
    stamp = F.lit(None).cast("timestamp")
    if names.get(spec.watermark_field) in ("timestamp", "date"):
        stamp = col(spec.watermark_field).cast("timestamp")
    stamp = F.when(which, F.unix_micros(stamp))
    no_key = col(spec.primary_key).isNull() if spec.primary_key in names else F.lit(False)
    return {"n": F.count_if(which), "lo": F.min(stamp), "hi": F.max(stamp), "no_key": F.count_if(which & no_key)}


def _staged(spec: ObjectSpec, commit_id: str, found: dict) -> Staged:
    if found["no_key"]:
        raise RequiredValueMissing(f"object {spec.name}: {found['no_key']} row(s) without {spec.primary_key}")
    return Staged(commit_id, found["n"], from_micros(found["lo"]), from_micros(found["hi"]))


def _checked(df: DataFrame, spec: ObjectSpec, columns: Sequence[ColumnDef]) -> DataFrame:
    """The frame if the table can hold it: no unknown column, unless they may overflow, and no other type."""
    known = {c.name: c.field.dataType for c in columns}
    unknown = [n for n in df.columns if n not in known and not is_system(n)]
    if unknown and not spec.overflow:
        raise ChangeVaultError(f"object {spec.name}: the table has no column {', '.join(unknown)}")
    wrong = [
        f"{f.name} is {f.dataType.simpleString()}, not {known[f.name].simpleString()}"
        for f in df.schema.fields if f.name in known and f.dataType not in (known[f.name], T.NullType())
    ]
    if wrong:
        raise ChangeVaultError(f"object {spec.name}: {'; '.join(wrong)}")
    stamp = known.get(spec.watermark_field)
    if stamp is not None and not isinstance(stamp, (T.TimestampType, T.DateType)):
        raise ChangeVaultError(
            f"object {spec.name}: watermark field {spec.watermark_field} is {stamp.simpleString()}, which gives no watermark"
        )
    return spill_overflow(df, known) if unknown else df


def append_raw(
    df: DataFrame,
    spec: ObjectSpec,
    root: str,
    sync_id: str,
    synced_at: datetime | None = None,
    watermark: datetime | None = None,
    columns: Sequence[ColumnDef] | None = None,
    job_id: str | None = None,
    max_records_per_file: int | None = None,
    known: History | None = None,
) -> Entry | None:
    """Append a typed batch and publish it; None when it was published before.

    ``watermark`` defaults to the newest stamp written and never goes below the stored one. An
    empty batch is published, as a row without data, only when it brings a ``watermark`` of its own;
    else it gives None too. Unknown columns are an error, or overflow where the object allows it;
    so is a column of another type. Rows with ``_rejects`` (see :func:`changevault.functions.coerce.coerce`) are set
    aside by the same write, for :func:`read_rejects`. Any failure leaves the table and the watermark as they were.
    ``known`` is given by callers that have looked the sync id up.
    """
    spark = df.sparkSession
    synced_at = synced_at or now()
    if columns is None:
        columns = ensure_table(spark, spec, root, columns_of(df))
    df = _checked(df, spec, columns)
    done, last = (False, known.watermark) if known else sync_state(spark, root, spec.name, sync_id)
    if done:
        return None
    stamped, apart = stamp_rows(df, columns, sync_id, synced_at), None
    if REJECTS in df.columns:
        staged, apart = stage_apart(stamped, spec, root, columns, max_records_per_file)
    else:
        staged = stage(stamped, spec, root, columns, max_records_per_file)
    n_rejects = apart.n_rows if apart else 0
    if staged.n_rows == 0 and n_rejects == 0 and watermark is None:
        return None
    marks = [m for m in (watermark or staged.max_stamp, last) if m is not None]
    entry = Entry(
        spec.name, RAW, sync_id, staged.commit_id, staged.n_rows,
        watermark=max(marks) if marks else None,
        last_job_start=synced_at, last_job_id=job_id,
        min_stamp=staged.min_stamp, max_stamp=staged.max_stamp,
        rejects_id=apart.commit_id if n_rejects else None, n_rejects=n_rejects,
    )
    publish(spark, root, entry)
    return entry


def columns_of(df: DataFrame) -> list[ColumnDef]:
    """Column definitions of a typed frame."""
    names = {
        T.StringType: "string", T.LongType: "long", T.IntegerType: "int", T.DoubleType: "double",
        T.FloatType: "float", T.BooleanType: "boolean", T.DateType: "date",
        T.TimestampType: "timestamp", T.BinaryType: "binary",
    }
    try:
        return [
            ColumnDef(f.name, names[type(f.dataType)], not f.nullable)
            for f in df.schema.fields if not is_system(f.name)
        ]
    except KeyError as error:
        raise ChangeVaultError(f"type {error.args[0].__name__} is not one of the table types") from None
