"""Canonical ids of one object's records: given at first sight, stored, never changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from changevault.model import ChangeVaultError, ObjectSpec, col
from changevault.operators.lineage import CANONICAL_ID, canonical_ids
from changevault.session import local_frame, read_if_exists
from changevault.sources.ledger import IDS, Entry, history, new_commit_id, publish
from changevault.sources.raw import read_columns, read_raw


def _schema(spark: SparkSession, spec: ObjectSpec, root: str) -> T.StructType:
    columns = {c.name: c.field for c in read_columns(spark, spec, root) or ()}
    if spec.primary_key not in columns:
        raise ChangeVaultError(f"object {spec.name}: no table with a column {spec.primary_key} under {root}")
    return T.StructType([columns[spec.primary_key], T.StructField(CANONICAL_ID, T.StringType())])


def read_ids(spark: SparkSession, spec: ObjectSpec, root: str) -> DataFrame:
    """``(key, canonical_id)`` as stored; no rows before the first :func:`register_ids`."""
    schema = _schema(spark, spec, root)
    stored = read_if_exists(spark, f"{root}/canonical/object={spec.name}", schema)
    return local_frame(spark, [], schema) if stored is None else stored


def register_ids(spark: SparkSession, spec: ObjectSpec, root: str) -> tuple[str, ...]:
    """Give every key of the history that has none yet its id, and store it; the commits read for that.

    Ids are only ever added, so neither a late older version nor retention changes one. The ledger tells which
    commits an earlier run has read, or what maintenance made of them, and only the others are read. A run that
    stores ids and then fails before its ledger row reads the same commits once more and adds nothing. One run at a
    time for an object, like its other jobs.
    """
    known, fresh = read_ids(spark, spec, root), tuple(history(spark, root, spec.name).unregistered)
    if not fresh:
        return ()
    raw = read_raw(spark, spec, root, commits=fresh).select(col(spec.primary_key), col(spec.watermark_field))
    made = canonical_ids(raw, spec).where(col(spec.primary_key).isNotNull())
    missing = made.join(known.select(col(spec.primary_key)), spec.primary_key, "left_anti")
    missing.write.mode("append").parquet(f"{root}/canonical/object={spec.name}")
    publish(spark, root, Entry(spec.name, IDS, None, new_commit_id(), 0, covers=fresh))
    return fresh


def record_key(ids: DataFrame, spec: ObjectSpec, canonical_id: str) -> object:
    """The key that bears a canonical id, to ask for the record's past; an error where none does."""
    found = ids.where(col(CANONICAL_ID) == canonical_id).select(col(spec.primary_key)).take(1)
    if not found:
        raise ChangeVaultError(f"object {spec.name}: no record has the canonical id {canonical_id!r}")
    return found[0][0]
