"""Schema derivation and drift, set-wise over the field catalog of all objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changevault.model import COMPOUND_TYPES, SOURCE_TYPES, DriftHalted

_ON = ["object", "name"]


def _mapped_type(source_type: Column) -> Column:
    pairs = [F.lit(x) for pair in SOURCE_TYPES.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[source_type], F.lit("string"))


def columns_from_catalog(catalog: DataFrame, excludes: DataFrame | None = None) -> DataFrame:
    """``(object, name, type, required)`` for all catalog fields worth a column.

    Excluded names and compound types are left out. A ``position`` column, where the catalog
    has one, is kept.
    """
    kept = catalog.where(~F.coalesce(F.col("type"), F.lit("")).isin(*COMPOUND_TYPES))
    if excludes is not None:
        kept = kept.join(excludes.select(*_ON), _ON, "left_anti")
    position = [F.col("position")] if "position" in catalog.columns else []
    return kept.select(
        "object",
        "name",
        _mapped_type(F.col("type")).alias("type"),
        (~F.col("nillable")).alias("required"),
        *position,
    )


def _compared(current: DataFrame, desired: DataFrame) -> DataFrame:
    system = F.col("name").startswith("_")
    old = current.where(~system).select(*_ON, F.col("type").alias("old_type"))
    new = desired.where(~system).select(*_ON, F.col("type").alias("new_type"))
    change = (
        F.when(F.col("old_type").isNull(), "new")
        .when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "type_change")
    )
    return old.join(new, _ON, "full_outer").withColumn("change", change)


def detect_drift(current: DataFrame, desired: DataFrame) -> DataFrame:
    """``(object, change, name, old_type, new_type)``; change is new, removed or type_change.

    Names are compared exactly; nullability is not compared; system columns take no part.
    """
    return (
        _compared(current, desired)
        .where(F.col("change").isNotNull())
        .select("object", "change", "name", "old_type", "new_type")
    )


def without_intentional(drift: DataFrame, catalog: DataFrame) -> DataFrame:
    """Drop ``removed`` rows of fields the source still has (excluded or compound ones)."""
    fields = catalog.select(F.col("object").alias("__o"), F.col("name").alias("__n"))
    still_there = (
        (F.col("object") == F.col("__o")) & (F.col("name") == F.col("__n")) & (F.col("change") == "removed")
    )
    return drift.join(fields, still_there, "left_anti")


def type_changes(drift: DataFrame) -> DataFrame:
    """Reported only: the stored type stays."""
    return drift.where(F.col("change") == "type_change").drop("change")


def removed_policy(drift: DataFrame, policies: DataFrame) -> DataFrame:
    """``(object, name, action)`` per removed field: halt where the policy says so, else tombstone.

    The rows are field metadata, few for each object; the join relies on adaptive execution for skew.
    """
    policy = policies.select("object", "removed_field_policy")
    return (
        drift.where(F.col("change") == "removed")
        .join(policy, "object", "left")
        .select(
            "object",
            "name",
            F.when(F.col("removed_field_policy") == "halt", "halt").otherwise("tombstone").alias("action"),
        )
    )


def apply_removed_policy(drift: DataFrame, policies: DataFrame) -> DataFrame:
    """:func:`removed_policy`, raising :class:`DriftHalted` if any object must halt."""
    decided = removed_policy(drift, policies)
    halted = (
        decided.where(F.col("action") == "halt")
        .groupBy("object")
        .agg(F.sort_array(F.collect_list("name")).alias("names"))
        .collect()
    )
    if halted:
        told = "; ".join(f"object {r.object}: {', '.join(r.names)}" for r in sorted(halted, key=lambda r: r.object))
        raise DriftHalted(f"columns removed at the source: {told}")
    return decided


def evolve(current: DataFrame, drift: DataFrame, policies: DataFrame | None = None) -> DataFrame:
    """Stored columns plus the new ones, which are always optional.

    Objects whose policy row has ``overflow`` keep their columns; their new fields spill.
    """
    added = drift.where(F.col("change") == "new")
    if policies is not None:
        spilling = policies.where("overflow").select("object")
        added = added.join(spilling, "object", "left_anti")
    added = added.select("object", "name", F.col("new_type").alias("type"), F.lit(False).alias("required"))
    return current.select("object", "name", "type", "required").unionByName(added)


def dry_run(current: DataFrame, desired: DataFrame) -> DataFrame:
    """One report row per object: column counts, changes by kind with their names, drift flag, status.

    Status is ``create`` (no stored table), ``missing`` (no source metadata), ``drift`` or
    ``same``. Intentionally left-out fields count as removed here, as nothing is written. Names
    are sorted; their types are the rows of :func:`detect_drift`.
    """
    names = {"new": "new_columns", "removed": "removed_columns", "type_change": "changed_columns"}
    counts = (
        _compared(current, desired)
        .groupBy("object")
        .agg(
            F.count("old_type").alias("current_columns"),
            F.count("new_type").alias("desired_columns"),
            F.count_if(F.col("change") == "new").alias("n_new"),
            F.count_if(F.col("change") == "removed").alias("n_removed"),
            F.count_if(F.col("change") == "type_change").alias("n_type_change"),
            *[
                F.sort_array(F.collect_list(F.when(F.col("change") == kind, F.col("name")))).alias(column)
                for kind, column in names.items()
            ],
        )
    )
    status = (
        F.when(F.col("current_columns") == 0, "create")
        .when(F.col("desired_columns") == 0, "missing")
        .when(F.col("n_new") + F.col("n_removed") + F.col("n_type_change") > 0, "drift")
        .otherwise("same")
    )
    return counts.select(
        "*", (status == "drift").alias("drift_detected"), status.alias("status")
    )
