"""Current state: merging the newest versions into a keyed table.

Both sides of every join here hold one row per key, so no key is hot at the join; the
reduction to one row per key happens before, in :func:`latest_per_key`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from changevault.model import ROW_HASH, SYNCED_AT, ObjectSpec, col, is_system, quoted

IS_LIVE = "_is_live"
VERSION = ("_ver_stamp", "_ver_synced", "_ver_hash")
_KEY = "__key"


def deleted_flag(df: DataFrame, name: str) -> Column:
    """The soft-delete flag as boolean; text other than true/false counts as NULL."""
    if name not in df.columns:
        raise ValueError(f"column {name!r} is needed to tell deleted records")
    flag = col(name)
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return flag
    return F.when(flag == "true", True).when(flag == "false", False)


def merge_actions(current: DataFrame, latest: DataFrame, key: str, deleted: str) -> DataFrame:
    """``(key, action)`` per newest version: delete, update, insert or none."""
    target = current.select(col(key).alias("__k"), F.lit(True).alias("__t"))
    source = latest.select(col(key).alias("__k"), deleted_flag(latest, deleted).alias("__del"))
    matched = F.col("__t").isNotNull()
    action = (
        F.when(matched & F.col("__del"), "delete")
        .when(matched & ~F.col("__del"), "update")
        .when(~matched & ~F.col("__del"), "insert")
        .otherwise("none")
    )
    return source.join(target, "__k", "left").select(F.col("__k").alias(key), action.alias("action"))


def merge_current(current: DataFrame, latest: DataFrame, key: str, deleted: str) -> DataFrame:
    """The target after the merge.

    Matched and deleted: removed. Matched and live: all columns replaced. Unmatched and live:
    inserted. A NULL flag or an unmatched deletion does nothing; keys only the target has stay.
    Columns come from ``latest``, then those only ``current`` has.
    """
    columns = latest.columns + [c for c in current.columns if c not in latest.columns]
    joined = _full_outer(current, latest, key, deleted, {"__all": columns})
    apply = F.coalesce(~F.col("__del"), F.lit(False))
    remove = F.coalesce(F.col("__del"), F.lit(False))
    kept = joined.where(apply | (F.col("__t").isNotNull() & ~remove))
    return _chosen(kept, current, latest, {"__all": (apply, columns)})


def empty_state(df: DataFrame) -> DataFrame:
    """A state table without rows, with the columns of ``df``."""
    return _with_version(df.limit(0)).withColumn(IS_LIVE, F.lit(False))


def merge_state(state: DataFrame, latest: DataFrame, spec: ObjectSpec) -> DataFrame:
    """Merge that may be fed any part of the history, in any order, and repeatedly.

    ``state`` keeps deleted keys and the newest version seen of every key, whatever its flag.
    A version older than that one changes nothing, so a late arrival cannot bring a deleted
    record back. :func:`live_rows` is what :func:`merge_current` would hold.
    """
    latest = _with_version(latest)
    data = [c for c in latest.columns if c not in VERSION]
    data += [c for c in state.columns if c not in data and c not in VERSION and c != IS_LIVE]
    parts = {"__data": [c for c in data if c != spec.primary_key], "__ver": list(VERSION)}
    joined = _full_outer(state, latest, spec.primary_key, spec.deleted_field, parts)
    in_s, in_t = F.col("__s").isNotNull(), F.col("__t").isNotNull()
    newer = in_s & (~in_t | (F.col("__s.__ver") >= F.col("__t.__ver")))
    judged = joined.withColumn("__newer", newer).withColumn(
        "__apply", F.col("__newer") & F.coalesce(~F.col("__del"), F.lit(False))
    ).withColumn("__remove", F.col("__newer") & F.coalesce(F.col("__del"), F.lit(False)))
    live = F.when(F.col("__apply"), True).when(F.col("__remove"), False).otherwise(
        F.coalesce(F.col(f"__t.{IS_LIVE}"), F.lit(False))
    )
    judged = judged.withColumn("__live", live).withColumnRenamed("__k", _KEY)
    chosen = _chosen(judged, state, latest, {
        "__data": (F.col("__apply") | F.col("__remove"), parts["__data"]), "__ver": (F.col("__newer"), list(VERSION)),
    }, [_KEY, "__live"])
    return chosen.withColumnRenamed(_KEY, spec.primary_key).selectExpr(
        *map(quoted, data), *VERSION, f"__live AS {IS_LIVE}"
    )


def live_rows(state: DataFrame) -> DataFrame:
    """The records alive, without bookkeeping columns."""
    return state.where(IS_LIVE).drop(IS_LIVE, *VERSION)


def versioned(df: DataFrame, spec: ObjectSpec) -> DataFrame:
    """Raw rows reduced to their data columns plus the version that orders them."""
    data = [c for c in df.columns if not is_system(c) or c == "_overflow"]
    return df.selectExpr(
        *map(quoted, data), f"CAST({quoted(spec.watermark_field)} AS TIMESTAMP_LTZ) AS {VERSION[0]}",
        f"{SYNCED_AT} AS {VERSION[1]}", f"{ROW_HASH} AS {VERSION[2]}",
    )


def _with_version(df: DataFrame) -> DataFrame:
    if not set(VERSION) <= set(df.columns):
        raise ValueError("rows lack version columns; pass them through versioned() first")
    return df


def _full_outer(target: DataFrame, source: DataFrame, key: str, deleted: str, parts: dict[str, list[str]]) -> DataFrame:
    """``(__k, __t, __s, __del)``: each side's row as one struct, NULL where it has none.

    The columns in ``parts`` are grouped into structs of the same fields on both sides, so that a
    merge chooses once between two structs instead of once for each column.
    """
    types = {f.name: f.dataType.simpleString() for df in (source, target) for f in df.schema.fields}

    def side(df: DataFrame, extra: list[str]) -> str:
        present = set(df.columns)
        groups = [
            "struct(" + ", ".join(
                quoted(c) if c in present else f"CAST(NULL AS {types[c]}) AS {quoted(c)}" for c in columns
            ) + f") AS {name}"
            for name, columns in parts.items() if columns
        ]
        return f"struct({', '.join(groups + [quoted(c) for c in extra if c in present])})"

    t = target.selectExpr(f"{quoted(key)} AS __k", f"{side(target, [IS_LIVE])} AS __t")
    s = source.withColumn("__del", deleted_flag(source, deleted)).selectExpr(
        f"{quoted(key)} AS __k", f"{side(source, [])} AS __s", "__del"
    )
    return t.join(s, "__k", "full_outer")


def _chosen(
    joined: DataFrame, target: DataFrame, source: DataFrame, parts: dict[str, tuple[Column, list[str]]],
    keep: Sequence[str] = (),
) -> DataFrame:
    """The source's struct where its condition holds, else the target's, expanded; columns that only the
    target has come from the target."""
    parts = {name: part for name, part in parts.items() if part[1]}
    picked = joined.select(*keep, "__t", *[
        F.when(condition, F.col(f"__s.{name}")).otherwise(F.col(f"__t.{name}")).alias(name)
        for name, (condition, _) in parts.items()
    ])
    here = set(source.columns)
    return picked.selectExpr(*keep, *[
        f"{name if c in here else f'__t.{name}'}.{quoted(c)} AS {quoted(c)}"
        for name, (_, columns) in parts.items() for c in columns
    ])
