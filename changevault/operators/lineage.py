"""Relations between records: canonical ids, parent references, restore order."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from changevault.model import ChangeVaultError, ObjectSpec, col
from changevault.operators.lookup import HOT_BYTES, hot_among, hot_keys, key_counts, lookup_join
from changevault.session import as_utc, checkpoint

CANONICAL_ID = "canonical_id"


def canonical_ids(raw: DataFrame, spec: ObjectSpec, known: DataFrame | None = None) -> DataFrame:
    """``(key, canonical_id)``, one row per key ever seen.

    Keys in ``known`` keep their id, whatever arrives later or is dropped. A new key's id is a hash of
    object, key and its first stamp so far, in UTC. To keep ids for good, store them:
    :func:`changevault.sources.canonical.register_ids`.
    """
    key = spec.primary_key
    first = raw.groupBy(col(key)).agg(F.min(col(spec.watermark_field)).alias("__first"))
    stamp = F.col("__first")
    if isinstance(raw.schema[spec.watermark_field].dataType, T.TimestampType):
        stamp = as_utc(stamp)
    made = F.sha2(F.concat_ws(":", F.lit(spec.name), col(key).cast("string"), stamp.cast("string")), 256)
    if known is None:
        return first.select(col(key), made.alias(CANONICAL_ID))
    kept = known.select(col(key), F.col(CANONICAL_ID).alias("__known"))
    return first.join(kept, key, "full_outer").select(
        col(key), F.coalesce(F.col("__known"), made).alias(CANONICAL_ID)
    )


def assign_canonical_id(
    raw: DataFrame, spec: ObjectSpec, known: DataFrame | None = None, hot_bytes: int = HOT_BYTES
) -> DataFrame:
    """Every row with the canonical id of its key."""
    ids = canonical_ids(raw, spec, known).withColumnRenamed(spec.primary_key, "__id_key")
    return lookup_join(raw, ids, spec.primary_key, "__id_key", hot_bytes).drop("__id_key")


def reference_edges(catalog: DataFrame) -> DataFrame:
    """``(object, field, parent, place)``: the reference fields of a field catalog, a row for each object a field may name.

    ``reference_to`` is the list of these objects, or the name of the only one; ``place`` is the position in the list.
    """
    several = isinstance(catalog.schema["reference_to"].dataType, T.ArrayType)
    parents = F.col("reference_to") if several else F.array("reference_to")
    fields = catalog.where(F.col("type") == "reference")
    named = fields.select("object", F.col("name").alias("field"), F.posexplode(parents).alias("place", "parent"))
    return named.where("parent IS NOT NULL").select("object", "field", "parent", "place")


def rewrite_parent_refs(
    child: DataFrame,
    parent: DataFrame,
    ref: str,
    parent_object: str,
    parent_key: str = "Id",
    canonical: str = CANONICAL_ID,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """Child rows with the reference replaced by the parent's canonical id.

    The new column is named ``ref:object:field``, the form in which an upsert names a parent by
    an external id. Rows whose parent is unknown get NULL.
    """
    target = f"{ref}:{parent_object}:{canonical}"
    ids = parent.select(col(parent_key).alias("__parent_key"), col(canonical).alias("__parent_id"))
    joined = lookup_join(child, ids, ref, "__parent_key", hot_bytes)
    return joined.select(
        *[col(c) for c in child.columns if c != ref], F.col("__parent_id").alias(target)
    )


def rewrite_refs_to_any(
    child: DataFrame, ref: str, parents: Mapping[str, DataFrame], canonical: str = CANONICAL_ID, hot_bytes: int = HOT_BYTES,
    keep_unknown: bool = False, hot: list[tuple] | None = None,
) -> DataFrame:
    """Child rows with a reference that may name records of several objects replaced by one column for each object.

    ``parents`` gives each object's ``(key, canonical id)``, unique by key. Column ``ref:object:field`` holds the
    parent's canonical id where it is of that object and NULL elsewhere, so at most one of them is filled; a key that
    two objects bear counts for the object named first. All parents are looked up in one join on the key, in the
    type of the reference. ``keep_unknown`` keeps the reference itself where none of these objects has its key, for
    fields that may name other objects too. ``hot`` is given by callers that know the reference's hot keys.
    """
    kind = child.schema[ref].dataType
    known = [
        ids.select(col(ids.columns[0]).try_cast(kind).alias("__parent_key"), F.lit(place).alias("__place"),
                   col(ids.columns[1]).alias("__parent_id"))
        for place, ids in enumerate(parents.values())
    ]
    lookup = reduce(DataFrame.unionByName, known).where("__parent_key IS NOT NULL")
    if len(known) > 1:
        lookup = lookup.groupBy("__parent_key").agg(
            F.min("__place").alias("__place"), F.min_by("__parent_id", "__place").alias("__parent_id"))
    joined = lookup_join(child, lookup, ref, "__parent_key", hot_bytes, hot)
    unknown = [F.when(F.col("__place").isNull(), col(ref)).alias(ref)] if keep_unknown else []
    return joined.select(*[col(c) for c in child.columns if c != ref], *unknown, *[
        F.when(F.col("__place") == place, F.col("__parent_id")).alias(f"{ref}:{name}:{canonical}")
        for place, name in enumerate(parents)
    ])


def restore_levels(edges: DataFrame, on_cycle: str = "raise") -> DataFrame:
    """``(object, level)``: 0 without parents, else one more than the highest parent.

    ``edges`` is ``(object, parent)``; rows without an object or parent are no edges. An object referring to itself
    is no ordering constraint. Objects on or behind a cycle never settle: an error, or rows with
    a NULL level for ``on_cycle='null'``; :func:`restore_plan` orders these too.
    """
    ranks = _ranks(edges)
    if on_cycle != "null":
        stuck = ranks.where(F.col("rank") >= _CORE_RANK).select("object")
        some = stuck.orderBy("object").take(5)
        if some:
            raise ChangeVaultError(
                f"references form a cycle: {stuck.count()} objects are on or behind one, among them "
                + ", ".join(str(r.object) for r in some) + "; on_cycle='null' returns them all"
            )
    return ranks.select("object", F.when(F.col("rank") < _CORE_RANK, F.col("rank")).alias("level"))


FREE, CORE, BEHIND = "free", "core", "behind"


def restore_plan(edges: DataFrame) -> DataFrame:
    """``(object, place, level)`` for every object, cycles included.

    ``free`` objects settle as in :func:`restore_levels`. What is left is peeled from the other end: an object that
    no unsettled one refers to is ``behind`` a cycle. What neither end gives up is the ``core``: cycles, and what lies
    on the way from one to another. Core objects share the level after the last free one; they go without their
    references to each other first, which are filled afterwards, at the level that follows. Objects behind have
    levels from there on, parents first.
    """
    ranks, rank = _ranks(edges), F.col("rank")
    highest = ranks.where(rank < _CORE_RANK).agg(F.max(rank)).first()[0]
    level = 0 if highest is None else highest + 1
    return ranks.select(
        "object",
        F.when(rank < _CORE_RANK, FREE).when(rank == _CORE_RANK, CORE).otherwise(BEHIND).alias("place"),
        F.when(rank < _CORE_RANK, rank).otherwise(rank - _CORE_RANK + level).alias("level"),
    )


#: Rank of core objects, above that of every free one; behind them ranks go on.
_CORE_RANK = 1 << 30
#: Edges of which a round takes no longer than the start of its jobs.
_FEW_EDGES = 1000


def _ranks(edges: DataFrame) -> DataFrame:
    """``(object, rank)``: one more than the highest parent's, 0 without parents, ``_CORE_RANK`` in the core.

    Objects that no other refers to are set aside with their edges, as long as that halves the edges at least and
    these are not few; they are on no cycle, and nothing else's rank depends on theirs. What remains is peeled, and
    those set aside follow from it, the last first. So the rounds around the peeling handle twice the edges at most.
    """
    parent = F.when(F.col("object") != F.col("parent"), F.col("parent"))
    told = checkpoint(edges.select(F.coalesce("object", "parent").alias("object"), parent.alias("parent")).where(
        F.col("object").isNotNull()))
    aside, n_open = [], told.where("parent IS NOT NULL").count()
    while n_open > _FEW_EDGES:
        counts = checkpoint(key_counts(told.where("parent IS NOT NULL"), "parent"))
        named = counts.select(F.col("__key").alias("object"))
        inner = checkpoint(told.where("parent IS NOT NULL").join(named, "object", "left_semi").select("object", "parent"))
        n_inner = inner.count()
        if 2 * n_inner > n_open:
            break
        aside.append((told, counts))
        told, n_open = inner.unionByName(named.withColumn("parent", F.lit(None).cast(named.schema["object"].dataType))), n_inner
    ranks = _peeled_ranks(told) if n_open else told.select("object").distinct().withColumn("rank", F.lit(0))
    for told, counts in reversed(aside):
        marks = ranks.select(F.col("object").alias("__parent"), F.col("rank").alias("__rank"))
        open_edges = told.where("parent IS NOT NULL")
        hot = hot_among(counts, open_edges.schema)
        above = lookup_join(open_edges, marks, "parent", "__parent", hot=hot).select("object", (F.col("__rank") + 1).alias("rank"))
        alone = told.where("parent IS NULL").select("object", F.lit(0).alias("rank"))
        reached = above.unionByName(alone).groupBy("object").agg(F.max("rank").alias("rank"))
        ranks = ranks.unionByName(checkpoint(reached.join(ranks.select("object"), "object", "left_anti")))
    return ranks


def _peeled_ranks(edges: DataFrame) -> DataFrame:
    """The ranks by peeling from both ends."""
    free, left = _peeled(edges)
    settled = free.select("object", F.col("level").alias("rank"))
    if left.isEmpty():
        return settled
    _, between = _peeled(left.select(F.col("parent").alias("object"), F.col("object").alias("parent")))
    core = checkpoint(between.select("object").distinct())
    outside = left.join(core, "object", "left_anti")
    own = outside.select("object", F.col("object").alias("parent"))
    apart = outside.join(core.select(F.col("object").alias("parent")), "parent", "left_anti").select("object", "parent")
    behind, _ = _peeled(apart.unionByName(own))
    return settled.unionByName(core.select("object", F.lit(_CORE_RANK).alias("rank"))).unionByName(
        behind.select("object", (F.col("level") + _CORE_RANK + 1).alias("rank")))


def _peeled(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Levels of the objects that settle, and the edges left open.

    Each round closes the edges to what the round before settled and settles the objects left without an open one, so
    there are as many rounds as levels.
    """
    told = edges.select("object", "parent")
    open_edges = checkpoint(told.where(F.col("object") != F.col("parent")).distinct())
    nodes = (
        told.select("object").unionByName(told.select(F.col("parent").alias("object")))
        .where(F.col("object").isNotNull())
        .distinct()
    )
    settled = checkpoint(
        nodes.join(open_edges.select("object").distinct(), "object", "left_anti")
        .withColumn("level", F.lit(0))
    )
    levels, level = settled, 0
    hot = hot_keys(open_edges, "parent")  # of all edges, so of those still open too
    while True:
        level += 1
        # edges of what was just settled close; an object without open edges is settled in turn
        marks = settled.select(F.col("object").alias("__parent"), F.lit(True).alias("__closed"))
        marked = checkpoint(lookup_join(open_edges, marks, "parent", "__parent", hot=hot).drop("__parent"))
        counted = marked.groupBy("object").agg(F.count_if(F.col("__closed").isNull()).alias("open"))
        settled = checkpoint(counted.where("open = 0").select("object", F.lit(level).alias("level")))
        open_edges = marked.where("__closed IS NULL").drop("__closed")
        if settled.isEmpty():
            return levels, open_edges
        levels = levels.unionByName(settled)
