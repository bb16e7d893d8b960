"""Exact copies by sorting content: sampled splitters deal texts out, an external sort lays equals side by side,
and neighbours are compared in full. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

#: A text with more copies than rows / HOT_SHARE is counted by partial sums and is not sorted.
HOT_SHARE = 2048
#: No text with fewer copies than this counts as hot.
HOT_ROWS = 256
#: So many leading characters of a text are sent to the driver when splitters are sampled; the hash decides beyond.
SPLITTER_CHARS = 48


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, keep: str = "smallest",
                hot_rows: int | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc`` (the row), ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical; NULL counts as empty. Of equal texts the row with the smallest
    (``keep="largest"``: largest) identifier stays; a NULL identifier stays only where there is no other, and of
    rows that repeat both text and identifier exactly one stays. Columns of ``docs`` may have any name: they travel
    in ``doc``. An empty frame gives an empty frame.

    Rows are range-partitioned by leading characters and hash of the text. Splitters are sampled, so only those
    short keys reach the driver, not texts. The sort is by the same keys and then by the whole text, and rows are
    grouped where neighbours are equal in full. Texts with very many copies (found by counting hashes; at most
    ``HOT_SHARE`` of them, so that they can be broadcast) are counted where they are read and merged as partial
    sums. Of these, only rows that may stay are sorted, so no task receives a large group.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is {keep!r}; it must be 'smallest' or 'largest'")
    best = F.min if keep == "smallest" else F.max
    rows = docs.select(
        F.struct("*").alias("doc"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("hash", F.xxhash64("text"))
    limit = hot_rows or max(HOT_ROWS, docs.count() // HOT_SHARE)
    hot = F.broadcast(rows.groupBy("hash").count().where(F.col("count") > limit).select("hash"))
    groups = (
        rows.join(hot, "hash", "left_semi").groupBy("hash", "text")
        .agg(best("id").alias("hot_id"), F.count(F.lit(1)).alias("hot_size"))
        .select("hash", F.sha2("text", 256).alias("sha"), "hot_id", "hot_size")
    )
    known = (
        rows.withColumn("sha", F.sha2("text", 256)).join(F.broadcast(groups), ["hash", "sha"], "left")
        .withColumn("head", F.substring("text", 1, SPLITTER_CHARS))
        .drop("text")
    )
    dropped = F.col("hot_size").isNotNull() & ~F.col("id").eqNullSafe(F.col("hot_id"))
    whole = F.coalesce(F.col("doc")[text_col], F.lit(""))
    order = F.col("id").asc_nulls_last() if keep == "smallest" else F.col("id").desc_nulls_last()
    equal = Window.partitionBy("head", "hash", whole).orderBy(order)
    everywhere = equal.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    compared = known.where(~dropped).repartitionByRange("head", "hash").select(
        "doc", "sha",
        F.coalesce("hot_id", best("id").over(everywhere)).alias("keep_id"),
        F.coalesce("hot_size", F.count(F.lit(1)).over(everywhere)).alias("group_size"),
        (F.row_number().over(equal) == 1).alias("kept"),
    )
    copies = known.where(dropped).select(
        "doc", "sha", F.col("hot_id").alias("keep_id"), F.col("hot_size").alias("group_size"),
        F.lit(False).alias("kept"),
    )
    return compared.unionByName(copies).select(
        "doc", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, keep: str = "smallest") -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    return mark_copies(docs, id_col, text_col, keep=keep).where("kept").select("doc.*")
