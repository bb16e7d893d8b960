"""Sparse linear models over hashed features: follow-the-regularised-leader updates in shards, weights averaged."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from changevault.llm.language import is_held_out
from changevault.llm.tasks import ship

#: Labelled documents that a model is fitted on at most (about), chosen by a hash of their identifier; the shards they
#: are dealt to, each of which makes so many passes.
FIT_DOCS, SHARDS, PASSES = 16_000, 8, 6


class Ftrl:
    """Follow the regularised leader with a step size for each coordinate."""

    def __init__(self, size: int, alpha: float, beta: float = 1.0, l1: float = 0.0, l2: float = 0.0) -> None:
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z = self.z[at]
        step = (self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / step)

    def learn(self, at: np.ndarray, weights: np.ndarray, gradient: np.ndarray) -> None:
        square = gradient * gradient
        n = self.n[at]
        self.z[at] += gradient - (np.sqrt(n + square) - np.sqrt(n)) / self.alpha * weights
        self.n[at] = n + square


def sigmoid(x: np.ndarray | float) -> np.ndarray | float:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, size: int) -> DataFrame:
    """(doc_id, text, label) of about ``size`` documents with a label that are not held out.

    Labels are thinned out by a hash of the identifier before they meet the texts, so they are few enough to broadcast,
    and no text is shuffled but those of the sample. NULL labels teach nothing; of several labels of a document the
    largest counts.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out("doc_id"))
    share = min(1.0, size / max(known.count(), 1))
    few = known.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000)) < int(share * 1_000_000))
    few = few.groupBy("doc_id").agg(F.max(label).alias("label"))
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(few), "doc_id")


def fit_in_shards(sample: DataFrame, train: Callable[[list[str], np.ndarray], np.ndarray]) -> np.ndarray:
    """The mean of the weights that ``train`` finds in each shard of ``sample`` (doc_id, text, label).

    Only weights other than zero travel, as (place, weight); their number is bounded by the model's size.
    """
    ship(sample.sparkSession)

    def one(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["order", "doc_id"])
        weights = train(list(shard["text"]), shard["label"].to_numpy(np.int64))
        place = np.flatnonzero(weights)
        return pd.DataFrame({"place": place, "weight": weights[place]})

    dealt = sample.withColumns({"shard": F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(SHARDS)), "order": F.xxhash64("doc_id", F.lit(5))})
    trained = dealt.groupBy("shard").applyInPandas(one, "place long, weight double")
    rows = trained.groupBy("place").agg(F.sum("weight").alias("weight")).toPandas()
    used = max(1, sample.select(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(SHARDS))).distinct().count())
    out = np.zeros(int(rows["place"].max()) + 1 if len(rows) else 0)
    out[rows["place"].to_numpy(np.int64)] = rows["weight"].to_numpy() / used
    return out
