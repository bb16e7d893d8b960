"""Toxicity as grades of severity: a cumulative-link model, one set of weights shared by all ordered thresholds."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changevault.llm.linear import FIT_DOCS, PASSES, Ftrl, fit_in_shards, labelled_sample, sigmoid
from changevault.llm.tasks import map_batches, per_text
from changevault.llm.text import mix, text_pieces, words
from changevault.session import checkpoint

BITS = 18
ALPHA, L1 = 0.5, 0.05
#: Lengths in bytes of the beginnings of words that are features.
STEM_BYTES = range(4, 9)
#: Grades: 0 not toxic, 1 to 3 toxic with few, more and many marked words.
GRADES = 4
#: Features that tell toxic from other texts: standard errors they must differ by, and how many are kept at most.
SCREEN_Z, SCREENED = 3.5, 20_000


class Model(NamedTuple):
    weights: np.ndarray  # by place
    thresholds: np.ndarray  # GRADES - 1, ascending


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of every word of letters, in lower case, and of the beginnings of longer words, so that a compound
    or an inflected form is known by its stem. A text's repeated words count each time."""
    found = words([t.lower() for t in texts], split_symbols=True)
    if not len(found.start):
        return found.doc, np.empty(0, np.int64)
    raw = np.frombuffer(found.data, np.uint8)
    first = raw[found.start]
    word = np.flatnonzero(((first >= 97) & (first <= 122)) | (first >= 128))
    doc, start = found.doc[word], found.start[word]
    length = found.stop[word] - start
    docs, hashes = [doc], [found.hash[word]]
    stem = np.zeros(len(word), np.uint64)
    for k in range(STEM_BYTES[-1]):
        stem = stem * np.uint64(0x100000001B3) + raw[np.minimum(start + k, len(raw) - 1)] + np.uint64(1)
        if k + 1 in STEM_BYTES:
            longer = length > k + 1
            docs.append(doc[longer])
            hashes.append(stem[longer] ^ np.uint64(k))
    return np.concatenate(docs), (mix(np.concatenate(hashes)) % np.uint64(1 << BITS)).astype(np.int64)


def telling(sample: DataFrame) -> np.ndarray:
    """For each place, 1 where it is met in far more toxic texts of ``sample`` than in others, -1 where in far fewer, else 0:
    log odds ratios of more than ``SCREEN_Z`` standard errors, at most ``SCREENED`` places."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in text_pieces(batches):
            doc, place = features(texts)
            pairs = np.unique(doc.astype(np.int64) << BITS | place)
            bad = piece.column("label").to_numpy()[pairs >> BITS] == 1
            place, at = np.unique(pairs & ((1 << BITS) - 1), return_inverse=True)
            bad_count = np.bincount(at, bad, len(place)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(place), pa.array(bad_count), pa.array(np.bincount(at, minlength=len(place)) - bad_count)],
                ["place", "bad", "good"])

    size = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    seen = map_batches(sample.select("text", F.col("label").cast("long").alias("label")), count, "place long, bad long, good long")
    seen = seen.groupBy("place").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    yes, no = F.col("bad") + 0.5, F.col("good") + 0.5
    odds = F.log(yes / (F.lit(toxic + 1.0) - yes + 0.5)) - F.log(no / (F.lit(clean + 1.0) - no + 0.5))
    z = odds / F.sqrt(1 / yes + 1 / no)
    chosen = seen.select("place", z.alias("z")).where(F.abs("z") >= SCREEN_Z).orderBy(F.abs("z").desc(), "place").limit(SCREENED)
    sign = np.zeros(1 << BITS, np.int8)
    for row in chosen.collect():
        sign[row["place"]] = 1 if row["z"] > 0 else -1
    return sign


def cuts_of(sample: DataFrame, sign: np.ndarray) -> np.ndarray:
    """The thirds of the number of marked features in the toxic texts of the whole sample, so that a number means one grade
    in every shard. The driver gets a row for each number met."""
    shared = sample.sparkSession.sparkContext.broadcast(sign)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_pieces(batches):
            doc, place = features(texts)
            hits = np.bincount(doc[shared.value[place] > 0], minlength=len(texts))
            yield pa.RecordBatch.from_arrays([pa.array(hits.astype(np.int64))], ["hits"])

    toxic = map_batches(sample.where("label = 1").select("text"), count, "hits long")
    found = sorted(map(tuple, toxic.groupBy("hits").count().collect()))
    if not found:
        return np.zeros(2)
    return np.quantile(np.repeat([h for h, _ in found], [n for _, n in found]), [1 / 3, 2 / 3])


def graded(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, sign: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Labels say only whether a text is toxic. A toxic text's grade is the third its number of marked features is in."""
    hits = np.array([times[sign[at] > 0].sum() for at, times in rows])
    return np.where(labels == 1, 1 + (hits > cuts[0]) + (hits > cuts[1]), 0)


def _train(sign: np.ndarray, cuts: np.ndarray) -> Callable[[list[str], np.ndarray], np.ndarray]:
    """A function that gives the weights, and behind them the thresholds."""
    def train(texts: list[str], labels: np.ndarray) -> np.ndarray:
        model = Ftrl(1 << BITS, ALPHA, l1=L1)
        counted = []
        for text in texts:
            place = features([text])[1]
            counted.append(np.unique(place[sign[place] != 0], return_counts=True))
        grade = graded(counted, labels, sign, cuts)
        rows = [(at, np.log2(1.0 + times)) for at, times in counted]
        theta, slope = np.linspace(1.0, 3.0, GRADES - 1), np.ones(GRADES - 1)
        for _ in range(PASSES):
            for (at, x), y in zip(rows, grade):
                w = model.weights(at)
                eta = float(w @ x)
                low = sigmoid(theta[y - 1] - eta) if y else 0.0
                high = sigmoid(theta[y] - eta) if y < GRADES - 1 else 1.0
                model.learn(at, w, (1 - low - high) * x)
                push, mass = np.zeros(GRADES - 1), max(high - low, 1e-6)
                if y < GRADES - 1:
                    push[y] = -high * (1 - high) / mass
                if y:
                    push[y - 1] = low * (1 - low) / mass
                push = np.clip(push, -5, 5)
                slope += push * push
                theta = np.maximum.accumulate(theta - 0.3 * push / np.sqrt(slope))  # thresholds stay in order
        return np.concatenate([model.weights(slice(None)), theta])

    return train


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> Model:
    """A model from about ``fit_docs`` documents (doc_id, text) whose ``labels.toxic`` is known and not held out."""
    sample = checkpoint(labelled_sample(docs, labels, "toxic", fit_docs))  # read several times
    sign = telling(sample)
    found = fit_in_shards(sample, _train(sign, cuts_of(sample, sign)))
    if not len(found) or not (sign > 0).any():
        return Model(np.zeros(1 << BITS), np.full(GRADES - 1, 60.0))
    full = np.zeros((1 << BITS) + GRADES - 1)
    full[:len(found)] = found
    return Model(full[:1 << BITS], np.sort(full[1 << BITS:]))


def predict(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` as (doc, severity, grade, toxic): each row, its expected grade (0 to 3), its likeliest grade (ties to the lower)
    and whether it is toxic with a probability of ``threshold`` or more. NULL and empty texts have no words and so the lowest severity; a model without
    training rows finds nothing toxic. Equal texts get equal answers; an empty frame gives an empty frame.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def start() -> Callable[[list[str]], pa.Array]:
        m = broadcast.value

        def score(texts: list[str]) -> pa.Array:
            doc, place = features(texts)
            heavy = m.weights[place] != 0  # only words that the model knows need counting
            key, times = np.unique(doc[heavy].astype(np.int64) << BITS | place[heavy], return_counts=True)
            eta = np.bincount(key >> BITS, m.weights[key & ((1 << BITS) - 1)] * np.log2(1.0 + times), len(texts))
            above = sigmoid(eta[:, None] - m.thresholds[None, :])
            each = np.concatenate([np.ones((len(texts), 1)), above], axis=1) - np.concatenate([above, np.zeros((len(texts), 1))], axis=1)
            return pa.StructArray.from_arrays([
                pa.array(above.sum(axis=1)), pa.array(each.argmax(axis=1), pa.int32()), pa.array(above[:, 0] >= threshold),
            ], ["severity", "grade", "toxic"])

        return score

    answer = per_text(docs.sparkSession, start, "severity double, grade int, toxic boolean", F.col(text_col))
    return docs.select(F.struct("*").alias("doc"), answer.alias("answer")).select("doc", "answer.*")
