"""Quality of a text: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changevault.llm.linear import FIT_DOCS, PASSES, Ftrl, fit_in_shards, labelled_sample, sigmoid
from changevault.llm.tasks import per_text
from changevault.llm.text import mix, words

#: Features are hashed to 2**BITS places; place 0 is the intercept.
BITS = 18
ALPHA, L1, L2 = 1.0, 1e-4, 1e-6
#: A frequency of one in SCALE words counts as one.
SCALE = 20.0


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, words of the text) of every word, every two words, and every run of one to three word shapes.

    A word is a run of letters and digits or of symbols. Its shape is lower case, capitalised, upper case, number, or
    the symbols themselves, and whether it repeats the word before it.
    """
    found = words(texts, split_symbols=True)
    n = len(found.hash)
    count = np.bincount(found.doc, minlength=len(texts)).astype(np.float64)
    if not n:
        return found.doc, np.empty(0, np.int64), count
    raw = np.frombuffer(found.data, np.uint8)
    first, last = raw[found.start], raw[found.stop - 1]
    shape = np.zeros(n, np.uint64)
    upper = (first >= 65) & (first <= 90)
    shape[upper] = 1
    shape[upper & (last >= 65) & (last <= 90) & (found.stop - found.start > 1)] = 2
    shape[(first >= 48) & (first <= 57)] = 3
    symbol = (first < 48) | ((first > 57) & (first < 65)) | ((first > 90) & (first < 97)) | ((first > 122) & (first < 128))
    shape = np.where(symbol, found.hash, shape)
    again = np.zeros(n, bool)
    again[1:] = (found.hash[1:] == found.hash[:-1]) & (found.doc[1:] == found.doc[:-1])
    shape = mix(shape * np.uint64(2) + again.astype(np.uint64) + np.uint64(77))
    one = found.doc[:-1] == found.doc[1:]
    two = one[:-1] & one[1:]
    pair = mix(shape[:-1] + shape[1:] * np.uint64(31))
    docs = [found.doc, found.doc[:-1][one], found.doc, found.doc[:-1][one], found.doc[:-2][two]]
    hashes = [found.hash, mix(found.hash[:-1] + found.hash[1:] * np.uint64(31))[one], shape, pair[one],
              mix(pair[:-1] + shape[2:] * np.uint64(1009))[two]]
    place = np.concatenate([mix(h + np.uint64(i)) for i, h in enumerate(hashes)]) % np.uint64((1 << BITS) - 1)
    return np.concatenate(docs), place.astype(np.int64) + 1, count


def _train(texts: list[str], labels: np.ndarray) -> np.ndarray:
    model = Ftrl(1 << BITS, ALPHA, l1=L1, l2=L2)
    rows = []
    for text in texts:
        _, place, count = ngrams([text])
        at, times = np.unique(place, return_counts=True)
        rows.append((np.append(at, 0), np.append(times * (SCALE / max(count[0], 1)), 1.0)))
    for _ in range(PASSES):
        for (at, x), y in zip(rows, labels):
            w = model.weights(at)
            model.learn(at, w, (sigmoid(w @ x) - y) * x)
    return model.weights(slice(None))


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> np.ndarray:
    """Weights from about ``fit_docs`` documents (doc_id, text) whose ``labels.quality`` is known and not held out."""
    return fit_in_shards(labelled_sample(docs, labels, "quality", fit_docs), _train)


def predict(docs: DataFrame, weights: np.ndarray, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` as (doc, score, predicted): each row, how likely it is of good quality (0 to 1), and whether the score
    reaches ``threshold``. NULL and empty texts get the score of the intercept; without any training rows all scores
    are 0.5. Equal texts get equal scores; an empty frame gives an empty frame. The weights, of fixed size, are broadcast.
    """
    full = np.zeros(1 << BITS)
    full[:len(weights)] = weights
    broadcast = docs.sparkSession.sparkContext.broadcast(full)

    def start() -> Callable[[list[str]], pa.Array]:
        w = broadcast.value

        def score(texts: list[str]) -> pa.Array:
            doc, place, count = ngrams(texts)
            total = np.bincount(doc, w[place], len(texts)) * SCALE / np.maximum(count, 1)
            return pa.array(sigmoid(total + w[0]), pa.float64())

        return score

    scored = docs.select(F.struct("*").alias("doc"), per_text(docs.sparkSession, start, "double", F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
