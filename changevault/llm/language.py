"""Language by word-first backoff: a known word counts with its log frequency in each language, an unseen word with
those of the longest of its character n-grams that are known."""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from changevault.llm.tasks import per_text
from changevault.llm.text import Words, words

#: The model is fitted on about so many labelled documents, as many of each language, chosen by a hash of their identifier.
FIT_DOCS = 8_000
#: The most frequent words, and n-grams of words, that the model keeps, as many of each language.
FIT_WORDS, FIT_NGRAMS = 60_000, 40_000
LONGEST = 5
#: Long words are cut into n-grams by pieces, so many of which start in each.
_PIECE = 36
UNDETERMINED = "und"
#: Words that are unseen are remembered up to this number, then forgotten.
_MEMORY = 100_000
_ASCII_LETTER = re.compile("[A-Za-z]")
#: What parts words, for learning and for predicting; words that begin with a digit say nothing of the language.
_BETWEEN = r"[^\p{L}\p{M}\p{N}]+"
_PARTED = regex.compile(_BETWEEN)


class Model(NamedTuple):
    languages: list[str]
    words: np.ndarray  # sorted hashes
    word_scores: np.ndarray  # (word, language), log frequencies
    ngrams: dict[str, np.ndarray]


def is_held_out(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0


def sample(docs: DataFrame, id_col: str, size: int) -> DataFrame:
    """About ``size`` rows, the same ones whenever they are drawn."""
    share = min(1.0, size / max(docs.count(), 1))
    return docs.where(F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1_000_000)) < int(share * 1_000_000))


def _log_table(counts: list, languages: list[str]) -> dict[str, np.ndarray]:
    """Smoothed log frequency of each key in each language, less that of a key never seen in it."""
    place = {name: i for i, name in enumerate(languages)}
    seen: dict[str, np.ndarray] = {}
    for key, language, n in counts:
        seen.setdefault(key, np.zeros(len(languages)))[place[language]] += n
    total = sum(seen.values(), np.zeros(len(languages)))
    floor = 0.5
    return {key: np.log((n + floor) / (total + floor * len(seen))) for key, n in seen.items()}


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", fit_docs: int = FIT_DOCS,
        id_col: str = "doc_id") -> Model:
    """A model from the labelled rows of ``docs``; rows without language or text teach nothing.

    Each language has an equal part of ``fit_docs``, ``FIT_WORDS`` and ``FIT_NGRAMS``, and one with fewer documents is taken
    whole. Spark counts the words of these documents by language; the most frequent words and n-grams of each language, so
    at most so many rows for each language, come to the driver.
    """
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = dict(map(tuple, labelled.groupBy(F.col(lang_col)).count().collect()))
    part = max(len(rows), 1)
    if rows:
        drawn = F.create_map(*(F.lit(x) for name, n in rows.items() for x in (
            name, int(min(1.0, max(fit_docs // part, 1) / n) * 1_000_000))))
        labelled = labelled.where(F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1_000_000)) < drawn[F.col(lang_col)])
    counts = labelled.select(F.col(lang_col).alias("lang"), F.explode(
        F.split(F.lower(text_col), _BETWEEN)).alias("word")
    ).where(F.col("word").rlike("^[^0-9]")).groupBy("word", "lang").agg(F.count(F.lit(1)).alias("n"))
    padded = F.concat(F.lit(" "), "word", F.lit(" "))
    pieces = F.transform(F.sequence(F.lit(1), F.length(padded), F.lit(_PIECE)), lambda at: F.substring(padded, at, F.lit(_PIECE + LONGEST - 1)))
    grams = F.flatten(F.transform(F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("piece"))), lambda size: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(_PIECE), F.length("piece") - size + 1)), lambda at: F.substring("piece", at, size))))

    def most(table: DataFrame, key: str, top: int) -> list:
        place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), key))
        by_key = table.withColumn("place", place).where(F.col("place") <= max(top // part, 1)).select(key).distinct()
        return table.join(by_key, key).select(key, "lang", "n").collect()

    known = most(counts, "word", FIT_WORDS)
    parts = most(counts.select("lang", "n", F.explode(pieces).alias("piece")).select("lang", "n", F.explode(grams).alias("gram"))
                 .groupBy("gram", "lang").agg(F.sum("n").alias("n")), "gram", FIT_NGRAMS)
    languages = sorted({r[1] for r in known})
    table = _log_table(known, languages)
    hashes = words(list(table)).hash if table else np.empty(0, np.uint64)
    order = np.argsort(hashes)
    scores = np.array([table[w] for w in table]).reshape(len(table), len(languages))
    return Model(languages, hashes[order], scores[order], _log_table(parts, languages))


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.memory = model, {}

    def unseen(self, word: str) -> np.ndarray:
        """The mean over the longest known n-grams of the word; zeros if not even a character is known."""
        padded = f" {word} "
        for size in range(min(LONGEST, len(padded)), 0, -1):
            known = [g for i in range(len(padded) - size + 1)
                     if (g := self.model.ngrams.get(padded[i:i + size])) is not None and padded[i:i + size] != " "]
            if known:
                return np.mean(known, axis=0)
        return np.zeros(len(self.model.languages))

    def scores(self, texts: list[str]) -> np.ndarray:
        """(text, language): mean over all words of the text of their log frequencies."""
        lower = [t.lower() for t in texts]  # ASCII texts fall into the same words by the classes of their bytes
        found: Words = words([t if t.isascii() else _PARTED.sub(" ", t) for t in lower], split_symbols=True)
        letters = np.frombuffer(found.data, np.uint8)[found.start] if len(found.start) else np.empty(0, np.uint8)
        is_word = (letters >= 97) & (letters <= 122) | (letters >= 128)
        at = np.flatnonzero(is_word)
        doc, h = found.doc[at], found.hash[at]
        m = self.model
        total = np.zeros((len(texts), len(m.languages)))
        if not len(at) or not len(m.words):
            return total
        different, place, back = np.unique(h, return_index=True, return_inverse=True)
        spot = np.minimum(np.searchsorted(m.words, different), len(m.words) - 1)
        hit = m.words[spot] == different
        score = np.where(hit[:, None], m.word_scores[spot], 0.0)
        for i in np.flatnonzero(~hit):
            key = int(different[i])
            if key not in self.memory:
                if len(self.memory) >= _MEMORY:
                    self.memory.clear()
                self.memory[key] = self.unseen(found.word(at[place[i]]))
            score[i] = self.memory[key]
        for j in range(len(m.languages)):
            total[:, j] = np.bincount(doc, score[back, j], len(texts))
        return total / np.maximum(np.bincount(doc, minlength=len(texts)), 1)[:, None]


def has_letter(text: str) -> bool:
    return _ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` as (doc, lang_pred, score): every row, as a struct, its language and how sure it is (0 to 1).

    The score is the language's share when the words' mean log frequencies are weighed against each other over up to
    20 words' worth of evidence. ``und`` with score 0 where the text is NULL or has no letter; a model that has learnt
    nothing gives ``und`` throughout. Ties go to the language first in the alphabet. Repeated rows get the same
    answer; an empty frame gives an empty frame. The model, of bounded size, is broadcast; rows are not shuffled.
    """
    spark = docs.sparkSession
    broadcast = spark.sparkContext.broadcast(model)

    def start() -> Callable[[list[str]], pa.Array]:
        scorer = Scorer(broadcast.value)
        return lambda texts: _answers(scorer, texts)

    answer = per_text(spark, start, "lang_pred string, score double", F.col(text_col))
    return docs.select(F.struct("*").alias("doc"), answer.alias("answer")).select("doc", "answer.*")


def _answers(scorer: Scorer, texts: list[str]) -> pa.Array:
    names = scorer.model.languages
    language, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    if names and texts:
        mean = scorer.scores(texts)
        weight = np.exp(20 * (mean - mean.max(axis=1, keepdims=True)))
        sure, best = weight.max(axis=1) / weight.sum(axis=1), mean.argmax(axis=1)
        for i, text in enumerate(texts):
            if has_letter(text):
                language[i], score[i] = names[best[i]], sure[i]
    return pa.StructArray.from_arrays([pa.array(language, pa.string()), pa.array(score)], ["lang_pred", "score"])
