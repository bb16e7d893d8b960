"""Language, quality and toxicity: accuracy on held-out documents, and odd texts."""

import zlib

import numpy as np
from helpers import SF, frame

from changevault.llm import language, linear, quality, queries, toxicity

BIG = SF.replace("0.001", "0.01")
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "12345 !?"), (5, "word " * 50_000), (6, "你好 世界"), (7, "ünï"), (7, "ünï"), (None, "text")]


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_language_of_held_out_documents(spark):
    truth = dict(tuple(r) for r in spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang").collect())
    rows = queries.op5_language_id(spark, BIG).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in tested) >= 0.97 * len(tested)


def test_language_of_odd_texts(spark):
    train = frame(spark, [(1, "the cat sat on the mat", "en"), (2, "le chat et la souris", "fr"), (3, "x", None), (4, None, "en")],
                  "doc_id long, text string, lang string")
    model = language.fit(train)
    assert model.languages == ["en", "fr"]
    docs = frame(spark, [*ODD, (8, "the mats"), (9, "les chats")], "doc_id long, text string")
    got = [(r.doc.doc_id, r.lang_pred, r.score) for r in language.predict(docs, model).collect()]
    assert [g[1] for g in got[:4]] == ["und"] * 4 and all(g[2] == 0 for g in got[:4])
    assert all(g[1] in ("en", "fr") for g in got[4:])
    assert [g[1] for g in got[-2:]] == ["en", "fr"]
    assert got[6] == got[7]
    assert language.predict(docs.limit(0), model).count() == 0
    nothing = language.fit(train.limit(0))
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}


def test_unseen_words_fall_back_to_shorter_ngrams():
    model = language.Model(["a", "b"], np.empty(0, np.uint64), np.empty((0, 2)),
                           {"abc": np.array([-1.0, -5.0]), "z": np.array([-5.0, -1.0])})
    scorer = language.Scorer(model)
    assert scorer.unseen("xabcx").tolist() == [-1.0, -5.0]
    assert scorer.unseen("xzx").tolist() == [-5.0, -1.0]
    assert scorer.unseen("qqq").tolist() == [0.0, 0.0]


def test_quality_of_held_out_documents(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    rows = queries.op4_quality(spark, BIG).collect()
    assert len(rows) == spark.read.parquet(f"{BIG}/documents.parquet").count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    tested = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in tested) >= 0.95 * len(tested)


def test_toxicity_of_held_out_documents(spark):
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    rows = queries.op6_toxicity(spark, BIG).collect()
    assert len(rows) == spark.read.parquet(f"{BIG}/documents.parquet").count()
    tested = [r for r in rows if r.doc_id in truth and held(r.doc_id)]
    bad = [r.severity for r in tested if truth[r.doc_id] == 1]
    good = [r.severity for r in tested if truth[r.doc_id] == 0]
    assert np.mean([b > g for b in bad for g in good]) >= 0.8
    assert sum(r.toxic for r in tested if truth[r.doc_id] == 0) <= 0.02 * len(good)


def test_models_of_odd_texts_and_missing_labels(spark):
    docs = frame(spark, ODD, "doc_id long, text string")
    none = frame(spark, [], "doc_id long, quality int, toxic int")
    odd_labels = frame(spark, [(5, None, None), (5, 1, 1), (5, 0, 0), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, odd_labels):
        scores = [r.score for r in quality.predict(docs, quality.fit(docs, labels)).collect()]
        assert len(scores) == len(ODD) and all(0 <= s <= 1 for s in scores)
        grades = toxicity.predict(docs, toxicity.fit(docs, labels)).collect()
        assert len(grades) == len(ODD) and all(0 <= r.severity <= 3 for r in grades)
    assert quality.predict(docs.limit(0), quality.fit(docs, none)).count() == 0
    assert toxicity.predict(docs.limit(0), toxicity.fit(docs, none)).count() == 0


def test_ftrl_learns_a_separable_rule():
    model, rng = linear.Ftrl(4, 1.0, l1=0.01), np.random.default_rng(1)
    for _ in range(400):
        y = int(rng.integers(2))
        at = np.array([0, 1 + y])
        w = model.weights(at)
        model.learn(at, w, (linear.sigmoid(w.sum()) - y) * np.ones(2))
    w = model.weights(slice(None))
    assert w[2] > 1 > -1 > w[1] and w[3] == 0


def test_thresholds_are_ordered_and_severity_grows(spark):
    words = [("bad " * n + "plain text here", min(n, 1)) for n in (0, 0, 0, 1, 2, 3)] * 30
    docs = frame(spark, [(i, t) for i, (t, _) in enumerate(words)], "doc_id long, text string")
    labels = frame(spark, [(i, 1, y) for i, (_, y) in enumerate(words)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    assert (np.diff(model.thresholds) >= 0).all()
    probe = frame(spark, [(i, "bad " * i + "plain text here") for i in range(4)], "doc_id long, text string")
    severity = [r.severity for r in toxicity.predict(probe, model).collect()]
    assert severity == sorted(severity) and severity[3] > severity[0]


def test_rare_languages_and_long_words_are_learnt(spark, monkeypatch):
    monkeypatch.setattr(language, "FIT_WORDS", 20)
    rows = [(i, f"the cat number{i} sat on mat{i}", "en") for i in range(400)] + [(1001, "le chat", "fr"), (1002, "語" * 100, "zz")]
    model = language.fit(frame(spark, rows, "doc_id long, text string, lang string"), fit_docs=30)
    assert model.languages == ["en", "fr", "zz"] and "語" * 5 in model.ngrams


def test_words_are_cut_alike_when_learning_and_predicting(spark):
    """Quotes, dashes and other blanks part words; a model that knows only these words answers for sure."""
    rows = [(i, "“hello” l’homme word—word le\u00a0chat", "xx") for i in range(20)] + [(i, "quatsch sprache", "yy") for i in range(20, 40)]
    model = language.fit(frame(spark, rows, "doc_id long, text string, lang string"))
    scorer = language.Scorer(model)
    for text in ("hello", "“hello”", "l’homme", "word—word", "le\u00a0chat", "hello, le chat!"):
        scorer.scores([text])
        assert scorer.memory == {}, text
    assert "quatsch" not in scorer.memory and scorer.scores(["7 8 9"]).tolist() == [[0.0, 0.0]]


def test_grades_are_cut_once_over_the_whole_sample(spark):
    rows = [(i, "vile " * (1 + i % 9) + "and some plain words", 1) for i in range(90)] + [(i, "plain words", 0) for i in range(90, 180)]
    sample = frame(spark, rows, "doc_id long, text string, label int").repartition(7)
    sign = np.zeros(1 << toxicity.BITS, np.int8)
    sign[toxicity.features(["vile"])[1]] = 1
    hits = np.array([toxicity.features([t])[1] for _, t, y in rows if y], object)
    want = np.quantile([int((sign[h] > 0).sum()) for h in hits], [1 / 3, 2 / 3])
    assert toxicity.cuts_of(sample, sign).tolist() == want.tolist()
    assert toxicity.cuts_of(sample.where("label = 0"), sign).tolist() == [0.0, 0.0]
