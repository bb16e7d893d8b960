import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from helpers import SF, components, frame, near_links
from test_pii import base
from tokenizers import Tokenizer

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept string, lang_pred string, node string"
ENGLISH = "the quick brown fox jumps over the lazy dog and then runs back to the barn where all the other animals sleep at night"


def rows():
    near = ENGLISH.replace("quick", "swift")
    long = " ".join(f"word{i} of the long story" for i in range(60))
    texts = [ENGLISH, ENGLISH, near, None, "", "123 456", "le chat noir et la souris grise dans la maison", long, long + " end",
             f"{ENGLISH} write to bob@example.org or call +1 (017) 555-7713 now please", "short one", "short one", "Short  one"]
    return [(i, t, "fr" if t and t.startswith("le ") else "en", f"s{i % 2}", len(t or ""), "k", "p", "n") for i, t in enumerate(texts)]


def stages(spark, docs, sf_dir=SF):
    """The result of each stage, handed on as collected rows."""
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        out[name] = docs.collect()
        docs = spark.createDataFrame(out[name], docs.schema)
    return out


def test_each_stage_takes_effect_and_keeps_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "pii", "packing"]
    docs = frame(spark, rows(), COLUMNS)
    got = stages(spark, docs)
    for name in ("language", "exact_dedup", "near_dedup", "pii"):
        assert list(got[name][0].asDict()) == docs.columns, name
    ids = {name: sorted(r.doc_id for r in found) for name, found in got.items() if name != "packing"}
    assert ids["language"] == [0, 1, 2, 6, 7, 8, 9, 10, 11, 12]
    assert ids["exact_dedup"] == [0, 2, 6, 7, 8, 9, 10, 12]
    texts = {r.doc_id: r.text for r in got["exact_dedup"]}
    classes = components(texts, near_links(texts))
    assert ids["near_dedup"] == ids["pii"] == sorted(i for i, c in classes.items() if i == c)
    for r in got["pii"]:
        assert base(r.text) == [] and r.n_chars == len(r.text)
        if not base(texts[r.doc_id]):
            assert r.text == texts[r.doc_id]
    masked = next(r.text for r in got["pii"] if r.doc_id == 9)
    assert "<EMAIL>" in masked and "<PHONE>" in masked and "bob" not in masked
    assert {r.doc_id for r in got["packing"]} == set(ids["pii"])


def test_language_stage_hands_its_prediction_on(spark, monkeypatch):
    text = {"en": ENGLISH, "fr": "le chat noir et la souris grise dans la maison de ma tante"}
    rows = [(i, f"{text[lang]} {i}", lang if i < 30 else said) for i, (lang, said) in enumerate(
        [(k, k) for k in ("en", "fr")] * 15 + [("en", None), ("fr", None), ("en", "fr"), ("fr", "de")])]
    docs = frame(spark, rows + [(99, "12 34", "en")], "doc_id long, text string, lang string")
    stage = corpus_pipeline.known_language
    got = {r.doc_id: r.lang for r in stage(spark, docs, SF).collect()}
    assert got == {i: "en" if i % 2 == 0 else "fr" for i in range(34)}
    # another model, another outcome
    only = docs.where("lang = 'fr' AND doc_id < 30")
    model = corpus_pipeline.language.fit(only)
    monkeypatch.setattr(corpus_pipeline.language, "fit", lambda _: model)
    assert {r.lang for r in stage(spark, docs, SF).collect()} == {"fr"}


def test_a_table_that_names_no_language_keeps_documents_with_letters(spark):
    docs = frame(spark, [(1, "hello", None), (2, "12", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in corpus_pipeline.known_language(spark, docs, SF).collect()] == [(1, "hello", None)]


def test_empty_table(spark):
    got = stages(spark, frame(spark, [], COLUMNS))
    assert all(v == [] for v in got.values())


def test_run_over_a_table(spark):
    packed = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    texts = dict(tuple(r) for r in docs.select("doc_id", "text").collect())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole = {}
    for r in packed:
        ids = np.array([*library.encode(texts[r.doc_id], add_special_tokens=False).ids, 0], "<u4")
        assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
        whole[r.doc_id] = whole.get(r.doc_id, 0) + r.length
        assert r.doc_tokens == len(ids)
    assert whole == {r.doc_id: r.doc_tokens for r in packed} and set(whole) == set(texts)
