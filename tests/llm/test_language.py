"""Languages: held-out accuracy, scores against a direct sum, edge rows."""

from __future__ import annotations

import numpy as np
from edge import SCHEMA, rows

from envlake.llm import language

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    found = language.op7_language_id(spark, FOLDER).collect()
    assert len(found) == len(langs) and all(0 <= r.score <= 1 for r in found)
    held = [r.lang_pred == langs[r.doc_id] for r in found if r.held_out]
    assert len(held) > 150 and np.mean(held) >= 0.98


def test_scores_equal_direct_sums():
    draw = np.random.default_rng(1)
    weights = np.log(draw.dirichlet(np.ones(language.BUCKETS), 3).T).astype(np.float32)
    model = language.LanguageModel(["a", "b", "c"], weights)
    texts = ["Hello, world", "", None, "123 !?", "ÉCOLE école", "x" * 5000]
    named, scores = model.predict(texts)
    for text, name, score in zip(texts, named, scores, strict=True):
        grams = language.text_grams(text)
        if not len(grams):
            assert (name, score) == ("und", 0.0)
            continue
        total = weights[grams].astype(np.float64).sum(axis=0)
        evidence = total * min(len(grams), language.EVIDENCE) / len(grams) / len(language.ORDERS)
        chance = np.exp(evidence - evidence.max())
        assert name == "abc"[total.argmax()] and abs(score - chance.max() / chance.sum()) < 1e-9


def test_grams_take_letters_of_any_case_only():
    assert (language.text_grams("Été—42 NEIGE") == language.text_grams("été neige")).all()
    assert len(language.text_grams("42 — !")) == 0
    # " a " has three characters: three single ones, two pairs, one triple.
    assert len(language.text_grams("A")) == 6


def test_edge_rows(spark):
    frame = spark.createDataFrame(rows(), SCHEMA)
    model = language.fit_language(frame)
    found = {r.doc_id: r for r in language.predict_documents(frame, model).collect()}
    assert language.predict_documents(frame, model).count() == frame.count()
    assert all(found[k].lang_pred == "und" and found[k].score == 0 for k in (100, 101, 102))
    assert all(r.lang_pred in {"en", "de", "und"} for r in found.values())
    kept = language.drop_unknown_language(frame)
    assert kept.columns == frame.columns
    gone = {row.doc_id for row in frame.collect()} - {row.doc_id for row in kept.collect()}
    assert gone == {k for k, r in found.items() if r.score < language.MIN_SCORE}
    assert language.predict_documents(frame.limit(0), model).collect() == []
    assert language.fit_language(frame.limit(0)).languages == []
    unlearned = language.predict_documents(frame, language.fit_language(frame.limit(0))).collect()
    assert {(r.lang_pred, r.score) for r in unlearned} == {("und", 0.0)}
    unnamed = frame.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert language.drop_unknown_language(unnamed).count() == frame.count()


def test_ties_go_to_the_first_language():
    weights = np.zeros((language.BUCKETS, 2), np.float32)
    assert language.LanguageModel(["aa", "bb"], weights).predict(["text"]) [0] == ["aa"]
