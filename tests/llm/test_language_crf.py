"""The random field against enumeration, held-out documents, code-switched texts, hard tables."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from llm.conftest import HARD
from pyspark.sql import functions as F

from weftline.llm import language_crf

SF = "/root/testdata/sf0.01"


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    kinds, sizes = 3, np.array([4, 1, 3])
    scores, moves = rng.normal(size=(3, 4, kinds)) * 2, rng.normal(size=(kinds, kinds)) * 2
    marginal, expected = language_crf.forward_backward(scores, sizes, moves, pairs=True)
    want, want_pairs = np.zeros((3, 4, kinds)), np.zeros((kinds, kinds))
    for s, size in enumerate(sizes):
        paths = list(itertools.product(range(kinds), repeat=int(size)))
        weights = np.exp([sum(scores[s, t, y] for t, y in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:])) for p in paths])
        for p, w in zip(paths, weights / weights.sum()):
            for t, y in enumerate(p):
                want[s, t, y] += w
            for pair in zip(p, p[1:]):
                want_pairs[pair] += w
    assert np.allclose(marginal, want) and np.allclose(expected, want_pairs)


def test_features_of_a_form_do_not_depend_on_its_neighbours():
    forms = ["", "a", "ab", "straße", "你好", "abcdefgh"]
    owner, slot = language_crf._features(forms)
    for i, f in enumerate(forms):
        alone = language_crf._features([f])[1]
        assert sorted(slot[owner == i]) == sorted(alone) and (len(alone) > 0) == (f != "")
    assert (language_crf._form_hash(forms) == [language_crf._form_hash([f])[0] for f in forms]).all()


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, language_crf.fit(docs)


def test_held_out_documents(fitted):
    docs, model = fitted
    found = language_crf.predict(docs.withColumns({"score": F.lit("x"), "held_out": F.lit(1)}), model)
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").where(F.col("lang").isNotNull()).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 150 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {tuple(r["spans"][0]) for r in rows[:50] if len(r["spans"]) == 1} <= {(0, r["n_words"], r["spans"][0]["lang"]) for r in rows[:50] if r["spans"]}


def test_words_of_code_switched_texts(spark, fitted):
    docs, model = fitted
    rows = docs.where(language_crf.is_held_out() & F.col("lang").isNotNull() & (F.length("text") > 800)).limit(60).collect()
    rng = random.Random(2)
    mixed = []
    for i in range(60):
        a, b = rng.sample(rows, 2)
        cut = [rng.randint(30, 80), rng.randint(30, 80)]
        words = a["text"].split()[: cut[0]] + b["text"].split()[: cut[1]]
        mixed.append((i, " ".join(words), [a["lang"]] * cut[0] + [b["lang"]] * cut[1]))
    found = language_crf.predict(spark.createDataFrame([m[:2] for m in mixed], "doc_id bigint, text string"), model).collect()
    right = total = 0
    for r in found:
        own = [s["lang"] for s in r["spans"] for _ in range(s["words"])]
        want = mixed[r["doc_id"]][2]
        assert len(own) == len(want) == r["n_words"]
        right += sum(map(str.__eq__, own, want))
        total += len(want)
    assert right >= 0.93 * total


def test_only_training_rows_teach(spark, fitted):
    docs, model = fitted
    changed = docs.withColumn("lang", F.when(language_crf.is_held_out(), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    again = language_crf.fit(changed.repartition(7))
    assert again.languages == model.languages and (again.weights == model.weights).all() and (again.transitions == model.transitions).all()


def test_hard_and_empty(spark, hard, empty):
    labelled = hard.withColumn("lang", F.when(F.col("doc_id") == 7, "l2").otherwise("l1"))
    for docs in (labelled, hard.withColumn("lang", F.lit(None).cast("string")), labelled.withColumn("lang", F.lit("one"))):
        rows = language_crf.predict_languages(docs).collect()
        assert Counter(r["doc_id"] for r in rows) == Counter(d for d, _ in HARD)
        assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows if r["doc_id"] in (2, 3, 4))
    none = language_crf.predict_languages(hard.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    assert language_crf.predict_languages(empty.withColumn("lang", F.lit("a"))).count() == 0
    digits = spark.createDataFrame([(1, "12 34 ... ’"), (2, "4 ª")], "doc_id bigint, text string")
    one = language_crf.Model(["a"], np.zeros((1 << language_crf.BITS, 1), np.float32), np.zeros((1, 1)), np.zeros(0, np.uint64), np.zeros(0, int), np.zeros((1, 1), np.float32))
    assert [(r["doc_id"], r["lang_pred"], r["score"]) for r in language_crf.predict(digits, one).orderBy("doc_id").collect()] == [(1, "und", 0.0), (2, "a", 1.0)]
