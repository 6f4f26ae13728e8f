from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollbook.llm import language_id, toxicity
from tests.llm.fixtures import documents, empty, texts

SYLLABLES = {"aa": ["ka", "lo", "mi"], "bb": ["sch", "ung", "ein"], "cc": ["été", "que", "oui"], "dd": ["ción", "ll", "os"], "ee": ["by", "th", "wh"]}


def spoken(rng, lang, words):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=3)) for _ in range(words))


def corpus(spark):
    rng = random.Random(3)
    rows = [(i, spoken(rng, lang, rng.randint(3, 30)), lang) for i, lang in enumerate(list(SYLLABLES) * 60)]
    return spark.createDataFrame([*rows, (900, None, "aa"), (901, "ka lo", None), (902, "", "bb")], "doc_id long, text string, lang string")


@pytest.mark.parametrize("langs", [1, 2, 5, 7, 12])
def test_codewords_differ(langs):
    code = language_id.codewords(langs)
    assert len({tuple(row) for row in code.tolist()}) == langs
    assert all(np.ptp(column) == 2 for column in code.T)


def test_languages_are_told_apart(spark):
    docs = corpus(spark)
    model = language_id.fit(docs.where("doc_id % 4 <> 2"))
    assert model.langs == list(SYLLABLES)
    rows = language_id.predict(docs, model).where("doc_id < 900 AND doc_id % 4 = 2").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark):
    model = language_id.fit(corpus(spark))
    odd = documents(spark, [None, "", "12 34 !!", *texts()])
    rows = {r["doc_id"]: r for r in language_id.predict(odd, model).collect()}
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in range(3))
    assert all(r["lang_pred"] in [*SYLLABLES, "und"] for r in rows.values())
    none = language_id.fit(empty(spark))
    assert {r["lang_pred"] for r in language_id.predict(odd, none).collect()} == {"und"}
    one = language_id.fit(corpus(spark).where("lang = 'cc'"))
    assert {r["lang_pred"] for r in language_id.predict(odd, one).collect()} == {"cc", "und"}
    assert language_id.predict(empty(spark), model).count() == 0
    with pytest.raises(ValueError):
        language_id.predict(odd.withColumn("score", F.lit(1)), model)


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    model = language_id.fit(corpus(spark))
    long = spark.createDataFrame([(1, "ka lo mi " * 3000)], "doc_id long, text string")
    whole = language_id.predict(long, model).first()["score"]
    monkeypatch.setattr(language_id, "PIECE", 1000)
    assert language_id.predict(long, model).first()["score"] == pytest.approx(whole)


def insults(spark):
    rng = random.Random(6)
    rows = []
    for i in range(2000):
        words = [rng.choice(["an", "the", "of", "tion", "ing", "her"]) + rng.choice(["", "s", "ed"]) for _ in range(rng.randint(5, 60))]
        if i % 5 == 0:
            words.insert(rng.randrange(len(words)), rng.choice(["Blah", "grr"]))
        rows.append((i, " ".join(words), int(i % 5 == 0)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y, 1) for i, _, y in rows] + [(None, 1, 1), (3, None, 1)], "doc_id long, toxic int, quality int")


def test_toxic_words_are_learned(spark):
    docs, labels = insults(spark)
    model = toxicity.fit(docs, labels.where("doc_id % 4 <> 1"))
    assert 0 < len(model.weights) < 4000
    rows = toxicity.predict(docs, model).join(labels.where("toxic IS NOT NULL"), "doc_id").where("doc_id % 4 = 1").collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.95 * len(rows)


def test_toxicity_edges(spark):
    docs, labels = insults(spark)
    model = toxicity.fit(docs, labels)
    rows = toxicity.predict(documents(spark), model).collect()
    assert len(rows) == documents(spark).count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    none = toxicity.fit(docs, labels.limit(0))
    assert {r["predicted"] for r in toxicity.predict(docs, none).collect()} == {0}
    assert toxicity.predict(empty(spark), model).count() == 0
    with pytest.raises(ValueError):
        toxicity.predict(docs.withColumn("score", F.lit(1)), model)


def test_fitting_is_the_same_on_other_partitions(spark):
    docs, labels = insults(spark)
    one = toxicity.fit(docs.repartition(5), labels)
    other = toxicity.fit(docs.coalesce(1), labels)
    assert one.bias == other.bias and one.weights.tolist() == other.weights.tolist()
