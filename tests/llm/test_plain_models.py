"""The trained models and the pipeline against plain versions, and what the registered queries learn from."""

from __future__ import annotations

import math
import random
import shutil
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rollbook.llm import language_id, queries, toxicity
from tests.llm.fixtures import sentence

SF_DIR = "/root/testdata/sf0.001"


# --- toxicity -----------------------------------------------------------------


def plain_ftrl(rows):
    """FTRL-proximal with per-coordinate rates, one coordinate at a time; None is the bias."""
    z, n = Counter(), Counter()

    def weight(at):
        penalty = 0.0 if at is None else toxicity.L1
        if abs(z[at]) <= penalty:
            return 0.0
        return (math.copysign(penalty, z[at]) - z[at]) / ((toxicity.BETA + math.sqrt(n[at])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.PASSES):
        for label, found in rows:
            w = {at: weight(at) for at in [*found, None]}
            gradient = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - label
            for at, old in w.items():
                rate = (math.sqrt(n[at] + gradient**2) - math.sqrt(n[at])) / toxicity.ALPHA
                z[at] += gradient - rate * old
                n[at] += gradient**2
    return weight(None), {at: w for at in z if at is not None and (w := weight(at))}


def features_of(text):
    return sorted({int(b) for _, buckets in toxicity.features(pa.array([text])) for b in buckets})


def labelled(spark, count=300):
    rng = random.Random(8)
    rows = [(i, sentence(rng, rng.randint(2, 25)) + (" grr" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(count)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")


def test_ftrl_is_the_plain_one(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels, seed=5)
    place = F.xxhash64(F.lit(6), F.col("doc_id"), F.xxhash64("text"))
    ordered = docs.join(labels, "doc_id").withColumn("place", place).orderBy("place").collect()
    bias, weights = plain_ftrl([(r["toxic"], features_of(r["text"])) for r in ordered])
    assert model.bias == pytest.approx(bias, rel=1e-9)
    assert dict(zip(model.buckets.tolist(), model.weights.tolist(), strict=True)) == pytest.approx(weights, rel=1e-9)
    for row in toxicity.predict(docs, model).limit(40).collect():
        margin = bias + sum(weights.get(at, 0.0) for at in features_of(row["text"]))
        assert row["score"] == pytest.approx(1 / (1 + math.exp(-margin)), rel=1e-9)


def test_repeated_labels_and_rows_teach_once(spark):
    docs, labels = labelled(spark)
    once = toxicity.fit(docs, labels)
    copies = labels.unionByName(labels.where("doc_id = 7").crossJoin(spark.range(400)).select("doc_id", "toxic"))
    again = toxicity.fit(docs.unionByName(docs.where("doc_id IN (7, 8)")), copies)
    assert once.bias == again.bias and once.weights.tolist() == again.weights.tolist()


def test_an_id_with_very_many_texts_stays_within_the_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "FIT_ROWS", 50)
    docs, labels = labelled(spark, 60)
    many = spark.range(3000).select(F.lit(0).cast("long").alias("doc_id"), F.concat(F.lit("w"), F.col("id").cast("string")).alias("text"))
    seen = []
    rows_of = toxicity._feature_rows
    monkeypatch.setattr(toxicity, "_feature_rows", lambda sample: seen.append(sample.count()) or rows_of(sample))
    toxicity.fit(docs.unionByName(many), labels)
    assert 50 < seen[0] < 200


# --- languages ------------------------------------------------------------------


def test_decoding_is_the_plain_one():
    rng = np.random.default_rng(2)
    code = language_id.codewords(6)
    model = language_id.Model([f"l{i}" for i in range(6)], code, np.zeros((1, code.shape[1])), rng.random(code.shape[1]))
    margins = rng.normal(size=(60, code.shape[1]))
    best, score, close = language_id.decode(model, margins)
    for row, at, share, near in zip(margins.tolist(), best.tolist(), score.tolist(), close.tolist(), strict=True):
        loss = [
            sum(trust * math.log1p(math.exp(-language_id.SHARPNESS * m * bit)) for m, bit, trust in zip(row, word, model.trust.tolist(), strict=True))
            for word in code.tolist()
        ]
        order = sorted(range(6), key=loss.__getitem__)
        assert at == order[0]
        assert share == pytest.approx(1 / sum(math.exp(loss[at] - other) for other in loss))
        assert near == (loss[order[1]] - loss[order[0]] < language_id.AMBIGUOUS_LEAD)


# --- what the registered queries learn from -------------------------------------


def changed_tables(spark, folder, held_out, **columns):
    """The smallest tables with other values in the rows that must not be learned from."""
    for name in ("documents", "labels"):
        table = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        for column, value in columns.items():
            if column in table.columns:
                table = table.withColumn(column, F.when(held_out, value).otherwise(F.col(column)))
        table.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def remainder(key: int, divisor: int) -> int:
    return zlib.crc32(str(key).encode()) % divisor


@pytest.mark.parametrize(
    ("name", "divisor", "left_out", "column"),
    [("op9_ftrl", 5, 0, "toxic"), ("op10_output_codes", 4, 2, "lang")],
)
def test_held_out_rows_are_not_learned(spark, tmp_path, name, divisor, left_out, column):
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor == left_out
    other = F.lit(1) - F.col("toxic") if column == "toxic" else F.lit("xx")
    folder = changed_tables(spark, tmp_path, held_out, **{column: other, "source": F.lit("changed")})
    found = {row["doc_id"]: tuple(row) for row in queries.QUERIES[name](spark, SF_DIR).collect()}
    assert found == {row["doc_id"]: tuple(row) for row in queries.QUERIES[name](spark, folder).collect()}
    rows = queries.QUERIES[name](spark, SF_DIR).select("doc_id", "held_out", "score").collect()
    assert len(rows) == 200
    assert all(row["held_out"] == (remainder(row["doc_id"], divisor) == left_out) and 0 <= row["score"] <= 1 for row in rows)


# --- the pipeline ---------------------------------------------------------------


def grams(words, width=5):
    return [tuple(words[i : i + width]) for i in range(len(words) - width + 1)] if len(words) >= width else [tuple(words)] if words else []


def plain_near(rows):
    """One row of each group of texts linked by similarity 0.8: the one with the smallest id."""
    sets = {i: set(grams(t.lower().split())) for i, t in rows}
    group = {i: i for i, _ in rows}
    ids = sorted(group)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    return [(i, t) for i, t in rows if group[i] == i]


def plain_cut(rows, length=200):
    counts = Counter(t[i : i + length] for _, t in rows for i in range(len(t) - length + 1))
    out = []
    for i, t in rows:
        gone = {at + k for at in range(len(t) - length + 1) if counts[t[at : at + length]] > 1 for k in range(length)}
        out.append((i, "".join(c for at, c in enumerate(t) if at not in gone)))
    return out


def plain_clean(rows, items):
    def hit(words, item):
        wanted = Counter(grams(item))
        for start in range(len(words) - len(item) + 1):
            found = Counter(grams(words[start : start + len(item)]))
            if 100 * (wanted & found).total() >= 80 * (wanted | found).total():
                return True
        return False

    return [(i, t) for i, t in rows if not any(hit(t.lower().split(), item.lower().split()) for item in items)]


def test_pipeline_on_planted_rows(spark, tmp_path):
    rng = random.Random(9)
    letters = ["ba", "do", "ki", "lu", "me", "no", "pa", "ri", "su", "ta"]

    def prose(words):
        return " ".join("".join(rng.choices(letters, k=rng.randint(2, 4))) for _ in range(words))

    items, passage, copied = [prose(25) for _ in range(3)], prose(60), prose(90)
    near = copied.split()
    near[45] = "changed"
    rows = [(i, prose(rng.randint(3, 90)) + (" grr grr" if i % 5 == 0 else "")) for i in range(200)]
    rows += [(300, copied), (301, copied), (302, " ".join(near)), (303, copied.upper())]
    rows += [(310 + i, f"{prose(20)} {passage} {prose(20)}") for i in range(3)]
    rows += [(320, f"{prose(30)} {items[0]} {prose(9)}"), (321, items[1]), (322, f"{prose(12)} {' '.join(items[2].split()[:12])}")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, int("grr" in t)) for i, t in rows if i % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    shutil.copy(f"{SF_DIR}/nation.parquet", tmp_path)

    calm = [(i, t) for i, t in rows if "grr" not in t]
    assert {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).collect()} == {i for i, _ in calm}
    expected = dict(plain_clean(plain_cut(plain_near(calm)), items))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in found} == set(expected)
    assert all(r["exact"] and r["n_chars"] == len(expected[r["doc_id"]]) for r in found)
    assert {301, 302, 303, 320, 321}.isdisjoint(expected) and {300, 322, 310, 311, 312} <= set(expected)


def test_toxic_stage_takes_odd_rows(spark):
    from tests.llm.fixtures import documents

    kept = corpus_pipeline.drop_toxic(spark, documents(spark), SF_DIR)
    assert kept.columns == corpus_pipeline.COLUMNS
    assert kept.count() > 40 and kept.where("doc_id IS NULL").count() == 1
