"""The upsert contract."""

from __future__ import annotations

from random import Random

import pytest
from pyspark.sql import functions as F

from rollbook.operators.merge import latest_per_key, upsert

TARGET = "k string, a string, b int, note string"


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=str)


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [("x", "old", 1, "seed"), ("y", "old", 2, "seed"), (None, "stray", 3, "seed"), (None, "stray", 4, "seed")],
        TARGET,
    )


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(
        [("y", None, 20), ("z", "new", 30), (None, "lost", 40)], "k string, a string, b int"
    )


def merge(target, batch, **options):
    return upsert(
        target, batch, ["k"],
        on_insert={"note": F.lit("insert")},
        overwrite=["a"],
        on_match={"note": F.concat(F.lit("update "), F.col("b").cast("string"))},
        **options,
    )


EXPECTED = [
    ("x", "old", 1, "seed"),
    ("y", None, 2, "update 20"),
    ("z", "new", 30, "insert"),
    (None, "stray", 3, "seed"),
    (None, "stray", 4, "seed"),
]


def test_upsert(target, batch):
    merged = merge(target, batch)
    assert rows(merged.next) == sorted(EXPECTED, key=str)
    assert rows(merged.rejects) == [(None, "lost", 40)]
    assert merged.next.dtypes == target.dtypes


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_batches_against_dictionaries(spark, seed):
    random = Random(seed)
    schema = "k string, a int, b string"
    known = {f"k{n}": (f"k{n}", random.choice([None, n]), "seed") for n in random.sample(range(40), 25)}
    batch = [
        (random.choice([None, *[f"k{n}" for n in range(40)]]), random.choice([None, 1, 2]), f"v{n}")
        for n in range(60)
    ]
    expected = dict(known)
    last = {}
    for k, a, b in batch:
        if k is not None:
            last[k] = max(last.get(k, (-1, "")), (-1 if a is None else a, b))
    for k, (a, b) in last.items():
        new = None if a == -1 else a
        expected[k] = (k, new, known[k][2] + "+" if k in known else b)
    merged = upsert(
        spark.createDataFrame(list(known.values()), schema).withColumn("old", F.col("b")),
        spark.createDataFrame(batch, schema),
        ["k"],
        overwrite=["a"],
        on_match={"b": F.lit("seed+")},
    )
    assert rows(merged.next.drop("old")) == sorted(expected.values(), key=str)
    assert merged.rejects.count() == sum(k is None for k, _, _ in batch)


def test_same_batch_twice_changes_nothing_more(target, batch):
    once = merge(target, batch).next
    twice = merge(once, batch).next
    audit_free = ["k", "a", "b"]
    assert rows(twice.select(audit_free)) == rows(once.select(audit_free))


def test_insert_if_absent(target, batch):
    merged = upsert(target, batch, ["k"]).next
    assert ("y", "old", 2, "seed") in rows(merged)
    assert ("z", "new", 30, None) in rows(merged)


def test_duplicate_keys_in_a_batch(spark, target):
    doubled = spark.createDataFrame(
        [("z", "first", 9, 1), ("z", "last", 1, 2), ("z", "mid", 99, 1)], "k string, a string, b int, seq int"
    )
    by_order = upsert(target, doubled, ["k"], order=["seq"]).next.filter("k = 'z'")
    assert rows(by_order) == [("z", "last", 1, None)]
    without = latest_per_key(doubled, ["k"])
    assert rows(without) == [("z", "mid", 99, 1)]
    assert without.columns == doubled.columns


def test_keys_stay_unique(spark):
    many = spark.range(1000).selectExpr("cast(id % 100 as string) k", "cast(id as string) a", "cast(id as int) b")
    merged = upsert(many.limit(0).withColumn("note", F.lit("")), many, ["k"]).next
    assert merged.count() == merged.select("k").distinct().count() == 100


def test_two_part_key(spark):
    target = spark.createDataFrame([(1, 1, "t"), (1, None, "t")], "a int, b int, v string")
    batch = spark.createDataFrame([(1, 1, "u"), (1, 2, "u"), (1, None, "u")], "a int, b int, v string")
    merged = upsert(target, batch, ["a", "b"], overwrite=["v"])
    assert rows(merged.next) == [(1, 1, "u"), (1, 2, "u"), (1, None, "t")]
    assert rows(merged.rejects) == [(1, None, "u")]
