from __future__ import annotations

import zlib
from collections import Counter

import pytest

from rollbook.llm import sharding
from tests.llm.fixtures import documents, empty

EIGHT = {i: 1.0 for i in range(8)}
NINE = {i: 1.0 for i in range(9)}


def test_shards_slots_and_growth(spark):
    docs = documents(spark, [f"text {i}" for i in range(500)])
    rows = sharding.shard_table(docs, EIGHT, NINE).collect()
    assert len(rows) == 502
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 8)
        if r["doc_id"] == 7:
            assert (r["size"], r["text_crc32"]) == (7, zlib.crc32(b"text 7"))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    moved = sum(r["grown_shard"] == 8 for r in rows)
    assert 20 < moved < 110


def test_odd_rows(spark):
    rows = sharding.shard_table(documents(spark), EIGHT, NINE).collect()
    of_null = next(r for r in rows if r["doc_id"] == 0)
    assert (of_null["size"], of_null["text_crc32"]) == (1, 0)
    assert len(rows) == documents(spark).count()
    assert sharding.shard_table(empty(spark), EIGHT, NINE).count() == 0


def test_one_key_for_many_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPY_BLOCK", 10)
    docs = spark.range(1000).selectExpr("7L as doc_id", "'same' as text")
    rows = sharding.shard_table(docs, EIGHT, NINE).collect()
    assert sorted(r["slot"] for r in rows) == list(range(1000))
    assert len({r["shard"] for r in rows}) == 1


def test_weights(spark):
    keys = spark.range(4000).withColumnRenamed("id", "doc_id")
    counts = Counter(r["shard"] for r in sharding.assign_shard(keys, "doc_id", {0: 1.0, 1: 3.0}).collect())
    assert 0.70 < counts[1] / 4000 < 0.80
    with pytest.raises(ValueError):
        sharding.assign_shard(keys, "doc_id", {})
    with pytest.raises(ValueError):
        sharding.assign_shard(keys.selectExpr("doc_id", "1 as shard"), "doc_id", {0: 1.0})
