from __future__ import annotations

import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from rollbook.llm import bpe
from tests.llm.fixtures import documents, empty

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN
REFERENCE = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_ids_and_round_trip(spark):
    encoded = bpe.encode(documents(spark), RANKS, PATTERN)
    decoded = bpe.decode(encoded, RANKS)
    rows = decoded.collect()
    assert len(rows) == documents(spark).count()
    assert decoded.columns[:2] == ["doc_id", "text"]
    for r in rows:
        assert r["ids"] == REFERENCE.encode_ordinary(r["text"] or "")
        assert bytes(r["bytes"]) == (r["text"] or "").encode()


def test_random_texts():
    rng = random.Random(4)
    letters = [chr(c) for c in range(0x250)] + list("　 ‍中文😀½ \n\t") * 8 + list("ab e'st 1 ") * 60
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 50))) for _ in range(3000)]
    texts += ["a" * 3000, "ab" * 1000, " " * 700, "\n" * 99 + "x", "aaa aaaa aaaaa"]
    ids, offsets = bpe.Encoder(RANKS, PATTERN).encode(texts)
    for at, text in enumerate(texts):
        assert ids[offsets[at] : offsets[at + 1]].tolist() == REFERENCE.encode_ordinary(text)


def test_a_pair_that_ranks_before_the_merge_that_made_it():
    ranks = {bytes([b]): b for b in range(256)} | {b"cab": 300, b"ab": 400, b"abab": 500}
    merges = bpe.Merges(ranks)
    words = [b"cabcab", b"cab", b"ababab", b"abab", b"cabab", b"b"]
    ids, offsets = bpe.replay(merges, words)
    for at, word in enumerate(words):
        expected = [ranks[word]] if word in ranks else merges.encode_one(word)
        assert ids[offsets[at] : offsets[at + 1]].tolist() == expected


def test_forgetting_changes_nothing():
    encoder = bpe.Encoder(RANKS, PATTERN, memory=3)
    for text in ("a b c d e f", "g h i a b", "a b c"):
        ids, _ = encoder.encode([text])
        assert ids.tolist() == REFERENCE.encode_ordinary(text)


def test_edges(spark):
    assert bpe.decode(bpe.encode(empty(spark), RANKS, PATTERN), RANKS).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(documents(spark).withColumn("ids", F.lit(1)), RANKS, PATTERN)
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(spark.sql("select array(99999999) ids"), RANKS).collect()
    rows = bpe.decode(spark.sql("select cast(null as array<int>) ids union all select array()"), RANKS).collect()
    assert [bytes(r["bytes"]) for r in rows] == [b"", b""]


def test_round_trip_is_decode_of_encode(spark):
    docs = documents(spark)
    apart = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS)
    together = bpe.round_trip(docs, RANKS, PATTERN)
    assert together.dtypes == apart.dtypes
    assert sorted(map(str, together.collect())) == sorted(map(str, apart.collect()))
    assert bpe.round_trip(empty(spark), RANKS, PATTERN).count() == 0
    for clash in ("ids", "bytes"):
        with pytest.raises(ValueError):
            bpe.round_trip(docs.withColumn(clash, F.lit(1)), RANKS, PATTERN)
    with pytest.raises(ValueError):
        bpe.round_trip(docs, RANKS, PATTERN, ids="bytes")
