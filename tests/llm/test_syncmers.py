"""Closed syncmers against a plain version by the definition."""

from __future__ import annotations

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from rollbook.llm import syncmers
from rollbook.llm.queries import op11_closed_syncmers
from rollbook.llm.syncmers import K, S, WIDTH
from tests.llm.fixtures import sentence

SEED = 42


def hashed(data: bytes) -> int:
    value = xxhash.xxh64(data, seed=SEED).intdigest()
    return value - 2**64 if value >= 2**63 else value


def plain_anchors(data: bytes) -> list[tuple[int, int]]:
    found = []
    for at in range(len(data) - K + 1):
        inner = [hashed(data[at + i : at + i + S]) for i in range(WIDTH)]
        if min(inner) in (inner[0], inner[-1]):
            found.append((at, hashed(data[at : at + K])))
    return found


def plain_fingerprint(data: bytes) -> list[int]:
    found = sorted({value for _, value in plain_anchors(data)})
    return found or ([hashed(data)] if data else [])


def plain_rows(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    """The documents in order, each with its edited text and both likenesses."""
    mark = {text: hashed((text or "").encode()) for _, text in rows}
    texts = sorted({(i if i is not None else -(2**63), mark[t], t or "", i is None) for i, t in rows})
    by_row, out = {}, []
    for at, (place, value, text, _) in enumerate(texts):
        after = texts[(at + 1) % len(texts)][2]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        own, new, other = (plain_fingerprint(t.encode()) for t in (text, edited, after))

        def alike(a, b):
            return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0

        by_row[place, value] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), own, new, alike(own, new), alike(own, other))
    for i, t in rows:
        out.append((i, *by_row[i if i is not None else -(2**63), mark[t]]))
    return sorted(out, key=str)


def computed(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"kept": F.lit(1), "place": F.lit("x"), "block": F.lit(0)})
    found = syncmers.edited_fingerprints(docs, **options)
    found = found.select("doc_id", "n_chars", F.sha2("edited_text", 256), "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    return sorted((tuple(row) for row in found.collect()), key=str)


def odd_texts():
    return [None, "", "a", "ab", "abcdefgh", "é" * 13, "é" * 40, "x" * 200, "ab" * 100, "word " * 50, "😀 the quick brown fox jumps over it\n" * 3]


@pytest.mark.parametrize("block_rows", [3, 10_000])
def test_against_brute_force(spark, block_rows):
    rng = random.Random(11)
    texts = odd_texts() + [sentence(rng, rng.choice([3, 30, 200])) for _ in range(20)]
    rows = [(i * 7 - 20, text) for i, text in enumerate(texts)]
    assert computed(spark, rows, block_rows=block_rows) == plain_rows(rows)


@pytest.mark.parametrize("block_rows", [4])
def test_repeated_ids_rows_and_nulls(spark, block_rows):
    rng = random.Random(12)
    rows = [(5, sentence(rng, 20)) for _ in range(30)]
    rows += [(None, "one text without an id that is long enough"), (None, None), (7, "the same row"), (9, None)]
    rows += [(7, "the same row")] * 5 + [(5, rows[0][1])] * 3 + [(-(2**63), "least")]
    assert computed(spark, rows, block_rows=block_rows) == plain_rows(rows)


def test_many_copies_of_a_row_are_dealt_out(spark):
    rows = [(1, "copy")] * 2500 + [(2, "other")]
    found = computed(spark, rows)
    assert len(found) == 2501 and len(set(map(str, found))) == 2


def test_single_row_and_empty_table(spark):
    assert computed(spark, [(1, "alone " * 20)]) == plain_rows([(1, "alone " * 20)])
    assert computed(spark, []) == []


def test_long_text_in_stretches(spark):
    text = sentence(random.Random(13), 2 * syncmers.STRETCH // 6)
    assert len(text) > syncmers.STRETCH + K
    found = syncmers.fingerprints(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(anchor) for anchor in found.anchors] == plain_anchors(text.encode())
    assert found.fingerprint == plain_fingerprint(text.encode())


def test_anchors_move_with_their_text(spark):
    text = sentence(random.Random(14), 80)
    docs = spark.createDataFrame([(1, text), (2, "in front " + text + " behind")], "doc_id long, text string")
    one, other = (row.anchors for row in syncmers.fingerprints(docs).orderBy("doc_id").collect())
    moved = {(anchor.at + len("in front "), anchor.hash) for anchor in one}
    assert moved <= {(anchor.at, anchor.hash) for anchor in other}
    assert len(one) * 10 > len(text) / WIDTH


def test_registered_query(spark):
    found = op11_closed_syncmers(spark, "/root/testdata/sf0.001")
    rows = [tuple(row) for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted((tuple(row) for row in found.select(columns).collect()), key=str) == plain_rows(rows)
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    whole = found.where("n_chars >= 1000").agg(F.avg("near_edited"), F.avg("near_next")).first()
    assert whole[0] > 0.5 and whole[1] < 0.2
