from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollbook.llm import suffix_dedup
from tests.llm.fixtures import documents, empty, sentence

LENGTH = suffix_dedup.LENGTH


def brute(texts: list[bytes]) -> list[tuple[int, int, int, str]]:
    starts = Counter(t[i : i + LENGTH] for t in texts for i in range(len(t) - LENGTH + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - LENGTH + 1):
            if starts[t[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = True
        spans = int(np.sum(np.diff(np.concatenate(([0], gone.astype(int)))) == 1))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(docs, batches):
    rows = docs.select("doc_id", "text").collect()
    expected = brute([(r["text"] or "").encode() for r in rows])
    found = suffix_dedup.remove_repeats(docs, batches)
    made = found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("sha")).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, *e) for r, e in zip(rows, expected, strict=True)) == sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, *r[1:]) for r in made
    )
    return sum(e[1] for e in expected)


def overlapping() -> list[str]:
    """Texts made of a few pieces in many orders, so that matches begin and end anywhere."""
    rng = random.Random(5)
    pool = [sentence(rng, rng.randint(8, 50)) for _ in range(12)]
    return [sentence(rng, 5) + "".join(rng.choices(pool, k=rng.randint(1, 6))) + sentence(rng, 4) for _ in range(60)]


@pytest.mark.parametrize("batches", [1, 5])
def test_against_brute_force(spark, batches):
    assert check(documents(spark), batches) > 1000


def test_matches_that_begin_and_end_anywhere(spark):
    assert check(documents(spark, overlapping()), 3) > 5000


def test_periodic_text(spark):
    check(documents(spark, ["abc" * 200, "abcab" * 90, "z" * 199, "y" * 200, "y" * 201, "q" * 399]), 2)


def test_empty_tables(spark):
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0
    assert suffix_dedup.remove_repeats(documents(spark, ["short", None])).where("n_removed > 0").count() == 0


def test_whole_characters(spark):
    shared = "né" * 130
    docs = documents(spark, [f"a {shared} ü", f"b {shared} ö"])
    rows = suffix_dedup.remove_repeats(docs, as_text=True).where("doc_id < 2").collect()
    assert all("�" not in r["kept_text"] and len(r["kept_text"]) < 10 for r in rows)


def test_columns_are_kept_and_clashes_refused(spark):
    docs = documents(spark)
    assert suffix_dedup.remove_repeats(docs).columns[: len(docs.columns)] == docs.columns
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(docs.withColumn("n_bytes", F.lit(1)))


def test_levels_merge_geometrically(spark):
    family = suffix_dedup.SuffixLevels()
    ranks = []
    for batch in range(7):
        rows = spark.range(batch * 10, batch * 10 + 11).withColumnRenamed("id", "suffix")
        hits = {r["suffix"] for r in family.add(rows).collect()}
        assert hits == ({batch * 10} if batch else set())
        ranks.append([rank for rank, _ in family.levels])
    assert ranks == [[0], [0, 0], [1, 0], [1, 0, 0], [2, 0], [2, 0, 0], [2, 1, 0]]


def test_suffixes_of_very_many_blocks(spark, monkeypatch):
    """Beyond the bound the windows are compared one by one, with the same result."""
    monkeypatch.setattr(suffix_dedup, "MOST_KINDS", 2)
    assert check(documents(spark, overlapping()), 3) > 5000


def test_equal_rows_grow_as_their_number(spark):
    """Four hundred equal rows give no more spans to each than four do."""
    text = sentence(random.Random(8), 300)

    def spans(count):
        docs = spark.createDataFrame([(1, text)] * count + [(2, "other " + text[:900])], "doc_id long, text string").repartition(3)
        keyed = suffix_dedup._keyed(docs)
        return suffix_dedup.repeated_spans(keyed, 2).where("suffix_id = 1").select(F.size("spans")).collect()

    assert spans(4) == spans(400)
    assert check(spark.createDataFrame([(1, text)] * 400, "doc_id long, text string"), 2) == 400 * len(text.encode())


def test_levels_merge_by_size(spark, monkeypatch):
    """The number of batches follows the bytes of the table, and equal levels merge."""
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 3_000)
    ranks = []
    settle = suffix_dedup.SuffixLevels._settle
    monkeypatch.setattr(suffix_dedup.SuffixLevels, "_settle", lambda self: settle(self) or ranks.append([rank for rank, _ in self.levels]))
    docs = documents(spark, overlapping())
    check(docs, None)
    assert len(ranks) == suffix_dedup._batch_count(docs) > 4
    assert max(rank for levels in ranks for rank in levels) >= 2 and all(len(set(levels)) == len(levels) for levels in ranks)
