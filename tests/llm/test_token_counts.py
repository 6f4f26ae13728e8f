from __future__ import annotations

import random

import regex
import tiktoken
from pyspark.sql import functions as F

from rollbook.llm import token_counts
from rollbook.sources.snapshots import Snapshots, hash_parts
from tests.llm.fixtures import documents, empty, sentence
from tests.llm.test_bpe import PATTERN, RANKS, REFERENCE

EDIT = "array<struct<start:int,stop:int,text:string>>"


def edited(text: str, edits) -> str:
    for start, stop, new in edits:
        start = min(max(start, 0), len(text))
        stop = min(max(stop, start), len(text))
        text = text[:start] + (new or "") + text[stop:]
    return text


def test_trees_follow_random_edits():
    rng = random.Random(9)
    letters = list("ab c'st12 .\n  \té中")
    split, counter = regex.compile(PATTERN).findall, token_counts._Counter(RANKS)
    for size in [0, 1, 3, 30, 400, 3000]:
        text = "".join(rng.choices(letters, k=size))
        tree = token_counts.CountTree(split(text), split, counter)
        for _ in range(40):
            start = rng.randint(-2, len(text) + 3)
            stop = start + rng.choice([0, 0, 1, 2, 9, 200])
            new = "".join(rng.choices(letters, k=rng.choice([0, 1, 2, 30, 900])))
            tree.replace(start, stop, new)
            text = edited(text, [(start, stop, new)])
            assert tree.text() == text
            assert tree.tokens == len(REFERENCE.encode_ordinary(text))


def test_an_edit_reads_few_pre_tokens_again():
    split, counter = regex.compile(PATTERN).findall, token_counts._Counter(RANKS)
    tree = token_counts.CountTree(split("word " * 20_000), split, counter)
    tree.replace(50_000, 50_003, "other")
    assert tree.reread < 40


def test_documents_with_edits(spark):
    docs = documents(spark)
    edits = spark.createDataFrame(
        [(i, s, p, q, t) for i in range(60) for s, (p, q, t) in enumerate([(5, 9, " new words"), (-4, 2, None), (10_000, 10_000, "end"), (None, 1, "x"), (3, 1, "!")])],
        "doc_id long, seq int, start int, stop int, text string",
    )
    rows = token_counts.count_tokens(token_counts.with_edits(docs, edits), RANKS, PATTERN).collect()
    assert len(rows) == docs.count()
    for r in rows:
        text = r["text"] or ""
        changes = [(e["start"], e["stop"], e["text"]) for e in r["edits"] or [] if e["start"] is not None]
        assert r["n_tokens"] == len(REFERENCE.encode_ordinary(text))
        assert r["n_tokens_edited"] == len(REFERENCE.encode_ordinary(edited(text, changes)))
        assert r["n_edits"] == len(changes)


def test_no_edits_and_no_rows(spark):
    docs = documents(spark).selectExpr("*", f"cast(null as {EDIT}) edits")
    assert all(r["n_tokens"] == r["n_tokens_edited"] and r["n_reread"] == 0 for r in token_counts.count_tokens(docs, RANKS, PATTERN).collect())
    none = empty(spark).selectExpr("*", f"cast(null as {EDIT}) edits")
    assert token_counts.count_tokens(none, RANKS, PATTERN).count() == 0
    assert isinstance(REFERENCE, tiktoken.Encoding)


def test_kept_trees_over_three_batches(spark, tmp_path):
    """Counts and texts equal those of a full recount; documents without edits are not even read."""
    rng = random.Random(12)
    words = {i: sentence(rng, rng.choice([0, 3, 40, 900])) for i in range(60)}
    docs = spark.createDataFrame([(i, t or None) for i, t in words.items()], "doc_id long, text string")
    store = Snapshots(spark, str(tmp_path), parts={"trees": hash_parts("doc_id", 16)})
    store.write("trees", token_counts.count_trees(docs, RANKS, PATTERN), "first")
    for batch in range(3):
        rows, touched = [], rng.sample(sorted(words), 3)
        for i in touched:
            for seq in range(3):
                start = rng.randint(0, len(words[i]) + 2)
                stop, new = start + rng.randint(-1, 9), rng.choice(["", "x", " two words", "é\n\n 12"])
                rows.append((i, seq, start, stop, new))
                low, high = min(start, len(words[i])), min(max(start, stop), len(words[i]))
                words[i] = words[i][:low] + new + words[i][high:]
        rows.append((10**9, 0, 0, 0, "no such document"))
        edits = spark.createDataFrame(rows, "doc_id long, seq int, start int, stop int, text string")
        parts = store.touched("trees", edits)
        trees = store.read("trees", parts=parts)
        assert len(parts) <= 4 and trees.count() < 40
        edited = token_counts.edit_trees(trees, edits, RANKS, PATTERN)
        assert sorted(r.doc_id for r in edited.select("doc_id").collect()) == sorted(touched)
        after = trees.join(edits.select("doc_id").distinct(), "doc_id", "left_anti").unionByName(edited.drop("n_reread"))
        store.write("trees", after, f"batch {batch}", parts=parts)
        assert edited.agg(F.max("n_reread")).first()[0] < 300
    found = store.read("trees").select("doc_id", "n_tokens", token_counts.text_of_tree().alias("text")).collect()
    assert {r.doc_id: r.text for r in found} == words
    whole = spark.createDataFrame(list(words.items()), "doc_id long, text string")
    again = token_counts.count_trees(whole, RANKS, PATTERN).select("doc_id", "n_tokens").collect()
    assert {r.doc_id: r.n_tokens for r in found} == {r.doc_id: r.n_tokens for r in again}
