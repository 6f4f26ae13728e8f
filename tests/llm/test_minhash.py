from __future__ import annotations

import random
import re

import numpy as np
import pytest

from rollbook.llm import minhash
from rollbook.llm.components import components
from tests.llm.fixtures import documents, empty, sentence


def sets_of(texts, width):
    out = []
    for t in texts:
        lower = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())
        words = re.findall(rb"[^\x20\x09-\x0D]+", lower)
        out.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    return out


def brute(texts, width, percent):
    sets = sets_of(texts, width)
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return {i: (len(sets[i]), root[i]) for i in range(len(texts))}


def near_family(count: int) -> list[str]:
    """Copies that drift: neighbours are near, the ends of the chain are not."""
    rng = random.Random(8)
    words = sentence(rng, 150).split()
    out = []
    for i in range(count):
        words = list(words)
        words[rng.randrange(len(words))] = f"w{i}"
        if i % 3 == 0:
            words[rng.randrange(len(words))] = f"v{i}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("width", [4, 5])
def test_against_brute_force(spark, width):
    from tests.llm.fixtures import texts

    rows = [*texts(), *near_family(40)]
    found = minhash.near_duplicates(documents(spark, rows), width).collect()
    expected = brute(rows, width, 80)
    assert len(found) == len(rows) + 2
    for r in found:
        if r["doc_id"] is None:
            assert (r["component_id"], r["kept"]) == (None, False)
        else:
            assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_blocks_of_a_family(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "BROADCAST_IDS", 1)
    rows = near_family(40)
    found = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(documents(spark, rows)).where("doc_id IS NOT NULL").collect()}
    assert found == {i: c for i, (_, c) in brute(rows, 4, 80).items()}


def test_one_id_with_several_texts(spark, monkeypatch):
    """The bounds of an id's texts do not depend on the other texts under that id; no leader finds the links before."""
    monkeypatch.setattr(minhash, "_leader_pairs", lambda members, order: members.selectExpr("node AS a", "node AS b").where("false"))
    rows = near_family(12)
    extra = [(i, " ".join(f"u{i}x{k}" for k in range(140))) for i in range(12)]
    extra += [(i, f"{t} v{i}") for i, t in extra]
    docs = spark.createDataFrame([*enumerate(rows), *extra, *extra[:3]], "doc_id long, text string").repartition(3)
    found = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs).collect()]
    assert len(found) == 39
    assert all((i, n, c) in found for i, (n, c) in brute(rows, 4, 80).items())


def test_empty(spark):
    assert minhash.near_duplicates(empty(spark)).count() == 0
    rows = minhash.near_duplicates(documents(spark, [None, "", " "])).where("doc_id IS NOT NULL").collect()
    assert all(r["n_shingles"] == 0 and r["kept"] and r["component_id"] == r["doc_id"] for r in rows)


def test_odd_sketch_estimates_differences():
    rng = np.random.default_rng(1)
    one = rng.integers(0, 2**32, (minhash.BANDS * minhash.ROWS, 200), dtype=np.uint64).astype(np.uint32)
    other = one.copy()
    other[:22] = rng.integers(0, 2**32, (22, 200))
    apart = np.bitwise_count(minhash.odd_sketch(one) ^ minhash.odd_sketch(other)).sum(axis=1)
    assert 35 < apart.mean() < 47
    assert apart.max() <= minhash.most_differing_bits(0.8)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 3), (7, 6), (7, 6)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
