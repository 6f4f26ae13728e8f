"""The operators that use built-in functions only: licences and decontamination."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rollbook.llm import decontaminate, licenses
from tests.llm.fixtures import documents, empty, sentence


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def dice(one, other):
    return 2 * len(one & other) / (len(one) + len(other))


def license_brute(texts):
    sets = [(name, set(licenses.bigram_set(t))) for name, t in licenses.TEMPLATES]
    out = {}
    for i, text in enumerate(texts):
        plain = re.sub("[^a-z0-9\n]+", " ", (text or "").lower())
        segments = {" ".join(s.split()) for s in [*plain.split("\n"), *re.split("\n ?\n[ \n]*", plain), plain]} - {""}
        for segment in segments:
            grams = set(licenses.bigram_set(segment))
            best = {}
            for name, template in sets:
                if dice(grams, template) >= licenses.THRESHOLD:
                    best[name] = max(best.get(name, 0), dice(grams, template))
            for name, value in best.items():
                top, count = out.get((i, name), (0, 0))
                out[i, name] = (max(top, value), count + 1)
    return out


def test_licenses_against_brute_force(spark):
    mit = next(t for n, t in licenses.TEMPLATES if len(t) > 300)
    rng = random.Random(2)
    rows = [
        None, "", "licensed", "Released under the MIT License.", "RELEASED under -- the mit license!\nReleased under the MIT License.",
        sentence(rng, 50) + "\nLicensed under CC BY-NC 4.0.\n" + sentence(rng, 30),
        "This work is licensed under the GNU General Public License, version 2.", mit.replace(" to deal", "\nto deal").replace("free of charge, ", ""),
        "a\n\n" + mit.replace("Software", "software\n") + "\n\nb", mit + " " + sentence(rng, 300), *[sentence(rng, n) for n in range(1, 30)],
    ]
    found = licenses.license_matches(documents(spark, rows))
    assert "Python" not in plan_of(found) and "Cartesian" not in plan_of(found)
    assert {(r["doc_id"], r["license_id"]): (r["dice"], r["n_segments"]) for r in found.collect()} == license_brute(rows)
    assert licenses.license_matches(empty(spark)).count() == 0


@pytest.mark.parametrize("size", [1, 2, 5, 40])
def test_size_bounds_lose_nothing(size):
    low, high = licenses.size_bounds(size, 0.8)
    for other in range(1, 200):
        reachable = 2 * min(size, other) / (size + other) >= 0.8
        assert reachable == (low <= other <= high)


def grams_of(text):
    words = [w for w in re.split(r"[^\w]+", (text or "").lower().replace("_", " ")) if w]
    grams = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
    return words, grams


def contamination_brute(texts, items):
    out = {}
    for i, text in enumerate(texts):
        _, grams = grams_of(text)
        for item, item_text in items:
            words, wanted = grams_of(item_text)
            if not wanted:
                continue
            best = None
            for start in range(len(grams)):
                one, other = Counter(grams[start : start + len(wanted)]), Counter(wanted)
                common = (one & other).total()
                either = (one | other).total()
                if 100 * common >= 80 * either and (best is None or common / either > best[0]):
                    best = (common / either, start, common, either)
            if best:
                out[i, item] = (best[1], len(words), best[2], best[3])
    return out


def test_contamination_against_brute_force(spark):
    rng = random.Random(12)
    items = [(k, sentence(rng, rng.randint(12, 60))) for k in range(12)]
    items += [(12, items[0][1]), (13, "two words"), (14, None), (15, ""), (16, "again and again and " * 8)]
    rows = [None, "", "two words", "Two, words!", "two words more"]
    for _, text in items[:12]:
        words = text.split()
        at = rng.randrange(len(words))
        rows.append(f"{sentence(rng, 30)} {text.upper()}. {sentence(rng, 10)}")
        rows.append(" ".join([*sentence(rng, 12).split(), *words[:at], "edited", *words[at + 1 :], *sentence(rng, 9).split()]))
        rows.append(" ".join([*words[:at], *words[at + 1 :]]))
        rows.append(" ".join(words[: len(words) // 2]) + " " + sentence(rng, 40))
        rows.append(" ".join(["early", *words[1:]]) + " " + sentence(rng, 3))
    rows += [f"{items[3][1]} {items[4][1]} {items[3][1]}", "again and again and " * 30, sentence(rng, 500)]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    docs = documents(spark, rows)
    found = decontaminate.contaminated(docs, bench)
    assert "Python" not in plan_of(found)
    got = {(r["doc_id"], r["item_id"]): (r["start"], r["n_words"], r["common"], r["either"]) for r in found.collect()}
    assert got == contamination_brute(rows, items)


def test_contamination_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 1)
    item = "one two three four five six seven eight nine ten"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = decontaminate.contaminated(documents(spark, [item, "no", f"x {item} y"]), bench).collect()
    assert sorted((r["doc_id"], r["start"], r["similarity"]) for r in found) == [(0, 0, 1.0), (2, 1, 1.0)]


def test_contamination_of_nothing(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(documents(spark), bench).count() == 0
    full = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert decontaminate.contaminated(empty(spark), full).count() == 0


def test_simhash_blocks_guarantee_the_radius(spark):
    """Any two fingerprints within the radius agree in a block; the blocks cover all bits."""
    one = spark.range(1).select(F.lit(-1).cast("bigint").alias("x"))
    values = one.select(decontaminate._blocks(F.col("x")).alias("b")).first()["b"]
    assert len(values) == decontaminate.RADIUS + 1
    assert sum(v["value"].bit_length() for v in values) == 64
