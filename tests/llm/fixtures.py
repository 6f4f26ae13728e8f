"""Small tables that hold what is awkward: nulls, empty and long texts, copies, repeated rows."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, toxic string"


def sentence(rng: random.Random, words: int) -> str:
    parts = ["an", "the", "tion", "er", "ou", "ha", "ing", "re", "é", "sh", "on", "ti"]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(words))


def texts(seed: int = 1) -> list[str | None]:
    rng = random.Random(seed)
    base = sentence(rng, 90)
    passage = sentence(rng, 70)
    near = base.split()
    near[40] = "changed"
    out: list[str | None] = [None, "", " \n\t ", "one", "Two Words", "two words", base, base, " ".join(near), base.upper()]
    out += [f"{sentence(rng, 20)} {passage}\n{sentence(rng, 15)}" for _ in range(4)]
    out += ["ab" * 300, "x" * 500, sentence(rng, 4000), "日本語のテキスト。" * 40]
    out += [sentence(rng, rng.randint(1, 120)) for _ in range(30)]
    return out


def documents(spark, rows: list[str | None] | None = None):
    """The texts under ids from 0, a null id and a repeated row; one column has a name that operators use."""
    rows = texts() if rows is None else rows
    table = [(i, t, "en", "s", None if t is None else len(t), "x") for i, t in enumerate(rows)]
    if table:
        table += [(None, "a text of its own without an id", None, None, None, None), table[-1]]
    return spark.createDataFrame(table, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
