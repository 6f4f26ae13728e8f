"""Periodic runs of words, by uniting suffixes in order of falling common prefixes.

A run is a stretch of words with smallest period ``q`` that no neighbouring word extends,
of at least ``max(LEAST_WORDS, LEAST_TIMES * q)`` words. The suffixes of a text that begin
with the same words are a class. Kruskal's way, neighbours in the suffix array are united
by falling length of their common prefix; each class is a sorted set of positions, and
the smaller goes into the larger. Two positions that become neighbours in a united set at
a distance ``d`` begin equal for exactly the current length ``l``, so period ``d`` holds
for ``d + l`` words from the first: a seed of the run that ends there. The first position of
a run and the one a period later always meet this way, so the least seed with that end
and period is the run's start. A distance that is a multiple of the smallest period is
never seeded, as the position in between is in the set already.

Only prefixes of ``LEAST_PREFIX`` words and more can seed a run that is long enough, so
texts whose words repeat less are left after that check, and of the others only such
prefixes are united.

Each text is worked on for itself, in its task: memory is about 300 bytes a word of the
longest text plus 4 bytes a word for each doubling of its longest repeat.

Defined cases: a null text and one without words have no run, and what is left of them is
the empty text; equal rows get equal results; an empty table gives no rows. Words are
``[^\\x20\\x09-\\x0D]+`` and compared by their bytes. Other columns are kept; the columns
added must not be there already.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rollbook.llm.common import pieces

LEAST_WORDS, LEAST_TIMES = 6, 4
#: The common prefix of a run's start and the place a period later is its length less the period.
LEAST_PREFIX = min(max(LEAST_WORDS, LEAST_TIMES * q) - q for q in range(1, LEAST_WORDS + 1))

RUNS = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))

Run = tuple[int, int, int]


def _joined(ranks: np.ndarray, by: int) -> np.ndarray:
    """Ranks of prefixes twice as long (of ``by`` words more); what ends with the text comes first."""
    ahead = np.zeros(len(ranks), np.int64)
    ahead[: len(ranks) - by] = ranks[by:] + 1
    return np.unique(ranks.astype(np.int64) * (len(ranks) + 1) + ahead, return_inverse=True)[1].astype(np.int32)


def suffix_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and the length of the common prefix of each suffix with the one before.

    Equal ranks are equal prefixes of full length: shorter ones end with the text, and no
    two of those are equally long.
    """
    levels = [np.unique(words, return_inverse=True)[1].astype(np.int32)]
    while levels[-1].max() < len(words) - 1:
        levels.append(_joined(levels[-1], 1 << (len(levels) - 1)))
    order = np.argsort(levels[-1], kind="stable")
    one, other, prefix = order[:-1].copy(), order[1:].copy(), np.zeros(len(order), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        ranks = levels.pop()
        same = (one < len(words)) & (other < len(words))
        same[same] = ranks[one[same]] == ranks[other[same]]
        prefix[1:][same] += 1 << level
        one[same] += 1 << level
        other[same] += 1 << level
    return order, prefix


def _repeats(words: np.ndarray) -> bool:
    """Whether any LEAST_PREFIX words occur twice."""
    if len(words) < LEAST_PREFIX + 1:
        return False
    if len(np.unique(words)) == len(words):
        return False
    keys, base = words, len(words) + 1
    for by in range(1, LEAST_PREFIX):
        keys = np.unique(keys[:-1] * base + words[by:], return_inverse=True)[1]
        if keys.max() == len(keys) - 1:
            return False
    return True


class _Classes:
    """Suffix classes: union-find with the sorted positions of each class."""

    def __init__(self, order: list[int]):
        self.parent = list(range(len(order)))
        self.positions = [[place] for place in order]

    def find(self, at: int) -> int:
        parent = self.parent
        while parent[at] != at:
            parent[at] = parent[parent[at]]
            at = parent[at]
        return at

    def unite(self, a: int, b: int) -> list[tuple[int, int]]:
        """Unite two classes; returns the neighbours that are new, as (position, next)."""
        a, b = self.find(a), self.find(b)
        large, small = self.positions[a], self.positions[b]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        self.parent[b] = a
        self.positions[b] = []
        new = []
        if 16 * len(small) > len(large):
            of_small = set(small)
            large += small
            large.sort()
            last, last_small = large[0], large[0] in of_small
            for place in large[1:]:
                is_small = place in of_small
                if is_small != last_small:
                    new.append((last, place))
                last, last_small = place, is_small
            return new
        for i, place in enumerate(small):
            at = bisect_left(large, place)
            if at and (i == 0 or small[i - 1] < large[at - 1]):
                new.append((large[at - 1], place))
            if at < len(large) and (i + 1 == len(small) or small[i + 1] > large[at]):
                new.append((place, large[at]))
        for place in small:
            insort(large, place)
        return new


def runs_of(words: np.ndarray) -> list[Run]:
    """All runs (start, length, period) of a list of word numbers, by start and period."""
    if not _repeats(words):
        return []
    order, prefix = suffix_order(words)
    edges = np.flatnonzero(prefix >= LEAST_PREFIX)
    # Only what these edges touch is held in classes.
    touched = np.union1d(edges, edges - 1)
    number = np.searchsorted(touched, edges)
    falling = np.argsort(-prefix[edges], kind="stable")
    classes = _Classes(order[touched].tolist())
    starts: dict[tuple[int, int], int] = {}
    for at, length in zip(number[falling].tolist(), prefix[edges][falling].tolist(), strict=True):
        for place, after in classes.unite(at - 1, at):
            period = after - place
            if period + length >= max(LEAST_WORDS, LEAST_TIMES * period):
                end = after + length
                known = starts.get((end, period))
                if known is None or place < known:
                    starts[end, period] = place
    return sorted((start, end - start, period) for (end, period), start in starts.items())


def kept_words(size: int, runs: list[Run]) -> np.ndarray | None:
    """False for the words of a run behind its first period; None if there is no run."""
    if not runs:
        return None
    cover = np.zeros(size + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return np.cumsum(cover[:-1]) == 0


def _of_text(text: bytes | None) -> tuple[int, list[Run], bytes]:
    words = (text or b"").split()
    numbers: dict[bytes, int] = {}
    runs = runs_of(np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64))
    keep = kept_words(len(words), runs)
    left = words if keep is None else [words[at] for at in np.flatnonzero(keep).tolist()]
    return len(words), runs, b" ".join(left)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``text``) with ``n_words``, ``runs`` (start, length, period) and ``collapsed_text``.

    The collapsed text has the words of which no run holds an earlier period, joined by blanks.
    """
    added = [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed_text", T.StringType())]
    if clash := {field.name for field in added} & set(docs.columns):
        raise ValueError(f"the rows have columns {sorted(clash)} already")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = [_of_text(text) for text in piece.column("text").cast(pa.large_binary()).to_pylist()]
            sizes = np.concatenate(([0], np.cumsum([len(runs) for _, runs, _ in found], dtype=np.int64)))
            flat = np.array([run for _, runs, _ in found for run in runs], np.int64).reshape(-1, 3)
            fields = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(kind.value_type))
            yield pa.RecordBatch.from_arrays(
                [
                    *piece.columns,
                    pa.array([size for size, _, _ in found], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(sizes.astype(np.int32)), fields),
                    pa.array([left for _, _, left in found], pa.binary()).cast(pa.string()),
                ],
                [*piece.schema.names, *(field.name for field in added)],
            )

    return docs.mapInArrow(task, T.StructType([*docs.schema.fields, *added]))
