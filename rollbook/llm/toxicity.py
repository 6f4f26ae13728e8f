"""Toxicity scores by FTRL-proximal logistic regression over hashed word features.

Features of a text are its distinct lower-case words, word pairs and pairs with
one word skipped, hashed into ``BUCKETS`` coordinates. Every coordinate has its
own learning rate, and the L1 term leaves most weights at exactly 0, so the model
that is broadcast holds the few others. Scoring looks up all features of the whole
text and counts each weighted coordinate once.

Fitting reads a sample bounded by ``FIT_ROWS`` expected labelled texts per class
(chosen by a hash of the id, and of id and text where ids have several); FTRL passes over that sample one row after the other, in order
of a hash, in one task whose input has this bound.

Defined cases: a null or empty text has no features and gets the score of the bias
alone; null labels teach nothing; labels other than 0 count as 1; repeated labels and
repeated rows count once, and both of two labels of one document; without labelled rows every score is 0.5
less a little, so that nothing is predicted toxic. Other columns are kept; ``score``
and ``predicted`` must not be columns already.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.llm.common import RollingHash, hash_below, mix, pieces, sample_share, spaced_bytes, word_spans, write_scratch

FIT_ROWS = 5_000
BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
ALPHA, BETA, L1, L2 = 0.3, 1.0, 5.0, 0.0
PASSES = 4
BEFORE_LEARNING = -1e-6

_PAIR, _SKIP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_WORD_BYTE = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


@dataclass
class Model:
    bias: float
    buckets: np.ndarray  # sorted
    weights: np.ndarray


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and buckets of the words, the pairs, and the skip pairs of a text column."""
    data, offsets = spaced_bytes(pc.utf8_lower(column))
    starts, ends = word_spans(_WORD_BYTE[data])
    words = RollingHash(data).slices(starts, ends)
    row = np.searchsorted(offsets, starts, side="right") - 1
    shift = np.uint64(64 - BUCKET_BITS)
    yield row, (words >> shift).astype(np.int32)
    for gap, factor in ((1, _PAIR), (2, _SKIP)):
        if len(words) > gap:
            same = row[gap:] == row[:-gap]
            yield row[gap:][same], (mix(words[:-gap][same] * factor + words[gap:][same]) >> shift).astype(np.int32)


def _distinct(rows: list[np.ndarray], buckets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique(np.concatenate(rows).astype(np.int64) << BUCKET_BITS | np.concatenate(buckets))
    return keys >> BUCKET_BITS, (keys & (BUCKETS - 1)).astype(np.int32)


def _feature_rows(sample: DataFrame) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = list(features(batch.column("text")))
            rows, buckets = _distinct([r for r, _ in found], [b for _, b in found])
            offsets = np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(buckets))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("place"), lists], ["toxic", "place", "buckets"])

    return sample.select("text", "toxic", "place").mapInArrow(task, "toxic int, place long, buckets array<int>")


def _ftrl(rows: list[tuple[int, np.ndarray]]) -> tuple[float, np.ndarray, np.ndarray]:
    """One row after the other; the bias is the coordinate after the last and has no L1."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        penalty = np.where(at == BUCKETS, 0.0, L1)
        shrunk = np.sign(z[at]) * penalty - z[at]
        return np.where(np.abs(z[at]) > penalty, shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0.0)

    for _ in range(PASSES):
        for label, buckets in rows:
            at = np.append(buckets, BUCKETS)
            w = weights(at)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            rate = (np.sqrt(n[at] + gradient * gradient) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - rate * w
            n[at] += gradient * gradient
    w = weights(np.arange(BUCKETS + 1))
    kept = np.flatnonzero(w[:-1])
    return float(w[-1]), kept, w[kept]


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", seed: int = 5) -> Model:
    """Learn ``toxic`` of the label rows from the texts with the same key.

    The chosen labels, 2 * FIT_ROWS distinct ones expected, are broadcast to the texts.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("key"), (F.col("toxic") != 0).cast("int").alias("toxic")
    )
    known = write_scratch(known.distinct(), "labels")
    counts = {r["toxic"]: r["rows"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("rows")).collect()}
    if not counts:
        return Model(BEFORE_LEARNING, np.zeros(0, np.int64), np.zeros(0))
    chosen = F.lit(False)
    for toxic, rows in counts.items():
        chosen = chosen | ((F.col("toxic") == toxic) & hash_below(["key"], sample_share(rows, FIT_ROWS), seed))
    texts = docs.select(F.col(key).alias("key"), F.col("text").cast("string").alias("text")).withColumn("mark", F.xxhash64("text"))
    labelled = texts.join(F.broadcast(known.where(chosen)), "key")
    # An id may have very many texts: the chosen rows are counted once more, each text of an id by itself.
    named = write_scratch(labelled.select("key", "mark", "toxic").distinct(), "labelled")
    found = {r["toxic"]: r["rows"] for r in named.groupBy("toxic").agg(F.count(F.lit(1)).alias("rows")).collect()}
    taken = F.lit(False)
    for toxic, rows in found.items():
        taken = taken | ((F.col("toxic") == toxic) & hash_below(["key", "mark"], sample_share(rows, FIT_ROWS), seed + 2))
    once = labelled.where(taken).groupBy("key", "mark", "toxic").agg(F.min("text").alias("text"))
    sample = once.withColumn("place", F.xxhash64(F.lit(seed + 1), "key", "mark"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            flat, ends = batch.column("buckets").flatten().to_numpy(), batch.column("buckets").offsets.to_numpy()
            ends = ends - ends[0]
            for i, (label, place) in enumerate(zip(batch.column("toxic").to_pylist(), batch.column("place").to_pylist(), strict=True)):
                rows.append((place, label, flat[ends[i] : ends[i + 1]]))
        rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
        bias, kept, weights = _ftrl([(label, buckets) for _, label, buckets in rows])
        yield pa.RecordBatch.from_arrays(
            [pa.array([BUCKETS, *kept.tolist()], pa.int32()), pa.array([bias, *weights.tolist()], pa.float64())], ["bucket", "weight"]
        )

    learned = _feature_rows(sample).repartition(1).mapInArrow(task, "bucket int, weight double").collect()
    bias = next((r["weight"] for r in learned if r["bucket"] == BUCKETS), 0.0)
    rest = sorted((r["bucket"], r["weight"]) for r in learned if r["bucket"] != BUCKETS)
    return Model(bias or BEFORE_LEARNING, np.array([b for b, _ in rest], np.int64), np.array([w for _, w in rest]))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Add score (0 to 1) and predicted (1 if score >= 0.5) to every row. No shuffle."""
    if clash := {"score", "predicted"} & set(docs.columns):
        raise ValueError(f"the rows have columns {sorted(clash)} already")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        known = np.zeros(BUCKETS, bool)
        known[model.buckets] = True
        for batch in pieces(batches):
            rows, buckets = [], []
            for row, bucket in features(batch.column("text")):
                hit = known[bucket]
                rows.append(row[hit])
                buckets.append(bucket[hit])
            row, bucket = _distinct(rows, buckets)
            weight = model.weights[np.searchsorted(model.buckets, bucket)] if len(bucket) else np.zeros(0)
            margin = model.bias + np.bincount(row, weight, minlength=batch.num_rows)
            score = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                [*batch.schema.names, "score", "predicted"],
            )

    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return docs.mapInArrow(task, T.StructType([*docs.schema.fields, *added]))
