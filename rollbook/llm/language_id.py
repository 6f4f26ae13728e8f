"""Language identification with error-correcting output codes.

Every language gets a codeword. One binary classifier per code bit says on which
side of that bit a text's language lies: its weights are log ratios of byte n-gram
frequencies of the two sides, each language counting alike. A text gets the mean
weight of all its n-grams per bit; decoding picks the codeword with the least sum
of logistic losses, each bit weighted by how well its classifier did on sampled
texts. A small lead over the second codeword flags the answer as ambiguous.

Fitting reads a sample bounded by ``FIT_ROWS`` expected rows per language (rows
chosen by a hash of their text); the weights have ``BUCKETS`` rows and one column
per bit, whatever the size of the input.

Defined cases: a null text or one without letters is ``und`` with score 0 and not
ambiguous, as is every text if no language was learned; rows with a null language
teach nothing; with one language learned, every text with letters gets it with
score 1; equal texts get equal answers; equal losses go to the first language by
name. Other columns are kept; ``lang_pred``, ``score`` and ``ambiguous`` must not
be columns already.
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

from rollbook.llm.common import hash_below, pieces, sample_share, strings, text_bytes

FIT_ROWS = 4_000
ORDERS = (2, 3, 4)
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
SMOOTHING = 0.5
SHARPNESS = 6.0
AMBIGUOUS_LEAD = 0.5
UNDETERMINED = "und"
PIECE = 1_000_000


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray  # languages x bits, -1 or 1
    weights: np.ndarray  # buckets x bits
    trust: np.ndarray  # one weight per bit


def codewords(count: int, seed: int = 7) -> np.ndarray:
    """One row of -1 and 1 per language. Up to 7 languages get all different splits,
    more get the best of some random codes by smallest distance between rows."""
    if count <= 7:
        splits = range(1, 1 << max(0, count - 1))
        # Bit 0 belongs to the last language, which is always -1: no split comes twice.
        columns = [[1 if split >> (count - 2 - k) & 1 else -1 for k in range(count - 1)] + [-1] for split in splits]
        return np.array(columns, np.int8).reshape(len(columns), count).T
    rng = np.random.default_rng(seed)
    bits = int(np.ceil(10 * np.log2(count)))
    best, distance = None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.int8), (count, bits)).astype(np.int32)
        gap = int(((bits - code @ code.T) // 2 + bits * np.eye(count, dtype=int)).min())
        if gap > distance:
            best, distance = code.astype(np.int8), gap
    return best


#: Bytes for n-grams: letters as they are, everything else of ASCII is a blank.
_LETTERS = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)


def gram_buckets(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The row and the bucket of every n-gram within the rows of a text column, in blocks of one order."""
    data, offsets = text_bytes(pc.utf8_lower(column))
    data = _LETTERS[data].astype(np.uint32)
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    for order in ORDERS:
        for low in range(0, len(data) - order + 1, PIECE):
            part, near = data[low : low + PIECE + order - 1], row[low : low + PIECE + order - 1]
            code = part[: len(part) - order + 1].copy()
            for k in range(1, order):
                code |= part[k : len(part) - order + 1 + k] << np.uint32(8 * k)
            code = (code * np.uint32(0x9E3779B1) + np.uint32(order * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35)
            bucket = code >> np.uint32(32 - BUCKET_BITS)
            inside = near[: len(bucket)] == near[order - 1 :]
            yield near[: len(bucket)][inside], bucket[inside].astype(np.int32)


def _margins(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Mean weight per row and bit."""
    sums = np.zeros((len(column), weights.shape[1]))
    counts = np.zeros(len(column))
    for rows, buckets in gram_buckets(column):
        if not len(rows):
            continue
        found = weights[buckets]
        starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        sums[rows[starts]] += np.add.reduceat(found, starts, axis=0, dtype=np.float64)
        counts += np.bincount(rows, minlength=len(column))
    return sums / np.maximum(counts, 1)[:, None]


def _sample(train: DataFrame, seed: int) -> DataFrame:
    """About FIT_ROWS rows per language, chosen by a hash; the languages' counts come to the driver."""
    known = train.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["rows"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).collect()}
    if not counts:
        return known.select("lang", "text")
    whole = [lang for lang, rows in counts.items() if rows <= FIT_ROWS]
    chosen = F.col("lang").isin(whole) if whole else F.lit(False)
    for lang, rows in counts.items():
        if rows > FIT_ROWS:
            share = sample_share(rows, FIT_ROWS)
            chosen = chosen | ((F.col("lang") == F.lit(lang)) & hash_below(train.columns, share, seed))
    return known.where(chosen).select("lang", "text")


def _gram_counts(sample: DataFrame) -> DataFrame:
    """(lang, bucket, n) summed within tasks before the shuffle."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in pieces(batches, "text", PIECE):
            langs = np.array(batch.column("lang").to_pylist(), object)
            for rows, buckets in gram_buckets(batch.column("text")):
                of_gram = langs[rows]
                for lang in set(langs):
                    sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    sums[lang] += np.bincount(buckets[of_gram == lang], minlength=BUCKETS)
        for lang, n in sums.items():
            full = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [strings([lang] * len(full)), pa.array(full.astype(np.int32)), pa.array(n[full])], ["lang", "bucket", "n"]
            )

    return sample.mapInArrow(task, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(train: DataFrame, seed: int = 11) -> Model:
    """Learn from the columns text and lang. Counts come to the driver: BUCKETS per language at most."""
    sample = _sample(train, seed)
    counts = _gram_counts(sample).toPandas()
    langs = sorted(counts["lang"].unique().tolist())
    code = codewords(len(langs))
    table = np.zeros((len(langs), BUCKETS))
    if langs:
        table[counts["lang"].map({k: i for i, k in enumerate(langs)}), counts["bucket"]] = counts["n"]
    share = (table + SMOOTHING) / (table.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    weights = np.zeros((BUCKETS, code.shape[1] if langs else 0), np.float32)
    for bit in range(weights.shape[1]):
        weights[:, bit] = np.log(share[code[:, bit] > 0].mean(axis=0) / share[code[:, bit] < 0].mean(axis=0))
    model = Model(langs, code, weights, np.ones(weights.shape[1]))
    if weights.shape[1]:
        model.trust = _trust(sample, model)
    return model


def _trust(sample: DataFrame, model: Model) -> np.ndarray:
    """Per bit, how much more often than a coin its classifier is right on the sample."""
    sent = sample.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        row_of = {lang: at for at, lang in enumerate(model.langs)}
        right, rows = np.zeros(model.code.shape[1], np.int64), 0
        for batch in pieces(batches, "text", PIECE):
            code = model.code[[row_of.get(x, 0) for x in batch.column("lang").to_pylist()]]
            right += ((_margins(batch.column("text"), model.weights) > 0) == (code > 0)).sum(axis=0)
            rows += batch.num_rows
        bits = np.arange(len(right), dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(bits), pa.array(right), pa.array(np.full(len(bits), rows))], ["bit", "n", "rows"])

    found = sample.mapInArrow(task, "bit int, n long, rows long").groupBy("bit").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"))
    trust = np.ones(model.code.shape[1])
    for r in found.collect():
        trust[r["bit"]] = max(0.05, 2 * r["n"] / max(1, r["rows"]) - 1)
    return trust


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: the nearest codeword, its share of the softmax, and whether its lead is small."""
    loss = np.zeros((len(margins), len(model.langs)))
    for k in range(len(model.langs)):
        loss[:, k] = (np.logaddexp(0, -SHARPNESS * margins * model.code[k]) * model.trust).sum(axis=1)
    best = loss.argmin(axis=1)
    share = np.exp(loss.min(axis=1, keepdims=True) - loss)
    score = 1 / share.sum(axis=1)
    if len(model.langs) < 2:
        return best, score, np.zeros(len(best), bool)
    two = np.partition(loss, 1, axis=1)
    return best, score, two[:, 1] - two[:, 0] < AMBIGUOUS_LEAD


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Add lang_pred, score (0 to 1) and ambiguous to every row. No shuffle."""
    if clash := {"lang_pred", "score", "ambiguous"} & set(docs.columns):
        raise ValueError(f"the rows have columns {sorted(clash)} already")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in pieces(batches, "text", PIECE):
            text = batch.column("text")
            letters = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            if not model.langs:
                letters = np.zeros(batch.num_rows, bool)
                best, score, close = np.zeros(batch.num_rows, int), np.zeros(batch.num_rows), letters
            else:
                best, score, close = decode(model, _margins(text, model.weights))
            names = [model.langs[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), letters.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, strings(names), pa.array(np.where(letters, score, 0.0)), pa.array(letters & close)],
                [*batch.schema.names, "lang_pred", "score", "ambiguous"],
            )

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    return docs.mapInArrow(task, T.StructType([*docs.schema.fields, *added]))
