"""What several operators share: scratch tables, text bytes as arrays, hashes.

The array helpers run inside tasks. They work on one Arrow batch, cut into
pieces of a bounded number of bytes, and keep nothing between pieces.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.session import scratch_folder

PIECE_BYTES = 500_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_BASE = 0x5851F42D4C957F2D


def write_scratch(frame: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write a table into the shared folder and read it back; it outlives a lost executor."""
    spark = frame.sparkSession
    path = scratch_folder(spark, label)
    writer = frame.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def checked_broadcast(rows: DataFrame, most: int) -> DataFrame:
    """Broadcast a written table of a few numbers a row if it has at most so many; otherwise leave the join to Spark."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def crc32_mod(key, divisor: int):
    """crc32 of a key written as text, modulo a divisor; null keys count as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % F.lit(divisor)


def sample_share(rows: int, wanted: int) -> float:
    """Share of rows to take so that about ``wanted`` of ``rows`` are expected."""
    return 1.0 if rows <= wanted else wanted / rows


def hash_below(columns: list[str], share: float, seed: int):
    """A fixed choice of about that share of the rows, by a hash of the columns."""
    top = float(2**63)
    return F.xxhash64(F.lit(seed), *columns).cast("double") < F.lit(top * (2 * share - 1) if share < 1 else 2 * top)


# --- inside tasks -----------------------------------------------------------


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a fixed bijection)."""
    out = values ^ (values >> np.uint64(30))
    out *= _MIX1
    out ^= out >> np.uint64(27)
    out *= _MIX2
    out ^= out >> np.uint64(31)
    return out


_BYTE_CODES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _ODD)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``size`` of each."""
    if len(_powers[0]) < size:
        length = max(size, 1 << 16)
        inverse = pow(_BASE, -1, 1 << 64)
        for at, base in enumerate((_BASE, inverse)):
            table = np.full(length, np.uint64(base))
            table[0] = 1
            _powers[at] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


class RollingHash:
    """64-bit fingerprints of any slices of one byte array."""

    def __init__(self, data: np.ndarray):
        power, self._inverse = _power_tables(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[data] * power[: len(data)], out=self._sums[1:])

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._inverse[starts])

    def windows(self, width: int) -> np.ndarray:
        """Fingerprints of all slices of one width."""
        last = len(self._sums) - width
        return mix((self._sums[width:] - self._sums[:last]) * self._inverse[:last])


def give_back() -> None:
    """Return freed memory to the system, as workers outlive a stage and share an executor's memory with the next."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of text each, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            until = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, until - at)
            at = until
        give_back()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; a null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spaced_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """As text_bytes, with a blank after every row; offsets count the blanks."""
    data, offsets = text_bytes(column)
    sizes = np.diff(offsets)
    out = np.full(len(data) + len(sizes), 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(len(sizes)), sizes)] = data
    return out, offsets + np.arange(len(offsets))


def word_spans(is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word bytes."""
    edges = np.diff(np.concatenate(([0], is_word.view(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def unique_pairs(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value) pairs in order of row and value."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[first], values[first]


def strings(values: list) -> pa.Array:
    return pa.array(values, pa.string())
