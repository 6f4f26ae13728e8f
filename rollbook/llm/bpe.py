"""Byte-level BPE encoding and decoding by replaying the merges over a corpus.

Every task takes its slice of the texts as one corpus: the distinct pre-tokens
are laid out as one row of symbols, and an index from the rank of a symbol pair
to the positions of that pair is kept. The merges are applied in rank order, each
to all its positions at once; only the two neighbours of a merged pair get new
index entries. Pre-tokens do not interact, so a slice gives the same ids as the
whole corpus would, and no text is shuffled.

Defined cases: a null text is the empty text and has no ids; rows with equal text
have equal ids; an empty table stays empty; other columns are kept, and a column
that has the name of the new one is an error. Bytes that aren't UTF-8 are read as
U+FFFD.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rollbook.llm.common import give_back, pieces, text_bytes

Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

NONE = np.int32(2**31 - 1)
#: Distinct units that a task remembers; beyond it the memory starts anew.
MEMORY = 200_000
#: Ids that decoding lays out at once.
DECODE_IDS = 200_000
#: Bytes of text that one replay takes.
CHUNK_BYTES = 1_500_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: one base64 text and one number per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """The pairs of symbols that a vocabulary joins, for looking up many at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self._keys = np.array(sorted(pairs), np.int64)
        self._ranks = np.array([pairs[k] for k in self._keys.tolist()], np.int32)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the joined pairs; NONE where there is no such token or a side is a border."""
        if not len(self._keys):
            return np.full(len(left), NONE, np.int32)
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where((self._keys[at] == keys) & (right >= 0), self._ranks[at], NONE)

    def encode_one(self, word: bytes) -> list[int]:
        """The plain definition, one merge after the other."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            ranked = [self.ranks.get(a + b, NONE) for a, b in zip(parts, parts[1:], strict=False)]
            least = min(ranked)
            if least == NONE:
                break
            at = ranked.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]


def replay(merges: Merges, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in a row, and the offsets of each word's ids."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    # One border before the first word and one after each word.
    place = np.arange(len(data)) + np.repeat(np.arange(len(words)), sizes) + 1
    total = len(data) + len(words) + 1
    symbol = np.full(total, -1, np.int32)
    symbol[place] = merges.of_byte[data]
    after = np.arange(1, total + 1)
    before = np.arange(-1, total - 1)
    pair = np.full(total, NONE, np.int32)
    pair[:-1] = merges.rank_of(symbol[:-1], symbol[1:])
    odd_places: list[np.ndarray] = []

    waiting: dict[int, list[np.ndarray]] = {}

    def index(places: np.ndarray) -> None:
        found = pair[places]
        places = places[found != NONE]
        found = found[found != NONE]
        if not len(places):
            return
        order = np.argsort(found, kind="stable")
        places, found = places[order], found[order]
        cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
        for rank, start, end in zip(
            found[np.concatenate(([0], cuts))].tolist(), [0, *cuts.tolist()], [*cuts.tolist(), len(found)], strict=True
        ):
            if rank in waiting:
                waiting[rank].append(places[start:end])
            else:
                waiting[rank] = [places[start:end]]
                heapq.heappush(heap, rank)

    heap: list[int] = []
    index(np.arange(total))
    while heap:
        rank = heapq.heappop(heap)
        lists = waiting.pop(rank)
        at = lists[0] if len(lists) == 1 else np.concatenate(lists)
        at = at[pair[at] == rank]
        if len(at) > 1:
            at = np.sort(at)
            at = at[np.concatenate(([True], at[1:] != at[:-1]))]
            chained = np.concatenate(([False], after[at[:-1]] == at[1:]))
            if chained.any():  # of a run of overlapping pairs, every other one is free
                number = np.arange(len(at))
                start = np.maximum.accumulate(np.where(chained, 0, number))
                at = at[(number - start) % 2 == 0]
        if not len(at):
            continue
        gone = after[at]
        beyond = after[gone]
        symbol[at] = rank
        symbol[gone] = -2
        pair[gone] = NONE
        after[at] = beyond
        before[beyond] = at
        left = before[at]
        touched = np.concatenate((left, at))
        pair[touched] = new = merges.rank_of(symbol[touched], symbol[after[touched]])
        if (early := new < rank).any():
            odd_places.append(touched[early])
        index(touched)
    kept = symbol >= 0
    word_of = np.cumsum(symbol == -1) - 1
    counts = np.bincount(word_of[kept], minlength=len(words))[: len(words)]
    ids = symbol[kept]
    offsets = np.concatenate(([0], np.cumsum(counts)))
    # Whole words that are tokens stay whole even where no merge leads to them, and
    # a pair that ranks before the merge which made it is left to the definition.
    special = {w: [merges.ranks[words[w]]] for w in np.flatnonzero(counts > 1).tolist() if words[w] in merges.ranks}
    for w in np.unique(word_of[np.concatenate(odd_places)]).tolist() if odd_places else ():
        special.setdefault(w, merges.encode_one(words[w]))
    if special:
        lists = [special.get(w, ids[offsets[w] : offsets[w + 1]]) for w in range(len(words))]
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
        ids = np.concatenate(lists).astype(np.int32)
    return ids, offsets


class Encoder:
    """Encodes texts unit by unit and remembers a bounded number of units.

    A unit is what stands between two blanks, with the blank before it. The
    pattern must not match a blank after another character of the same
    pre-token, unless all of them are white space; then no pre-token crosses a
    unit's start, and equal units have equal ids. Texts with a blank after other
    white space are one unit. ``by_blanks=False`` lifts the condition.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, memory: int = MEMORY, by_blanks: bool = True):
        import regex

        self._split = regex.compile(pattern).findall
        self._bound = regex.compile(r"\s ").search if by_blanks else None
        self._merges = Merges(ranks)
        self._memory = memory
        self._forget()

    def _forget(self) -> None:
        self._number: dict[str | tuple[str], int] = {}
        self._ids = np.zeros(0, np.int32)
        self._offsets = np.zeros(1, np.int64)

    def units(self, text: str) -> list[str | tuple[str]]:
        """Names of a text's units: a tuple stands for a text as it is, a string for one after a blank."""
        if self._bound is None or self._bound(text):
            return [(text,)]
        first, *rest = text.split(" ")
        return [(first,), *rest]

    def _learn(self, units: list[str | tuple[str]]) -> None:
        if not units:
            return
        words: list[str] = []
        ends = [0]
        for unit in units:
            words += self._split(f" {unit}" if isinstance(unit, str) else unit[0])
            ends.append(len(words))
            self._number[unit] = len(self._number)
        place = {w: at for at, w in enumerate(dict.fromkeys(words))}
        ids, offsets = replay(self._merges, [w.encode("utf-8", "replace") for w in place])
        at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        sizes = offsets[at + 1] - offsets[at]
        sums = np.concatenate(([0], np.cumsum(sizes)))
        self._ids = np.concatenate((self._ids, ranges(ids, offsets[at], sizes)))
        self._offsets = np.concatenate((self._offsets, sums[ends][1:] + self._offsets[-1]))

    def learn(self, texts: list[str]) -> None:
        """Encode the units of the texts that aren't known yet, all in one replay."""
        if len(self._number) > self._memory:
            self._forget()
        new: set[str | tuple[str]] = set()
        for text in texts:
            new.update(self.units(text))
        self._learn([u for u in new if u not in self._number])

    def numbers(self, units: list[str | tuple[str]]) -> np.ndarray:
        """A number for each learned unit, for ``lengths`` and ``gather`` until more is learned."""
        return np.fromiter(map(self._number.__getitem__, units), np.int64, len(units))

    def lengths(self, numbers: np.ndarray) -> np.ndarray:
        return self._offsets[numbers + 1] - self._offsets[numbers]

    def gather(self, numbers: np.ndarray) -> np.ndarray:
        return ranges(self._ids, self._offsets[numbers], self.lengths(numbers))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the offsets of each text's ids."""
        self.learn(texts)
        found = [self.numbers(self.units(text)) for text in texts]
        ends = np.concatenate(([0], np.cumsum([len(x) for x in found], dtype=np.int64)))
        numbers = np.concatenate([np.zeros(0, np.int64), *found])
        sums = np.concatenate(([0], np.cumsum(self.lengths(numbers))))
        return self.gather(numbers), sums[ends]


def ranges(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Slices of an array, one after the other."""
    ends = np.cumsum(sizes)
    shift = starts - (ends - sizes)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(shift, sizes)]


def texts_of(column: pa.Array) -> list[str]:
    data, offsets = text_bytes(column)
    raw = data.tobytes()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def _with_column(rows: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    if name in rows.columns:
        raise ValueError(f"the rows have a column {name} already")
    return T.StructType([*rows.schema.fields, T.StructField(name, kind)])


def _encoding(sent: Broadcast, pattern: str, text: str, into: str) -> Task:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in pieces(batches, text, CHUNK_BYTES):
            encoder = encoder or Encoder(sent.value, pattern)
            ids, offsets = encoder.encode(texts_of(batch.column(text)))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, into])

    return task


def _decoding(sent: Broadcast, ids: str, into: str) -> Task:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            table = table or _token_table(sent.value)
            yield from (_decoded(part, table, ids, into) for part in _parts(batch, ids))
            give_back()

    return task


def encode(rows: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """Add the token ids of a text column. The vocabulary is broadcast: its size is that of its file."""
    sent = rows.sparkSession.sparkContext.broadcast(ranks)
    return rows.mapInArrow(_encoding(sent, pattern, text, into), _with_column(rows, into, T.ArrayType(T.IntegerType())))


def decode(rows: DataFrame, ranks: dict[bytes, int], ids: str = "ids", into: str = "bytes") -> DataFrame:
    """Add the bytes that a column of token ids stands for; a null or empty list gives no bytes.

    An id that the vocabulary lacks is an error.
    """
    sent = rows.sparkSession.sparkContext.broadcast(ranks)
    return rows.mapInArrow(_decoding(sent, ids, into), _with_column(rows, into, T.BinaryType()))


def round_trip(rows: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids", into: str = "bytes") -> DataFrame:
    """``decode`` of ``encode`` in one Python worker a task instead of two, which Spark keeps for later stages."""
    sent = rows.sparkSession.sparkContext.broadcast(ranks)
    encoding, decoding = _encoding(sent, pattern, text, ids), _decoding(sent, ids, into)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return decoding(encoding(batches))

    if ids == into:
        raise ValueError(f"both new columns are named {ids}")
    kinds = [*_with_column(rows, ids, T.ArrayType(T.IntegerType())), *_with_column(rows, into, T.BinaryType())[-1:]]
    return rows.mapInArrow(task, T.StructType(kinds))


def _parts(batch: pa.RecordBatch, ids: str, most: int = DECODE_IDS) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        until = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield batch.slice(at, until - at)
        at = until


def _token_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    top = max(ranks.values(), default=-1) + 1
    tokens = [None] * top
    for token, rank in ranks.items():
        tokens[rank] = token
    sizes = np.array([-1 if t is None else len(t) for t in tokens], np.int64)
    starts = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
    return np.frombuffer(b"".join(t or b"" for t in tokens), np.uint8), starts, sizes


def _decoded(batch: pa.RecordBatch, table, ids: str, into: str) -> pa.RecordBatch:
    data, starts, sizes = table
    column = batch.column(ids)
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False)
    if len(flat) and (flat.min() < 0 or flat.max() >= len(sizes) or sizes[flat].min() < 0):
        raise ValueError("an id is not in the vocabulary")
    sums = np.concatenate(([0], np.cumsum(sizes[flat])))
    ends = sums[np.concatenate(([0], np.cumsum(lengths)))]
    out = ranges(data, starts[flat], sizes[flat])
    made = pa.Array.from_buffers(
        pa.binary(), len(lengths), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(out.tobytes())]
    )
    return pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, into])
