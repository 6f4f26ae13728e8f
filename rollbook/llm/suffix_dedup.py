"""Removal of long repeated byte strings with a family of sparse suffix indexes.

A byte goes if some string of ``LENGTH`` bytes covers it that also starts anywhere
else in the corpus, in the same text or another. Matches never cross texts.

Of each window of ``LENGTH`` bytes one suffix is indexed: the one whose first
``PREFIX`` bytes have the least fingerprint (the leftmost on ties). The choice
depends on the window's bytes alone, so equal windows choose the same suffix, and
about two suffixes per ``LENGTH - PREFIX`` bytes are indexed instead of all. The
documents are dealt into batches by size. Each batch gets such a sparse suffix array:
its suffixes in the order of the fingerprints of their prefixes. Only equal prefixes
matter here, so the order is that of the fingerprints, not of the bytes. The array is
merge-scanned (a sort merge join) against the levels of the family; prefixes found
twice are hits, and levels of equal rank merge into one of the next rank before the
next batch comes. The index holds eight bytes a suffix; the blocks of the hits are
found again in a second pass over the texts.

Hits are then made exact. The windows that chose one suffix are a block. Equal blocks
are repeated as a whole; of the others with the same suffix, all windows are looked
up by their own fingerprint, each distinct block once, the blocks of a suffix together.

Rows that meet in one task are counted within tasks first, and joins on a suffix are
plain ones that Spark splits, so a passage in a third of all documents is no hot task.

Defined cases: a null text is empty, and its digest is that of no bytes; a text
shorter than ``LENGTH`` loses nothing; equal rows are texts of their own and so
repeat each other; a null doc_id is kept as a value; an empty table gives no rows.
Other columns are ignored by ``repeated_spans`` and kept by ``remove_repeats``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.llm.common import RollingHash, checked_broadcast, pieces, text_bytes, write_scratch

LENGTH = 200
PREFIX = 64
#: Text of one batch, and the most batches that a table is cut into; larger tables have larger batches.
BATCH_BYTES = 256_000_000
MOST_BATCHES = 16
#: Bits of a sort key that hold the position within a piece of text.
PLACE_BITS = 28
#: Hit suffixes, and rows that have any hit, up to which they are broadcast instead of shuffled with the rows they meet.
BROADCAST_SUFFIXES = 2_000_000
BROADCAST_ROWS = 1_000_000
#: Different blocks of one suffix that one task compares: about a million windows, some 60 MB.
MOST_KINDS = 8_000
#: Stands for a null doc_id in joins.
NO_ID = -(2**63)

_ID, _MARK = "suffix_id", "suffix_mark"


def _keyed(docs: DataFrame) -> DataFrame:
    """Name every row by its id and a hash of its text; equal rows share a name."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn(_ID, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn(_MARK, F.xxhash64(text))


def _least_ahead(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    full = -(-len(values) // width) * width
    padded = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    from_left = np.minimum.accumulate(rows, axis=1).ravel()
    from_right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(from_right[:count], from_left[width - 1 : width - 1 + count])


def blocks(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, prefix: int = PREFIX) -> dict[str, np.ndarray]:
    """The blocks of all texts: runs of windows that choose the same suffix.

    ``row``, ``start`` (first window) and ``run`` (further windows), ``suffix`` (the
    fingerprint of the chosen suffix's prefix), ``block`` (that of all its bytes).
    """
    sizes = np.diff(offsets)
    place = np.arange(len(data))
    inside = np.flatnonzero(place + length <= np.repeat(offsets[1:], sizes))
    if not len(inside):
        empty = np.zeros(0, np.int64)
        return {"row": empty, "start": empty, "run": empty, "suffix": empty, "block": empty}
    rolling = RollingHash(data)
    grams = rolling.windows(prefix)
    low = np.uint64((1 << PLACE_BITS) - 1)
    ranked = grams & ~low | np.arange(len(grams), dtype=np.uint64)
    chosen = (_least_ahead(ranked, length - prefix + 1)[inside] & low).astype(np.int64)
    change = np.flatnonzero(chosen[1:] != chosen[:-1]) + 1
    first, last = np.concatenate(([0], change)), np.concatenate((change, [len(chosen)])) - 1
    start, end = inside[first], inside[last]
    row = np.searchsorted(offsets, start, side="right") - 1
    return {
        "row": row,
        "start": start - offsets[row],
        "run": end - start,
        "suffix": grams[chosen[first]].view(np.int64),
        "block": rolling.slices(start, end + length).view(np.int64),
    }


def _long_texts(docs: DataFrame) -> DataFrame:
    return docs.where(F.octet_length("text") >= LENGTH).select(F.col("text").cast("string").alias("text"), _ID, _MARK)


def _batch_count(docs: DataFrame) -> int:
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return min(max(1, -(-total // BATCH_BYTES)), MOST_BATCHES)


def _suffixes(docs: DataFrame, batches: int) -> DataFrame:
    """(suffix, batch): the chosen suffixes of all documents, with the number of their batch."""

    def task(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(rows):
            found = blocks(*text_bytes(piece.column("text")))
            yield pa.RecordBatch.from_arrays([pa.array(found["suffix"]), piece.column("batch").take(pa.array(found["row"]))], ["suffix", "batch"])

    batch = F.pmod(F.xxhash64(F.lit(1), _ID, _MARK), F.lit(batches)).cast("int").alias("batch")
    return _long_texts(docs).select("text", batch).mapInArrow(task, "suffix long, batch int")


def _entries(docs: DataFrame) -> DataFrame:
    """All blocks of all documents; cheaper to find again than to keep."""

    def task(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(rows):
            found = blocks(*text_bytes(piece.column("text")))
            row = pa.array(found["row"])
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(_ID).take(row), piece.column(_MARK).take(row),
                    pa.array(found["start"].astype(np.int32)), pa.array(found["run"].astype(np.int32)),
                    pa.array(found["suffix"]), pa.array(found["block"]),
                ],
                [_ID, _MARK, "start", "run", "suffix", "block"],
            )

    return _long_texts(docs).mapInArrow(task, f"{_ID} long, {_MARK} long, start int, run int, suffix long, block long")


class SuffixLevels:
    """Levels of sorted tables of distinct suffixes; a level of rank r holds 2 ** r batches."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, DataFrame]] = []

    def _settle(self) -> None:
        """Merge levels of equal rank, least first, until all ranks differ."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (rank, one), (_, other) = self.levels.pop(), self.levels.pop()
            merged = one.unionByName(other).distinct()
            self.levels.append((rank + 1, write_scratch(merged.sortWithinPartitions("suffix"), "level")))

    def add(self, suffixes: DataFrame) -> DataFrame:
        """Index a batch's suffixes; returns those that occur in it twice or in a level."""
        self._settle()
        counted = suffixes.groupBy("suffix").agg((F.count(F.lit(1)) > 1).alias("twice"))
        new = write_scratch(counted.sortWithinPartitions("suffix"), "level")
        hits = new.where("twice").select("suffix")
        for _, level in self.levels:
            hits = hits.unionByName(new.where("NOT twice").select("suffix").join(level, "suffix"))
        self.levels.append((0, new.select("suffix")))
        return hits


def _named(texts: DataFrame, names: DataFrame, kind: str = "left_semi") -> DataFrame:
    """The rows that are named, or with left_anti the others; texts that are not wanted are not shuffled."""
    return texts.join(checked_broadcast(names, BROADCAST_ROWS), [_ID, _MARK], kind).select(*texts.columns)


def _window_rows(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(suffix, block, hashes): the fingerprints of all windows of the wanted blocks."""
    lists = wanted.groupBy(_ID, _MARK).agg(F.collect_list(F.struct("start", "run", "suffix", "block")).alias("wanted"))

    def task(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(rows):
            data, offsets = text_bytes(piece.column("text"))
            windows = RollingHash(data).windows(LENGTH)
            lists = piece.column("wanted")
            flat = lists.flatten()
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            start = flat.field("start").to_numpy().astype(np.int64) + offsets[row]
            count = flat.field("run").to_numpy().astype(np.int64) + 1
            ends = np.cumsum(count)
            at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - count), count)
            hashes = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(windows[at].view(np.int64)))
            yield pa.RecordBatch.from_arrays([flat.field("suffix"), flat.field("block"), hashes], ["suffix", "block", "hashes"])

    texts = _named(_long_texts(docs), write_scratch(wanted.select(_ID, _MARK).distinct(), "wanted_rows"))
    return texts.join(lists, [_ID, _MARK]).select("text", "wanted").mapInArrow(task, "suffix long, block long, hashes array<long>")


def _found_together(part: pa.RecordBatch) -> pa.RecordBatch:
    """(block, windows) of the blocks of whole suffixes: their windows that occur a second time with that suffix."""
    # Equal rows bring the same block again.
    part = part.take(pa.array(np.sort(np.unique(part.column("block").to_numpy(), return_index=True)[1])))
    count = part.column("hashes").value_lengths().to_numpy().astype(np.int64)
    row, ends = np.repeat(np.arange(len(count)), count), np.cumsum(count)
    values, suffix = part.column("hashes").flatten().to_numpy(), part.column("suffix").to_numpy()[row]
    order = np.lexsort((values, suffix))
    equal = (values[order][1:] == values[order][:-1]) & (suffix[order][1:] == suffix[order][:-1])
    repeated = np.zeros(len(values), bool)
    repeated[order[1:][equal]] = True
    repeated[order[:-1][equal]] = True
    at = (np.arange(len(values)) - np.repeat(ends - count, count))[repeated].astype(np.int32)
    lengths = np.bincount(row[repeated], minlength=len(count))
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), pa.array(at))
    some = pa.array(lengths > 0)
    return pa.RecordBatch.from_arrays([part.column("block").filter(some), lists.filter(some)], ["block", "windows"])


def _repeated_windows(docs: DataFrame, kinds: DataFrame) -> DataFrame:
    """(block, windows): which windows of the given blocks occur in another of them.

    Equal windows have chosen equal suffixes, so they are known by two fingerprints, and
    the blocks of one suffix, MOST_KINDS at most, are compared in one task.
    """
    rows = _window_rows(docs, kinds.select("suffix", "block", "place.*"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if last is not None:
                batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            suffix = batch.column("suffix").to_numpy()
            cut = int(np.searchsorted(suffix, suffix[-1])) if len(suffix) else 0
            # The last suffix may go on in the next batch.
            last = batch.slice(cut)
            if cut:
                yield _found_together(batch.slice(0, cut))
        if last is not None and last.num_rows:
            yield _found_together(last)

    return rows.repartition("suffix").sortWithinPartitions("suffix").mapInArrow(task, "block long, windows array<int>")


def _repeated_windows_apart(docs: DataFrame, kinds: DataFrame) -> DataFrame:
    """The same for suffixes of very many blocks, a row for each window, so that no task holds a suffix."""
    rows = _window_rows(docs, kinds.select("suffix", "block", "place.*"))
    # A block's fingerprint covers its suffix, so it names the block alone.
    windows = write_scratch(rows.select("suffix", "block", F.posexplode("hashes").alias("at", "hash")), "windows")
    # Equal rows share a name, so one window may come several times; two places are needed.
    place = F.xxhash64("block", "at")
    twice = windows.groupBy("suffix", "hash").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low < high").select("suffix", "hash")
    found = windows.join(twice, ["suffix", "hash"]).groupBy("block").agg(F.collect_set("at").alias("windows"))
    return found.select("block", F.array_sort("windows").alias("windows"))


def repeated_spans(docs: DataFrame, batches: int | None = None) -> DataFrame:
    """(suffix_id, suffix_mark, spans): per named row the stretches of repeated windows, as (start, run)."""
    batches = batches or _batch_count(docs)
    suffixes = write_scratch(_suffixes(docs, batches), "suffixes", "batch")
    family, hits = SuffixLevels(), None
    for batch in range(batches):
        new = family.add(suffixes.where(F.col("batch") == batch).select("suffix"))
        hits = new if hits is None else hits.unionByName(new)
    hits = write_scratch(hits.distinct(), "hits")
    members = _entries(docs).join(checked_broadcast(hits, BROADCAST_SUFFIXES), "suffix")
    # Equal rows share a name; from here on they are one row and a count.
    members = members.groupBy(_ID, _MARK, "start", "run", "suffix", "block").agg(F.count(F.lit(1)).alias("copies"))
    members = write_scratch(members, "members")
    kinds = members.groupBy("suffix", "block").agg(
        F.sum("copies").alias("n"), F.min(F.struct(_ID, _MARK, "start", "run")).alias("place")
    )
    kinds = write_scratch(kinds, "kinds")
    several = kinds.groupBy("suffix").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    wanted = write_scratch(kinds.join(several, "suffix"), "wanted")
    partly = _repeated_windows(docs, wanted.where(F.col("kinds") <= MOST_KINDS))
    many = wanted.where(F.col("kinds") > MOST_KINDS)
    if not many.isEmpty():
        partly = partly.unionByName(_repeated_windows_apart(docs, many))
    whole = kinds.where("n > 1").select("block", F.lit(None).cast("array<int>").alias("windows"))
    single = partly.join(kinds.where("n = 1").select("block"), "block")
    repeated = whole.unionByName(single.select("block", "windows"))
    spans = members.join(repeated, "block").select(_ID, _MARK, F.struct("start", "run", "windows").alias("span"))
    return spans.groupBy(_ID, _MARK).agg(F.collect_list("span").alias("spans"))


def _keep_mask(size: int, row: np.ndarray, base: np.ndarray, spans: pa.StructArray) -> np.ndarray:
    """True for the bytes that no repeated window covers."""
    covered = np.zeros(size + 1, np.int32)
    start = spans.field("start").to_numpy().astype(np.int64) + base[row]
    run = spans.field("run").to_numpy().astype(np.int64)
    windows = spans.field("windows")
    whole = windows.is_null().to_numpy(zero_copy_only=False)
    np.add.at(covered, start[whole], 1)
    np.add.at(covered, (start + run)[whole] + LENGTH, -1)
    count = windows.value_lengths().fill_null(0).to_numpy()
    at = np.repeat(start, count) + windows.flatten().to_numpy().astype(np.int64)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + LENGTH, -1)
    return np.cumsum(covered[:-1]) == 0


def _whole_characters(data: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Keep only the characters of which all bytes are kept."""
    character = np.cumsum((data & 0xC0) != 0x80)
    broken = np.zeros(int(character[-1]) + 1 if len(character) else 0, bool)
    broken[character[~keep]] = True
    return ~broken[character]


def remove_repeats(docs: DataFrame, batches: int | None = None, as_text: bool = False) -> DataFrame:
    """The documents with what is left of ``text``, ``n_bytes``, ``n_removed`` and ``n_spans``.

    What is left is a binary column ``kept_bytes``, as a cut can fall within a
    character; with ``as_text`` it is a string column ``kept_text`` without the
    characters that are cut in part. The columns added must not be there already.
    """
    kept_name = "kept_text" if as_text else "kept_bytes"
    added = [kept_name, "n_bytes", "n_removed", "n_spans"]
    if clash := {*added, _ID, _MARK, "spans"} & set(docs.columns):
        raise ValueError(f"the rows have columns {sorted(clash)} already")
    keyed = _keyed(docs)
    spans = repeated_spans(keyed, batches)
    spans = write_scratch(spans, "spans")
    names = spans.select(_ID, _MARK)
    joined = _named(keyed, names).join(spans, [_ID, _MARK])
    untouched = _named(keyed, names, "left_anti").withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
    joined = joined.select(*docs.columns, "spans").unionByName(untouched.select(*docs.columns, "spans"))

    def task(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(rows):
            data, offsets = text_bytes(piece.column("text"))
            lists = piece.column("spans")
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
            keep = _keep_mask(len(data), row, offsets, lists.flatten())
            removed = np.diff(np.concatenate(([0], np.cumsum(~keep, dtype=np.int64)))[offsets])
            opens = ~keep
            row_start = np.zeros(len(data), bool)
            row_start[offsets[:-1][offsets[:-1] < len(data)]] = True
            opens[1:] &= keep[:-1] | row_start[1:]
            spans_of = np.diff(np.concatenate(([0], np.cumsum(opens, dtype=np.int64)))[offsets])
            if as_text:
                keep = _whole_characters(data, keep)
            left = np.concatenate(([0], np.cumsum(keep, dtype=np.int64)))[offsets]
            kept = pa.Array.from_buffers(
                pa.string() if as_text else pa.binary(),
                len(left) - 1,
                [None, pa.py_buffer(left.astype(np.int32).tobytes()), pa.py_buffer(data[keep].tobytes())],
            )
            base = [c for c, name in zip(piece.columns, piece.schema.names, strict=True) if name != "spans"]
            yield pa.RecordBatch.from_arrays(
                [*base, kept, pa.array(np.diff(offsets)), pa.array(removed), pa.array(spans_of)],
                [*(n for n in piece.schema.names if n != "spans"), *added],
            )

    fields = [T.StructField(kept_name, T.StringType() if as_text else T.BinaryType()), *(T.StructField(n, T.LongType()) for n in added[1:])]
    return joined.mapInArrow(task, T.StructType([*docs.schema.fields, *fields]))
