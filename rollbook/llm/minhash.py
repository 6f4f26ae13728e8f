"""Near-duplicate documents by MinHash bands and odd sketches.

A document is the set of its distinct word shingles. From ``BANDS * ROWS`` MinHash
samples come the bands that propose candidates and an odd sketch: a bitmap in which
every sample toggles one bit, so that the bits in which two sketches differ count
the samples that differ. For high similarities this estimate is sharp; candidates
that are clearly below the threshold go, and the rest are confirmed on full sets.
The sketch's threshold lies ``SLACK`` standard errors below the wanted similarity.

Equal sets are one class with a number of its own. A band's bucket is not compared
all with all. First, its members meet the one that shares most buckets with others.
Of buckets that then hold several components, the members' own shingles are counted:
those that no other member of such a bucket has, and that therefore cannot be common.
A pair reaches at most ``min(c) / (max(c) + own + own)``, c being the other shingles, so
a member that cannot reach the threshold even with the one of the fewest own shingles
leaves the bucket; the rest meet that one. Members that still share buckets of several
components are a family: its pairs across components are compared in blocks, by that
bound and then by their shared shingles, and only links are written. The bounds are
exact, so no pair of a bucket is lost, and a large group of near copies, or of texts
around one passage, writes rows in proportion to its size. A pair at the threshold shares no bucket with probability
(1 - t ** ROWS) ** BANDS, 4e-7 for t = 0.8.

Defined cases: a null or empty text, or one without words, has no shingles and is
linked with nothing; a text with fewer words than a shingle is one shingle; rows with
one doc_id and different texts are compared each for itself; a null doc_id takes no part and gets a null component and
kept = false (``near_groups`` compares these rows as well); an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import RollingHash, checked_broadcast, mix, pieces, spaced_bytes, word_spans, write_scratch
from rollbook.llm.components import components

BANDS, ROWS = 28, 4
SKETCH_BITS = 512
SLACK = 5.0
#: Ids up to which a list of documents is broadcast to the texts instead of shuffled with them.
BROADCAST_IDS = 1_000_000
#: Members of a family that one task compares with as many others at once.
BLOCK = 1_024
#: Rows that agree in these have equal sets.
SAME = ["first", "second", "n_shingles"]
#: A shingle is named by so many bits of its hash, which leaves room for the row.
NAME_BITS = 50

_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_ADDENDS = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
_PLACES = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)

_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_IS_WORD = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])


def shingles(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, shingle name) of a text column, in order."""
    data, offsets = spaced_bytes(column)
    data = _LOWER[data]
    starts, ends = word_spans(_IS_WORD[data])
    words = RollingHash(data).slices(starts, ends)
    row = np.searchsorted(offsets, starts, side="right") - 1
    count = np.bincount(row, minlength=len(column))
    # Words from here to the end of the row: a full shingle needs `width` of them.
    left = np.repeat(np.cumsum(count), count) - np.arange(len(words))
    size = np.minimum(left, width)
    is_start = (left >= width) | ((count[row] < width) & (left == count[row]))
    sums = np.zeros(len(words), np.uint64)
    for k in range(width):
        inside = size > k
        moved = np.zeros(len(words), np.uint64)
        moved[: len(words) - k] = words[k:]
        sums += np.where(inside, moved * _PLACES[k % 64] + np.uint64(k), np.uint64(0))
    sums = mix(sums + size.astype(np.uint64))[is_start]
    keys = np.unique(row[is_start].astype(np.uint64) << np.uint64(NAME_BITS) | sums >> np.uint64(64 - NAME_BITS))
    return (keys >> np.uint64(NAME_BITS)).astype(np.int64), (keys & np.uint64((1 << NAME_BITS) - 1)).astype(np.int64)


def _row_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        for low in range(0, batch.num_rows, 1 << (64 - NAME_BITS)):
            yield batch.slice(low, 1 << (64 - NAME_BITS))


def samples(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash samples, a row per sample and a column per set; sets are slices from ``starts`` on."""
    short = mix(names.astype(np.uint64)).astype(np.uint32)
    out = np.empty((BANDS * ROWS, len(starts)), np.uint32)
    for i in range(BANDS * ROWS):
        out[i] = np.minimum.reduceat(short * _FACTORS[i] + _ADDENDS[i], starts)
    return out


def odd_sketch(found: np.ndarray) -> np.ndarray:
    """A bitmap of SKETCH_BITS per column of samples; every sample toggles one bit."""
    sketch = np.zeros((found.shape[1], SKETCH_BITS // 64), np.uint64)
    each = np.arange(found.shape[1])
    for i, sample in enumerate(found):
        bit = mix(sample.astype(np.uint64) + np.uint64(i << 32)) % np.uint64(SKETCH_BITS)
        sketch[each, (bit >> np.uint64(6)).astype(np.int64)] ^= np.uint64(1) << (bit & np.uint64(63))
    return sketch


def most_differing_bits(similarity: float) -> int:
    """Differing sketch bits up to which a pair may still reach the similarity."""
    count = BANDS * ROWS
    spread = np.sqrt(similarity * (1 - similarity) / count)
    low = max(0.0, similarity - SLACK * spread)
    bits = SKETCH_BITS / 2 * (1 - np.exp(-4 * count * (1 - low) / SKETCH_BITS))
    return int(np.ceil(bits + np.sqrt(SKETCH_BITS) / 2))


def _signatures(docs: DataFrame, width: int) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _row_pieces(batches):
            row, names = shingles(batch.column("text"), width)
            size = np.bincount(row, minlength=batch.num_rows)
            full = np.flatnonzero(size)
            first, second = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            bands = np.zeros((batch.num_rows, BANDS), np.int64)
            sketch = np.zeros((batch.num_rows, SKETCH_BITS // 64), np.int64)
            if len(full):
                starts = np.searchsorted(row, full)
                spread = mix(names.astype(np.uint64))
                first[full] = np.add.reduceat(spread, starts).view(np.int64)
                second[full] = np.add.reduceat(mix(spread), starts).view(np.int64)
                found = samples(names, starts)
                sketch[full] = odd_sketch(found).view(np.int64)
                for b in range(BANDS):
                    key = np.full(len(full), np.uint64(b + 1))
                    for sample in found[b * ROWS : (b + 1) * ROWS]:
                        key = mix(key * _PLACES[0] + sample.astype(np.uint64))
                    bands[full, b] = key.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("mark"), pa.array(size.astype(np.int64)), pa.array(first), pa.array(second),
                    _lists(bands), _lists(sketch),
                ],
                ["doc_id", "mark", "n_shingles", "first", "second", "bands", "sketch"],
            )

    kind = "doc_id long, mark long, n_shingles long, first long, second long, bands array<long>, sketch array<long>"
    return _texts(docs).mapInArrow(task, kind)


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text, mark): a row is named by its id and the mark of its text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.withColumn("mark", F.xxhash64("text"))


def _lists(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(matrix.ravel()))


def same_row(one: DataFrame, other: DataFrame) -> Column:
    """Whether two rows have one id, or none, and one text."""
    return one["doc_id"].eqNullSafe(other["doc_id"]) & (one["mark"] == other["mark"])


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The full sets of the classes (node, doc_id, mark), by the rows that these name."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _row_pieces(batches):
            row, names = shingles(batch.column("text"), width)
            offsets = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(names))], ["node", "names"])

    texts = _texts(docs)
    named = texts.join(checked_broadcast(wanted, BROADCAST_IDS), same_row(texts, wanted)).select("node", "text")
    sets = write_scratch(named.mapInArrow(task, "node long, names array<long>"), "sets")
    # A repeated row gives its set again.
    return sets if sets.count() == wanted.count() else write_scratch(sets.dropDuplicates(["node"]), "sets")


class _Search:
    """The steps on candidate pairs; what one step hands to the next is a written table."""

    def __init__(self, docs: DataFrame, classes: DataFrame, members: DataFrame, width: int, percent: int):
        self.percent = percent
        self.limit = most_differing_bits(percent / 100)
        self.nodes = classes.select("node", "n_shingles", "sketch")
        wanted = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "row.doc_id", "row.mark")
        self.sets = _sets(docs, write_scratch(wanted, "nodes"), width)
        self.links: DataFrame | None = None

    def _sides(self, pairs: DataFrame, table: DataFrame) -> DataFrame:
        """Pairs (a, b) with the columns of the table for a and for b."""
        for side in ("a", "b"):
            pairs = pairs.join(table.select([F.col(c).alias(side if c == "node" else f"{side}_{c}") for c in table.columns]), side)
        return pairs

    def _plausible(self, pairs: DataFrame) -> DataFrame:
        """Pairs that sizes and sketches do not rule out."""
        pairs = self._sides(pairs, self.nodes)
        fits = 100 * F.least("a_n_shingles", "b_n_shingles") >= self.percent * F.greatest("a_n_shingles", "b_n_shingles")
        differing = F.aggregate(F.zip_with("a_sketch", "b_sketch", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
        return pairs.where(fits & (differing <= self.limit)).select("a", "b").distinct()

    def _confirmed(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose full sets are similar enough."""
        common = F.size(F.array_intersect("a_names", "b_names"))
        either = F.size("a_names") + F.size("b_names") - common
        sides = self._sides(pairs, self.sets)
        return sides.where(100 * common >= self.percent * either).select(F.col("a").alias("u"), F.col("b").alias("v"))

    def connect(self, pairs: DataFrame) -> DataFrame:
        """Add the links among the pairs; returns the components of all links so far."""
        pairs = write_scratch(self._plausible(pairs), "pairs")
        return self.add(self._confirmed(pairs))

    def add(self, new: DataFrame) -> DataFrame:
        new = write_scratch(new, "links")
        self.links = new if self.links is None else self.links.unionByName(new)
        return write_scratch(components(self.links), "components")

    def names_of(self, members: DataFrame) -> DataFrame:
        """The shingles of the members, as (node, name)."""
        return self.sets.join(members.select("node").distinct(), "node", "left_semi").select("node", F.explode("names").alias("name")).distinct()

    def own_shingles(self, members: DataFrame) -> DataFrame:
        """(node, shared, own): how many of a member's shingles no other member of these buckets has."""
        nodes = members.select("node").distinct()
        names = self.names_of(members)
        alone = names.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).where("n = 1")
        counts = alone.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
        sizes = self.nodes.select("node", F.col("n_shingles").alias("size")).join(nodes, "node", "left_semi")
        own = F.coalesce("own", F.lit(0))
        return sizes.join(counts, "node", "left").select("node", (F.col("size") - own).alias("shared"), own.alias("own"))

    def within_reach(self, members: DataFrame) -> DataFrame:
        """Members that may reach the threshold with the bucket's member of the fewest own shingles."""
        fewest = members.groupBy("bucket").agg(F.min("own").alias("fewest"))
        reach = 100 * F.col("shared") >= self.percent * (F.col("shared") + F.col("own") + F.col("fewest"))
        return members.join(fewest, "bucket").where(reach).drop("fewest")


def _open_buckets(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members, with their components, of buckets that hold more than one of these."""
    members = members.drop("component").join(found.withColumnRenamed("component", "label"), "node", "left")
    members = members.withColumn("component", F.coalesce("label", "node")).drop("label")
    several = members.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return members.join(several.where("low < high").select("bucket"), "bucket")


def _leader_pairs(members: DataFrame, order: list) -> DataFrame:
    """Every member with its bucket's first by that order, if that is in another component."""
    leaders = members.groupBy("bucket").agg(F.min(F.struct(*order, "node", "component")).alias("leader"))
    pairs = members.join(leaders, "bucket").where(F.col("component") != F.col("leader.component"))
    return pairs.select(F.least("node", "leader.node").alias("a"), F.greatest("node", "leader.node").alias("b")).distinct()


def _across(left: pa.Table, right: pa.Table, percent: int) -> pa.Table:
    """Links between two blocks of a family, across components, by the members' shared shingles."""

    def arrays(table: pa.Table):
        table = table.rename_columns([c.removeprefix("right_") for c in table.column_names])
        names = table.column("names").combine_chunks()
        ends = np.concatenate(([0], np.cumsum(names.value_lengths().to_numpy(), dtype=np.int64)))
        return [table.column(c).to_numpy() for c in ("node", "component", "shared", "own")], names.flatten().to_numpy(), ends

    (a, a_names, a_ends), ((node, part, shared, own), names, ends) = arrays(left), arrays(right)
    known, place = np.unique(names, return_inverse=True)
    low, high = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, (one, one_part, one_shared, one_own) in enumerate(zip(*a, strict=True)):
        most = 100 * np.minimum(shared, one_shared) >= percent * (np.maximum(shared, one_shared) + own + one_own)
        for_it = np.flatnonzero(most & (part != one_part))
        if not len(for_it):
            continue
        has = np.zeros(len(known) + 1, bool)
        mine = a_names[a_ends[i] : a_ends[i + 1]]
        at = np.searchsorted(known, mine)
        has[at[known[np.minimum(at, len(known) - 1)] == mine]] = True
        common = np.array([np.count_nonzero(has[place[ends[j] : ends[j + 1]]]) for j in for_it])
        linked = for_it[100 * common >= percent * (shared[for_it] + own[for_it] + one_shared + one_own - common)]
        low.append(np.minimum(node[linked], one))
        high.append(np.maximum(node[linked], one))
    return pa.table({"u": np.concatenate(low), "v": np.concatenate(high)})


def _families(members: DataFrame) -> DataFrame:
    """(node, family): members that share a bucket, directly or through others, are a family."""
    first = members.groupBy("bucket").agg(F.min("node").alias("v"))
    return components(members.join(first, "bucket").select(F.col("node").alias("u"), "v")).withColumnRenamed("component", "family")


def _all_across(members: DataFrame, names: DataFrame, percent: int) -> DataFrame:
    """All links across the components of each family, compared block by block."""
    # A name that one member of all has cannot be common; the counts of these are at hand.
    several = names.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name")
    lists = names.join(several, "name").groupBy("node").agg(F.collect_list("name").alias("names"))
    family = write_scratch(_families(members), "families")
    sizes = family.groupBy("family").agg(F.count(F.lit(1)).alias("size"))
    nodes = members.groupBy("node").agg(F.first("component").alias("component"), F.first("shared").alias("shared"), F.first("own").alias("own"))
    placed = nodes.join(family, "node").join(lists, "node").join(sizes, "family").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    placed = write_scratch(placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "family_members")
    # Block i meets the blocks j >= i: as the left side with its own number first, as the right side second.
    left = placed.withColumn("x", F.col("block")).withColumn("y", F.explode(F.sequence("block", F.col("blocks") - 1)))
    right = placed.withColumn("y", F.col("block")).withColumn("x", F.explode(F.sequence(F.lit(0), "block")))
    right = right.select([F.col(c).alias(f"right_{c}") for c in right.columns])
    by = ["family", "x", "y"]
    pairs = left.groupBy(*by).cogroup(right.groupBy(*[f"right_{c}" for c in by]))
    return pairs.applyInArrow(lambda a, b: _across(a, b, percent), "u long, v long")


def _found(docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, component) of all classes that are linked with another."""
    members = classes.select("node", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = write_scratch(members.join(shared, "bucket").withColumn("component", F.col("node")), "members")
    search = _Search(docs, classes, members, width, percent)
    weights = members.groupBy("node").agg(F.sum("n").alias("weight"))
    found = search.connect(_leader_pairs(members.join(weights, "node"), [-F.col("weight")]))
    members = write_scratch(_open_buckets(members.select("bucket", "node"), found), "members")
    members = members.join(write_scratch(search.own_shingles(members), "own"), "node")
    members = write_scratch(_open_buckets(search.within_reach(members), found), "members")
    if members.isEmpty():
        return found
    found = search.connect(_leader_pairs(members, [F.col("own")]))
    members = write_scratch(_open_buckets(members, found), "members")
    if members.isEmpty():
        return found
    return search.add(_all_across(members, search.names_of(members), percent))


def _grouped(docs: DataFrame, width: int, percent: int, part: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All rows with their set; the classes of those that take part; (node, component) of the linked classes."""
    signed = write_scratch(_signatures(docs, width), "signatures")
    classes = signed.where(part).where("n_shingles > 0").groupBy(*SAME).agg(
        F.min(F.struct("doc_id", "mark")).alias("row"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    # The numbers are read from the written table only, so a repeated task cannot change them.
    classes = write_scratch(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    return signed, classes, _found(docs, classes, width, percent)


def near_groups(docs: DataFrame, width: int = 4, percent: int = 80) -> DataFrame:
    """(doc_id, mark, component) for every row of ``docs``, those without an id too.

    ``mark`` is xxhash64 of the text; ``component`` is a number that means nothing
    else, and null for texts without words.
    """
    signed, classes, found = _grouped(docs, width, percent, "true")
    of_class = classes.join(found, "node", "left").select(*SAME, F.coalesce("component", "node").alias("component"))
    return signed.select("doc_id", "mark", *SAME).join(of_class, SAME, "left").select("doc_id", "mark", "component")


def near_duplicates(docs: DataFrame, width: int = 4, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Linked are documents with ``100 * common >= percent * all`` of their shingles.
    """
    signed, classes, found = _grouped(docs, width, percent, "doc_id IS NOT NULL")
    ids = classes.select("node", F.col("row.doc_id").alias("least"))
    least = write_scratch(found.join(ids, "node").groupBy("component").agg(F.min("least").alias("label")), "labels")
    found = found.join(checked_broadcast(least, BROADCAST_IDS), "component").select("node", "label")
    of_class = classes.join(found, "node", "left").select(*SAME, F.coalesce("label", "row.doc_id").alias("component"))
    linked = signed.select("doc_id", *SAME).join(of_class, SAME, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return linked.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))
