"""Document fingerprints of closed syncmers, in built-in functions only.

Of all strings of ``K`` bytes of a text those are anchors whose minimal inner string of
``S`` bytes, by its hash, lies at the first or the last place. Whether a string is an
anchor depends on its own bytes alone, so equal stretches have equal anchors at equal
distances wherever they stand, and the anchors of an edited text are those of the parts
it kept plus those across the seams. About two of ``K - S + 1`` strings are anchors, and
no ``K - S + 1`` consecutive ones are without, given inner strings that differ.

Texts are read as UTF-8 bytes in stretches of ``STRETCH`` strings, so what is held besides
the text and its anchors does not grow with it. An inner string is compared with the
least of four neighbours at once, its own four first, which most of them fail.

Defined cases: a null text is empty and has no anchor; a text without any anchor, such as
one of under ``K`` bytes, has its whole text as the only one, at place 0; two empty
fingerprints are alike (1.0), an empty and another are not (0.0). ``edited_fingerprints`` orders rows
by ``doc_id``, rows without one first, rows of one id by a hash of their text, and takes
rows that are equal in both as one document, whose result each of them gets; the last
row is followed by the first, a single one by itself. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.common import checked_broadcast, write_scratch

K, S = 28, 5
WIDTH = K - S + 1
#: Inner strings are compared with the least of so many at once.
STEP = 4
STRETCH = 1 << 15
#: Rows that one task orders, and the most boundaries between such blocks that the driver holds.
BLOCK_ROWS = 10_000
MOST_BLOCKS = 1 << 15
#: Repeated keys up to which they are broadcast.
BROADCAST_KEYS = 1_000_000
#: Equal rows whose results one task writes.
COPIES = 1_000
#: Stands for a null doc_id in the order.
NO_ID = -(2**63)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _lesser_ahead(values: Column, by: int) -> Column:
    """The lesser of each value and the one ``by`` places ahead; at the end it is alone."""
    return F.zip_with(values, F.slice(values, by + 1, F.size(values)), lambda a, b: F.least(a, b))


def _stretch_anchors(data: Column, start: Column) -> Column:
    """Anchors of a stretch of at least K bytes that begins at ``start``."""
    size = F.octet_length(data)
    hashes = F.transform(F.sequence(F.lit(1), size - (S - 1)), lambda at: F.xxhash64(F.substring(data, at, F.lit(S))))

    def is_least(place: Column, at: Column, inner: Column, fours: Column, own: int) -> Column:
        """Whether the inner string at ``place`` is the least of those from ``at`` on; ``own`` is its four, most often the reason why not."""
        order = [own, *(step for step in range(0, WIDTH, STEP) if step != own)]
        return reduce(lambda a, b: a & b, [inner[place] <= fours[at + step] for step in order])

    def chosen(inner: Column, fours: Column) -> Column:
        places = F.sequence(F.lit(0), size - K)
        at_edge = F.filter(
            places,
            lambda at: is_least(at, at, inner, fours, 0) | is_least(at + (WIDTH - 1), at, inner, fours, WIDTH - STEP),
        )
        return F.transform(
            at_edge,
            lambda at: F.struct((start + at).alias("at"), F.xxhash64(F.substring(data, at + 1, F.lit(K))).alias("hash")),
        )

    return _let(
        hashes,
        lambda inner: _let(_lesser_ahead(inner, 1), lambda twos: _let(_lesser_ahead(twos, 2), lambda fours: chosen(inner, fours))),
    )


def closed_syncmers(data: Column) -> Column:
    """Anchors of a binary column, as an array of (at, hash) in order of place; empty if there are none."""
    last = F.octet_length(data) - K
    none = F.array().cast("array<struct<at:int,hash:bigint>>")
    starts = F.sequence(F.lit(0), last, F.lit(STRETCH))
    stretches = F.transform(starts, lambda at: _let(F.substring(data, at + 1, F.lit(STRETCH + K - 1)), lambda part: _stretch_anchors(part, at)))
    return F.when(last >= 0, F.flatten(stretches)).otherwise(none)


def hashes_of(anchors: Column) -> Column:
    return F.transform(anchors, lambda anchor: anchor["hash"])


def fingerprint(hashes: Column, data: Column) -> Column:
    """The distinct hashes of the anchors, in order; of a text that has none, that of the whole text."""
    whole = (F.size(hashes) == 0) & (F.octet_length(data) > 0)
    return F.when(whole, F.array(F.xxhash64(data))).otherwise(F.sort_array(F.array_distinct(hashes)))


def likeness(one: Column, other: Column) -> Column:
    """Share of the hashes of two fingerprints that both have."""
    common = F.size(F.array_intersect(one, other))
    either = F.size(one) + F.size(other) - common
    return F.when(either == 0, F.lit(1.0)).otherwise(common / either)


def hashes_before(anchors: Column, kept: Column) -> Column:
    """Hashes of the anchors that lie within the first ``kept`` bytes."""
    return hashes_of(F.filter(anchors, lambda anchor: anchor["at"] + K <= kept))


def hashes_behind(edited: Column, kept: Column) -> Column:
    """Hashes of the other anchors of a text, of which only what is needed for them is read."""
    seam = F.greatest(kept - (K - 1), F.lit(0))
    return hashes_of(closed_syncmers(F.substring(edited, seam + 1, F.octet_length(edited))))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``anchors`` and ``fingerprint``; needs no shuffle."""
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    anchored = docs.select("doc_id", "text", data.alias("data")).withColumn("anchors", closed_syncmers(F.col("data")))
    return anchored.withColumn("fingerprint", fingerprint(hashes_of(F.col("anchors")), F.col("data"))).drop("data")


# --- the next document ------------------------------------------------------


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("place"), F.xxhash64("text").alias("mark"), "text"
    )


def _keys(keyed: DataFrame) -> DataFrame:
    """(place, mark, n): the distinct documents and how many rows each has, as a written table."""
    return write_scratch(keyed.groupBy("place", "mark").agg(F.count(F.lit(1)).alias("n")), "document_keys")


def _boundaries(keys: DataFrame, block_rows: int) -> list[int]:
    """Places that cut the rows into blocks of about so many; a place of many rows occurs several times."""
    blocks = min(-(-keys.count() // block_rows), MOST_BLOCKS)
    if blocks < 2:
        return []
    shares = [i / blocks for i in range(1, blocks)]
    return sorted(keys.agg(F.percentile_approx("place", shares, max(10_000, 20 * blocks))).first()[0])


def _block(bounds: list[int]) -> Column:
    """The block of a row: its place among the boundaries; rows of a repeated boundary are dealt over its blocks by ``mark``."""
    if not bounds:
        return F.lit(0)
    array = F.lit(bounds)
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(len(bounds).bit_length()))])

    def boundaries_up_to(passed: Callable[[Column], Column]) -> Column:
        def step(at: Column, ahead: Column) -> Column:
            return F.when(at + ahead > len(bounds), at).when(passed(array[at + ahead - 1]), at + ahead).otherwise(at)

        return F.aggregate(steps, F.lit(0), step)

    below, upto = boundaries_up_to(lambda bound: bound < F.col("place")), boundaries_up_to(lambda bound: bound <= F.col("place"))
    share = F.floor((F.col("mark").cast("double") / 2.0**64 + 0.5) * (upto - below)).cast("int")
    return below + F.greatest(F.least(share, upto - below - 1), F.lit(0))


def _distinct_rows(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    """One row per (place, mark); only texts of repeated keys are brought together."""
    repeated = keys.where("n > 1").select("place", "mark")
    if repeated.isEmpty():
        return keyed
    repeated = checked_broadcast(repeated, BROADCAST_KEYS)
    single = keyed.join(repeated, ["place", "mark"], "left_anti").select(*keyed.columns)
    several = keyed.join(repeated, ["place", "mark"], "left_semi").groupBy("place", "mark").agg(F.min(F.struct("doc_id", "text")).alias("row"))
    return single.unionByName(several.select("row.doc_id", "place", "mark", "row.text"))


def _for_each_row(found: DataFrame, keys: DataFrame) -> DataFrame:
    """The results of distinct documents, once more for every further row that is equal."""
    extra = keys.where("n > 1").select("place", "mark", (F.col("n") - 1).alias("copies"))
    if extra.isEmpty():
        return found
    found = write_scratch(found, "distinct_documents")
    copies = found.join(checked_broadcast(extra, BROADCAST_KEYS), ["place", "mark"])
    # The copies of one document are dealt out in parts of COPIES.
    parts = F.ceil(F.col("copies") / COPIES).cast("int")
    dealt = copies.withColumn("part", F.explode(F.sequence(F.lit(1), parts))).repartition("place", "mark", "part")
    count = F.when(F.col("part") < parts, F.lit(COPIES)).otherwise(F.col("copies") - (parts - 1) * COPIES).cast("int")
    again = dealt.withColumn("copy", F.explode(F.sequence(F.lit(1), count))).select(*found.columns)
    return found.unionByName(again)


def _with_next(keyed: DataFrame, keys: DataFrame, computed: Callable[[DataFrame], DataFrame], columns: list[str], block_rows: int) -> DataFrame:
    """Every distinct document with the named columns of the next one as ``next_<name>``.

    ``computed`` adds columns to the rows. It runs once a row, after the one shuffle of the
    texts, which brings together blocks of consecutive documents; the first row of a
    block visits the block before it as well.
    """
    block = _block(_boundaries(keys, block_rows))
    firsts = keys.groupBy(block.alias("block")).agg(F.min(F.struct("place", "mark")).alias("first"))
    # At most MOST_BLOCKS rows. The last block is visited by the first row of all.
    visits = firsts.select("first.*", F.lag("block").over(Window.orderBy("block")).alias("host"), F.max("block").over(Window.partitionBy()).alias("end"))
    visits = write_scratch(visits.select("place", "mark", F.coalesce("host", "end").alias("host")), "first_documents")
    rows = _distinct_rows(keyed, keys)
    guests = rows.join(F.broadcast(visits), ["place", "mark"])
    guests = guests.select(*rows.columns, F.col("host").alias("block"), F.lit(True).alias("guest"))
    placed = rows.select("*", block.alias("block"), F.lit(False).alias("guest")).unionByName(guests)
    ready = computed(placed.repartition("block"))
    order = Window.partitionBy("block").orderBy("guest", "place", "mark")
    following = [F.lead(name).over(order).alias(f"next_{name}") for name in columns]
    return ready.select("*", *following).where(~F.col("guest")).drop("guest", "block")


def edited_fingerprints(docs: DataFrame, quarter: int = 4, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per row of ``docs`` its fingerprint, its edited text with that one's fingerprint, and how alike they are.

    In the edited text the last ``floor(n_chars / quarter)`` characters are replaced by the
    first as many (or all) of the next document. ``near_edited`` and ``near_next`` are the
    likeness to the edited text's fingerprint and to the next document's.
    """
    size = F.length("text")
    cut = F.floor(size / quarter).cast("int")
    kept = F.left("text", size - cut)

    def anchored(rows: DataFrame) -> DataFrame:
        data = F.col("text").cast("binary")
        rows = rows.withColumns({"anchors": closed_syncmers(data), "kept": F.octet_length(kept)})
        found = fingerprint(hashes_of(F.col("anchors")), data)
        return rows.withColumns({"fingerprint": found, "kept_hashes": hashes_before(F.col("anchors"), F.col("kept"))}).drop("anchors")

    keyed = _keyed(docs)
    keys = _keys(keyed)
    found = _with_next(keyed, keys, anchored, ["text", "fingerprint"], block_rows)
    found = found.withColumns({"n_chars": size.cast("long"), "edited_text": F.concat(kept, F.left("next_text", cut))})
    edited = F.col("edited_text").cast("binary")
    found = found.withColumn("edited_hashes", F.concat("kept_hashes", hashes_behind(edited, F.col("kept"))))
    found = found.withColumn("edited_fingerprint", fingerprint(F.col("edited_hashes"), edited))
    found = found.select(
        "doc_id", "place", "mark", "n_chars", "edited_text", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
    return _for_each_row(found, keys).drop("place", "mark")
