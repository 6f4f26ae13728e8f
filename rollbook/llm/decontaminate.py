"""Benchmark decontamination by SimHash fingerprints of item-sized windows.

Texts are cut into lower-case words (runs of letters and digits) and five-word
shingles. A window of a document is as many words as a benchmark item has, fewer at
the document's end. Its similarity to the item is the weighted Jaccard coefficient
of their shingles, each weighted by how often it occurs: the sum of the smaller
weights over the sum of the larger ones. Reported is, for a document and an item, the
first window of the greatest similarity, if that is ``PERCENT`` or more.

1. A window that similar has ``PERCENT`` of the item's shingles in it. So windows of a
   size are only placed where that many shingles of items of this size stand in a
   document; this bound loses nothing.
2. Each such window gets a 64-bit SimHash, as each item does. The fingerprints are
   cut into ``RADIUS + 1`` blocks: two that differ in ``RADIUS`` bits at most agree in
   one block, so the join on (words, block number, block) finds all pairs within the
   radius. A pair at similarity 0.8 differs in 9.7 bits on average with a deviation of
   2.9, and lies beyond 23 bits with probability 2e-6.
3. Pairs within the radius are verified on their shingles.

Built-in functions only. Item shingles are broadcast up to ``BROADCAST_ROWS`` rows,
and joined by shuffle beyond. A document's rows that meet in one task are those of
its own text.

Defined cases: null and empty texts, and those without words, match nothing; a text
of fewer than five words is one shingle, and matches items of exactly these words;
rows with one doc_id are one document, with the best of their windows; a null doc_id
or item_id is kept as a value; equal items are reported each; empty tables give no
rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import checked_broadcast, write_scratch

WIDTH = 5
PERCENT = 80
BITS = 64
RADIUS = 23
BROADCAST_ROWS = 1_000_000


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(words: Column) -> Column:
    """A hash per five-word shingle in order; a shorter text is one shingle, an empty one none.

    ``words`` must be a column of the rows, not an expression: it is read in a loop.
    """
    full = F.transform(F.sequence(F.lit(0), F.size(words) - WIDTH), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WIDTH))))
    short = F.array(F.xxhash64(F.concat_ws(" ", words), F.size(words)))
    return F.when(F.size(words) >= WIDTH, full).when(F.size(words) > 0, short).otherwise(F.array().cast("array<bigint>"))


def simhash(hashes: Column) -> Column:
    """Bit b is set if most of the hashes, each as often as it occurs, have it set."""

    # ``hashes`` must be a column of the rows: it is read once for every bit.
    def bit(b: Column) -> Column:
        ones = F.aggregate(hashes, F.lit(0), lambda n, h: n + F.getbit(h, b).cast("int"))
        return F.when(2 * ones > F.size(hashes), F.lit(1)).otherwise(F.lit(0))

    bits = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), bit)
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda n, b: F.shiftleft(n, 1).bitwiseOR(b.cast("bigint")))


def _blocks(fingerprint: Column) -> Column:
    """The fingerprint's blocks, RADIUS + 1 of nearly equal length, as (number, value)."""
    cuts = [BITS * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    return F.array(
        *(
            F.struct(
                F.lit(i).alias("number"),
                F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << (high - low)) - 1).cast("bigint")).alias("value"),
            )
            for i, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False))
        )
    )


def _common(one: Column, other: Column) -> Column:
    """Sum of the smaller of the two counts of each shingle."""

    def count(hashes: Column, h: Column) -> Column:
        return F.size(F.filter(hashes, lambda x: x == h))

    return F.aggregate(F.array_intersect(one, other), F.lit(0), lambda n, h: n + F.least(count(one, h), count(other, h)))


def _hashed(rows: DataFrame, into: str) -> DataFrame:
    """Put the shingle hashes of ``text`` in its place, and the words as ``words``."""
    rows = rows.withColumn("words", words_of(F.col("text"))).drop("text")
    return rows.withColumn(into, shingle_hashes(F.col("words")))


def _items(benchmark: DataFrame) -> DataFrame:
    texts = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    hashed = _hashed(texts, "item").withColumn("n_words", F.size("words")).drop("words").where("n_words > 0")
    return write_scratch(hashed, "item_shingles").withColumn("item_print", simhash(F.col("item")))


def _windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc, mark, n_words, start): the windows that hold enough shingles of items."""
    known = items.select("n_words", F.size("item").alias("size"), F.explode("item").alias("hash")).distinct()
    known = write_scratch(known, "shingles")
    # Outer, as the filter that Spark derives from an inner one would compute the hashes twice, word by word.
    placed = _hashed(docs, "hashes").select("doc", "mark", F.posexplode_outer("hashes").alias("place", "hash"))
    found = placed.join(checked_broadcast(known, BROADCAST_ROWS), "hash").groupBy("doc", "mark", "n_words", "size").agg(F.array_sort(F.collect_set("place")).alias("places"))
    found = write_scratch(found, "found")
    least = F.greatest(F.lit(1), F.ceil(PERCENT * F.col("size") / 100).cast("int"))

    def starts(place: Column, i: Column) -> Column:
        # A window starts after the known shingle before, and so far before its own first at most that
        # enough of them can follow; the one that makes it enough must lie within it.
        enough = F.get("places", i + least - 1)
        low = F.greatest(place - F.col("size") + least, F.coalesce(F.get("places", i - 1) + 1, F.lit(0)), F.lit(0), enough - F.col("size") + 1)
        return F.when(enough.isNotNull() & (low <= place), F.sequence(low, place))

    found = found.select("doc", "mark", "n_words", F.explode_outer(F.transform("places", starts)).alias("starts"))
    return found.select("doc", "mark", "n_words", F.explode(F.col("starts")).alias("start"))


def _matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The windows that match an item, with the document (doc, mark) and the item."""
    items = write_scratch(_items(benchmark), "items")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Rows are named by their id and their text; a null id is a name as well.
    docs = docs.select(F.struct("doc_id").alias("doc"), F.xxhash64(text).alias("mark"), text.alias("text"))
    windows = write_scratch(_windows(docs, items), "windows")
    sized = items.select("n_words", F.size("item").alias("size")).distinct()
    lists = windows.join(F.broadcast(sized), "n_words").groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "n_words", "size")).alias("windows"))
    texts = docs.join(checked_broadcast(write_scratch(lists.select("doc", "mark").distinct(), "marked"), BROADCAST_ROWS), ["doc", "mark"], "left_semi")
    cut = texts.dropDuplicates(["doc", "mark"]).join(lists, ["doc", "mark"])
    cut = _hashed(cut, "hashes").select("doc", "mark", F.explode_outer("windows").alias("w"), "hashes")
    cut = cut.select("doc", "mark", F.col("w.start").alias("start"), F.col("w.n_words").alias("n_words"), F.slice("hashes", F.col("w.start") + 1, F.col("w.size")).alias("window"))
    cut = write_scratch(cut, "window_shingles").withColumn("print", simhash(F.col("window")))
    cut = write_scratch(cut, "prints")
    left = cut.withColumn("block", F.explode_outer(_blocks(F.col("print"))))
    right = items.withColumn("block", F.explode_outer(_blocks(F.col("item_print"))))
    near = left.join(right, ["n_words", "block"]).where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
    # A pair that agrees in several blocks is taken in the first of them.
    xor = F.col("print").bitwiseXOR(F.col("item_print"))
    first = F.array_min(F.transform(F.filter(_blocks(xor), lambda b: b["value"] == 0), lambda b: b["number"]))
    near = near.where(first == F.col("block.number"))
    scored = near.withColumn("common", _common(F.col("window"), F.col("item")))
    return scored.withColumn("either", F.size("window") + F.size("item") - F.col("common")).where(100 * F.col("common") >= PERCENT * F.col("either"))


def contaminated_texts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, mark) of the rows with a match; ``mark`` is xxhash64 of the text, of an empty one for a null."""
    return _matches(docs, benchmark).select("doc.doc_id", "mark").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, n_words, common, either, similarity) of the documents' best windows.

    ``start`` counts words from 0; ``similarity`` is ``common / either``.
    """
    scored = _matches(docs, benchmark)
    similarity = F.col("common") / F.col("either")
    best = scored.groupBy("doc", "item_id", "n_words").agg(F.min(F.struct((-similarity).alias("order"), "start", "common", "either")).alias("best"))
    return best.select(
        "doc.doc_id", "item_id", "best.start", "n_words", "best.common", "best.either", (-F.col("best.order")).alias("similarity")
    )


def oracle() -> str:
    """The same rows in DuckDB: all windows of an item's size from its first to its last shingle in a document."""
    cut = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w : w <> '')"
    grams = f"""CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {WIDTH} THEN [array_to_string(words, ' ') || ' of ' || len(words)]
      ELSE list_transform(range(1, len(words) - {WIDTH - 2}), lambda i : array_to_string(words[i:i + {WIDTH - 1}], ' ')) END"""
    return f"""
WITH docs AS (SELECT doc_id, {grams} AS grams FROM (SELECT doc_id, {cut} AS words FROM documents)),
items AS (SELECT item_id, len(words)::INTEGER AS n_words, {grams} AS grams FROM (SELECT item_id, {cut} AS words FROM benchmark) WHERE len(words) > 0),
counts AS (SELECT item_id, gram, count(*) AS n FROM (SELECT item_id, unnest(grams) AS gram FROM items) GROUP BY ALL),
places AS (SELECT doc_id, gram, place FROM (SELECT doc_id, unnest(grams) AS gram, unnest(range(len(grams))) AS place FROM docs)),
spans AS (
  SELECT doc_id, item_id, min(place) AS low, max(place) AS high FROM places JOIN counts USING (gram) GROUP BY ALL
), starts AS (
  SELECT doc_id, item_id, n_words, len(i.grams) AS size, unnest(range(greatest(0, low - len(i.grams)), high + 1)) AS start
  FROM spans JOIN items i USING (item_id)
), windows AS (
  SELECT doc_id, item_id, n_words, start, size, gram, count(*) AS n
  FROM starts JOIN places USING (doc_id) WHERE place >= start AND place < start + size GROUP BY ALL
), scored AS (
  SELECT doc_id, item_id, n_words, start, sum(least(w.n, coalesce(c.n, 0)))::BIGINT AS common, sum(w.n)::BIGINT + size - sum(least(w.n, coalesce(c.n, 0)))::BIGINT AS either
  FROM windows w LEFT JOIN counts c USING (item_id, gram) GROUP BY doc_id, item_id, n_words, start, size
), best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY common / either DESC, start) AS r FROM scored WHERE 100 * common >= {PERCENT} * either
)
SELECT doc_id, item_id, start::INTEGER AS start, n_words, common::INTEGER AS common, either::INTEGER AS either, common / either AS similarity FROM best WHERE r = 1"""
