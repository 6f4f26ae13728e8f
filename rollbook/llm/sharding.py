"""Sharding by weighted rendezvous hashing.

Every record key draws one number per shard, and the smallest ``-ln(u) / weight``
wins. The draw of a shard depends on the key and that shard alone, so a further
shard takes keys only into itself, and a removed one gives away only its own.

Defined cases: a null key counts as the empty text; rows with one key share a
shard; a null text has size 1 and checksum 0; an empty table gives no rows;
equal rows get consecutive slots. Columns other than those named are ignored by
``shard_table`` and kept by ``assign_shard``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hash prefixes that split a shard when its rows are numbered: 16**3 pieces each.
BUCKET_DIGITS = 3
#: Equal rows that one task writes out together.
COPY_BLOCK = 100_000


def key_text(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit(""))


def draw(key: Column, shard: int) -> Column:
    """A number strictly between 0 and 1, fixed by the key and the shard (52 bits of md5)."""
    digits = F.substring(F.md5(F.concat(key_text(key), F.lit(f"/{shard}")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(2**52))


def rendezvous(key: Column, weights: dict[int, float]) -> Column:
    """The shard of a key among the shards in ``weights``; weights must be positive."""
    if not weights or min(weights.values()) <= 0:
        raise ValueError("give at least one shard, all weights above 0")
    costs = [
        F.struct((-F.log(draw(key, shard)) / F.lit(float(weight))).alias("cost"), F.lit(int(shard)).alias("shard"))
        for shard, weight in sorted(weights.items())
    ]
    return F.array_min(F.array(*costs))["shard"]


def assign_shard(rows: DataFrame, key: str, weights: dict[int, float], into: str = "shard") -> DataFrame:
    """Add the shard of every row; no shuffle. ``into`` must not be a column already."""
    if into in rows.columns:
        raise ValueError(f"the rows have a column {into} already")
    return rows.withColumn(into, rendezvous(F.col(key), weights))


def shard_table(docs: DataFrame, weights: dict[int, float], grown: dict[int, float]) -> DataFrame:
    """Size, checksum, shard, slot and the shard after growth of every document.

    Slots run from 0 without gaps in every shard, in order of the key's md5.
    They are counted by (shard, hash prefix), so no task orders a whole shard;
    equal rows are counted before the shuffle and written out in blocks, so a
    repeated key doesn't gather in one task.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    kinds = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    kinds = (
        kinds.withColumn("shard", rendezvous(F.col("doc_id"), weights))
        .withColumn("grown_shard", rendezvous(F.col("doc_id"), grown))
        .withColumn("order", F.md5(key_text(F.col("doc_id")).cast("binary")))
        .withColumn("bucket", F.substring("order", 1, BUCKET_DIGITS))
    )
    counts = kinds.groupBy("shard", "bucket").agg(F.sum("copies").alias("rows"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    within = (
        Window.partitionBy("shard", "bucket")
        .orderBy("order", "doc_id", "size", "text_crc32")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = kinds.withColumn("earlier", F.coalesce(F.sum("copies").over(within), F.lit(0))).join(
        offsets, ["shard", "bucket"]
    )
    last_block = F.floor((F.col("copies") - 1) / COPY_BLOCK)
    blocks = placed.withColumn("first", F.col("offset") + F.col("earlier")).select(
        "doc_id", "size", "text_crc32", "shard", "grown_shard", "first", "copies",
        F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)).alias("block"),
    )
    low = F.col("block") * COPY_BLOCK
    high = F.least(low + COPY_BLOCK, F.col("copies")) - 1
    return blocks.repartition("doc_id", "block").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.explode(F.transform(F.sequence(low, high), lambda i: F.col("first") + i)).alias("slot"),
        "grown_shard",
    )


def _shard_sql(count: int) -> str:
    return f"""(SELECT arg_min(s.i, (-ln((('0x' || substr(md5(key || '/' || s.i), 1, 13))::BIGINT + 0.5) / 4503599627370496), s.i))
        FROM range({count}) AS s(i))::INTEGER"""


def oracle(shards: int) -> str:
    """The same rows in DuckDB, for equal weights; crc32 is its definition, byte by byte."""
    return f"""
WITH RECURSIVE steps(b, k, c) AS (
  SELECT b, 0, b::BIGINT FROM range(256) AS r(b)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
rows AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS key, strlen(coalesce(text, ''))::BIGINT + 1 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x : ('0x' || x)::BIGINT)),
      lambda c, b : xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS text_crc32
  FROM documents, crc_table
), keyed AS (
  SELECT *, {_shard_sql(shards)} AS shard, {_shard_sql(shards + 1)} AS grown_shard FROM rows
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY md5(key), doc_id, size, text_crc32) - 1 AS slot, grown_shard
FROM keyed"""
