"""Lookups, ranks and numbers that hold when one group has a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_KEYS = 1_000
RANK_BLOCK = 1_000_000
LOWEST = -(2**63) + 1
BLOCK_DIGITS = 4


def lookup(
    rows: DataFrame, key: str, table: DataFrame, value: str, hot_keys: int = HOT_KEYS
) -> DataFrame:
    """Left join of ``rows`` to ``table``, which holds each ``key`` once.

    The most frequent keys of ``rows`` are looked up by broadcast: their share
    of the table has at most ``hot_keys`` rows whatever the data. All other
    rows are joined by shuffle, where no key can hold more than one
    ``hot_keys``-th of them. Rows without a key are passed by.
    """
    hot = (
        rows.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("__n"))
        .orderBy(F.desc("__n"), key)
        .limit(hot_keys)
        .select(key)
    )
    found = table.select(key, F.col(value).alias("__hot_value")).join(F.broadcast(hot), key)
    hot_table = hot.join(F.broadcast(found), key, "left").withColumn("__hot", F.lit(True))
    marked = rows.join(F.broadcast(hot_table), key, "left")
    direct = F.col("__hot").isNotNull() | F.col(key).isNull()
    done = marked.filter(direct).withColumnRenamed("__hot_value", value).drop("__hot")
    cold = marked.filter(~direct).drop("__hot", "__hot_value")
    return done.unionByName(cold.join(table.select(key, value), key, "left"))


def descending_rank(
    rows: DataFrame, group: str, by: str, name: str, block: int = RANK_BLOCK
) -> DataFrame:
    """``rank() over (partition by group order by by desc)`` for a unique integer ``by``.

    A group is cut into blocks of ``block`` consecutive numbers. As the numbers
    are unique, a block has at most that many rows, so no task sorts a whole
    group. The rank is the rank in the block plus the rows of higher blocks.
    """
    cut = rows.withColumn(
        "__group", F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    ).withColumn("__block", F.expr(f"coalesce(`{by}` div {block}, {LOWEST})"))
    higher = Window.partitionBy("__group").orderBy(F.desc("__block")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ahead = (
        cut.groupBy("__group", "__block")
        .agg(F.count("*").alias("__n"))
        .withColumn("__ahead", F.coalesce(F.sum("__n").over(higher), F.lit(0)))
        .drop("__n")
    )
    inside = F.rank().over(Window.partitionBy("__group", "__block").orderBy(F.desc(by)))
    rank = F.col("__inside") + F.col("__ahead")
    return (
        cut.withColumn("__inside", inside)
        .join(ahead, ["__group", "__block"])
        .select(*rows.columns, rank.cast("int").alias(name))
    )


def number_by_hash(rows: DataFrame, key: str, start: Column, name: str) -> DataFrame:
    """Unique numbers above ``start`` for rows with a unique hex hash ``key``.

    The first digits of a hash are spread evenly and cut the rows into 65,536
    blocks of like size, numbered side by side and interleaved: row r of block b
    gets ``start + 1 + r * 65536 + b``. No task sees more than its blocks and
    nothing is counted beforehand. The numbers depend on the keys alone, so a
    task that runs again gives the same ones. They leave gaps where blocks
    differ in size.
    """
    block = F.substring(key, 1, BLOCK_DIGITS)
    inside = F.row_number().over(Window.partitionBy("__block").orderBy(key))
    number = (F.col("__inside") - 1).cast("bigint") * 16**BLOCK_DIGITS + F.conv(
        F.col("__block"), 16, 10
    ).cast("bigint")
    return (
        rows.withColumn("__block", block)
        .withColumn("__inside", inside)
        .select(*rows.columns, (start + 1 + number).alias(name))
    )
