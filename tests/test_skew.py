"""Lookups, ranks and numbers against the plain forms, with hot groups."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rollbook.operators.skew import descending_rank, lookup, number_by_hash


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=str)


def test_lookup_is_a_left_join(spark):
    data = spark.range(3000).selectExpr(
        "id",
        "case when id % 3 = 0 then 'hot' when id % 3 = 1 then 'hot unknown' "
        "when id % 7 = 0 then null else concat('k', id % 50) end as key",
    )
    table = spark.range(0, 50, 2).selectExpr("concat('k', id) as key", "cast(id as string) as value").union(
        spark.createDataFrame([("hot", "found"), ("never", "x")], "key string, value string")
    )
    expected = data.join(table, "key", "left").select("id", "key", "value")
    for hot_keys in (1, 2, 5, 1000):
        actual = lookup(data, "key", table, "value", hot_keys).select("id", "key", "value")
        assert rows(actual) == rows(expected)


def test_lookup_without_rows_or_table(spark):
    data = spark.createDataFrame([(1, "a"), (2, None)], "id int, key string")
    empty = spark.createDataFrame([], "key string, value string")
    assert rows(lookup(data, "key", empty, "value").select("id", "key", "value")) == [
        (1, "a", None), (2, None, None),
    ]
    assert lookup(data.limit(0), "key", empty, "value").count() == 0


def test_rank_over_blocks_is_the_rank(spark):
    data = spark.range(1000).selectExpr(
        "id * 3 as id",
        "case when id % 3 = 0 then 'hot' when id % 11 = 0 then null else concat('g', id % 20) end as g",
    )
    data = data.union(spark.sql("select cast(null as bigint) id, 'hot' g"))
    expected = data.withColumn(
        "r", F.rank().over(Window.partitionBy("g").orderBy(F.desc("id")))
    )
    for block in (1, 100, 1_000_000):
        assert rows(descending_rank(data, "g", "id", "r", block)) == rows(expected)


def test_null_group_is_not_the_group_named_like_its_mark(spark):
    data = spark.createDataFrame([(1, None), (2, "-"), (3, "=")], "id bigint, g string")
    assert {row.r for row in descending_rank(data, "g", "id", "r").collect()} == {1}


def test_numbers_are_unique_and_above_the_start(spark):
    data = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("key"))
    numbered = number_by_hash(data, "key", F.lit(100), "id")
    figures = numbered.agg(
        F.count("*").alias("n"), F.countDistinct("id").alias("distinct"), F.min("id").alias("least")
    ).first()
    assert figures.n == figures.distinct == 5000
    assert figures.least > 100
    again = number_by_hash(data.repartition(7), "key", F.lit(100), "id")
    assert rows(again) == rows(numbered)
