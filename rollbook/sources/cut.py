"""Cutting one large register file, whose values may hold line breaks, in parallel.

Whether a line begins a record depends on the quotes before it, so a plain reader
takes such a file in one task. Here the lines are read in splits. Within a split the
quotes are counted for both cases, that it begins inside of a value or not; one row
for each split then tells which case holds and how many records lie before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollbook.sources.register import FRAGMENT_ROWS, READ_OPTIONS, export_fragments
from rollbook.sources.schema import FILE_HEADER, REGISTER_NAMES

SPLIT = ["file_path", "file_block_start"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place, and how many quotes of the split stand before them, odd or even."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("line"), "value"
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    inside = Window.partitionBy(*SPLIT).orderBy("line")
    ahead = F.coalesce(F.sum("odd").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    counted = lines.withColumn("odd", (quotes % 2).cast("long")).withColumn("ahead", ahead)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counted.withColumns(
        {
            "if_outside": F.sum(F.when(F.col("ahead") == 0, 1).otherwise(0)).over(so_far),
            "if_inside": F.sum(F.when(F.col("ahead") == 1, 1).otherwise(0)).over(so_far),
            "next_ahead": F.lead("ahead").over(inside),
        }
    )


def _splits(lines: DataFrame) -> DataFrame:
    """Per split whether it begins inside a value, and the records that begin before it; a row each, so few."""
    tallies = lines.groupBy(*SPLIT).agg(
        F.sum("odd").alias("odd"), F.max("if_outside").alias("if_outside"), F.max("if_inside").alias("if_inside")
    )
    before = Window.partitionBy("file_path").orderBy("file_block_start").rowsBetween(Window.unboundedPreceding, -1)
    opened = tallies.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    begun = opened.withColumn("begun", F.when(F.col("inside") == 0, F.col("if_outside")).otherwise(F.col("if_inside")))
    return begun.select(*SPLIT, "inside", F.coalesce(F.sum("begun").over(before), F.lit(0)).alias("records_before"))


def cut_records(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, record, text): the records of CSV files, numbered from 1 in each, with their line breaks.

    The lines are shuffled once, by split. Only records that have, or at the end of a
    split may have, several lines are put together by a second one. Blank lines between
    records are no records but keep their number.
    """
    lines = _lines(spark, path)
    placed = lines.join(_splits(lines), SPLIT)
    number = F.col("records_before") + F.when(F.col("inside") == 0, F.col("if_outside")).otherwise(F.col("if_inside"))
    begins = F.col("ahead") == F.col("inside")
    alone = begins & F.coalesce(F.col("next_ahead") == F.col("inside"), F.lit(False))
    rows = placed.select(*SPLIT, "line", "value", number.alias("record"), alone.alias("alone"))
    parts = F.array_sort(F.collect_list(F.struct("file_block_start", "line", "value")))
    together = rows.filter(~F.col("alone")).groupBy("file_path", "record").agg(
        F.array_join(F.transform(parts, lambda part: part["value"]), "\n").alias("value")
    )
    whole = rows.filter("alone").select("file_path", "record", "value").unionByName(together)
    text = F.regexp_replace("value", "\r$", "")
    return whole.select("file_path", "record", text.alias("text")).filter(F.col("text") != "")


def scan_raw_register(spark: SparkSession, path: str) -> DataFrame:
    """What ``scan_register`` reads, from one large file in as many tasks as it has splits.

    A file whose first record is another header, and a record with more or fewer fields
    than the file has columns, fail the scan.
    """
    records = cut_records(spark, path)
    is_header = F.replace("text", F.lit('"'), F.lit("")) == ",".join(FILE_HEADER)
    wrong = F.raise_error(F.concat(F.lit("another header in "), "file_path")).cast("boolean")
    body = records.filter(F.when(F.col("record") > 1, F.lit(True)).when(is_header, F.lit(False)).otherwise(wrong))
    names = [f"c{at}" for at in range(len(REGISTER_NAMES))]
    options = {name: str(READ_OPTIONS[name]) for name in ("quote", "escape")} | {"multiLine": "true", "mode": "FAILFAST"}
    parsed = body.select(F.from_csv("text", ", ".join(f"{name} string" for name in names), options).alias("row"))
    return parsed.select("row.*").toDF(*REGISTER_NAMES)


def cut_into_fragments(spark: SparkSession, path: str, fragments: str, rows_per_file: int = FRAGMENT_ROWS) -> None:
    """Write a large file as fragments with a header and at most ``rows_per_file`` records each."""
    export_fragments(scan_raw_register(spark, path), fragments, rows_per_file)
