"""Reading, writing and counting register files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.sources.schema import (
    CODE_TEXTS,
    FILE_SCHEMA,
    REGISTER_COLUMNS,
    REGISTER_NAMES,
)

FRAGMENT_ROWS = 50_000

# Quotes inside a value are doubled. With enforceSchema off, Spark compares the
# header of every file with the schema and fails on a file of other columns.
READ_OPTIONS = {"header": True, "quote": '"', "escape": '"', "enforceSchema": False}
WRITE_OPTIONS = {
    "header": True,
    "quoteAll": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def scan_register(
    spark: SparkSession, path: str, multi_line: bool = True, file_name: bool = False
) -> DataFrame:
    """The register file(s) under ``path`` as text columns with table names.

    A scan that allows line breaks in values reads each file in one task, which
    suits fragments. Set ``multi_line`` to False to read one large file of plain
    lines in splits. A record with more or fewer fields than the file has columns
    fails a scan of all columns; one of a few columns, or a count, takes it as it is.
    """
    raw = (
        spark.read.schema(FILE_SCHEMA)
        .options(**READ_OPTIONS)
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .csv(path)
    )
    if not file_name:
        return raw.toDF(*REGISTER_NAMES)
    return raw.select("*", "_metadata.file_name").toDF(*REGISTER_NAMES, "file_name")


def scan_code_columns(
    spark: SparkSession, path: str, multi_line: bool = True
) -> DataFrame:
    """Only the code texts and the status; the parser skips the other columns."""
    return scan_register(spark, path, multi_line).select(*CODE_TEXTS, "company_status")


def as_register_file(register: DataFrame) -> DataFrame:
    """All file columns under their file names; columns not at hand are empty."""
    present = set(register.columns)
    return register.select(
        *[
            (F.col(name) if name in present else F.lit(None)).cast("string").alias(header)
            for header, name in REGISTER_COLUMNS
        ]
    )


def export_fragments(
    register: DataFrame, path: str, rows_per_file: int = FRAGMENT_ROWS
) -> None:
    """Write CSV parts of at most ``rows_per_file`` whole records, each with a header.

    Every task cuts its own output, so the export needs no shuffle.
    """
    (
        as_register_file(register)
        .write.mode("overwrite")
        .options(**WRITE_OPTIONS)
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )


def file_row_counts(
    spark: SparkSession, path: str, multi_line: bool = True
) -> DataFrame:
    """Records per file."""
    return (
        scan_register(spark, path, multi_line, file_name=True)
        .groupBy("file_name")
        .agg(F.count("*").alias("row_count"))
    )


def total_row_count(counts: DataFrame) -> DataFrame:
    return counts.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("file_rowcount"))


def land(batch: DataFrame, path: str) -> DataFrame:
    """Replace the landing folder by ``batch`` and return what now lies there."""
    batch.write.mode("overwrite").parquet(path)
    return batch.sparkSession.read.schema(batch.schema).parquet(path)
