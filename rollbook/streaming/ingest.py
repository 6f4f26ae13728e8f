"""Incremental ingest: each new file is merged into the register once."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.operators import codes
from rollbook.operators.registers import KEY, empty_register, upsert_register
from rollbook.sources.register import READ_OPTIONS, land
from rollbook.sources.schema import FILE_SCHEMA, REGISTER_NAMES
from rollbook.sources.snapshots import Snapshots

REGISTER = "register"
REJECTS = "register_rejects"
FRAGMENT_COUNTS = "fragment_counts"
#: The text of a record that has more or fewer fields than the file has columns.
MALFORMED = "malformed"
#: Of several records of one company the last of these is taken.
ORDER = ("file_time", "file_name", "file_block_start", "record")


def stream_fragments(
    spark: SparkSession,
    folder: str,
    files_per_batch: int | None = None,
    clean_source: str = "off",
    archive: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """New CSV files of ``folder`` as a stream with table names and the place in the file.

    ``clean_source`` may be ``delete`` or ``archive`` to clear handled files.
    """
    reader = (
        spark.readStream.schema(T.StructType([*FILE_SCHEMA.fields, T.StructField(MALFORMED, T.StringType())]))
        .options(**READ_OPTIONS)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("multiLine", multi_line)
        .option("cleanSource", clean_source)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    raw = reader.csv(folder)
    place = ["_metadata.file_modification_time", "_metadata.file_name", "_metadata.file_block_start"]
    return raw.select("*", *place).toDF(*REGISTER_NAMES, MALFORMED, *ORDER[:3])


def ingest_fragments(
    spark: SparkSession,
    folder: str,
    store: Snapshots,
    checkpoint: str,
    as_of: dt.datetime | dt.date,
    run: str,
    files_per_batch: int | None = None,
    clean_source: str = "off",
    archive: str | None = None,
    multi_line: bool = True,
    count_codes: bool = False,
) -> DataFrame:
    """Merge all files not seen before into the register; return its newest version.

    Where the store lays the register out in parts of its key, a batch reads and
    writes the parts that it touches. Otherwise each batch writes the register anew, so
    few large batches cost less than many small ones: leave ``files_per_batch`` open
    unless memory or a wish for early results says otherwise. The result does not
    depend on it: for a company that occurs twice, the newest file wins, and within a
    file the last record.

    A batch is parsed once, into a landing folder beside the tables, and merged
    from there. Every stream has two such folders in turn, so the landing of the batch
    before stays readable while one is written. The checkpoint remembers handled files;
    its identity and the batch number name the version, so a batch that is played again
    after a failure changes nothing, and a new checkpoint never passes for one that is done.

    With ``count_codes`` the codes of active companies are counted from the batch, per
    file, into the table ``fragment_counts``. A file that comes again under the same
    ``run`` replaces its own counts.

    Records without a company number, and malformed ones (more or fewer fields than
    columns) with their text, go to ``register_rejects``, one version per batch that
    has any; they never touch the register.
    """

    def merge(batch: DataFrame, number: int) -> None:
        stream = spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0]
        name = f"{run}/{json.loads(stream)['id']}/{number}"
        if store.finished(REGISTER, name):
            return
        landing = f"{store.root}/_landing/{json.loads(stream)['id']}/{number % 2}"
        landed = land(batch.withColumn(ORDER[3], F.monotonically_increasing_id()), landing)
        bad = F.col(KEY).isNull() | F.col(MALFORMED).isNotNull()
        rejects = landed.filter(bad)
        if not rejects.isEmpty():
            store.write(REJECTS, rejects, name)
        if count_codes:
            _write_counts(store, landed.filter(F.col(MALFORMED).isNull()), run, name)
        rows = landed.filter(~bad).drop(MALFORMED)
        parts = store.touched(REGISTER, rows) if REGISTER in store.parts else None
        target = store.read(REGISTER, empty_register(spark), parts=parts)
        merged = upsert_register(target, rows, as_of, source=F.col("file_name"), order=ORDER)
        store.write(REGISTER, merged.next, name, clustered=True, parts=parts)

    query = (
        stream_fragments(spark, folder, files_per_batch, clean_source, archive, multi_line)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return store.read(REGISTER, empty_register(spark))


def _write_counts(store: Snapshots, landed: DataFrame, run: str, name: str) -> None:
    """Put the batch's counts in the place of those that its files had before."""
    files = landed.select(F.lit(run).alias("release"), "file_name").distinct()
    parts = store.touched(FRAGMENT_COUNTS, files) if FRAGMENT_COUNTS in store.parts else None
    counts = codes.fragment_counts(landed, run)
    before = store.read(FRAGMENT_COUNTS, counts.limit(0), parts=parts)
    store.write(FRAGMENT_COUNTS, codes.replace_fragments(before, counts, files), name, parts=parts)
