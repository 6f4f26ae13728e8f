"""A corpus pipeline: documents go in, clean and encoded documents come out.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it
kept; ``run`` writes what a stage returns as Parquet and reads it for the next. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import bpe, decontaminate, minhash, suffix_dedup, toxicity
from rollbook.llm.common import checked_broadcast, write_scratch

RANK_FILE = "byte_bpe_50k.tiktoken"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _rows_of(docs: DataFrame) -> DataFrame:
    """The columns of ``documents`` alone, so that no other name can clash."""
    return docs.select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out the documents whose score is 0.5 or more; the labels are learned from the rows given."""
    docs = _rows_of(docs)
    model = toxicity.fit(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.predict(docs, model).where("predicted = 0").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies (five words, similarity 0.8): the one with the smallest id.

    A row is named by its id and its text: unlike texts under one id all stay, of rows equal
    in both one stays. Rows without an id are named by their text alone and come after all
    ids; those of them that have no words either all stay.
    """
    docs = _rows_of(docs).withColumn("mark", F.xxhash64("text"))
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark").alias("row")
    found = minhash.near_groups(docs.select("doc_id", "text"), width=5, percent=80).select("component", row)
    found = write_scratch(found, "near_rows")
    linked = found.where("component IS NOT NULL")
    first = linked.groupBy("component").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = checked_broadcast(write_scratch(first.drop("n"), "near_first"), minhash.BROADCAST_IDS)
    dropped = linked.join(first, "component").where(~F.col("row").eqNullSafe(F.col("first"))).select("row.doc_id", "row.mark").distinct()
    dropped = checked_broadcast(write_scratch(dropped, "near_dropped"), minhash.BROADCAST_IDS)
    kept = docs.join(dropped, minhash.same_row(docs, dropped), "left_anti")
    bare = F.col("doc_id").isNull() & ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    bare_rows, kept = kept.where(bare).select(*COLUMNS), kept.where(~bare)
    # Only rows that are there several times are brought together; the others pass by.
    repeated = found.groupBy("row").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("row.doc_id", "row.mark")
    repeated = checked_broadcast(write_scratch(repeated, "near_repeated"), minhash.BROADCAST_IDS)
    single = kept.join(repeated, minhash.same_row(kept, repeated), "left_anti").select(*COLUMNS)
    several = kept.join(repeated, minhash.same_row(kept, repeated), "left_semi")
    # The least of the other columns, so that a repeated task keeps the same row.
    several = several.groupBy("doc_id", "mark").agg(F.min(F.struct("lang", "source", "n_chars", "text")).alias("row")).select("doc_id", "row.*")
    return single.unionByName(several.select(*COLUMNS)).unionByName(bare_rows)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out the bytes of long repeated passages; texts that have none stay as they are.

    A cut within a character leaves out what is left of that character. ``n_chars``
    follows the text; a null text stays null, and a text that is cut wholly is empty.
    """
    cut = suffix_dedup.remove_repeats(_rows_of(docs), as_text=True)
    whole = F.col("n_removed") == 0
    size = F.when(whole, F.col("n_chars")).otherwise(F.length("kept_text").cast("bigint"))
    return cut.select("doc_id", F.when(whole, F.col("text")).otherwise(F.col("kept_text")).alias("text"), "lang", "source", size.alias("n_chars"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out the rows, by id and text, with a window that matches a benchmark item."""
    docs = _rows_of(docs).withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    found = decontaminate.contaminated_texts(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(found, minhash.same_row(docs, found), "left_anti").select(*COLUMNS)


def encode_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every text and decode it again: ids, their number, and whether the round trip is exact."""
    ranks = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    decoded = bpe.round_trip(_rows_of(docs), ranks, public_tokenizers.PATTERN)
    exact = F.col("bytes") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return decoded.select("doc_id", "lang", "source", "n_chars", "ids", F.size("ids").cast("bigint").alias("n_tokens"), exact.alias("exact"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("byte_level_bpe", encode_text),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each one's rows written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_scratch(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: A trained classifier and sketches are not expressible in SQL; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None
