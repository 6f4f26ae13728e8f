"""The queries of this package on the given tables, and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import ann, bpe, decontaminate, language_id, licenses, minhash, runs, sharding, suffix_dedup, syncmers, token_counts, toxicity, whitening
from rollbook.llm.common import crc32_mod

SHARDS = 8
RANK_FILE = "byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), lambda key: key % 100 == 0)


def op2_suffix_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = suffix_dedup.remove_repeats(docs)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op3_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = {shard: 1.0 for shard in range(SHARDS + 1)}
    shards = {shard: even[shard] for shard in range(SHARDS)}
    return sharding.shard_table(_table(spark, sf_dir, "documents"), shards, even)


def op6_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN).drop("text")
    return bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op7_dice_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(_table(spark, sf_dir, "documents"))


def op8_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four edits of every document, derived from the document itself: a replacement, an insertion, an
    addition at the end, a deletion at the start."""
    ranks = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.length(text)
    third, half = F.floor(size / 3).cast("int"), F.floor(size / 2).cast("int")

    def edit(start, stop, new):
        return F.struct(start.alias("start"), stop.alias("stop"), new.alias("text"))

    edits = F.array(
        edit(third, third + 7, F.substr(text, 2 * third + 1, F.lit(11))),
        edit(half, half, F.concat(F.lit(" "), F.coalesce(F.col("source"), F.lit("")))),
        edit(size + 1000, size + 1000, F.concat(F.lit("\n"), F.coalesce(F.col("lang"), F.lit("")), F.lit(" "), F.crc32(text.cast("binary")).cast("string"))),
        edit(F.lit(0), F.lit(3), F.lit("")),
    )
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", edits.alias("edits"))
    return token_counts.count_tokens(docs, ranks, public_tokenizers.PATTERN).drop("text", "edits")


def op9_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc32_mod(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.predict(docs.withColumn("held_out", held_out), model).drop("text")


def op10_output_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc32_mod(F.col("doc_id"), 4) == 2
    model = language_id.fit(docs.where(~held_out))
    return language_id.predict(docs.drop("lang").withColumn("held_out", held_out), model).drop("text")


def op11_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = syncmers.edited_fingerprints(_table(spark, sf_dir, "documents"))
    return found.withColumn("edited_sha256", F.sha2("edited_text", 256)).drop("edited_text")


def with_tiled_words(docs: DataFrame) -> DataFrame:
    """The documents with the words of every tenth, by the hash of its id, laid out as repeats of a few of them.

    A document without an id or without words stays as it is.
    """
    key = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    step = F.floor(key / 10)

    def tiled(found):
        n = F.size(found)
        first = F.pmod(step, n).cast("int")
        period = (1 + F.floor((n - first) / (3 + F.pmod(step, F.lit(8))))).cast("int")
        return F.array_join(F.transform(found, lambda word, i: F.when(i < first, word).otherwise(found[first + F.pmod(i - first, period)])), " ")

    tile = F.when(key % 10 == 0, words)
    rows = docs.select("doc_id", "text", tile.alias("words"))
    return rows.select("doc_id", F.when(F.size("words") > 0, tiled(F.col("words"))).otherwise(F.col("text")).alias("text"))


def op12_descending_lcp(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_tiled_words(_table(spark, sf_dir, "documents")))

    def better(best, run):
        """The run of the greater exponent; of equal ones the first, as runs come by start and period."""
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    found = found.withColumn("best", F.aggregate("runs", none, better))
    lines = F.transform("runs", lambda run: F.concat_ws(",", run["start"].cast("string"), run["length"].cast("string"), run["period"].cast("string")))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_qdwh(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whole_vectors(_table(spark, sf_dir, "embeddings"))
    vectors = whitening.fit_list(rows)
    model = whitening.fit(vectors)
    error = whitening.identity_error(vectors, model) if model else 0.0
    return whitening.whiten(rows, model).select(
        F.col("key").alias("vec_id"), "component", F.lit(model.count if model else 0).cast("long").alias("n"),
        "deviation", "whitened", "explained", F.lit(error).alias("identity_error"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_kmeans_tree,
        op2_suffix_levels,
        op3_simhash_windows,
        op4_odd_sketch,
        op5_rendezvous,
        op6_merge_replay,
        op7_dice_bigrams,
        op8_edit_counts,
        op9_ftrl,
        op10_output_codes,
        op11_closed_syncmers,
        op12_descending_lcp,
        op13_qdwh,
    )
}

ORACLES: dict[str, str] = {
    "op3_simhash_windows": decontaminate.oracle(),
    "op5_rendezvous": sharding.oracle(SHARDS),
    "op7_dice_bigrams": licenses.oracle(),
}
