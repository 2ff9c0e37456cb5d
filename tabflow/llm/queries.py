"""The registered queries of the training-data operators: each applies its
operator with production parameters to the whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm.common import crc32_of_id, read_table, scratch_path
from tabflow.llm.decontamination import benchmark_matches
from tabflow.llm.line_dedup import build_index, dedup_lines
from tabflow.llm.manifest import fold, leaf_digest, manifest, proof_digest
from tabflow.llm.minhash import Similarity, near_duplicates
from tabflow.llm.mixing import measure, mix
from tabflow.llm.packing import pack_documents
from tabflow.llm.pseudonyms import pseudonymize
from tabflow.llm.quality_classifier import score, train, training_rows
from tabflow.llm.quality_rules import quality_rules
from tabflow.llm.resharding import reshard, slots, write_layout
from tabflow.llm.spelling import LOWER, UPPER, corrupted_words, variants, vocabulary
from tabflow.llm.token_counts import length_histogram, token_lengths
from tabflow.llm.token_files import file_offsets, read_tokens, write_tokens

# The key of the registered query; a real run passes a secret of its own.
PSEUDONYM_KEY = "tabflow"

# Fixed values of the query contracts.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SHARDS = 8
NEAR = Similarity(shingle_words=3, percent=85)
FOLDS, HELD_OUT_FOLD = 5, 0
QUALITY_THRESHOLD = 0.3
FILE_END_ID = 0
PACK_END_ID = 2
SEQUENCE_TOKENS = 1024
SOURCE_WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
TAMPERED_ONE_IN = 3

# Quality weights of the mix, by labels.quality; documents without a label stand between.
GOOD, UNLABELLED, POOR = 2.0, 1.0, 0.5
MIX_SEED = 11


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old layout deals whole sources to the shards, so a hot source makes
    one of them heavy; the new one gives all shards the same bytes."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    old = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(SHARDS))
    layout = write_layout(docs, old, scratch_path(spark, "layout-old"))
    placed = slots(reshard(layout, SHARDS, SHARDS))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymize(read_table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), NEAR)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram(token_lengths(read_table(spark, sf_dir, "documents"), TOKENIZER))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = F.pmod(crc32_of_id(F.col("doc_id")), F.lit(FOLDS)) == HELD_OUT_FOLD
    model = train(training_rows(docs, labels, "quality", ~held_out))
    return score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_tokens(read_table(spark, sf_dir, "documents"), path, TOKENIZER, FILE_END_ID)
    return (
        read_tokens(spark, path)
        .join(file_offsets(spark, path), "file")
        .select("doc_id", (F.col("file_start") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32")
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, build_index(docs)).select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), TOKENIZER, PACK_END_ID, SEQUENCE_TOKENS)


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that ``labels`` marks as good are drawn first more often, those
    it marks as poor less often."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    labels = read_table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    weight = F.when(F.col("quality") == 1, GOOD).when(F.col("quality") == 0, POOR).otherwise(UNLABELLED)
    weighted = measure(docs, MIX_SEED).join(labels, "doc_id", "left").withColumn("weight", weight)
    mixed = mix(weighted, SOURCE_WEIGHTS, MAX_EPOCHS)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(corrupted_words(read_table(spark, sf_dir, "documents"))))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    fields = lambda text: [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    tampered = F.pmod(crc32_of_id(F.col("doc_id")), F.lit(TAMPERED_ONE_IN)) == 0
    rows = docs.select(
        "doc_id",
        "lang",
        leaf_digest(fields(F.col("text"))).alias("leaf"),
        leaf_digest(fields(F.when(tampered, F.translate("text", UPPER, LOWER)).otherwise(F.col("text")))).alias("seen"),
    )
    folded = fold(F.col("seen"), F.col("path"))
    return manifest(rows, "lang", ["doc_id"]).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_resharding": op2_resharding,
    "op3_quality_rules": op3_quality_rules,
    "op4_pseudonyms": op4_pseudonyms,
    "op5_minhash": op5_minhash,
    "op6_token_counts": op6_token_counts,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_token_files": op8_token_files,
    "op9_line_dedup": op9_line_dedup,
    "op10_packing": op10_packing,
    "op11_mixing": op11_mixing,
    "op12_spelling": op12_spelling,
    "op13_manifest": op13_manifest,
}
