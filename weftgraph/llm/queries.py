"""One registered query per operator, over whole tables with production settings."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession, functions as F

from weftgraph.llm import merkle
from weftgraph.llm.decontaminate import decontaminate
from weftgraph.llm.exact_dedup import exact_dedup
from weftgraph.llm.jaccard_join import jaccard_components
from weftgraph.llm.language import held_out, identify, labelled_sample, learned
from weftgraph.llm.language_model import language_scores
from weftgraph.llm.license_scan import license_scan
from weftgraph.llm.minhash import near_duplicates
from weftgraph.llm.mixing import mixed, source_sizes, tempered_weights
from weftgraph.llm.spelling import spelling_variants, word_counts
from weftgraph.llm.substring_dedup import substring_dedup
from weftgraph.llm.suffix_dedup import suffix_dedup
from weftgraph.llm.token_files import read_token_files, write_token_files
from weftgraph.scratch import Scratch

TOKENIZER, VOCABULARY, END_ID = "byte_bpe_50k.json", 50_257, 2

# Between equal shares of the sources (0) and shares by size (1).
TEMPER = 0.7


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "source")
    sizes = source_sizes(documents)
    placed = mixed(documents, tempered_weights(sizes, TEMPER), Scratch(spark), sizes=sizes)
    return placed.select("row.doc_id", "row.source", "source_block", "slot", "place")


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = learned(*labelled_sample(documents))
    found = identify(documents, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_dedup(_table(spark, folder, "documents"), Scratch(spark), as_digest=True)
    return found.withColumnRenamed("kept", "kept_sha256").drop("spans")


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), Scratch(spark))


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup(_table(spark, folder, "documents"), Scratch(spark), as_digest=True)
    spans = F.size("spans").cast("bigint").alias("n_spans")
    return found.select("doc_id", "n_bytes", "n_removed", spans, F.col("kept").alias("kept_sha256"))


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(_table(spark, folder, "documents"), Scratch(spark))


def op7_language_model(spark: SparkSession, folder: str) -> DataFrame:
    found = language_scores(_table(spark, folder, "documents"), Scratch(spark))
    return found.withColumnsRenamed({"score": "bigram_score", "class_score": "score"})


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark)
    path = scratch.folder("token_files")
    documents = _table(spark, folder, "documents")
    write_token_files(documents, path, tokenizer_path(TOKENIZER), END_ID, VOCABULARY)
    return read_token_files(spark, path, scratch, VOCABULARY, as_digest=True)


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(_table(spark, folder, "documents"), Scratch(spark))


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    # Its SQL gives no row where a text has fewer shingles than a template.
    return license_scan(_table(spark, folder, "documents"), short_texts=False)


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark)
    words = word_counts(_table(spark, folder, "documents"), least=6, least_count=5, damage=199)
    return spelling_variants(scratch.keep(words, "words"), scratch)


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    tampered = {"n_chars": F.when(chosen, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    found = merkle.manifest(documents, Scratch(spark), ["doc_id", "source", "lang", "n_chars", "text"], changed=tampered)
    refolded = found.withColumn("folded_root", merkle.folded(F.col("changed_leaf"), F.col("path")))
    return refolded.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.sha256(merkle.siblings(F.col("path"))).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"), Scratch(spark))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": op1_mixing,
        "op3_decontaminate": op3_decontaminate,
        "op2_substring_dedup": op2_substring_dedup,
        "op4_language": op4_language,
        "op5_suffix_dedup": op5_suffix_dedup,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_language_model": op7_language_model,
        "op8_token_files": op8_token_files,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_license_scan": op10_license_scan,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_minhash_dedup": op13_minhash_dedup,
    }
