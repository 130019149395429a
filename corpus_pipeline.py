"""A pipeline from raw documents to token files, in five stages.

Each stage is a function of (spark, docs, sf_dir) that works on all documents its
predecessor kept. ``run`` writes each stage's result as Parquet and reads it back for
the next. Documents with a null id are never dropped for being near copies or
contaminated, since such decisions are made by id; rows that repeat an id stay or go
together. An empty table gives an empty result, and columns beyond those the stages
read are passed on untouched.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weftgraph.llm.decontaminate import decontaminate
from weftgraph.llm.jaccard_join import jaccard_components
from weftgraph.llm.language import UNDETERMINED, identify, labelled_sample, learned
from weftgraph.llm.mixing import mixed, source_sizes, tempered_weights
from weftgraph.llm.queries import END_ID, TEMPER, TOKENIZER, VOCABULARY
from weftgraph.llm.token_files import read_token_files, write_token_files
from weftgraph.scratch import Scratch

# A text whose likeliest language has a lower probability than this is taken for none of them.
LEAST_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, and those no learned language fits. Without labels nothing is learned or dropped."""
    model = learned(*labelled_sample(docs))
    if not model.languages:
        return docs
    label, score = (name + "_" * (1 + max(map(len, docs.columns))) for name in ("label", "score"))
    found = identify(docs, model, keep=True, into=(label, score))
    kept = found.where((F.col(label) != UNDETERMINED) & (F.col(score) >= LEAST_SCORE))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by word shingles the one with the least id stays."""
    found = jaccard_components(docs, Scratch(spark))
    dropped = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents contaminated by items of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate(docs, items, Scratch(spark))
    return docs.join(found.where("contaminated").select("doc_id"), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: by file name, and by place in the file."""
    scratch, sizes = Scratch(spark), source_sizes(docs)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Whole texts move, so a range is a share of the rows that a task is given elsewhere too.
    rows = -(-sum(sizes.values()) // partitions) or 1
    placed = mixed(docs, tempered_weights(sizes, TEMPER), scratch, sizes=sizes, rows_per_range=rows)
    ordered = placed.repartitionByRange(partitions, "slot", "place").sortWithinPartitions("slot", "place")
    return ordered.select("row.*")


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token files in the order of the mix and read them back: doc_id, start, n_tokens, ids_crc32."""
    scratch = Scratch(spark)
    path = scratch.folder("token_files")
    place = place_in_files(docs)
    write_token_files(docs, path, tokenizer_path(TOKENIZER), END_ID, VOCABULARY, place=place)
    return read_token_files(spark, path, scratch, VOCABULARY, as_digest=True)


def place_in_files(docs: DataFrame) -> Column | None:
    """A row's place in files written in order by Spark; none for rows that are not read from files."""
    try:
        docs.select("_metadata.file_name")
    except AnalysisException:
        return None
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).try_cast("bigint")
    return F.coalesce(part, F.lit(0)) * (1 << 40) + F.col("_metadata.row_index")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

# A trained network decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents below ``sf_dir``."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
