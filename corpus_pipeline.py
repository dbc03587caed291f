"""From raw documents to packed training sequences.

Each stage works on all that the one before it kept, written as Parquet in
between.  Stages have their own scales of judgement: quality drops documents,
line dedup edits them, near-dedup keeps one of each class, mixing repeats or
leaves out documents, packing turns them into placed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import line_dedup, minhash, mixing, packing, quality
from orderlake.llm.common import materialize

CAPACITY = 4096
TOKENIZER = "word_bpe_49k.json"
#: No stage can be written in SQL (EM, alignment, MinHash classes, a dynamic
#: program, a tokenizer); tests/llm compares run() with brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality is at least one half."""
    return quality.keep_good(docs)


def line_blocks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of 50 words or more that an earlier document holds are deleted;
    a document of which nothing is left goes."""
    out = line_dedup.clean_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate class."""
    return minhash.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, 0 to 3 times."""
    return mixing.take_mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequence and place."""
    pieces = packing.tokenized_pieces(docs, public_tokenizers.path(TOKENIZER), CAPACITY)
    return packing.best_fit_pack(pieces, CAPACITY)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_blocks),
          ("minhash_near_dedup", near_duplicates), ("source_mix", source_mix),
          ("best_fit_packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
