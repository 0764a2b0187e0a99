"""From raw documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the shared folder and
reads it again for the next. The first four return the columns of ``docs``, the last one the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from newsweave.llm.decontamination import drop_contaminated
from newsweave.llm.language_id import keep_identified
from newsweave.llm.line_dedup import drop_repeated_lines
from newsweave.llm.minhash_dedup import drop_near_duplicates
from newsweave.llm.packing import pack, pieces
from newsweave.session import cut, tune


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language."""
    tune(spark)
    return keep_identified(docs)


def dedupe_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat, up to one edit, an earlier line."""
    tune(spark)
    return drop_repeated_lines(docs)


def dedupe_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    tune(spark)
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    tune(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequences and places there."""
    tune(spark)
    return pack(pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedupe_lines),
    ("minhash_dedup", dedupe_documents),
    ("decontamination", decontaminate),
    ("packing", pack_sequences),
]

#: Context trees, edit distances and genetic packing are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
