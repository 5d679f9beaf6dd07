"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) with the columns of ``documents`` and returns a DataFrame that is written as
Parquet and read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm.common import DOCUMENT_COLUMNS, delete_folder, read_table, shared_folder
from gridloom.llm.exact_dedup import deduplicate
from gridloom.llm.language import keep_known_languages
from gridloom.llm.near_dedup import keep_one_of_each
from gridloom.llm.packing import pack_documents
from gridloom.llm.queries import tokenizer_file
from gridloom.llm.secrets import redact


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with it where they had none; those without letters, junk and languages that were not learned go."""
    return keep_known_languages(docs.select(*DOCUMENT_COLUMNS))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the smallest id."""
    return deduplicate(docs.select(*DOCUMENT_COLUMNS), keep="smallest")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8), the one with the smallest id."""
    return keep_one_of_each(docs.select(*DOCUMENT_COLUMNS))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and offset, in sequences of at most 2048 tokens."""
    return pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("secret_scan", secret_stage),
    ("best_fit_packing", packing_stage),
]

#: Language profiles and similarity of whole sets have no SQL form; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what lies between two stages is written to the shared folder, and goes when the next stage is written."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    done = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if done:
            delete_folder(spark, done)
        done = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
