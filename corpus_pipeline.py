"""A corpus from documents to packed training sequences, one corpus operator per stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, language, packing, secret_scan, simhash
from millrace.llm.work import forget, stored, written

TOKENIZER = "word_bpe_49k.json"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; null texts, texts without letters and unknown ones go."""
    return language.keep_identified(docs, language.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; n_chars follows the text."""
    cleaned = secret_scan.redact(docs, secret_scan.train(docs))
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("secret_scans", redact_secrets),
    ("packing", pack_sequences),
]
#: Models, fingerprints and tokenizers have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each reads what the one before has written.

    What a stage has written on its way, and the documents it has read, go when its own are there.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mark = written()
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        forget(spark, mark, keep=1)
    return STAGES[-1][1](spark, docs, sf_dir)
