"""A training corpus from raw documents: filter, deduplicate, mix and tokenize.

Every stage takes ``(spark, docs, folder)`` and returns a DataFrame; ``run`` writes
each stage's rows as Parquet below the shared checkpoint folder and reads them again
for the next.  Stages but the last return the columns of ``documents``; rows keep all
of their columns.  The last returns a row for each document of the mix, repeats
included: ``doc_id``, ``lang``, ``source``, ``n_tokens`` and ``ids`` (little-endian
unsigned 32-bit token ids).

The quality model learns from ``labels`` as far as its documents are among the stage's
own input.  Rows with null, empty or repeated texts and ids go through as the
operators' docstrings say; empty tables give empty tables.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.bpe import encode_texts
from millrace.llm.exact_dedup import drop_copies
from millrace.llm.mixing import mixed_documents
from millrace.llm.quality import keep_good, train_quality
from millrace.llm.simhash import drop_near_duplicates
from millrace.session import checkpoint_folder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
QUALITY_THRESHOLD = 0.3
SHINGLE_WORDS = 3
SIMHASH_BITS = 3

#: A learned classifier, a bit-majority hash and BPE cannot be said in SQL.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{folder.rstrip('/')}/labels.parquet")
    return keep_good(docs, train_quality(docs, labels), QUALITY_THRESHOLD)


def exact_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of every group of equal texts."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of every group linked by SimHash."""
    return drop_near_duplicates(docs, shingle=SHINGLE_WORDS, radius=SIMHASH_BITS)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that the mix takes, once for every time."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every document of the mix."""
    encoded = encode_texts(docs, VOCABULARY, ["doc_id", "lang", "source"])
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("encode", encode),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")
    place = f"{checkpoint_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        written = f"{place}/{number}-{name}"
        stage(spark, docs, folder).write.parquet(written)
        docs = spark.read.parquet(written)
    return docs
