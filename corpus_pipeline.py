"""The training-data pipeline: five stages over the documents table.

STAGES lists (name, function); a function takes (spark, docs, sf_dir), where
docs is what the stage before kept, and returns what it keeps. All but the last
return the columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliospark.llm import minhash, packing, secret_scan, suffix, toxicity
from heliospark.llm.common import batches_by_bytes, read, stored

CAPACITY = 2048
# Fifty words are hardly shorter; chance repeats of the words' order are.
REPEAT_BYTES = 200


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a text that a stage has changed."""
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    batches_by_bytes(spark)
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, the one of least doc_id."""
    batches_by_bytes(spark)
    return minhash.without_near_copies(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of REPEAT_BYTES that repeat anywhere are cut out; every document stays."""
    batches_by_bytes(spark)
    return _recounted(suffix.without_repeats(docs, length=REPEAT_BYTES))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are masked; every document stays."""
    batches_by_bytes(spark)
    return _recounted(secret_scan.mask_secrets(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as pieces of packed sequences."""
    batches_by_bytes(spark)
    return packing.packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), CAPACITY)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("suffix_repeats", cut_repeats),
    ("secrets", mask_secrets),
    ("packing", pack),
]

# Trained scores, sketches and search have no SQL form; tests/llm compares the
# stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
