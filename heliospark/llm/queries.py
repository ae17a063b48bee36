"""Registered queries of this subpackage: (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, fingerprint, hnsw, htmlcut, minhash, mixing, packing, pii, ranked, repair, secret_scan, suffix, toxicity
from .common import read


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip_report(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_report(read(spark, sf_dir, "documents"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes_report(read(spark, sf_dir, "documents"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeats_report(read(spark, sf_dir, "documents"))


def op6_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(read(spark, sf_dir, "embeddings"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmlcut.page_texts(read(spark, sf_dir, "pages"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data_report(read(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.packed_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_findings(read(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.conversations_report(read(spark, sf_dir, "conversations"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_fingerprint": op3_fingerprint,
    "op4_minhash": op4_minhash,
    "op5_repeats": op5_repeats,
    "op6_embedding_links": op6_embedding_links,
    "op7_html_text": op7_html_text,
    "op8_personal_data": op8_personal_data,
    "op9_packing": op9_packing,
    "op10_secret_scan": op10_secret_scan,
    "op11_ranked_search": op11_ranked_search,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_mixing": op13_mixing,
}
# The other operators are not expressible in DuckDB SQL within reach; each is
# tested against brute force, a round trip or held-out accuracy in tests/llm.
ORACLES: dict[str, str] = {
    "op11_ranked_search": ranked.RANKED_SQL,
    "op12_conversation_repair": repair.REPAIR_SQL,
    "op13_mixing": mixing.MIX_SQL,
}
