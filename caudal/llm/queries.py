"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from caudal.llm.bpe import bpe_digest
from caudal.llm.exact_dedup import exact_dedup
from caudal.llm.lm_scoring import lm_scores
from caudal.llm.merkle import merkle_manifest
from caudal.llm.near_dedup import near_duplicates
from caudal.llm.packing import pack_documents
from caudal.llm.quality import quality
from caudal.llm.shared import prepare, table
from caudal.llm.simhash import simhash_duplicates
from caudal.llm.spelling import spelling_variants
from caudal.llm.suffix_dedup import repeated_passages
from caudal.llm.token_files import token_file_digest
from caudal.llm.toxicity import toxicity
from caudal.llm.warc import archived_pages


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return bpe_digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(prepare(spark), sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(prepare(spark), sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(prepare(spark), sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(prepare(spark), sf_dir, "documents")).drop("row")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return token_file_digest(docs, public_tokenizers.path("word_bpe_49k.json"), keeps_space=False, end_id=2)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return lm_scores(docs, public_tokenizers.path("byte_bpe_50k.json"), vocabulary_size=50257)


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(prepare(spark), sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(prepare(spark), sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(table(prepare(spark), sf_dir, "documents"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(table(prepare(spark), sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_quality": op3_quality,
    "op4_warc": op4_warc,
    "op5_toxicity": op5_toxicity,
    "op6_packing": op6_packing,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_token_files": op8_token_files,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_near_dedup": op10_near_dedup,
    "op11_spelling": op11_spelling,
    "op12_merkle": op12_merkle,
    "op13_simhash": op13_simhash,
}
