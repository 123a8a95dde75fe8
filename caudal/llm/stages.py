"""The stages of corpus_pipeline.py: each takes (spark, docs, sf_dir) and returns a frame.

Stages decide for each row: they number the rows of their input, and the operators carry the numbers, so that
repeated rows and null ids are rows of their own. All stages but the last return the columns of `documents`.

What a stage returns reads its numbered input. This copy is deleted when the next stage begins, by which time the result
has been written; a stage that reads the copy as its own input keeps it.

Defined cases: null or empty texts pass the toxicity stage like any text without words; of equal texts with one id, or
none, one row stays; ties in the operators are decided as their docstrings say; very long texts are decided on as a whole; an empty
table stays empty; columns beside id, text, language and n_chars, whatever their names, are handed on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from caudal.llm.exact_dedup import exact_dedup
from caudal.llm.near_dedup import near_duplicates
from caudal.llm.packing import pack_documents
from caudal.llm.shared import leave, numbered, prepare, release, scope, staged, table, unused
from caudal.llm.suffix_dedup import remove_repeats
from caudal.llm.toxicity import toxicity


def _kept(docs: DataFrame, rejected) -> DataFrame:
    """The rows of `docs` that `rejected(docs, number)` does not give back; its rows are staged, so that their size is known."""
    number = unused(docs, "number")
    with scope() as work:
        docs = numbered(docs, number)
        dropped = staged(rejected(docs, number).select(number), "zstd")
        leave(work, docs, dropped)
    return docs.join(dropped, number, "left_anti").drop(number)


def _begin(spark: SparkSession, docs: DataFrame) -> None:
    prepare(spark)
    leave(None, docs)
    release(spark)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that reach the threshold of their language go."""
    _begin(spark, docs)
    labels = table(spark, sf_dir, "labels")
    return _kept(docs, lambda rows, number: toxicity(rows, labels, number=number).filter("flagged"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    _begin(spark, docs)
    return _kept(docs, lambda rows, number: exact_dedup(rows, number=number).filter("NOT kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates, the document with the smallest id stays."""
    _begin(spark, docs)
    return _kept(docs, lambda rows, number: near_duplicates(rows, percent=80, number=number).filter("NOT kept"))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay where they occur first."""
    _begin(spark, docs)
    with scope() as work:
        kept = remove_repeats(docs)
        leave(work)
    return kept


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    _begin(spark, docs)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
