"""Token ids in Parquet: list columns whose pages can be read selectively.

Documents are range-partitioned by id, so a file holds a run of ids in ascending order. Each row has
doc_id, n_tokens and ids. The ids are dictionary-encoded (a vocabulary fits one dictionary
page, so an id takes as many bits as the vocabulary of the row group needs); doc_id and n_tokens
are delta-encoded (format version 2). Row groups and pages are small enough to skip:
a filter on doc_id or n_tokens drops row groups by their statistics and pages by the page index, and
a reader of the metadata columns alone never touches the ids.

Defined cases: a null text is empty and has only its end token; a null doc_id sorts first; rows with
equal ids keep one after the other; columns beside id and text are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caudal.llm.shared import in_batches, scratch
from caudal.llm.tokens import library_cache

LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "500",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}


def id_lists(encoded: list[bytes]) -> pa.Array:
    """Byte strings of unsigned 32-bit integers as an Arrow list array."""
    offsets = np.cumsum([0, *(len(ids) // 4 for ids in encoded)]).astype("<i4")
    values = np.frombuffer(b"".join(encoded), "<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, keeps_space: bool, end_id: int) -> None:
    """Encode (doc_id, text), append `end_id` to each document and write the files."""
    end = np.array([end_id], "<u4").tobytes()

    def each(columns):
        encoded = [ids + end for ids in library_cache(tokenizer, keeps_space).ids(columns["text"])]
        yield {"doc_id": columns["doc_id"], "n_tokens": [len(ids) // 4 for ids in encoded],
               "ids": id_lists(encoded)}

    # The hash of the text splits the rows of one id (or none) over several tasks.
    ordered = (docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("split"))
               .repartitionByRange("doc_id", "split").sortWithinPartitions("doc_id", "split").drop("split"))
    in_batches(ordered, each, "doc_id long, n_tokens long, ids array<int>").write.options(**LAYOUT).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id long, n_tokens long, ids array<int>").parquet(path)


def token_starts(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32, in the order of the files.

    Each file's total is one row; running sums over these rows and within each file give the start.
    """
    read = read_tokens(spark, path).select(
        "doc_id", "ids", F.col("_metadata.row_index").alias("place"),
        F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long").alias("file"))

    def each(columns):
        lists = columns.pop("ids")
        data = [np.asarray(ids, "<u4").tobytes() for ids in lists]
        yield {"doc_id": columns["doc_id"], "place": columns["place"], "file": columns["file"],
               "n_tokens": [len(ids) // 4 for ids in data],
               "ids_crc32": [zlib.crc32(ids) for ids in data]}

    rows = in_batches(read, each,
                      "doc_id long, place long, file long, n_tokens long, ids_crc32 long")
    before = (read_tokens(spark, path)
              .groupBy(F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long").alias("file"))
              .agg(F.sum("n_tokens").alias("total"))
              .select("file", (F.sum("total").over(Window.orderBy("file")) - F.col("total")).alias("before")))
    running = F.sum("n_tokens").over(Window.partitionBy("file").orderBy("place"))
    return (rows.withColumn("start", running - F.col("n_tokens")).join(before, "file")
            .select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))


def token_file_digest(docs: DataFrame, tokenizer: str, keeps_space: bool, end_id: int) -> DataFrame:
    """Write the files to the shared folder and report what they hold."""
    path = scratch(docs.sparkSession)
    write_tokens(docs, path, tokenizer, keeps_space, end_id)
    return token_starts(docs.sparkSession, path)
