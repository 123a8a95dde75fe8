"""Exact dedup by block naming: equal texts get one integer identity that no other text has.

A text, with A-Z lower-cased, is cut into blocks of a fixed number of bytes. All distinct blocks are
sorted and numbered; then adjacent numbers are paired, the distinct pairs sorted and numbered
again, and so on until each text is one number of one level. Two texts have the same level and
number exactly if they are equal, whatever the hash function does:

* Blocks sort by their 64-bit hash. A hash that one block alone has needs no content. The contents
  behind a hash of several blocks are compared, and where they differ an ordinal (by sorted
  content) joins the sort key.
* Pairs of numbers are compared as they are.

What is shuffled: hashes, numbers, and the distinct contents (of each task) of blocks whose hash occurs again. A bitmap of the
repeated hashes, of fixed size, picks these where they are read. The sort keys are distinct before they
are sorted, so a text that a third of all rows share is one key; rows get their numbers by joins
that adaptive execution can split.

Defined cases: a null text counts as empty; equal rows are separate documents, of which the one with the
largest id stays (a null id is smallest, and of rows with the same id one stays); columns beside
id and text are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.shared import bitmap_of, in_batches, in_bitmap, keyed_join, scope, staged

BLOCK_BYTES = 8192


def fingerprint(block: bytes) -> int:
    """64-bit hash of a block as a signed integer."""
    value = xxhash.xxh3_64_intdigest(block)
    return value - (1 << 64) if value >= 1 << 63 else value


def _blocks(text: str | None, size: int) -> tuple[bytes, list[bytes]]:
    data = (text or "").encode().lower()  # bytes.lower() changes A-Z only
    return data, [data[i:i + size] for i in range(0, len(data), size)] or [b""]


def _heads(docs: DataFrame, size: int, hashed: Callable[[bytes], int],
           contents: bool = False) -> DataFrame:
    """One row per block: its document, place and hash; the text's digest is with the first."""
    def each(columns):
        out = {k: [] for k in ("row", "doc_id", "blocks", "pos", "hash", "sha", "block")}
        for row, doc_id, text in zip(columns["row"], columns["doc_id"], columns["text"], strict=True):
            data, blocks = _blocks(text, size)
            for pos, block in enumerate(blocks):
                out["row"].append(row)
                out["doc_id"].append(doc_id)
                out["blocks"].append(len(blocks))
                out["pos"].append(pos)
                out["hash"].append(hashed(block))
                out["sha"].append(None if pos else hashlib.sha256(data).hexdigest())
                out["block"].append(block if contents else None)
        yield out

    return in_batches(docs, each,
                      "row long, doc_id long, blocks long, pos long, hash long, sha string, block binary")


def _contents(docs: DataFrame, size: int, hashed: Callable[[bytes], int], wanted) -> DataFrame:
    """Distinct blocks of each batch whose hash has its bit set in `wanted`."""
    def each(columns):
        found = {block: hashed(block) for text in columns["text"] for block in _blocks(text, size)[1]}
        named = in_bitmap(wanted.value, np.array(list(found.values()), np.int64))
        found = {block: value for (block, value), keep in zip(found.items(), named.tolist(), strict=True) if keep}
        yield {"hash": list(found.values()), "block": list(found)}

    return in_batches(docs, each, "hash long, block binary", "text")


def _ordinals(docs: DataFrame, heads: DataFrame, size: int,
              hashed: Callable[[bytes], int]) -> DataFrame:
    """(hash, block, ordinal) of all hashes that different blocks share; nearly always empty."""
    repeated = staged(heads.groupBy("hash").count().filter("count > 1").select("hash"))
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap_of(repeated, "hash"))
    # Distinct first: a task sends a block that all its rows share once.
    contested = _contents(docs, size, hashed, wanted).distinct().join(repeated, "hash", "left_semi")
    several = contested.groupBy("hash").count().filter("count > 1").select("hash")
    by_content = Window.partitionBy("hash").orderBy("block")
    return (contested.join(several, "hash", "left_semi")
            .withColumn("ordinal", F.row_number().over(by_content)))


def name_keys(rows: DataFrame, keys: list[str], name: str = "name") -> DataFrame:
    """Number the distinct keys in sorted order and add its number to each row.

    The number of a key is its partition in the range-partitioned order and its place there.
    """
    names = staged(rows.select(*keys).distinct()
                   .repartitionByRange(*keys).sortWithinPartitions(*keys)
                   .withColumn(name, F.monotonically_increasing_id()))
    return keyed_join(rows, names, keys)


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES,
               hashed: Callable[[bytes], int] = fingerprint, number: str | None = None) -> DataFrame:
    """(doc_id, row, level, name, sha) of each row of (doc_id, text); `number` is a column that numbers the rows."""
    row = F.col(number) if number else F.monotonically_increasing_id()
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text"), row.alias("row"))
    with scope() as work:
        heads = staged(_heads(docs, block_bytes, hashed), "zstd")
        ordinals = staged(_ordinals(docs, heads, block_bytes, hashed))
        most = heads.agg(F.max("blocks")).first()[0] or 1
        first = heads.filter("pos = 0").select("row", "doc_id", "sha")
        keys = ["hash"]
        rows = heads
        if not ordinals.isEmpty():
            # Read again for the contents; places are those of the first reading, in the order of each text's blocks.
            keys = ["hash", "ordinal"]
            contents = staged(_heads(docs, block_bytes, hashed, contents=True), "zstd")
            first = contents.filter("pos = 0").select("row", "doc_id", "sha")
            rows = (keyed_join(contents, ordinals, ["hash", "block"], "left")
                    .withColumn("ordinal", F.coalesce("ordinal", F.lit(0))))
        rows = rows.select("row", "blocks", "pos", *keys)
        named = name_keys(rows, keys)
        level = staged(named.select("row", "blocks", "pos", "name"))
        done = level.filter("blocks = 1").select("row", F.lit(0).alias("level"), "name")
        depth = 0
        while most > 1:
            depth, most = depth + 1, (most + 1) // 2
            pairs = (level.filter("blocks > 1")
                     .groupBy("row", F.floor(F.col("pos") / 2).alias("pos"))
                     .agg(F.ceil(F.max("blocks") / 2).alias("blocks"),
                          F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
                          F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))),
                                     F.lit(-1)).alias("right")))
            named = name_keys(pairs, ["left", "right"])
            level = staged(named.select("row", "blocks", "pos", "name"))
            done = done.unionByName(
                level.filter("blocks = 1").select("row", F.lit(depth).alias("level"), "name"))
        return work.result(first.join(done, "row"), "zstd")


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES,
                hashed: Callable[[bytes], int] = fingerprint, number: str | None = None) -> DataFrame:
    """One row per row of (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256 (and `number`, if given)."""
    named = identities(docs, block_bytes, hashed, number)
    groups = named.groupBy("level", "name").agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    return keyed_join(named, groups, ["level", "name"]).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), F.col("sha").alias("text_sha256"),
        *([F.col("row").alias(number)] if number else []))
