"""What the operators of this subpackage share: staged tables, joins by hot keys, Arrow passes."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from caudal.session import configure

# Python workers hold one Arrow batch of documents at a time; these bound it by rows and by bytes.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Send this package to the executors once, as their Python path may not have it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="caudal-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings and code that all queries here rely on."""
    configure(spark)
    _ship(spark)
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder for intermediate tables below spark.checkpoint.dir.

    Without that setting a temporary folder serves where driver and executors are one process; a cluster
    must name a folder that all executors share.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="caudal-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/caudal-llm-{uuid.uuid4().hex}"


class Scope:
    """The staged tables of one piece of work, deleted at its end but for its result."""

    def __init__(self) -> None:
        self.folders: list[tuple[DataFrame, str]] = []

    def drop(self, *frames: DataFrame) -> None:
        """Delete staged tables that nothing will read again."""
        for frame, path in [pair for pair in self.folders if any(pair[0] is f for f in frames)]:
            self.folders = [pair for pair in self.folders if pair[1] != path]
            _delete(frame.sparkSession, path)

    def result(self, df: DataFrame, compression: str = "snappy") -> DataFrame:
        """The frame, staged for whoever asked for this work, which may delete it in turn."""
        df = staged(df, compression)
        self.folders, own = [pair for pair in self.folders if pair[0] is not df], self.folders
        if len(_scopes) > 1:
            _scopes[-2].folders += [pair for pair in own if pair[0] is df]
        return df


_scopes: list[Scope] = []


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scope() -> Iterator[Scope]:
    """Tables that are staged inside belong to the scope; it deletes them when it ends, also by an error."""
    own = Scope()
    _scopes.append(own)
    try:
        yield own
    finally:
        _scopes.pop()
        own.drop(*(frame for frame, _ in own.folders))


_left: list[tuple[DataFrame, str]] = []


def leave(work: Scope | None, *frames: DataFrame) -> None:
    """Take staged tables out of a scope (all of them, if none are named): they outlive it, until the next stage begins.

    Without a scope this is the beginning of a stage, of which `frames` are the input: what earlier stages left is deleted,
    but for tables that the input itself reads.
    """
    if work is not None:
        kept = [pair for pair in work.folders if not frames or any(pair[0] is f for f in frames)]
        work.folders = [pair for pair in work.folders if all(pair[1] != path for _, path in kept)]
        _left.extend(kept)
        return
    read = [file for frame in frames for file in frame.inputFiles()] if _left else []
    for frame, path in list(_left):
        if not any(path.rsplit("/", 1)[-1] in file for file in read):
            _left.remove((frame, path))
            _delete(frame.sparkSession, path)


def staged(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write a frame once and read it back, so that later steps start from files.

    Unlike a cache it survives lost executors and it cuts the lineage.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    if _scopes:
        _scopes[-1].folders.append((out, path))
    return out


def unused(df: DataFrame, stem: str) -> str:
    """A column name that the frame does not have, whatever its own columns are called."""
    taken = {name.lower() for name in df.columns}
    return next(name for name in (stem + "_" * n for n in range(len(taken) + 1)) if name not in taken)


def numbered(df: DataFrame, number: str) -> DataFrame:
    """The frame, staged, with a column that numbers the rows and stays the same however often it is read."""
    return staged(df.withColumn(number, F.monotonically_increasing_id()), "zstd")


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished, unreachable queries.

    It does so when the driver collects its garbage, which an idle driver may put off for half an hour. The memory of tables
    that came to the driver goes back to the system.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark.sparkContext._jvm.System.gc()


def keyed_join(rows: DataFrame, side: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys of which one may hold a large share of `rows`; `side` has a row per key.

    `side` was usually grouped by the same keys. Joining on their hash as well asks for a shuffle
    of its own, and only then can adaptive execution split a hot partition of `rows`.
    """
    twin = "_keys_hash"
    rows = rows.withColumn(twin, F.hash(*keys))
    side = side.withColumn(twin, F.hash(*keys))
    return rows.join(side, [*keys, twin], how).drop(twin)


BITMAP_BITS = 1 << 26  # 8 MB that the driver sends to each executor
PART_BITS = 1 << 15  # of one bitmap aggregate, fixed by Spark


def bitmap_of(rows: DataFrame, column: str) -> np.ndarray:
    """A bitmap with a bit set for each integer of the column; its size does not depend on their number.

    It tells which rows may have one of these integers. As it fills, it tells less, but never wrongly that one has not.
    """
    bit = F.pmod(column, F.lit(BITMAP_BITS))
    parts = (rows.select(F.floor(bit / PART_BITS).alias("part"), F.pmod(bit, F.lit(PART_BITS)).alias("bit"))
             .groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))).collect()
    out = np.zeros((BITMAP_BITS // PART_BITS, PART_BITS // 8), np.uint8)
    for row in parts:
        out[row.part] = np.frombuffer(row.bits, np.uint8)
    return out.reshape(-1)


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values % BITMAP_BITS
    return (bitmap[at >> 3] >> (at & 7) & 1).astype(bool)


def _lists(batch: pa.RecordBatch) -> dict[str, list]:
    """Columns as Python lists; lists of numbers without nulls as numpy views."""
    out = {}
    for name, column in zip(batch.schema.names, batch.columns, strict=True):
        if (pa.types.is_list(column.type) and pa.types.is_primitive(column.type.value_type)
                and not column.values.null_count):
            values = column.values.to_numpy(zero_copy_only=False)
            ends = column.offsets.to_numpy()
            out[name] = [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        else:
            out[name] = column.to_pylist()
    return out


def _typed(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, kind)


def in_partitions(df: DataFrame, run: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]],
                  schema: str | StructType, *columns: str) -> DataFrame:
    """Apply `run` to the Arrow batches of each partition: columns as Python lists in, columns out."""
    target = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)
    frame = df.select(*columns) if columns else df

    def typed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(map(_lists, batches)):
            yield pa.RecordBatch.from_arrays([_typed(out[f.name], f.type) for f in target], schema=target)

    return frame.mapInArrow(typed, schema)


def in_batches(df: DataFrame, each: Callable[[dict[str, list]], Iterable[dict[str, list]]],
               schema: str | StructType, *columns: str) -> DataFrame:
    """Apply `each` to every Arrow batch by itself; it may give several results."""
    def run(batches):
        for batch in batches:
            yield from each(batch)

    return in_partitions(df, run, schema, *columns)


def dealt(rows: DataFrame, size: str, block: int, at_once: int, total: int) -> DataFrame:
    """Rows (cluster, uid, ...) with the group they are compared in: part, low and high.

    Clusters of at most `block` rows share parts of about `at_once` rows. A larger one is dealt into
    blocks, and a row goes to each pair of blocks that has its own.
    """
    parts = max(1, -(-total // at_once))
    return (rows.withColumn("_blocks", F.ceil(F.col(size) / block))
            .withColumn("_own", F.pmod(F.xxhash64("uid"), F.col("_blocks")).cast("int"))
            .withColumn("_other", F.explode(F.sequence(F.lit(0), (F.col("_blocks") - 1).cast("int"))))
            .withColumn("low", F.least("_own", "_other")).withColumn("high", F.greatest("_own", "_other"))
            .withColumn("part", F.when(F.col("_blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(parts)))
                        .otherwise(F.xxhash64("cluster", "low", "high")))
            .withColumn("own", F.col("_own") == F.col("low")))


def crossing(rows: DataFrame, cluster: str, label: str, block: int) -> DataFrame:
    """Rows of clusters that have several labels, with the group in which they meet the rows of other labels.

    The rows outside a cluster's most frequent label ("minor" ones) meet all of its rows: minor ones are dealt into blocks by
    `_block`, all of them into blocks by `_chunk`, and a group holds one of each. A cluster whose rows are mostly connected
    costs about two copies of a row, whatever its size. `part` is such a group, or small clusters together.
    """
    with scope() as work:
        sizes = rows.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("_n"))
        main = sizes.groupBy(cluster).agg(
            F.max(F.struct("_n", label))[label].alias("_main"), F.count(F.lit(1)).alias("_labels"),
            F.sum("_n").alias("_all"), F.max("_n").alias("_most"))
        main = main.filter("_labels > 1").select(
            cluster, "_main", F.ceil((F.col("_all") - F.col("_most")) / block).cast("int").alias("_blocks"),
            F.ceil(F.col("_all") / block).cast("int").alias("_chunks"))
        kept = staged(keyed_join(rows, main, [cluster]), "zstd")
        parts = max(1, kept.count() // block)
        chunk = F.pmod(F.xxhash64("uid"), F.col("_chunks")).cast("int")
        minor = (kept.filter(F.col(label) != F.col("_main"))
                 .withColumn("_block", F.pmod(F.xxhash64(F.lit(1), "uid"), F.col("_blocks")).cast("int"))
                 .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))).withColumn("minor", F.lit(True)))
        every = (kept.withColumn("_chunk", chunk)
                 .withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).withColumn("minor", F.lit(False)))
        part = F.when(F.col("_chunks") == 1, F.pmod(F.xxhash64(cluster), F.lit(parts))).otherwise(
            F.xxhash64(cluster, "_block", "_chunk"))
        return work.result(minor.unionByName(every).withColumn("part", part).drop("_main", "_blocks", "_chunks"), "zstd")
