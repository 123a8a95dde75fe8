"""Layer tables on Parquet.

A keyed table is a directory of numbered snapshots, `<root>/<layer>/<table>/snapshot=<n>`, and the
current one is the newest that has Spark's _SUCCESS file. A write goes to the next number, so a
failed or repeated job never touches what readers see. For a partitioned table a snapshot
holds only the partitions that changed; the newest snapshot of each partition counts.

Log and reject tables are plain directories with one slice per batch (and table); writing a
slice again replaces it, so a rerun adds nothing.
"""

from __future__ import annotations

import gc
import json
import re
import tempfile
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caudal.operators.keyed import duplicate_keys, upsert, without_keys
from caudal.sources import locator
from caudal.sources.lake import Lake
from caudal.sources.together import together

_NULL = "__HIVE_DEFAULT_PARTITION__"  # Spark's directory name for a NULL partition value
CODEC = "zstd"  # files are about a third smaller than with Spark's default


class DuplicateKeyError(ValueError):
    """The source of an upsert has more than one row for a key."""


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _fs(spark, path)
    return fs.exists(hadoop)


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop = _fs(spark, path)
    if not fs.exists(hadoop):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop) if s.isDirectory())


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Complete snapshots, oldest first."""
    found = [int(m.group(1)) for name in _children(spark, path)
             if (m := re.fullmatch(r"snapshot=(\d+)", name))]
    return sorted(n for n in found if _exists(spark, f"{path}/snapshot={n}/_SUCCESS"))


def _next_version(spark: SparkSession, path: str) -> str:
    """Path of the next snapshot, emptied of what an earlier failed write left there."""
    done = _versions(spark, path)
    target = f"{path}/snapshot={(done[-1] if done else 0) + 1}"
    fs, hadoop = _fs(spark, target)
    fs.delete(hadoop, True)
    return target


def table_exists(spark: SparkSession, lake: Lake, layer: str, name: str) -> bool:
    return bool(_versions(spark, lake.path(layer, name)))


def _leaves(spark: SparkSession, base: str, depth: int) -> dict[str, str]:
    """Partition directories below a snapshot: {'a=1/b=2': full path}."""
    level = {"": base}
    for _ in range(depth):
        level = {f"{prefix}/{child}".lstrip("/"): f"{path}/{child}"
                 for prefix, path in level.items()
                 for child in _children(spark, path) if "=" in child}
    return level


def current_partitions(spark: SparkSession, lake: Lake, layer: str, name: str,
                       depth: int) -> dict[str, str]:
    """The newest directory of every partition. Driver metadata only: one entry per partition."""
    base = lake.path(layer, name)
    newest: dict[str, str] = {}
    for version in _versions(spark, base):
        if _is_full(spark, base, version):  # a full snapshot replaces all before it
            newest = {}
        newest |= _leaves(spark, f"{base}/snapshot={version}", depth)
    return newest


def _is_full(spark: SparkSession, base: str, version: int) -> bool:
    return _exists(spark, f"{base}/snapshot={version}/_schema")


def _partitioned_schema(spark: SparkSession, base: str) -> StructType:
    """Schema stored beside the last full snapshot, so that reading lists and infers nothing."""
    version = max(n for n in _versions(spark, base) if _is_full(spark, base, n))
    fs, folder = _fs(spark, f"{base}/snapshot={version}/_schema")
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    name = next(name for name in names if not name.startswith(("_", ".")))
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(folder, name))
    try:
        return StructType.fromJson(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def _write_schema(spark: SparkSession, target: str, schema: StructType) -> None:
    """A small file that the driver writes and reads itself: a job for it costs more than most tables' own."""
    fs, file = _fs(spark, f"{target}/_schema/schema.json")
    stream = fs.create(file, True)
    try:
        stream.write(bytearray(schema.json().encode()))
    finally:
        stream.close()


def read_table(spark: SparkSession, lake: Lake, layer: str, name: str,
               partition_by: tuple[str, ...] = ()) -> DataFrame:
    """The current rows of a table. Partition columns are text, as they were written."""
    base = lake.path(layer, name)
    versions = _versions(spark, base)
    if not versions:
        raise FileNotFoundError(f"no table {layer}/{name} under {lake.root}")
    if not partition_by:
        return spark.read.parquet(f"{base}/snapshot={versions[-1]}")
    paths = current_partitions(spark, lake, layer, name, len(partition_by))
    return _read_partitions(spark, base, sorted(paths.values()))


def _read_partitions(spark: SparkSession, base: str, paths: list[str]) -> DataFrame:
    schema = _partitioned_schema(spark, base)
    if not paths:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).option("basePath", base).parquet(*paths)
    return df.select(*schema.fieldNames())


def driver_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows that the driver made, as one task. Unasked, writing them starts a task for each core."""
    return spark.createDataFrame(rows, schema).coalesce(1)


def read_log(spark: SparkSession, lake: Lake, layer: str, name: str,
             schema: StructType | str) -> DataFrame:
    """All slices of a log table, or no rows where nothing was written yet."""
    path = lake.path(layer, name)
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _write(df: DataFrame, path: str, partition_by: tuple[str, ...], mode: str, gather: bool = True) -> None:
    if partition_by and gather:
        # Rebalance sizes the output files: it gathers the rows of a partition from all tasks,
        # and splits a partition that holds too much for one of them.
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode).option("compression", CODEC)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def overwrite_table(df: DataFrame, lake: Lake, layer: str, name: str,
                    partition_by: tuple[str, ...] = (), gather: bool = True) -> None:
    """Replace the table, schema included, by a full snapshot.

    `gather=False` states that all rows belong to one partition: each task then writes one file, and nothing is shuffled.
    """
    spark = df.sparkSession
    target = _next_version(spark, lake.path(layer, name))
    if partition_by:
        _write_schema(spark, target, df.schema)
        locator.forget(spark, lake, layer, name)  # what it knows is of the replaced rows
    _write(df, target, partition_by, "append", gather)


def replace_partitions(df: DataFrame, lake: Lake, layer: str, name: str, partition_by: tuple[str, ...]) -> None:
    """Replace the partitions that `df` has rows of by these rows; create the table if need be.

    For rows that were derived from partitions as a whole: no key is looked up. `df` is read twice once the table exists.
    """
    spark = df.sparkSession
    if not table_exists(spark, lake, layer, name):
        overwrite_table(df, lake, layer, name, partition_by)
        return
    locator.forget(spark, lake, layer, name)
    rows = df.select(*partition_by).distinct().collect()  # bounded by the number of partitions
    if rows:
        version = _next_version(spark, lake.path(layer, name))
        _mark_changed(spark, version, [_partition(row, partition_by) for row in rows])
        _write(df, version, partition_by, "append", len(rows) > 1)


def _partition(row: Row, partition_by: tuple[str, ...]) -> str:
    """A partition's path below its snapshot: 'a=1/b=2'."""
    return "/".join(f"{c}={_NULL if row[c] is None else row[c]}" for c in partition_by)


def _mark_changed(spark: SparkSession, version: str, names: list[str]) -> None:
    for changed in names:  # also marks a partition that loses its last row
        fs, directory = _fs(spark, f"{version}/{changed}")
        fs.mkdirs(directory)


def stage(df: DataFrame, lake: Lake, name: str, batch_id: str) -> DataFrame:
    """Write a frame to the lake and read it back: one evaluation, however often it is used.

    Unlike a cache it survives the loss of executors, and the plan starts anew from files.
    """
    path = f"{lake.path('_stage', name)}/batch_id={batch_id}"
    df.write.mode("overwrite").option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_lake(spark: SparkSession) -> Lake:
    """A new folder for intermediate tables, inside the session's checkpoint folder.

    A cluster names a shared folder in spark.checkpoint.dir. Where none is set, one machine uses a
    temporary folder, and a cluster is refused, since its executors would each write to their own disk.
    """
    shared = (spark.conf.get("spark.checkpoint.dir", None)
              or spark.sparkContext.getCheckpointDir())
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="caudal-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return Lake(f"{shared}/caudal-{uuid.uuid4().hex}")


def upsert_table(df: DataFrame, lake: Lake, layer: str, name: str, keys: tuple[str, ...],
                 partition_by: tuple[str, ...] = (), unique: bool = True,
                 stable_partitions: bool = False, gather: bool = True) -> list[tuple[str | None, ...]]:
    """Update all rows whose key exists and insert the others; create the table if need be.

    `df` is read more than once, so pass a frame that reads files (see `stage`). With
    `unique`, a key that occurs twice in `df` is an error. A partitioned table rewrites only
    the partitions that hold affected keys, which it gives back; the locator (see `locator`) knows where
    keys are. Rows of a partition that only takes new keys are compared to nothing. `stable_partitions` states that
    a key never changes its partition, which saves looking, `gather=False` that a first load has one partition.
    """
    spark = df.sparkSession

    def refuse_copies() -> None:
        if unique and (twice := duplicate_keys(df, list(keys)).head(1)):
            raise DuplicateKeyError(f"{layer}/{name}: duplicate key in source: {twice[0].asDict()}")

    if not table_exists(spark, lake, layer, name):
        refuse_copies()
        overwrite_table(df, lake, layer, name, partition_by, gather)
        if not partition_by:
            return []
        if not stable_partitions:
            locator.restart(read_table(spark, lake, layer, name, partition_by), lake, layer, name, keys, partition_by)
        return [_values(name_) for name_ in current_partitions(spark, lake, layer, name, len(partition_by))]
    if not partition_by:
        refuse_copies()
        merged = upsert(read_table(spark, lake, layer, name), df, list(keys))
        _write(merged, _next_version(spark, lake.path(layer, name)), (), "overwrite")
        return []

    base = lake.path(layer, name)
    current = current_partitions(spark, lake, layer, name, len(partition_by))

    def touched() -> list[Row]:
        found = df.select(*partition_by).distinct().withColumn("_located", F.lit(stable_partitions))
        if not stable_partitions:
            known = locator.read(spark, lake, layer, name, keys, partition_by)
            if known is None:  # written by other means
                target = _read_partitions(spark, base, sorted(current.values()))
                locator.restart(target, lake, layer, name, keys, partition_by)
                known = locator.read(spark, lake, layer, name, keys, partition_by)
            located = locator.partitions_of(known, df, keys, partition_by).withColumn("_located", F.lit(True))
            found = found.unionByName(located)
        found = found.groupBy(*partition_by).agg(F.max("_located").alias("_located"))
        return found.collect()  # bounded by the number of partitions

    _, rows = together([refuse_copies, touched])
    if not rows:
        return []
    names = {_partition(row, partition_by): row["_located"] for row in rows}
    hit = sorted(current[n] for n, located in names.items() if located and n in current)
    others = sorted(current[n] for n, located in names.items() if not located and n in current)
    merged = _read_partitions(spark, base, others).unionByName(df)
    if hit:
        merged = without_keys(_read_partitions(spark, base, hit), df, list(keys)).unionByName(merged)
    version = _next_version(spark, base)
    _mark_changed(spark, version, list(names))
    if not stable_partitions:
        # Before the rows: a place that is named without need costs a look at it, one that is not named a lost copy.
        locator.add(df, lake, layer, name, keys, partition_by)
    _write(merged, version, partition_by, "append", len(names) > 1)
    return [tuple(row)[:-1] for row in rows]


def _values(partition: str) -> tuple[str | None, ...]:
    """The values in a partition's path below its table: 'a=1/b=2' gives ('1', '2')."""
    found = [unquote(part.split("=", 1)[1]) for part in partition.split("/")]
    return tuple(None if value == _NULL else value for value in found)


def drop_superseded(spark: SparkSession, lake: Lake, layer: str, name: str,
                    partition_by: tuple[str, ...] = (), keep: int = 1) -> None:
    """Delete what no reader of the `keep` newest snapshots needs any more.

    A partition directory of an older snapshot stays while it is the newest of its partition.
    """
    base = lake.path(layer, name)
    versions = _versions(spark, base)
    old = versions[:-keep]
    if not partition_by:
        _delete(spark, [f"{base}/snapshot={n}" for n in old])
        return
    full = [n for n in versions if _is_full(spark, base, n)]
    before_full = [n for n in old if n < full[-1]]
    _delete(spark, [f"{base}/snapshot={n}" for n in before_full])
    needed = set(current_partitions(spark, lake, layer, name, len(partition_by)).values())
    _delete(spark, [path for n in old if n not in before_full
                    for path in _leaves(spark, f"{base}/snapshot={n}", len(partition_by)).values()
                    if path not in needed])


def drop_stage(spark: SparkSession, lake: Lake, batch_id: str, *names: str) -> None:
    """Delete the staged copies of a finished batch, or those of some names that nothing reads any more."""
    base = lake.path("_stage", "").rstrip("/")
    _delete(spark, [f"{base}/{name}/batch_id={batch_id}" for name in names or _children(spark, base)])


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished queries, which it does when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def log_slices(spark: SparkSession, lake: Lake, layer: str, name: str, depth: int) -> list[tuple[str | None, ...]]:
    """The values that name the slices of a log, e.g. (batch, table). Driver metadata only."""
    return [_values(slice_) for slice_ in _leaves(spark, lake.path(layer, name), depth)]


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        fs, directory = _fs(spark, path)
        fs.delete(directory, True)


def drop_log(spark: SparkSession, lake: Lake, layer: str, name: str) -> None:
    """Delete a log whose rows have served their purpose."""
    _delete(spark, [lake.path(layer, name)])


def append_table(df: DataFrame, lake: Lake, layer: str, name: str, /, **slice_of: str) -> None:
    """Add a slice, e.g. batch_id='B1', to a log table. The same slice again replaces itself.

    The slice columns are in the directory name, so they are left out of the files.
    """
    path = "/".join([lake.path(layer, name), *[f"{k}={v}" for k, v in slice_of.items()]])
    df.drop(*slice_of).write.mode("overwrite").option("compression", CODEC).parquet(path)
