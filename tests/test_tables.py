from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from caudal.sources.files import read_csv, write_files
from caudal.sources.marks import read_mark, write_mark
from caudal.sources.tables import (
    DuplicateKeyError, append_table, drop_superseded, overwrite_table, read_log, read_table, scratch_lake,
    stage, table_exists, upsert_table,
)

NOW = datetime(2024, 1, 2, 3, 4, 5)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, part string, v string")


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("partition_by", [(), ("part",)])
def test_upsert_and_rerun(spark, lake, partition_by):
    first = frame(spark, [(1, "a", "x"), (2, "a", "y"), (3, "b", "z"), (4, None, "n")])
    batch = frame(spark, [(2, "a", "Y"), (5, "c", "new")])
    assert not table_exists(spark, lake, "gold", "t")
    upsert_table(first, lake, "gold", "t", ("k",), partition_by)
    for _ in range(2):
        upsert_table(batch, lake, "gold", "t", ("k",), partition_by)
        got = rows(read_table(spark, lake, "gold", "t", partition_by).select("k", "part", "v"))
        assert got == Counter({(1, "a", "x"): 1, (2, "a", "Y"): 1, (3, "b", "z"): 1,
                               (4, None, "n"): 1, (5, "c", "new"): 1})


def test_only_touched_partitions_are_rewritten(spark, lake):
    upsert_table(frame(spark, [(1, "a", "x"), (3, "b", "z")]), lake, "gold", "t", ("k",), ("part",))
    upsert_table(frame(spark, [(1, "a", "X")]), lake, "gold", "t", ("k",), ("part",))
    files = read_table(spark, lake, "gold", "t", ("part",)).select("k", F.input_file_name().alias("f"))
    version = {r["k"]: r["f"].split("/snapshot=")[1].split("/")[0] for r in files.collect()}
    assert version == {1: "2", 3: "1"}


def test_a_row_can_leave_its_partition(spark, lake):
    upsert_table(frame(spark, [(1, "a", "x"), (2, None, "n")]), lake, "gold", "t", ("k",), ("part",))
    upsert_table(frame(spark, [(1, "b", "moved"), (2, "b", "filled")]), lake, "gold", "t", ("k",),
                 ("part",))
    got = rows(read_table(spark, lake, "gold", "t", ("part",)).select("k", "part", "v"))
    assert got == Counter({(1, "b", "moved"): 1, (2, "b", "filled"): 1})


def test_null_parts_of_a_key_are_equal(spark, lake):
    keys = ("k", "part")
    upsert_table(frame(spark, [(1, None, "x")]), lake, "gold", "t", keys)
    upsert_table(frame(spark, [(1, None, "y")]), lake, "gold", "t", keys)
    assert rows(read_table(spark, lake, "gold", "t")) == Counter({(1, None, "y"): 1})


def test_duplicate_source_keys_are_refused(spark, lake):
    twice = frame(spark, [(1, "a", "x"), (1, "a", "y")])
    with pytest.raises(DuplicateKeyError):
        upsert_table(twice, lake, "gold", "t", ("k",))
    assert not table_exists(spark, lake, "gold", "t")


def test_an_unfinished_write_is_not_seen(spark, lake, tmp_path):
    overwrite_table(frame(spark, [(1, "a", "x")]), lake, "gold", "t")
    broken = tmp_path / "lake" / "gold" / "t" / "snapshot=2"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"half")
    assert rows(read_table(spark, lake, "gold", "t")) == Counter({(1, "a", "x"): 1})
    upsert_table(frame(spark, [(2, "a", "y")]), lake, "gold", "t", ("k",))
    assert read_table(spark, lake, "gold", "t").count() == 2


def test_overwrite_replaces_schema(spark, lake):
    overwrite_table(frame(spark, [(1, "a", "x")]), lake, "gold", "t", ("part",))
    overwrite_table(spark.createDataFrame([("01", 2)], "part string, n int"), lake, "gold", "t",
                    ("part",))
    out = read_table(spark, lake, "gold", "t", ("part",))
    assert out.columns == ["part", "n"] and tuple(out.head()) == ("01", 2)


def test_empty_partitioned_table(spark, lake):
    overwrite_table(frame(spark, []), lake, "gold", "t", ("part",))
    assert read_table(spark, lake, "gold", "t", ("part",)).count() == 0
    upsert_table(frame(spark, [(1, "a", "x")]), lake, "gold", "t", ("k",), ("part",))
    assert read_table(spark, lake, "gold", "t", ("part",)).count() == 1


def test_missing_table(spark, lake):
    with pytest.raises(FileNotFoundError):
        read_table(spark, lake, "gold", "none")


def test_log_slices_replace_themselves(spark, lake):
    ddl = "n int, batch_id string"
    assert read_log(spark, lake, "errors", "log", ddl).count() == 0
    for batch, n in (("B1", 1), ("B2", 2), ("B1", 3)):
        append_table(spark.createDataFrame([(n, batch)], ddl), lake, "errors", "log", batch_id=batch)
    assert rows(read_log(spark, lake, "errors", "log", ddl)) == Counter({(3, "B1"): 1, (2, "B2"): 1})


@pytest.mark.parametrize("partition_by", [(), ("part",)])
def test_superseded_snapshots_can_be_dropped(spark, lake, tmp_path, partition_by):
    upsert_table(frame(spark, [(1, "a", "x"), (3, "b", "z")]), lake, "gold", "t", ("k",), partition_by)
    for value in ("p", "q", "r"):
        upsert_table(frame(spark, [(1, "a", value)]), lake, "gold", "t", ("k",), partition_by)

    def now():
        return rows(read_table(spark, lake, "gold", "t", partition_by).select("k", "part", "v"))

    before = now()
    drop_superseded(spark, lake, "gold", "t", partition_by, keep=2)
    assert now() == before == Counter({(1, "a", "r"): 1, (3, "b", "z"): 1})
    table = tmp_path / "lake" / "gold" / "t"
    left = sorted(str(p.parent.relative_to(table)) for p in table.glob("**/*.parquet"))
    if partition_by:
        assert sorted(set(left)) == ["snapshot=1/part=b", "snapshot=3/part=a", "snapshot=4/part=a"]
    else:
        assert set(left) == {"snapshot=3", "snapshot=4"}
    upsert_table(frame(spark, [(3, "b", "Z")]), lake, "gold", "t", ("k",), partition_by)
    assert now() == Counter({(1, "a", "r"): 1, (3, "b", "Z"): 1})


def test_stage_reads_files(spark, lake):
    staged = stage(spark.range(5).withColumn("r", F.rand()), lake, "x", "B1")
    assert staged.collect() == staged.collect()


def test_scratch_folder_follows_the_checkpoint_setting(spark):
    assert scratch_lake(spark).root.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_marks(spark, lake):
    assert read_mark(spark, lake, "a") is None
    write_mark(spark, lake, "a", "2024-01-01", "B1", NOW)
    write_mark(spark, lake, "b", "2024-01-05", "B1", NOW)
    write_mark(spark, lake, "a", "2024-02-01", "B2", NOW)
    assert read_mark(spark, lake, "a") == "2024-02-01"
    assert read_mark(spark, lake, "b") == "2024-01-05"
    assert read_mark(spark, lake, "c") is None


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_files_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame([("P01", 26.82, None), ("P02", 0.0, "a,b")],
                               "cod_prod string, tasa_ea double, d string")
    path = str(tmp_path / fmt)
    write_files(df, path, fmt)
    back = read_csv(spark, path, df.schema) if fmt == "csv" else spark.read.parquet(path)
    assert rows(back) == rows(df)
    with pytest.raises(ValueError):
        write_files(df, path, "xml")


def test_opening_a_partitioned_table_starts_no_job(spark, lake):
    upsert_table(frame(spark, [(n, f"p{n}", "é") for n in range(40)]), lake, "gold", "t", ("k",), ("part",))
    context = spark.sparkContext
    context.setJobGroup("opening", "opening a table")
    try:
        df = read_table(spark, lake, "gold", "t", ("part",))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert list(context.statusTracker().getJobIdsForGroup("opening")) == []
    assert df.columns == ["k", "part", "v"] and df.count() == 40
