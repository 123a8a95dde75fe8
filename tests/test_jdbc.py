"""JDBC without a database: options, order of statements, and the source's arguments."""

from datetime import date

from caudal.plans import bronze
from caudal.sources import jdbc
from caudal.sources.jdbc import Partitioning, jdbc_options, load_jdbc, read_jdbc
from caudal.specs import FEES, PRODUCTS


def test_options_split_the_scan():
    split = Partitioning("fec_mov", "2024-01-01", "2025-01-01", 16)
    options = jdbc_options("jdbc:x", "T", split, user="u", password="p")
    assert options == {
        "url": "jdbc:x", "dbtable": "T", "fetchsize": "10000", "user": "u", "password": "p",
        "partitionColumn": "fec_mov", "lowerBound": "2024-01-01", "upperBound": "2025-01-01",
        "numPartitions": "16"}
    assert "numPartitions" not in jdbc_options("jdbc:x", "T")


class FakeReader:
    def __init__(self, spark, df):
        self.calls, self.df = [], df
        self.read = self
        self.spark = spark

    def format(self, name):
        self.calls.append(("format", name))
        return self

    def options(self, **options):
        self.calls.append(("options", options))
        return self

    def load(self):
        return self.df

    def jdbc(self, url, table, **kwargs):
        self.calls.append(("jdbc", url, table, kwargs))
        return self.df


def test_watermark_is_a_typed_filter(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-02",)], "d string")
    fake = FakeReader(spark, df)
    assert read_jdbc(fake, "jdbc:x", "T").count() == 2
    assert read_jdbc(fake, "jdbc:x", "T", watermark=("d", "2024-01-01")).count() == 1
    assert read_jdbc(fake, "jdbc:x", "T", watermark=("d", "2024-01-01"), inclusive=True).count() == 2
    assert fake.calls[0] == ("format", "jdbc")


def test_predicates_give_one_task_each(spark):
    fake = FakeReader(spark, spark.range(1))
    read_jdbc(fake, "jdbc:x", "T", Partitioning(predicates=("a < 'M'", "a >= 'M'")), user="u")
    assert fake.calls == [("jdbc", "jdbc:x", "T", {
        "predicates": ["a < 'M'", "a >= 'M'"], "properties": {"fetchsize": "10000", "user": "u"}})]


class FakeTable:
    def __init__(self, name, log, empty=False):
        self.name, self.log, self.empty = name, log, empty
        self.write = self

    def limit(self, n):
        return FakeTable(self.name, self.log, empty=n == 0)

    def option(self, key, value):
        self.log.append((key, value))
        return self

    def jdbc(self, url, name, mode, properties):
        self.log.append(("empty" if self.empty else "fill", name, mode))


def test_load_empties_children_first_and_fills_parents_first():
    log = []
    order = ["parent", "child", "grandchild"]
    load_jdbc({name: FakeTable(name, log) for name in order}, "jdbc:x", order, user="u")
    steps = [entry for entry in log if entry[0] != "truncate"]
    assert steps == [("empty", "grandchild", "overwrite"), ("empty", "child", "overwrite"),
                     ("empty", "parent", "overwrite"), ("fill", "parent", "append"),
                     ("fill", "child", "append"), ("fill", "grandchild", "append")]


def test_source_passes_the_mark(monkeypatch):
    seen = []
    monkeypatch.setattr(bronze, "read_jdbc", lambda *args, **kwargs: seen.append((args, kwargs)))
    split = Partitioning("fec_cobro", "2024-01-01", "2025-01-01")
    source = bronze.jdbc_source(None, "jdbc:x", {FEES.name: split}, user="u")
    source(FEES, "2024-06-01")
    source(FEES, None)
    source(PRODUCTS, None)
    assert [kwargs["watermark"] for _, kwargs in seen] == [("fec_cobro", "2024-06-01"), None, None]
    assert seen[0][0][3] is split and seen[2][0][3] is None
    assert jdbc.FETCH_SIZE == 10_000


def test_increments_are_split_from_the_mark_on():
    full = jdbc.Partitioning("fec_cobro", "2020-01-01", "2024-01-01", 16)
    assert full.since("fec_cobro", "2024-06-01", date(2024, 6, 20)).options() == {
        "partitionColumn": "fec_cobro", "lowerBound": "2024-06-01", "upperBound": "2024-06-20", "numPartitions": "16"}
    assert full.since("fec_cobro", "2024-06-20", date(2024, 6, 20)).upper == "2024-06-21"
    assert full.since("other", "2024-06-01", date(2024, 6, 20)) is full
    assert jdbc.Partitioning(predicates=("a = 1",)).since("x", "2024-06-01", date(2024, 6, 2)).predicates == ("a = 1",)


def test_a_source_splits_increments_by_the_day_of_the_batch(monkeypatch):
    seen = []
    monkeypatch.setattr(bronze, "read_jdbc", lambda *args, **kwargs: seen.append(args[3]))
    full = jdbc.Partitioning("fec_cobro", "2020-01-01", "2024-01-01", 16)
    source = bronze.jdbc_source(None, "jdbc:x", {FEES.name: full}, until=date(2024, 6, 20))
    source(FEES, None)
    source(FEES, "2024-06-01")
    assert seen[0] is full and (seen[1].lower, seen[1].upper) == ("2024-06-01", "2024-06-20")
