"""Steps that run side by side, and what they must not change."""

from collections import Counter
from datetime import date, datetime
from threading import Event

import pytest

from bank_rows import frames
from caudal.plans import batch as runs
from caudal.plans import bronze, rejects, silver
from caudal.queries import deliveries
from caudal.sources import locator, tables
from caudal.sources.tables import DuplicateKeyError, read_table, upsert_table
from caudal.sources.together import together
from caudal.specs import LOANS, Batch

B1, B2 = (Batch(f"B{n}", date(2024, 6, 30), datetime(2024, 6, n, 7)) for n in (1, 2))


def test_all_steps_end_before_an_error_is_raised():
    ended = []

    def bad():
        raise ValueError("bad")

    with pytest.raises(ValueError, match="bad"):
        together([bad, lambda: ended.append(1)])
    assert ended == [1] and together([]) == [] and together([lambda: 1, lambda: 2]) == [1, 2]


@pytest.mark.parametrize("fails", [False, True])
def test_the_second_delivery_lands_while_gold_is_built(spark, monkeypatch, fails):
    landed, order = Event(), []

    def layer(name):
        def run(spark, lake, *rest):
            batch = rest[-1]
            if (name, batch) == ("bronze", deliveries.SECOND):
                landed.set()
            error = "late" if (name, batch) == ("gold", deliveries.FIRST) and (fails or not landed.wait(20)) else ""
            order.append((name, batch.batch_id))
            return [("t", 0, "", error)]
        return run

    for name in ("bronze", "silver", "gold"):
        monkeypatch.setattr(runs, f"run_{name}", layer(name))
    monkeypatch.setattr(deliveries, "_lakes", {})
    monkeypatch.setattr(deliveries.bank, "RAW", {})
    if fails:  # then nothing more is cleaned, and no lake is kept
        with pytest.raises(runs.BatchFailed, match="BATCH_1.*late"):
            deliveries.two_deliveries(spark, "nowhere")
        assert ("silver", "BATCH_2") not in order and not deliveries._lakes
    else:
        deliveries.two_deliveries(spark, "nowhere")
        assert order[:2] == [("bronze", "BATCH_1"), ("silver", "BATCH_1")]
        assert order[-2:] == [("silver", "BATCH_2"), ("gold", "BATCH_2")] and len(order) == 6


def test_waiting_rejects_are_read_while_customers_are_cleaned(spark, lake, monkeypatch):
    data = frames(spark)
    source = lambda spec, mark: data[spec.name]
    runs.run_bronze(spark, lake, source, B1)
    assert not any(error for *_, error in runs.run_silver(spark, lake, B1))
    runs.run_bronze(spark, lake, source, B2)
    read, opened, customers = Event(), rejects.open_rejects, silver.silver_customers

    def open_rejects(spark, lake, spec, *rest):
        if spec == LOANS:
            read.set()
        return opened(spark, lake, spec, *rest)

    def slow_customers(df):
        assert read.wait(60), "rejects were not read meanwhile"
        return customers(df)

    monkeypatch.setattr(rejects, "open_rejects", open_rejects)
    monkeypatch.setattr(silver, "silver_customers", slow_customers)
    assert not any(error for *_, error in runs.run_silver(spark, lake, B2))


def test_copies_are_looked_for_while_the_partitions_are(spark, lake, monkeypatch):
    def frame(*rows):
        return spark.createDataFrame(list(rows), "k int, p string, v string")

    upsert_table(frame((1, "a", "x"), (2, "b", "x")), lake, "gold", "t", ("k",), ("p",))
    with pytest.raises(DuplicateKeyError):
        upsert_table(frame((1, "a", "y"), (1, "b", "z")), lake, "gold", "t", ("k",), ("p",))
    found = read_table(spark, lake, "gold", "t", ("p",)).select("k", "p", "v").collect()
    assert Counter(map(tuple, found)) == Counter([(1, "a", "x"), (2, "b", "x")])
    looked, partitions, copies = Event(), locator.partitions_of, tables.duplicate_keys

    def partitions_of(*args):
        looked.set()
        return partitions(*args)

    def duplicate_keys(*args):
        assert looked.wait(20), "the places were not looked up meanwhile"
        return copies(*args)

    monkeypatch.setattr(locator, "partitions_of", partitions_of)
    monkeypatch.setattr(tables, "duplicate_keys", duplicate_keys)
    upsert_table(frame((1, "b", "y")), lake, "gold", "t", ("k",), ("p",))
    found = read_table(spark, lake, "gold", "t", ("p",)).select("k", "p", "v").collect()
    assert Counter(map(tuple, found)) == Counter([(1, "b", "y"), (2, "b", "x")])


def test_a_row_of_a_log_is_one_task(spark):
    assert bronze.log_ingestion(spark, "t", B1, 1, 1.0, "SUCCESS").rdd.getNumPartitions() == 1
