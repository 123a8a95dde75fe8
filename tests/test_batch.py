import random
from collections import Counter
from datetime import date, datetime, timedelta
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from bank_rows import frames, movement
from caudal.functions.audit import INGEST_PARTS
from caudal.plans import batch as runs
from caudal.plans.bronze import ERROR_SCHEMA, LOG_SCHEMA, frames_source
from caudal.sources.marks import read_mark
from caudal.plans.changes import read_changes
from caudal.sources.tables import Lake, _leaves, _versions, read_log, read_table
from caudal.specs import CUSTOMERS, GOLD_TABLES, MOVEMENTS, PRODUCTS, SOURCE_TABLES, Batch

FIRST = Batch("BATCH_20240601", date(2024, 12, 31), datetime(2024, 6, 1, 7))
SECOND = Batch("BATCH_20240602", date(2024, 12, 31), datetime(2024, 6, 2, 7))
REJECTS = ("source_table string, reason string, batch_id string, row_key string, payload string, "
           "rejected_at timestamp")
TIMES = ("_ingestion_timestamp", "_silver_timestamp", "_gold_timestamp")


def snapshot(spark, lake):
    """All table contents apart from time columns."""
    out = {}
    for spec in SOURCE_TABLES:
        out["bronze", spec.name] = read_table(spark, lake, "bronze", spec.name, INGEST_PARTS)
        out["silver", spec.name] = runs.read_silver(spark, lake, spec)
    for spec in GOLD_TABLES:
        out["gold", spec.name] = read_table(spark, lake, "gold", spec.name, spec.partition_by)
    out["errors", "rejects"] = read_log(spark, lake, "errors", "rejects", REJECTS)
    return {name: Counter(tuple(r) for r in df.drop(*TIMES).select(
        *sorted(set(df.columns) - set(TIMES))).collect()) for name, df in out.items()}


@pytest.fixture(scope="module")
def first_run(spark, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("lake")))
    summary = runs.run_batch(spark, lake, frames_source(frames(spark)), FIRST).head()
    return lake, summary


def test_summary(first_run):
    _, row = first_run
    assert (row["batch_id"], row["total_bronze"], row["total_silver"]) == (FIRST.batch_id, 34, 17)
    assert (row["total_checks"], row["failed_checks"], row["status"]) == (8, 0, "SUCCESS")


def test_logs(spark, first_run):
    lake, _ = first_run
    log = {r["table_name"]: r for r in
           read_log(spark, lake, "bronze", "_control/ingestion_log", LOG_SCHEMA).collect()}
    assert log[MOVEMENTS.name]["n_records"] == 10 and log[MOVEMENTS.name]["status"] == "SUCCESS"
    assert log[MOVEMENTS.name]["file_size_mb"] == 0.005
    quality = read_log(spark, lake, "silver", "_control/quality_log",
                       "table_name string, batch_id string, n_input long, n_output long, "
                       "n_rejected long, pct_conformes double, null_summary string")
    row = quality.filter(F.col("table_name") == MOVEMENTS.name).head()
    assert (row["n_input"], row["n_output"], row["n_rejected"], row["pct_conformes"]) == (10, 4, 6, 40.0)
    rejects = read_log(spark, lake, "errors", "rejects", REJECTS)
    assert rejects.filter("source_table = 'TB_MOV_FINANCIEROS'").count() == 5
    assert read_log(spark, lake, "errors", "pipeline_errors", ERROR_SCHEMA).count() == 0


def test_a_bad_date_does_not_move_the_mark(spark, first_run):
    lake, _ = first_run
    assert read_mark(spark, lake, MOVEMENTS.name) == "2024-03-05"


def test_rerun_changes_nothing(spark, first_run):
    lake, _ = first_run
    before = snapshot(spark, lake)
    summary = runs.run_batch(spark, lake, frames_source(frames(spark)), FIRST).head()
    assert snapshot(spark, lake) == before
    assert summary["status"] == "SUCCESS"
    statuses = Counter(r["status"] for r in read_log(
        spark, lake, "bronze", "_control/ingestion_log", LOG_SCHEMA).collect())
    assert statuses == {"SUCCESS": 6, "SKIPPED_NO_NEW_RECORDS": 4}


def test_late_rows_of_the_marked_day_arrive(spark, first_run):
    lake, _ = first_run
    data = frames(spark)
    more = [movement("M2", day="2024-03-05"),               # known already
            movement("M20", day="2024-03-05", value=70.0),  # same day as the mark
            movement("M21", day="2024-03-06", value=80.0)]
    data[MOVEMENTS.name] = data[MOVEMENTS.name].union(spark.createDataFrame(more, MOVEMENTS.schema))
    summary = runs.run_batch(spark, lake, frames_source(data), SECOND).head()
    assert summary["total_bronze"] == 2 + 6  # new movements; the full-load tables have 6 rows
    silver = runs.read_silver(spark, lake, MOVEMENTS)
    assert {r["id_mov"] for r in silver.collect()} == {"M1", "M2", "M3", "M8", "M20", "M21"}
    assert read_mark(spark, lake, MOVEMENTS.name) == "2024-03-06"
    # Gold took over the changes alone: of the facts only the month that the new rows lie in.
    written = {name: _newest(spark, lake, name, 2) for name in ("fact_transacciones", "_state/ingresos")}
    assert written["fact_transacciones"] == {"anio_mov=2024/mes_mov=03"}
    assert written["_state/ingresos"] == {"_anio=2024/_mes=03"}
    facts = read_table(spark, lake, "gold", "fact_transacciones", ("anio_mov", "mes_mov"))
    assert {r["id_mov"] for r in facts.collect()} == {"M1", "M2", "M3", "M8", "M20", "M21"}
    assert read_changes(spark, lake).batches == ()


def _newest(spark, lake, name, depth):
    """Partitions of the newest snapshot of a gold table."""
    base = lake.path("gold", name)
    return set(_leaves(spark, f"{base}/snapshot={_versions(spark, base)[-1]}", depth))


def test_one_failing_table_stops_the_layer_at_its_end(spark, lake):
    good = frames_source(frames(spark))

    def source(spec, mark):
        if spec.name == "TB_PRODUCTOS_CAT":
            raise RuntimeError("source is down")
        return good(spec, mark)

    with pytest.raises(runs.BatchFailed, match="source is down"):
        runs.run_batch(spark, lake, source, FIRST)
    log = {r["table_name"]: r["status"] for r in
           read_log(spark, lake, "bronze", "_control/ingestion_log", LOG_SCHEMA).collect()}
    assert log["TB_PRODUCTOS_CAT"] == "FAILED" and Counter(log.values())["SUCCESS"] == 5
    assert read_log(spark, lake, "errors", "pipeline_errors", ERROR_SCHEMA).head()["table_name"] == (
        "TB_PRODUCTOS_CAT")
    summary = read_log(spark, lake, "errors", "run_summary", "batch_id string, status string").collect()
    assert [row["status"] for row in summary] == ["PARTIAL_FAILURE"]
    # The next attempt of the same batch carries on.
    assert runs.run_batch(spark, lake, good, FIRST).head()["status"] == "SUCCESS"


def test_references_can_be_checked_against_bronze(spark, lake):
    source = frames_source(frames(spark))
    settings = runs.Settings(refs_from="bronze")
    runs.run_bronze(spark, lake, source, FIRST, settings)
    outcomes = {name: count for name, count, _, _ in runs.run_silver(spark, lake, FIRST, settings)}
    assert outcomes["TB_CLIENTES_CORE"] == 3
    assert outcomes["TB_OBLIGACIONES"] == 2


def random_batches(seed):
    """Three deliveries of movements: late rows, new versions, unknown clients, bad dates."""
    rng = random.Random(seed)
    first = date(2024, 1, 1)
    deliveries, known = [], []
    for number in range(3):
        rows = []
        for i in range(60):
            fresh = not known or rng.random() < 0.85
            id_mov = f"R{number}_{i}" if fresh else rng.choice(known)
            day = first + timedelta(days=number * 40 + rng.randrange(50))
            value = rng.choice([10.0, 11.0, 12.0, 900.0])
            client = rng.choice(["C1", "C1", "C1", "C2", "C7"])
            text = rng.choice([str(day)] * 9 + ["2099-01-01"])
            rows.append(movement(id_mov, client, day=text, value=value))
        unique = {row[0]: row for row in rows}
        known += [id_mov for id_mov in unique if id_mov not in known]
        deliveries.append(list(unique.values()))
    return deliveries


def test_cleaning_only_new_rows_equals_cleaning_all(spark, tmp_path):
    """Client C7 is unknown at first and arrives with the third delivery."""
    deliveries = random_batches(1)
    results = {}
    for scope in ("all", "new"):
        lake = Lake(str(tmp_path / scope))
        settings = runs.Settings(scope=scope)
        for number, rows in enumerate(deliveries):
            data = frames(spark)
            data[MOVEMENTS.name] = spark.createDataFrame(rows, MOVEMENTS.schema)
            if number == 2:
                late = ("C7", "Eva", "Ruiz", "CC", "777", None, "2024-05-01", "ELITE", 1, "CALI",
                        "VALLE", "ACTIVO", "WEB")
                data[CUSTOMERS.name] = data[CUSTOMERS.name].union(
                    spark.createDataFrame([late], CUSTOMERS.schema))
            # Deliver everything given, whatever the mark says.
            source = lambda spec, mark, d=data: d[spec.name]
            batch = Batch(f"B{number}", date(2024, 12, 31), datetime(2024, 6, 1 + number, 7))
            only = (CUSTOMERS, MOVEMENTS) if number else (CUSTOMERS, PRODUCTS, MOVEMENTS)
            loaded = runs.run_bronze(spark, lake, source, batch, settings, only)
            cleaned = runs.run_silver(spark, lake, batch, settings, only)
            assert {status for _, _, status, _ in loaded + cleaned} == {"SUCCESS"}
        df = runs.read_silver(spark, lake, MOVEMENTS).drop(*TIMES, "_batch_id_silver")
        assert df.filter("_superseded").count() > 0  # a newer version of an accepted row was refused
        results[scope] = Counter(df.select(*sorted(df.columns)).collect())
        log = read_log(spark, lake, "silver", runs.QUALITY_LOG,
                       "n_input long, n_output long, n_rejected long, pct_conformes double").collect()
        assert all(0 <= r["pct_conformes"] <= 100 and r["n_rejected"] >= 0 for r in log)
        refused = read_log(spark, lake, "errors", "rejects", "reason string, row_key string, payload string")
        assert refused.count() == refused.distinct().count()
    assert results["new"] == results["all"]
    assert {row["ind_sospechoso"] for row in results["new"]} == {0, 1}
    assert "C7" in {row["id_cli"] for row in results["new"]}


def test_tables_of_a_layer_are_processed_side_by_side(spark, tmp_path, monkeypatch):
    meeting = Barrier(3, timeout=120)  # broken unless three tables are on their way at once
    ingest, pending = runs.bronze.ingest_table, runs.pending

    def met(work):
        def step(spark, lake, spec, *rest):
            if spec.watermark and spec is not CUSTOMERS:
                meeting.wait()
            return work(spark, lake, spec, *rest)
        return step

    monkeypatch.setattr(runs.bronze, "ingest_table", met(ingest))
    monkeypatch.setattr(runs, "pending", met(pending))
    lake = Lake(str(tmp_path / "lake"))
    outcomes = runs.run_bronze(spark, lake, frames_source(frames(spark)), FIRST)
    assert [o[0] for o in outcomes] == [spec.name for spec in SOURCE_TABLES]
    outcomes += runs.run_silver(spark, lake, FIRST)
    assert [o[3] for o in outcomes] == [""] * 12
    marks = {spec.name for spec in SOURCE_TABLES if spec.watermark and read_mark(spark, lake, spec.name)}
    assert marks == {spec.name for spec in SOURCE_TABLES if spec.watermark}  # no mark lost to another's


def test_rows_and_rejects_of_a_table_are_written_side_by_side(spark, tmp_path, monkeypatch):
    meeting = Barrier(3, timeout=120)  # valid rows, waiting and final rejects
    append, upsert = runs.rejects.append_table, runs.upsert_table

    def append_met(df, lake, layer, name, /, **slice_of):
        if name == runs.rejects.REJECTS and slice_of["source_table"] == MOVEMENTS.name:
            meeting.wait()
        append(df, lake, layer, name, **slice_of)

    def upsert_met(df, lake, layer, name, *rest, **more):
        if (layer, name) == ("silver", MOVEMENTS.name):
            meeting.wait()
        return upsert(df, lake, layer, name, *rest, **more)

    monkeypatch.setattr(runs.rejects, "append_table", append_met)
    monkeypatch.setattr(runs, "upsert_table", upsert_met)
    lake = Lake(str(tmp_path / "lake"))
    outcomes = runs.run_bronze(spark, lake, frames_source(frames(spark)), FIRST) + runs.run_silver(spark, lake, FIRST)
    assert [o[3] for o in outcomes] == [""] * 12


def test_states_are_staged_once_and_kpis_need_no_locator(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    for batch in (FIRST, SECOND):
        outcomes = runs.run_bronze(spark, lake, frames_source(frames(spark)), batch)
        outcomes += runs.run_silver(spark, lake, batch) + runs.run_gold(spark, lake, batch)
        assert not [o[3] for o in outcomes if o[3]]
    staged = {path.name for path in (tmp_path / "lake" / "_stage").iterdir()}
    assert {"gold_state", "gold_income", "gold_state_gone", "gold_income_gone"} <= staged
    assert not (tmp_path / "lake" / "_stage" / "gold__state").exists()  # what `keep` wrote once more
    located = {path.name for path in (tmp_path / "lake" / "_locator" / "gold").iterdir()}
    assert located == {"fact_cartera", "fact_transacciones"}
