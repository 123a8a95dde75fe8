"""What batches on changes alone rest on: spans of windows, month states, waiting rejects, places of keys."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bank_rows import LOAN_ROWS, frames, movement
from caudal.functions.audit import INGEST_PARTS, with_audit, with_date_parts
from caudal.functions.rules import provision
from caudal.operators.clean import PAYLOAD, REASON, row_key, start_tags, tag
from caudal.plans import batch as runs
from caudal.plans import bronze, changes, gold, rejects, silver, state
from caudal.sources import locator
from caudal.sources.files import read_csv, scan_csv, split_csv
from caudal.sources.tables import append_table, overwrite_table, read_log, read_table, upsert_table
from caudal.specs import (
    AMOUNT_OUT_OF_RANGE, CUSTOMERS, DATE_OUT_OF_RANGE, LOANS, MOVEMENTS, UNKNOWN_CLIENT, UNKNOWN_PRODUCT, Batch,
)
from plans_text import final_plan

B1 = Batch("B1", date(2024, 12, 31), datetime(2024, 6, 1, 7))
B2 = Batch("B2", date(2024, 12, 31), datetime(2024, 6, 2, 7))
B3 = Batch("B3", date(2024, 12, 31), datetime(2024, 6, 3, 7))


# Windows

def test_window_spans(spark):
    rng = random.Random(4)
    start = date(2023, 1, 1)
    days = {(c, start + timedelta(days=rng.randrange(500))) for c in "abc" for _ in range(9)} | {("d", start)}
    spans = silver.window_spans(spark.createDataFrame(sorted(days), "id_cli string, day date")).collect()
    for client in "abcd":
        own = [r for r in spans if r.id_cli == client]
        for n in range(-40, 560):
            day = start + timedelta(days=n)
            hit = [r for r in own if r._start <= day <= r._end]
            near = any(abs((day - d).days) <= 30 for c, d in days if c == client)
            assert len(hit) <= 1 and (not near or hit)
            again = bool(hit) and any(i.after < day <= i.to for i in hit[0]._again)
            inside = [d for c, d in days if c == client and 0 <= (day - d).days <= 30]
            # A changed day that another interval covers is flagged again with it.
            assert again >= any(day != d for d in inside) or not inside
            assert not again or inside
    months = {r.month for r in silver.span_months(spark.createDataFrame(
        [(date(2023, 12, 20), date(2024, 2, 3)), (date(2024, 2, 1), date(2024, 2, 2))], "_start date, _end date")).collect()}
    assert months == {"202312", "202401", "202402"}


def prepared(spark, rows):
    """(id_mov, id_cli, day, amount, reason) as prepared movements."""
    return spark.createDataFrame(
        [(i, c, d, v, "10:00:00", r, None) for i, c, d, v, r in rows],
        f"id_mov string, id_cli string, fec_mov date, vr_mov double, hra_mov string, {REASON} string, {PAYLOAD} string")


def test_refresh_equals_flagging_everything(spark):
    """Late rows years apart, a row that moves to another day and client, and a refused version."""
    rng = random.Random(2)
    start = date(2020, 1, 1)
    old = [(f"m{n}", rng.choice("ab"), start + timedelta(days=rng.randrange(900)), rng.choice([10.0, 11.0, 500.0]), None)
           for n in range(160)]
    new = [("n1", "a", start + timedelta(days=40), 900.0, None), ("n2", "a", start + timedelta(days=860), 9.0, None),
           ("m5", "b", start + timedelta(days=77), 700.0, None), ("m6", old[6][1], date(2099, 1, 1), 1.0, DATE_OUT_OF_RANGE)]
    columns = ["id_mov", "id_cli", "fec_mov", "vr_mov", "ind_sospechoso"]
    existing = silver.flag_movements(prepared(spark, old)).filter(F.col(REASON).isNull()).drop(REASON, PAYLOAD)
    fresh = prepared(spark, new)
    spans = silver.window_spans(silver.changed_days(fresh, existing))
    out = silver.refresh_movements(fresh, existing, spans)
    refreshed = {r.id_mov: tuple(r)[:5] for r in out.filter(F.col(REASON).isNull()).select(*columns).collect()}
    merged = {r.id_mov: tuple(r)[:5] for r in existing.select(*columns).collect()} | refreshed
    accepted = {r[0]: r for r in old} | {r[0]: r for r in new if r[4] is None}
    whole = silver.flag_movements(prepared(spark, list(accepted.values())))
    assert merged == {r.id_mov: tuple(r)[:5] for r in whole.select(*columns).collect()}
    changed = [(c, d) for _, c, d, _, r in new if r is None] + [old[5][1:3]]
    for id_mov in refreshed.keys() - {r[0] for r in new}:  # no row between the changes is touched
        _, client, day, _, _ = accepted[id_mov]
        assert any(c == client and 0 <= (day - d).days <= 30 for c, d in changed)
    marks = {r.id_mov: r[silver.REFRESHED] for r in out.collect()}
    assert marks["n1"] is marks["m6"] is False and any(marks.values()) and len(refreshed) < 100


def test_a_refused_version_marks_the_accepted_row(spark):
    existing = spark.createDataFrame([("m1", 1.0), ("m2", 2.0), ("m3", 3.0)], "id_mov string, v double")
    tagged = spark.createDataFrame([("m1", "R"), ("m2", "R"), ("m2", None), ("m9", "R")], f"id_mov string, {REASON} string")
    assert [tuple(r) for r in silver.superseded_rows(tagged, existing, ("id_mov",)).collect()] == [("m1", 1.0, True)]


def test_amounts_beyond_exact_sums_are_refused(spark):
    data = frames(spark)
    rows = [movement("A1", value=9.9e21), movement("A2", value=1e22), movement("A3", value=float("nan")),
            movement("A4", value=float("-inf")), movement("A5", value=2e16), movement("A6", value=-1e16)]
    tagged = silver.prepare_movements(spark.createDataFrame(rows, MOVEMENTS.schema), data["TB_CLIENTES_CORE"],
                                      data["TB_PRODUCTOS_CAT"])
    reasons = {r.id_mov: r[REASON] for r in tagged.collect()}
    assert {i for i, r in reasons.items() if r == AMOUNT_OUT_OF_RANGE} == {"A2", "A3", "A4"}
    assert reasons["A1"] is reasons["A5"] is reasons["A6"] is None


# States of gold

def loan_facts(spark, rows):
    return spark.createDataFrame(rows, "id_oblig string, id_cli string, anio_desembolso string, mes_desembolso string, "
                                 "cod_prod string, tip_prod string, cod_segmento string, depto_res string, "
                                 "sdo_capital double, provision_estimada double, ind_en_mora int")


def random_loans(rng, n):
    return {f"L{k}": (f"L{k}", f"C{rng.randrange(40)}", rng.choice(["2023", "2024", None]), rng.choice(["01", "02"]),
                      rng.choice(["P1", "P2"]), "T", rng.choice(["S1", None]), "D", rng.choice([1e3, 0.1, 2e16, None]),
                      rng.choice([0.05, 7.0]), rng.randrange(2)) for k in range(n)}


def test_portfolio_state_over_three_deliveries(spark):
    """Only the months of changed loans are recomputed; the KPIs equal those of one build."""
    rng = random.Random(6)
    loans, numbers, kept = {}, None, None
    for delivery in range(3):
        fresh = random_loans(rng, 60 + 30 * delivery)
        fresh = {k: v for k, v in fresh.items() if delivery == 0 or rng.random() < 0.2}
        touched = {v[2:4] for v in fresh.values()} | {loans[k][2:4] for k in fresh if k in loans}
        loans |= fresh
        fact = loan_facts(spark, list(loans.values()))
        months = fact.filter(changes.in_parts(list(touched), ("anio_desembolso", "mes_desembolso")))
        placed = spark.createDataFrame(state.new_clients(numbers, months).collect(), "id_cli string, _id long")
        more = state.numbered_clients(numbers, placed).collect()
        numbers = spark.createDataFrame((numbers.collect() if numbers else []) + more, "id_cli string, number long")
        now = state.portfolio_state(months, numbers)
        if kept is not None:
            inside = changes.in_parts(list(touched), ("_anio", "_mes"))
            now = now.unionByName(state.emptied_portfolio(kept.filter(inside), now))
            now = kept.filter(~inside).unionByName(now)
        kept = spark.createDataFrame(now.collect(), now.schema)
    assert sorted(r.number for r in numbers.collect()) == list(range(numbers.count()))
    got = state.kpis_from_state(kept, date(2024, 1, 31))
    want = gold.build_daily_kpis(fact, date(2024, 1, 31))
    assert got.columns == [*want.columns[:9], *got.columns[9:]] or set(got.columns) == set(want.columns)
    assert Counter(got.select(*want.columns).collect()) == Counter(want.collect())
    assert max(r.clientes_con_mora for r in want.collect()) > 5


@pytest.mark.parametrize("as_of", [date(2024, 2, 29), date(2024, 3, 31), date(2024, 1, 1), date(2023, 12, 31), date(2024, 5, 15)])
def test_whole_and_partly_covered_months(spark, as_of):
    whole, partly = state.whole_months(as_of)
    low = spark.range(1).select(F.add_months(F.lit(as_of), -12)).head()[0]
    covered, seen = defaultdict(set), low
    while seen <= as_of:
        covered[f"{seen:%Y-%m}"].add(seen.day)
        seen += timedelta(days=1)
    assert sorted(whole + partly) == sorted(covered)
    for period, days in covered.items():
        after = date(int(period[:4]) + (period[5:] == "12"), int(period[5:]) % 12 + 1, 1)
        assert (len(days) == (after - timedelta(days=1)).day) == (period in whole)


def test_client_value_from_state_equals_one_build(spark):
    rng = random.Random(3)
    day = lambda: date(2023, 1, 1) + timedelta(days=rng.randrange(520))
    fees = spark.createDataFrame([(f"C{rng.randrange(8)}", day(), rng.randrange(1, 9999) / 100,
                                   rng.choice(["COBRADO", "PENDIENTE"])) for _ in range(150)],
                                 "id_cli string, fec_cobro date, vr_comision double, estado_cobro string")
    loans = spark.createDataFrame([(f"C{rng.randrange(8)}", rng.choice(["P1", "P2", "P9"]), rng.choice([day(), None]),
                                    rng.choice([1e6, 33.33, None])) for _ in range(60)],
                                  "id_cli string, cod_prod string, fec_desembolso date, sdo_capital double")
    moves = spark.createDataFrame([(f"C{rng.randrange(12)}", day()) for _ in range(90)], "id_cli string, fec_mov date")
    products = spark.createDataFrame([("P1", 1.2345), ("P2", None)], "cod_prod string, tasa_mensual_pct double")
    customers = spark.createDataFrame([(f"C{n}", "S", "ACTIVO") for n in range(6)],
                                      "id_cli string, cod_segmento string, estado_cli string")
    as_of = date(2024, 4, 17)
    want = gold.build_client_value(fees, loans, moves, products, customers, as_of)
    rows = state.income_rows(fees, loans, moves, products)
    kept = state.income_state(rows)
    kept = kept.unionByName(state.emptied_income(kept.limit(1).withColumn("id_cli", F.lit("gone")), kept))
    got = state.value_from_state(kept, rows, customers, as_of)
    assert Counter(got.select(*want.columns).collect()) == Counter(want.collect()) and want.count() == 8


# Rejects

def refused(spark, rows):
    """(key, client, product, reason) as tagged loans."""
    base = LOAN_ROWS[0]
    df = spark.createDataFrame([(k, c, p, *base[3:]) for k, c, p, _ in rows], LOANS.schema)
    tagged = start_tags(df)
    for key, _, _, reason in rows:
        if reason:
            tagged = tag(tagged, F.col("id_oblig") == key, reason)
    return tagged


def test_waiting_rejects_are_taken_up_once_and_closed(spark, lake):
    first = refused(spark, [("L1", "C1", "P1", UNKNOWN_CLIENT), ("L2", "C2", "P9", UNKNOWN_CLIENT),
                            ("L3", "C1", "P1", "OTHER"), ("L4", "C1", "P8", UNKNOWN_PRODUCT), ("L5", "C5", "P1", None)])
    nothing = rejects.open_rejects(spark, lake, LOANS, B1)
    rejects.write_rejects(first, lake, LOANS, B1, nothing)
    assert rejects.open_rejects(spark, lake, LOANS, B1).count() == 0  # a rerun does not see its own
    waiting = rejects.open_rejects(spark, lake, LOANS, B2, (rejects.WAITING,))
    assert {(r.row_key, r.ref_key) for r in waiting.collect()} == {("L1", "C1"), ("L2", "C2"), ("L4", "P8")}
    assert "kind" in final_plan(waiting).split("PartitionFilters: ")[1].split("]")[0]

    customers = spark.createDataFrame([("C1",), ("C2",)], "id_cli string")
    products = spark.createDataFrame([("P1",)], "cod_prod string")
    ready = rejects.arrived(waiting, customers, products)
    again = rejects.refused_rows(ready, LOANS)
    assert {r.id_oblig for r in again.collect()} == {"L1", "L2"}
    assert Counter(again.collect()) == Counter(first.filter("id_oblig IN ('L1', 'L2')").select(*LOANS.columns).collect())

    second = refused(spark, [("L1", "C1", "P1", None), ("L2", "C2", "P9", UNKNOWN_PRODUCT)])
    rejects.write_rejects(second, lake, LOANS, B2, waiting)
    rejects.close_rejects(second, lake, LOANS, B2, waiting, ready)
    third = rejects.open_rejects(spark, lake, LOANS, B3)
    assert {(r.row_key, r.reason) for r in third.collect()} == {
        ("L2", UNKNOWN_PRODUCT), ("L3", "OTHER"), ("L4", UNKNOWN_PRODUCT)}
    assert Counter((r.row_key, r.reason) for r in rejects.still_rejected(spark, lake).collect()) == Counter(
        [("L2", UNKNOWN_PRODUCT), ("L3", "OTHER"), ("L4", UNKNOWN_PRODUCT)])


def test_a_key_of_several_columns_keeps_its_nulls(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "a"), ("a|", None)], "x string, y string")
    assert df.select(row_key(("x", "y")).alias("k")).distinct().count() == 4
    assert [r.k for r in df.select(row_key(("x",)).alias("k")).collect()] == ["a", "", "a", "a|"]


# Bronze and tables

def test_unseen_rows_are_read_from_their_days(spark, lake):
    data = frames(spark)[MOVEMENTS.name]
    for batch in (B1, B2, B3):
        rows = data.limit(4).withColumn("id_mov", F.concat(F.lit(batch.batch_id), "id_mov"))
        rows = with_date_parts(with_audit(rows, "core", batch.batch_id, batch.now), "_ingestion_timestamp", INGEST_PARTS)
        upsert_table(rows, lake, "bronze", MOVEMENTS.name, MOVEMENTS.keys, INGEST_PARTS, unique=False)
        append_table(spark.createDataFrame([(batch.now,)], "noted_at timestamp"), lake, "bronze", bronze.INGEST_DAYS,
                     table_name=MOVEMENTS.name, batch_id=batch.batch_id, day=f"{batch.now:%Y-%m-%d}")
    append_table(spark.createDataFrame([(4,)], "n_input long"), lake, "silver", runs.QUALITY_LOG, batch_id="B1",
                 table_name=MOVEMENTS.name)
    unseen = runs.unseen_rows(spark, lake, MOVEMENTS, B3)
    assert {r["_batch_id"] for r in unseen.collect()} == {"B2", "B3"}
    filters = final_plan(unseen).split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "2024-06-02" in filters and "2024-06-03" in filters and "2024-06-01" not in filters


def test_the_locator_names_the_partition_of_a_moved_key(spark, lake):
    def rows(*data):
        return spark.createDataFrame(list(data), "k string, p string, v int")

    def put(df):
        return sorted(upsert_table(df, lake, "x", "t", ("k",), ("p",)))

    assert put(rows(("a", "1", 1), ("b", "2", 1), (None, "3", 1))) == [("1",), ("2",), ("3",)]
    assert put(rows(("a", "2", 2))) == [("1",), ("2",)]  # the old place is rewritten too
    assert put(rows((None, "1", 5))) == [("1",), ("3",)]
    assert {tuple(r) for r in read_table(spark, lake, "x", "t", ("p",)).collect()} == {
        ("a", "2", 2), ("b", "2", 1), (None, "1", 5)}
    assert put(rows().limit(0)) == []
    known = locator.read(spark, lake, "x", "t", ("k",), ("p",))
    found = locator.partitions_of(known, rows(("b", "9", 0)), ("k",), ("p",))
    assert [r.p for r in found.collect()] == ["2"]
    assert "In(bucket" in final_plan(found).split("PushedFilters: ")[1] or "EqualTo(bucket" in final_plan(found)


def test_a_table_without_locator_gets_one(spark, lake):
    rows = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, p string")
    overwrite_table(rows, lake, "x", "u", ("p",))
    assert locator.read(spark, lake, "x", "u", ("k",), ("p",)) is None
    moved = spark.createDataFrame([("a", "2")], "k string, p string")
    assert sorted(upsert_table(moved, lake, "x", "u", ("k",), ("p",))) == [("1",), ("2",)]
    assert {tuple(r) for r in read_table(spark, lake, "x", "u", ("p",)).collect()} == {("a", "2"), ("b", "2")}


def test_notes_of_changes_add_up(spark, lake):
    changes.note_parts(spark, lake, LOANS, B1, [("2024", "01"), (None, None)])
    changes.note_parts(spark, lake, LOANS, B1, [("2023", "12")])  # a rerun
    changes.note_parts(spark, lake, MOVEMENTS, B2, [("2024", "02")])
    key = spark.createDataFrame([("C1",)], "key string")
    changes.note_keys(spark, lake, CUSTOMERS, B1, key)
    changes.note_keys(spark, lake, CUSTOMERS, B1, key.limit(0))
    noted = changes.read_changes(spark, lake)
    assert noted.batches == ("B1", "B2") and set(noted.parts[LOANS.name]) == {("2024", "01"), (None, None), ("2023", "12")}
    assert noted.months(LOANS, MOVEMENTS) == [("2023", "12"), ("2024", "01"), ("2024", "02")]
    assert [r.id_cli for r in noted.changed(CUSTOMERS, "id_cli").collect()] == ["C1"]
    rows = spark.createDataFrame([("2024", "01"), ("2024", "02"), (None, None), ("2023", "12")], "a string, b string")
    assert rows.filter(changes.in_parts(noted.parts[LOANS.name], ("a", "b"))).count() == 3
    changes.forget_changes(spark, lake)
    assert changes.read_changes(spark, lake).batches == ()


def test_corrupt_lines_are_kept_apart(spark, lake, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "t.csv").write_text('a,b\n1,2\nx,3\n4\n5,6,7\n8,\n"9,9",1\n')
    scanned = scan_csv(spark, str(tmp_path / "in" / "t.csv"), "a int, b int")
    good, bad = split_csv(scanned)
    assert {tuple(r) for r in good.collect()} == {(1, 2), (8, None)}
    assert {r.line for r in bad.collect()} == {"x,3", "4", "5,6,7", '"9,9",1'}
    assert {r.a for r in good.select("a").collect()} == {1, 8} and len(bad.select("a", "line").collect()) == 4
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, str(tmp_path / "in" / "t.csv"), "a int, b int").collect()

    names = ",".join(CUSTOMERS.columns)
    (tmp_path / "in" / f"{CUSTOMERS.name}.csv").write_text(
        f"{names}\nC1,Ana,Paz,CC,1,2001-01-01,2024-01-02,ELITE,7,CALI,VALLE,ACTIVO,WEB\nC2,short\n")
    source = bronze.csv_source(spark, lake, str(tmp_path / "in"), B1)
    assert [r.id_cli for r in source(CUSTOMERS, None).collect()] == ["C1"]
    entries = rejects.read_rejects(spark, lake).collect()
    assert [(r.reason, r.row_key, r.payload, r.kind) for r in entries] == [
        ("LINEA_ILEGIBLE", "C2", "C2,short", "malformed")]


def test_money_holds_amounts_below_the_limit(spark):
    df = spark.createDataFrame([(2e16, "E"), (8e21, "A")], "v double, g string")
    assert [r[0] for r in df.select(provision("v", "g")).collect()] == pytest.approx([2e16, 8e19])
    assert df.select(F.sum(F.col("v").cast("decimal(24,2)"))).head()[0] == Decimal("8000020000000000000000.00")
