"""What steps leave on disk, and what they do not shuffle or write."""

from collections import Counter
from datetime import date, datetime

from bank_rows import LOAN_ROWS, frames
from caudal.operators.clean import accepted, start_tags, tag
from caudal.plans import bronze, gold, rejects, silver
from caudal.queries import bank, catalog, deliveries
from caudal.sources import locator, tables
from caudal.sources.tables import append_table, overwrite_table, read_table, replace_partitions, upsert_table
from caudal.specs import LOANS, UNKNOWN_CLIENT, Batch
from plans_text import final_plan

B1, B2, B3 = (Batch(f"B{n}", date(2024, 6, 30), datetime(2024, 6, n, 7)) for n in (1, 2, 3))


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k string, p string, v int")


def rows(spark, lake):
    return Counter(tuple(r) for r in read_table(spark, lake, "x", "t", ("p",)).select("k", "p", "v").collect())


def staged(path):
    return {p.parent.name for p in path.glob("_stage/*/batch_id=*")}


def test_partitions_that_only_take_new_keys_are_compared_to_nothing(spark, lake, monkeypatch):
    compared, real = [], tables.without_keys

    def without_keys(df, other, keys):
        compared.append({r.p for r in df.select("p").distinct().collect()})
        return real(df, other, keys)

    monkeypatch.setattr(tables, "without_keys", without_keys)

    def put(*data):
        return sorted(upsert_table(frame(spark, *data), lake, "x", "t", ("k",), ("p",)), key=str)

    assert put(("a", "1", 1), ("b", "2", 1), (None, None, 1)) == [("1",), ("2",), (None,)]
    assert put(("c", "1", 1), ("d", "3", 1)) == [("1",), ("3",)] and compared == []
    assert put(("a", "2", 2), (None, "3", 2)) == [("1",), ("2",), ("3",), (None,)]  # 2 and 3 take keys new to them
    assert compared == [{"1", None}]
    assert rows(spark, lake) == Counter([("c", "1", 1), ("b", "2", 1), ("a", "2", 2), ("d", "3", 1), (None, "3", 2)])


def test_the_locator_is_made_anew_after_a_full_load(spark, lake):
    upsert_table(frame(spark, ("a", "1", 1)), lake, "x", "t", ("k",), ("p",))
    assert locator.read(spark, lake, "x", "t", ("k",), ("p",)).columns == ["key", "p0", "bucket"]  # no texts of keys
    overwrite_table(frame(spark, ("b", "1", 1), ("c", "2", 1)), lake, "x", "t", ("p",))
    assert sorted(upsert_table(frame(spark, ("c", "1", 2)), lake, "x", "t", ("k",), ("p",))) == [("1",), ("2",)]
    assert rows(spark, lake) == Counter([("b", "1", 1), ("c", "1", 2)])


def test_partitions_are_replaced_as_a_whole(spark, lake):
    replace_partitions(frame(spark, ("a", "1", 1), ("b", "1", 1), ("c", "2", 1), ("d", None, 1)), lake, "x", "t", ("p",))
    replace_partitions(frame(spark, ("e", "1", 2), ("f", None, 2)), lake, "x", "t", ("p",))
    replace_partitions(frame(spark), lake, "x", "t", ("p",))
    assert rows(spark, lake) == Counter([("e", "1", 2), ("c", "2", 1), ("f", None, 2)])


def test_a_full_load_is_written_once_and_an_increment_leaves_no_copy(spark, lake, tmp_path):
    data = frames(spark)[LOANS.name]
    assert bronze.ingest_table(spark, lake, LOANS, lambda spec, mark: data, B1)[1:3] == (6, "SUCCESS")
    assert not (tmp_path / "lake" / "_stage").exists()
    more = data.union(spark.createDataFrame([("L9", *LOAN_ROWS[0][1:])], LOANS.schema))
    assert bronze.ingest_table(spark, lake, LOANS, lambda spec, mark: more, B2)[2] == "SUCCESS"
    assert staged(tmp_path / "lake") == set()
    landed = read_table(spark, lake, "bronze", LOANS.name, bronze.INGEST_PARTS)
    assert {r.id_oblig for r in landed.collect()} == {"L1", "L2", "L3", "L4", "L5", "L9"}


def test_rejects_are_joined_to_nothing_where_nothing_was_logged(spark, lake):
    df = spark.createDataFrame([(k, *LOAN_ROWS[0][1:]) for k in ("L1", "L2")], LOANS.schema)
    refused = tag(start_tags(df), df["id_oblig"].isNotNull(), UNKNOWN_CLIENT)
    assert not rejects.has_entries(spark, lake, LOANS, B1)
    for write in rejects.reject_writes(refused, lake, LOANS, B1, None):
        write()
    assert rejects.has_entries(spark, lake, LOANS, B2) and not rejects.has_entries(spark, lake, LOANS, B1)
    waiting = rejects.open_rejects(spark, lake, LOANS, B2, (rejects.WAITING,))
    assert "Join" not in final_plan(waiting) and waiting.count() == 2
    # A log of before names the closed entry by its columns.
    one = waiting.filter("row_key = 'L1'").select(*rejects.SAME)
    append_table(one, lake, "errors", rejects.CLOSED, batch_id="B2", source_table=LOANS.name)
    assert [r.row_key for r in rejects.open_rejects(spark, lake, LOANS, B3).collect()] == ["L2"]
    assert [r.row_key for r in rejects.still_rejected(spark, lake).collect()] == ["L2"]


def test_nulls_and_borders_tell_rejects_apart(spark):
    data = [("a", "b", "c"), ("ab", "", "c"), ("a", "bc", ""), ("a", None, "bc"), ("a", "", "bc"), (None, "a", "bc")]
    df = spark.createDataFrame(data, "reason string, row_key string, payload string")
    assert df.select(rejects._digest().alias("d")).distinct().count() == len(data)
    assert rejects._matching(df, df.limit(0), "left_anti").count() == len(data)
    assert rejects._matching(df, df.unionByName(df), "left_semi").count() == len(data)


def test_two_deliveries_leave_no_copies(spark, tmp_path, monkeypatch):
    data = frames(spark)
    monkeypatch.setattr(deliveries, "_lakes", {})
    monkeypatch.setattr(deliveries, "scratch_lake", lambda spark: tables.Lake(str(tmp_path / "lake")))
    monkeypatch.setattr(deliveries.bank, "RAW", {name: lambda spark, folder, df=df: df for name, df in data.items()})
    lake = deliveries.two_deliveries(spark, "nowhere")
    assert (tmp_path / "lake" / "_stage").exists() and staged(tmp_path / "lake") == set()
    for layer in ("bronze", "silver"):  # delivered in full twice
        assert len(list((tmp_path / "lake" / layer / "TB_PRODUCTOS_CAT").glob("**/*.parquet"))) > 0
        assert len(tables._versions(spark, lake.path(layer, "TB_PRODUCTOS_CAT"))) == 1


def test_the_suite_stages_what_is_read_more_than_once(spark, tmp_path, monkeypatch):
    for name, ddl in bank.SCHEMAS.items():
        spark.createDataFrame([], ddl).write.parquet(str(tmp_path / f"{name}.parquet"))
    kept = []
    monkeypatch.setattr(catalog, "stage", lambda df, lake, name, batch: kept.append(name) or df)
    catalog.quality_suite(spark, str(tmp_path))
    assert set(kept) == {"customers", "products", "branches", "portfolio", "movements"}


def test_client_value_is_the_same_from_loans_and_from_their_fact(spark):
    data = frames(spark)
    customers = accepted(silver.silver_customers(data["TB_CLIENTES_CORE"]))
    products = accepted(silver.silver_products(data["TB_PRODUCTOS_CAT"]))
    loans = accepted(silver.silver_loans(data[LOANS.name], customers, products))
    fees = accepted(silver.silver_fees(data["TB_COMISIONES_LOG"], customers, products))
    moved = accepted(silver.silver_movements(data["TB_MOV_FINANCIEROS"], customers, products))
    dim = gold.build_dim_products(products)
    fact = gold.build_fact_portfolio(loans, customers, dim)
    one, two = (gold.build_client_value(fees, df, moved, dim, customers, date(2024, 12, 31)).collect()
                for df in (loans, fact))
    assert len(one) == 2 and Counter(one) == Counter(two) and fact.count() == loans.count()
