import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import day, order, table
from tidewharf.operators import clean, quality
from tidewharf.sources import files, sinks


def rows(df, key):
    return {r[key]: r for r in df.collect()}


def test_products(cleaned):
    got = rows(cleaned["products"], "product_id")
    assert set(got) == {"P00001", "P00002", "P00004"}
    assert got["P00001"].selling_price == 5  # the first of the two in column order
    assert (got["P00002"].unit_cost, got["P00002"].selling_price, got["P00002"].is_active) == (0, 0, False)
    assert got["P00004"].selling_price == 9 and got["P00004"].is_active is True


def test_warehouses_and_suppliers(cleaned):
    places = rows(cleaned["warehouses"], "warehouse_id")
    assert set(places) == {"W001", "W002"}
    assert (places["W001"].capacity_units, places["W001"].current_utilization) == (1, 1)
    assert places["W002"].current_utilization is None
    firms = rows(cleaned["suppliers"], "supplier_id")
    assert set(firms) == {"S001", "S002"}
    assert (firms["S001"].reliability_score, firms["S001"].defect_rate) == (100, 0)
    assert firms["S002"].lead_time_days == 0


def test_orders(cleaned):
    got = rows(cleaned["orders"], "order_id")
    assert len(got) == 5
    assert got["ORD0000002"].quantity == 1 and got["ORD0000002"].fill_rate == 1
    third = got["ORD0000003"]
    assert (third.delivery_date, third.expected_delivery) == (day("2024-03-01"), day("2024-03-04"))
    assert third.is_on_time is False
    assert (third.contracted_lead_time, third.actual_lead_time, third.lead_time_variance) == (6, 0, -6)
    assert got["ORD0000005"].actual_lead_time is None and got["ORD0000006"].fill_rate == 1


def test_inventory(cleaned):
    stock = cleaned["inventory"]
    assert stock.agg(F.min("current_stock")).first()[0] >= 0
    assert stock.filter(F.col("stock_status").isNull()).count() == 0
    got = {(r.product_id, r.warehouse_id): r for r in stock.collect()}
    assert len(got) == 4
    # Delivered units of P00001: 10 + 1 + 10, a year's half; its mean stock is (0 + 40) / 2.
    assert float(got["P00001", "W002"].inventory_turnover) == 0.525
    assert float(got["P00001", "W002"].days_of_inventory) == 695.24
    assert got["P00001", "W001"].stock_status == "Stock Out"
    assert got["P00002", "W001"].stock_status == "Low Stock" and got["P00002", "W001"].days_of_inventory == 999
    assert got["P00004", "W001"].stock_status == "Overstocked"
    assert got["P00001", "W002"].inventory_value == 160


def test_logistics_and_demand(cleaned):
    got = rows(cleaned["logistics"], "shipment_id")
    assert set(got) == {"SHP1", "SHP2"}
    assert (got["SHP1"].shipping_cost, got["SHP1"].delay_days, got["SHP1"].is_delayed) == (0, 0, False)
    assert got["SHP2"].is_delayed is True
    demand = sorted((r.demand_date, r.demand_quantity) for r in cleaned["demand_history"].collect())
    assert demand == [(day("2024-03-01"), 20), (day("2024-03-02"), 0)]


@pytest.mark.parametrize("parts", [1, 32])
def test_dedupe_is_the_same_on_any_partitioning(spark, parts):
    rows = [order(1, quantity=q) for q in range(200, 0, -1)] + [order(n) for n in range(2, 60)]
    df = clean.dedupe(table(spark, "orders", rows).repartition(parts), ["order_id"])
    assert df.count() == 59
    assert df.filter("order_id = 'ORD0000001'").first().quantity == 1


def test_dedupe_limits_before_the_shuffle(raw):
    plan = clean.dedupe(raw["orders"], ["order_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_dropped_rows(raw, cleaned):
    got = clean.dropped_rows(raw["orders"], cleaned["orders"], "orders").first()
    assert (got.rows_before, got.rows_after, got.rows_dropped) == (7, 5, 2)


def test_csv_round_trip_and_missing_file(spark, raw, tmp_path):
    for name, df in raw.items():
        sinks.write(df, f"{tmp_path}/{name}.csv", "csv")
    back = files.extract(spark, str(tmp_path))
    for name, df in raw.items():
        assert sorted(map(str, back[name].collect())) == sorted(map(str, df.collect())), name
    with pytest.raises(AnalysisException):
        files.read_csv(spark, f"{tmp_path}/nowhere", "orders").count()


def test_parameters_are_values(spark, raw):
    text = "SELECT count(*) AS n FROM {orders} WHERE order_id = :id"
    assert files.read_sql(spark, text, {"id": "ORD0000001"}, orders=raw["orders"]).first().n == 2
    assert files.read_sql(spark, text, {"id": "x' OR '1'='1"}, orders=raw["orders"]).first().n == 0


def test_quality_reports(raw, cleaned):
    frame = lambda name, *c: raw[name].select(*c) if c else raw[name]
    names = list(raw)
    unique = {r.table_name: r for r in quality.unique_report(frame, names).collect()}
    assert (unique["orders"].duplicated_keys, unique["orders"].surplus_rows) == (1, 1)
    assert unique["warehouses"].duplicated_keys == 0
    nulls = {(r.table_name, r.column_name): r.null_rows for r in quality.not_null_report(frame, names).collect()}
    assert nulls["products", "product_name"] == 1 and nulls["orders", "quantity"] == 1
    bounds = {r.check_name: r.failed_rows for r in quality.bounds_report(frame, names).collect()}
    assert bounds["unit_cost_not_negative"] == 1 and bounds["quantity_positive"] == 1
    assert bounds["reliability_0_to_100"] == 1 and bounds["capacity_positive"] == 1
    links = {(r.child_table, r.child_column): r.orphan_rows for r in quality.reference_report(frame, names).collect()}
    assert links["logistics", "order_id"] == 1  # SHP3 names an unknown order
    assert links["logistics", "origin_warehouse"] == 0  # a null reference passes
    dates = {r.check_name: r.failed_rows for r in quality.date_report(raw["orders"], raw["inventory"]).collect()}
    assert dates["delivery_before_order"] == 1
    fixed = {r.check_name: r.failed_rows for r in quality.date_report(cleaned["orders"], cleaned["inventory"]).collect()}
    assert set(fixed.values()) == {0}


def test_output_report(spark):
    day_ = "date'2024-01-01'"
    frames = {
        "kpi_executive": spark.sql(f"SELECT {day_} calculation_date UNION ALL SELECT {day_} UNION ALL SELECT null"),
        "kpi_supplier": spark.sql(f"SELECT {day_} calculation_date, 'S1' supplier_id UNION ALL SELECT {day_}, 'S9' UNION ALL SELECT {day_}, null"),
    }
    parents = {"suppliers": spark.sql("SELECT 'S1' supplier_id")}
    pick = lambda of: lambda name, *columns: of[name].select(*columns)
    got = {tuple(r)[:3]: r.failed_rows for r in quality.output_report(pick(frames), list(frames), pick(parents)).collect()}
    assert got == {
        ("kpi_executive", "not_null", "calculation_date"): 1, ("kpi_supplier", "not_null", "calculation_date"): 0,
        ("kpi_supplier", "not_null", "supplier_id"): 1, ("kpi_executive", "unique", "calculation_date"): 1,
        ("kpi_supplier", "reference", "supplier_id"): 1,
    }
