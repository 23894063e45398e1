import pytest
from pyspark.sql import functions as F

from tests.conftest import day, order, table
from tidewharf.operators import (
    advanced, basic, insights, intermediate, inventory, kpi, logistics, optimize, suppliers, views,
)
from tidewharf.sources.tables import SupplyTables


def rows(df, key):
    return {r[key]: r for r in df.collect()}


def test_supplier_without_orders(tables):
    perf = rows(views.supplier_performance(tables), "supplier_id")
    second = perf["S002"]
    assert (second.total_orders, second.on_time_pct, second.total_spend) == (0, 0.0, None)
    assert perf["S001"].on_time_pct == pytest.approx(100 * 2 / 5)
    kpis = rows(kpi.supplier_kpis(tables, day("2024-04-01")), "supplier_id")
    assert kpis["S002"].on_time_delivery_pct == 88.5 and kpis["S002"].supplier_rank == 1
    assert kpis["S002"].avg_lead_time == 0.0 and kpis["S001"].on_time_delivery_pct == 40.0
    cards = rows(suppliers.scorecards(tables, day("2024-04-01")), "supplier_id")
    assert (cards["S001"].rank_position, cards["S001"].overall_grade) == (1, "D")
    impact = rows(intermediate.defect_impact(tables), "supplier_id")
    assert impact["S002"].return_rate_pct == 0.0 and impact["S001"].return_rate_pct == 20.0


def test_scorecard_text(tables):
    text = rows(suppliers.scorecard_text(tables, suppliers.scorecards(tables).filter("supplier_id = 'S001'")), "supplier_id")
    assert text["S001"].scorecard.startswith("Supplier: first\n\nReliability Score: 100.0\nAverage Lead Time: 3 Days\n")
    assert "On-Time Deliveries: 40%\nDefect Rate: 0.00%\nOverall Grade: D\nRank: #1" in text["S001"].scorecard
    assert text["S002"].scorecard == "No scorecard found for supplier S002"


def test_null_spend_sorts_first(tables):
    assert [r.supplier_id for r in basic.supplier_volume(tables).collect()] == ["S002", "S001"]


def test_service_kpis_count_unknown_stock_as_in_stock(spark, cleaned):
    orders = table(spark, "orders", [order(1), order(2, product_id="P00009"), order(3, order_status="Returned")])
    t = SupplyTables({**cleaned, "orders": orders})
    got = rows(kpi.service_kpis(t), "warehouse_id")["W001"]
    assert got.stock_out_frequency == pytest.approx(2 / 3)  # P00001 at W001 is empty, P00009 is unknown
    assert got.order_accuracy == pytest.approx(2 / 3)
    assert got.customer_satisfaction == pytest.approx(100 - 200 / 3 - 5)
    assert got.avg_order_cycle_time == 4.0


def test_warehouse_without_delivered_orders_takes_the_overall_fill_rate(tables):
    got = rows(kpi.inventory_kpis(tables, day("2024-04-01")), "warehouse_id")
    assert got["W002"].fill_rate == pytest.approx((0.9 + 1 + 0.9) / 3)
    assert got["W001"].stock_out_rate == pytest.approx(1 / 3)
    assert got["W001"].calculation_date == day("2024-04-01")


def test_executive_row(tables):
    got = kpi.executive_kpis(tables, day("2024-04-01")).first()
    assert (got.total_products, got.total_orders, got.forecast_accuracy) == (2, 5, 0.85)
    assert got.revenue == 150.0 and got.avg_supplier_reliability == pytest.approx((40 + 88.5) / 2)


def test_alerts(tables):
    got = {(r.product_id, r.warehouse_id): r for r in inventory.alerts(tables, day("2024-04-01")).collect()}
    out = got["P00001", "W001"]
    assert (out.alert_type, out.severity) == ("STOCK_OUT", "critical")
    assert out.message == "Product bolt (P00001) is OUT OF STOCK at one (W001)."
    low = got["P00002", "W001"]
    assert (low.alert_type, low.severity, low.message) == ("LOW_STOCK", "medium", "Product nut at one has low stock (7 units).")
    assert inventory.reorder_quantities(tables).first().recommended_reorder == 7  # 5 - 0 + 2


def test_carrier_switch_needs_two_carriers_and_ten_points(spark, cleaned):
    def shipment(i, carrier, late):
        return {
            "shipment_id": f"X{i}", "order_id": "ORD0000001", "carrier": carrier, "route": "W001 -> North",
            "origin_warehouse": "W001", "shipping_cost": 10, "distance_km": 5, "ship_date": day("2024-03-01"),
            "delivery_status": "Delivered", "delay_days": int(late), "is_delayed": late,
        }

    def kinds(shipments):
        t = SupplyTables({**cleaned, "logistics": table(spark, "logistics", shipments)})
        return [r.type for r in logistics.recommendations(t).collect()]

    slow = [shipment(i, "A", i % 2 == 0) for i in range(10)]
    fast = [shipment(10 + i, "B", False) for i in range(10)]
    assert kinds(slow) == ["route_delay", "cost_optimization"]
    assert kinds(slow + fast) == ["route_delay", "cost_optimization", "cost_optimization", "carrier_switch"]


def test_stockout_insight_boundaries(spark, cleaned):
    def stock(warehouse, empty, whole):
        return [
            {"product_id": f"P{i}", "warehouse_id": warehouse, "current_stock": 0 if i < empty else 5, "reorder_point": 1,
             "safety_stock": 1} for i in range(whole)
        ]

    levels = stock("W1", 1, 20) + stock("W2", 2, 20) + stock("W3", 14, 20)
    t = SupplyTables({**cleaned, "inventory": table(spark, "inventory", levels)})
    got = rows(insights.stockouts(t, day("2024-04-01")), "entity_id")
    assert set(got) == {"W2", "W3"}  # exactly 5% does not count
    assert got["W2"].severity == "medium" and got["W3"].severity == "high"
    assert "a 17% increase in stock-outs (14 of 20 SKUs affected)" in got["W3"].description
    assert "a 3% increase" in got["W2"].description


def test_demand_spike_windows(spark, cleaned):
    def demand(product, date, quantity):
        return {"product_id": product, "warehouse_id": "W001", "demand_date": day(date), "demand_quantity": quantity}

    history = [
        demand("up", "2024-03-20", 26), demand("up", "2024-02-20", 20),
        demand("quarter", "2024-03-20", 25), demand("quarter", "2024-02-20", 20),
        demand("small", "2024-03-20", 90), demand("small", "2024-02-20", 10),
        demand("new", "2024-03-20", 90),
        demand("old", "2024-03-20", 90), demand("old", "2024-01-20", 20),
    ]
    t = SupplyTables({**cleaned, "demand_history": table(spark, "demand_history", history)})
    got = insights.demand_spikes(t, day("2024-03-31")).collect()
    assert [r.entity_id for r in got] == ["up"]
    assert got[0].description == "Product up demand increased 30% in the last 30 days (26 vs 20 units)."


def test_insight_order_and_tallies(spark):
    cols = "insight_date date, category string, severity string, entity_id string"
    df = spark.createDataFrame([(day("2024-01-01"), c, s, "e") for c, s in (("x", "medium"), ("x", "high"), ("y", "critical"))], cols)
    assert [r.severity for r in insights.select(df).collect()] == ["critical", "high", "medium"]
    tally = {(r.category, r.severity): r.insight_count for r in insights.tallies(df).collect()}
    assert tally == {("x", None): 2, ("y", None): 1, (None, "high"): 1, (None, "medium"): 1, (None, "critical"): 1, (None, None): 3}
    pct = {(r.category, r.severity): r.pct_of_category for r in insights.severity_dashboard(df).collect()}
    assert pct["x", "high"] == 50.0 and pct["y", "critical"] == 100.0


def test_recommendation_text_of_one_pair(tables):
    rows = optimize.recommendations(tables, as_of=day("2024-04-01"))
    first = rows.select("product_id", "warehouse_id").first()
    got = optimize.recommendation_text(tables, rows, first.product_id, first.warehouse_id).collect()
    assert len(got) == 1 and got[0].recommendation.startswith(f"Product ID: {first.product_id}\n")
    none = optimize.recommendation_text(tables, rows, "nothing", "W9").collect()
    assert [r.recommendation for r in none] == ["No recommendation for nothing at W9"]
    with pytest.raises(ValueError):
        optimize.recommendation_text(tables, rows, "nothing")


def test_lookups_have_bounds(tables):
    from tidewharf.operators import reporting

    for call in (lambda: reporting.top_products(tables, 0), lambda: reporting.delayed(tables, 501)):
        with pytest.raises(ValueError):
            call()


def test_recommendations_without_forecast(tables):
    got = {(r.product_id, r.warehouse_id): r for r in optimize.recommendations(tables, as_of=day("2024-04-01")).collect()}
    row = got["P00001", "W001"]
    # mean demand (20 + 0) / 2 = 10, lead 6: buffer round(1.65 * 3 * sqrt(0.2)) = 2, point 62, expected 900
    assert (row.safety_stock, row.reorder_point, row.expected_demand, row.priority) == (2, 62, 900.0, "critical")
    assert row.eoq == 604 and row.recommended_reorder == 902
    assert "low" not in {r.priority for r in got.values()}


def test_composite_score_is_not_multiplied_by_kpi_runs(tables):
    service, stock = kpi.service_kpis(tables), kpi.inventory_kpis(tables)
    once = rows(kpi.composite_scores(tables, service, stock), "warehouse_id")["W001"]
    twice = rows(kpi.composite_scores(tables, service.unionAll(service), stock.unionAll(stock)), "warehouse_id")["W001"]
    assert once == twice


def test_executive_trend(spark):
    df = spark.createDataFrame(
        [(day("2024-01-01"), 1.0, 0.10, 0.9), (day("2024-01-02"), 1.0, 0.25, 0.9)],
        "calculation_date date, total_inventory_value double, stock_out_rate double, fill_rate double",
    )
    first, second = kpi.executive_trend(df).collect()
    assert first.prev_stock_out_pct is None and second.stock_out_change == 15.0


def test_abc_ties_share_a_class(spark, cleaned):
    levels = [
        {"product_id": p, "warehouse_id": "W001", "current_stock": 1, "reorder_point": 0, "safety_stock": 0} for p in "abcd"
    ]
    stock = table(spark, "inventory", levels).withColumn(
        "inventory_value", F.when(F.col("product_id") == "a", 50).when(F.col("product_id") == "d", 10).otherwise(20).cast("decimal(14,2)")
    )
    names = [{"product_id": p, "product_name": p, "category": "c", "unit_cost": 1, "selling_price": 1} for p in "abcd"]
    t = SupplyTables({**cleaned, "inventory": stock, "products": table(spark, "products", names)})
    got = {r.product_id: (r.cumulative_pct, r.abc_class) for r in advanced.abc_classes(t).collect()}
    assert got == {"a": (0.5, "A"), "b": (0.9, "B"), "c": (0.9, "B"), "d": (1.0, "C")}
