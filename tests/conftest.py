import datetime
import os
import sys
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewharf.schemas import RAW  # noqa: E402
from tidewharf.sources.tables import SupplyTables  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text):
    return datetime.date.fromisoformat(text)


def table(spark, name, rows):
    """Rows given as dicts; missing columns are null and numbers become the column's decimals."""
    schema = RAW[name]
    out = []
    for row in rows:
        unknown = set(row) - set(schema.fieldNames())
        assert not unknown, unknown
        out.append(tuple(
            Decimal(str(row[f.name])) if f.dataType.typeName() == "decimal" and row.get(f.name) is not None
            else row.get(f.name)
            for f in schema.fields
        ))
    return spark.createDataFrame(out, schema)


def order(number, **changes):
    base = {
        "order_id": f"ORD{number:07d}", "product_id": "P00001", "warehouse_id": "W001", "supplier_id": "S001",
        "customer_region": "North", "quantity": 10, "unit_price": 5, "total_amount": 50,
        "order_date": day("2024-03-01"), "expected_delivery": day("2024-03-06"), "delivery_date": day("2024-03-05"),
        "order_status": "Delivered", "is_on_time": True, "fill_rate": 0.9,
    }
    return {**base, **changes}


@pytest.fixture(scope="session")
def raw(spark):
    """A small raw table set with repeated keys, gaps and out-of-range values."""
    rows = {
        "products": [
            {"product_id": "P00001", "product_name": "bolt", "category": "Metal", "unit_cost": 4, "selling_price": 5},
            {"product_id": "P00001", "product_name": "bolt", "category": "Metal", "unit_cost": 4, "selling_price": 6},
            {"product_id": "P00002", "product_name": "nut", "category": "Metal", "unit_cost": -3, "selling_price": -5,
             "is_active": False},
            {"product_id": "P00003", "product_name": None, "category": "Wood", "unit_cost": 1, "selling_price": 2},
            {"product_id": "P00004", "product_name": "beam", "category": "Wood", "unit_cost": 9, "selling_price": 2},
        ],
        "warehouses": [
            {"warehouse_id": "W001", "warehouse_name": "one", "location": "A", "region": "North", "capacity_units": 0,
             "current_utilization": 1.5},
            {"warehouse_id": "W002", "warehouse_name": "two", "location": "B", "region": "South", "capacity_units": 100,
             "current_utilization": None},
            {"warehouse_id": "W003", "warehouse_name": "three", "location": None, "region": "East", "capacity_units": 5},
        ],
        "suppliers": [
            {"supplier_id": "S001", "supplier_name": "first", "lead_time_days": 6, "reliability_score": 120,
             "defect_rate": None},
            {"supplier_id": "S002", "supplier_name": "second", "lead_time_days": -1, "reliability_score": 88.5,
             "defect_rate": 0.02},
            {"supplier_id": "S003", "supplier_name": None, "lead_time_days": 3},
        ],
        "product_suppliers": [
            {"product_id": "P00001", "supplier_id": "S001", "is_primary": True},
            {"product_id": "P00001", "supplier_id": "S001", "is_primary": True},
            {"product_id": "P00002", "supplier_id": "S001", "is_primary": False},
        ],
        "inventory": [
            {"product_id": "P00001", "warehouse_id": "W001", "current_stock": -10, "reorder_point": 5, "safety_stock": 2,
             "max_stock": 50},
            {"product_id": "P00001", "warehouse_id": "W002", "current_stock": 40, "reorder_point": None,
             "safety_stock": 2, "max_stock": 50},
            {"product_id": "P00002", "warehouse_id": "W001", "current_stock": 7, "reorder_point": 3, "safety_stock": 9,
             "max_stock": None},
            {"product_id": "P00004", "warehouse_id": "W001", "current_stock": 9, "reorder_point": 3, "safety_stock": 2,
             "max_stock": 0},
            {"product_id": "P00004", "warehouse_id": None, "current_stock": 9},
        ],
        "orders": [
            order(1), order(1),
            order(2, quantity=0, fill_rate=None),
            order(3, delivery_date=day("2024-02-01"), expected_delivery=day("2024-02-01"), is_on_time=None),
            order(4, quantity=None),
            order(5, order_status="Pending", delivery_date=None, is_on_time=None, product_id="P00002"),
            order(6, order_status="Returned", is_on_time=False, fill_rate=1.4, warehouse_id="W002"),
        ],
        "logistics": [
            {"shipment_id": "SHP1", "order_id": "ORD0000001", "carrier": "UPS", "route": "W001 -> North",
             "origin_warehouse": "W001", "shipping_cost": -4, "distance_km": 0, "ship_date": day("2024-03-01"),
             "actual_delivery": day("2024-03-05"), "delivery_status": "Delivered", "delay_days": None},
            {"shipment_id": "SHP2", "order_id": "ORD0000002", "carrier": "UPS", "route": "W001 -> North",
             "origin_warehouse": "W001", "shipping_cost": 20, "distance_km": 10, "ship_date": day("2024-03-02"),
             "delivery_status": "Lost", "delay_days": 4},
            {"shipment_id": "SHP3", "order_id": "ORD0000009", "carrier": None, "route": "W001 -> North",
             "shipping_cost": 20, "delivery_status": "Returned"},
        ],
        "demand_history": [
            {"product_id": "P00001", "warehouse_id": "W001", "demand_date": day("2024-03-01"), "demand_quantity": 20},
            {"product_id": "P00001", "warehouse_id": "W001", "demand_date": day("2024-03-01"), "demand_quantity": 30},
            {"product_id": "P00001", "warehouse_id": "W001", "demand_date": day("2024-03-02"), "demand_quantity": -2},
            {"product_id": "P00002", "warehouse_id": "W001", "demand_date": None, "demand_quantity": 3},
        ],
    }
    return {name: table(spark, name, values) for name, values in rows.items()}


@pytest.fixture(scope="session")
def cleaned(raw):
    from tidewharf.operators.clean import transform

    return transform(raw)


@pytest.fixture(scope="session")
def tables(cleaned):
    return SupplyTables(cleaned)
