"""Column contracts of every stored table, as Spark types.

Keys are strings in files that carry codes such as ``P00001``; ``TABLE_KEYS`` names them. Spark does
not enforce keys, references or bounds, so they are listed here and checked by ``operators.quality``.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "date": T.DateType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampType(),
}


def _schema(columns: str) -> T.StructType:
    """``"name type, ..."`` as a StructType; unlike ``fromDDL`` it needs no running session."""
    fields = []
    for name, kind, precision, scale in re.findall(r"(\w+) (\w+)(?:\((\d+),(\d+)\))?", columns):
        data_type = T.DecimalType(int(precision), int(scale)) if precision else _TYPES[kind]
        fields.append(T.StructField(name, data_type))
    return T.StructType(fields)


# Raw files as they arrive: nothing is required yet, counts may be negative or missing.
RAW = {
    "products": _schema(
        "product_id string, product_name string, category string, subcategory string, "
        "unit_cost decimal(12,2), selling_price decimal(12,2), weight_kg decimal(8,3), is_active boolean"
    ),
    "warehouses": _schema(
        "warehouse_id string, warehouse_name string, location string, region string, state string, "
        "capacity_units int, current_utilization decimal(5,2), manager_name string, is_active boolean"
    ),
    "suppliers": _schema(
        "supplier_id string, supplier_name string, country string, lead_time_days int, "
        "reliability_score decimal(5,2), defect_rate decimal(5,4), contact_email string, is_active boolean"
    ),
    "product_suppliers": _schema(
        "product_id string, supplier_id string, unit_cost decimal(12,2), is_primary boolean"
    ),
    "inventory": _schema(
        "inventory_id int, product_id string, warehouse_id string, current_stock int, reorder_point int, "
        "safety_stock int, max_stock int, last_restocked date"
    ),
    "orders": _schema(
        "order_id string, product_id string, warehouse_id string, supplier_id string, "
        "customer_region string, quantity int, unit_price decimal(12,2), total_amount decimal(14,2), "
        "order_date date, expected_delivery date, delivery_date date, order_status string, "
        "is_on_time boolean, fill_rate decimal(5,4)"
    ),
    "logistics": _schema(
        "shipment_id string, order_id string, carrier string, route string, origin_warehouse string, "
        "destination_region string, shipping_cost decimal(12,2), distance_km decimal(10,2), "
        "ship_date date, expected_delivery date, actual_delivery date, delivery_status string, "
        "delay_days int, is_delayed boolean"
    ),
    "demand_history": _schema(
        "product_id string, warehouse_id string, demand_date date, demand_quantity int, "
        "revenue decimal(14,2), region string"
    ),
}

# Columns and types of the stored tables; totals are wide enough for any volume, and counts are bigint.
# Stored tables after cleaning; row ids are not stored because (product, warehouse) is the key.
STORED = {
    **RAW,
    "inventory": _schema(
        "product_id string, warehouse_id string, current_stock int, reorder_point int, safety_stock int, "
        "max_stock int, last_restocked date, inventory_value decimal(28,2), "
        "days_of_inventory decimal(10,2), inventory_turnover decimal(10,4), stock_status string"
    ),
    "kpi_inventory": _schema(
        "calculation_date date, warehouse_id string, product_id string, inventory_turnover decimal(10,4), "
        "days_sales_inventory decimal(10,2), carrying_cost decimal(28,2), inventory_accuracy decimal(5,4), "
        "stock_out_rate decimal(5,4), fill_rate decimal(5,4), total_inventory_value decimal(28,2)"
    ),
    "kpi_supplier": _schema(
        "calculation_date date, supplier_id string, reliability_score decimal(5,2), "
        "on_time_delivery_pct decimal(5,2), avg_lead_time decimal(8,2), defect_rate decimal(5,4), "
        "total_orders bigint, total_spend decimal(28,2), supplier_rank bigint"
    ),
    "kpi_logistics": _schema(
        "calculation_date date, carrier string, route string, avg_delivery_time decimal(8,2), "
        "transportation_cost decimal(28,2), delayed_shipment_rate decimal(5,4), total_shipments bigint, "
        "on_time_pct decimal(5,2)"
    ),
    "kpi_service": _schema(
        "calculation_date date, warehouse_id string, fill_rate decimal(5,4), order_accuracy decimal(5,4), "
        "stock_out_frequency decimal(5,4), avg_order_cycle_time decimal(8,2), "
        "customer_satisfaction decimal(5,2)"
    ),
    "kpi_executive": _schema(
        "calculation_date date, total_products bigint, total_inventory_value decimal(28,2), "
        "stock_out_rate decimal(5,4), fill_rate decimal(5,4), forecast_accuracy decimal(5,4), "
        "avg_supplier_reliability decimal(5,2), total_orders bigint, revenue decimal(28,2)"
    ),
    "forecasts": _schema(
        "product_id string, warehouse_id string, region string, forecast_date date, horizon_months int, "
        "model_name string, predicted_demand decimal(12,2), lower_bound decimal(12,2), "
        "upper_bound decimal(12,2), rmse decimal(12,4), mae decimal(12,4), mape decimal(8,4)"
    ),
    "inventory_recommendations": _schema(
        "product_id string, warehouse_id string, recommendation_date date, current_stock int, "
        "recommended_reorder int, expected_demand decimal(12,2), safety_stock int, eoq int, "
        "reorder_point int, priority string, status string"
    ),
    "business_insights": _schema(
        "insight_date date, category string, entity_type string, entity_id string, metric_name string, "
        "metric_value decimal(14,4), threshold_value decimal(14,4), severity string, title string, "
        "description string, recommendation string, is_acknowledged boolean"
    ),
    "inventory_alerts": _schema(
        "alert_date date, product_id string, warehouse_id string, alert_type string, current_stock int, "
        "reorder_point int, message string, severity string"
    ),
    "supplier_scorecards": _schema(
        "scorecard_date date, supplier_id string, reliability_score decimal(5,2), "
        "avg_lead_time decimal(8,2), on_time_pct decimal(5,2), defect_rate decimal(5,4), "
        "overall_grade string, rank_position int"
    ),
    "etl_audit_log": _schema(
        "pipeline_name string, stage string, records_processed bigint, records_failed bigint, "
        "status string, error_message string, started_at timestamp, completed_at timestamp, "
        "duration_seconds decimal(10,2)"
    ),
}

# The eight tables a load writes, parents before children.
SOURCE_TABLES = (
    "products", "warehouses", "suppliers", "product_suppliers",
    "inventory", "orders", "logistics", "demand_history",
)

TABLE_KEYS = {
    "products": ["product_id"],
    "warehouses": ["warehouse_id"],
    "suppliers": ["supplier_id"],
    "product_suppliers": ["product_id", "supplier_id"],
    "inventory": ["product_id", "warehouse_id"],
    "orders": ["order_id"],
    "logistics": ["shipment_id"],
    "demand_history": ["product_id", "warehouse_id", "demand_date"],
    "kpi_executive": ["calculation_date"],
}

REQUIRED = {
    "products": ["product_id", "product_name", "category", "unit_cost", "selling_price"],
    "warehouses": ["warehouse_id", "warehouse_name", "location", "region", "capacity_units"],
    "suppliers": ["supplier_id", "supplier_name", "lead_time_days"],
    "product_suppliers": ["product_id", "supplier_id"],
    "inventory": ["product_id", "warehouse_id", "current_stock", "reorder_point", "safety_stock"],
    "orders": ["order_id", "product_id", "quantity", "order_date", "order_status"],
    "logistics": ["shipment_id", "carrier", "route", "shipping_cost", "delivery_status"],
    "demand_history": ["product_id", "demand_date", "demand_quantity"],
    "kpi_inventory": ["calculation_date"],
    "kpi_supplier": ["calculation_date", "supplier_id"],
    "kpi_logistics": ["calculation_date"],
    "kpi_service": ["calculation_date"],
    "kpi_executive": ["calculation_date"],
    "forecasts": ["forecast_date", "horizon_months", "model_name", "predicted_demand"],
    "inventory_recommendations": ["product_id", "warehouse_id", "recommendation_date"],
    "business_insights": ["insight_date", "category", "title", "description", "recommendation"],
    "inventory_alerts": ["alert_date", "product_id", "warehouse_id", "alert_type"],
    "supplier_scorecards": ["scorecard_date", "supplier_id"],
    "etl_audit_log": ["pipeline_name", "stage", "status", "started_at"],
}

# (table, name of the check, SQL predicate a valid row satisfies)
BOUNDS = [
    ("products", "unit_cost_not_negative", "unit_cost >= 0"),
    ("products", "selling_price_not_negative", "selling_price >= 0"),
    ("warehouses", "capacity_positive", "capacity_units > 0"),
    ("suppliers", "lead_time_not_negative", "lead_time_days >= 0"),
    ("suppliers", "reliability_0_to_100", "reliability_score BETWEEN 0 AND 100"),
    ("orders", "quantity_positive", "quantity > 0"),
    ("logistics", "shipping_cost_not_negative", "shipping_cost >= 0"),
    ("demand_history", "demand_not_negative", "demand_quantity >= 0"),
]

# (child table, child column, parent table, parent column)
REFERENCES = [
    ("product_suppliers", "product_id", "products", "product_id"),
    ("product_suppliers", "supplier_id", "suppliers", "supplier_id"),
    ("inventory", "product_id", "products", "product_id"),
    ("inventory", "warehouse_id", "warehouses", "warehouse_id"),
    ("orders", "product_id", "products", "product_id"),
    ("orders", "warehouse_id", "warehouses", "warehouse_id"),
    ("orders", "supplier_id", "suppliers", "supplier_id"),
    ("logistics", "order_id", "orders", "order_id"),
    ("logistics", "origin_warehouse", "warehouses", "warehouse_id"),
    ("demand_history", "product_id", "products", "product_id"),
    ("demand_history", "warehouse_id", "warehouses", "warehouse_id"),
    ("kpi_inventory", "warehouse_id", "warehouses", "warehouse_id"),
    ("kpi_inventory", "product_id", "products", "product_id"),
    ("kpi_supplier", "supplier_id", "suppliers", "supplier_id"),
    ("kpi_service", "warehouse_id", "warehouses", "warehouse_id"),
    ("forecasts", "product_id", "products", "product_id"),
    ("forecasts", "warehouse_id", "warehouses", "warehouse_id"),
    ("inventory_recommendations", "product_id", "products", "product_id"),
    ("inventory_recommendations", "warehouse_id", "warehouses", "warehouse_id"),
    ("inventory_alerts", "product_id", "products", "product_id"),
    ("inventory_alerts", "warehouse_id", "warehouses", "warehouse_id"),
    ("supplier_scorecards", "supplier_id", "suppliers", "supplier_id"),
]
