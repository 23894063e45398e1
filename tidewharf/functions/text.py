"""Sentences and text blocks as column expressions.

The wording and number formats below are fixed values: stored alerts, insights and reports must
read exactly so. ``{name}`` is replaced by a column.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewharf.functions.numbers import half_even

# --- Fixed values: texts ---
ALERT_STOCK_OUT = "Product {product_name} ({product_id}) is OUT OF STOCK at {warehouse_name} ({warehouse_id})."
ALERT_REORDER = (
    "Product {product_name} ({product_id})\nCurrent Stock: {current_stock}\n"
    "Reorder Point: {reorder_point}\nStatus: Reorder Required"
)
ALERT_LOW_STOCK = "Product {product_name} at {warehouse_name} has low stock ({current_stock} units)."

SCORECARD = (
    "Supplier: {supplier_name}\n\nReliability Score: {reliability_score}\n"
    "Average Lead Time: {avg_lead_time:0} Days\nOn-Time Deliveries: {on_time_pct:0}%\n"
    "Defect Rate: {defect_pct:2}%\nOverall Grade: {overall_grade}\nRank: #{rank_position}"
)
NO_SCORECARD = "No scorecard found for supplier {supplier_id}"

RECOMMENDATION = (
    "Product ID: {product_id}\nProduct: {product_name}\nWarehouse: {warehouse_id}\n\n"
    "Recommended Reorder: {recommended_reorder} Units\nExpected Demand: {expected_demand:0} Units\n"
    "Safety Stock: {safety_stock} Units\nEOQ: {eoq} Units\nPriority: {priority}"
)
NO_RECOMMENDATION = "No recommendation for {product_id} at {warehouse_id}"

ROUTE_DELAY_METRIC = "{delay_rate_pct:1}% delay rate"
ROUTE_DELAY = (
    "Route {route} via {carrier} has a {delay_rate_pct:1}% delay rate. "
    "Consider alternative carriers or routes."
)
ROUTE_COST_METRIC = "${avg_shipping_cost:2} avg cost"
ROUTE_COST = (
    "Route {route} has high transportation costs (${avg_shipping_cost:2}/shipment). "
    "Negotiate rates or consolidate shipments."
)
CARRIER_METRIC = "{worst_rate:1}% delay vs {best} at {best_rate:1}%"
CARRIER_SWITCH = "Consider shifting volume from {worst} to {best} to reduce delays by ~{gap:1}%."

STOCKOUT_TITLE = "Elevated stock-outs at {warehouse_id}"
STOCKOUT_DESCRIPTION = (
    "Warehouse {warehouse_id} has experienced a {simulated_increase:0}% increase in stock-outs "
    "({stock_outs} of {total_skus} SKUs affected)."
)
STOCKOUT_ADVICE = "Increase safety stock by 15% and review reorder points for affected SKUs."
SUPPLIER_TITLE = "Supplier {supplier_id} delivery delays"
SUPPLIER_DESCRIPTION = "Supplier {supplier_id} has a delivery delay rate of {delay_rate:0}%."
SUPPLIER_ADVICE = "Review supplier contract or switch vendors."
ROUTE_TITLE = "High-risk route: {route}"
ROUTE_DESCRIPTION = (
    "Route {route} via {carrier} has a {delay_pct:1}% delay rate across {total_shipments} shipments."
)
ROUTE_ADVICE = "Evaluate alternative carriers or adjust expected delivery windows."
DEMAND_TITLE = "Demand spike for {product_id}"
DEMAND_DESCRIPTION = (
    "Product {product_id} demand increased {growth:0}% in the last 30 days "
    "({recent_demand:0} vs {prior_demand:0} units)."
)
DEMAND_ADVICE = "Increase forecast and safety stock; verify supplier capacity."
# --- end of fixed values ---


def decimals(value: Column, digits: int) -> Column:
    """Fixed number of decimals, ties to even."""
    return F.format_string(f"%.{digits}f", half_even(value, digits))


def sentence(template: str, **columns: Column) -> Column:
    """Fill ``{column}`` and ``{column:digits}``; columns not given are looked up by name."""
    parts, at = [], 0
    for hole in re.finditer(r"\{(\w+)(?::(\d+))?\}", template):
        if hole.start() > at:
            parts.append(F.lit(template[at:hole.start()]))
        name, digits = hole.group(1), hole.group(2)
        value = columns.get(name, F.col(name))
        parts.append(decimals(value, int(digits)) if digits else value.cast("string"))
        at = hole.end()
    if at < len(template):
        parts.append(F.lit(template[at:]))
    return F.concat(*parts)
