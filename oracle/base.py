"""Common table expressions for the mapped tables and small SQL text helpers."""

from __future__ import annotations

import re


def up(x: str, n: int) -> str:
    """Round half away from zero."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def even(x: str, n: int = 0) -> str:
    """Round half to even on doubles."""
    return f"(round_even(({x}) * {float(10**n)}, 0) / {float(10**n)})"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def mean(x: str) -> str:
    return f"(CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0))"


def mean_if(x: str, cond: str) -> str:
    return f"(CAST(SUM({x}) FILTER (WHERE {cond}) AS DOUBLE) / NULLIF(COUNT({x}) FILTER (WHERE {cond}), 0))"


def share(cond: str) -> str:
    return f"(CAST(COUNT(*) FILTER (WHERE {cond}) AS DOUBLE) / NULLIF(COUNT(*), 0))"


def fmt(x: str, n: int) -> str:
    """Fixed decimals, rounded half to even first."""
    return f"printf('%.{n}f', {even(x, n)})"


STATUS_RULES = """CASE
    WHEN current_stock <= 0 THEN 'Stock Out'
    WHEN current_stock <= reorder_point THEN 'Reorder Required'
    WHEN current_stock <= safety_stock THEN 'Low Stock'
    WHEN current_stock > max_stock THEN 'Overstocked'
    WHEN days_of_inventory > 180 THEN 'Dead Inventory'
    WHEN inventory_turnover > 12 THEN 'Fast Moving'
    ELSE 'Healthy' END"""

CTES: dict[str, str] = {}

CTES["t_line"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
             l_returnflag, l_linestatus, l_shipdate) AS rn
  FROM lineitem) WHERE rn = 1"""

CTES["t_warehouses"] = """
SELECT n_nationkey AS warehouse_id, n_name AS warehouse_name, n_name AS location, r_name AS region,
  CAST(NULL AS VARCHAR) AS state, 50000 + n_nationkey * 15000 AS capacity_units,
  CAST((40 + (n_nationkey * 37) % 55) / 100.0 AS DECIMAL(5,2)) AS current_utilization,
  CAST(NULL AS VARCHAR) AS manager_name, TRUE AS is_active
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""

CTES["t_suppliers"] = """
SELECT s_suppkey AS supplier_id, s_name AS supplier_name, n_name AS country,
  CAST(2 + s_suppkey % 19 AS INTEGER) AS lead_time_days,
  CAST(60 + ((s_suppkey * 7) % 400) / 10.0 AS DECIMAL(5,2)) AS reliability_score,
  CAST((s_suppkey % 50) / 1000.0 AS DECIMAL(5,4)) AS defect_rate,
  CAST(NULL AS VARCHAR) AS contact_email, TRUE AS is_active
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""

CTES["t_products"] = """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS subcategory,
  CAST(ROUND(CAST(p_retailprice AS DECIMAL(12,2)) * (60 + p_size % 30) * 0.01, 2) AS DECIMAL(12,2)) AS unit_cost,
  CAST(p_retailprice AS DECIMAL(12,2)) AS selling_price, CAST(p_size AS DECIMAL(8,3)) AS weight_kg,
  p_partkey % 50 <> 0 AS is_active
FROM part"""

CTES["t_product_suppliers"] = """
SELECT DISTINCT l_partkey AS product_id, l_suppkey AS supplier_id, unit_cost,
  l_suppkey = MIN(l_suppkey) OVER (PARTITION BY l_partkey) AS is_primary
FROM lineitem LEFT JOIN t_products ON product_id = l_partkey"""


def _orders(source: str, delivery: str | None = None) -> str:
    status = """CASE WHEN l_suppkey % 4 = 0 OR (l_linestatus = 'F' AND l_returnflag <> 'R') THEN 'Delivered'
         WHEN l_linestatus = 'F' THEN 'Returned' WHEN l_returnflag = 'A' THEN 'Shipped'
         WHEN l_returnflag = 'N' THEN 'Processing' ELSE 'Cancelled' END"""
    return f"""
SELECT *, CASE WHEN order_status = 'Delivered' THEN GREATEST(order_date + 1, expected_delivery + delay)
               WHEN order_status IN ('Returned', 'Cancelled')
               THEN order_date + CAST(1 + l_orderkey % 4 AS INTEGER) END AS delivery_date,
  COALESCE(order_status = 'Delivered' AND delay <= 0, FALSE) AS is_on_time,
  CAST(CASE WHEN order_status = 'Cancelled' THEN 0 ELSE (85 + l_orderkey % 16) / 100.0 END AS DECIMAL(5,4)) AS fill_rate
FROM (
SELECT *, order_date + lead AS expected_delivery FROM (
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag, l_linestatus, l_shipdate,
  l_orderkey || '-' || l_linenumber AS order_id, l_partkey AS product_id, s_nationkey AS warehouse_id,
  l_suppkey AS supplier_id, r_name AS customer_region, r_regionkey AS region_key,
  CAST(l_quantity AS INTEGER) AS quantity, CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
  CAST(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(12,2)) AS DECIMAL(14,2)) AS total_amount,
  CAST(o_orderdate AS DATE) AS order_date, CAST(1 + (l_partkey + l_suppkey) % 13 AS INTEGER) AS lead,
  {status} AS order_status,
  CASE WHEN (l_orderkey * 7 + l_linenumber * 3 + l_partkey) % 100 < 55 + l_suppkey % 50 THEN -1
       ELSE CAST(1 + l_orderkey % 7 AS INTEGER) END AS delay
FROM {source} LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey))"""


CTES["t_orders"] = _orders("t_line")
CTES["t_dirty_lines"] = _orders("lineitem")


def _logistics(source: str) -> str:
    return f"""
SELECT order_id AS shipment_id, order_id, 'Carrier ' || ((l_orderkey + l_linenumber) % 8) AS carrier,
  warehouse_id || ' -> ' || customer_region AS route, warehouse_id AS origin_warehouse,
  customer_region AS destination_region,
  CAST(5 + ((l_partkey * 13 + l_orderkey * 7) % 14500) / 100.0 AS DECIMAL(12,2)) AS shipping_cost,
  CAST(50 + (warehouse_id * 97 + region_key * 331) % 2950 AS DECIMAL(10,2)) AS distance_km,
  order_date + l_linenumber % 2 AS ship_date, expected_delivery, delivery_date AS actual_delivery,
  CASE WHEN order_status <> 'Delivered' THEN 'In Transit' WHEN delay > 0 THEN 'Delayed' ELSE 'Delivered' END AS delivery_status,
  CASE WHEN order_status = 'Delivered' THEN GREATEST(delay, 0) ELSE 0 END AS delay_days,
  order_status = 'Delivered' AND delay > 0 AS is_delayed
FROM {source} WHERE order_status IN ('Delivered', 'Shipped')"""


CTES["t_logistics"] = _logistics("t_orders")

CTES["t_demand"] = """
SELECT product_id, warehouse_id, order_date AS demand_date, CAST(SUM(quantity) AS INTEGER) AS demand_quantity,
  CAST(SUM(total_amount) AS DECIMAL(14,2)) AS revenue, ANY_VALUE(region) AS region
FROM t_orders LEFT JOIN t_warehouses USING (warehouse_id)
WHERE order_status = 'Delivered' GROUP BY ALL"""
CTES["t_demand"] = CTES["t_demand"].replace("GROUP BY ALL", "GROUP BY product_id, warehouse_id, order_date")

STOCK_FORMULAS = """
  CAST(CASE p % 7 WHEN 0 THEN (p * 17 + w * 31) % 12 WHEN 1 THEN (p * 17 + w * 31) % 80
       ELSE (p * 17 + w * 31) % 300 - 6 END AS INTEGER) AS current_stock,
  CAST(CASE p % 7 WHEN 0 THEN 2 WHEN 1 THEN 10 ELSE 20 + p_size END AS INTEGER) AS reorder_point,
  CAST(CASE p % 7 WHEN 0 THEN 1 WHEN 1 THEN 5 ELSE (p * 3 + w) % 100 END AS INTEGER) AS safety_stock,
  CAST(CASE p % 7 WHEN 0 THEN 40 WHEN 1 THEN 60 ELSE 200 END AS INTEGER) AS max_stock"""

CTES["t_stock"] = f"""
SELECT p AS product_id, w AS warehouse_id, {STOCK_FORMULAS}, CAST(NULL AS DATE) AS last_restocked
FROM (SELECT DISTINCT product_id AS p, warehouse_id AS w FROM t_orders) LEFT JOIN part ON p_partkey = p"""

CTES["t_annual"] = """
SELECT product_id, SUM(quantity) / 2.0 AS annual_demand FROM t_orders
WHERE order_status = 'Delivered' GROUP BY product_id"""


def inventory_from(stock: str, annual: str, products: str) -> str:
    """Derived inventory fields over a stock relation with non-negative counts."""
    return f"""
SELECT product_id, warehouse_id, current_stock, reorder_point, safety_stock, max_stock, last_restocked,
  inventory_value, days_of_inventory, inventory_turnover, {STATUS_RULES} AS stock_status FROM (
SELECT *, CAST(CASE WHEN inventory_turnover > 0
    THEN {even('365.0 / CAST(inventory_turnover AS DOUBLE)', 2)} ELSE 999 END AS DECIMAL(10,2)) AS days_of_inventory FROM (
SELECT s.*, CAST(unit_cost * current_stock AS DECIMAL(14,2)) AS inventory_value,
  CAST({even('COALESCE(CAST(annual_demand AS DOUBLE), 0) / CASE WHEN mean_stock = 0 THEN 1 ELSE mean_stock END', 4)}
    AS DECIMAL(10,4)) AS inventory_turnover
FROM {stock} s LEFT JOIN {products} p USING (product_id) LEFT JOIN {annual} a USING (product_id)
  LEFT JOIN (SELECT product_id, CAST(SUM(current_stock) AS DOUBLE) / COUNT(*) AS mean_stock
             FROM {stock} GROUP BY product_id) m USING (product_id)))"""


CTES["t_stock_clean"] = """
SELECT * REPLACE (GREATEST(current_stock, 0) AS current_stock, GREATEST(reorder_point, 0) AS reorder_point,
                  GREATEST(safety_stock, 0) AS safety_stock) FROM t_stock"""
CTES["t_inventory"] = inventory_from("t_stock_clean", "t_annual", "t_products")

CTES["t_health"] = f"""
SELECT i.product_id, product_name, category, i.warehouse_id, warehouse_name, region, current_stock,
  reorder_point, safety_stock, inventory_turnover, days_of_inventory, stock_status, inventory_value,
  {STATUS_RULES} AS health_status
FROM t_inventory i JOIN t_products p ON p.product_id = i.product_id
  JOIN t_warehouses w ON w.warehouse_id = i.warehouse_id"""

_NAME = re.compile(r"\bt_[a-z_]+\b")


def with_tables(body: str) -> str:
    """Prefix ``body`` with the table expressions it mentions, dependencies first."""
    order: list[str] = []

    def visit(text: str, above: tuple[str, ...]) -> None:
        for name in _NAME.findall(text):
            if name in CTES and name not in order and name not in above:
                visit(CTES[name], (*above, name))
                order.append(name)

    visit(body, ())
    if not order:
        return body
    head = ",\n".join(f"{name} AS ({CTES[name]})" for name in order)
    return f"WITH {head}\n{body}"


def unfolded(parts: list[tuple[str, str, str]]) -> str:
    """(part, key, name, value) of every value of the parts, each given as name, key expression and SELECT."""
    each = "COLUMNS('(.*)')"
    text = f"""CASE WHEN typeof({each}) = 'DOUBLE' OR typeof({each}) LIKE 'DECIMAL%' THEN CAST(TRY_CAST({each} AS DECIMAL(30,6)) AS VARCHAR)
      ELSE CAST({each} AS VARCHAR) END AS '\\1'"""
    return "\nUNION ALL\n".join(
        f"""SELECT '{part}' AS part, unfold_key AS key, name, value FROM (SELECT {key} AS unfold_key, {text} FROM ({body}))
        UNPIVOT INCLUDE NULLS (value FOR name IN (COLUMNS(* EXCLUDE (unfold_key))))""" for part, key, body in parts
    )
