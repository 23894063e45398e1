"""Cleaning, derivation and data-quality statements on the uncleaned feeds."""

from __future__ import annotations

from oracle.base import CTES, STOCK_FORMULAS, _logistics, big, dbl, inventory_from, with_tables

ORDERS = (
    "order_id product_id warehouse_id supplier_id customer_region quantity unit_price total_amount order_date "
    "expected_delivery delivery_date order_status is_on_time fill_rate"
).split()
LOGISTICS = (
    "shipment_id order_id carrier route origin_warehouse destination_region shipping_cost distance_km ship_date "
    "expected_delivery actual_delivery delivery_status delay_days is_delayed"
).split()
DEMAND = "product_id warehouse_id demand_date demand_quantity revenue region".split()
PRODUCTS = "product_id product_name category subcategory unit_cost selling_price weight_kg is_active".split()
WAREHOUSES = "warehouse_id warehouse_name location region capacity_units current_utilization".split()
SUPPLIERS = "supplier_id supplier_name lead_time_days reliability_score defect_rate".split()
PAIRS = "product_id supplier_id unit_cost is_primary".split()
STOCK = "product_id warehouse_id current_stock reorder_point safety_stock max_stock last_restocked".split()

GAP = "(l_linenumber = 5 AND l_returnflag = 'R')"


def cols(names):
    return ", ".join(names)


def first_row(source: str, names: list[str], keys: list[str]) -> str:
    rest = ", ".join(f"{c} NULLS FIRST" for c in names if c not in keys)
    return (
        f"SELECT {cols(names)} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {cols(keys)} ORDER BY {rest}) AS rn "
        f"FROM {source}) WHERE rn = 1"
    )


CTES["t_raw_orders"] = f"""
SELECT * REPLACE (
  CASE WHEN {GAP} THEN NULL ELSE CAST(l_quantity - 3 AS INTEGER) END AS quantity,
  CASE WHEN l_linenumber = 6 THEN order_date - 2 ELSE expected_delivery END AS expected_delivery,
  CAST(l_shipdate AS DATE) AS delivery_date,
  CASE WHEN order_status = 'Delivered' THEN is_on_time END AS is_on_time,
  CAST(CASE WHEN l_linenumber <> 7 THEN (85 + l_orderkey % 16) / 90.0 END AS DECIMAL(5,4)) AS fill_rate)
FROM t_dirty_lines"""
CTES["t_dirty_ship"] = _logistics("t_dirty_lines").replace(
    "SELECT order_id AS shipment_id", "SELECT l_linenumber AS line, order_id AS shipment_id"
)
CTES["t_raw_logistics"] = """
SELECT * REPLACE (
  CASE WHEN line = 3 AND delay_days = 1 THEN NULL ELSE carrier END AS carrier,
  CAST(shipping_cost - 40 AS DECIMAL(12,2)) AS shipping_cost,
  CASE WHEN line < 6 THEN is_delayed END AS is_delayed,
  CASE WHEN line <> 7 THEN delay_days - 1 END AS delay_days)
FROM t_dirty_ship"""
CTES["t_raw_demand"] = f"""
SELECT product_id, warehouse_id, order_date AS demand_date,
  CASE WHEN {GAP} THEN NULL ELSE CAST(l_quantity - 3 AS INTEGER) END AS demand_quantity,
  total_amount AS revenue, customer_region AS region FROM t_dirty_lines"""
CTES["t_raw_products"] = """
SELECT l_partkey AS product_id, CASE WHEN l_quantity < 50 THEN p_name END AS product_name, p_type AS category,
  p_brand AS subcategory,
  CAST(ROUND(CAST(p_retailprice AS DECIMAL(12,2)) * (l_linenumber - 2) * 0.25, 2) AS DECIMAL(12,2)) AS unit_cost,
  CAST(p_retailprice AS DECIMAL(12,2)) AS selling_price, CAST(p_size AS DECIMAL(8,3)) AS weight_kg,
  CASE WHEN l_returnflag <> 'N' THEN l_linestatus = 'F' END AS is_active
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey"""
CTES["t_raw_warehouses"] = """
SELECT n_nationkey AS warehouse_id, n_name AS warehouse_name, CASE WHEN n_nationkey % 9 <> 0 THEN n_name END AS location,
  CAST(n_regionkey AS VARCHAR) AS region, (n_nationkey % 5 - 1) * 1000 + l_linenumber AS capacity_units,
  CAST((n_nationkey % 30 - 3) / 20.0 AS DECIMAL(5,2)) AS current_utilization
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = s_nationkey"""
CTES["t_raw_suppliers"] = """
SELECT l_suppkey AS supplier_id, CASE WHEN l_suppkey % 11 <> 0 THEN s_name END AS supplier_name,
  CAST(l_suppkey % 7 - 4 + l_linenumber AS INTEGER) AS lead_time_days,
  CAST(l_suppkey % 30 * 5 - 10 AS DECIMAL(5,2)) AS reliability_score,
  CAST(CASE WHEN l_suppkey % 6 <> 0 THEN (l_suppkey % 50) / 40.0 - 0.1 END AS DECIMAL(5,4)) AS defect_rate
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey"""
CTES["t_raw_pairs"] = """
SELECT l_partkey AS product_id, l_suppkey AS supplier_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_cost,
  l_linenumber = 1 AS is_primary FROM lineitem"""
CTES["t_raw_stock"] = f"""
SELECT p AS product_id, CASE WHEN l_suppkey % 23 <> 0 THEN w END AS warehouse_id,
  current_stock - l_linenumber AS current_stock, CASE WHEN p % 10 <> 0 THEN reorder_point END AS reorder_point,
  CASE WHEN p % 4 <> 0 THEN safety_stock - 3 END AS safety_stock, max_stock, CAST(NULL AS DATE) AS last_restocked
FROM (SELECT *, {STOCK_FORMULAS} FROM
  (SELECT l_partkey AS p, s_nationkey AS w, l_suppkey, l_linenumber FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey)
  LEFT JOIN part ON p_partkey = p)"""

CTES["t_one_product"] = first_row("t_raw_products", PRODUCTS, ["product_id"])
CTES["t_ok_products"] = """
SELECT product_id, product_name, category, subcategory, GREATEST(unit_cost, 0) AS unit_cost,
  GREATEST(selling_price, unit_cost, 0) AS selling_price, weight_kg, COALESCE(is_active, TRUE) AS is_active
FROM t_one_product WHERE product_name IS NOT NULL AND category IS NOT NULL AND unit_cost IS NOT NULL
  AND selling_price IS NOT NULL"""
CTES["t_one_warehouse"] = first_row("t_raw_warehouses", WAREHOUSES, ["warehouse_id"])
CTES["t_ok_warehouses"] = """
SELECT * REPLACE (CASE WHEN capacity_units < 1 THEN 1 ELSE capacity_units END AS capacity_units,
  CASE WHEN current_utilization < 0 THEN 0 WHEN current_utilization > 1 THEN 1 ELSE current_utilization END AS current_utilization)
FROM t_one_warehouse WHERE location IS NOT NULL AND capacity_units IS NOT NULL"""
CTES["t_one_supplier"] = first_row("t_raw_suppliers", SUPPLIERS, ["supplier_id"])
CTES["t_ok_suppliers"] = """
SELECT * REPLACE (CASE WHEN lead_time_days < 0 THEN 0 ELSE lead_time_days END AS lead_time_days,
  CASE WHEN reliability_score < 0 THEN 0 WHEN reliability_score > 100 THEN 100 ELSE reliability_score END AS reliability_score,
  CASE WHEN defect_rate IS NULL OR defect_rate < 0 THEN 0 WHEN defect_rate > 1 THEN 1 ELSE defect_rate END AS defect_rate)
FROM t_one_supplier WHERE supplier_name IS NOT NULL AND lead_time_days IS NOT NULL"""
CTES["t_ok_pairs"] = first_row("t_raw_pairs", PAIRS, ["product_id", "supplier_id"])
CTES["t_one_stock"] = first_row("t_raw_stock", STOCK, ["product_id", "warehouse_id"])
CTES["t_ok_stock"] = """
SELECT * REPLACE (GREATEST(COALESCE(current_stock, 0), 0) AS current_stock, GREATEST(COALESCE(reorder_point, 0), 0) AS reorder_point,
  GREATEST(COALESCE(safety_stock, 0), 0) AS safety_stock)
FROM t_one_stock WHERE product_id IS NOT NULL AND warehouse_id IS NOT NULL"""
CTES["t_one_order"] = first_row("t_raw_orders", ORDERS, ["order_id"])
CTES["t_ok_orders"] = """
SELECT * REPLACE (GREATEST(quantity, 1) AS quantity, LEAST(COALESCE(fill_rate, 1), 1) AS fill_rate,
  CASE WHEN delivery_date < order_date THEN order_date ELSE delivery_date END AS delivery_date,
  CASE WHEN expected_delivery < order_date THEN order_date + 3 ELSE expected_delivery END AS expected_delivery,
  COALESCE(is_on_time, FALSE) AS is_on_time)
FROM t_one_order WHERE quantity IS NOT NULL AND order_date IS NOT NULL AND product_id IS NOT NULL"""
CTES["t_one_ship"] = first_row("t_raw_logistics", LOGISTICS, ["shipment_id"])
CTES["t_ok_logistics"] = """
SELECT * REPLACE (CASE WHEN shipping_cost < 0 THEN 0 ELSE shipping_cost END AS shipping_cost,
  GREATEST(COALESCE(delay_days, 0), 0) AS delay_days,
  COALESCE(is_delayed, GREATEST(COALESCE(delay_days, 0), 0) > 0) AS is_delayed)
FROM t_one_ship WHERE carrier IS NOT NULL AND route IS NOT NULL AND shipping_cost IS NOT NULL"""
CTES["t_one_demand"] = first_row("t_raw_demand", DEMAND, ["product_id", "warehouse_id", "demand_date"])
CTES["t_ok_demand"] = """
SELECT * REPLACE (GREATEST(demand_quantity, 0) AS demand_quantity) FROM t_one_demand
WHERE demand_quantity IS NOT NULL AND demand_date IS NOT NULL"""
CTES["t_ok_annual"] = """
SELECT product_id, SUM(quantity) / 2.0 AS annual_demand FROM t_ok_orders WHERE order_status = 'Delivered' GROUP BY product_id"""
CTES["t_ok_inventory"] = inventory_from("t_ok_stock", "t_ok_annual", "t_ok_products")

P_OUT = "unit_cost selling_price weight_kg".split()
O_OUT = "unit_price total_amount fill_rate".split()
L_OUT = "shipping_cost distance_km".split()


def plain(source: str, names: list[str], decimals: list[str]) -> str:
    return f"SELECT {', '.join(f'{dbl(c)} AS {c}' if c in decimals else c for c in names)} FROM {source}"


TABLES = "products warehouses suppliers product_suppliers inventory orders logistics demand_history".split()
RAW = {
    "products": "t_raw_products", "warehouses": "t_raw_warehouses", "suppliers": "t_raw_suppliers",
    "product_suppliers": "t_raw_pairs", "inventory": "t_raw_stock", "orders": "t_raw_orders",
    "logistics": "t_raw_logistics", "demand_history": "t_raw_demand",
}
CLEAN = {
    "products": "t_ok_products", "warehouses": "t_ok_warehouses", "suppliers": "t_ok_suppliers",
    "product_suppliers": "t_ok_pairs", "inventory": "t_ok_inventory", "orders": "t_ok_orders",
    "logistics": "t_ok_logistics", "demand_history": "t_ok_demand",
}
KEYS = {
    "products": ["product_id"], "warehouses": ["warehouse_id"], "suppliers": ["supplier_id"],
    "product_suppliers": ["product_id", "supplier_id"], "inventory": ["product_id", "warehouse_id"],
    "orders": ["order_id"], "logistics": ["shipment_id"],
    "demand_history": ["product_id", "warehouse_id", "demand_date"],
}
NOT_NULL = {
    "products": "product_id product_name category unit_cost selling_price".split(),
    "warehouses": "warehouse_id warehouse_name location region capacity_units".split(),
    "product_suppliers": "product_id supplier_id".split(),
    "suppliers": "supplier_id supplier_name lead_time_days".split(),
    "inventory": "product_id warehouse_id current_stock reorder_point safety_stock".split(),
    "orders": "order_id product_id quantity order_date order_status".split(),
    "logistics": "shipment_id carrier route shipping_cost delivery_status".split(),
    "demand_history": "product_id demand_date demand_quantity".split(),
}
FAILS = [
    ("products", "unit_cost_not_negative", "unit_cost < 0"),
    ("products", "selling_price_not_negative", "selling_price < 0"),
    ("warehouses", "capacity_positive", "capacity_units <= 0"),
    ("suppliers", "lead_time_not_negative", "lead_time_days < 0"),
    ("suppliers", "reliability_0_to_100", "reliability_score NOT BETWEEN 0 AND 100"),
    ("orders", "quantity_positive", "quantity <= 0"),
    ("logistics", "shipping_cost_not_negative", "shipping_cost < 0"),
    ("demand_history", "demand_not_negative", "demand_quantity < 0"),
]
LINKS = [
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
]


OUT = {
    "kpi_inventory": "t_kpi_inventory", "kpi_supplier": "t_kpi_supplier", "kpi_logistics": "t_kpi_logistics", "kpi_service": "t_kpi_service",
    "kpi_executive": "t_kpi_executive", "forecasts": "t_forecasts", "inventory_recommendations": "t_queue", "business_insights": "t_insights",
    "inventory_alerts": "t_alerts", "supplier_scorecards": "t_cards",
}
OUT_REQUIRED = {
    **{t: ["calculation_date"] for t in OUT if t.startswith("kpi_")}, "kpi_supplier": ["calculation_date", "supplier_id"],
    "forecasts": "forecast_date horizon_months model_name predicted_demand".split(),
    "inventory_recommendations": "product_id warehouse_id recommendation_date".split(),
    "business_insights": "insight_date category title description recommendation".split(),
    "inventory_alerts": "alert_date product_id warehouse_id alert_type".split(), "supplier_scorecards": ["scorecard_date", "supplier_id"],
}
OUT_LINKS = [
    (t, f"{p}_id", f"{p}s") for t, parents in (
        ("kpi_inventory", ("warehouse", "product")), ("kpi_supplier", ("supplier",)), ("kpi_service", ("warehouse",)),
        ("forecasts", ("product", "warehouse")), ("inventory_recommendations", ("product", "warehouse")),
        ("inventory_alerts", ("product", "warehouse")), ("supplier_scorecards", ("supplier",)),
    ) for p in parents
]


def union(parts):
    return "\nUNION ALL\n".join(parts)


# The CSV files: malformed lines are set aside, and keys are text, which orders repeated rows in another way.
BROKEN = {
    "products": "product_id % 97 = 0", "warehouses": "capacity_units % 1000 = 7 AND warehouse_id % 4 = 1",
    "suppliers": "supplier_id % 89 = 0", "product_suppliers": "product_id % 83 = 0", "inventory": "product_id % 101 = 0",
    "orders": "product_id % 103 = 0", "logistics": "delay_days = 3", "demand_history": "product_id % 79 = 0",
}
ONE = {
    "products": ("t_one_product", PRODUCTS), "warehouses": ("t_one_warehouse", WAREHOUSES), "suppliers": ("t_one_supplier", SUPPLIERS),
    "product_suppliers": ("t_ok_pairs", PAIRS), "inventory": ("t_one_stock", STOCK), "orders": ("t_one_order", ORDERS),
    "logistics": ("t_one_ship", LOGISTICS), "demand_history": ("t_one_demand", DEMAND),
}
TEXT_KEYS = "product_id warehouse_id supplier_id origin_warehouse".split()
CSV_CLEAN = {}
for t, (one, names) in ONE.items():
    text = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in TEXT_KEYS if c in names)
    replaced = f"* REPLACE ({text})" if text else "*"
    CTES[f"t_csv_{t}"] = f"SELECT {replaced} FROM {RAW[t]} WHERE NOT COALESCE({BROKEN[t]}, FALSE)"
    CTES[f"t_csv_one_{t}"] = first_row(f"t_csv_{t}", names, KEYS[t])
    CSV_CLEAN[t] = f"t_csv_one_{t}"
    if one != "t_ok_pairs":
        ok = "t_ok_stock" if t == "inventory" else CLEAN[t]
        CTES[f"t_csv_ok_{t}"] = CTES[ok].replace(one, f"t_csv_one_{t}")
        CSV_CLEAN[t] = f"t_csv_ok_{t}"
CTES["t_csv_totals"] = "SELECT " + ", ".join(
    "(" + " + ".join(f"(SELECT COUNT(*) FROM {source(t)})" for t in TABLES) + f") AS {name}"
    for name, source in (
        ("accepted", lambda t: f"t_csv_{t}"), ("rejected", lambda t: f"{RAW[t]} WHERE {BROKEN[t]}"), ("loaded", lambda t: CSV_CLEAN[t]),
    )
)

LEAD = """SELECT o.*, lead_time_days AS contracted_lead_time, delivery_date - order_date AS actual_lead_time,
  delivery_date - order_date - lead_time_days AS lead_time_variance"""
LEAD_NAMES = [*ORDERS, "contracted_lead_time", "actual_lead_time", "lead_time_variance"]

BODIES = {
    "etl_dedupe": "SELECT * FROM t_line",
    "etl_require": plain("(SELECT * FROM t_raw_orders WHERE quantity IS NOT NULL AND fill_rate IS NOT NULL)", ORDERS, O_OUT),
    "etl_clip": f"""SELECT order_id, CASE WHEN quantity < 1 THEN 1 ELSE quantity END AS quantity,
        {dbl('CASE WHEN fill_rate > 1 THEN 1 ELSE fill_rate END')} AS fill_rate FROM t_raw_orders""",
    "etl_clip_column": f"""SELECT product_id, {dbl('unit_cost')} AS unit_cost,
        {dbl('CASE WHEN selling_price < unit_cost THEN unit_cost ELSE selling_price END')} AS selling_price FROM t_raw_products""",
    "etl_fill": f"""SELECT shipment_id, COALESCE(delay_days, 0) AS delay_days,
        COALESCE(is_delayed, COALESCE(delay_days, 0) > 0) AS is_delayed FROM t_raw_logistics""",
    "etl_date_repair": """SELECT order_id, order_date,
        CASE WHEN delivery_date < order_date THEN order_date ELSE delivery_date END AS delivery_date,
        CASE WHEN expected_delivery < order_date THEN order_date + 3 ELSE expected_delivery END AS expected_delivery
        FROM t_raw_orders""",
    "etl_drop_stats": union(
        f"""SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {RAW[t]}) AS rows_before,
        (SELECT COUNT(*) FROM {CLEAN[t]}) AS rows_after,
        (SELECT COUNT(*) FROM {RAW[t]}) - (SELECT COUNT(*) FROM {CLEAN[t]}) AS rows_dropped"""
        for t in ("products", "inventory", "orders")
    ),
    "etl_key_lookup": f"""SELECT s.product_id, s.warehouse_id, s.current_stock, {dbl('unit_cost')} AS unit_cost
        FROM t_raw_stock s LEFT JOIN t_ok_products USING (product_id)""",
    "etl_products": plain("t_ok_products", PRODUCTS, P_OUT),
    "etl_warehouses": plain("t_ok_warehouses", WAREHOUSES, ["current_utilization"]),
    "etl_suppliers": plain("t_ok_suppliers", SUPPLIERS, ["reliability_score", "defect_rate"]),
    "etl_product_suppliers": plain("t_ok_pairs", PAIRS, ["unit_cost"]),
    "etl_inventory": f"""SELECT {cols('s.' + c for c in STOCK)}, {dbl('CAST(unit_cost * current_stock AS DECIMAL(14,2))')} AS inventory_value
        FROM t_ok_stock s LEFT JOIN t_ok_products p USING (product_id)""",
    "etl_orders": plain("t_ok_orders", ORDERS, O_OUT),
    "etl_order_lead_times": plain(
        f"({LEAD} FROM t_ok_orders o LEFT JOIN t_ok_suppliers USING (supplier_id))", LEAD_NAMES, O_OUT
    ),
    "etl_logistics": plain("t_ok_logistics", LOGISTICS, L_OUT),
    "etl_demand_history": plain("t_ok_demand", DEMAND, ["revenue"]),
    "etl_demand_rollup": plain("t_demand", DEMAND, ["revenue"]),
    "etl_annual_demand": f"SELECT product_id, {dbl('annual_demand')} AS annual_demand FROM t_annual",
    "etl_inventory_turnover": f"SELECT product_id, warehouse_id, current_stock, {dbl('inventory_turnover')} AS inventory_turnover FROM t_inventory",
    "etl_days_of_inventory": f"""SELECT product_id, warehouse_id, {dbl('inventory_turnover')} AS inventory_turnover,
        {dbl('days_of_inventory')} AS days_of_inventory FROM t_inventory""",
    "etl_stock_status": "SELECT product_id, warehouse_id, current_stock, reorder_point, safety_stock, max_stock, stock_status FROM t_inventory",
    "etl_transform": plain(
        "t_ok_inventory",
        [*STOCK, "inventory_value", "days_of_inventory", "inventory_turnover", "stock_status"],
        ["inventory_value", "days_of_inventory", "inventory_turnover"],
    ),
    "etl_run": union(f"SELECT '{t}' AS table_name, COUNT(*) AS rows_loaded FROM {CSV_CLEAN[t]}" for t in TABLES),
    "src_csv_quarantine": union(
        f"""SELECT '{t}' AS table_name, COUNT(*) FILTER (WHERE NOT COALESCE({BROKEN[t]}, FALSE)) AS accepted,
        COUNT(*) FILTER (WHERE {BROKEN[t]}) AS rejected FROM {RAW[t]}""" for t in TABLES
    ),
    "etl_resume": f"""SELECT 'supply_chain_etl' AS pipeline_name, stage, status, {big('done')} AS records_processed,
        {big('lost')} AS records_failed, error_message FROM (
          SELECT 'extract' AS stage, 'success' AS status, accepted AS done, rejected AS lost, CAST(NULL AS VARCHAR) AS error_message
            FROM t_csv_totals
          UNION ALL SELECT 'transform', 'failed', 0, 0, 'ConnectionError: the connection was lost'
          UNION ALL SELECT 'transform', 'success', loaded, accepted - loaded, NULL FROM t_csv_totals
          UNION ALL SELECT 'load', 'success', loaded, 0, NULL FROM t_csv_totals)""",
    "dq_unique": union(
        f"""SELECT '{t}' AS table_name, '{', '.join(KEYS[t])}' AS key_columns, COUNT(*) AS duplicated_keys,
        {big('COALESCE(SUM(n - 1), 0)')} AS surplus_rows
        FROM (SELECT COUNT(*) AS n FROM {RAW[t]} GROUP BY {cols(KEYS[t])}) WHERE n > 1""" for t in TABLES
    ),
    "dq_not_null": union(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_rows FROM {RAW[t]}"
        for t in NOT_NULL for c in NOT_NULL[t]
    ),
    "dq_check": union(
        f"SELECT '{t}' AS table_name, '{n}' AS check_name, COUNT(*) FILTER (WHERE {p}) AS failed_rows FROM {RAW[t]}"
        for t, n, p in FAILS
    ),
    "dq_foreign_key": union(
        f"""SELECT '{c}' AS child_table, '{k}' AS child_column, '{p}' AS parent_table, COUNT(*) AS orphan_rows
        FROM {RAW[c]} AS ch WHERE ch.{k} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {CLEAN[p]} pa WHERE pa.{pk} = ch.{k})"""
        for c, k, p, pk in LINKS
    ),
    "dq_outputs": union([
        *(f"SELECT '{t}' AS table_name, 'not_null' AS check_name, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS failed_rows FROM {OUT[t]}"
          for t in OUT for c in OUT_REQUIRED[t]),
        "SELECT 'kpi_executive', 'unique', 'calculation_date', COUNT(*) - COUNT(DISTINCT calculation_date) FROM t_kpi_executive",
        *(f"""SELECT '{t}', 'reference', '{c}', COUNT(*) FROM {OUT[t]} ch WHERE ch.{c} IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM t_{p} pa WHERE CAST(pa.{c} AS VARCHAR) = CAST(ch.{c} AS VARCHAR))""" for t, c, p in OUT_LINKS),
    ]),
    "dq_order_dates": union([
        "SELECT 'delivery_before_order' AS check_name, COUNT(*) AS failed_rows FROM t_raw_orders WHERE delivery_date < order_date",
        "SELECT 'negative_reorder_point', COUNT(*) FROM t_raw_stock WHERE reorder_point < 0",
        "SELECT 'negative_safety_stock', COUNT(*) FROM t_raw_stock WHERE safety_stock < 0",
    ]),
}

CSV_ORDER = ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" if c in ("product_id", "warehouse_id", "supplier_id") else f"{dbl(c)} AS {c}" if c in O_OUT else c
    for c in ORDERS
)
DEMAND_DAY = f"SELECT product_id, demand_date, {big('SUM(demand_quantity)')} AS demand FROM t_demand GROUP BY product_id, demand_date"
BODIES |= {
    "src_csv": f"SELECT {CSV_ORDER} FROM t_raw_orders",
    "src_sql": f"""SELECT customer_region, COUNT(*) AS order_count, {dbl('SUM(total_amount)')} AS revenue FROM t_orders
        WHERE order_status = 'Delivered' AND quantity >= 10 GROUP BY customer_region""",
    "sink_csv": union(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {CLEAN[t]}" for t in TABLES),
    "sink_append": union(["SELECT supplier_id, supplier_name, lead_time_days FROM t_suppliers"] * 2),
    "sink_full_reload": "SELECT order_id, order_status, quantity FROM t_orders WHERE order_status = 'Delivered'",
    "sink_project_schema": f"SELECT {CSV_ORDER} FROM t_orders",
    "sink_snapshot_replace": "SELECT * REPLACE (DATE '2001-08-01' AS calculation_date) FROM t_kpi_service",
    "sink_range_replace": f"""SELECT product_id, demand_date, CASE WHEN demand_date >= DATE '2000-01-01' THEN demand * 2 ELSE demand END AS demand
        FROM ({DEMAND_DAY})""",
    "sink_metrics_json": "SELECT *, TRUE AS is_best FROM t_scores",
    "sink_audit": union(
        f"""SELECT 'supply_chain_etl' AS pipeline_name, 'extract_{t}' AS stage, COUNT(*) AS records_processed, 0::BIGINT AS records_failed,
        'success' AS status, 1.5::DOUBLE AS duration_seconds FROM {RAW[t]}""" for t in TABLES
    ),
}


def statements() -> dict[str, str]:
    """Built late: some bodies use table expressions of the other modules."""
    return {name: with_tables(body) for name, body in BODIES.items()}
