"""KPIs and the inventory, supplier and logistics analyses."""

from __future__ import annotations

from oracle.base import CTES, big, dbl, even, fmt, mean, mean_if, share, up, with_tables, unfolded
from oracle.numbered import DAYS, HEALTH_OUT

DAY = "(SELECT CAST(MAX(o_orderdate) AS DATE) FROM orders)"

CTES["t_kpi_inventory"] = f"""
SELECT {DAY} AS calculation_date, warehouse_id, CAST(NULL AS VARCHAR) AS product_id, inventory_turnover, days_sales_inventory,
  total_inventory_value * 0.25::DOUBLE / 365 AS carrying_cost, 1 - stock_out_rate AS inventory_accuracy, stock_out_rate,
  COALESCE(f, (SELECT {mean('fill_rate')} FROM t_orders WHERE order_status = 'Delivered'), 0) AS fill_rate, total_inventory_value
FROM (SELECT warehouse_id, {mean('inventory_turnover')} AS inventory_turnover, {mean('days_of_inventory')} AS days_sales_inventory,
  {share('current_stock <= 0')} AS stock_out_rate, {dbl('SUM(inventory_value)')} AS total_inventory_value
  FROM t_inventory JOIN t_products USING (product_id) GROUP BY warehouse_id)
LEFT JOIN (SELECT warehouse_id, {mean('fill_rate')} AS f FROM t_orders WHERE order_status = 'Delivered' GROUP BY warehouse_id)
  USING (warehouse_id)"""

CTES["t_kpi_supplier"] = f"""
SELECT *, RANK() OVER (ORDER BY on_time_delivery_pct DESC) AS supplier_rank FROM (
SELECT {DAY} AS calculation_date, supplier_id, {dbl('reliability_score')} AS reliability_score,
  COALESCE({even(f"CASE WHEN COUNT(order_id) > 0 THEN {mean('CAST(is_on_time AS INTEGER)')} * 100 ELSE {dbl('reliability_score')} END", 2)}, 0) AS on_time_delivery_pct,
  COALESCE({even(f"COALESCE({mean(DAYS)}, lead_time_days)", 2)}, 0) AS avg_lead_time, {dbl('defect_rate')} AS defect_rate,
  COUNT(order_id) AS total_orders, COALESCE({dbl('SUM(total_amount)')}, 0) AS total_spend
FROM t_suppliers LEFT JOIN t_orders USING (supplier_id)
GROUP BY supplier_id, t_suppliers.reliability_score, t_suppliers.defect_rate, lead_time_days)"""

CTES["t_kpi_logistics"] = f"""
SELECT {DAY} AS calculation_date, carrier, route, COALESCE({even(mean('(actual_delivery - ship_date)'), 2)}, 0) AS avg_delivery_time,
  {dbl('SUM(shipping_cost)')} AS transportation_cost, {mean('CAST(is_delayed AS INTEGER)')} AS delayed_shipment_rate,
  COUNT(*) AS total_shipments, {even(f"(1 - {mean('CAST(is_delayed AS INTEGER)')}) * 100", 2)} AS on_time_pct
FROM t_logistics WHERE carrier IS NOT NULL AND route IS NOT NULL GROUP BY carrier, route"""

CTES["t_kpi_service"] = f"""
SELECT {DAY} AS calculation_date, *, GREATEST(0, 100 - stock_out_frequency * 100 - (1 - fill_rate) * 50) AS customer_satisfaction FROM (
SELECT o.warehouse_id, {mean('fill_rate')} AS fill_rate, 1 - {share("order_status = 'Returned'")} AS order_accuracy,
  {share('current_stock <= 0')} AS stock_out_frequency,
  COALESCE({even(mean_if(DAYS, "order_status = 'Delivered'"), 2)}, 0) AS avg_order_cycle_time
FROM t_orders o LEFT JOIN t_inventory i ON i.product_id = o.product_id AND i.warehouse_id = o.warehouse_id
WHERE o.warehouse_id IS NOT NULL GROUP BY o.warehouse_id)"""

CTES["t_kpi_executive"] = f"""
SELECT {DAY} AS calculation_date, (SELECT COUNT(*) FROM t_products WHERE is_active) AS total_products,
  (SELECT {dbl('SUM(inventory_value)')} FROM t_inventory) AS total_inventory_value,
  (SELECT {share('current_stock <= 0')} FROM t_inventory) AS stock_out_rate,
  {mean_if('fill_rate', "order_status = 'Delivered'")} AS fill_rate, 0.85::DOUBLE AS forecast_accuracy,
  (SELECT {mean('CAST(on_time_delivery_pct AS DECIMAL(5,2))')} FROM t_kpi_supplier) AS avg_supplier_reliability,
  COUNT(*) AS total_orders, {dbl("SUM(total_amount) FILTER (WHERE order_status = 'Delivered')")} AS revenue
FROM t_orders"""

GRADE = """CASE WHEN on_time_pct >= 95 THEN 'A+' WHEN on_time_pct >= 90 THEN 'A' WHEN on_time_pct >= 85 THEN 'B+'
  WHEN on_time_pct >= 80 THEN 'B' WHEN on_time_pct >= 70 THEN 'C' ELSE 'D' END"""
CTES["t_cards"] = f"""
SELECT {DAY} AS scorecard_date, supplier_id, reliability_score, COALESCE(avg_actual_lead_time, contracted_lead_time) AS avg_lead_time,
  {even('on_time_pct', 2)} AS on_time_pct, defect_rate, {GRADE} AS overall_grade,
  ROW_NUMBER() OVER (ORDER BY t_perf.on_time_pct DESC, supplier_id) AS rank_position FROM t_perf"""
CTES["t_cards"] = CTES["t_cards"].replace("CASE WHEN on_time_pct", "CASE WHEN t_perf.on_time_pct").replace(
    "WHEN on_time_pct >=", "WHEN t_perf.on_time_pct >="
)

PERF_OUT = f"* REPLACE ({dbl('reliability_score')} AS reliability_score, {dbl('defect_rate')} AS defect_rate)"
LOW = "health_status IN ('Stock Out', 'Reorder Required', 'Low Stock')"
URGENCY = """CASE health_status WHEN 'Stock Out' THEN 1 WHEN 'Reorder Required' THEN 2 ELSE 3 END, current_stock, product_id, warehouse_id"""
SUMMARY = f"""COUNT(*) AS total_skus, COUNT(*) FILTER (WHERE health_status = 'Stock Out') AS stock_outs,
  COUNT(*) FILTER (WHERE health_status = 'Reorder Required') AS reorder_required,
  COUNT(*) FILTER (WHERE health_status IN ('Overstocked', 'Dead Inventory')) AS overstocked,
  COUNT(*) FILTER (WHERE health_status = 'Fast Moving') AS fast_moving,
  COUNT(*) FILTER (WHERE health_status = 'Healthy') AS healthy, {dbl('SUM(inventory_value)')} AS total_inventory_value"""
SUP_SUMMARY = f"""SELECT COUNT(*) AS total_suppliers, {up('AVG(on_time_pct)', 6)} AS avg_on_time_pct,
  {up('AVG(avg_actual_lead_time)', 6)} AS avg_lead_time, COUNT(*) FILTER (WHERE 100 - on_time_pct >= 15) AS high_risk_suppliers,
  (SELECT supplier_name FROM t_perf ORDER BY on_time_pct DESC, supplier_id LIMIT 1) AS top_supplier,
  (SELECT supplier_name FROM t_perf ORDER BY on_time_pct, supplier_id DESC LIMIT 1) AS worst_supplier FROM t_perf"""
CARRIERS = f"""SELECT carrier, COUNT(*) AS total_shipments, {mean('shipping_cost')} AS avg_cost, {dbl('SUM(shipping_cost)')} AS total_cost,
  {mean('delay_days')} AS avg_delay, {share('is_delayed')} * 100 AS delay_rate_pct,
  {mean('(actual_delivery - ship_date)')} AS avg_transit_days FROM t_logistics GROUP BY carrier"""
CTES["t_carriers"] = CARRIERS

LOG_REC = f"""
SELECT 'route_delay' AS type, route AS entity, carrier, {fmt('delay_rate_pct', 1)} || '% delay rate' AS metric,
  'Route ' || route || ' via ' || carrier || ' has a ' || {fmt('delay_rate_pct', 1)} || '% delay rate. Consider alternative carriers or routes.' AS recommendation,
  'high' AS priority FROM (SELECT * FROM t_routes WHERE delay_rate_pct >= 20 ORDER BY delay_rate_pct DESC, route, carrier LIMIT 5)
UNION ALL
SELECT 'cost_optimization', route, carrier, '$' || {fmt('avg_shipping_cost', 2)} || ' avg cost',
  'Route ' || route || ' has high transportation costs ($' || {fmt('avg_shipping_cost', 2)} || '/shipment). Negotiate rates or consolidate shipments.',
  'medium' FROM (SELECT * FROM t_routes ORDER BY avg_shipping_cost DESC, route, carrier LIMIT 3)
UNION ALL
SELECT 'carrier_switch', w.carrier, NULL,
  {fmt('w.delay_rate_pct', 1)} || '% delay vs ' || b.carrier || ' at ' || {fmt('b.delay_rate_pct', 1)} || '%',
  'Consider shifting volume from ' || w.carrier || ' to ' || b.carrier || ' to reduce delays by ~' || {fmt('w.delay_rate_pct - b.delay_rate_pct', 1)} || '%.',
  'high' FROM (SELECT * FROM t_carriers ORDER BY delay_rate_pct DESC, carrier DESC LIMIT 1) w,
  (SELECT * FROM t_carriers ORDER BY delay_rate_pct, carrier LIMIT 1) b WHERE w.delay_rate_pct - b.delay_rate_pct > 10"""
LATE = f"""SELECT l.* REPLACE ({dbl('shipping_cost')} AS shipping_cost, {dbl('distance_km')} AS distance_km), o.product_id, warehouse_name
  FROM t_logistics l LEFT JOIN (SELECT order_id, product_id FROM t_orders) o ON o.order_id = l.order_id
  LEFT JOIN t_warehouses w ON w.warehouse_id = l.origin_warehouse WHERE is_delayed"""
TOTALS = f"""SELECT {big('SUM(total_shipments)')} AS total_shipments, {up('SUM(total_shipping_cost)', 2)} AS total_shipping_cost,
  {up('AVG(delay_rate_pct)', 6)} AS avg_delay_rate_pct, (SELECT COUNT(*) FROM t_logistics WHERE is_delayed) AS delayed_shipments,
  COUNT(*) FILTER (WHERE delay_rate_pct >= 20) AS high_risk_routes, COUNT(DISTINCT carrier) AS carriers_used FROM t_routes"""

EXEC_VIEW = """SELECT calculation_date, total_products, total_inventory_value, stock_out_rate * 100 AS stock_out_rate_pct,
  fill_rate * 100 AS fill_rate_pct, forecast_accuracy * 100 AS forecast_accuracy_pct, avg_supplier_reliability, total_orders, revenue
  FROM t_kpi_executive"""

ALERTS = f"""SELECT {DAY} AS alert_date, product_id, warehouse_id,
  CASE health_status WHEN 'Stock Out' THEN 'STOCK_OUT' WHEN 'Reorder Required' THEN 'REORDER_REQUIRED' ELSE 'LOW_STOCK' END AS alert_type,
  current_stock, reorder_point,
  CASE health_status WHEN 'Stock Out' THEN 'Product ' || product_name || ' (' || product_id || ') is OUT OF STOCK at ' || warehouse_name || ' (' || warehouse_id || ').'
    WHEN 'Reorder Required' THEN 'Product ' || product_name || ' (' || product_id || ')' || chr(10) || 'Current Stock: ' || current_stock || chr(10) ||
      'Reorder Point: ' || reorder_point || chr(10) || 'Status: Reorder Required'
    ELSE 'Product ' || product_name || ' at ' || warehouse_name || ' has low stock (' || current_stock || ' units).' END AS message,
  CASE health_status WHEN 'Stock Out' THEN 'critical' WHEN 'Reorder Required' THEN 'high' ELSE 'medium' END AS severity
  FROM t_health WHERE {LOW}"""
CTES["t_alerts"] = ALERTS

CARD_TEXT = f"""SELECT supplier_id, 'Supplier: ' || supplier_name || chr(10) || chr(10) || 'Reliability Score: ' || CAST({dbl('c.reliability_score')} AS VARCHAR) || chr(10) ||
  'Average Lead Time: ' || {fmt('CAST(CAST(avg_lead_time AS DECIMAL(8,2)) AS DOUBLE)', 0)} || ' Days' || chr(10) ||
  'On-Time Deliveries: ' || {fmt('on_time_pct', 0)} || '%' || chr(10) ||
  'Defect Rate: ' || {fmt(f"{dbl('c.defect_rate')} * 100", 2)} || '%' || chr(10) || 'Overall Grade: ' || overall_grade || chr(10) ||
  'Rank: #' || rank_position AS scorecard FROM t_cards c JOIN t_suppliers s USING (supplier_id)"""

CTES["t_history"] = f"""
SELECT calculation_date, {dbl('SUM(inventory_value)')} AS total_inventory_value,
  CAST(SUM(CASE WHEN current_stock <= 0 THEN n ELSE 0 END) AS DOUBLE) / SUM(n) AS stock_out_rate, {dbl('SUM(f)')} / SUM(n) AS fill_rate
FROM (SELECT CAST(date_trunc('month', order_date) AS DATE) AS calculation_date, product_id, warehouse_id, COUNT(*) AS n, SUM(fill_rate) AS f
  FROM t_orders GROUP BY 1, 2, 3) LEFT JOIN t_inventory USING (product_id, warehouse_id) GROUP BY calculation_date"""

BODIES = {
    "kpi_inventory": "SELECT * FROM t_kpi_inventory",
    "kpi_supplier": "SELECT * FROM t_kpi_supplier",
    "kpi_logistics": "SELECT * FROM t_kpi_logistics",
    "kpi_service": "SELECT * FROM t_kpi_service",
    "kpi_executive": "SELECT * FROM t_kpi_executive",
    "kpi_run_all": "\nUNION ALL\n".join(
        f"SELECT 'kpi_{n}' AS table_name, COUNT(*) AS row_count FROM t_kpi_{n}"
        for n in ("inventory", "supplier", "logistics", "service", "executive")
    ),
    "v_executive_dashboard": EXEC_VIEW,
    "q39_kpi_trend": f"""SELECT *, stock_out_pct - prev_stock_out_pct AS stock_out_change FROM (
        SELECT calculation_date, total_inventory_value, stock_out_rate * 100 AS stock_out_pct, fill_rate * 100 AS fill_rate_pct,
          LAG(stock_out_rate * 100) OVER (ORDER BY calculation_date) AS prev_stock_out_pct FROM t_history)""",
    "q40_scorecard_rank": f"""SELECT supplier_id, supplier_name, {dbl('c.reliability_score')} AS reliability_score, on_time_pct, overall_grade,
        rank_position, PERCENT_RANK() OVER (ORDER BY on_time_pct DESC) AS percentile,
        on_time_pct - (SELECT {mean('CAST(on_time_pct AS DECIMAL(5,2))')} FROM t_cards) AS vs_avg
        FROM t_cards c JOIN t_suppliers s USING (supplier_id)""",
    "q43_composite_score": f"""SELECT warehouse_id, warehouse_name, region, fill_rate, stock_out_freq, turnover, inventory_value,
        {up('score', 2)} AS composite_score, RANK() OVER (ORDER BY score DESC) AS overall_rank FROM (
        SELECT *, fill_rate * 40 + (1 - stock_out_freq) * 30 + LEAST(turnover / 20, 1) * 30 AS score FROM (
        SELECT warehouse_id, warehouse_name, region, COALESCE(s.fill_rate, 0) AS fill_rate, COALESCE(s.stock_out_frequency, 0) AS stock_out_freq,
          COALESCE(k.inventory_turnover, 0) AS turnover, v AS inventory_value
        FROM t_warehouses LEFT JOIN (SELECT warehouse_id, {dbl('CAST(fill_rate AS DECIMAL(5,4))')} AS fill_rate,
            {dbl('CAST(stock_out_frequency AS DECIMAL(5,4))')} AS stock_out_frequency FROM t_kpi_service) s USING (warehouse_id)
          LEFT JOIN (SELECT warehouse_id, {dbl('CAST(inventory_turnover AS DECIMAL(10,4))')} AS inventory_turnover FROM t_kpi_inventory) k USING (warehouse_id)
          LEFT JOIN (SELECT warehouse_id, {dbl('SUM(inventory_value)')} AS v FROM t_inventory GROUP BY warehouse_id) USING (warehouse_id)))""",
    "inv_health": f"SELECT {HEALTH_OUT} FROM t_health",
    "inv_overstocked": f"SELECT {HEALTH_OUT} FROM t_health WHERE health_status IN ('Overstocked', 'Dead Inventory') OR days_of_inventory > 180",
    "inv_understocked": f"SELECT {HEALTH_OUT} FROM t_health WHERE {LOW}",
    "inv_dead": f"SELECT {HEALTH_OUT} FROM t_health WHERE days_of_inventory > 180 OR health_status = 'Dead Inventory'",
    "inv_fast_moving": f"SELECT {HEALTH_OUT} FROM t_health WHERE inventory_turnover > 12 OR health_status = 'Fast Moving'",
    "inv_alerts": "SELECT * FROM t_alerts",
    "inv_reorder_qty": f"""SELECT product_id, product_name, warehouse_id, current_stock, reorder_point,
        GREATEST(reorder_point - current_stock + safety_stock, safety_stock) AS recommended_reorder, health_status AS status,
        CASE WHEN health_status = 'Stock Out' THEN 'critical' ELSE 'high' END AS priority FROM t_health WHERE {LOW} ORDER BY {URGENCY} LIMIT 50""",
    "inv_summary": f"SELECT {SUMMARY} FROM t_health",
    "inv_analyze": f"SELECT {SUMMARY}, COUNT(*) FILTER (WHERE {LOW}) AS alerts_count FROM t_health",
    "sup_performance": f"SELECT {PERF_OUT} FROM t_perf",
    "sup_delayed": f"SELECT {PERF_OUT}, 100 - on_time_pct AS delay_rate FROM t_perf WHERE 100 - on_time_pct >= 15",
    "sup_scorecards": f"SELECT {PERF_OUT} FROM t_cards",
    "sup_scorecard_text": CARD_TEXT,
    "sup_rank": f"SELECT {PERF_OUT} FROM t_perf ORDER BY on_time_pct DESC, supplier_id LIMIT 20",
    "sup_summary": SUP_SUMMARY,
    "sup_analyze": f"SELECT *, (SELECT COUNT(*) FROM t_cards) AS scorecards_generated FROM ({SUP_SUMMARY})",
    "log_summary": "SELECT * FROM t_routes",
    "log_delayed": LATE,
    "log_delayed_buckets": LATE,
    "log_high_risk": "SELECT * FROM t_routes WHERE delay_rate_pct >= 20",
    "log_expensive": "SELECT * FROM t_routes ORDER BY avg_shipping_cost DESC, route, carrier LIMIT 20",
    "log_carriers": "SELECT * FROM t_carriers",
    "log_recommendations": LOG_REC,
    "log_totals": TOTALS,
    "log_analyze": f"SELECT *, (SELECT COUNT(*) FROM ({LOG_REC})) AS recommendation_count FROM ({TOTALS})",
}
PAIR, ROUTE, SUPPLIER = "concat_ws('|', product_id, warehouse_id)", "concat_ws('|', route, carrier)", "CAST(supplier_id AS VARCHAR)"
BODIES |= {
    "inv_bundle": unfolded([
        ("summary", "''", BODIES["inv_analyze"]), ("alerts", PAIR, BODIES["inv_alerts"]),
        ("recommendations", PAIR, BODIES["inv_reorder_qty"].replace("LIMIT 50", "LIMIT 20")),
    ]),
    "sup_bundle": unfolded([
        ("summary", "''", SUP_SUMMARY), ("scorecards", SUPPLIER, BODIES["sup_scorecards"]),
        ("top_suppliers", SUPPLIER, BODIES["sup_rank"].replace("LIMIT 20", "LIMIT 10")),
        ("delayed_suppliers", SUPPLIER, BODIES["sup_delayed"] + " ORDER BY delay_rate DESC, supplier_id LIMIT 10"),
    ]),
    "log_bundle": unfolded([
        ("summary", "''", TOTALS), ("recommendations", "concat_ws('|', type, entity, carrier)", LOG_REC),
        ("high_risk_routes", ROUTE, BODIES["log_high_risk"] + " ORDER BY delay_rate_pct DESC, route, carrier LIMIT 10"),
        ("carrier_performance", "carrier", BODIES["log_carriers"]),
    ]),
}
SQL = {name: with_tables(body) for name, body in BODIES.items()}
