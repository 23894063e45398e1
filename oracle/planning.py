"""Demand series, seasonal forecasts, optimization, insights, reports, lookups and measures."""

from __future__ import annotations

import oracle.etl  # noqa: F401  (registers the feed expressions)
from oracle.analysis import DAY, EXEC_VIEW, LATE, LOW, URGENCY
from oracle.base import CTES, big, dbl, even, fmt, mean, share, unfolded, up, with_tables
from oracle.numbered import HEALTH_OUT

CTES["t_monthly"] = f"""
SELECT product_id, CAST(date_trunc('month', demand_date) AS DATE) AS demand_date, {big('SUM(demand_quantity)')} AS demand
FROM t_demand GROUP BY 1, 2"""
CTES["t_lags"] = """
SELECT * FROM (SELECT *, LAG(demand, 1) OVER w AS lag_1, LAG(demand, 2) OVER w AS lag_2, LAG(demand, 3) OVER w AS lag_3,
  LAG(demand, 6) OVER w AS lag_6, LAG(demand, 12) OVER w AS lag_12,
  AVG(demand) OVER (PARTITION BY product_id ORDER BY demand_date ROWS 2 PRECEDING) AS rolling_mean_3,
  AVG(demand) OVER (PARTITION BY product_id ORDER BY demand_date ROWS 5 PRECEDING) AS rolling_mean_6,
  CAST(month(demand_date) AS INTEGER) AS month, CAST(quarter(demand_date) AS INTEGER) AS quarter
FROM t_monthly WINDOW w AS (PARTITION BY product_id ORDER BY demand_date)) WHERE lag_12 IS NOT NULL"""
DIGEST = "md5(product_id || '|' || demand_date || '|42')"
CTES["t_year_old"] = """
SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY demand_date) AS pos,
  COUNT(*) OVER (PARTITION BY product_id) AS months, MIN(demand_date) OVER (PARTITION BY product_id) AS first_month,
  MAX(demand_date) OVER (PARTITION BY product_id) AS last_month FROM t_monthly) WHERE months >= 12"""


def fitted(rows: str) -> str:
    """Line and calendar-month effects over relation ``rows`` (product_id, x, moy, demand, train, ...)."""
    return f"""
SELECT r.*, GREATEST(a + b * x + COALESCE((my - (a * mn + b * mx)) / mn, 0), 0) AS predicted
FROM {rows} r JOIN (
  SELECT product_id, b, (sy - b * sx) / n AS a FROM (
    SELECT *, COALESCE((n * sxy - sx * sy) / NULLIF(n * sxx - sx * sx, 0), 0) AS b FROM (
      SELECT product_id, COUNT(*)::DOUBLE AS n, SUM(x)::DOUBLE AS sx, SUM(demand)::DOUBLE AS sy, SUM(x * demand)::DOUBLE AS sxy,
        SUM(x * x)::DOUBLE AS sxx FROM {rows} WHERE train GROUP BY product_id))) l ON l.product_id = r.product_id
LEFT JOIN (SELECT product_id, moy, COUNT(*)::DOUBLE AS mn, SUM(x)::DOUBLE AS mx, SUM(demand)::DOUBLE AS my
  FROM {rows} WHERE train GROUP BY product_id, moy) m ON m.product_id = r.product_id AND m.moy = r.moy"""


CTES["t_split"] = """
SELECT product_id, demand_date, demand, date_diff('month', first_month, demand_date) AS x, month(demand_date) AS moy,
  pos <= floor(months * 0.8::DOUBLE) AS train FROM t_year_old"""
CTES["t_holdout"] = f"""
SELECT 'seasonal_trend' AS model, product_id, demand_date, demand AS actual, predicted FROM ({fitted('t_split')}) WHERE NOT train"""
METRICS = f"""{up('sqrt(AVG((actual - predicted) * (actual - predicted)))', 6)} AS rmse, {up('AVG(abs(actual - predicted))', 6)} AS mae,
  {up('COALESCE(AVG(abs((actual - predicted) / actual)) FILTER (WHERE actual <> 0) * 100, 0)', 6)} AS mape"""
CTES["t_scores"] = f"SELECT model, {METRICS} FROM t_holdout GROUP BY model"
CTES["t_future"] = """
SELECT product_id, 0 AS step, demand, date_diff('month', first_month, demand_date) AS x, month(demand_date) AS moy, TRUE AS train, last_month
FROM t_year_old
UNION ALL
SELECT product_id, step, NULL, date_diff('month', first_month, last_month) + step,
  month(last_month + to_months(CAST(step AS INTEGER))), FALSE, last_month FROM t_year_old, generate_series(1, 12) g(step) WHERE pos = months"""
CTES["t_ahead"] = f"SELECT product_id, last_month, step, predicted FROM ({fitted('t_future')}) WHERE step > 0"
CTES["t_forecasts"] = f"""
SELECT product_id, CAST(NULL AS VARCHAR) AS warehouse_id, CAST(NULL AS VARCHAR) AS region,
  CAST(last_month + to_months(CAST(step AS INTEGER)) AS DATE) AS forecast_date, CAST(h AS INTEGER) AS horizon_months,
  'seasonal_trend' AS model_name, {even('predicted', 2)} AS predicted_demand, {even('predicted * 0.85::DOUBLE', 2)} AS lower_bound,
  {even('predicted * 1.15::DOUBLE', 2)} AS upper_bound, (SELECT rmse FROM t_scores) AS rmse, (SELECT mae FROM t_scores) AS mae,
  (SELECT mape FROM t_scores) AS mape
FROM t_ahead, (VALUES (3), (6), (12)) v(h) WHERE step <= h"""

# The trend of straight pieces: the normal equations of each product, their Cholesky factor and both substitutions.
SINES = {
    "sin1": [500, 866, 1000, 866, 500, 0, -500, -866, -1000, -866, -500, 0], "cos1": [866, 500, 0, -500, -866, -1000, -866, -500, 0, 500, 866, 1000],
    "sin2": [866, 866, 0, -866, -866, 0, 866, 866, 0, -866, -866, 0], "cos2": [500, -500, -1000, -500, 500, 1000, 500, -500, -1000, -500, 500, 1000],
}
PIECES = [  # value, divisor, ridge
    ("1", 1, 0), ("x", 1, 500), ("GREATEST(x - CAST(floor(span * 1 / 3) AS BIGINT), 0)", 1, 5000),
    ("GREATEST(x - CAST(floor(span * 2 / 3) AS BIGINT), 0)", 1, 5000), *[(f"{values}[moy]", 1000, 50) for values in SINES.values()],
]


def solved(rows: str) -> str:
    """Coefficients w0 to w7 of each product from relation ``rows`` (product_id, x, moy, span, demand)."""
    ids = range(len(PIECES))
    value = ", ".join(f"CAST({v} AS BIGINT) AS f{i}" for i, (v, _, _) in enumerate(PIECES))
    lower = [(i, j) for i in ids for j in ids if j <= i]
    gram = ", ".join(f"SUM(f{i} * f{j})::DOUBLE / {float(PIECES[i][1] * PIECES[j][1])}::DOUBLE + {float(PIECES[i][2] if i == j else 0)}::DOUBLE AS g{i}{j}" for i, j in lower)
    right = ", ".join(f"SUM(f{i} * demand)::DOUBLE / {float(PIECES[i][1])}::DOUBLE AS b{i}" for i in ids)
    out = f"SELECT product_id, {gram}, {right} FROM (SELECT product_id, demand, {value} FROM {rows}) GROUP BY product_id"
    for j in ids:
        out = f"SELECT *, sqrt(g{j}{j}{''.join(f' - l{j}{k} * l{j}{k}' for k in range(j))}) AS l{j}{j} FROM ({out})"
        for i in range(j + 1, len(PIECES)):
            out = f"SELECT *, (g{i}{j}{''.join(f' - l{i}{k} * l{j}{k}' for k in range(j))}) / l{j}{j} AS l{i}{j} FROM ({out})"
    for i in ids:
        out = f"SELECT *, (b{i}{''.join(f' - l{i}{k} * z{k}' for k in range(i))}) / l{i}{i} AS z{i} FROM ({out})"
    for i in reversed(ids):
        out = f"SELECT *, (z{i}{''.join(f' - l{k}{i} * w{k}' for k in range(i + 1, len(PIECES)))}) / l{i}{i} AS w{i} FROM ({out})"
    return out


LEVEL = "w0" + "".join(f" + w{i} * (CAST({v} AS DOUBLE) / {float(d)}::DOUBLE)" for i, (v, d, _) in enumerate(PIECES) if i)
CTES["t_span"] = """
SELECT product_id, MIN(demand_date) AS first_day, MAX(demand_date) AS last_day, date_diff('month', MIN(demand_date), MAX(demand_date)) AS whole
FROM t_monthly GROUP BY product_id HAVING COUNT(*) >= 12"""
CTES["t_pieces"] = """
SELECT product_id, demand_date, demand, date_diff('month', first_day, demand_date) AS x, month(demand_date) AS moy, whole,
  CAST(floor(whole * 8 / 10) AS BIGINT) AS span FROM t_monthly JOIN t_span USING (product_id)"""
CTES["t_pieces_seen"] = "SELECT * FROM t_pieces WHERE x <= span"
CTES["t_pieces_all"] = "SELECT * REPLACE (whole AS span) FROM t_pieces"
CTES["t_pieces_held"] = f"""
SELECT 'piecewise_trend' AS model, product_id, demand_date, demand AS actual, {up(f'GREATEST({LEVEL}, 0)', 4)} AS predicted
FROM t_pieces JOIN ({solved('t_pieces_seen')}) USING (product_id) WHERE x > span"""
CTES["t_pieces_scores"] = f"SELECT model, {METRICS} FROM t_pieces_held GROUP BY model"
CTES["t_pieces_ahead"] = f"""
SELECT product_id, last_day, step, {up(f'GREATEST({LEVEL}, 0)', 4)} AS predicted FROM (
  SELECT product_id, last_day, step, whole AS span, whole + step AS x, month(last_day + to_months(CAST(step AS INTEGER))) AS moy
  FROM t_span, generate_series(1, 12) g(step)) JOIN ({solved('t_pieces_all')}) USING (product_id)"""

CTES["t_stats"] = f"""
SELECT product_id, warehouse_id, {mean('demand_quantity')} AS avg_daily_demand, {big('SUM(demand_quantity)')} AS total_demand
FROM t_demand GROUP BY product_id, warehouse_id"""
CTES["t_expected"] = f"""
SELECT product_id, {mean('CAST(predicted_demand AS DECIMAL(12,2))')} AS expected_monthly_demand
FROM t_forecasts WHERE horizon_months = 3 GROUP BY product_id"""
CTES["t_lead"] = """
SELECT product_id, lead_time_days FROM (SELECT l_partkey AS product_id, MIN(l_suppkey) AS supplier_id FROM lineitem GROUP BY l_partkey)
JOIN t_suppliers USING (supplier_id)"""


def eoq(demand: str, cost: str) -> str:
    return f"""CAST(CASE WHEN {demand} <= 0 OR {cost} <= 0 THEN 0
      ELSE GREATEST(round_even(sqrt(2.0::DOUBLE * {demand} * 50 / (CAST({cost} AS DOUBLE) * 0.25)), 0), 1) END AS INTEGER)"""


def buffer(daily: str, lead: str) -> str:
    return f"CAST(GREATEST(round_even(1.65::DOUBLE * ({daily} * 0.3) * sqrt({lead} / 30.0::DOUBLE), 0), 0) AS INTEGER)"


CTES["t_terms"] = """
SELECT i.product_id, i.warehouse_id, current_stock, reorder_point, unit_cost, COALESCE(lead_time_days, 7) AS lead_time_days
FROM t_inventory i JOIN t_products p ON p.product_id = i.product_id LEFT JOIN t_lead l ON l.product_id = i.product_id"""
CTES["t_recs"] = f"""
SELECT product_id, warehouse_id, {DAY} AS recommendation_date, current_stock,
  CASE WHEN current_stock <= point THEN GREATEST(eoq, CAST(trunc(expected - current_stock + ss) AS INTEGER))
       WHEN current_stock <= reorder_point THEN eoq ELSE 0 END AS recommended_reorder,
  {even('expected', 2)} AS expected_demand, ss AS safety_stock, eoq, point AS new_point,
  CASE WHEN current_stock <= point AND current_stock <= 0 THEN 'critical' WHEN current_stock <= point THEN 'high'
       WHEN current_stock <= reorder_point THEN 'medium' ELSE 'low' END AS priority, 'pending' AS status
FROM (SELECT *, CAST(trunc(daily * lead_time_days + ss) AS INTEGER) AS point FROM (
  SELECT *, {eoq('(daily * 365)', 'unit_cost')} AS eoq, {buffer('daily', 'lead_time_days')} AS ss FROM (
    SELECT t.*, COALESCE(avg_daily_demand, 1) AS daily,
      COALESCE(expected_monthly_demand, COALESCE(avg_daily_demand, 1) * 30) * 3 AS expected
    FROM t_terms t LEFT JOIN t_stats s ON s.product_id = t.product_id AND s.warehouse_id = t.warehouse_id
      LEFT JOIN t_expected e ON e.product_id = t.product_id)))"""
RECS = "SELECT * EXCLUDE (new_point), new_point AS reorder_point FROM t_recs WHERE recommended_reorder > 0"
CTES["t_queue"] = RECS
REC_SUMMARY = f"""SELECT COUNT(*) AS total_recommendations, COUNT(*) FILTER (WHERE priority = 'critical') AS critical,
  COUNT(*) FILTER (WHERE priority = 'high') AS high_priority, {big('COALESCE(SUM(recommended_reorder), 0)')} AS total_reorder_units FROM t_queue"""


def insight(category, kind, entity, metric, value, threshold, severity, title, text, advice, source):
    return f"""SELECT {DAY} AS insight_date, '{category}' AS category, '{kind}' AS entity_type, CAST({entity} AS VARCHAR) AS entity_id,
  '{metric}' AS metric_name, {value} AS metric_value, {dbl(threshold)} AS threshold_value, {severity} AS severity, {title} AS title,
  {text} AS description, '{advice}' AS recommendation FROM ({source})"""


CTES["t_ins_stock"] = insight(
    "inventory", "warehouse", "warehouse_id", "stock_out_rate", even("r", 4), "0.05",
    "CASE WHEN r * 100 > 10 THEN 'high' ELSE 'medium' END", "'Elevated stock-outs at ' || warehouse_id",
    f"'Warehouse ' || warehouse_id || ' has experienced a ' || {fmt('LEAST(r * 100 * 0.3::DOUBLE, 17)', 0)} || "
    "'% increase in stock-outs (' || o || ' of ' || n || ' SKUs affected).'",
    "Increase safety stock by 15% and review reorder points for affected SKUs.",
    f"""SELECT warehouse_id, COUNT(*) FILTER (WHERE current_stock <= 0) AS o, COUNT(*) AS n, {share('current_stock <= 0')} AS r
    FROM t_inventory GROUP BY warehouse_id HAVING {share('current_stock <= 0')} > 0.05 ORDER BY r DESC, warehouse_id LIMIT 10""",
)
CTES["t_ins_feed"] = CTES["t_ins_stock"].replace("t_inventory", "t_ok_stock")
CTES["t_ins_supplier"] = insight(
    "supplier", "supplier", "supplier_id", "delay_rate", even("100 - p", 2), "15",
    "CASE WHEN 100 - p > 20 THEN 'high' ELSE 'medium' END", "'Supplier ' || supplier_id || ' delivery delays'",
    f"'Supplier ' || supplier_id || ' has a delivery delay rate of ' || {fmt('100 - p', 0)} || '%.'",
    "Review supplier contract or switch vendors.",
    "SELECT supplier_id, on_time_delivery_pct AS p FROM t_kpi_supplier WHERE on_time_delivery_pct < 85 ORDER BY p, supplier_id LIMIT 10",
)
RATE4 = "CAST(ROUND(CAST(delayed_shipment_rate AS DECIMAL(38,10)), 4) AS DOUBLE)"
CTES["t_ins_route"] = insight(
    "logistics", "route", "route", "delay_rate", even("r * 100", 2), "15",
    "CASE WHEN r * 100 > 25 THEN 'high' ELSE 'medium' END", "'High-risk route: ' || route",
    f"'Route ' || route || ' via ' || carrier || ' has a ' || {fmt('r * 100', 1)} || '% delay rate across ' || total_shipments || ' shipments.'",
    "Evaluate alternative carriers or adjust expected delivery windows.",
    f"SELECT *, {RATE4} AS r FROM t_kpi_logistics WHERE {RATE4} > 0.15 ORDER BY r DESC, route, carrier LIMIT 10",
)
CTES["t_ins_demand"] = insight(
    "demand", "product", "product_id", "demand_growth", even("r * 100", 2), "25", "'medium'", "'Demand spike for ' || product_id",
    f"'Product ' || product_id || ' demand increased ' || {fmt('r * 100', 0)} || '% in the last 30 days (' || {fmt('new', 0)} || "
    f"' vs ' || {fmt('old', 0)} || ' units).'",
    "Increase forecast and safety stock; verify supplier capacity.",
    f"""SELECT *, CAST(new - old AS DOUBLE) / NULLIF(old, 0) AS r FROM (
      SELECT product_id, SUM(demand_quantity) FILTER (WHERE demand_date >= {DAY} - 30) AS new,
        SUM(demand_quantity) FILTER (WHERE demand_date >= {DAY} - 60 AND demand_date < {DAY} - 30) AS old FROM t_demand GROUP BY product_id)
    WHERE new IS NOT NULL AND old > 10 AND CAST(new - old AS DOUBLE) / NULLIF(old, 0) > 0.25 ORDER BY r DESC, product_id LIMIT 10""",
)
CTES["t_insights"] = """
SELECT * FROM t_ins_stock UNION ALL SELECT * FROM t_ins_supplier UNION ALL SELECT * FROM t_ins_route UNION ALL SELECT * FROM t_ins_demand"""

REPORT = f"""SELECT {DAY} AS report_date, {', '.join(f'{c} AS executive_{c}' for c in (
    'calculation_date', 'total_products', 'total_inventory_value', 'stock_out_rate', 'fill_rate', 'forecast_accuracy',
    'avg_supplier_reliability', 'total_orders', 'revenue'))},
  (SELECT COUNT(*) FROM t_inventory) AS inventory_records, (SELECT {dbl('SUM(inventory_value)')} FROM t_inventory) AS total_inventory_value,
  (SELECT COUNT(*) FROM t_orders) AS total_orders, (SELECT COUNT(*) FROM t_insights) AS active_insights FROM t_kpi_executive"""
LINES = [
    ("Report Date", "report_date", 0), ("Executive Calculation Date", "executive_calculation_date", 0),
    ("Executive Total Products", "executive_total_products", 0), ("Executive Total Inventory Value", "executive_total_inventory_value", 1),
    ("Executive Stock Out Rate", "executive_stock_out_rate", 1), ("Executive Fill Rate", "executive_fill_rate", 1),
    ("Executive Forecast Accuracy", "executive_forecast_accuracy", 1),
    ("Executive Avg Supplier Reliability", "executive_avg_supplier_reliability", 1),
    ("Executive Total Orders", "executive_total_orders", 0), ("Executive Revenue", "executive_revenue", 1),
    ("Inventory Records", "inventory_records", 0), ("Total Inventory Value", "total_inventory_value", 1),
    ("Total Orders", "total_orders", 0), ("Active Insights", "active_insights", 0),
]
CTES["t_report"] = REPORT
REPORT_TEXT = "\nUNION ALL\n".join(
    f"SELECT {i}::BIGINT AS line_number, '- **{label}:** ' || "
    + (f"CAST(CAST({c} AS DECIMAL(24,4)) AS VARCHAR)" if number else c) + " AS line FROM t_report"
    for i, (label, c, number) in enumerate(LINES, 1)
)

MOVED = "SUM(CASE WHEN is_delayed THEN 1 ELSE 0 END)"
MATRIX = ", ".join(
    f"""CAST(COUNT(*) FILTER (WHERE carrier = 'Carrier {i}' AND is_delayed) AS DOUBLE)
        / NULLIF(COUNT(*) FILTER (WHERE carrier = 'Carrier {i}'), 0) * 100 AS "Carrier {i}\""""
    for i in range(8)
)

# All rows that no model is fitted on, and what is certain about a prediction of them.
HELD_OUT = f"""SELECT '{{name}}' AS model, product_id, demand_date, demand AS actual, {{last}} FROM t_lags
    WHERE CAST('0x' || {DIGEST}[9:16] AS BIGINT) % 100 >= 80"""

BODIES = {
    "fc_calendar_features": f"""SELECT product_id, demand_date, demand, CAST(year(demand_date) AS INTEGER) AS year,
        CAST(month(demand_date) AS INTEGER) AS month, CAST(isodow(demand_date) - 1 AS INTEGER) AS day_of_week,
        CAST(weekofyear(demand_date) AS INTEGER) AS week_of_year, CAST(quarter(demand_date) AS INTEGER) AS quarter FROM (
        SELECT product_id, demand_date, {big('SUM(demand_quantity)')} AS demand FROM t_demand GROUP BY product_id, demand_date)""",
    "fc_daily_demand": f"SELECT product_id, demand_date, {big('SUM(demand_quantity)')} AS demand FROM t_demand GROUP BY product_id, demand_date",
    "fc_monthly_series": "SELECT * FROM t_monthly",
    "fc_lag_features": "SELECT * FROM t_lags",
    "fc_sample_split": f"""SELECT * EXCLUDE (u, d), CAST('0x' || d[9:16] AS BIGINT) % 100 >= 80 AS is_test FROM (
        SELECT *, {DIGEST} AS d, CAST('0x' || {DIGEST}[1:8] AS BIGINT) AS u FROM t_lags ORDER BY u, product_id, demand_date LIMIT 50000)""",
    "fc_top_products": f"SELECT product_id, {big('SUM(demand)')} AS total_demand FROM t_lags GROUP BY product_id ORDER BY SUM(demand) DESC, product_id LIMIT 100",
    "fc_linear": HELD_OUT.format(name="linear_regression", last="CAST(demand AS DOUBLE) AS predicted"),
    "fc_random_forest_range": HELD_OUT.format(name="random_forest", last="true AS in_training_range"),
    "fc_gbt_sign": HELD_OUT.format(name="gradient_boosting", last="true AS not_negative"),
    "fc_train_select_errors": """SELECT model, model = 'linear_regression' AS is_best, count(*) > 0 AS errors_agree
        FROM t_lags, (VALUES ('linear_regression'), ('random_forest'), ('gradient_boosting')) v(model) GROUP BY model""",
    "fc_generate_bounds": """SELECT product_id, CAST(d + to_months(CAST(m AS INTEGER)) AS DATE) AS forecast_date, h AS horizon_months,
        'gradient_boosting' AS model_name, true AS bounds_agree
        FROM (SELECT product_id, MAX(demand_date) AS d FROM t_lags GROUP BY product_id), (VALUES (3), (6), (12)) v(h), generate_series(1, 12) s(m)
        WHERE m <= h""",
    "fc_seasonal": "SELECT * FROM t_holdout",
    "fc_metrics": "SELECT * FROM t_scores",
    "fc_mape": f"""SELECT product_id, {up('COALESCE(AVG(abs((actual - predicted) / actual)) FILTER (WHERE actual <> 0) * 100, 0)', 6)} AS mape
        FROM t_holdout GROUP BY product_id""",
    "fc_seasonal_forecasts": "SELECT * FROM t_forecasts",
    "fc_piecewise": "SELECT * FROM t_pieces_held",
    "fc_piecewise_metrics": "SELECT * FROM t_pieces_scores UNION ALL SELECT * FROM t_scores",
    "fc_piecewise_forecasts": f"""SELECT product_id, CAST(NULL AS VARCHAR) AS warehouse_id, CAST(NULL AS VARCHAR) AS region,
        CAST(last_day + to_months(CAST(step AS INTEGER)) AS DATE) AS forecast_date, CAST(h AS INTEGER) AS horizon_months,
        'piecewise_trend' AS model_name, {even('predicted', 2)} AS predicted_demand, {even('predicted * 0.85::DOUBLE', 2)} AS lower_bound,
        {even('predicted * 1.15::DOUBLE', 2)} AS upper_bound, (SELECT rmse FROM t_pieces_scores) AS rmse,
        (SELECT mae FROM t_pieces_scores) AS mae, (SELECT mape FROM t_pieces_scores) AS mape
        FROM t_pieces_ahead, (VALUES (3), (6), (12)) v(h) WHERE step <= h""",
    "q38_forecast_accuracy": f"""SELECT product_id, model_name, horizon_months, {up('AVG(mape)', 2)} AS avg_mape, {up('AVG(rmse)', 2)} AS avg_rmse,
        COUNT(*) AS forecast_count FROM t_forecasts GROUP BY product_id, model_name, horizon_months
        ORDER BY avg_mape, product_id, model_name, horizon_months LIMIT 20""",
    "opt_eoq": f"SELECT product_id, warehouse_id, {eoq('(avg_daily_demand * 365)', 'unit_cost')} AS eoq FROM t_stats JOIN t_products USING (product_id)",
    "opt_safety_stock": f"SELECT product_id, warehouse_id, {buffer('avg_daily_demand', 'lead_time_days')} AS safety_stock FROM t_stats JOIN t_lead USING (product_id)",
    "opt_demand_stats": "SELECT * FROM t_stats",
    "opt_expected_demand": "SELECT * FROM t_expected",
    "opt_primary_supplier": f"SELECT * REPLACE ({dbl('unit_cost')} AS unit_cost) FROM t_terms",
    "opt_recommendations": "SELECT * FROM t_queue",
    "opt_recommendation_text": f"""SELECT product_id, warehouse_id, 'Product ID: ' || product_id || chr(10) || 'Product: ' || product_name || chr(10) ||
        'Warehouse: ' || warehouse_id || chr(10) || chr(10) || 'Recommended Reorder: ' || recommended_reorder || ' Units' || chr(10) ||
        'Expected Demand: ' || {fmt('expected_demand', 0)} || ' Units' || chr(10) || 'Safety Stock: ' || safety_stock || ' Units' || chr(10) ||
        'EOQ: ' || eoq || ' Units' || chr(10) || 'Priority: ' || priority AS recommendation FROM t_queue JOIN t_products USING (product_id)""",
    "opt_summary": REC_SUMMARY,
    "opt_bundle": unfolded([
        ("summary", "''", REC_SUMMARY), ("recommendations", "concat_ws('|', product_id, warehouse_id)", "SELECT * FROM t_queue"),
        ("sample", "concat_ws('|', product_id, warehouse_id)", "SELECT * FROM t_queue ORDER BY product_id, warehouse_id LIMIT 10"),
    ]),
    "opt_run": f"SELECT *, (SELECT COUNT(*) FROM t_queue) AS recommendations_count FROM ({REC_SUMMARY})",
    "q41_priority_queue": """SELECT product_id, product_name, warehouse_id, current_stock, recommended_reorder, expected_demand, priority,
        ROW_NUMBER() OVER (PARTITION BY priority ORDER BY expected_demand DESC, product_id, warehouse_id) AS priority_rank
        FROM t_queue JOIN t_products USING (product_id)""",
    "ins_stockout": "SELECT * FROM t_ins_feed",
    "ins_supplier_delay": "SELECT * FROM t_ins_supplier",
    "ins_route_delay": "SELECT * FROM t_ins_route",
    "ins_demand_spike": "SELECT * FROM t_ins_demand",
    "ins_generate": "SELECT * FROM t_insights",
    "ins_get": "SELECT * FROM t_insights WHERE severity = 'high'",
    "ins_counts": "SELECT category, severity, COUNT(*) AS insight_count FROM t_insights GROUP BY GROUPING SETS ((category), (severity), ())",
    "q42_severity_dashboard": f"""SELECT category, severity, n AS insight_count, {up('CAST(n AS DOUBLE) / SUM(n) OVER (PARTITION BY category) * 100', 2)} AS pct_of_category
        FROM (SELECT category, severity, COUNT(*) AS n FROM t_insights GROUP BY category, severity)""",
    "rep_executive_summary": "SELECT * FROM t_report",
    "rep_executive_text": REPORT_TEXT,
    "api_exec_latest": EXEC_VIEW,
    "api_kpi_inventory": "SELECT * FROM t_kpi_inventory",
    "api_kpi_supplier": "SELECT * FROM t_kpi_supplier ORDER BY supplier_rank, supplier_id LIMIT 20",
    "api_kpi_logistics": "SELECT * FROM t_kpi_logistics",
    "api_alerts": """SELECT * FROM t_alerts ORDER BY CASE severity WHEN 'critical' THEN 1 WHEN 'high' THEN 2 ELSE 3 END, product_id, warehouse_id LIMIT 100""",
    "api_overstocked": f"""SELECT {HEALTH_OUT} FROM t_health WHERE health_status IN ('Overstocked', 'Dead Inventory') OR days_of_inventory > 180
        ORDER BY t_health.inventory_value DESC, product_id, warehouse_id LIMIT 50""",
    "api_understocked": f"SELECT {HEALTH_OUT} FROM t_health WHERE {LOW} ORDER BY {URGENCY} LIMIT 50",
    "api_delayed": f"{LATE} ORDER BY delay_days DESC, shipment_id LIMIT 50",
    "api_forecast_lookup": """SELECT * EXCLUDE (rmse, mae, mape) FROM t_forecasts WHERE horizon_months = 12 AND product_id = (
        SELECT product_id FROM t_forecasts WHERE horizon_months = 12 GROUP BY product_id
        ORDER BY SUM(CAST(predicted_demand AS DECIMAL(18,2))) DESC, product_id LIMIT 1)""",
    "api_forecasts": "SELECT * FROM t_forecasts WHERE horizon_months = 3 ORDER BY forecast_date, product_id LIMIT 500",
    "api_top_products": f"""SELECT product_id, product_name, category, {big('SUM(quantity)')} AS total_quantity, {dbl('SUM(total_amount)')} AS total_revenue
        FROM t_orders JOIN t_products USING (product_id) WHERE order_status = 'Delivered' GROUP BY product_id, product_name, category
        ORDER BY SUM(total_amount) DESC, product_id LIMIT 20""",
    "api_regional_demand": f"""SELECT customer_region AS region, COUNT(*) AS order_count, {big('SUM(quantity)')} AS total_quantity,
        {dbl('SUM(total_amount)')} AS total_revenue FROM t_orders WHERE order_status = 'Delivered' GROUP BY customer_region""",
    "bi_turnover": f"""SELECT COALESCE(CAST((SELECT SUM(quantity) FROM t_orders) AS DOUBLE) / (SELECT {mean('current_stock')} FROM t_inventory), 0)
        AS inventory_turnover""",
    "bi_days_of_inventory": f"""SELECT COALESCE(365 / NULLIF(CAST((SELECT SUM(quantity) FROM t_orders) AS DOUBLE)
        / (SELECT {mean('current_stock')} FROM t_inventory), 0), 0) AS days_of_inventory""",
    "bi_on_time": """SELECT COALESCE(CAST(COUNT(*) FILTER (WHERE is_on_time) AS DOUBLE)
        / NULLIF(COUNT(*) FILTER (WHERE order_status = 'Delivered'), 0), 0) * 100 AS on_time_delivery_pct FROM t_orders""",
    "bi_stock_out_rate": f"SELECT COALESCE({share('current_stock <= 0')}, 0) * 100 AS stock_out_rate FROM t_inventory",
    "bi_fill_rate": f"SELECT {mean('fill_rate')} * 100 AS fill_rate FROM t_orders",
    "bi_delay_rate": f"SELECT COALESCE({share('is_delayed')}, 0) * 100 AS delay_rate FROM t_logistics",
    "bi_revenue_ytd": f"""SELECT order_date, {dbl('r')} AS revenue, {dbl('SUM(r) OVER (PARTITION BY year(order_date) ORDER BY order_date)')} AS revenue_ytd
        FROM (SELECT order_date, SUM(total_amount) AS r FROM t_orders GROUP BY order_date)""",
    "bi_mom_growth": f"""SELECT month, {dbl('ytd')} AS revenue_ytd, {dbl('prev')} AS prev_month_ytd,
        COALESCE({dbl('ytd - prev')} / NULLIF({dbl('prev')}, 0), 0) * 100 AS mom_growth_pct FROM (
        SELECT *, LAG(ytd) OVER (ORDER BY month) AS prev FROM (
        SELECT month, SUM(COALESCE(r, 0)) OVER (PARTITION BY year(month) ORDER BY month) AS ytd FROM (
        SELECT CAST(unnest(generate_series(date_trunc('month', MIN(order_date)), date_trunc('month', MAX(order_date)), INTERVAL 1 MONTH)) AS DATE) AS month
        FROM t_orders) LEFT JOIN (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, SUM(total_amount) AS r FROM t_orders GROUP BY 1) USING (month)))""",
    "bi_route_matrix": f"SELECT route, {MATRIX} FROM t_logistics GROUP BY route",
    "bi_cost_per_km": f"""SELECT shipment_id, carrier, route, {dbl('shipping_cost')} AS shipping_cost, {dbl('distance_km')} AS distance_km,
        {dbl('shipping_cost')} / NULLIF({dbl('distance_km')}, 0) AS cost_per_km FROM t_logistics""",
    "bi_actual_vs_forecast": """SELECT COALESCE(a.product_id, f.product_id) AS product_id, COALESCE(demand_date, month) AS month, demand, predicted_demand
        FROM t_monthly a FULL JOIN (SELECT product_id, CAST(date_trunc('month', forecast_date) AS DATE) AS month, predicted_demand
          FROM t_forecasts WHERE horizon_months = 12) f ON f.product_id = a.product_id AND f.month = a.demand_date""",
    "bi_model_comparison": f"SELECT model_name, {up('AVG(rmse)', 4)} AS rmse, {up('AVG(mape)', 4)} AS mape, COUNT(*) AS forecast_count FROM t_forecasts GROUP BY model_name",
    "bi_capacity_planning": f"""SELECT warehouse_id, warehouse_name, capacity_units, {dbl('current_utilization')} AS current_utilization, forecast_units,
        {up('forecast_units / capacity_units * 100', 2)} AS forecast_pct_of_capacity FROM (
        SELECT w.*, COALESCE(u, 0) AS forecast_units FROM t_warehouses w LEFT JOIN (
        SELECT warehouse_id, {up('SUM(CAST(ahead * (CAST(total_demand AS DOUBLE) / NULLIF(whole, 0)) AS DECIMAL(20,6)))', 2)} AS u
        FROM (SELECT *, SUM(total_demand) OVER (PARTITION BY product_id) AS whole FROM t_stats)
          JOIN (SELECT product_id, {dbl('SUM(CAST(predicted_demand AS DECIMAL(12,2)))')} AS ahead FROM t_forecasts WHERE horizon_months = 3 GROUP BY product_id)
          USING (product_id) GROUP BY warehouse_id) USING (warehouse_id))""",
    "bi_exec_cards": """SELECT total_products, total_inventory_value, stock_out_rate * 100 AS stock_out_rate, fill_rate * 100 AS fill_rate,
        forecast_accuracy * 100 AS forecast_accuracy FROM t_kpi_executive""",
    "bi_revenue_trend": f"SELECT order_date, {dbl('SUM(total_amount)')} AS revenue FROM t_orders GROUP BY order_date",
    "bi_health_distribution": "SELECT health_status, COUNT(*) AS item_count FROM t_health GROUP BY health_status",
}
SQL = {name: with_tables(body) for name, body in BODIES.items()}
