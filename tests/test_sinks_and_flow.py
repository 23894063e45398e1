import datetime
import glob
import os
import threading

import pytest
from pyspark.sql import functions as F

from tests.conftest import day
from tidewharf.operators import clean, logistics, optimize, summaries
from tidewharf.plans import flow, registry
from tidewharf.plans.ledger import Ledger, Outcome
from tidewharf.schemas import RAW, SOURCE_TABLES, STORED
from tidewharf.sources import buckets, feeds, files, sinks, versions
from tidewharf.sources.star import StarTables
from tidewharf.sources.tables import SupplyTables, stored_tables


def frame(spark, rows):
    return spark.createDataFrame(rows, "d date, v int")


def values(spark, path):
    return sorted((str(r.d), r.v) for r in spark.read.parquet(path).collect())


def test_snapshot_rerun_and_empty_result(spark, tmp_path):
    path = f"{tmp_path}/s"
    first, second = day("2024-01-01"), day("2024-01-02")
    sinks.replace_day(frame(spark, [(first, 1), (first, 2)]), path, "d", first)
    sinks.replace_day(frame(spark, [(second, 3)]), path, "d", second)
    assert sinks.replace_day(frame(spark, [(second, 4), (first, 9)]), path, "d", second) == 1
    assert values(spark, path) == [("2024-01-01", 1), ("2024-01-01", 2), ("2024-01-02", 4)]
    sinks.replace_day(frame(spark, []), path, "d", first)
    assert values(spark, path) == [("2024-01-02", 4)]


def test_range_replace_keeps_earlier_rows(spark, tmp_path):
    path = f"{tmp_path}/r"
    sinks.replace_from(frame(spark, [(day("2024-01-01"), 1), (day("2024-02-01"), 2)]), path, "d", day("2024-01-01"))
    sinks.replace_from(frame(spark, [(day("2024-03-01"), 3)]), path, "d", day("2024-02-01"))
    assert values(spark, path) == [("2024-01-01", 1), ("2024-03-01", 3)]


def test_range_replace_runs_again(spark, tmp_path):
    path = f"{tmp_path}/again"
    rows = frame(spark, [(day("2024-01-01"), 1), (day("2024-02-01"), 2)])
    for _ in range(3):
        sinks.replace_from(rows, path, "d", day("2024-02-01"))
    assert values(spark, path) == [("2024-02-01", 2)]


def test_projection_casts_and_is_complete(spark):
    row = spark.sql(
        "SELECT date'2024-01-01' calculation_date, 's' supplier_id, 1 reliability_score, 2.5 on_time_delivery_pct, "
        "3 avg_lead_time, 0.1 defect_rate, 5 total_orders, cast('300000000000000' as decimal(28,2)) total_spend, 1 supplier_rank"
    )
    done = sinks.project(row, "kpi_supplier")
    assert done.schema.simpleString() == STORED["kpi_supplier"].simpleString() and done.count() == 1
    with pytest.raises(ValueError):
        sinks.project(row.drop("total_spend"), "kpi_supplier")


def test_reload_may_read_its_own_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert sinks.reload(spark.range(10), path) == 10
    assert sinks.reload(sinks.read(spark, path).filter("id < 3"), path) == 3
    assert sinks.read(spark, path).count() == 3


def test_append_counts_rows_and_projection_drops_helpers(spark, cleaned, tmp_path):
    path = f"{tmp_path}/a"
    assert sinks.append(spark.range(4), path) == 4 and sinks.append(spark.range(3), path) == 3
    assert spark.read.parquet(path).count() == 7
    kept = sinks.project(cleaned["orders"], "orders")
    assert "actual_lead_time" in cleaned["orders"].columns and "actual_lead_time" not in kept.columns


def test_audit(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    for n in (1, 2):
        sinks.audit(spark, f"{tmp_path}/log", "p", "load", n, 0, "success", start, start + datetime.timedelta(seconds=2))
    log = spark.read.parquet(f"{tmp_path}/log")
    assert log.count() == 2 and float(log.agg(F.max("duration_seconds")).first()[0]) == 2.0


def test_load_then_kpis(spark, raw, cleaned, tmp_path):
    folder = str(tmp_path)
    counts = flow.load_tables(spark, raw, folder)
    assert counts["orders"] == 5 and counts["products"] == 3
    assert flow.load_tables(spark, raw, folder) == counts
    stored = sinks.read(spark, f"{folder}/inventory")
    same = cleaned["inventory"].select(stored.columns)
    assert sorted(map(str, stored.collect())) == sorted(map(str, same.collect()))
    t = stored_tables(spark, folder)
    for _ in range(2):
        flow.run_kpis(t, folder, day("2024-03-31"))
    assert spark.read.parquet(f"{folder}/kpi_executive").count() == 1
    assert spark.read.parquet(f"{folder}/kpi_service").count() == 2
    log = spark.read.parquet(f"{folder}/etl_audit_log").groupBy("stage").count()
    assert {r["stage"]: r["count"] for r in log.collect()} == {"extract": 2, "transform": 2, "load": 2}
    dropped = {r["table_name"]: r for r in sinks.read(spark, f"{folder}/etl_drop_stats").collect()}
    for name in raw:
        before, after = raw[name].count(), cleaned[name].count()
        row = dropped[name]
        assert (row["rows_before"], row["rows_after"], row["rows_dropped"]) == (before, after, before - after)
        assert row["repeated_keys"] + row["missing_values"] == row["rows_dropped"]


def part_files(path):
    return {os.path.relpath(f, path) for f in glob.glob(f"{path}/*/*.parquet")}


def test_reader_sees_one_version_throughout_a_reload(spark, tmp_path):
    path = f"{tmp_path}/v"
    sinks.reload(spark.range(10), path)
    reader = sinks.read(spark, path)
    staged = versions.stage(spark.range(100, 103), path)
    assert sinks.read(spark, path).count() == 10  # written, but not the table yet
    versions.commit(spark, path, staged)
    assert reader.count() == 10 and sinks.read(spark, path).count() == 3
    versions.commit(spark, path, staged)  # again, as after an interruption
    assert len(versions.numbers(spark, path)) == 2
    sinks.reload(spark.range(1), path)
    assert len(versions.numbers(spark, path)) == versions.KEEP and sinks.read(spark, path).count() == 1
    assert len(glob.glob(f"{path}/data-*")) == versions.KEEP


def test_interrupted_reload_leaves_the_old_version(spark, tmp_path):
    path = f"{tmp_path}/v"
    sinks.reload(spark.range(10), path)
    with pytest.raises(Exception):
        sinks.reload(spark.range(5).selectExpr("id", "raise_error('lost')"), path)
    versions.stage(spark.range(7), path)  # the writer went before its commit
    versions.put_text(spark, f"{path}/{versions.MANIFESTS}/000000000002.json", '{"folder": "data-')  # or during it
    assert sinks.read(spark, path).count() == 10
    assert versions.vacuum(spark, path) and sinks.read(spark, path).count() == 10
    assert sinks.reload(spark.range(4), path) == 4 and sinks.read(spark, path).count() == 4


def test_late_writer_is_told(spark, tmp_path):
    path = f"{tmp_path}/v"
    sinks.reload(spark.range(1), path)
    versions.put_text(spark, f"{path}/{versions.MANIFESTS}/000000000002.json", "{}")
    with pytest.raises(Exception):
        versions.put_text(spark, f"{path}/{versions.MANIFESTS}/000000000002.json", "{}")


def test_range_replace_touches_its_months_only(spark, tmp_path):
    path = f"{tmp_path}/m"
    rows = [(day(f"2024-{m:02}-{d:02}"), m) for m in (1, 2, 3, 4) for d in (5, 20)] + [(None, 9)]
    sinks.write_months(frame(spark, rows), path, "d")
    before = part_files(path)
    new = [(day("2024-02-10"), 20), (day("2024-04-20"), 40), (day("2024-02-06"), 99)]
    assert sinks.replace_from(frame(spark, new), path, "d", day("2024-02-10")) == 3
    want = [("2024-01-05", 1), ("2024-01-20", 1), ("2024-02-05", 2), ("2024-02-10", 20), ("2024-04-20", 40), ("None", 9)]
    for _ in range(2):
        assert values(spark, path) == want and sinks.read(spark, path).columns == ["d", "v"]
        kept = {f for f in before if "2024-01" in f or "HIVE" in f}
        assert kept and kept < part_files(path) and not (before - kept) & part_files(path)
        sinks.replace_from(frame(spark, new), path, "d", day("2024-02-10"))
    sinks.replace_from(frame(spark, []), path, "d", day("2024-01-20"))
    assert values(spark, path) == [("2024-01-05", 1), ("None", 9)]


def test_failed_stage_is_recorded_and_the_rerun_skips_what_is_done(spark, tmp_path):
    ran, broken = [], [True]

    def one(notes):
        ran.append("one")
        return Outcome(5, 1, {"x": 7})

    def two(notes):
        ran.append("two")
        if broken:
            raise OSError("disk is full")
        return Outcome(notes["one"]["x"])

    ledger = Ledger(spark, str(tmp_path), "p", "night")
    with pytest.raises(OSError):
        ledger.run_all([("one", one), ("two", two)])
    broken.clear()
    assert Ledger(spark, str(tmp_path), "p", "night").run_all([("one", one), ("two", two)]) == {"one": {"x": 7}, "two": {}}
    assert ran == ["one", "two", "two"]
    log = spark.read.parquet(f"{tmp_path}/etl_audit_log").orderBy("completed_at").collect()
    assert [(r["stage"], r["status"], r["records_processed"], r["records_failed"], r["error_message"]) for r in log] == [
        ("one", "success", 5, 1, None), ("two", "failed", 0, 0, "OSError: disk is full"), ("two", "success", 7, 0, None),
    ]
    versions.delete(spark, f"{tmp_path}/_runs/night/two.json")
    versions.put_text(spark, f"{tmp_path}/_runs/night/two.json", "{")  # stopped while it was written
    assert ledger.finished("two") is None


def test_malformed_csv_lines_are_set_aside(spark, raw, cleaned, tmp_path):
    folder, out = f"{tmp_path}/csv", f"{tmp_path}/out"
    for name in SOURCE_TABLES:
        columns = [c if c in raw[name].columns else f"cast(null as string) as {c}" for c in RAW[name].fieldNames()]
        sinks.write(raw[name].selectExpr(*columns), f"{folder}/{name}.csv", "csv")
    bad = ["P9,no price,c,s,cheap,2,1,true", "P8,too,few", "P7,x,c,s,1,2,1,true,and,more"]
    with open(f"{folder}/products.csv/more.csv", "w") as more:
        more.write("\n".join(["product_id,product_name,category,subcategory,unit_cost,selling_price,weight_kg,is_active", *bad]) + "\n")
    source = files.extract_checked(spark, folder)
    counts = flow.load_tables(spark, source, out, run="first")
    assert counts == {name: cleaned[name].count() for name in SOURCE_TABLES}
    aside = flow.rejected_rows(spark, source, out, "first")
    assert sorted(r["_corrupt"] for r in aside["products"].collect()) == sorted(bad)
    assert all(df.count() == 0 for name, df in aside.items() if name != "products")
    log = {r["stage"]: r for r in spark.read.parquet(f"{out}/etl_audit_log").collect()}
    assert log["extract"]["records_failed"] == 3 and log["load"]["records_processed"] == sum(counts.values())
    assert flow.load_tables(spark, {}, out, run="first") == counts  # all is done


def test_steps_read_the_source_once(spark, raw):
    steps = clean.Steps()
    df = clean.clean_orders(raw["orders"], steps)
    assert df._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    df.write.format("noop").mode("overwrite").save()
    assert steps.rows()["read"] == raw["orders"].count() and steps.rows()["complete"] == df.count()


def rows_scanned(df):
    """Rows that the scans of a plan gave out when it ran, before any filter."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    nodes = [plan]
    while nodes:
        node = nodes.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def test_lookup_skips_what_cannot_hold_the_value(spark, tmp_path):
    rows = spark.range(200_000).selectExpr("concat('P', lpad(string(id * 7919 % 20000), 6, '0')) AS product_id", "id AS v")
    path = f"{tmp_path}/t"
    assert sinks.write(rows, path, lookup=("product_id",)) == 200_000
    found = spark.read.parquet(path).filter("product_id = 'P001234'")
    assert found.count() == 10 and rows_scanned(found) <= 0.25 * 200_000
    assert rows_scanned(spark.read.parquet(path).filter("product_id = 'P0012345'")) == 0  # inside the ranges; the bloom filter tells


def test_bucketed_orders_and_shipments_join_without_a_shuffle(spark, tmp_path):
    t = StarTables(spark, "/root/testdata/sf0.001")
    stored = buckets.by_order(t, spark, str(tmp_path), "test_join", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = stored.logistics("order_id", "is_delayed").filter("is_delayed").join(stored.orders("order_id", "product_id"), "order_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        want = t.logistics("order_id", "is_delayed").filter("is_delayed").join(t.orders("order_id", "product_id"), "order_id")
        assert joined.count() == want.count() > 0
        again = buckets.declare(spark, "test_again", f"{tmp_path}/orders_by_order", spark.table("test_join_orders")._jdf.schema().toDDL(), "order_id", 4)
        assert "Exchange" not in again.groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    late, same = logistics.delayed(stored), logistics.delayed(t)
    assert sorted(map(str, late.collect())) == sorted(map(str, same.collect()))
    assert buckets.buckets_for(10) == 8 and buckets.buckets_for(10**10) == 4096


def test_new_month_updates_its_sums_only(spark, tmp_path):
    def demand(rows):
        return SupplyTables({"demand_history": spark.createDataFrame(rows, "product_id string, warehouse_id string, demand_date date, demand_quantity int")})

    path = f"{tmp_path}/pair_months"
    rows = [("p", "w", day(f"2024-0{m}-{d:02}"), m * d) for m in (1, 2, 3) for d in (1, 9)] + [("p", None, day("2024-01-05"), None)]
    summaries.refresh(demand(rows), path)
    before = part_files(path)
    rows += [("p", "w", day("2024-03-20"), 100), ("q", "w", day("2024-04-02"), 7)]
    summaries.refresh(demand(rows), path, day("2024-03-15"))
    stored = SupplyTables({"pair_months": sinks.read(spark, path)})
    kept = {f for f in before if "2024-03" not in f}
    assert kept < part_files(path)
    key = lambda df: sorted(map(str, df.select("product_id", "warehouse_id", "avg_daily_demand", "total_demand").collect()))
    assert key(optimize.demand_stats(stored)) == key(optimize.demand_stats(demand(rows)))
    assert "month=2024-04" in str(part_files(path)) and stored.pair_months().count() == 5


def test_planning_reads_the_line_items_once(spark):
    t = StarTables(spark, "/root/testdata/sf0.001")
    once = t.summarised()
    for name, plain in (("demand", optimize.demand_stats(t)), ("stock", optimize.supply_terms(t))):
        shared = optimize.demand_stats(once) if name == "demand" else optimize.supply_terms(once)
        assert not any("lineitem" in f for f in shared.inputFiles())
        assert sorted(map(str, shared.collect())) == sorted(map(str, plain.collect()))


def test_extract_holds_both_files_open(spark, tmp_path, monkeypatch):
    rows = spark.range(1000).selectExpr("id", "IF(id % 10 = 0, 'bad', NULL) AS _corrupt").coalesce(1)
    seen = []  # the setting as the write finds it
    writer = type(rows.write)
    monkeypatch.setattr(writer, "parquet", lambda w, p, f=writer.parquet: seen.append(spark.conf.get(flow.WRITERS)) or f(w, p))
    counts = flow._extract_table(rows, f"{tmp_path}/t")
    assert seen == ["2"]
    assert counts == {"good": 900, "bad": 100}
    good = spark.read.parquet(f"{tmp_path}/t").filter("NOT rejected")
    assert [r.id for r in good.coalesce(1).collect()] == [i for i in range(1000) if i % 10]
    assert spark.conf.get(flow.WRITERS) == "0"


def listed(df):
    return sorted(map(str, df.collect()))


def test_gathered_lines_give_the_same_tables(spark):
    t = StarTables(spark, "/root/testdata/sf0.001")
    for once in (t.gathered(), t.gathered().summarised()):
        for name in ("orders", "logistics", "inventory", "demand_history"):
            assert not any("lineitem" in f for f in once.frame(name).inputFiles())
            assert listed(once.frame(name)) == listed(t.frame(name))
        assert listed(optimize.demand_stats(once)) == listed(optimize.demand_stats(t))
        assert listed(once.primary_suppliers()) == listed(t.primary_suppliers())


def cleared(monkeypatch):
    """A list that grows by one each time the line items are cleared of repeats."""
    calls, lines = [], StarTables.lines
    monkeypatch.setattr(StarTables, "lines", lambda t: calls.append(1) or lines(t))
    return calls


def test_output_checks_clear_the_line_items_once(spark, monkeypatch):
    calls = cleared(monkeypatch)
    registry._outputs(StarTables(spark, "/root/testdata/sf0.001"))
    assert len(calls) == 1


def test_snapshots_clear_the_line_items_once(spark, monkeypatch):
    calls = cleared(monkeypatch)
    assert registry._sink_snapshot(StarTables(spark, "/root/testdata/sf0.001")).count() > 0
    assert len(calls) == 1


def test_compressed_csv_files_hold_all_rows_in_small_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "FILE_ROWS", 10)
    rows = spark.range(35).selectExpr("concat('P', id) AS product_id", "IF(id = 7, 'x,\"y\"', '') AS supplier_id", "'1.50' AS unit_cost", "'true' AS is_primary")
    for codec, ending in (("gzip", "gz"), ("lz4", "lz4")):
        sinks.write_all({"product_suppliers.csv": rows.coalesce(1)}, f"{tmp_path}/{codec}", "csv", codec=codec)
        assert len(glob.glob(f"{tmp_path}/{codec}/product_suppliers.csv/*.csv.{ending}")) == 4
        back = files.read_csv_checked(spark, f"{tmp_path}/{codec}", "product_suppliers").collect()
        assert sorted(r.product_id for r in back) == sorted(f"P{i}" for i in range(35))
        assert [r.product_id for r in back if r.supplier_id == 'x,"y"'] == ["P7"] and not any(r._corrupt for r in back)


def test_csv_input_of_a_load_is_compressed(spark):
    folder = registry._csv_folder(StarTables(spark, "/root/testdata/sf0.001"))
    for name in SOURCE_TABLES:
        assert glob.glob(f"{folder}/{name}.csv/*.csv.lz4") and not glob.glob(f"{folder}/{name}.csv/*.csv")


def test_feed_lines_give_the_same_feeds_and_are_looked_up_once(spark, monkeypatch):
    t = StarTables(spark, "/root/testdata/sf0.001")
    once = t.with_feed_lines()
    for name in ("orders", "logistics", "demand_history"):
        assert not any("lineitem" in f for f in feeds.frame(once, name).inputFiles())
        assert listed(feeds.frame(once, name)) == listed(feeds.frame(t, name))
    calls, look = [], StarTables._looked_up
    monkeypatch.setattr(StarTables, "_looked_up", lambda t, *a: calls.append(1) or look(t, *a))
    monkeypatch.setattr(sinks, "write_all", lambda frames, *a, **b: frames)
    registry._csv_folder(t)
    assert len(calls) == 1


def test_tables_of_a_load_are_extracted_and_cleaned_side_by_side(spark, raw, tmp_path, monkeypatch):
    met = {"extract": threading.Barrier(2), "transform": threading.Barrier(2)}
    extract, stage = flow._extract_table, versions.stage

    def meets(name, first, f):  # the first two tables of a stage wait for each other
        def work(*args):
            if args[1].rsplit("/", 1)[-1] in first:
                met[name].wait(60)
            return f(*args)

        return work

    monkeypatch.setattr(flow, "_extract_table", meets("extract", SOURCE_TABLES[:2], extract))
    monkeypatch.setattr(versions, "stage", meets("transform", SOURCE_TABLES[:2], stage))
    loaded = flow.load_tables(spark, raw, str(tmp_path))
    assert list(loaded) == list(SOURCE_TABLES) and spark.conf.get(flow.WRITERS) == "0"
    assert loaded == {name: sinks.read(spark, f"{tmp_path}/{name}").count() for name in SOURCE_TABLES}


def test_full_run_looks_its_lines_up_once_and_writes_snapshots_side_by_side(spark, monkeypatch, tmp_path):
    calls, look = [], StarTables._looked_up
    with monkeypatch.context() as m:
        m.setattr(StarTables, "_looked_up", lambda t, *a: calls.append(1) or look(t, *a))
        m.setattr(flow, "run_all", lambda spark, raw, folder: raw)
        m.setattr(registry, "counts", lambda raw: raw)
        raw = registry._pipe_full(StarTables(spark, "/root/testdata/sf0.001"))
        assert len(calls) == 1 and list(raw) == list(feeds.FEEDS)

    met, replace = threading.Barrier(2), sinks.replace_day

    def meets(df, path, *args):  # the first two snapshots wait for each other
        if path.endswith(("kpi_inventory", "kpi_supplier")):
            met.wait(60)
        return replace(df, path, *args)

    monkeypatch.setattr(sinks, "replace_day", meets)
    t = StarTables(spark, "/root/testdata/sf0.001")
    names = ("kpi_inventory", "kpi_supplier", "kpi_logistics", "kpi_service", "kpi_executive")
    rows = flow.run_kpis(t, str(tmp_path), t.latest_day().first()["day"])
    assert rows == sum(spark.read.parquet(f"{tmp_path}/{name}").count() for name in names)
