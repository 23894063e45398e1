"""Runs that write: loading cleaned tables, and the whole sequence from raw tables to reports.

Each stage writes its result and the next reads what was written. Shared work is done once, a lost
executor costs at most the running stage, and no result has to stay cached. Stages are recorded in a
ledger: a run with the name of one that was stopped skips what that one has finished.
"""

from __future__ import annotations

import contextlib
import datetime
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewharf.functions.parallel import AT_ONCE, together
from tidewharf.operators import (
    clean, forecast, insights, inventory, kpi, logistics, optimize, reporting, summaries, suppliers,
)
from tidewharf.plans.ledger import AUDIT, Ledger, Outcome
from tidewharf.schemas import SOURCE_TABLES
from tidewharf.sources import sinks, versions
from tidewharf.sources.files import CORRUPT
from tidewharf.sources.tables import SupplyTables, stored_tables

PIPELINE = "supply_chain_etl"
REJECTED = "rejected"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"

# Rows of a file are kept in date order, so a date filter skips most of each file's row groups.
DATE_ORDER = {"orders": "order_date", "logistics": "ship_date", "demand_history": "demand_date"}

Stage = tuple[str, Callable[[dict], Outcome]]


def extracted_path(folder: str, run: str, name: str) -> str:
    return f"{folder}/_extract/{run}/{name}"


@contextlib.contextmanager
def _both_files_open(spark: SparkSession) -> Iterator[None]:
    """A block in which a task may hold two files open. Tables written at the same time share the setting, and so a block."""
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, "2")
    try:
        yield
    finally:
        spark.conf.set(WRITERS, before)


def _extract_table(df: DataFrame, path: str) -> dict[str, int]:
    """One pass over a source: good rows and malformed ones into folders of their own, both counted.

    A task holds both files open, as it would otherwise sort its rows by the folder.
    """
    bad = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)
    seen = Observation()
    marked = df.withColumn(REJECTED, bad)
    marked = marked.observe(seen, F.count_if(~F.col(REJECTED)).alias("good"), F.count_if(F.col(REJECTED)).alias("bad"))
    with _both_files_open(df.sparkSession):
        marked.write.mode("overwrite").partitionBy(REJECTED).parquet(path)
    return {"good": seen.get["good"], "bad": seen.get["bad"]}


def _extracted(spark: SparkSession, df: DataFrame, path: str, rejected: bool) -> DataFrame:
    """The good or the malformed rows of a source that was extracted."""
    schema = T.StructType([*df.schema.fields, T.StructField(REJECTED, T.BooleanType())])
    return spark.read.schema(schema).parquet(path).filter(F.col(REJECTED) == rejected).drop(REJECTED)


def extracted_rows(spark: SparkSession, df: DataFrame, folder: str, run: str, name: str) -> DataFrame:
    return _extracted(spark, df, extracted_path(folder, run, name), False).drop(CORRUPT)


def rejected_rows(spark: SparkSession, raw: dict[str, DataFrame], folder: str, run: str) -> dict[str, DataFrame]:
    """The quarantine of a run by table: columns as far as they could be read, and the line in ``_corrupt``."""
    return {name: _extracted(spark, raw[name], extracted_path(folder, run, name), True) for name in SOURCE_TABLES}


def load_stages(spark: SparkSession, raw: dict[str, DataFrame], folder: str, run: str) -> list[Stage]:
    """Extract, transform, load. Tables change in the last stage only, by a small write for each.

    Tables that do not need each other are extracted and cleaned at the same time, a few at once.
    """

    def extract(notes: dict) -> Outcome:
        tasks = [lambda name=name: _extract_table(raw[name], extracted_path(folder, run, name)) for name in SOURCE_TABLES]
        with _both_files_open(spark):
            counts = dict(zip(SOURCE_TABLES, together(spark, *tasks, at_once=AT_ONCE)))
        good, bad = (sum(n[x] for n in counts.values()) for x in ("good", "bad"))
        return Outcome(good, bad, counts)

    def transform(notes: dict) -> Outcome:
        staged, rows = {}, {}

        def source(name: str) -> DataFrame:
            return extracted_rows(spark, raw[name], folder, run, name)

        def put(name: str, df: DataFrame) -> dict:
            df = sinks.project(df, name)
            if name in DATE_ORDER:
                df = df.sortWithinPartitions(DATE_ORDER[name])
            return versions.stage(df, f"{folder}/{name}")

        def cleaned(name: str) -> tuple[dict, dict]:
            steps = clean.Steps()
            return put(name, clean.CLEANERS[name](source(name), steps)), steps.rows()

        def back(name: str) -> DataFrame:
            return versions.read_version(spark, f"{folder}/{name}", staged[name])

        alone = [name for name in SOURCE_TABLES if name != "inventory"]
        done = together(spark, *[lambda name=name: cleaned(name) for name in alone], at_once=AT_ONCE)
        for name, (version, counts) in zip(alone, done):
            staged[name], rows[name] = version, counts
        steps = clean.Steps()
        valued = clean.with_inventory_value(clean.clean_inventory(source("inventory"), steps), back("products"))
        staged["inventory"] = put("inventory", clean.inventory_metrics(valued, back("orders")))
        rows["inventory"] = steps.rows()
        sinks.reload(clean.drop_report(spark, rows), f"{folder}/etl_drop_stats")
        kept = sum(n["complete"] for n in rows.values())
        return Outcome(kept, sum(n["read"] for n in rows.values()) - kept, {"staged": staged, "rows": rows})

    def load(notes: dict) -> Outcome:
        staged = notes["transform"]["staged"]
        counts = {name: versions.commit(spark, f"{folder}/{name}", staged[name]) for name in SOURCE_TABLES}
        summaries.refresh(stored_tables(spark, folder), f"{folder}/pair_months")
        for name in SOURCE_TABLES:  # the quarantine stays
            versions.delete(spark, f"{extracted_path(folder, run, name)}/{REJECTED}=false")
        return Outcome(sum(counts.values()), 0, counts)

    return [("extract", extract), ("transform", transform), ("load", load)]


def load_tables(spark: SparkSession, raw: dict[str, DataFrame], folder: str, run: str | None = None) -> dict[str, int]:
    """Extract, clean and replace the stored tables. Returns rows per table.

    Orders and products are written before the inventory figures are derived from them, so cleaning
    runs once per table. ``run`` names the run; one that was stopped goes on under the same name.
    """
    ledger = Ledger(spark, folder, PIPELINE, run)
    return ledger.run_all(load_stages(spark, raw, folder, ledger.name))["load"]


def counts_frame(spark: SparkSession, folder: str, names) -> DataFrame:
    """Rows per written table, read from the files."""
    parts = [
        sinks.read(spark, f"{folder}/{name}").agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows_loaded")
        )
        for name in names
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def run_kpis(t: SupplyTables, folder: str, day: datetime.date) -> int:
    """All KPI snapshots of one date; the executive one is last because it reads the supplier's."""
    frames = {name: sinks.project(frame(t, day), name) for name, frame in (
        ("kpi_inventory", kpi.inventory_kpis), ("kpi_supplier", kpi.supplier_kpis),
        ("kpi_logistics", kpi.logistics_kpis), ("kpi_service", kpi.service_kpis),
    )}
    spark = frames["kpi_supplier"].sparkSession
    tasks = [lambda name=name: sinks.replace_day(frames[name], f"{folder}/{name}", "calculation_date", day) for name in frames]
    rows = sum(together(spark, *tasks, at_once=AT_ONCE))
    stored = spark.read.parquet(f"{folder}/kpi_supplier").filter(F.col("calculation_date") == F.lit(day))
    executive = kpi.executive_kpis(t, day, suppliers=stored)
    return rows + sinks.replace_day(
        sinks.project(executive, "kpi_executive"), f"{folder}/kpi_executive", "calculation_date", day
    )


def analysis_stages(spark: SparkSession, folder: str, quick: bool = False) -> list[Stage]:
    """What follows a load: KPIs, alerts and scorecards, forecasts, recommendations, insights, the report."""

    def stored(name: str) -> DataFrame:
        return sinks.read(spark, f"{folder}/{name}")

    def day(notes: dict) -> datetime.date:
        return datetime.date.fromisoformat(notes["kpis"]["day"])

    def kpis(notes: dict) -> Outcome:
        t = stored_tables(spark, folder)
        newest = t.latest_day().first()["day"]  # one value
        return Outcome(run_kpis(t, folder, newest), 0, {"day": newest.isoformat()})

    def snapshots(notes: dict) -> Outcome:
        t = stored_tables(spark, folder)

        def snapshot(name: str, frame: Callable, column: str, key: str) -> int:
            df = sinks.project(frame(t, day(notes)), name)
            return sinks.replace_day(df, f"{folder}/{name}", column, day(notes), (key,))

        return Outcome(sum(together(
            spark,
            lambda: snapshot("inventory_alerts", inventory.alerts, "alert_date", "product_id"),
            lambda: snapshot("supplier_scorecards", suppliers.scorecards, "scorecard_date", "supplier_id"),
            lambda: sinks.write(logistics.recommendations(t), f"{folder}/logistics_recommendations"),
        )))

    def forecasts(notes: dict) -> Outcome:
        out = forecast.run(stored_tables(spark, folder), quick)
        sinks.write_metrics(out["metrics"], f"{folder}/forecast_metrics")
        df = sinks.project(out["forecasts"], "forecasts")
        return Outcome(sinks.replace_from(df, f"{folder}/forecasts", "forecast_date", day(notes), ("product_id",)))

    def recommendations(notes: dict) -> Outcome:
        df = optimize.recommendations(stored_tables(spark, folder), stored("forecasts"), day(notes))
        return Outcome(sinks.replace_day(
            sinks.project(df, "inventory_recommendations"), f"{folder}/inventory_recommendations", "recommendation_date",
            day(notes), ("product_id", "warehouse_id"),
        ))

    def findings(notes: dict) -> Outcome:
        found = insights.generate(stored_tables(spark, folder), stored("kpi_supplier"), stored("kpi_logistics"), day(notes))
        df = sinks.project(found.withColumn("is_acknowledged", F.lit(False)), "business_insights")
        return Outcome(sinks.replace_day(df, f"{folder}/business_insights", "insight_date", day(notes)))

    def report(notes: dict) -> Outcome:
        t = stored_tables(spark, folder)
        summary = reporting.executive_summary(t, stored("kpi_executive"), stored("business_insights"))
        return Outcome(sinks.write(reporting.executive_text(summary), f"{folder}/executive_summary"))

    return [
        ("kpis", kpis), ("snapshots", snapshots), ("forecasts", forecasts), ("recommendations", recommendations),
        ("insights", findings), ("report", report),
    ]


def run_all(
    spark: SparkSession, raw: dict[str, DataFrame], folder: str, quick: bool = False, run: str | None = None
) -> dict[str, DataFrame]:
    """Every stage in order; returns the written results as frames by name."""
    ledger = Ledger(spark, folder, PIPELINE, run)
    ledger.run_all(load_stages(spark, raw, folder, ledger.name) + analysis_stages(spark, folder, quick))
    names = [
        "kpi_inventory", "kpi_supplier", "kpi_logistics", "kpi_service", "kpi_executive", "inventory_alerts",
        "supplier_scorecards", "logistics_recommendations", "forecasts", "inventory_recommendations",
        "business_insights", "executive_summary", AUDIT,
    ]
    return {name: sinks.read(spark, f"{folder}/{name}") for name in (*SOURCE_TABLES, *names)}
