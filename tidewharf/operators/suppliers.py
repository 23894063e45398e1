"""Supplier analysis and scorecards."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewharf.functions import text
from tidewharf.functions.numbers import half_even, half_up, mean, row_count
from tidewharf.functions.ranking import percent_rank, with_position, with_ranks
from tidewharf.functions.rules import grade
from tidewharf.functions.scratch import materialized
from tidewharf.operators.kpi import as_stored
from tidewharf.operators.views import supplier_performance
from tidewharf.sources.tables import SupplyTables

Day = datetime.date | None


def performance(t: SupplyTables) -> DataFrame:
    return supplier_performance(t).orderBy(F.desc("on_time_pct"), "supplier_id")


def delayed(t: SupplyTables, delay_threshold_pct: float = 15) -> DataFrame:
    df = supplier_performance(t).withColumn("delay_rate", 100 - F.coalesce("on_time_pct", F.lit(0.0)))
    return df.filter(F.col("delay_rate") >= delay_threshold_pct).orderBy(F.desc("delay_rate"), "supplier_id")


def scorecards(t: SupplyTables, as_of: Day = None) -> DataFrame:
    """Grade and position per supplier.

    Every order counts, so one still under way lowers the on-time share: grades are strict on purpose.
    Equal shares are placed in supplier order.
    """
    df = supplier_performance(t)
    score = F.coalesce(F.col("on_time_pct"), F.col("reliability_score").cast("double"))
    df = with_position(df, "rank_position", [-F.col("on_time_pct"), F.col("supplier_id")])
    return df.select(
        t.day(as_of).alias("scorecard_date"),
        "supplier_id",
        "reliability_score",
        F.coalesce(F.col("avg_actual_lead_time"), F.col("contracted_lead_time").cast("double")).alias("avg_lead_time"),
        half_even(score, 2).alias("on_time_pct"),
        "defect_rate",
        grade(score).alias("overall_grade"),
        "rank_position",
    )


def latest_scorecards(cards: DataFrame) -> DataFrame:
    """The newest scorecard of each supplier."""
    values = F.struct(*[c for c in cards.columns if c != "supplier_id"])
    newest = cards.groupBy("supplier_id").agg(F.max_by(values, "scorecard_date").alias("_card"))
    return newest.select("supplier_id", "_card.*")


def scorecard_text(t: SupplyTables, cards: DataFrame | None = None, supplier_id=None) -> DataFrame:
    """A text block per supplier, or a note for one that has no scorecard."""
    cards = latest_scorecards(as_stored(scorecards(t) if cards is None else cards, "supplier_scorecards"))
    names = t.suppliers("supplier_id", "supplier_name")
    if supplier_id is not None:
        names = names.filter(F.col("supplier_id") == supplier_id)
    df = names.join(cards, "supplier_id", "left")
    block = text.sentence(
        text.SCORECARD,
        reliability_score=F.col("reliability_score").cast("double"),
        defect_pct=F.col("defect_rate").cast("double") * 100,
    )
    missing = F.col("scorecard_date").isNull()
    note = text.sentence(text.NO_SCORECARD)
    return df.select("supplier_id", F.when(missing, note).otherwise(block).alias("scorecard"))


def ranking(t: SupplyTables, top_n: int = 20) -> DataFrame:
    return performance(t).limit(top_n)


def summary(t: SupplyTables, delay_threshold_pct: float = 15) -> DataFrame:
    best = F.struct(-F.col("on_time_pct"), F.col("supplier_id"))
    late = 100 - F.coalesce("on_time_pct", F.lit(0.0)) >= delay_threshold_pct
    return supplier_performance(t).agg(
        row_count().alias("total_suppliers"),
        half_up(F.avg("on_time_pct"), 6).alias("avg_on_time_pct"),
        half_up(F.avg("avg_actual_lead_time"), 6).alias("avg_lead_time"),
        F.count_if(late).alias("high_risk_suppliers"),
        F.min_by("supplier_name", best).alias("top_supplier"),
        F.max_by("supplier_name", best).alias("worst_supplier"),
    )


def analyze(t: SupplyTables, as_of: Day = None) -> dict[str, DataFrame]:
    return {
        "summary": summary(t),
        "scorecards": scorecards(t, as_of),
        "top_suppliers": ranking(t, 10),
        "delayed_suppliers": delayed(t).limit(10),
    }


def scorecard_ranking(t: SupplyTables, cards: DataFrame) -> DataFrame:
    """The newest scorecard run, each supplier against the others (query 40)."""
    cards = materialized(as_stored(cards, "supplier_scorecards"))
    newest = cards.select(F.max("scorecard_date")).scalar()
    run = cards.filter(F.col("scorecard_date") == newest).join(
        t.suppliers("supplier_id", "supplier_name"), "supplier_id"
    )
    average = run.select(mean(F.col("on_time_pct"))).scalar()
    run = with_ranks(run, "on_time_pct", stored=True, _rank="rank", _rows="rows_total")
    return run.select(
        "supplier_id", "supplier_name", "reliability_score", "on_time_pct", "overall_grade", "rank_position",
        percent_rank(F.col("_rank"), F.col("_rows")).alias("percentile"),
        (F.col("on_time_pct").cast("double") - average).alias("vs_avg"),
    ).orderBy("rank_position")
