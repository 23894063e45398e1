"""Data-quality checks: keys, required columns, bounds, references and date order.

Each check is one aggregate with map-side combining (or one anti join per reference) and returns
one row per rule, so the report's size does not depend on the data.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewharf.functions.numbers import row_count
from tidewharf.schemas import BOUNDS, RAW, REFERENCES, REQUIRED, TABLE_KEYS

Frames = Callable[..., DataFrame]  # frame(name, *columns)


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(row_count().alias("row_count")).filter("row_count > 1")


def unique_report(frame: Frames, tables: list[str]) -> DataFrame:
    parts = []
    for table in tables:
        keys = TABLE_KEYS[table]
        twice = duplicate_keys(frame(table, *keys), keys)
        parts.append(twice.agg(
            F.lit(table).alias("table_name"),
            F.lit(", ".join(keys)).alias("key_columns"),
            row_count().alias("duplicated_keys"),
            F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).alias("surplus_rows"),
        ))
    return _stack(parts)


def not_null_report(frame: Frames, tables: list[str]) -> DataFrame:
    """Nulls per required column, one pass per table."""
    parts = []
    for table in tables:
        columns = REQUIRED[table]
        counts = frame(table, *columns).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        long = counts.unpivot([], columns, "column_name", "null_rows")
        parts.append(long.select(F.lit(table).alias("table_name"), "column_name", "null_rows"))
    return _stack(parts)


def bounds_report(frame: Frames, tables: list[str]) -> DataFrame:
    """Rows that break a bound; a null satisfies a CHECK, as in SQL."""
    parts = []
    for table in tables:
        rules = [(name, predicate) for owner, name, predicate in BOUNDS if owner == table]
        if not rules:
            continue
        columns = [c for c in RAW[table].fieldNames() if any(re.search(rf"\b{c}\b", p) for _, p in rules)]
        counts = frame(table, *columns).agg(*[
            F.count_if(~F.coalesce(F.expr(predicate), F.lit(True))).alias(name) for name, predicate in rules
        ])
        long = counts.unpivot([], [name for name, _ in rules], "check_name", "failed_rows")
        parts.append(long.select(F.lit(table).alias("table_name"), "check_name", "failed_rows"))
    return _stack(parts)


def _keyed(df: DataFrame, links: list[tuple[str, str]]) -> DataFrame:
    """(link, key) rows: each row of ``df`` once per named link, with the link's column as text."""
    pairs = [F.struct(F.lit(name).alias("link"), F.col(column).cast("string").alias("key")) for name, column in links]
    return df.select(F.inline(F.array(*pairs))).filter(F.col("key").isNotNull())


def reference_report(
    frame: Frames, tables: list[str], parents: Frames | None = None, children: list[str] | None = None
) -> DataFrame:
    """Child rows whose key has no parent; a null key refers to nothing and passes.

    ``parents`` supplies the parent tables when they differ, such as cleaned parents for raw children.
    ``children`` limits the tables that are checked. Each child and each parent is asked for once: its keys become (reference, key) rows, counted per key before a single
    anti join, so a key held by very many rows is one row there.
    """
    parents = parents or frame
    links = [
        (f"{c}.{k}", c, k, p, pk) for c, k, p, pk in REFERENCES
        if c in (children or tables) and p in tables
    ]

    def keys(source: Frames, table: str, own: list[tuple[str, str]]) -> DataFrame:
        return _keyed(source(table, *dict.fromkeys(column for _, column in own)), own)

    referring = _stack([
        keys(frame, table, [(link, k) for link, c, k, _, _ in links if c == table])
        for table in dict.fromkeys(c for _, c, _, _, _ in links)
    ])
    known = _stack([
        keys(parents, table, [(link, pk) for link, _, _, p, pk in links if p == table])
        for table in dict.fromkeys(p for _, _, _, p, _ in links)
    ])
    used = referring.groupBy("link", "key").agg(row_count().alias("_rows"))
    orphans = used.join(known, ["link", "key"], "left_anti").groupBy("link").agg(F.sum("_rows").alias("_rows"))
    names = frame_of_links(orphans.sparkSession, links)
    return names.join(orphans, "link", "left").select(
        "child_table", "child_column", "parent_table", F.coalesce("_rows", F.lit(0)).alias("orphan_rows")
    )


def output_report(frame: Frames, tables: list[str], parents: Frames) -> DataFrame:
    """Required columns, keys and references of result tables: (table_name, check_name, column_name, failed_rows).

    ``frame`` should give stored tables, as each is read once for every kind of check; ``parents`` gives the source tables.
    """
    nulls = not_null_report(frame, tables).select(
        "table_name", F.lit("not_null").alias("check_name"), "column_name", F.col("null_rows").alias("failed_rows")
    )
    keyed = [table for table in tables if table in TABLE_KEYS]
    twice = unique_report(frame, keyed).select(
        "table_name", F.lit("unique").alias("check_name"), F.col("key_columns").alias("column_name"), F.col("surplus_rows").alias("failed_rows")
    )
    owners = list(dict.fromkeys(p for c, _, p, _ in REFERENCES if c in tables and p not in tables))
    links = reference_report(frame, [*tables, *owners], parents, children=tables).select(
        F.col("child_table").alias("table_name"), F.lit("reference").alias("check_name"), F.col("child_column").alias("column_name"),
        F.col("orphan_rows").alias("failed_rows"),
    )
    return nulls.unionByName(twice).unionByName(links)


def frame_of_links(spark: SparkSession, links: list[tuple]) -> DataFrame:
    """The checked references themselves, so that those without orphans are reported too."""
    rows = [(link, c, k, p) for link, c, k, p, _ in links]
    return spark.createDataFrame(rows, "link string, child_table string, child_column string, parent_table string")


def date_report(orders: DataFrame, inventory: DataFrame) -> DataFrame:
    """Deliveries before their order, and negative reorder points or safety stocks."""
    late = orders.agg(
        F.count_if(F.col("delivery_date") < F.col("order_date")).alias("delivery_before_order")
    ).unpivot([], ["delivery_before_order"], "check_name", "failed_rows")
    stock = inventory.agg(
        F.count_if(F.col("reorder_point") < 0).alias("negative_reorder_point"),
        F.count_if(F.col("safety_stock") < 0).alias("negative_safety_stock"),
    ).unpivot([], ["negative_reorder_point", "negative_safety_stock"], "check_name", "failed_rows")
    return late.unionByName(stock)
