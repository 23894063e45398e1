"""Ranks, row numbers and running totals over groups too large for one task.

A window without partitions, or with a handful of them, sorts each group in a single task. These
helpers range-partition the rows by the sort key instead, as a global sort does, and store them with the
number of their range ("slice"). Slice totals give each slice its starting offset, and an ordinary window
then works inside (group, slice). Spark sets the number of ranges, so it grows with the cluster and the
data. The ranges only balance the work; the numbers are exact wherever they end. Equal values are merged
before slicing, so one value held by a third of all rows is one row here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewharf.functions.scratch import materialized


def _with_slice(df: DataFrame, key: Column, slices: int | None) -> DataFrame:
    """``df`` stored with ``_key`` and ``_slice``, the number of the key's range; later ranges have larger keys.

    ``slices`` sets the number of ranges; by default it is the session's number of shuffle partitions,
    less what adaptive execution merges.
    """
    keyed = df.withColumn("_key", key)
    ranged = keyed.repartitionByRange(slices, "_key") if slices else keyed.repartitionByRange("_key")
    return materialized(ranged.withColumn("_slice", F.spark_partition_id()))


def _match(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """Left join on ``names`` with nulls equal to each other, keeping the left side's columns."""
    renamed = right.select(*[F.col(n).alias(f"_r_{n}") if n in names else F.col(n) for n in right.columns])
    condition = [F.col(n).eqNullSafe(F.col(f"_r_{n}")) for n in names]
    return left.join(renamed, condition, "left").drop(*[f"_r_{n}" for n in names])


def value_steps(
    df: DataFrame,
    value: str,
    *,
    by: Sequence[str] = (),
    weight: str | None = None,
    descending: bool = True,
    slices: int | None = None,
) -> DataFrame:
    """One row per distinct (by, value) with everything a rank over that order needs.

    Columns: ``peers`` rows holding the value, ``rank``, ``dense_rank``, ``rows_total`` in the group,
    and with ``weight`` also ``running`` (sum up to and including peers) and ``grand_total``.
    """
    by = list(by)
    sums = [F.sum(weight).alias("_w")] if weight else []
    steps = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("peers"), *sums)
    steps = _with_slice(steps, F.struct(F.col(value)), slices)

    slice_order = F.col("_slice").desc() if descending else F.col("_slice").asc()
    value_order = F.col(value).desc() if descending else F.col(value).asc()
    slice_sums = [F.sum("_w").alias("_sw")] if weight else []
    totals = steps.groupBy(*by, "_slice").agg(
        F.sum("peers").alias("_sp"), F.count(F.lit(1)).alias("_sd"), *slice_sums
    )
    # One row for each slice and group reaches this window.
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    before = group.orderBy(slice_order).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "_slice",
        F.coalesce(F.sum("_sp").over(before), F.lit(0)).alias("_op"),
        F.coalesce(F.sum("_sd").over(before), F.lit(0)).alias("_od"),
        F.sum("_sp").over(group).alias("rows_total"),
        *(
            [F.sum("_sw").over(before).alias("_ow"), F.sum("_sw").over(group).alias("grand_total")]
            if weight
            else []
        ),
    )

    local = W.partitionBy(*by, "_slice").orderBy(value_order)
    earlier = local.rowsBetween(W.unboundedPreceding, -1)
    upto = local.rowsBetween(W.unboundedPreceding, 0)
    joined = _match(steps, offsets, [*by, "_slice"])
    out = joined.select(
        *by,
        value,
        "peers",
        (F.col("_op") + F.coalesce(F.sum("peers").over(earlier), F.lit(0)) + 1).alias("rank"),
        (F.col("_od") + F.row_number().over(local)).alias("dense_rank"),
        "rows_total",
        *(
            [
                (F.coalesce("_ow", F.lit(0)) + F.sum("_w").over(upto)).alias("running"),
                "grand_total",
            ]
            if weight
            else []
        ),
    )
    return out


def with_ranks(
    df: DataFrame,
    value: str,
    *,
    by: Sequence[str] = (),
    weight: str | None = None,
    descending: bool = True,
    slices: int | None = None,
    stored: bool = False,
    **names: str,
) -> DataFrame:
    """``df`` with rank-like columns of ``value`` added; ``names`` maps new column -> step column."""
    df = df if stored else materialized(df)
    steps = value_steps(
        df, value, by=by, weight=weight, descending=descending, slices=slices
    )
    wanted = steps.select(*by, value, *[F.col(step).alias(new) for new, step in names.items()])
    return _match(df, wanted, [*by, value])


def with_position(
    df: DataFrame, name: str, keys: Sequence[Column], *, by: Sequence[str] = (), slices: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """``df`` with its 1-based position in the ascending order of ``keys`` within ``by``.

    ``keys`` must be a total order (end with a unique id). Negate a number for descending order.
    """
    by = list(by)
    df = df if stored else materialized(df)
    sliced = _with_slice(df, F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]), slices)
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    before = group.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*by, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*by, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    )
    local = W.partitionBy(*by, "_slice").orderBy("_key")
    joined = _match(sliced, offsets, [*by, "_slice"])
    return joined.withColumn(name, F.col("_o") + F.row_number().over(local)).drop("_o", "_slice", "_key")


def percent_rank(rank: Column, rows: Column) -> Column:
    """(rank - 1) / (rows - 1), zero for a single row."""
    return F.when(rows > 1, (rank - 1).cast("double") / (rows - 1).cast("double")).otherwise(F.lit(0.0))
