"""Tables stored in buckets of a key, so that joins and sums on the key need no shuffle.

Tables that are joined on a key again and again are hashed by it once, when they are written, into the same number of
buckets. Spark keeps a bucketed table's layout in its catalog; a session that did not write the table declares it over the
files that are there.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

from tidewharf.sources.tables import SupplyTables

ROWS_IN_A_BUCKET = 4_000_000


def buckets_for(rows: int, least: int = 8) -> int:
    """A power of two, so that tables of different sizes can still be read together."""
    return 1 << math.ceil(math.log2(max(rows / ROWS_IN_A_BUCKET, least)))


def store(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` to ``path`` and return it as the bucketed table ``name``; a file for each bucket."""
    whole = df.repartition(buckets, key)
    whole.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def declare(spark: SparkSession, name: str, path: str, schema: str, key: str, buckets: int) -> DataFrame:
    """The bucketed table at ``path`` under ``name``, written by another session."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def by_order(t: SupplyTables, spark: SparkSession, folder: str, prefix: str, buckets: int) -> SupplyTables:
    """``t`` with orders and shipments stored in buckets of the order id."""
    frames = {
        name: store(t.frame(name), f"{prefix}_{name}", f"{folder}/{name}_by_order", "order_id", buckets)
        for name in ("orders", "logistics")
    }
    frames["warehouses"] = t.warehouses()
    return SupplyTables(frames)
