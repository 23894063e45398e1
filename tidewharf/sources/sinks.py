"""Writing tables: append, full reload, dated snapshots, range replacement, metrics and audit rows.

Nothing is overwritten while it is being read. A reload is a new version that one small file makes current
(``versions``); a range replacement rewrites the months it touches; a snapshot replaces only its own date's
directory, so running it again gives the same table and an empty result clears the date.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewharf.functions.parallel import AT_ONCE, together
from tidewharf.schemas import STORED
from tidewharf.sources import versions

MONTH = "__month"
FILE_ROWS = 2_000_000  # fixed value: most rows of a compressed CSV file, which one task has to read


def clustered(df: DataFrame, *keys: str) -> DataFrame:
    """Rows in ranges of the keys, sorted: a file and each part of it then hold few values of the first key.

    The ranges end with a hash of the row, so that a value held by very many rows is spread over several tasks.
    """
    return df.repartitionByRange(*keys, F.xxhash64(*df.columns)).sortWithinPartitions(*keys)


def write(
    df: DataFrame, path: str, kind: str = "parquet", mode: str = "overwrite", lookup: tuple[str, ...] = (), codec: str | None = None
) -> int:
    """Write and return the number of rows, counted by the write itself.

    ``lookup`` names columns that rows will be asked for by: the files are clustered by them and carry a bloom filter of
    each, so that a lookup skips files and row groups that cannot hold the value. ``codec`` compresses CSV files; such a
    file cannot be split, so its rows are limited.
    """
    counted, seen = versions.counted(clustered(df, *lookup) if lookup else df)
    writer = counted.write.mode(mode).format(kind)
    if kind == "csv":
        writer = writer.option("header", True)
        if codec:
            writer = writer.option("compression", codec).option("maxRecordsPerFile", FILE_ROWS)
    for column in lookup:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.save(path)
    return seen.get["rows"]


def append(df: DataFrame, path: str, kind: str = "parquet") -> int:
    return write(df, path, kind, mode="append")


def append_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 5000, **options: str) -> None:
    df.write.format("jdbc").mode("append").options(url=url, dbtable=table, batchsize=batch_size, **options).save()


def write_all(frames: dict[str, DataFrame], folder: str, kind: str = "parquet", codec: str | None = None) -> dict[str, int]:
    """One folder per table: parquet by default, CSV with a header on request. Some tables are written at the same time."""
    spark = next(iter(frames.values())).sparkSession
    tasks = [lambda name=name, df=df: write(df, f"{folder}/{name}", kind, codec=codec) for name, df in frames.items()]
    return dict(zip(frames, together(spark, *tasks, at_once=AT_ONCE)))


def reload(df: DataFrame, path: str) -> int:
    """Replace a whole table, even one that ``df`` reads from."""
    return versions.commit(df.sparkSession, path, versions.stage(df, path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """A stored table: its current version, or all files where it has no versions."""
    version = versions.current(spark, path)
    if version:
        return versions.read_version(spark, path, version)
    df = spark.read.parquet(path)
    return df.drop(*[c for c in df.columns if c.endswith(MONTH)])


def project(df: DataFrame, table: str | T.StructType) -> DataFrame:
    """Exactly the columns of the target table, in its types; helper columns are left behind.

    A missing column is an error, so that no incomplete table is written.
    """
    schema = STORED[table] if isinstance(table, str) else table
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} of the table are missing")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def replace_day(df: DataFrame, path: str, date_column: str, day: datetime.date, lookup: tuple[str, ...] = ()) -> int:
    """Replace the rows of one date."""
    rows = df.filter(F.col(date_column) == F.lit(day)).drop(date_column)
    return write(rows, f"{path}/{date_column}={day.isoformat()}", lookup=lookup)


def write_months(df: DataFrame, path: str, date_column: str, lookup: tuple[str, ...] = ()) -> int:
    """Write the months that ``df`` has rows of, each in place of what the table holds of it; other months stay as they are.

    A month's rows are brought together, so that each month has few files; ``lookup`` as in ``write``.
    """
    month = f"{date_column}{MONTH}"
    rows = clustered(df.withColumn(month, F.date_format(date_column, "yyyy-MM")), month, *lookup)
    counted, seen = versions.counted(rows)
    writer = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month)
    for column in lookup:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)
    return seen.get["rows"]


def replace_from(df: DataFrame, path: str, date_column: str, day: datetime.date, lookup: tuple[str, ...] = ()) -> int:
    """Replace all rows from ``day`` on with those of ``df``; earlier ones stay as they are. Returns the rows written.

    The table is partitioned by month. Only the months from ``day`` on are written: the first of them together with its
    rows before ``day``, and later ones that ``df`` has no rows of are cleared. Rows of ``df`` from before ``day`` are left
    out, so running it again gives the same table, also after an interruption.
    """
    spark, first = df.sparkSession, day.replace(day=1)
    df = df.filter(F.col(date_column) >= F.lit(day))
    folders = [x for x in versions.names(spark, path) if x.startswith(f"{date_column}{MONTH}=")]
    later = [x for x in folders if x.split("=")[1] >= f"{first:%Y-%m}" and not x.endswith("__")]  # not the one of null dates
    before = {x: versions.names(spark, f"{path}/{x}") for x in later}
    if f"{date_column}{MONTH}={first:%Y-%m}" in later:
        own = spark.read.parquet(path).filter(F.col(f"{date_column}{MONTH}") == f"{first:%Y-%m}")
        df = own.filter(F.col(date_column) < F.lit(day)).drop(f"{date_column}{MONTH}").unionByName(df)
    rows = write_months(df, path, date_column, lookup)
    for folder, old in before.items():  # a month that was written anew has other files
        if old and versions.names(spark, f"{path}/{folder}") == old:
            versions.delete(spark, f"{path}/{folder}")
    return rows


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Model errors as JSON lines, one model per line."""
    metrics.write.mode("overwrite").json(path)


def audit(
    spark: SparkSession, path: str, pipeline: str, stage: str, processed: int, failed: int, status: str,
    started: datetime.datetime, completed: datetime.datetime, error: str | None = None,
) -> None:
    """Append one row about a finished stage."""
    seconds = round((completed - started).total_seconds(), 2)
    values = (pipeline, stage, processed, failed, status, error, started, completed)
    row = spark.createDataFrame([values], T.StructType(STORED["etl_audit_log"].fields[:-1]))
    append(row.withColumn("duration_seconds", F.lit(seconds).cast("decimal(10,2)")), path)
