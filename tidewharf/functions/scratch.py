"""Shared folders for intermediate tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a temporary folder; on a cluster each executor would write
    to its own disk, so there the setting is required.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        master = context.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tidewharf-")
        context.setCheckpointDir(folder)
    elif not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Temporary:
    """The folders that ``materialized`` has made in a ``temporary`` block."""

    def __init__(self):
        self.paths: dict[str, None] = {}
        self.kept: set[str] = set()

    def keep(self, *frames: DataFrame) -> DataFrame:
        """The results of ``materialized`` that are still read after the block; returns the first of them."""
        for df in frames:
            self.kept |= {path for path in self.paths if any(path.rsplit("/", 1)[-1] in name for name in df.inputFiles())}
        return frames[0]


_blocks: list[Temporary] = []


@contextlib.contextmanager
def temporary(spark: SparkSession) -> Iterator[Temporary]:
    """A block after which the tables that ``materialized`` has stored in it are deleted, but for those kept.

    For operators whose result rests on one or two small tables, so that what led to them need not fill the shared
    folder for as long as the session lives. If the block fails, all go.
    """
    made = Temporary()
    _blocks.append(made)
    try:
        yield made
    except BaseException:
        made.kept.clear()
        raise
    finally:
        _blocks.remove(made)
        for path in made.paths:
            if path not in made.kept:
                location = spark._jvm.org.apache.hadoop.fs.Path(path)
                location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)
            elif _blocks:
                _blocks[-1].paths[path] = None


def materialized(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder, so later passes read it and survive lost executors.

    A parquet table rather than an RDD checkpoint: its size is known to the planner when it decides
    about broadcasting, and later passes read only the columns they use.
    """
    spark = df.sparkSession
    path = new_folder(spark, "step")
    if _blocks:
        _blocks[-1].paths[path] = None
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the input, as it goes to the join: both sides are dealt out by the key.

    Spark takes a stored table for as large as its compressed files and an exploded one for as large as what it is made
    of, so a table of ten million rows may pass for one that fits the driver, which a broadcast has to gather it in.
    """
    return df.hint("merge")
