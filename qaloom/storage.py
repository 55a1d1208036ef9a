"""Where intermediate results are kept: the shared folder that the session names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: set while a step runs: its shuffle files go when it ends, not when the driver happens to collect its garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own machine, since there
    every task sees it.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="qaloom-")
        sc.setCheckpointDir(folder)
        folder = sc.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile gives back its shuffle files as soon as it ends; they would add up over the steps of a flow."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, name: str = "step", **options) -> DataFrame:
    """Write a frame as a table in the shared folder and read it back.

    This cuts the lineage, survives the loss of executors, and gives later plans the true size
    of the data, so that they broadcast only what is small. The shuffle files of the step go with its end. ``options`` are the writer's.
    """
    spark = df.sparkSession
    folder = new_folder(spark, name)
    with shuffles_freed(spark):
        df.write.options(**options).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small frame by a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
