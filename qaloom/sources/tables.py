"""Reading of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread_small(df: DataFrame) -> DataFrame:
    """Spread a scan over all cores when it has fewer splits than cores.

    This is for small files with few row groups. A large scan has more splits than cores and is
    left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spread_small(spark.read.parquet(f"{folder}/{name}.parquet"))
