"""Column helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def hex_number(text: Column, start: int, digits: int) -> Column:
    """The number written in some hexadecimal digits of a text."""
    return F.conv(F.substring(text, start, digits), 16, 10).cast("bigint")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns that clash with no column of the frame."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        name = f"_{name}"
        while name.lower() in have:
            name = f"_{name}"
        have.add(name.lower())
        out.append(name)
    return out
