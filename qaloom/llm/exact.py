"""Exact duplicates with frequent texts split off, in DataFrame operations only.

Texts are compared by the SHA-256 of what is left without white space. A Misra-Gries summary (Spark's frequent items
sketch: a fixed number of counters, all lowered when they run out) finds the digests that may hold more than 1/``SHARE``
of all rows, in one pass and without a shuffle of rows; summaries of tasks are combined in three steps, each of few
summaries. A second pass counts these digests exactly, which verifies them, and picks the row that stays. Fewer than
``SHARE`` digests can pass, so the winners are broadcast and frequent copies are decided where they are read. What
remains has no digest with more than 1/``SHARE`` of the rows and is shuffled by digest as usual.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaloom.storage import materialize

#: A digest is frequent with more than 1/SHARE of the rows. The summary overrates by at most 3.5/32768 of the rows, the
#: size of its table for 16,384 counters, so all frequent digests are among those that it names.
SHARE = 4096
COUNTERS = 4 * SHARE
FAN = 64
WHITE = " \t\n\x0b\x0c\r"


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of a text without white space; null counts as empty."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), WHITE, ""), 256)


def _numbered(docs: DataFrame, key: str, text: str, *more: Column) -> DataFrame:
    """One written row a document: its key, digest, code points and a number of its own."""
    points = F.length(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    return materialize(docs.select(
        F.col(f"`{key}`").alias("doc_id"), digest(F.col(f"`{text}`")).alias("digest"), points.alias("points"),
        F.monotonically_increasing_id().alias("row"), *more,
    ), "digests")


def candidates(rows: DataFrame) -> DataFrame:
    """Hashes (``item``) of all digests that may hold more than 1/SHARE of the rows; fewer than 2 * SHARE."""
    part = F.spark_partition_id().alias("part")
    state = rows.select(part, F.xxhash64("digest").alias("item")).groupBy(F.expr(f"part div {FAN}").alias("part"))
    state = state.agg(F.count("*").alias("n"), F.expr(f"approx_top_k_accumulate(item, {COUNTERS})").alias("state"))
    both = F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(state, {COUNTERS})").alias("state")
    state = state.groupBy(F.expr(f"part div {FAN}").alias("part")).agg(*both)
    state = state.groupBy(F.lit(0).alias("part")).agg(*both)  # no row for an empty table, unlike without a group
    named = state.select("n", F.explode(F.expr(f"approx_top_k_estimate(state, {2 * SHARE})")).alias("top"))
    return named.filter(F.col("top.count") * SHARE > F.col("n")).select(F.col("top.item").alias("item"), "n")


def _order() -> Column:
    """Most code points first, then the smallest id (null last), then the first row of those alike."""
    return F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("x"), F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"))


def frequent(rows: DataFrame) -> DataFrame:
    """Verified frequent digests with their exact size and the row that stays: at most SHARE rows."""
    named = F.broadcast(materialize(candidates(rows), "candidates"))
    counted = rows.withColumn("item", F.xxhash64("digest")).join(named, "item").groupBy("digest")
    counted = counted.agg(F.count("*").alias("group_size"), F.min(_order()).alias("best"), F.first("n").alias("n"))
    counted = counted.filter(F.col("group_size") * SHARE > F.col("n"))
    return materialize(counted.select("digest", "group_size", "best.keep_id", "best.keep_row"), "frequent")


def _decide(rows: DataFrame, often: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of frequent digests, decided without a shuffle, and all others, decided by one."""
    often = F.broadcast(often)
    hot = rows.join(often, "digest").withColumn("kept", F.col("row") == F.col("keep_row")).drop("keep_row")
    group = Window.partitionBy("digest")
    first = group.orderBy(F.desc("points"), F.col("doc_id").asc_nulls_last(), "row")
    rest = rows.join(often, "digest", "left_anti").withColumns({
        "group_size": F.count("*").over(group), "keep_id": F.first("doc_id").over(first), "kept": F.row_number().over(first) == 1,
    })
    return hot, rest


def mark(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row: doc_id, keep_id (that of the row that stays), group_size, kept and text_sha256.

    Texts are equal when they are without white space; a null text is empty and equal to other empty ones. Of equal texts
    the one with the most code points stays, then the smallest id, a null id last; of rows alike in both, one. A repeated
    id is judged row by row. An empty table gives an empty result. Other columns are not looked at, whatever their names.
    """
    rows = _numbered(docs, key, text)
    hot, rest = _decide(rows, frequent(rows))
    out = hot.unionByName(rest)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def unique(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns, in the sense of ``mark``.

    Copies of frequent texts go where they are read; whole texts are joined only with the numbers of the rows that go.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    rows = _numbered(docs, key, text, whole)
    often = frequent(rows)
    gone = materialize(_decide(rows.drop("whole"), often)[1].filter(~F.col("kept")).select("row"), "gone")
    left = rows.join(F.broadcast(often), "digest", "left").filter("keep_row IS NULL OR row = keep_row")
    return left.join(gone, "row", "left_anti").select(*[F.col("whole")[c].alias(c) for c in docs.columns])
