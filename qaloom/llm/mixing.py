"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Every document expects as many copies as its source's target is of its source's size. Expected copies are summed
along a fixed order inside the source, one random offset is added, and a document is emitted once for each whole
number that its stretch of the running sum crosses. So a source's emitted documents differ from the expected number by
less than one, and no document is emitted more often than its expectation rounded up.

Running sums are whole numbers of 1/2**24 copies: they are exact, the same in any partitioning, and a document that
expects exactly three copies gets three. The order goes by size class first, so each class is sampled at its own even
pace and the emitted words stay near the target as well.

No source is gathered in one task: it is cut along the order into bins of about the square root of a class's rows; a
window runs inside a bin, and the bins' totals are summed by a second window over bins alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import fresh, hex_number

ONE = 1 << 24


def size_class(size: Column) -> Column:
    """Eight classes to a power of two."""
    bits = F.length(F.bin(size))
    return bits * 8 + F.call_function("shiftright", size, F.greatest(bits - 3, F.lit(0)).cast("int"))


def source_targets(sized: DataFrame, source: str, size: str, weights: Sequence[int], most: int = 3) -> DataFrame:
    """One row per source: its size, weight, target, expected copies and offset.

    Sources in code point order, null last, take the weights in turn. Targets share the sum of all sizes by weight; one
    above ``most`` times its source's size stops there, and the excess goes to the others by weight until none is
    above. The limit is reached first by sources with the least size to a weight, so one pass in that order finds all
    that stop. The table has a row per source; a mix names a weight for each, so it is small beside the documents.
    """
    per = sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size").cast("double") * most)
    per = per.withColumn("need", F.col("cap") / F.col("weight"))
    order = Window.orderBy("need", F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    per = per.withColumns({
        "before": F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "rest": F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        "total": F.sum("source_size").over(whole).cast("double"),
    })
    per = per.withColumn("level", (F.col("total") - F.col("before")) / F.col("rest"))
    per = per.withColumn("share", F.max(F.when(F.col("need") > F.col("level"), F.col("level"))).over(whole))
    per = per.withColumn("target", F.least("cap", F.coalesce(F.col("weight") * F.col("share"), F.col("cap"))))
    copies = F.coalesce(F.floor(F.try_divide("target", F.col("source_size").cast("double")) * float(ONE)), F.lit(0))
    return per.select(
        "source", "source_size", "weight", "target", copies.cast("bigint").alias("expected"),
    )


def mix(docs: DataFrame, key: str, source: str, size: str, targets: DataFrame, seed: int = 7) -> DataFrame:
    """All documents with ``source_size``, ``target`` and the ``copies`` that the mix takes of each.

    Ties of the order are rows alike in key and size, so which of them is taken makes no difference. A null key or
    source is a value like any other; a size of 0 is sampled like other sizes and adds nothing. An empty table gives an
    empty result. Columns of ``docs`` keep their names; those named like a result column must be renamed before.
    """
    src, cls, h, buckets, bucket, upto, base, u, exp, ssize, tgt = fresh(
        docs, "src", "class", "h", "buckets", "bucket", "upto", "base", "u", "expected", "source_size", "target"
    )
    names = docs.columns
    per = targets.select(
        F.col("source").alias(src), F.col("source_size").alias(ssize), F.col("target").alias(tgt), F.col("expected").alias(exp),
        hex_number(F.md5(F.concat(F.lit(f"mix {seed} "), F.coalesce("source", F.lit("")))), 1, 6).alias(u),
    )
    d = docs.join(per, docs[source].eqNullSafe(per[src]))
    text = F.concat_ws(":", F.lit(seed), F.col(key).cast("string"), F.col(size).cast("string"))
    d = d.withColumns({cls: size_class(F.col(size)), h: hex_number(F.md5(text), 1, 8)})
    # Classes of a source and their bins; a bin is a stretch of the order (class, h).
    classes = docs.groupBy(F.col(source).alias("s"), size_class(F.col(size)).alias("c")).count()
    classes = classes.select("s", "c", F.ceil(F.sqrt("count")).cast("bigint").alias(buckets))
    d = d.join(classes, d[src].eqNullSafe(classes["s"]) & (d[cls] == classes["c"])).drop("s", "c")
    d = d.withColumn(bucket, F.call_function("shiftright", F.col(h) * F.col(buckets), F.lit(32)))
    bins = d.groupBy(src, cls, bucket).agg(F.sum(exp).alias(base))
    earlier = Window.partitionBy(src).orderBy(cls, bucket).rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(
        F.col(src).alias("s"), F.col(cls).alias("c"), F.col(bucket).alias("b"),
        F.coalesce(F.sum(base).over(earlier), F.lit(0)).alias(base),
    )
    inside = Window.partitionBy(src, cls, bucket).orderBy(h, key, size).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn(upto, F.sum(exp).over(inside))
    d = d.join(bins, d[src].eqNullSafe(bins["s"]) & (d[cls] == bins["c"]) & (d[bucket] == bins["b"]))
    end = F.col(base) + F.col(upto) + F.col(u)
    whole = lambda x: F.call_function("shiftright", x, F.lit(24))
    return d.select(
        *names, F.col(ssize).alias("source_size"), F.col(tgt).alias("target"),
        (whole(end) - whole(end - F.col(exp))).cast("bigint").alias("copies"),
    )


def emit(mixed: DataFrame, copies: str = "copies") -> DataFrame:
    """The mixed documents themselves: each row as often as it was taken."""
    return mixed.filter(F.col(copies) > 0).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).drop(copies)
