"""Inputs of the registered queries, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.sources.tables import read_table

from .templates import TEMPLATES

N = len(TEMPLATES)


def template_table(spark: SparkSession) -> DataFrame:
    rows = [(i, *t) for i, t in enumerate(TEMPLATES)]
    return spark.createDataFrame(rows, "tpl_id bigint, raw_text string, c1 string, c2 string, c3 string")


def flat(text):
    """A whole text as one line. A blank by itself stays, so only what changes is replaced."""
    return F.trim(F.regexp_replace(text, r"[\x00-\x1f][\x00-\x20]*| [\x00-\x20]+", " "))


def _parts(docs: DataFrame) -> DataFrame:
    """What the shapes are filled with, once per document: the lines only for shapes (or texts) that name them."""
    lines = F.filter(F.split("text", "\n"), lambda x: x != "")
    docs = docs.withColumn("_w", flat(F.col("text")))
    line = F.col("_w")

    def named(field: str, value):
        asks = F.col("tpl_id").isin([i for i, shape in enumerate(TEMPLATES) if any(field in x for x in shape)])
        return F.when(asks | F.contains("text", F.lit(field)), value).otherwise(F.when(F.col("text").isNotNull(), ""))

    return docs.select(
        "*",
        F.replace(F.replace(line, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')).alias("_j"),
        named("{S}", F.array_join(F.transform(lines, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". Open "), x)), "\n")).alias("_s"),
        named("{L}", F.array_join(F.transform(lines, lambda x: F.concat(F.lit("Open "), x)), "\n")).alias("_l"),
    )


def _filled(parts: DataFrame, spark: SparkSession) -> DataFrame:
    """Parts joined with the shape of ``tpl_id`` (a fixed table of 40 rows), fields filled in."""
    def fill(c: str):
        out = F.col(c)
        for name, value in (("{W}", "_w"), ("{J}", "_j"), ("{T}", "text"), ("{S}", "_s"), ("{L}", "_l")):
            out = F.replace(out, F.lit(name), F.col(value))
        return out.alias(c)

    joined = parts.join(F.broadcast(template_table(spark)), "tpl_id")
    kept = [c for c in parts.columns if c not in ("text", "_w", "_j", "_s", "_l")]
    return joined.select(*kept, fill("raw_text"), fill("c1"), fill("c2"), fill("c3"))


def completions(spark: SparkSession, folder: str) -> DataFrame:
    """One completion per document: doc_id, raw_text, c1, c2, c3, src_after, src_next."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text", (F.col("doc_id") % N).alias("tpl_id"))
    return _filled(_parts(docs), spark).drop("tpl_id").withColumns(
        {"src_after": F.substring("c2", 1, 1200), "src_next": F.substring("c3", 1, 1800)}
    )


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Five candidate completions per document: doc_id, cand_idx, raw_text."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    each = docs.withColumn("cand_idx", F.explode(F.sequence(F.lit(0), F.lit(4))))
    each = each.withColumn("tpl_id", (F.col("doc_id") + F.col("cand_idx") * 7) % N)
    return _filled(_parts(each), spark).select("doc_id", "cand_idx", "raw_text")


def line_chunks(spark: SparkSession, folder: str, lines: int = 2) -> DataFrame:
    from qaloom.operators.windows import chunk_lines

    return chunk_lines(read_table(spark, folder, "documents"), "doc_id", "text", lines)


def exchanges(spark: SparkSession, folder: str) -> DataFrame:
    """User turns with the assistant turn after and the system turn before them.

    Every turn names the user turn it may belong to, and one grouping on (conversation, turn)
    puts them together: one shuffle, at most three rows per group, even for a conversation
    that holds a third of all turns.
    """
    turns = read_table(spark, folder, "conversations")
    role = F.col("role")
    anchor = F.when(role == "assistant", F.col("turn") - 1).when(role == "system", F.col("turn") + 1).otherwise(F.col("turn"))
    known = turns.filter(role.isin("user", "assistant", "system")).select("conv_id", anchor.alias("turn"), "role", "text")

    def of(name: str, column: str):
        return F.max(F.when(role == name, F.col("text"))).alias(column)

    grouped = known.groupBy("conv_id", "turn").agg(of("user", "question"), of("assistant", "answer"), of("system", "system"))
    return grouped.filter(F.col("question").isNotNull())


def conversation_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Exchanges as ``conversation`` arrays of role and content."""
    def one(role: str, c: str):
        return F.when(F.col(c).isNotNull(), F.struct(F.lit(role).alias("role"), F.col(c).alias("content")))

    turns = F.array(one("system", "system"), one("user", "question"), one("assistant", "answer"))
    return exchanges(spark, folder).select(
        "conv_id", "turn", F.filter(turns, lambda m: m.isNotNull()).alias("conversation")
    )
