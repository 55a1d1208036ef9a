"""The training-data pipeline: documents through quality, near copies, repeated passages, mixing and packing.

Every stage takes (spark, docs, sf_dir) and works on all rows it gets. All but the last return the columns of ``docs``;
extra columns are handed through, also where they are named like working columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.llm import mixing, neardup, packing, quality, suffixes
from qaloom.llm.columns import table, word_count
from qaloom.storage import materialize


def _rest(docs: DataFrame, *names: str):
    """All other columns as one struct."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in names], F.lit(0).alias("`")).alias("rest")


def _back(docs: DataFrame, **named) -> list:
    """The columns of ``docs`` in their order, from the struct but for those given."""
    return [named[c].alias(c) if c in named else F.col("rest")[c].alias(c) for c in docs.columns]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules score at 0.3 or more; the rules are fitted to labelled rows that are not held out."""
    model = quality.train(docs, table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")))
    scored = quality.score(docs.select("text", _rest(docs, "text")), model)
    return scored.filter("predicted = 1").select(*_back(docs, text=F.col("text")))


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest number; a null number is always kept."""
    gone = neardup.near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(materialize(gone, "gone"), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def no_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 bytes that a document with a smaller number has; ``n_chars`` follows the text."""
    cut = suffixes.remove_repeats(docs, _rest(docs, "doc_id", "text"), texts=True)
    named = {"doc_id": F.col("doc_id"), "text": F.col("kept")}
    if "n_chars" in docs.columns:
        named["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return cut.select(*_back(docs, **named))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: weights 5, 2, 1 in turn, none above three times its size."""
    number = F.monotonically_increasing_id().alias("row")
    rows = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _rest(docs, "doc_id", "source"), number), "rows")
    small = rows.select("doc_id", "source", "size", "row")  # whole texts stay out of the exchanges of the mix
    mixed = mixing.mix(small, "doc_id", "source", "size", mixing.source_targets(small, "source", "size", [5, 2, 1]))
    mixed = rows.join(materialize(mixed.filter("copies > 0").select("row", "copies"), "copies"), "row")
    return mixing.emit(mixed).select(*_back(docs, doc_id=F.col("doc_id"), source=F.col("source")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of at most 2048; a document that the mix repeats is packed as often."""
    return packing.packed_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", good_quality), ("near_copies", no_near_copies), ("repeats", no_repeats), ("mix", mixed_sources), ("pack", packed),
]
#: The classifier, the sketches and the packing are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
