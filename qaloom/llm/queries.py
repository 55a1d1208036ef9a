"""Registered queries of the operators in this package, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.storage import materialize

from . import covertree, exact, manifest, mixing, neardup, quality, repair, reputation, sharding, suffixes, topk, warc
from .columns import table, word_count
from .packing import packed_pieces

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_mix(spark, folder):
    d = table(spark, folder, "documents")
    sized = materialize(d.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sized")
    targets = mixing.source_targets(sized, "source", "size", [5, 2, 1])
    mixed = mixing.mix(sized, "doc_id", "source", "size", targets)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


@query
def op5_shards(spark, folder):
    d = table(spark, folder, "documents")
    text = F.coalesce("text", F.lit(""))
    sized = d.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).cast("bigint").alias("text_crc32"))
    return sharding.shuffle_to_shards(sized).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op9_packing(spark, folder):
    return packed_pieces(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_topk(spark, folder):
    e = table(spark, folder, "embeddings").filter(F.col("vec_id").isNotNull() & topk.usable(F.col("embedding")))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(64.0) * x.cast("double")).cast("bigint"))
    rows = e.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("vector"))
    return topk.top_k(rows, rows.filter(F.col("vec_id") % 20 == 0), 20)


@query
def op7_url_filter(spark, folder):
    """A page counts as bad if the document of its number is labelled as of low quality or toxic."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("bigint").alias("bad"))
    return reputation.judge(pages, labels).drop("url")


@query
def op8_warc(spark, folder):
    packages, place = warc.archive(table(spark, folder, "pages"))
    return warc.read_packages(packages, place, payloads=False).drop("url", "payload")


@query
def op4_quality(spark, folder):
    d = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(d, table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label")))
    return quality.score(d, model).select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op3_minhash(spark, folder):
    return neardup.near_duplicates(table(spark, folder, "documents"))


@query
def op10_covertree(spark, folder):
    e = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    return covertree.near_duplicates(e).select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


@query
def op6_suffixes(spark, folder):
    return suffixes.remove_repeats(table(spark, folder, "documents")).drop("kept", "rest")


@query
def op11_exact_dedup(spark, folder):
    return exact.mark(table(spark, folder, "documents"))


@query
def op12_repair(spark, folder):
    rows = table(spark, folder, "conversations").select(F.col("conv_id").alias("conv"), "turn", "role", "text")
    return repair.repair(repair.damaged(rows), rows)


@query
def op13_merkle(spark, folder):
    """Where 7 divides the CRC-32 of the id, the row that is verified has one character more than the manifest's."""
    d = table(spark, folder, "documents")
    first, text = [F.col("doc_id"), F.col("source"), F.col("lang")], F.col("text")
    leaf = manifest.leaf(*first, F.col("n_chars"), text)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = manifest.leaf(*first, F.col("n_chars").cast("decimal(20,0)") + 1, text)
    check = F.when(tampered & F.col("n_chars").isNotNull(), changed).otherwise(leaf)
    out = manifest.manifest(d, F.col("doc_id"), F.col("lang"), leaf, check).withColumnRenamed("id", "doc_id")
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")
