"""Exact duplicates: frequent texts split off, against a plain grouping."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from qaloom.llm import exact

WHITE = re.compile("[\x20\x09-\x0d]")


def plain(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(WHITE.sub("", text or ""), []).append((-len(text or ""), i is None, i))
    out = []
    for i, text in rows:
        bare = WHITE.sub("", text or "")
        best = min(groups[bare], key=lambda x: (x[0], x[1], x[2] or 0))
        out.append((i, best[2], len(groups[bare]), hashlib.sha256(bare.encode()).hexdigest()))
    return out


def rows_of(df):
    return df.select("doc_id", "keep_id", "group_size", "text_sha256").collect()


def test_marks_equal_texts(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a b", "ab", " ab\n", "é\tü", "e\x85", "", None, "\x0b\x0c", "A b", "ab "])) for i in range(60)]
    rows += [(None, "a b"), (None, "only"), (None, "only"), (7, "twice"), (7, "twice"), (8, "long " * 200_000), (9, "long" * 200_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for c in ("row", "digest", "points", "kept", "whole", "keep_id", "item", "n"):
        df = df.withColumn(c, F.lit("x"))
    out = exact.mark(df)
    assert sorted(map(str, map(tuple, rows_of(out)))) == sorted(map(str, plain(rows)))
    kept = out.filter("kept").collect()
    assert len(kept) == len({r["text_sha256"] for r in kept}) == len({WHITE.sub("", t or "") for _, t in rows})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)
    stay = exact.unique(df)
    assert stay.columns == df.columns
    best = {h: k for _, k, _, h in plain(rows)}
    assert {(r["doc_id"], hashlib.sha256(WHITE.sub("", r["text"] or "").encode()).hexdigest()) for r in stay.collect()} == {(k, h) for h, k in best.items()}
    assert exact.mark(df.limit(0)).count() == exact.unique(df.limit(0)).count() == 0


def test_frequent_texts_are_split_off(spark):
    n = 30_000
    share = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 100 == 1, F.lit("warm")).otherwise(F.concat(F.lit("t"), (F.col("id") / 3).cast("int").cast("string")))
    df = spark.range(n).select(F.col("id").alias("doc_id"), share.alias("text")).repartition(7)
    rows = exact._numbered(df, "doc_id", "text")
    often = exact.frequent(rows).collect()
    exact_count = {"hot": n // 3, "warm": 200}
    assert {r["digest"]: r["group_size"] for r in often} == {hashlib.sha256(t.encode()).hexdigest(): c for t, c in exact_count.items()}
    assert {r["keep_id"] for r in often} == {0, 1}
    hot, rest = exact._decide(rows, exact.frequent(rows))
    assert "hashpartitioning" not in hot._jdf.queryExecution().executedPlan().toString()
    assert hot.count() == n // 3 + 200 and hot.count() + rest.count() == n
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact.mark(df).collect()}
    assert all(got[i] == (k, c) for i, k, c, _ in plain([(r["doc_id"], r["text"]) for r in df.collect()]))
