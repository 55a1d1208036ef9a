"""Conversations of rows against the text of their array, also in parts, with nulls, ties and a long conversation."""

import random

from pyspark.sql import functions as F

from qaloom.functions import messages as m
from qaloom.operators.rendering import render_conversations

TURNS = "conv string, turn int, role string, content string, thinking string, extra int, part int"
FIELDS = ("thinking",)


def whole(spark, rows, **options):
    """The conversations as arrays in their order, rendered as such."""
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    data = []
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or ""))
        data.append((conv, [(r[2], r[3], r[4]) for r in own]))
    df = spark.createDataFrame(data, "conv string, m array<struct<role:string,content:string,thinking:string>>")
    return {r["conv"]: r["t"] for r in df.select("conv", m.render_chat(F.col("m"), "D", FIELDS, **options).alias("t")).collect()}


def joined(spark, rows, size, **options):
    df = spark.createDataFrame(rows, TURNS)
    got = render_conversations(df, "conv", "turn", "D", FIELDS, part_rows=size, **options).collect()
    out = {}
    for r in sorted(got, key=lambda r: r["part"]):
        out.setdefault(r["conv"], []).append(r)
    for parts in out.values():
        assert [r["part"] for r in parts] == list(range(parts[0]["parts"]))
    return {conv: "".join(r["text"] for r in parts) for conv, parts in out.items()}


def conversations():
    rng = random.Random(3)
    rows = []
    for conv in [None, *(f"c{i}" for i in range(40))]:
        turns = rng.sample(range(30), rng.randrange(1, 9))
        for turn in turns:
            role = rng.choice(["user", "assistant", "assistant", "system", "tool", None])
            rows.append((conv, turn, role, rng.choice([None, "", "text é", "more"]), rng.choice([None, "", "idea"]), 1, 9))
        if rng.random() < 0.5:
            rows.append((conv, None, "user", "no turn", None, 1, 9))
    return rows + [("tie", 1, "user", "b", None, 0, 0), ("tie", 1, "assistant", "a", None, 0, 0), ("tie", 2, "user", "same", None, 0, 0), ("tie", 2, "user", "same", None, 1, 1)]


def test_parts_are_the_text_of_the_array(spark):
    rows = conversations()
    for options in ({}, {"close_earlier": True, "think": "high"}):
        want = whole(spark, rows, **options)
        assert joined(spark, rows, 256, **options) == want
        assert joined(spark, rows, 2, **options) == want


def test_empty(spark):
    assert joined(spark, [], 256) == {}


def test_long_conversation_in_bounded_parts(spark):
    n = 20_000
    role = F.when(F.col("id") % 2 == 0, "user").otherwise("assistant")
    turns = spark.range(n).select(F.lit(1).alias("conv"), F.col("id").alias("turn"), role.alias("role"), F.col("id").cast("string").alias("content"))
    got = render_conversations(turns.repartition(8), "conv", "turn", "D", close_earlier=True).orderBy("part").collect()
    assert len(got) == -(-n // 256) and max(len(r["text"]) for r in got) < 30_000
    text = "".join(r["text"] for r in got)
    assert text.count("<|start|>user") == n // 2 and text.endswith(f"final<|message|>{n - 1}")
    assert [int(x.split("<|end|>")[0]) for x in text.split("<|message|>")[2:]] == list(range(n))
