"""Walks over long texts: the same results as plain loops, and time in proportion to the length."""

import time

import pytest
from pyspark.sql import functions as F

from qaloom.functions.qa import step_candidates
from qaloom.functions.text import number_bullets, scan
from qaloom.operators.blocks import budget_chunks, similarity_chunks, under_headings

ELEMENT = "array<struct<tag:string,text:string>>"


def test_scan_gathers_blocks(spark):
    rows = [(list(range(n)),) for n in (0, 1, 255, 256, 257, 1000)]
    df = spark.createDataFrame(rows, "x array<int>")
    out = df.select(scan(F.col("x"), F.lit(0), lambda s, x: (s + x, F.when(x % 3 != 0, s)), "int").alias("v")).collect()
    for (x,), r in zip(rows, out):
        total, want = 0, []
        for i in x:
            if i % 3:
                want.append(total)
            total += i
        assert r["v"]["out"] == want and r["v"]["state"] == total


def elements(n):
    return [(f"h{1 + i % 6}", f"t{i}") if i % 3 == 0 else ("p", f"text {i}.") for i in range(n)]


def paths(n):
    path, out = [None] * 6, []
    for tag, text in elements(n):
        if tag[0] == "h":
            level = int(tag[1]) - 1
            path = path[:level] + [text] + [None] * (5 - level)
        else:
            out.append((" > ".join(p for p in path if p is not None), text))
    return out


def test_heading_paths(spark):
    df = spark.createDataFrame([(elements(n),) for n in (0, 1, 2000)], f"e {ELEMENT}")
    got = [[tuple(b) for b in r[0]] for r in df.select(under_headings(F.col("e"))).collect()]
    assert got == [paths(n) for n in (0, 1, 2000)]


def test_first_spellings(spark):
    text = "\n".join(f"{i}. Click the Button {i % 7}" if i % 2 else f"{i}. CLICK the button {i % 7}" for i in range(1, 60))
    (got,) = spark.createDataFrame([(text,)], "t string").select(step_candidates(F.col("t"))).collect()
    lines, seen = [], set()
    for line in got[0]:
        assert line.lower() not in seen
        seen.add(line.lower())
        lines.append(line)
    assert lines == sorted(lines, key=lambda x: text.index(x)) and len(lines) == 59


TEXTS = {
    "number_bullets": (lambda n: "\n".join(f"- step {i}" for i in range(n)), "string", number_bullets),
    "step_candidates": (lambda n: "\n".join(f"{i}. click number {i}" for i in range(n)), "string", step_candidates),
    "under_headings": (lambda n: elements(n), ELEMENT, under_headings),
    "budget_chunks": (lambda n: [(f"h{i // 2}", f"text number {i}") for i in range(n)], "array<struct<headings:string,text:string>>", budget_chunks),
    "similarity_chunks": (lambda n: " ".join(f"Word{i} is here." for i in range(n)), "string", similarity_chunks),
}


@pytest.mark.parametrize("name", TEXTS)
def test_time_grows_with_length(spark, name):
    make, kind, build = TEXTS[name]
    spent = {}
    for n in (1000, 20_000, 40_000):
        df = spark.createDataFrame([(make(n),)], f"x {kind}").cache()
        df.count()
        best = 1e9
        for _ in range(2 if n > 1000 else 3):
            start = time.perf_counter()
            df.select(F.xxhash64(build(F.col("x")))).collect()
            best = min(best, time.perf_counter() - start)
        spent[n] = best
    print(name, {n: round(x, 2) for n, x in spent.items()})
    assert spent[40_000] < 3 * spent[20_000] + 0.5
