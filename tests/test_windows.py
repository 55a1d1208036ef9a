from pyspark.sql import Window
from pyspark.sql import functions as F

from qaloom import Rules
from qaloom.functions.text import approx_tokens
from qaloom.operators import windows


def chunks(spark, sizes):
    rows = [(d, i, f"{d}{i}") for d, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "doc_path string, chunk_idx int, text string")


def test_look_ahead_equals_plain_window(spark, monkeypatch):
    monkeypatch.setattr(windows, "BLOCK_ROWS", 4)
    df = chunks(spark, {"a": 1, "b": 2, "c": 4, "d": 5, "e": 17, "f": 8})
    got = windows.next_rows(df, "doc_path", "chunk_idx", {"n1": ("text", 1), "n2": ("text", 2)})
    w = Window.partitionBy("doc_path").orderBy("chunk_idx")
    want = df.withColumn("n1", F.lead("text", 1).over(w)).withColumn("n2", F.lead("text", 2).over(w))
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_windows_at_the_end(spark):
    got = {r["window_index"]: r for r in windows.context_windows(chunks(spark, {"a": 3})).collect()}
    assert [(got[i]["c1"], got[i]["c2"], got[i]["c3"], got[i]["chunk_pairing"]) for i in range(3)] == [
        ("a0", "a1", "a2", [0, 1]), ("a1", "a2", "", [1, 2]), ("a2", "a2", "", [2, 2]),
    ]


def test_budget_holds(spark):
    lengths = [0, 1, 399, 4000, 7999, 8000, 8001, 30000]
    df = spark.createDataFrame(
        [(f"{a}-{b}", i, "x" * n) for a in lengths for b in lengths for i, n in enumerate((a, b))], "doc_path string, chunk_idx int, text string"
    )
    for budget in (1000, 1500, 2500, 4000):
        out = windows.context_windows(df, "doc_path", Rules(content_budget=budget))
        over = out.filter(approx_tokens(F.col("c1")) + approx_tokens(F.col("c2")) > max(budget, 1) + 1)
        assert over.count() == 0


def test_prompt_overflow_gives_up_second_chunk(spark):
    df = spark.createDataFrame([("d", 0, "a" * 4000, "b" * 1300, "c" * 2000), ("d", 1, "a", "b" * 1300, "c")], "doc_path string, window_index int, c1 string, c2 string, c3 string")
    out = {r["window_index"]: r for r in windows.with_prompt(df, "{c1}|{c2}", Rules(context_tokens=1000, overflow_clip=10)).collect()}
    assert out[0]["prompt"] == "a" * 40 + "|" and out[0]["c2"] == "" and out[0]["src_after"] == "" and len(out[0]["src_next"]) == 1800
    assert out[1]["prompt"] == "a|" + "b" * 1300 and out[1]["src_after"] == "b" * 1200 and out[1]["src_next"] == "c"


def test_best_completion_takes_the_earliest_of_equals(spark):
    df = spark.createDataFrame([(1, 0, "none"), (1, 2, "Q: a\nA: b"), (1, 1, "Q: c\nA: d"), (2, 0, "etc.")], "w int, cand_idx int, raw_text string")
    got = {r["w"]: (r["cand_idx"], r["raw_text"]) for r in windows.best_completion(df, ["w"]).collect()}
    assert got == {1: (1, "Q: c\nA: d"), 2: (0, "etc.")}


def test_merge_chunks(spark):
    df = spark.createDataFrame([("a", 0, " x "), ("a", 1, " "), ("a", 2, "y"), ("a", 3, ""), ("a", 4, "z")], "doc_path string, chunk_idx int, text string")
    got = {r["chunk_idx"]: r["text"] for r in windows.merge_chunks(df, "doc_path", 2).collect()}
    assert got == {0: "x", 1: "y", 2: "z"}
    assert windows.merge_chunks(df, "doc_path", 1).count() == 3
    gaps = spark.createDataFrame([("a", i, "" if i in (2, 3, 6) else f"t{i}") for i in range(8)], "doc_path string, chunk_idx int, text string")
    w = windows.context_windows(windows.merge_chunks(gaps, "doc_path", 2)).orderBy("window_index").collect()
    assert [(r["window_index"], r["c1"], r["chunk_pairing"]) for r in w] == [(0, "t0\n\nt1", [0, 1]), (1, "t4\n\nt5", [1, 2]), (2, "t7", [2, 2])]


def test_chunk_lines(spark):
    df = spark.createDataFrame([("a", "1\n2\n3\n4\n5"), ("b", "")], "d string, text string")
    got = sorted((r["d"], r["chunk_idx"], r["text"]) for r in windows.chunk_lines(df, "d", "text", 2).collect())
    assert got == [("a", 0, "1\n2"), ("a", 1, "3\n4"), ("a", 2, "5"), ("b", 0, "")]


def test_best_of_list_is_the_best_completion(spark):
    body = "1. Open the {0} page of the tool\n2. Choose the {0} entry\n3. Submit the {0} form"
    raws = ["nothing", "Q: How?\nA:\n" + body.format("a"), '[{"question": "How?", "ans": "see it"}]', "", "Q: How?\nA:\n" + body.format("b"), "Q: What?\nA: click [OK] or so"]
    rows = [(n, c, raws[(n * k + c) % len(raws)]) for n, k in enumerate([1, 2, 3, 4, 5]) for c in range(5)]
    df = spark.createDataFrame(rows, "w int, cand_idx int, raw_text string")
    want = {r["w"]: r["raw_text"] for r in windows.best_completion(df, ["w"]).collect()}
    lists = [(n, [x for m, _, x in rows if m == n]) for n in range(5)] + [(8, []), (9, None)]
    own = spark.createDataFrame(lists, "w int, raws array<string>").select("w", windows.best_of_list(F.col("raws")).alias("t"))
    assert {r["w"]: r["t"] for r in own.collect()} == {**want, 8: None, 9: None}
