import json
import time

import pytest
from pyspark.sql import functions as F

from qaloom.functions.messages import convert_format
from qaloom.sources import files
from qaloom.sources.tables import spread_small
from qaloom.storage import materialize, settle, shared_folder
from registry import queries


def test_scan_documents(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "x.DOCX").write_bytes(b"1")
    (tmp_path / "a" / "b" / "y.v1.docx").write_bytes(b"22")
    (tmp_path / "a" / "z.pdf").write_bytes(b"3")
    docs = files.scan_documents(spark, str(tmp_path))
    got = {(r["stem"], r["length"], bytes(r["content"])) for r in docs.withColumn("stem", files.document_stem(F.col("doc_path"))).collect()}
    assert got == {("x", 1, b"1"), ("y.v1", 2, b"22")}
    assert files.scan_documents(spark, str(tmp_path), (".pdf", ".docx")).count() == 3


def test_records_by_suffix(spark, tmp_path):
    row = {"messages": [{"role": "user", "content": "é"}]}
    (tmp_path / "a.jsonl").write_text(json.dumps(row) + "\n" + json.dumps(row) + "\n", encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps([row, row, row], indent=2), encoding="utf-8")
    (tmp_path / "c.json").write_text(json.dumps(row, indent=2), encoding="utf-8")
    counts = [files.read_records(spark, str(tmp_path / n)).filter("messages[0].content = 'é'").count() for n in ("a.jsonl", "b.json", "c.json")]
    assert counts == [2, 3, 1]
    with pytest.raises(ValueError):
        files.read_records(spark, str(tmp_path / "a.csv"))


def test_splits_may_be_missing(spark, tmp_path):
    (tmp_path / "train.jsonl").write_text('{"messages": []}\n')
    assert files.load_split(spark, str(tmp_path), "val") is None
    train = files.load_split(spark, str(tmp_path), "train")
    assert files.require_columns(train, "messages") is train
    with pytest.raises(ValueError):
        files.require_columns(train, "text")
    with pytest.raises(FileNotFoundError):
        files.require_columns(None, "messages")


def test_conversion_skips_blank_lines_and_missing_splits(spark, tmp_path):
    old = {"conversation": [{"role": "user", "content": "ü"}, {"role": "assistant", "content": "a"}], "meta": {"doc_path": "p"}}
    new = {"messages": [{"role": "user", "content": "n"}], "meta": {"doc_path": "p", "window_index": 3}}
    (tmp_path / "train.jsonl").write_text(json.dumps(old) + "\n \n\n" + json.dumps(new) + "\n")
    (tmp_path / "test.jsonl").write_text(json.dumps(new) + "\n")
    out = tmp_path / "converted"
    assert files.convert_splits(spark, str(tmp_path), str(out)) == ["train", "test"]
    rows = [json.loads(x) for f in sorted((out / "train.jsonl").glob("part-*")) for x in f.read_text(encoding="utf-8").splitlines()]
    assert sorted(rows, key=len) == sorted(
        [
            {"messages": [{"role": "user", "content": "ü"}, {"role": "assistant", "name": "analysis", "content": "(Domain reasoning)\na"}, {"role": "assistant", "name": "final", "content": "a"}]},
            new,
        ],
        key=len,
    )


def test_written_text_keeps_non_ascii(spark, tmp_path):
    df = spark.createDataFrame([("ß→", None)], "a string, b string")
    files.write_jsonl(df, str(tmp_path / "x.jsonl"))
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "x.jsonl").glob("part-*"))
    assert text == '{"a":"ß→"}\n'
    assert convert_format(df) is df


def test_split_table_and_completions(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "val"), (3, "train")], "id int, split string")
    files.write_splits(df, str(tmp_path / "s"))
    assert sorted(tuple(r) for r in files.read_splits(spark, str(tmp_path / "s"), "id int").collect()) == [(1, "train"), (2, "val"), (3, "train")]
    raw = spark.createDataFrame([("/d/a.docx", 0, "x")], "doc_path string, window_index int, raw_text string")
    files.write_completions(raw, str(tmp_path / "c"))
    assert [tuple(r) for r in spark.read.json(str(tmp_path / "c")).select("doc_stem", "window_index", "raw_text").collect()] == [("a", 0, "x")]


def test_trials(spark, tmp_path):
    path = str(tmp_path / "t.jsonl")
    assert files.load_trials(spark, path) is None
    rows = [(1, {"a": 0.5}, 1.0, "COMPLETE"), (2, {}, 2.0, "PRUNED")]
    files.save_trials(spark.createDataFrame(rows, "number int, params map<string,double>, value double, state string"), path)
    assert [tuple(r) for r in files.load_trials(spark, path).collect()] == [(1, {"a": 0.5}, 1.0)]
    (tmp_path / "old.json").write_text("[]")
    assert files.load_trials(spark, str(tmp_path / "old.json")).count() == 0


def test_generate(spark):
    df = spark.createDataFrame([(1, "a"), (2, "bb")], "id int, prompt string")
    made = files.generate(df, "prompt", lambda p: p.map(lambda x: None if x == "a" else x * 2), 2)
    assert sorted(tuple(r) for r in made.collect()) == [(2, 0, "bbbb"), (2, 1, "bbbb")]

    def weak(prompts):
        if (prompts == "a").any():
            raise RuntimeError("no answer")
        return prompts.map(lambda x: "  " if x == "c" else x)

    df = spark.createDataFrame([(1, "a"), (2, "bb"), (3, "c"), (4, "d")], "id int, prompt string").coalesce(1)
    assert sorted(tuple(r) for r in files.generate(df, "prompt", weak).collect()) == [(2, 0, "bb"), (4, 0, "d")]


def test_malformed_lines_end_the_job(spark, tmp_path):
    (tmp_path / "train.jsonl").write_text('{"messages": []}\n{"messages": [\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        files.load_split(spark, str(tmp_path), "train").collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        files.convert_splits(spark, str(tmp_path), str(tmp_path / "out"))


def test_shared_folder_and_spreading(spark):
    assert shared_folder(spark) == shared_folder(spark)
    df = materialize(spark.range(10))
    assert df.columns == ["id"] and df.count() == 10 and settle(df).count() == 10
    assert spread_small(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(10, numPartitions=64)
    assert spread_small(wide) is wide


def test_a_finished_step_leaves_no_shuffle_files(spark):
    from qaloom.storage import CLEANUP

    def written():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))

    before = written()
    df = spark.range(50_000).selectExpr("id % 1000 AS k", "id AS v").repartition(4, "v").groupBy("k").count()
    assert len(materialize(df).collect()) == 1000 and len(materialize(df.repartition(3)).collect()) == 1000
    for _ in range(100):  # files go by a message
        if written() <= before:
            break
        time.sleep(0.1)
    assert written() <= before
    assert spark.conf.get(CLEANUP, "false") == "false"


def test_arrays_of_a_long_conversation(spark, tmp_path, monkeypatch):
    turns = [(c, t, role, f"{role} {c} {t}") for c, n in ((3, 400), (4, 2), (70, 2)) for t, role in ((t, ("user", "assistant")[t % 2]) for t in range(n))]
    spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    monkeypatch.setattr(queries, "new_folder", lambda spark, name: str(tmp_path / name))
    got = queries.json_arrays(spark, str(tmp_path)).collect()
    assert sorted((r["conv_id"], r["turn"] + r["pos"], r["role"], r["content"]) for r in got) == sorted(turns)
    arrays = [json.loads(f.read_text()) for f in (tmp_path / "arrays.json").rglob("*.txt")]
    assert sum(map(len, arrays)) == 202 and max(map(len, arrays)) <= 33
