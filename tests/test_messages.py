import pytest
from pyspark.sql import functions as F

from qaloom import constants as C
from qaloom.functions import messages as m

HEAD = f"<|start|>system<|message|>{C.CHAT_IDENTITY}\nCurrent date: D{{}}\n\n{C.CHAT_CHANNELS}<|end|>"
MEDIUM = HEAD.format("\n\nReasoning: medium")


def render(spark, msgs, schema="role string, content string", **options):
    df = spark.createDataFrame([(msgs,)], f"m array<struct<{schema.replace(' ', ':').replace(',:', ',')}>>")
    return df.select(m.render_chat(F.col("m"), "D", **options).alias("t")).first()["t"]


def test_render(spark):
    user, final = "<|start|>user<|message|>{}<|end|>", "<|start|>assistant<|channel|>final<|message|>{}"
    assert render(spark, [("user", "hi")]) == MEDIUM + user.format("hi") + "<|start|>assistant"
    assert render(spark, [("system", "S"), ("user", "hi"), ("assistant", "yo")]) == (
        MEDIUM + "<|start|>developer<|message|>\n\n# Instructions\n\nS<|end|>" + user.format("hi") + final.format("yo")
    )
    turns = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    open_ended = user.format("a") + final.format("b") + user.format("c") + final.format("d")
    assert render(spark, turns) == MEDIUM + open_ended
    assert render(spark, turns, close_earlier=True) == MEDIUM + open_ended.replace("message|>b", "message|>b<|end|>")
    assert render(spark, turns[:3]) == MEDIUM + user.format("a") + final.format("b") + "<|end|>" + user.format("c") + "<|start|>assistant"
    assert render(spark, [("developer", "x"), ("user", "u")]) == MEDIUM + user.format("u") + "<|start|>assistant"
    assert render(spark, [("user", "u")], think=False).startswith(HEAD.format(""))
    assert render(spark, [("user", "u")], think="low").startswith(HEAD.format("\n\nReasoning: low"))
    assert render(spark, []) == MEDIUM + "<|start|>assistant"


def test_render_thoughts_and_tools(spark):
    schema = "role:string,content:string,thinking:string,tool_name:string,tool_calls:array<struct<name:string,arguments:string>>"
    msgs = [
        ("assistant", "early", "hidden", None, None), ("user", "u", None, None, None), ("assistant", "", "plan", None, [("python", "1"), ("find", "2")]),
        ("tool", "r", None, "python", None), ("tool", "s", None, "find", None),
    ]
    df = spark.createDataFrame([(msgs,), (msgs + [("assistant", None, "more", None, None)],)], f"m array<struct<{schema}>>")
    text = m.render_chat(F.col("m"), "D", ("thinking", "tool_name", "tool_calls"))
    first, second = [r["t"] for r in df.select(text.alias("t")).collect()]
    body = (
        "<|start|>assistant<|channel|>final<|message|>early<|end|><|start|>user<|message|>u<|end|>"
        "<|start|>assistant<|channel|>analysis<|message|>plan{0}"
        "<|start|>assistant<|channel|>analysis to=python <|constrain|>json<|message|>1<|call|>"
        "<|start|>assistant<|channel|>commentary to=functions.find <|constrain|>json<|message|>2<|call|>"
        "<|start|>python to=assistant<|message|>r<|end|><|start|>functions.find to=assistant<|message|>s<|end|>"
    )
    assert first == MEDIUM + body.format("<|end|>") + "<|start|>assistant"
    assert second == MEDIUM + body.format("") + "<|start|>assistant<|channel|>analysis<|message|>more"


def test_convert(spark):
    conv = [("system", "s"), ("user", "q"), ("assistant", "a"), ("tool", "x")]
    df = spark.createDataFrame([(conv, 1)], "conversation array<struct<role:string,content:string>>, extra int")
    out = m.convert_format(df)
    assert out.columns == ["messages"]
    assert [tuple(x) for x in out.first()["messages"]] == [
        ("developer", None, C.DEVELOPER_TEXT), ("user", None, "q"), ("assistant", "analysis", "(Domain reasoning)\na"), ("assistant", "final", "a"),
    ]
    new = df.withColumnRenamed("conversation", "messages")
    assert m.convert_format(new) is new


def test_convert_mixed_rows(spark):
    one = "array<struct<role:string,content:string>>"
    df = spark.createDataFrame([([("user", "q")], None, 1), (None, [("user", "m")], 2)], f"conversation {one}, messages {one}, extra int")
    got = [(r["messages"][0]["content"], r["extra"]) for r in m.convert_format(df).collect()]
    assert got == [("q", None), ("m", 2)]


def test_dispatch_and_sharegpt(spark):
    one = "array<struct<role:string,content:string>>"
    assert m.with_messages(spark.createDataFrame([([("user", "x")],)], f"conversation {one}")).columns == ["messages"]
    flat = m.with_messages(spark.createDataFrame([("q", "a")], "question string, answer string")).first()["messages"]
    assert [tuple(x) for x in flat] == [("user", "q"), ("assistant", "a")]
    with pytest.raises(ValueError):
        m.with_messages(spark.range(1))
    df = spark.createDataFrame([([("human", "Hello!"), ("gpt", "Hi"), ("system", "s")],)], "conversations array<struct<`from`:string,value:string>>")
    got = df.select(m.from_sharegpt(F.col("conversations")).alias("m")).first()["m"]
    assert [tuple(x) for x in got] == [("user", "Hello!"), ("assistant", "Hi"), ("system", "s")]


def test_first_of_role(spark):
    df = spark.createDataFrame([([("user", "a"), ("user", "b")],), ([],)], "m array<struct<role:string,content:string>>")
    assert [r["v"] for r in df.select(m.first_of_role(F.col("m"), "user").alias("v")).collect()] == ["a", ""]
