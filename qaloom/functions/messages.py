"""Shaping of chat records: building, converting, dispatching and rendering message arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .text import let

MESSAGES = "array<struct<role:string,content:string>>"
NAMED_MESSAGES = "array<struct<role:string,name:string,content:string>>"


def message(role: str | Column, content: str | Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    content = F.lit(content) if isinstance(content, str) else content
    return F.struct(role.alias("role"), content.alias("content"))


def build_messages(question: Column, answer: Column | None = None, system: str | Column | None = None) -> Column:
    """Optional system turn, the user turn, and the assistant turn when there is an answer."""
    turns = [message("system", system)] if system is not None else []
    turns.append(message("user", question))
    if answer is not None:
        turns.append(message("assistant", answer))
    return F.array(*turns).cast(MESSAGES)


def first_of_role(messages: Column, role: str) -> Column:
    """Content of the first message of a role, empty when there is none."""
    own = F.filter(messages, lambda m: m["role"] == role)
    return F.coalesce(F.get(own, F.lit(0))["content"], F.lit(""))


def convert_conversation(
    conversation: Column, developer_text: str = C.DEVELOPER_TEXT, prefix: str = C.REASONING_PREFIX
) -> Column:
    """System turns become a fixed developer text, assistant turns an analysis and a final message."""

    def named(role: str, name: str | None, content: Column) -> Column:
        return F.struct(
            F.lit(role).alias("role"), F.lit(name).cast("string").alias("name"), content.alias("content")
        )

    def turns(m: Column) -> Column:
        reasoning = F.concat(F.lit(prefix + "\n"), m["content"])
        return (
            F.when(m["role"] == "system", F.array(named("developer", None, F.lit(developer_text))))
            .when(m["role"] == "user", F.array(named("user", None, m["content"])))
            .when(
                m["role"] == "assistant",
                F.array(named("assistant", "analysis", reasoning), named("assistant", "final", m["content"])),
            )
            .otherwise(F.array().cast(NAMED_MESSAGES))
        )

    return F.flatten(F.transform(conversation, turns))


def convert_format(df: DataFrame, **texts) -> DataFrame:
    """Legacy ``conversation`` rows to ``messages`` rows; rows of the new form pass unchanged.

    A converted row keeps nothing but its messages. A frame that has both columns is decided
    row by row, on whether ``conversation`` is set.
    """
    if "conversation" not in df.columns:
        return df
    converted = convert_conversation(F.col("conversation"), **texts)
    if "messages" not in df.columns:
        return df.select(converted.alias("messages"))
    old = F.col("conversation").isNotNull()
    has_name = "name" in df.schema["messages"].dataType.elementType.fieldNames()
    current = F.transform(
        F.col("messages"),
        lambda m: F.struct(
            m["role"].alias("role"),
            (m["name"] if has_name else F.lit(None).cast("string")).alias("name"),
            m["content"].alias("content"),
        ),
    )
    rest = [F.when(~old, F.col(c)).alias(c) for c in df.columns if c not in ("messages", "conversation")]
    return df.select(F.when(old, converted).otherwise(current).alias("messages"), *rest)


def from_sharegpt(conversations: Column) -> Column:
    return F.transform(
        conversations,
        lambda t: message(
            F.when(t["from"] == "human", "user").when(t["from"] == "gpt", "assistant").otherwise(t["from"]), t["value"]
        ),
    )


def with_messages(df: DataFrame) -> DataFrame:
    """Give a frame a ``messages`` column from whichever row form it has."""
    cols = df.columns
    if "messages" in cols:
        return df
    if "conversation" in cols:
        return df.withColumnRenamed("conversation", "messages")
    if "question" in cols and "answer" in cols:
        return df.withColumn("messages", build_messages(F.col("question"), F.col("answer")))
    raise ValueError("rows need messages, or conversation, or question and answer")


# --- chat text ----------------------------------------------------------------
DEVELOPER = "<|start|>developer<|message|>\n\n# Instructions\n\n"


def chat_header(current_date: str | Column, think: bool | str | None) -> Column:
    date = F.lit(current_date) if isinstance(current_date, str) else current_date
    if isinstance(think, str) and think:
        level = f"\n\nReasoning: {think}"
    else:
        level = "" if think is False else "\n\nReasoning: medium"
    return F.concat(
        F.lit(f"<|start|>system<|message|>{C.CHAT_IDENTITY}\nCurrent date: "),
        date,
        F.lit(f"{level}\n\n{C.CHAT_CHANNELS}<|end|>"),
    )


def has(text: Column) -> Column:
    return F.coalesce(F.length(text) > 0, F.lit(False))


def text_of(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def turn_text(m: Column, i: Column, f: Column, fields: tuple = (), close_earlier: bool = False) -> Column:
    """Chat text of message ``m`` at place ``i``; a system message has none.

    ``f`` tells of the conversation: its ``size``, whether its end is left ``open`` after content or after a thought
    alone (``musing``), and the place of its last ``user`` message, -1 without one.
    """

    def closing(is_open: Column) -> Column:
        stays_open = is_open & (i == f["size"] - 1) if close_earlier else is_open
        return F.when(stays_open, "").otherwise("<|end|>")

    def builtin(name: Column) -> Column:
        return name.isin(C.BUILTIN_TOOLS)

    def call(c: Column) -> Column:
        where = F.when(builtin(c["name"]), "analysis to=").otherwise("commentary to=functions.")
        return F.concat(
            F.lit("<|start|>assistant<|channel|>"), where, c["name"],
            F.lit(" <|constrain|>json<|message|>"), c["arguments"], F.lit("<|call|>"),
        )

    parts = []
    if "thinking" in fields:
        shown = F.concat(F.lit("<|start|>assistant<|channel|>analysis<|message|>"), m["thinking"], closing(f["musing"]))
        parts.append(F.when(has(m["thinking"]) & (i > f["user"]), shown).otherwise(""))
    said = F.concat(F.lit("<|start|>assistant<|channel|>final<|message|>"), m["content"], closing(f["open"]))
    parts.append(F.when(has(m["content"]), said).otherwise(""))
    if "tool_calls" in fields:
        parts.append(text_of(F.array_join(F.transform(m["tool_calls"], call), "")))
    shown = F.when(
        m["role"] == "user", F.concat(F.lit("<|start|>user<|message|>"), text_of(m["content"]), F.lit("<|end|>"))
    ).when(m["role"] == "assistant", F.concat(*parts))
    if "tool_name" in fields:
        name = F.concat(F.when(builtin(m["tool_name"]), "").otherwise("functions."), m["tool_name"])
        shown = shown.when(
            m["role"] == "tool",
            F.concat(F.lit("<|start|>"), name, F.lit(" to=assistant<|message|>"), text_of(m["content"]), F.lit("<|end|>")),
        )
    return shown.otherwise("")


def left_open(last: Column, fields: tuple = ()) -> tuple[Column, Column]:
    """Whether a conversation that ends with ``last`` is left open after its content, or after its thought alone."""
    own = F.coalesce(last["role"] == "assistant", F.lit(False))
    thought = has(last["thinking"]) if "thinking" in fields else F.lit(False)
    return own & has(last["content"]), own & ~has(last["content"]) & thought


def render_chat(
    messages: Column,
    current_date: str | Column,
    fields: tuple = (),
    think: bool | str | None = None,
    close_earlier: bool = False,
) -> Column:
    """Chat text of a message array.

    ``fields`` names the optional struct members the messages carry: ``thinking``,
    ``tool_name`` and ``tool_calls`` (``array<struct<name,arguments>>``). A final assistant
    message stays open as a prefill. The template then leaves *every* assistant message open;
    ``close_earlier`` closes all but the last.
    """
    size = F.size(messages)
    open_content, thinking_only = left_open(F.get(messages, size - 1), fields)
    last_user = F.array_max(F.transform(messages, lambda m, i: F.when(m["role"] == "user", i).otherwise(-1)))
    flags = F.struct(size.alias("size"), open_content.alias("open"), thinking_only.alias("musing"), last_user.alias("user"))
    system = F.array_join(
        F.transform(F.filter(messages, lambda m: m["role"] == "system"), lambda m: text_of(m["content"])), "\n\n"
    )
    developer = F.when(has(system), F.concat(F.lit(DEVELOPER), system, F.lit("<|end|>"))).otherwise("")
    return F.concat(
        chat_header(current_date, think),
        developer,
        let(flags, lambda f: F.array_join(F.transform(messages, lambda m, i: turn_text(m, i, f, fields, close_earlier)), "")),
        F.when(open_content | thinking_only, "").otherwise("<|start|>assistant"),
    )


def render_prompt(question: Column, system: str | Column, current_date: str | Column) -> Column:
    """Single-turn text that ends where the assistant has to begin."""
    return render_chat(build_messages(question, None, system), current_date)
