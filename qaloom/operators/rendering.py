"""Chat text of whole conversations whose messages are rows, however long a conversation is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.messages import DEVELOPER, chat_header, has, left_open, text_of, turn_text
from ..ordered import numbered
from ..storage import materialize

PART = 256


def render_conversations(
    turns: DataFrame,
    conversation: str,
    order: str,
    current_date: str | Column,
    fields: tuple = (),
    think: bool | str | None = None,
    close_earlier: bool = False,
    part_rows: int = PART,
) -> DataFrame:
    """Messages (conversation, order, role, content, and ``fields``) to their chat text, in parts of ``part_rows`` messages.

    Returns the conversation, ``part`` (from 0), ``parts`` and ``text``; the parts of a conversation one after another are
    what ``render_chat`` gives for its messages as one array. Places come from a sort over ranges, and what a message must
    know of the others (the last user message, the end, the number of system messages) is one aggregated row a
    conversation, copied to each of its parts. So no task gets more than a part at once, even if one conversation holds a third of all rows.

    System messages come first, joined by a blank line. Messages alike in ``order`` (nulls first) come by role, then by a
    digest of their fields. A null conversation is one like any other, a message with a null or unknown role has no text,
    null content is empty. An empty table gives an empty result; other columns are left out.
    """
    names = ["role", "content", *fields]
    system = F.coalesce(F.col("role") == "system", F.lit(False))
    rows = turns.select(
        F.struct(F.col(conversation).alias("id")).alias("key"), F.struct(*names).alias("m"), system.alias("system"),
        F.struct(F.col(order).alias("at"), "role", F.sha2(F.to_json(F.struct(*names)), 256).alias("digest")).alias("place"),
    )
    rows = numbered(rows, "key", [~F.col("system"), F.col("place")], "pos", "total")
    part = F.floor(F.col("pos") / part_rows)
    rows = rows.withColumn("part", part)

    content = F.col("m")["content"]
    ends = F.struct("place", *[x.alias(n) for x, n in zip(left_open(F.col("m"), fields), ("open", "musing"))])
    known = rows.groupBy("key").agg(
        F.max("total").alias("size"),
        F.max(ends).alias("last"),
        F.coalesce(F.max(F.when(F.col("m")["role"] == "user", F.col("pos"))), F.lit(-1)).alias("user"),
        F.count_if("system").alias("systems"),
        F.max(F.col("system") & has(content)).alias("told"),
    )
    known = known.select("key", F.struct("size", "last.open", "last.musing", "user", "systems", (F.col("told") | (F.col("systems") > 1)).alias("told")).alias("f"))
    known = materialize(known, "known")
    each = known.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("f.size") - 1) / part_rows))))

    f, pos = F.col("f"), F.col("pos")
    opening = F.when(pos == 0, DEVELOPER).otherwise("\n\n")
    instruction = F.concat(opening, text_of(content), F.when(pos == f["systems"] - 1, "<|end|>").otherwise(""))
    own = F.when(F.col("system"), F.when(f["told"], instruction).otherwise("")).otherwise(turn_text(F.col("m"), pos, f, fields, close_earlier))
    pieces = rows.join(each, ["key", "part"]).select("key", "part", "f", F.struct("pos", own.alias("text")).alias("piece"))
    joined = pieces.groupBy("key", "part").agg(F.first("f").alias("f"), F.array_sort(F.collect_list("piece")).alias("pieces"))
    last = F.floor((f["size"] - 1) / part_rows)
    text = F.concat(
        F.when(F.col("part") == 0, chat_header(current_date, think)).otherwise(""),
        F.array_join(F.transform("pieces", lambda x: x["text"]), ""),
        F.when((F.col("part") == last) & ~f["open"] & ~f["musing"], "<|start|>assistant").otherwise(""),
    )
    return joined.select(F.col("key.id").alias(conversation), "part", (last + 1).alias("parts"), text.alias("text"))
