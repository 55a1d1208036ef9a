"""Registered queries: every operator over the given tables, named by what it computes."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom import Rules
from qaloom import constants as C
from qaloom.functions import messages as m
from qaloom.functions import qa, tags
from qaloom.functions import text as t
from qaloom.functions import validators as v
from qaloom.operators import blocks, dedup, rendering, sampling, stats, windows
from qaloom.operators.dedup import Similarity
from qaloom.plans import dataset
from qaloom.plans.validate import clean_pairs, split_pairs
from qaloom.sources import files
from qaloom.sources.tables import read_table
from qaloom.storage import new_folder

from . import feeds
from .templates import TEMPLATES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DATE = "2025-01-01"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def big(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


# --- scalar text --------------------------------------------------------------
@query
def approx_tokens(spark, folder):
    d = read_table(spark, folder, "documents")
    return d.select("doc_id", t.approx_tokens(F.col("text")).alias("tokens"), big(t.word_count(F.col("text"))).alias("words"))


@query
def clip_budget(spark, folder):
    d = read_table(spark, folder, "documents")
    return d.select("doc_id", F.md5(t.clip_tokens(F.col("text"), 100)).alias("clipped"))


@query
def clean_text(spark, folder):
    d = read_table(spark, folder, "documents")
    noisy = F.concat(
        F.lit("* -\n"), F.replace("text", F.lit("\n"), F.lit("\nNote: seen\n 3. -\n•\nclick .\nnote- you must go\n")), F.lit("....")
    )
    return d.select("doc_id", t.clean_block(noisy).alias("text"))


@query
def norm_question(spark, folder):
    d = read_table(spark, folder, "conversations")
    q = t.clean_question(F.concat(F.lit("** "), F.replace("text", F.lit(" "), F.lit(" \t")), F.lit(" **")))
    return d.select("conv_id", "turn", q.alias("question"), t.question_key(F.col("text")).alias("key"))


@query
def scrub_answers(spark, folder):
    p = windows.extract_pairs(feeds.completions(spark, folder))
    a = t.strip_meta(t.clean_answer(t.clean_block(F.col("a_raw"))))
    return p.select("doc_id", big("match_idx").alias("match_idx"), a.alias("plain"), t.scrub_ui_refs(a).alias("scrubbed"))


@query
def rework_steps(spark, folder):
    """Inline bullets, numbering and renumbering of the lines of every document."""
    d = read_table(spark, folder, "documents")
    bullets = F.concat(F.lit("- "), F.replace("text", F.lit("\n"), F.lit("\n* ")))
    numbered = F.concat(F.lit("4. "), F.replace("text", F.lit("\n"), F.lit("\n9. ")), F.lit("\nend"))
    inline = F.concat(F.lit("Choose: * "), F.replace("text", F.lit(". "), F.lit(" * ")))
    return d.select(
        "doc_id",
        t.number_bullets(bullets).alias("bulleted"),
        t.renumber(numbered).alias("renumbered"),
        t.has_number_gap(numbered).alias("gap"),
        t.expand_inline_bullets(inline).alias("expanded"),
    )


@query
def repair_placeholders(spark, folder):
    """Placeholders filled from labels seen in the text of the document."""
    low = "abcdefghijklmnopqrstuvwxyz"
    d = read_table(spark, folder, "documents").select("doc_id", F.translate("text", low, low.upper()).alias("context"), "text")
    answer = F.concat(F.lit("1. Click . now\n2. "), F.col("text"), F.lit("\n3. Press button"))
    return d.select(
        "doc_id",
        t.repair_placeholders(answer, F.col("text")).alias("plain"),
        F.md5(t.repair_placeholders(answer, F.col("context"))).alias("loud"),
    )


# --- chunks and windows -------------------------------------------------------
@query
def pair_windows(spark, folder):
    w = windows.context_windows(feeds.line_chunks(spark, folder), "doc_id", Rules(content_budget=1100))
    return w.select(
        "doc_id", big("window_index").alias("window_index"), "c1", "c2", F.md5("c3").alias("c3"),
        big(F.element_at("chunk_pairing", 1)).alias("first"), big(F.element_at("chunk_pairing", 2)).alias("second"),
    )


@query
def prompt_overflow(spark, folder):
    rules = Rules(context_tokens=1012, overflow_clip=50)
    w = windows.context_windows(feeds.line_chunks(spark, folder, 4), "doc_id", rules)
    p = windows.with_prompt(w, "Text one: {c1}\nText two: {c2}\nEnd", rules)
    return p.select("doc_id", big("window_index").alias("window_index"), F.md5("prompt").alias("prompt"), "src_after", F.md5("src_next").alias("src_next"))


@query
def merge_chunks(spark, folder):
    merged = windows.merge_chunks(feeds.line_chunks(spark, folder), "doc_id", 3)
    return merged.select("doc_id", big("chunk_idx").alias("chunk_idx"), "text")


def _with_blanks(spark, folder) -> DataFrame:
    """One-line chunks where each with a number 2, 3, 6, 7, ... is blank, so that merged groups of two fall out."""
    c = feeds.line_chunks(spark, folder, 1)
    return c.withColumn("text", F.when(F.col("chunk_idx") % 4 >= 2, F.lit(" ")).otherwise(F.col("text")))


@query
def merged_windows(spark, folder):
    """Merged chunks, some of them blank, straight into context windows."""
    w = windows.context_windows(windows.merge_chunks(_with_blanks(spark, folder), "doc_id", 2), "doc_id", Rules(content_budget=4000))
    return w.select(
        "doc_id", big("window_index").alias("window_index"), F.md5("c1").alias("c1"), F.md5("c2").alias("c2"), F.md5("c3").alias("c3"),
        big(F.get("chunk_pairing", F.lit(1))).alias("pair_end"),
    )


@query
def html_blocks(spark, folder):
    body = blocks.under_headings(blocks.html_elements(F.col("html")))
    p = read_table(spark, folder, "pages").select("page_id", F.posexplode(body).alias("pos", "b"))
    return p.select("page_id", big("pos").alias("pos"), "b.headings", "b.text")


@query
def budget_chunks(spark, folder):
    c = blocks.html_chunks(read_table(spark, folder, "pages"), "page_id", "html", Rules(chunk_tokens=100))
    return c.select("page_id", big("chunk_idx").alias("chunk_idx"), "text")


@query
def element_text(spark, folder):
    """Paragraphs as narrative text, list items as list items, headings as titles; navigation links dropped."""
    kind = F.create_map(*[F.lit(x) for x in ("h1", "Title", "p", "NarrativeText", "li", "PageNavigation")])
    elements = F.transform(
        blocks.html_elements(F.col("html")), lambda e: F.struct(F.try_element_at(kind, e["tag"]).alias("category"), e["text"].alias("text"))
    )
    return read_table(spark, folder, "pages").select("page_id", blocks.element_text(elements).alias("text"))


@query
def similarity_chunks(spark, folder):
    rules = Rules(initial_threshold=0.2, appending_threshold=0.15, merging_threshold=0.1, max_chunk_chars=400)
    d = read_table(spark, folder, "documents").select("doc_id", F.posexplode(blocks.similarity_chunks(F.col("text"), rules)).alias("chunk_idx", "text"))
    return d.select("doc_id", big("chunk_idx").alias("chunk_idx"), "text")


@query
def best_of_k(spark, folder):
    b = windows.best_completion(feeds.candidates(spark, folder), ["doc_id"])
    return b.select("doc_id", big("cand_idx").alias("cand_idx"), F.round("score", 6).alias("score"), F.md5("raw_text").alias("raw"))


# --- pairs --------------------------------------------------------------------
@query
def parse_completions(spark, folder):
    p = windows.extract_pairs(feeds.completions(spark, folder))
    return p.select("doc_id", big("match_idx").alias("match_idx"), "q_raw", "a_raw")


def _judged(spark, folder) -> DataFrame:
    return split_pairs(clean_pairs(windows.extract_pairs(feeds.completions(spark, folder))))


@query
def clean_stage(spark, folder):
    p = clean_pairs(windows.extract_pairs(feeds.completions(spark, folder)))
    return p.select("doc_id", big("match_idx").alias("match_idx"), "question", "answer", "drop_reason")


@query
def drop_reason(spark, folder):
    return _judged(spark, folder).select(
        "doc_id", big("match_idx").alias("match_idx"), big("split_idx").alias("split_idx"), "question", "answer", "drop_reason"
    )


@query
def drop_summary(spark, folder):
    return stats.drop_summary(_judged(spark, folder))


@query
def split_add_remove(spark, folder):
    """Add/remove steps made of the lines of every document, in turns."""
    d = read_table(spark, folder, "documents")
    rows = F.filter(F.split("text", "\n"), lambda x: x != "")
    verbs = F.array(*[F.lit(x) for x in ("Go to", "Choose", "Add", "Remove", "Save", "Look at", "Associate")])
    steps = F.transform(
        rows, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), F.get(verbs, ((F.col("doc_id") + i * 3) % 7).cast("int")), F.lit(" "), x)
    )
    q = F.concat(F.lit("How do I add or remove document "), F.col("doc_id").cast("string"))
    out = d.select("doc_id", F.posexplode(qa.split_add_remove(q, F.array_join(steps, "\n"))).alias("split_idx", "p"))
    return out.select("doc_id", big("split_idx").alias("split_idx"), "p.question", F.col("p.ans").alias("answer"))


@query
def coverage_jaccard(spark, folder):
    """Steps of the odd lines of a document against steps of all its lines."""
    d = read_table(spark, folder, "documents")
    rows = F.filter(F.split("text", "\n"), lambda x: x != "")
    source = F.array_join(F.transform(rows, lambda x, i: F.when(i % 5 == 4, x).otherwise(F.concat(F.lit("Open "), x))), "\n")
    answer = F.array_join(F.transform(F.filter(rows, lambda x, i: i % 5 != 2), lambda x, i: F.concat((i + 1).cast("string"), F.lit(". Open "), x)), "\n")
    d = d.select("doc_id", source.alias("source"), answer.alias("answer"))
    d = d.withColumn("own", F.transform(qa.answer_steps(F.col("answer")), qa.normalize_step))
    d = d.withColumn("src", qa.source_steps(F.col("source")))
    own, src = F.col("own"), F.col("src")
    return d.select(
        "doc_id", big(F.size(src)).alias("source_steps"), big(F.size(own)).alias("answer_steps"),
        v.jaccard(own, src).alias("jaccard"), v.covers_source(F.col("answer"), F.col("source"), 0.6).alias("covered"),
        F.md5(F.array_join(qa.step_candidates(F.col("source")), "|")).alias("candidates"),
    )


@query
def continuation(spark, folder):
    """Does the next completion of the row order go on with the interface terms of an answer?"""
    p = feeds.completions(spark, folder)
    a = F.col("raw_text")
    n = F.concat(F.col("src_next"), F.lit("\nOpen "), F.col("c1"))
    return p.select(
        "doc_id", F.array_join(F.sort_array(qa.ui_terms(a)), ",").alias("terms"),
        v.continues_in_next(a, n, 1).alias("one"), v.continues_in_next(a, n, 2).alias("two"),
    )


def _replies(spark, folder) -> DataFrame:
    """Paraphrase replies with the whole text of every document: doc_id, raw_text."""
    w = feeds.flat(F.col("text"))
    text = F.concat(
        F.when(F.col("doc_id") % 3 == 0, "Q1: Steps to open the page of ").when(F.col("doc_id") % 3 == 1, "Q1: List all the pages of ").otherwise("Q1: Why "),
        w, F.lit("?\nq2. Describe in short how to reach "), F.when(F.col("doc_id") % 2 == 0, w).otherwise(""),
        F.lit("\nQ3: In which way can I open the page of "), w, F.lit("? \n"), F.col("text"),
    )
    return read_table(spark, folder, "documents").select("doc_id", text.alias("raw_text"), w.alias("w"), w.alias("a"))


@query
def paraphrase_filter(spark, folder):
    r = _replies(spark, folder)
    return r.select(
        "doc_id", F.get(qa.paraphrases(F.col("raw_text")), F.lit(0)).alias("first"),
        big(F.size(qa.paraphrases(F.col("raw_text"), 1000000))).alias("usable"),
    )


@query
def coverage_tags(spark, folder):
    p = windows.extract_pairs(feeds.completions(spark, folder))
    q, a = F.col("q_raw"), F.col("a_raw")
    return p.select(
        "doc_id", big("match_idx").alias("match_idx"), tags.question_intent(q).alias("asked"), tags.answer_intent(a).alias("intent"),
        tags.state(a).alias("state"), tags.ui_area(a).alias("ui_area"),
    )


@query
def replaced_rules(spark, folder):
    """Tags and checks of all pairs by rule lists that the user gives in place of the own ones."""
    rules = Rules(
        question_intents=((r"\bopen\b", "open"), (r"\bpage\b", "page")), answer_intents=((r"\bsubmit\b", "send"), (r"\bopen\b", "open")),
        default_intent="other", error_state=r"\bclose\b", ui_areas=((r"\bform\b", "form"), (r"\bpage\b", "page")), default_ui_area="none",
        ui_token=r"form|entry", single_step_verb=r"\blook\b",
    )
    p = windows.extract_pairs(feeds.completions(spark, folder), rules)
    q, a = F.col("q_raw"), F.col("a_raw")
    return p.select(
        "doc_id", big("match_idx").alias("match_idx"), tags.question_intent(q, rules.question_intents, rules.default_intent).alias("asked"),
        tags.answer_intent(a, rules.answer_intents, rules.default_intent).alias("intent"), tags.state(a, rules.error_state).alias("state"),
        tags.ui_area(a, rules.ui_areas, rules.default_ui_area).alias("ui_area"),
        v.is_too_vague(a, rules.vague_phrases, rules.ui_token, rules.single_step_verb).alias("vague"), v.is_misaligned(q, a, rules.ui_token).alias("misaligned"),
    )


@query
def tag_counts(spark, folder):
    p = windows.extract_pairs(feeds.completions(spark, folder))
    a = F.col("a_raw")
    tagged = p.select(
        tags.answer_intent(a).alias("intent"), tags.state(a).alias("state"),
        F.nullif(tags.ui_area(a), F.lit("listing")).alias("ui_area"),
    )
    return stats.tag_counts(tagged, ["intent", "state", "ui_area"])


# --- dedup --------------------------------------------------------------------
@query
def exact_dedup(spark, folder):
    return dedup.exact_first(read_table(spark, folder, "documents"), "doc_id", "text")


@query
def new_questions(spark, folder):
    """Conversation turns whose text is neither a document nor a later turn that was kept before."""
    turns = read_table(spark, folder, "conversations").select("conv_id", "turn", F.col("text").alias("question"))
    earlier = turns.filter("turn >= 2").select("question")
    earlier = earlier.union(read_table(spark, folder, "documents").select("text"))
    return dedup.not_seen_before(turns, "question", earlier).select("conv_id", "turn")


@query
def greedy_dedup(spark, folder):
    """First-wins over whole documents: same text, word sets at 0.92, then at 0.90 with source and language."""
    d = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "lang", "text")
    text = F.col("text")
    with_source = F.concat_ws(" ", "source", "lang", "text")
    tests = [
        (Similarity("q_text_sem_dup", "q_sig", 0.92), dedup.word_ids(text)),
        (Similarity("pair_sem_dup", "p_sig", 0.90), dedup.word_ids(with_source)),
    ]
    return dedup.first_wins(d, "doc_id", t.question_key(text), F.lower(with_source), tests)


@query
def paraphrase_dedup(spark, folder):
    """Questions of every document and their paraphrases, which live only with their parent."""
    return dedup.dedup_pairs(_families(spark, folder), "ord", "question", "answer", "parent")


def _families(spark, folder) -> DataFrame:
    r = _replies(spark, folder)
    parents = r.select(
        (F.col("doc_id") * 2).alias("ord"), F.lit(None).cast("bigint").alias("parent"),
        F.concat(F.lit("How do I open the page of "), F.col("w"), F.lit(" in the tool?")).alias("question"), F.col("a").alias("answer"),
    )
    children = r.select("doc_id", "a", F.explode(qa.paraphrases(F.col("raw_text"))).alias("question")).select(
        (F.col("doc_id") * 2 + 1).alias("ord"), (F.col("doc_id") * 2).alias("parent"), "question", F.col("a").alias("answer")
    )
    return parents.union(children)


@query
def dense_dedup(spark, folder):
    """First-wins over the given vectors at cosine 0.40."""
    e = read_table(spark, folder, "embeddings")
    key = F.col("vec_id").cast("string")
    test = (Similarity("q_text_sem_dup", "q_sig", 0.40, dense=True), dedup.unit(F.col("embedding")))
    return dedup.first_wins(e, "vec_id", key, key, [test])


def _letters(texts: pd.Series) -> pd.Series:
    """A stand-in for a sentence embedder: counts of the letters a to z."""
    return texts.map(lambda x: [float(x.count(c)) for c in "abcdefghijklmnopqrstuvwxyz"])


@query
def embedder_dedup(spark, folder):
    """First-wins over exchanges with the vectors of a user-supplied embedder."""
    e = feeds.exchanges(spark, folder).filter(F.col("answer").isNotNull())
    e = e.withColumn("ord", F.struct("conv_id", "turn"))
    rules = Rules(question_threshold=0.995, pair_threshold=0.9985)
    d = dedup.dedup_pairs(e, "ord", "question", "answer", None, rules, _letters)
    return d.select("ord.conv_id", "ord.turn", "status")


# --- sampling -----------------------------------------------------------------
@query
def rebalance(spark, folder):
    grown = sampling.rebalance(read_table(spark, folder, "labels"), F.col("doc_id"), "toxic", 1, 0.20)
    return grown.select("doc_id", big("toxic").alias("toxic"), "copy_no")


@query
def size_cap(spark, folder):
    d = read_table(spark, folder, "labels")
    grown = sampling.rebalance(d, F.col("doc_id"), "toxic", 1, 0.90)
    key = F.concat_ws(":", "doc_id", "copy_no")
    return sampling.cap_size(grown, key, d.count()).select("doc_id", "copy_no")


@query
def split_exact(spark, folder):
    return sampling.assign_split(read_table(spark, folder, "documents"), F.col("doc_id")).select("doc_id", "split")


@query
def split_grouped(spark, folder):
    d = read_table(spark, folder, "documents").withColumn("group", t.question_key(F.col("text")))
    return sampling.assign_split(d, F.col("doc_id"), group=F.md5("group")).select("doc_id", "split")


@query
def split_leaks(spark, folder):
    d = sampling.assign_split(read_table(spark, folder, "documents"), F.col("doc_id"))
    leaks = stats.split_leaks(d, "text")
    return leaks.select(F.md5("q_norm").alias("question"), F.array_join("splits", ",").alias("splits"), "rows")


@query
def pack_sequences(spark, folder):
    turns = read_table(spark, folder, "conversations").withColumn("id", F.concat_ws(":", "conv_id", "turn"))
    packed = sampling.pack_sequences(turns, "id", "text", 200)
    return packed.select("bin", "rows", "tokens", F.md5("text").alias("text"))


# --- records ------------------------------------------------------------------
@query
def build_messages(spark, folder):
    e = feeds.exchanges(spark, folder).filter(F.col("answer").isNotNull())
    r = e.select("conv_id", "turn", m.build_messages(F.col("question"), F.col("answer"), C.SYSTEM_TEXT).alias("messages"))
    r = r.select("conv_id", "turn", F.posexplode("messages").alias("pos", "m"))
    return r.select("conv_id", "turn", big("pos").alias("pos"), "m.role", "m.content")


@query
def convert_format(spark, folder):
    c = feeds.conversation_rows(spark, folder)
    r = c.select("conv_id", "turn", F.posexplode(m.convert_conversation(F.col("conversation"))).alias("pos", "m"))
    return r.select("conv_id", "turn", big("pos").alias("pos"), "m.role", "m.name", "m.content")


@query
def row_dispatch(spark, folder):
    """The three row forms, dispatched on their columns."""
    e = feeds.exchanges(spark, folder).filter(F.col("answer").isNotNull()).select("question", "answer")
    legacy = feeds.conversation_rows(spark, folder).select("conversation")
    current = legacy.select(F.col("conversation").alias("messages"))
    out = None
    for form, df in (("flat", e), ("legacy", legacy), ("current", current)):
        shaped = m.with_messages(df).select(
            F.lit(form).alias("form"), big(F.size("messages")).alias("turns"), m.first_of_role(F.col("messages"), "user").alias("user")
        )
        out = shaped if out is None else out.union(shaped)
    return out


@query
def sharegpt(spark, folder):
    name = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    c = feeds.conversation_rows(spark, folder)
    shared = F.transform("conversation", lambda x: F.struct(name(x["role"]).alias("from"), x["content"].alias("value")))
    r = c.select("conv_id", "turn", F.posexplode(m.from_sharegpt(shared)).alias("pos", "m"))
    return r.select("conv_id", "turn", big("pos").alias("pos"), "m.role", "m.content")


@query
def render_chat(spark, folder):
    c = feeds.conversation_rows(spark, folder)
    return c.select("conv_id", "turn", m.render_chat(F.col("conversation"), DATE).alias("text"))


@query
def render_conversations(spark, folder):
    """Whole conversations, with a thought on every third turn of the assistant."""
    thought = F.when((F.col("role") == "assistant") & (F.col("turn") % 3 == 0), F.concat(F.lit("Thought of turn "), F.col("turn")))
    turns = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", F.col("text").alias("content"), thought.alias("thinking"))
    return rendering.render_conversations(turns, "conv_id", "turn", DATE, ("thinking",), close_earlier=True)


@query
def render_prompt(spark, folder):
    e = feeds.exchanges(spark, folder)
    return e.select("conv_id", "turn", m.render_prompt(F.col("question"), C.SYSTEM_TEXT, DATE).alias("text"))


@query
def render_reasoning(spark, folder):
    """Exchanges whose answers carry a thought and a tool turn."""
    e = feeds.exchanges(spark, folder).filter(F.col("answer").isNotNull())
    calls = F.array(F.struct(F.lit("lookup").alias("name"), F.lit("{}").alias("arguments")))
    none = F.lit(None)

    def turn(role, content, thinking=none, tool=none, tool_calls=none):
        return F.struct(
            F.lit(role).alias("role"), content.alias("content"), thinking.cast("string").alias("thinking"),
            tool.cast("string").alias("tool_name"), tool_calls.cast("array<struct<name:string,arguments:string>>").alias("tool_calls"),
        )

    msgs = F.array(
        turn("user", F.col("question")), turn("assistant", F.lit(""), F.lit("Look it up."), none, calls),
        turn("tool", F.lit("found"), none, F.when(F.col("turn") % 4 == 0, "python").otherwise("lookup")),
        turn("assistant", F.when(F.col("turn") % 3 == 0, "").otherwise(F.col("answer")), F.lit("Now answer.")),
    )
    text = m.render_chat(F.col("msgs"), DATE, ("thinking", "tool_name", "tool_calls"), "high")
    return e.select("conv_id", "turn", msgs.alias("msgs")).select("conv_id", "turn", text.alias("text"))


@query
def training_text(spark, folder):
    e = feeds.exchanges(spark, folder).filter(F.col("answer").isNotNull()).select("question", "answer")
    return dataset.training_text(e, DATE, keep_messages=False)


# --- statistics and plans -----------------------------------------------------
@query
def corpus_stats(spark, folder):
    c = feeds.conversation_rows(spark, folder).withColumnRenamed("conversation", "messages")
    s = stats.corpus_stats(c)
    return s.select("total", F.round("avg_q_words", 6).alias("avg_q_words"), F.round("avg_a_words", 6).alias("avg_a_words"))


@query
def train_plan(spark, folder):
    return stats.training_plan(read_table(spark, folder, "documents"), ["lang"], 2)


@query
def step_totals(spark, folder):
    d = read_table(spark, folder, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return d.select("source", "n", stats.steps_for(F.col("n"), F.lit(2), F.lit(8), F.lit(3)).alias("steps"))


def _trials(spark, folder) -> DataFrame:
    """One trial per part: brand, number, params, value, state, metrics."""
    p = read_table(spark, folder, "part")
    k = F.col("p_partkey")
    params = F.when(k % 2 == 0, F.create_map(F.lit("per_device_bs"), F.col("p_size").cast("double"), F.lit("learning_rate"), F.col("p_size") / 1000.0))
    params = params.otherwise(F.create_map(F.lit("epochs"), (F.col("p_size") % 5 + 1).cast("double"), F.lit("weight_decay"), F.lit(0.1)))
    value = F.when(k % 10 == 0, F.lit(float("inf"))).when(k % 11 == 0, F.lit(float("nan"))).otherwise(F.floor(F.col("p_retailprice") / 10).cast("double"))
    return p.select(
        F.col("p_brand").alias("brand"), k.cast("int").alias("number"), params.alias("params"), value.alias("value"),
        F.when(k % 7 == 0, "FAIL").otherwise("COMPLETE").alias("state"),
        F.when(k % 3 == 0, F.create_map(F.lit("eval_runtime"), F.col("p_size").cast("double"), F.lit("eval_loss"), F.col("p_retailprice")))
        .otherwise(F.create_map(F.lit("accuracy"), F.col("p_retailprice"), F.lit("other"), F.lit(1.0))).alias("metrics"),
    )


@query
def best_trial(spark, folder):
    return stats.best_trial(_trials(spark, folder), ["brand"]).select("brand", big("number").alias("number"), "value")


@query
def trial_value(spark, folder):
    r = _trials(spark, folder)
    loss = stats.eval_loss(F.col("metrics"))
    return r.select(
        big("number").alias("number"), stats.trial_value(F.col("metrics")).alias("value"), (loss == float("inf")).alias("unset")
    )


@query
def final_plan(spark, folder):
    plan = stats.training_plan(read_table(spark, folder, "part").withColumnRenamed("p_brand", "brand"), ["brand"], 2)
    best = stats.best_trial(_trials(spark, folder), ["brand"])
    return stats.final_plan(plan, best, ["brand"], 2)


# --- files --------------------------------------------------------------------
@query
def jsonl_roundtrip(spark, folder):
    path = new_folder(spark, "records") + ".jsonl"
    files.write_jsonl(feeds.conversation_rows(spark, folder), path)
    rows = files.read_records(spark, path, f"conv_id bigint, turn bigint, conversation {m.MESSAGES}")
    r = rows.select("conv_id", "turn", F.posexplode("conversation").alias("pos", "m"))
    return r.select("conv_id", "turn", big("pos").alias("pos"), "m.role", "m.content")


@query
def converted_splits(spark, folder):
    """Write all splits, convert each to the new form, read all of them back."""
    src, out = new_folder(spark, "splits"), new_folder(spark, "converted")
    rows = sampling.assign_split(
        feeds.conversation_rows(spark, folder).withColumn("id", F.concat_ws(":", "conv_id", "turn")), F.col("id")
    )
    for name in files.SPLITS:
        files.write_jsonl(rows.filter(F.col("split") == name).select("conversation"), f"{src}/{name}.jsonl")
    result = None
    for name in files.convert_splits(spark, src, out):
        part = files.load_split(spark, out, name, f"messages {m.NAMED_MESSAGES}")
        part = part.select(F.lit(name).alias("split"), F.explode("messages").alias("m")).select("split", "m.role", "m.name", "m.content")
        result = part if result is None else result.union(part)
    return result


@query
def saved_splits(spark, folder):
    path = new_folder(spark, "dataset")
    rows = sampling.assign_split(read_table(spark, folder, "documents"), F.col("doc_id")).select("doc_id", "lang", "split")
    files.write_splits(rows, path)
    back = files.read_splits(spark, path, "doc_id bigint, lang string")
    return back.groupBy("split", "lang").agg(F.count("*").alias("rows"))


@query
def saved_completions(spark, folder):
    path = new_folder(spark, "completions")
    c = feeds.completions(spark, folder).select(
        F.concat(F.lit("/in/part"), (F.col("doc_id") % 5).cast("string"), F.lit(".v1.docx")).alias("doc_path"),
        F.col("doc_id").alias("window_index"), "raw_text",
    )
    files.write_completions(c, path)
    back = spark.read.schema("window_index bigint, raw_text string, doc_stem string").json(path)
    return back.select("doc_stem", "window_index", F.md5("raw_text").alias("raw"))


@query
def saved_trials(spark, folder):
    path = new_folder(spark, "trials") + ".jsonl"
    files.save_trials(_trials(spark, folder), path)
    back = files.load_trials(spark, path)
    return back.select(big("number").alias("number"), "value", F.try_element_at("params", F.lit("epochs")).alias("epochs"))


def _reply(prompts: pd.Series) -> pd.Series:
    """A stand-in for a language model; gives up on some prompts and fails on others."""
    if (prompts.str.len() % 11 == 0).any():
        raise RuntimeError("the model is out of reach")
    return prompts.map(lambda p: None if len(p) % 7 == 0 else "Q: What is it?\nA: " + p)


@query
def generate_completions(spark, folder):
    d = read_table(spark, folder, "documents").select("doc_id", "text")
    made = files.generate(d, "text", _reply, 2)
    return made.select("doc_id", big("cand_idx").alias("cand_idx"), F.md5("raw_text").alias("raw"))


@query
def scan_files(spark, folder):
    """Pages written as files of 256 numbers each, in two depths and two endings, then listed and read whole by their ending."""
    root = new_folder(spark, "files")
    kind = F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(3))
    block = F.coalesce(F.floor(F.col("page_id") / 256), F.lit(-1))
    pages = read_table(spark, folder, "pages").select("page_id", "html", kind.alias("kind"), block.alias("block"))

    def files_of(n: int):
        own = pages.filter(F.col("kind") == n).repartition("block").sortWithinPartitions("block", "page_id")
        return own.select("html", "block").write.partitionBy("block")

    files_of(0).text(f"{root}/near")
    files_of(1).text(f"{root}/far/and/deep")
    files_of(2).json(f"{root}/other")
    found = files.scan_documents(spark, root, (".TXT", ".Json"))
    path = F.col("doc_path")
    return found.select(
        F.regexp_extract(path, r"/block=(-?\d+)/", 1).cast("bigint").alias("block"), F.regexp_extract(path, r"\.(\w+)$", 1).alias("ending"),
        F.contains(path, F.lit("/deep/")).alias("deep"), "length", F.md5("content").alias("content"),
    )


@query
def json_arrays(spark, folder):
    """Conversations written as files that hold one JSON array each, 64 conversations by 64 turns at most, and read back."""
    path = new_folder(spark, "arrays") + ".json"
    rows = feeds.conversation_rows(spark, folder).withColumns({"part": F.floor(F.col("conv_id") / 64), "span": F.floor(F.col("turn") / 64)})
    arrays = rows.groupBy("part", "span").agg(F.to_json(F.collect_list(F.struct("conv_id", "turn", "conversation"))).alias("value"))
    arrays.write.partitionBy("part", "span").text(path)
    back = files.read_records(spark, path, f"conv_id bigint, turn bigint, conversation {m.MESSAGES}, part bigint, span bigint")
    r = files.require_columns(back, "conversation").select("conv_id", "turn", F.posexplode("conversation").alias("pos", "m"))
    return r.select("conv_id", "turn", big("pos").alias("pos"), "m.role", "m.content")


def _measure(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": pdf["doc_id"], "letters": pdf["text"].str.len().astype("int64")})


@query
def batched_rows(spark, folder):
    """A user's function over batches of documents."""
    return files.map_batches(read_table(spark, folder, "documents").select("doc_id", "text"), _measure, "doc_id bigint, letters bigint")


# --- the whole flow -----------------------------------------------------------
def _flow_input(spark, folder):
    src = feeds.completions(spark, folder).select(
        F.lpad((F.col("doc_id") % 50).cast("string"), 3, "0").alias("doc_path"),
        F.floor(F.col("doc_id") / 50).cast("int").alias("window_index"),
        "c1", "c2", "src_after", "src_next", "raw_text",
    )
    windows_ = src.drop("raw_text").withColumn("chunk_pairing", F.array("window_index", F.col("window_index") + 1))
    answers = src.select("doc_path", "window_index", F.lit(0).alias("cand_idx"), "raw_text")
    return windows_, answers


def _flow(spark, folder):
    return dataset.build_dataset(*_flow_input(spark, folder))


@query
def training_records(spark, folder):
    """Records of all valid pairs: lineage, tags and messages."""
    checked = dataset.validated_pairs(*_flow_input(spark, folder)).filter(F.col("drop_reason").isNull())
    r = dataset.records(dataset.with_paraphrases(checked, None))
    content = lambda i: F.get("messages", F.lit(i))["content"]
    return r.select(
        "meta.doc_path", big("meta.window_index").alias("window_index"), big("ord.match_idx").alias("match_idx"),
        big("ord.split_idx").alias("split_idx"), big(F.get("meta.chunk_pairing", F.lit(1))).alias("pair_end"),
        "meta.intent", "meta.state", "meta.ui_area", content(0).alias("system"), content(1).alias("user"), content(2).alias("assistant"),
    )


@query
def dataset_splits(spark, folder):
    """Rows and mean words per split after the whole flow."""
    built, _ = _flow(spark, folder)
    s = stats.corpus_stats(built, by=["split"])
    return s.select("split", "total", F.round("avg_q_words", 6).alias("avg_q_words"), F.round("avg_a_words", 6).alias("avg_a_words"))


@query
def dataset_drops(spark, folder):
    """Drop reasons of the whole flow, dedup included."""
    return _flow(spark, folder)[1]


def _author(prompts: pd.Series) -> pd.Series:
    """A stand-in for a language model: one of the shapes, filled with the first text of the prompt; fails for some prompts."""
    if any(zlib.crc32(p.encode()) % 13 == 0 for p in prompts):
        raise RuntimeError("the model is out of reach")

    def write(prompt: str) -> str:
        text = prompt.split("First text:\n", 1)[1].split("\n\nSecond text:\n", 1)[0]
        line, rows = re.sub(r"[\x00-\x20]+", " ", text).strip(), [x for x in text.split("\n") if x]
        fields = {
            "{W}": line, "{J}": line.replace("\\", "\\\\").replace('"', '\\"'), "{T}": text,
            "{S}": "\n".join(f"{n}. Open {x}" for n, x in enumerate(rows, 1)), "{L}": "\n".join(f"Open {x}" for x in rows),
        }
        shape = TEMPLATES[zlib.crc32(text.encode()) % len(TEMPLATES)][0]
        return re.sub("|".join(map(re.escape, fields)), lambda f: fields[f.group()], shape)

    return prompts.map(write)


def _rephrase(prompts: pd.Series) -> pd.Series:
    """A stand-in that gives back the question itself, the question in other words, or nothing of use."""

    def write(prompt: str) -> str:
        q = prompt.split("\n\n", 1)[1].strip()
        return (f"Q1: {q}", f"Q1: And in other words than before, {q}", "No idea.")[zlib.crc32(q.encode()) % 3]

    return prompts.map(write)


def _pages_flow(spark, folder):
    pages = read_table(spark, folder, "pages").select("page_id", "html")
    return dataset.dataset_from_pages(pages, "page_id", "html", _author, _rephrase)


@query
def pages_dataset(spark, folder):
    """Every record of the flow from pages: its place, copy, split (by question with its paraphrases) and texts."""
    built, _ = _pages_flow(spark, folder)
    at = F.from_json("record_id", "doc_path string, window_index int, match_idx int, split_idx int, para_idx int")
    content = lambda i: F.get("messages", F.lit(i))["content"]
    return built.select(
        at.alias("r"), big("copy_no").alias("copy_no"), "split", content(1).alias("user"), F.md5(content(2)).alias("assistant"), "meta.intent", "meta.state", "meta.ui_area",
    ).select("r.*", "copy_no", "split", "user", "assistant", "intent", "state", "ui_area")


@query
def pages_drops(spark, folder):
    """Drop reasons of the flow from pages, those of paraphrases included."""
    return _pages_flow(spark, folder)[1]
