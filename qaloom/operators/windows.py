"""Chunks, context windows and the choice among completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.qa import completion_score, parse_pairs
from ..functions.text import approx_tokens, clip_tokens, format_prompt, let, strip
from ..rules import Rules
from ..storage import materialize

#: rows of one document that one window partition may hold
BLOCK_ROWS = 4096


def chunk_lines(df: DataFrame, doc: str, text: str, lines: int) -> DataFrame:
    """Cut a text into chunks of ``lines`` lines. Stays inside the row, no shuffle."""

    def cut(rows: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / lines).cast("int"))
        return F.transform(starts, lambda i: F.array_join(F.slice(rows, i * lines + 1, F.lit(lines)), "\n"))

    chunks = let(F.split(F.col(text), "\n"), cut)
    return df.select(doc, F.posexplode(chunks).alias("chunk_idx", "text"))


def next_rows(df: DataFrame, doc: str, idx: str, columns: dict[str, tuple[str, int]]) -> DataFrame:
    """Add look-ahead columns ``{name: (column, distance)}`` over dense positions of a document.

    A plain window over the document would put the longest document into one task. Here the
    window runs over blocks of a document, and the first rows of a block are also given to the
    block before it, so that the result is the same and no partition exceeds a block.
    """
    reach = max(d for _, d in columns.values())
    block = F.floor(F.col(idx) / BLOCK_ROWS).cast("bigint")
    head = (F.col(idx) % BLOCK_ROWS < reach) & (block > 0)
    spread = df.withColumn(
        "_block", F.explode(F.when(head, F.array(block, block - 1)).otherwise(F.array(block)))
    )
    w = Window.partitionBy(doc, "_block").orderBy(idx)
    for name, (column, distance) in columns.items():
        spread = spread.withColumn(name, F.lead(column, distance).over(w))
    return spread.filter(F.col("_block") == F.floor(F.col(idx) / BLOCK_ROWS)).drop("_block")


def chunk_pairing(idx: Column, following: Column) -> Column:
    return F.array(idx, F.when(following.isNotNull(), idx + 1).otherwise(idx)).cast("array<int>")


def context_windows(chunks: DataFrame, doc: str = "doc_path", rules: Rules = Rules()) -> DataFrame:
    """One row per chunk with the chunk (c1), the next (c2, the chunk itself at the end) and the one after (c3).

    c1 and c2 are cut to the content budget. c2 never exceeds what c1 leaves of it, so the
    budget holds without a further cut.
    """
    ahead = next_rows(chunks, doc, "chunk_idx", {"_next": ("text", 1), "_after": ("text", 2)})
    budget = rules.content_budget
    half = budget // 2
    return (
        ahead.withColumn("c1", clip_tokens(F.col("text"), min(half, budget - 1000)))
        .withColumn(
            "c2",
            clip_tokens(
                F.coalesce("_next", "text"),
                F.greatest(F.lit(0), F.least(F.lit(half), F.lit(budget) - approx_tokens(F.col("c1")))),
            ),
        )
        .select(
            doc,
            F.col("chunk_idx").alias("window_index"),
            "c1",
            "c2",
            F.coalesce("_after", F.lit("")).alias("c3"),
            chunk_pairing(F.col("chunk_idx"), F.col("_next")).alias("chunk_pairing"),
        )
    )


def with_prompt(windows: DataFrame, template: str, rules: Rules = Rules()) -> DataFrame:
    """Add the prompt; when it overflows the context, the second chunk is given up and the first cut.

    Also adds the tails of the following chunks that the validators look at.
    """
    full = format_prompt(template, c1=F.col("c1"), c2=F.col("c2"))
    short = format_prompt(template, c1=clip_tokens(F.col("c1"), rules.overflow_clip), c2=F.lit(""))
    return (
        windows.withColumn("_over", approx_tokens(full) > rules.context_tokens - 512)
        .withColumn("prompt", F.when(F.col("_over"), short).otherwise(full))
        .withColumn("c2", F.when(F.col("_over"), F.lit("")).otherwise(F.col("c2")))
        .withColumn("src_after", F.substring("c2", 1, rules.after_chars))
        .withColumn("src_next", F.substring("c3", 1, rules.next_chars))
        .drop("_over")
    )


def best_completion(completions: DataFrame, keys: list[str], rules: Rules = Rules()) -> DataFrame:
    """The completion with the highest score per window, the earliest on ties.

    Candidates are scored in one pass and ranked as numbers, which each task does first by itself; whole texts meet only
    the numbers of the winners. ``cand_idx`` is unique in a window; null keys are windows like others.
    """
    raw = F.col("raw_text")
    scored = completions.select(*keys, "cand_idx", completion_score(raw, parse_pairs(raw, rules.strict_markers), rules.ui_token).alias("score"))
    rank = F.struct("score", (-F.col("cand_idx")).alias("early"))
    best = scored.groupBy(*keys).agg(F.max(rank).alias("b"))
    best = materialize(best.select(*[F.col(k).alias(f"_{k}") for k in keys], (-F.col("b.early")).alias("_cand"), F.col("b.score").alias("score")), "best")
    own = F.col("cand_idx") == F.col("_cand")
    for k in keys:
        own = own & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return completions.join(best, own).select(*keys, "cand_idx", "score", "raw_text")


def best_of_list(raw_texts: Column, rules: Rules = Rules()) -> Column:
    """The text with the highest score of an array, the earliest on ties; null if there is none. Equal texts are scored once."""
    def rated(raw: Column, i: Column) -> Column:
        score = completion_score(raw, parse_pairs(raw, rules.strict_markers), rules.ui_token)
        return F.struct(score.alias("score"), (-i).alias("early"), raw.alias("raw_text"))

    return F.array_max(F.transform(F.array_distinct(raw_texts), rated))["raw_text"]


def extract_pairs(completions: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per pair of a completion, with its position ``match_idx``."""
    pairs = parse_pairs(F.col("raw_text"), rules.strict_markers)
    keep = [c for c in completions.columns if c != "raw_text"]
    return completions.select(*keep, F.posexplode(pairs).alias("match_idx", "_p")).select(
        *keep, "match_idx", F.col("_p.question").alias("q_raw"), F.col("_p.ans").alias("a_raw")
    )


def dense_positions(df: DataFrame, doc: str, idx: str) -> DataFrame:
    """Renumber ``idx`` from 0 without gaps within a document; a null document is one of its own.

    Only the counts per block of a document (one per ``BLOCK_ROWS`` positions) are summed over the
    whole document; rows are numbered inside their block.
    """
    blocked = df.withColumn("_block", F.floor(F.col(idx) / BLOCK_ROWS).cast("bigint"))
    over = Window.partitionBy(doc).orderBy("_block")
    starts = blocked.groupBy(doc, "_block").agg(F.count("*").alias("_n")).select(
        F.col(doc).alias("_doc"), F.col("_block").alias("_of"), (F.sum("_n").over(over) - F.col("_n")).alias("_start")
    )
    inside = F.row_number().over(Window.partitionBy(doc, "_block").orderBy(idx)) - 1
    return (
        blocked.withColumn("_in", inside)
        .join(starts, F.col(doc).eqNullSafe(F.col("_doc")) & (F.col("_block") == F.col("_of")))
        .withColumn(idx, (F.col("_start") + F.col("_in")).cast(df.schema[idx].dataType))
        .drop("_block", "_in", "_doc", "_of", "_start")
    )


def merge_chunks(chunks: DataFrame, doc: str, count: int) -> DataFrame:
    """Every ``count`` consecutive chunks as one, blank members skipped, empty results dropped.

    The results are numbered anew as ``chunk_idx`` without gaps, as :func:`context_windows` takes them.
    """
    text = strip(F.col("text"))
    kept = chunks.select(
        doc, "chunk_idx", F.floor(F.col("chunk_idx") / count).cast("int").alias("_merged"), text.alias("text")
    ).filter(F.col("text") != "")
    members = F.sort_array(F.collect_list(F.struct("chunk_idx", "text")))
    merged = kept.groupBy(doc, F.col("_merged").alias("merged")).agg(
        F.array_join(F.transform(members, lambda m: m["text"]), "\n\n").alias("text")
    )
    return dense_positions(merged.select(doc, F.col("merged").alias("chunk_idx"), "text"), doc, "chunk_idx")
