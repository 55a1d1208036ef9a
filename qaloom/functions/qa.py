"""From raw completions to question/answer pairs and the terms used to check them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C
from .text import count_some, find_all, find_some, holds, let, matches, renumber, split_lines, step_count, strip, sub, word_count

PAIRS = "array<struct<question:string,ans:string>>"


# --- parsing ------------------------------------------------------------------
def pairs_from_text(raw: Column, strict: bool = False) -> Column:
    """Marked pairs of a text; one pass of the pattern sets marks around both groups, which are cut apart there."""
    pattern = C.QA_BLOCK_STRICT if strict else C.QA_BLOCK

    def pair(part: Column) -> Column:
        both = F.substring_index(part, "\x03", 1)
        return F.struct(F.substring_index(both, "\x02", 1).alias("question"), F.substring_index(both, "\x02", -1).alias("ans"))

    # bound once: the slice reads the parts twice
    cut = let(
        F.split(sub(raw, pattern, "\x01$1\x02$2\x03"), "\x01"),
        lambda parts: F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), pair),
    )
    # a text that has such marks itself is read by its groups
    zipped = F.arrays_zip(
        find_all(raw, pattern, 1).alias("question"), find_all(raw, pattern, 2).alias("ans")
    )
    return F.when(holds(raw, "\x01\x02\x03"), zipped.cast(PAIRS)).otherwise(cut.cast(PAIRS))


def pairs_from_json(raw: Column) -> Column:
    """Pairs of a JSON array of ``{question, ans}``; null when the text is no such array."""
    return F.when(raw.rlike(r"\A\s*\["), F.from_json(raw, PAIRS))


def parse_pairs(raw: Column, strict: bool = False) -> Column:
    """JSON first, then marked text."""
    parsed = F.filter(pairs_from_json(raw), lambda p: p.isNotNull())
    return let(parsed, lambda own: F.when(F.size(own) > 0, own).otherwise(pairs_from_text(raw, strict)))


def completion_score(raw: Column, pairs: Column, ui_token: str = C.UI_TOKEN) -> Column:
    """Reward pairs, steps (up to six per answer) and interface words; punish vague wording."""
    def rated(own: Column) -> Column:
        steps = F.aggregate(
            own, F.lit(0), lambda acc, p: acc + F.least(F.coalesce(step_count(p["ans"]), F.lit(0)), F.lit(6))
        )
        return (
            F.lit(2.0) * F.size(own)
            + F.lit(0.30) * steps
            + let(F.lower(raw), words)
        )

    def words(low: Column) -> Column:
        return F.lit(0.15) * count_some(raw, ui_token, low) - F.lit(1.0) * count_some(low, C.VAGUE_SCORE_WORDS)

    return let(pairs, rated)


# --- add / remove split -------------------------------------------------------
def split_add_remove(question: Column, answer: Column) -> Column:
    """One pair, or an add pair and a remove pair that share the neutral steps around them.

    The step that decides is the first one that adds or removes and is not a navigation step:
    before it, navigation and plain steps are the shared prefix; every save-type step, and
    every plain step after it, belongs to the shared suffix.
    """
    steps = F.transform(
        F.filter(split_lines(answer), lambda x: x.rlike(C.STEP_NUMBER)),
        lambda x: F.struct(
            x.alias("line"),
            matches(F.lower(x), C.ADD_STEP).alias("add"),
            matches(F.lower(x), C.REMOVE_STEP).alias("rem"),
            x.rlike(C.NEUTRAL_STEP).alias("neutral"),
            matches(x, C.COMMON_SUFFIX_STEP).alias("common"),
        ),
    )
    some = let(steps, lambda s: let(_turning_point(s), lambda turn: _add_remove_pairs(question, answer, s, turn)))
    whole = F.array(F.struct(question.alias("question"), renumber(answer).alias("ans"))).cast(PAIRS)
    possible = holds(F.lower(answer), C.PIECES[C.ADD_STEP] + C.PIECES[C.REMOVE_STEP])
    return F.when(~possible, whole).otherwise(some)


def _turning_point(steps: Column) -> Column:
    at = F.array_position(F.transform(steps, lambda s: ~s["neutral"] & (s["add"] | s["rem"])), F.lit(True))
    return F.when(at == 0, F.size(steps) + 1).otherwise(at) - 1


def _add_remove_pairs(question: Column, answer: Column, steps: Column, turn: Column) -> Column:
    def pick(test):
        return F.filter(steps, test)

    prefix = pick(lambda s, i: (i < turn) & (s["neutral"] | ~s["common"]))
    adds = pick(lambda s, i: (i >= turn) & s["add"])
    removes = pick(lambda s, i: (i >= turn) & ~s["add"] & s["rem"])
    suffix = pick(
        lambda s, i: ((i < turn) & ~s["neutral"] & s["common"]) | ((i > turn) & ~s["add"] & ~s["rem"])
    )

    def joined(own: Column) -> Column:
        lines = F.transform(F.concat(prefix, own, suffix), lambda s: s["line"])
        return renumber(F.array_join(lines, "\n"))

    def pair(q: Column, a: Column) -> Column:
        return F.struct(q.alias("question"), a.alias("ans"))

    add_pair = pair(F.regexp_replace(question, C.TO_ADD, "add"), joined(adds))
    rem_pair = pair(F.regexp_replace(question, C.TO_REMOVE, "remove"), joined(removes))
    has_add, has_rem = F.size(adds) > 0, F.size(removes) > 0
    return (
        F.when(has_add & has_rem, F.array(add_pair, rem_pair))
        .when(has_add, F.array(add_pair))
        .when(has_rem, F.array(rem_pair))
        .otherwise(F.array(pair(question, renumber(answer))))
    ).cast(PAIRS)


# --- steps of a source --------------------------------------------------------
def normalize_step(step: Column) -> Column:
    low = F.regexp_replace(F.lower(step), r"(?U)\A\s*\d+\.\s*", "")
    return F.trim(F.regexp_replace(low, "[^a-z0-9]+", " "))


def step_candidates(source: Column) -> Column:
    """Step-like lines, white space collapsed, ten characters or more, first of each spelling."""
    lines = F.transform(
        find_all(source, C.STEP_CANDIDATE), lambda s: F.regexp_replace(strip(s), r"(?U)\s+", " ")
    )
    lines = F.filter(lines, lambda s: F.length(s) >= 10)
    spelled = F.array_sort(F.transform(lines, lambda s, i: F.struct(F.lower(s).alias("low"), i.alias("at"), s.alias("line"))))

    def first(rows: Column) -> Column:
        """Of rows sorted by spelling, the first of each, in the order of the text."""
        own = F.filter(rows, lambda r, i: (i == 0) | (F.get(rows, i - 1)["low"] != r["low"]))
        return F.transform(F.array_sort(F.transform(own, lambda r: F.struct(r["at"].alias("at"), r["line"].alias("line")))), lambda r: r["line"])

    return let(spelled, first)


def source_steps(source: Column) -> Column:
    lowered = F.transform(
        find_all(source, C.STEP_CANDIDATE), lambda s: F.lower(F.regexp_replace(strip(s), r"(?U)\s+", " "))
    )
    return F.transform(F.array_distinct(F.filter(lowered, lambda s: F.length(s) >= 10)), normalize_step)


def answer_steps(answer: Column) -> Column:
    return find_all(answer, C.STEP_NUMBER_BODY, 1)


def ui_terms(answer: Column) -> Column:
    """Lower-cased labels, button words and widget words of an answer."""
    labels = F.filter(F.transform(find_some(answer, C.UI_LABEL, 1), strip), lambda t: t != "")
    words = let(F.lower(answer), lambda low: F.concat(*[find_some(answer, p, 1, low) for p in (C.UI_BUTTON_WORD, C.UI_WIDGET_WORD)]))
    return F.array_distinct(F.transform(F.concat(labels, words), lambda t: F.lower(t)))


# --- paraphrases --------------------------------------------------------------
def paraphrases(raw: Column, keep: int = 1) -> Column:
    """Usable questions among the ``Qn:`` lines, the first ``keep`` of them."""
    lines = F.transform(find_all(raw, C.PARAPHRASE_LINE, 1), strip)
    good = F.filter(
        lines,
        lambda c: (c != "")
        & (c.endswith("?") | c.rlike(C.PARAPHRASE_VERB))
        & (word_count(c) >= 6)
        & ~c.rlike(C.PARAPHRASE_STEPS_TO),
    )
    return F.slice(good, 1, keep)
