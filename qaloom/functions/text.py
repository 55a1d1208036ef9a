"""Scalar text functions. Every function maps Columns to a Column and stays in the JVM."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C

#: the single characters of LINE_BREAKS but the newline
OTHER_BREAKS = "\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029"


def let(value: Column, body) -> Column:
    """Bind a value to a variable, so that a body which reads it many times computes it once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scan(items: Column, start: Column, step, kind: str, block: int = 256) -> Column:
    """Walk an array with a state: ``step(state, item)`` gives the next state and an output.

    Returns a struct of the last ``state`` and ``out``, the outputs that are not null, an array of ``kind``. Outputs are
    gathered in blocks, as an array that grows by one item at a time would be copied as often. A null array gives null.
    """
    none = F.array().cast(f"array<{kind}>")
    count = F.ceil(F.size(items) / block).cast("int")
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).when(items.isNotNull(), F.array().cast("array<int>"))

    def one(acc: Column, item: Column) -> Column:
        state, out = step(acc["state"], item)
        return let(out, lambda o: F.struct(state.alias("state"), F.when(o.isNull(), acc["out"]).otherwise(F.array_append(acc["out"], o)).alias("out")))

    def many(acc: Column, at: Column) -> Column:
        part = F.aggregate(F.slice(items, at * block + 1, F.lit(block)), F.struct(acc["state"].alias("state"), none.alias("out")), one)
        return let(part, lambda p: F.struct(p["state"].alias("state"), F.array_append(acc["out"], p["out"]).alias("out")))

    begin = F.struct(start.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out"))
    return F.aggregate(starts, begin, many, lambda acc: F.struct(acc["state"].alias("state"), F.flatten(acc["out"]).alias("out")))


# --- small regex helpers ------------------------------------------------------
def sub(text: Column, pattern: str, replacement: str = "") -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(replacement))


def find_all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def holds(text: Column, pieces) -> Column:
    """Does a text contain one of some literal pieces? Looks at bytes, far quicker than a pattern."""
    return reduce(Column.__or__, [F.contains(text, F.lit(p)) for p in pieces])


def may_match(text: Column, pattern: str, low: Column | None = None) -> Column | None:
    """False where no match is possible, by the pieces of a fixed pattern; None for any other pattern. ``low`` is the text in lower case."""
    pieces = C.PIECES.get(pattern)
    if pieces is None:
        return None
    flags = re.match(r"\(\?(\w+)\)", pattern)
    if not flags or "i" not in flags[1]:
        return holds(text, pieces)
    return let(F.lower(text), lambda own: holds(own, pieces)) if low is None else holds(low, pieces)


def matches(text: Column, pattern: str, low: Column | None = None) -> Column:
    """``rlike``, tried only where a match is possible."""
    possible = may_match(text, pattern, low)
    return text.rlike(pattern) if possible is None else possible & text.rlike(pattern)


def sub_some(text: Column, pattern: str, replacement: str = "", low: Column | None = None) -> Column:
    """``sub`` of a fixed pattern, tried only where a match is possible."""
    return let(text, lambda own: F.when(~may_match(own, pattern, low), own).otherwise(sub(own, pattern, replacement)))


def find_some(text: Column, pattern: str, group: int = 0, low: Column | None = None) -> Column:
    """``find_all`` of a fixed pattern, tried only where a match is possible."""
    return F.when(~may_match(text, pattern, low), F.array().cast("array<string>")).otherwise(find_all(text, pattern, group))


def count_some(text: Column, pattern: str, low: Column | None = None) -> Column:
    """``count_of``, tried only where a match is possible."""
    possible = may_match(text, pattern, low)
    return count_of(text, pattern) if possible is None else F.when(~possible, 0).otherwise(count_of(text, pattern))


def strip(text: Column) -> Column:
    """Trim any Unicode white space, not only the blanks that ``trim`` removes."""
    return F.btrim(text, F.lit(C.WHITE_SPACE))


def split_lines(text: Column) -> Column:
    """Lines at any line break; a final break opens no further line."""
    def cut(own: Column) -> Column:
        any_break = F.split(sub(own, f"(?:{C.LINE_BREAKS})\\z"), C.LINE_BREAKS)
        plain = F.split(F.when(own.endswith("\n"), F.substring(own, F.lit(1), F.length(own) - 1)).otherwise(own), "\n")
        return F.when(holds(own, OTHER_BREAKS), any_break).otherwise(plain)

    return let(text, cut)


def unify_breaks(text: Column) -> Column:
    """Every line break as a newline, none at the end."""
    return let(text, lambda own: F.when(holds(own, [*OTHER_BREAKS, "\n"]), F.array_join(split_lines(own), "\n")).otherwise(own))


def words(text: Column) -> Column:
    """White-space separated words."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


# --- sizes --------------------------------------------------------------------
def approx_tokens(text: Column) -> Column:
    """A quarter of the characters, rounded up, at least one."""
    return F.greatest(F.lit(1).cast("bigint"), F.ceil(F.length(text) / 4))


def clip_tokens(text: Column, tokens: Column | int) -> Column:
    tokens = tokens if isinstance(tokens, Column) else F.lit(tokens)
    return F.substring(text, F.lit(1), (tokens * 4).cast("int"))


# --- normalisation ------------------------------------------------------------
def squeeze(text: Column) -> Column:
    """Tabs to blanks, any run of two or more white-space characters to one blank, trimmed."""
    return strip(sub(F.replace(text, F.lit("\t"), F.lit(" ")), r"(?U)\s{2,}", " "))


def strip_emphasis(text: Column) -> Column:
    return strip(F.when(~F.contains(text, F.lit("*")), text).otherwise(sub(text, r"(?d)\A\*+|\*+$")))


def clean_question(text: Column) -> Column:
    def without_mark(s: Column) -> Column:
        return F.when(s.endswith("**"), F.substring(s, F.lit(1), F.length(s) - 2)).otherwise(s)

    return strip(let(squeeze(strip_emphasis(text)), without_mark))


def clean_answer(text: Column, corrections: dict[str, str] = C.ANSWER_CORRECTIONS) -> Column:
    for wrong, right in corrections.items():
        text = F.replace(text, F.lit(wrong), F.lit(right))
    return squeeze(text)


def question_key(text: Column) -> Column:
    """Form under which two questions count as the same text."""
    return sub(sub(strip(F.lower(text)), r"[!-/:-@\[-`{-~]+"), r"(?U)\s+", " ")


# --- block cleaning -----------------------------------------------------------
def is_noise_line(line: Column) -> Column:
    def noise(s: Column) -> Column:
        head = F.lower(F.substring(s, 1, 5))
        return (
            (s == "")
            | s.rlike(C.BULLETS_ONLY)
            | ((head == "click") & F.lower(s).rlike(C.BARE_CLICK))
            | (head.rlike(C.NOTE_START) & ~s.rlike(C.NOTE_ACTION))
        )

    return let(strip(line), noise)


def clean_block(text: Column) -> Column:
    kept = strip(F.array_join(F.filter(F.split(text, "\n"), lambda x: ~is_noise_line(x)), "\n"))
    kept = sub_some(sub(kept, C.EMPTY_NUMBERED_LINE), C.TRAILING_DOTS, ".")
    return strip(F.array_join(F.filter(F.split(kept, "\n"), lambda x: ~x.rlike(C.BULLETS_ONLY)), "\n"))


def strip_meta(text: Column) -> Column:
    return strip(sub_some(text, C.META_REMARK))


def scrub_ui_refs(text: Column) -> Column:
    plain = sub_some(sub_some(text, C.ANGLE_IMAGE), C.POINTER_PHRASE)
    return strip(sub(plain, r"(?U)\s{2,}", " "))


# --- bullets and steps --------------------------------------------------------
def _expanded_line(line: Column) -> Column:
    colon = F.instr(line, ":")
    head = strip(F.substring(line, F.lit(1), colon - 1))
    parts = F.filter(
        F.transform(F.split(F.substring(line, colon + 1, F.length(line)), C.INLINE_BULLET_SPLIT), strip),
        lambda p: p != "",
    )

    def built(parts: Column) -> Column:
        body = F.array_join(F.transform(parts, lambda p: F.concat(F.lit("   - "), p)), "\n")
        return F.when(F.size(parts) >= 2, F.concat(head, F.lit(":\n"), body)).otherwise(line)

    return F.when((colon > 0) & line.rlike(C.INLINE_BULLET), let(parts, built)).otherwise(line)


def expand_inline_bullets(text: Column) -> Column:
    """``head: * a * b`` becomes a head line and one indented line per bullet."""
    def expanded(own: Column) -> Column:
        lines = F.array_join(F.transform(split_lines(own), _expanded_line), "\n")
        return F.when(F.contains(own, F.lit("*")), lines).otherwise(unify_breaks(own))

    return let(text, expanded)  # bound once, as it is read a dozen times


def number_bullets(text: Column) -> Column:
    """Number the bullets 1..n when there are bullets and no numbered line."""
    lines = F.transform(F.split(text, "\n"), lambda x: sub(x, r"(?U)\s+\z"))

    def step(n: Column, line: Column) -> tuple[Column, Column]:
        bullet = line.rlike(C.BULLET_LINE)
        numbered = F.concat((n + 1).cast("string"), F.lit(". "), sub(line, C.BULLET_LINE))
        return n + F.when(bullet, 1).otherwise(0), F.when(bullet, numbered).otherwise(line)

    folded = let(lines, lambda own: F.array_join(scan(own, F.lit(0), step, "string")["out"], "\n"))
    wanted = text.rlike("(?m)" + C.BULLET_LINE.replace(r"\A", "^")) & ~F.exists(lines, lambda x: x.rlike(C.NUMBERED_LINE))
    return F.when(wanted & F.exists(lines, lambda x: x.rlike(C.BULLET_LINE)), folded).otherwise(text)


def step_count(text: Column) -> Column:
    return count_of(text, C.STEP_NUMBER)


def renumber(text: Column) -> Column:
    """Numbered lines only, counted 1..n; a text without numbered lines is left as it is."""
    bodies = F.filter(F.transform(find_all(text, C.STEP_LINE_REST, 2), strip), lambda b: b != "")
    lines = F.transform(bodies, lambda b, i: F.concat((i + 1).cast("string"), F.lit(". "), b))
    return F.when(text.rlike(C.STEP_LINE_REST), F.array_join(lines, "\n")).otherwise(text)


def has_number_gap(text: Column) -> Column:
    def gap(nums: Column) -> Column:
        first = F.get(nums, F.lit(0))
        wrong = F.transform(nums, lambda n, i: F.coalesce(n - i != first, F.lit(True)))
        return F.array_contains(wrong, True)

    return let(F.transform(find_all(text, C.STEP_LINE_REST, 1), lambda n: n.try_cast("decimal(38,0)")), gap)


# --- placeholder repair -------------------------------------------------------
def _title_case(token: Column) -> Column:
    runs = find_all(token, "[A-Z]+|[^A-Z]+")
    return F.array_join(
        F.transform(
            runs, lambda r: F.concat(F.substring(r, 1, 1), F.lower(F.substring(r, F.lit(2), F.length(r))))
        ),
        "",
    )


def button_hints(context: Column, labels=tuple(C.BUTTON_HINTS)) -> Column:
    """Labels seen in the context: the known ones in list order, then upper-case tokens as they occur."""
    known = F.filter(
        F.array(*[F.when(context.rlike(rf"(?Ui)\b\Q{b}\E\b"), F.lit(b)) for b in labels]), lambda b: b.isNotNull()
    )
    return F.array_distinct(F.concat(known, F.transform(find_all(context, C.UPPER_TOKEN), _title_case)))


def repair_placeholders(answer: Column, context: Column, labels=tuple(C.BUTTON_HINTS)) -> Column:
    """Fill ``click .`` with the first hint that leaves no placeholder; null if there is none."""

    def filled(hint: Column) -> Column:
        return F.regexp_replace(answer, F.lit(C.PLACEHOLDER), F.concat(F.lit("$1 "), hint))

    # only a hint that reads like a part of a placeholder can make a new one
    def works(hint: Column) -> Column:
        return ~F.lower(hint).isin("click", "press", "select", "button") | ~filled(hint).rlike(C.PLACEHOLDER)

    hint = F.get(F.filter(button_hints(context, labels), works), F.lit(0))
    return F.when(~answer.rlike(C.PLACEHOLDER), answer).otherwise(filled(hint))


# --- prompts ------------------------------------------------------------------
def format_prompt(template: str, **fields: Column) -> Column:
    """Fill ``{name}`` fields; the template text is cut once, so inserted text is never scanned again."""
    out, rest = [], template
    while rest:
        spots = [(rest.find("{" + n + "}"), n) for n in fields]
        spots = [s for s in spots if s[0] >= 0]
        if not spots:
            break
        at, name = min(spots)
        out += [F.lit(rest[:at]), fields[name]]
        rest = rest[at + len(name) + 2:]
    return F.concat(*out, F.lit(rest))
