"""Rules behind a quick look at pieces agree with their patterns, and costly steps are computed once."""

import pytest
from pyspark.sql import functions as F

from qaloom import constants as C
from qaloom.functions import qa, tags
from qaloom.functions import text as t
from qaloom.functions import validators as v

TEXTS = [
    "", "plain", "Enter the required details", "ENTER RELEVANT INFORMATION", "maKe the neceſsary changeſ", "clıck add", "Clİck Add",
    "the applİcatıon displays the result", "an İcon", "an ıCON", "fıeld", "FİELD", "[ſave]", "dropdown", "Drop-Down", "TAB", "ſectİon",
    "ſearch", "ſubmıt", "oK", "Fİnıſh", "confırm", "bacK", "Refer to the Table", "BELOW TABLE", "**bold**", "x\nNote: The extracted Q&A pairs are",
    "The extracted q&a paırſ", "<İmage 3>", "preſſ thıſ", "click THİS", "Select here", "wait...", "create parameter", "etc.", "move right", "remove it",
    "associate", "cannot be blank", "timeout", "new", "modify", "eliminate", "duplicate", "filter", "find", "listing", "pop-up", "modal", "toolbar", "pane", "a tab",
]


@pytest.mark.parametrize("pattern", list(C.PIECES))
def test_no_match_without_a_piece(spark, pattern):
    df = spark.createDataFrame([(x,) for x in TEXTS], "x string")
    x = F.col("x")
    plain = [x.rlike(pattern), t.sub(x, pattern, "<>"), t.find_all(x, pattern), t.count_of(x, pattern)]
    quick = [t.matches(x, pattern), t.sub_some(x, pattern, "<>"), t.find_some(x, pattern), t.count_some(x, pattern)]
    rows = df.select("x", F.array(*[p.eqNullSafe(q) for p, q in zip(plain, quick)]).alias("same"), plain[0].alias("hit")).collect()
    assert all(all(r["same"]) for r in rows), [r["x"] for r in rows if not all(r["same"])]
    assert any(r["hit"] for r in rows)


def test_lines_and_steps(evaluate):
    texts = ["", "a", "a\n", "a\r\nb\r\n", "a\n\n", "\n", "a b\u0085", "a\rb", "a\x0b", "1. a \n\n2.\n3. b \n4.  ", " 1. a\n\t2. b  c\n\n\nx\n3.d"]
    lines = lambda x: F.split(t.sub(x, f"(?:{C.LINE_BREAKS})\\z"), C.LINE_BREAKS)
    rows = [(x,) for x in texts]
    assert evaluate(t.split_lines, *rows) == evaluate(lines, *rows)
    assert evaluate(t.unify_breaks, *rows) == evaluate(lambda x: F.array_join(lines(x), "\n"), *rows)
    bodies = lambda p: lambda x: F.transform(t.find_all(x, p, 2), t.strip)
    assert evaluate(bodies(C.STEP_LINE_REST), *rows) == evaluate(bodies(C.STEP_LINE), *rows)
    numbers = lambda p: lambda x: t.find_all(x, p, 1)
    assert evaluate(numbers(C.STEP_LINE_REST), *rows) == evaluate(numbers(C.STEP_LINE), *rows)


def test_shared_words_beyond_the_beginning(evaluate):
    pad = "x1 " * 200
    rows = [("open page", "page open " + pad), ("open page", pad + "open page"), ("open page", pad + "open"), ("open page", pad), ("pag" + pad, "page open"),
            ("open", pad + "open field"), ("z" * 399 + "abcdef open", "z" * 399 + "a"), ("see the doc", "a see the do"), ("", "")]
    plain = lambda q, a: v.shared_keywords(q, a) < F.when(a.rlike(C.UI_TOKEN), 1).otherwise(2)
    assert evaluate(v.is_misaligned, *rows) == evaluate(plain, *rows)


def test_bullets_read_a_scrubbed_text_once(spark):
    """Looks for line breaks and bullets do not scrub the answer again: it was written a dozen times into the plan."""
    build = t.expand_inline_bullets(t.scrub_ui_refs(F.reverse(F.col("id").cast("string"))))
    plan = spark.range(1).select(build.alias("v"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("reverse(") == 1, plan


def test_pieces_look_at_one_lower_case(spark):
    plan = spark.range(1).select(t.sub_some(F.col("id").cast("string"), C.POINTER_PHRASE).alias("v"))._jdf.queryExecution().analyzed().toString()
    assert len(C.PIECES[C.POINTER_PHRASE]) > 1 and plan.count("lower(") == 1, plan


@pytest.mark.parametrize("build", [qa.parse_pairs, lambda x: t.scrub_ui_refs(t.strip_meta(t.clean_block(x))), tags.answer_intent, v.has_dangling_step])
def test_heavy_steps_are_bound_once(spark, build):
    """The text that a rule reads many times, and the pass over its pairs, are computed once."""
    plan = spark.range(1).select(build(F.reverse(F.col("id").cast("string"))).alias("v"))._jdf.queryExecution().analyzed().toString()
    heavy = {"parse_pairs": ("regexp_replace(",), "has_dangling_step": ("reverse(",), "answer_intent": ("lower(",)}.get(getattr(build, "__name__", ""), ("reverse(",))
    assert all(plan.count(x) == 1 for x in heavy), plan
