from pyspark.sql import functions as F

from qaloom.functions import qa, tags
from qaloom.functions import validators as v

from .test_text import table


def pairs(evaluate, text, strict=False):
    (found,) = evaluate(lambda x: qa.parse_pairs(x, strict), (text,))
    return [(p["question"], p["ans"]) for p in found]


def test_text_pairs(evaluate):
    text = "Q: How do I add a user?\nA:\n1. Go to Admin.\n2. Quick step\nQuick note\nAlso x\nQ2: How?\nA2: ok"
    assert pairs(evaluate, text) == [
        ("How do I add a user?", "1. Go to Admin.\n2. Quick step"),
        ("uick note", "lso x"),
        ("How?", "ok"),
    ]
    assert pairs(evaluate, text, strict=True) == [
        ("How do I add a user?", "1. Go to Admin.\n2. Quick step\nQuick note\nAlso x"),
        ("How?", "ok"),
    ]
    assert pairs(evaluate, "**Q1- x **\n\n **A1: y") == [("x **", "y")]
    assert pairs(evaluate, "nothing here") == []


def test_json_pairs(evaluate):
    assert pairs(evaluate, ' [{"question": "a?", "ans": "b\\n1. c"}, {"question": "d", "ans": null}]') == [("a?", "b\n1. c"), ("d", None)]
    assert pairs(evaluate, '[{"question": "a?", "ans": ') == []
    assert pairs(evaluate, "[Save] it\nQ: a\nA: b") == [("a", "b")]


def test_score(evaluate):
    build = lambda x: qa.completion_score(x, qa.parse_pairs(x))
    got = evaluate(build, ("Q: a\nA:\n1. x\n2. the Save button",), ("etc. and required details",), ("",))
    assert [round(x, 6) for x in got] == [2.0 + 0.6 + 0.15, -2.0, 0.0]


def split(evaluate, q, a):
    (found,) = evaluate(qa.split_add_remove, (q, a))
    return [(p["question"], p["ans"]) for p in found]


def test_split_add_remove(evaluate):
    a = "1. Go to users\n2. Save first\n3. Add the name\n4. Look around\n5. Remove the name\n6. Save"
    assert split(evaluate, "How to add or remove users?", a) == [
        ("How to add users?", "1. Go to users\n2. Add the name\n3. Save first\n4. Look around\n5. Save"),
        ("How to remove users?", "1. Go to users\n2. Remove the name\n3. Save first\n4. Look around\n5. Save"),
    ]
    assert split(evaluate, "How to add users?", "1. Remove all\n2. Save") == [("How to remove users?", "1. Remove all\n2. Save")]
    assert split(evaluate, "q", "3. Look\n4. See") == [("q", "1. Look\n2. See")]
    assert split(evaluate, "q", "text") == [("q", "text")]
    # a navigation step that adds belongs to the prefix until the first real add step
    assert split(evaluate, "q", "1. Open and add x\n2. Add y") == [("q", "1. Open and add x\n2. Add y")]


def test_step_candidates(evaluate):
    src = "1. Open the   page\nClick it\nselect the row now\nSELECT the row now\nOther line\n2.  x"
    assert evaluate(qa.step_candidates, (src,)) == [["1. Open the page", "select the row now"]]
    assert evaluate(qa.source_steps, (src,)) == [["open the page", "select the row now"]]


def test_ui_terms(evaluate):
    (got,) = evaluate(qa.ui_terms, ("Press [My Label] or the Save button in the renewed drop-down, [ ]",))
    assert sorted(got) == ["button", "drop-down", "my label", "save"]


def test_paraphrases(evaluate):
    text = "Q1: Steps to open the page of users?\nq2. too short?\nQ3 - List all pages that show the users\nQ4: How may I open the page of users?"
    assert evaluate(qa.paraphrases, (text,)) == [["List all pages that show the users"]]
    assert evaluate(lambda x: F.size(qa.paraphrases(x, 9)), (text,)) == [2]


def test_heading_and_reference_rules(evaluate):
    table(evaluate, v.has_external_refs, [("Refer to the Table 2", True), ("above figure", True), ("a figure", False)])
    table(
        evaluate, v.leaks_heading,
        [("x\n Section 12 y", True), ("section 1", False), ("GENERAL INFO", True), ("Ab CDEFGH", False), ("a **b** c", True), ("a ** b", False)],
    )


def test_vague(evaluate):
    table(
        evaluate, v.is_too_vague,
        [
            ("Enter the required details", True),
            ("Enter the required details in the field", False),
            ("then click add", True),
            ("click add now", False),
            ("1. Look at it", True),
            ("1. Save it", False),
            ("1. a\n2. b", False),
            ("make the necessary changes to the table", False),  # "table" holds "tab"
        ],
    )


def test_alignment(evaluate):
    table(
        evaluate, v.is_misaligned,
        [(("open the page", "open a page"), False), (("open page", "open it"), True), (("open page", "open icon"), False), (("Why?", "none"), True)],
    )


def test_repeated_steps(evaluate):
    table(evaluate, v.repeats_step, [("1. a\n2. A", True), ("1. a\n2. b\na", False)])
    table(evaluate, lambda a: v.repeats_step(a, True), [("1. a\n2. a", False), ("1. a\n 1. A", True)])


def test_early_stop(evaluate):
    table(
        evaluate, v.stops_early,
        [
            (("done, record saved", "- next thing"), True),
            (("done, record saved", "nothing"), False),
            (("success" + "x" * 300, "1. a"), False),
            (("success", " " * 801 + "\n1. a"), False),
        ],
    )


def test_minimum_steps(evaluate):
    table(
        evaluate, v.has_enough_steps,
        [
            (("How to create x", "1. a"), False),
            (("How to create x", "1. a\n2. b"), True),
            (("How to create x", "open it"), True),
            (("What is x", "it"), True),
            (("my address", "it"), False),  # "add" inside a word
            (("my knew", "it"), False),
            (("a newt", "it"), True),
            (("eliminated", "it"), True),  # the last word is bound at its end
        ],
    )
    table(evaluate, v.is_trivial_parameter, [("Create Parameter", True), ("1. create parameter\n2. b", False)])
    table(evaluate, v.is_too_short, [("1. a", True), ("reopen", False), ("expanded", False), ("resubmit", False), ("submits", True)])


def test_dangling(evaluate):
    table(
        evaluate, v.has_dangling_step,
        [("1. a b c d\n2. pick one:", True), ("x such as", True), ("x ...", True), ("1. Click Save", True), ("1. Click the Save label", False), ("following it", False)],
    )


def test_coverage(evaluate):
    src = "Open the user page\nSelect a user from it\nClick the delete label"
    good = "1. Open the user page\n2. Select a user from it\n3. Click the delete label"
    rule = lambda a, s: v.covers_source(a, s, 0.60)
    table(
        evaluate, rule,
        [
            ((good, src), True),
            ((good, "no steps at all"), True),
            (("no steps", src), False),
            ((good.replace("3. Click the delete label", "3. Delete it"), src), False),
            ((good + ":", src), False),
            ((good + " following", src), False),
            (("1. Open the user page\n2. Something else entirely different", src), False),
        ],
    )
    assert evaluate(lambda a, s: v.covers_source(a, s, 0.6, as_run=True), ("none", src)) == [True]


def test_continuation(evaluate):
    table(
        evaluate, lambda a, n: v.continues_in_next(a, n, 1),
        [(("click [Go On]", "1. go on"), True), (("click it", "1. go on"), False), (("Save", "save, no step"), False), (("Save", "Open the save box"), True)],
    )
    assert evaluate(lambda a, n: v.continues_in_next(a, n, 2), ("Save [Go]", "1. save and go"), ("Save", "1. save")) == [True, False]


def test_tags(evaluate):
    table(evaluate, tags.question_intent, [("Copy or delete", "clone/copy"), ("address", "create"), ("refind", "search/filter"), ("x", "configure/ui")])
    table(evaluate, tags.answer_intent, [("create and remove", "delete"), ("renew", "create"), ("find", "search/filter"), ("add", "configure/ui")])
    table(evaluate, tags.state, [("is required", "error_or_validation"), ("fine", "happy_path"), ("unsuccessfully", "happy_path")])
    table(evaluate, tags.ui_area, [("the tab", "tabs"), ("table", "detail_form"), ("popup", "modal_popup"), ("listing in toolbar", "listing")])
