"""Scalar rules against values worked out by hand."""

from pyspark.sql import functions as F

from qaloom.functions import text as t


def table(evaluate, build, cases):
    rows = [c[0] if isinstance(c[0], tuple) else (c[0],) for c in cases]
    assert evaluate(build, *rows) == [c[1] for c in cases]


def test_sizes(evaluate):
    table(evaluate, t.approx_tokens, [("", 1), ("abcd", 1), ("abcde", 2), ("é" * 9, 3)])
    table(evaluate, lambda x: t.clip_tokens(x, 2), [("abcdefghij", "abcdefgh"), ("abc", "abc")])
    table(evaluate, t.word_count, [("", 0), ("  a\u00a0b \n c ", 3)])


def test_squeeze_joins_indented_lines(evaluate):
    table(
        evaluate, t.squeeze,
        [
            ("1. a\n2. b\n\n3. c\n   - d", "1. a\n2. b 3. c - d"),
            ("\ta\t\tb ", "a b"),
            ("\u00a0 x\u2003", "x"),
        ],
    )


def test_questions(evaluate):
    table(
        evaluate, t.clean_question,
        [("** How  do I?**", "How do I?"), ("*a* b***", "a* b"), ("x ** ", "x"), ("", "")],
    )
    table(
        evaluate, t.question_key,
        [("  How do I, really?! ", "how do i really"), ("A  b\nC", "a b c"), ("What !", "what "), ("É-t_x", "étx")],
    )


def test_clean_block(evaluate):
    table(
        evaluate, t.clean_block,
        [
            ("* -\n• \na\n\nclick .\nCLICK.\nb", "a\nb"),
            ("Note: background\nnote- you must save\nnotes: kept", "note- you must save\nnotes: kept"),
            ("1. a\n2.\n 3. -\n4. b", "1. a\n\n\n4. b"),
            ("wait...", "wait."),
            ("a.. b..", "a.. b."),
            ("***", ""),
        ],
    )


def test_answer_corrections(evaluate):
    table(evaluate, t.clean_answer, [("pick the appreciate option", "pick the appropriate option")])


def test_meta_and_scrub(evaluate):
    table(
        evaluate, t.strip_meta,
        [
            ("a\nNote: The extracted Q&A pairs follow", "a"),
            ("a\nthe extracted q&a pairs\nb", "a\nthe extracted q&a pairs\nb"),
        ],
    )
    table(
        evaluate, t.scrub_ui_refs,
        [("see < image 12 > and click here  now", "see and now"), ("Select there", ""), ("click hereby", "click hereby")],
    )


def test_expand_inline_bullets(evaluate):
    table(
        evaluate, t.expand_inline_bullets,
        [
            ("1. Pick: * a * b\nend", "1. Pick:\n   - a\n   - b\nend"),
            ("Pick: * a", "Pick: * a"),
            ("no colon * a * b", "no colon * a * b"),
            ("a\r\nb\n", "a\nb"),
            ("t: x:y * z", "t:\n   - x:y\n   - z"),
        ],
    )


def test_number_bullets(evaluate):
    table(
        evaluate, t.number_bullets,
        [
            ("- a  \nx\n * b\n• c", "1. a\nx\n2. b\n3. c"),
            ("1. a\n- b  ", "1. a\n- b  "),
            ("plain  ", "plain  "),
            ("-a", "-a"),
        ],
    )


def test_renumber(evaluate):
    table(
        evaluate, t.renumber,
        [
            ("3. a\nnote\n9. b", "1. a\n2. b"),
            ("1. a:\n   - x\n2.\n3. c", "1. a:\n2. 3. c"),
            ("no steps", "no steps"),
            ("1. a\n2. b", "1. a\n2. b"),
        ],
    )
    table(evaluate, lambda x: t.renumber(t.renumber(x)) == t.renumber(x), [("3. a\n3. b\nx", True), ("1.\n2.\n3. z", True)])
    table(
        evaluate, t.has_number_gap,
        [("2. a\n3. b", False), ("1. a\n3. b", True), ("x", False), ("1. a\n1. b", True), ("9" * 60 + ". a", True)],
    )


def test_repair(evaluate):
    table(
        evaluate, t.repair_placeholders,
        [
            (("2. Click .", "the Save label"), "2. Click Save"),
            (("2. Click .", "nothing"), None),
            (("no gap", "nothing"), "no gap"),
            (("press button", "BUTTON then NEXT_2X"), "press Next_2X"),
            (("Click . .", "CLICK or MOVE"), "Click Move ."),
            (("click .", "cancel and save"), "click Save"),
            (("", "Save"), ""),
        ],
    )


def test_prompt_fields_are_not_scanned_again(evaluate):
    table(evaluate, lambda a, b: t.format_prompt("<{c1}|{c2}>", c1=a, c2=b), [(("{c2}", "x"), "<{c2}|x>")])
    assert evaluate(lambda a: t.format_prompt("plain", q=a), ("x",)) == ["plain"]


def test_let_binds_once(evaluate):
    assert evaluate(lambda a: t.let(F.upper(a), lambda u: F.concat(u, u)), ("ab",)) == ["ABAB"]
