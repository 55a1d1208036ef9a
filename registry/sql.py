"""Building blocks of the SQL that states the expected results."""

from __future__ import annotations

import re

from qaloom import constants as C

from .templates import TEMPLATES

NL = "chr(10)"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def re2(pattern: str) -> str:
    """A pattern of the library as an SQL literal: the flags U and d have no twin and are left out."""
    flags = re.match(r"\(\?([A-Za-z]+)\)", pattern)
    if flags:
        rest = flags.group(1).replace("U", "").replace("d", "")
        pattern = (f"(?{rest})" if rest else "") + pattern[flags.end():]
    return lit(pattern)


def sub(x: str, pattern: str, repl: str = "") -> str:
    return f"regexp_replace({x}, {re2(pattern)}, {lit(repl)}, 'g')"


def hit(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {re2(pattern)})"


def every(x: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract_all({x}, {re2(pattern)}, {group})"


def count(x: str, pattern: str) -> str:
    return f"len({every(x, pattern)})"


def strip(x: str) -> str:
    return sub(x, r"^\s+|\s+$")


def lines(x: str) -> str:
    return f"string_split({x}, {NL})"


def join(x: str) -> str:
    return f"array_to_string({x}, {NL})"


def squeeze(x: str) -> str:
    return strip(sub(f"replace({x}, chr(9), ' ')", r"\s{2,}", " "))


def clean_question(x: str) -> str:
    return strip(sub(squeeze(strip(sub(x, r"^\*+|\*+$"))), r"\*\*$"))


def question_key(x: str) -> str:
    return sub(f"translate({strip(f'lower({x})')}, {lit(C.ASCII_PUNCTUATION)}, '')", r"\s+", " ")


def clean_block(x: str) -> str:
    s = strip("l")
    noise = (
        f"({s} = '' OR {hit(s, C.BULLETS_ONLY)} OR {hit(f'lower({s})', C.BARE_CLICK)} OR "
        f"({hit(f'lower({s})', C.NOTE_START)} AND NOT {hit(s, C.NOTE_ACTION)}))"
    )
    kept = strip(join(f"list_filter({lines(x)}, lambda l: NOT {noise})"))
    kept = sub(sub(kept, C.EMPTY_NUMBERED_LINE), r"\.{2,}(\n?)$", r".\1")
    return strip(join(f"list_filter({lines(kept)}, lambda l: NOT {hit('l', C.BULLETS_ONLY)})"))


def clean_answer(x: str) -> str:
    for wrong, right in C.ANSWER_CORRECTIONS.items():
        x = f"replace({x}, {lit(wrong)}, {lit(right)})"
    return squeeze(x)


def scrub(x: str) -> str:
    return strip(sub(sub(sub(x, C.ANGLE_IMAGE), C.POINTER_PHRASE), r"\s{2,}", " "))


def strip_meta(x: str) -> str:
    return strip(sub(x, C.META_REMARK))


def expand(x: str) -> str:
    rest = "substr(l, instr(l, ':') + 1)"
    parts = f"list_filter(list_transform(regexp_split_to_array({rest}, {re2(C.INLINE_BULLET_SPLIT)}), lambda p: {strip('p')}), lambda p: p <> '')"
    head = strip("substr(l, 1, instr(l, ':') - 1)")
    body = f"array_to_string(list_transform({parts}, lambda p: '   - ' || p), {NL})"
    return join(
        f"list_transform({lines(x)}, lambda l: CASE WHEN instr(l, ':') > 0 AND {hit('l', C.INLINE_BULLET)} "
        f"AND len({parts}) >= 2 THEN {head} || ':' || {NL} || {body} ELSE l END)"
    )


def number_bullets(x: str) -> str:
    rows = f"list_transform({lines(x)}, lambda l: {sub('l', chr(92) + 's+$')})"
    bullet = hit("l", C.BULLET_LINE)
    seen = f"len(list_filter({rows}[1:i], lambda z: {hit('z', C.BULLET_LINE)}))"
    numbered = f"list_transform({rows}, lambda l, i: CASE WHEN {bullet} THEN {seen} || '. ' || {sub('l', C.BULLET_LINE)} ELSE l END)"
    return (
        f"CASE WHEN len(list_filter({rows}, lambda l: {bullet})) > 0 "
        f"AND len(list_filter({rows}, lambda l: {hit('l', C.NUMBERED_LINE)})) = 0 THEN {join(numbered)} ELSE {x} END"
    )


def renumber(x: str) -> str:
    bodies = f"list_filter(list_transform({every(x, C.STEP_LINE, 2)}, lambda b: {strip('b')}), lambda b: b <> '')"
    return f"CASE WHEN {hit(x, C.STEP_LINE)} THEN {join(f'list_transform({bodies}, lambda b, i: i || {lit('. ')} || b)')} ELSE {x} END"


def number_gap(x: str) -> str:
    nums = f"list_transform({every(x, C.STEP_LINE, 1)}, lambda n: try_cast(n AS HUGEINT))"
    return f"(len({nums}) > 0 AND len(list_filter({nums}, lambda n, i: coalesce(n - (i - 1) <> {nums}[1], true))) > 0)"


def repaired(a: str, context: str) -> str:
    # a word's edge is one of ASCII here, so letters beyond it become a plain one while labels are looked for
    context = f"regexp_replace({context}, '[^\\x00-\\x7f\\p{{P}}\\p{{S}}\\p{{Z}}\\p{{C}}]', 'z', 'g')"
    known = ", ".join(f"CASE WHEN {hit(context, rf'(?i){chr(92)}b{b}{chr(92)}b')} THEN '{b}' END" for b in C.BUTTON_HINTS)
    runs = every("t", "[A-Z]+|[^A-Z]+")
    title = f"array_to_string(list_transform({runs}, lambda r: r[1] || lower(r[2:])), '')"
    upper = f"list_transform({every(context, C.UPPER_TOKEN)}, lambda t: {title})"
    hints = f"list_concat(list_filter([{known}], lambda h: h IS NOT NULL), {upper})"
    filled = f"regexp_replace({a}, {re2(C.PLACEHOLDER)}, '\\1 ' || h, 'g')"
    good = f"list_filter({hints}, lambda h: CASE WHEN lower(h) IN ('click', 'press', 'select', 'button') THEN NOT {hit(filled, C.PLACEHOLDER)} ELSE true END)"
    return f"CASE WHEN NOT {hit(a, C.PLACEHOLDER)} THEN {a} ELSE regexp_replace({a}, {re2(C.PLACEHOLDER)}, '\\1 ' || {good}[1], 'g') END"


def steps(x: str) -> str:
    return count(x, C.STEP_NUMBER)


def words(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> ''))"


def word_set(x: str) -> str:
    return f"list_distinct({every(f'lower({x})', r'[\p{L}\p{N}]+')})"


def any_hit(x: str, patterns) -> str:
    return "(" + " OR ".join(hit(x, p) for p in patterns) + ")"


def normalize_step(x: str) -> str:
    return strip(sub(sub(sub(f"lower({x})", r"\A\s*\d+\.\s*"), "[^a-z0-9 ]+", " "), r"\s+", " "))


def source_steps(x: str) -> str:
    rows = f"list_transform({every(x, C.STEP_CANDIDATE)}, lambda s: lower({sub(strip('s'), chr(92) + 's+', ' ')}))"
    rows = f"list_filter({rows}, lambda s: length(s) >= 10)"
    return f"list_transform(list_filter({rows}, lambda s, i: list_position({rows}, s) = i), lambda s: {normalize_step('s')})"


def jaccard(a: str, b: str) -> str:
    return f"(len(list_intersect({a}, {b})) / greatest(1, len(list_distinct(list_concat({a}, {b}))))::DOUBLE)"


def ui_terms(x: str) -> str:
    labels = f"list_filter(list_transform({every(x, C.UI_LABEL, 1)}, lambda t: {strip('t')}), lambda t: t <> '')"
    return (
        f"list_distinct(list_transform(list_concat({labels}, {every(x, C.UI_BUTTON_WORD, 1)}, "
        f"{every(x, C.UI_WIDGET_WORD, 1)}), lambda t: lower(t)))"
    )


def approx_tokens(x: str) -> str:
    return f"greatest(1, ceil(length({x}) / 4.0))::BIGINT"


def first_rule(x: str, rules, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {hit(x, p)} THEN {lit(v)}" for p, v in rules) + f" ELSE {lit(default)} END"


# --- common table expressions -------------------------------------------------
def template_values() -> str:
    def cell(t: str) -> str:
        return lit(t).replace("\n", f"' || {NL} || '") if "\n" in t else lit(t)

    rows = ", ".join(f"({i}, {', '.join(cell(c) for c in t)})" for i, t in enumerate(TEMPLATES))
    return f"tpl(tpl_id, raw_text, c1, c2, c3) AS (VALUES {rows})"


def flat(text: str) -> str:
    return f"trim(regexp_replace({text}, '[\\x00-\\x20]+', ' ', 'g'))"


def filled(docs: str, keys: str) -> str:
    def fill(c: str) -> str:
        return f"replace(replace(replace(replace(replace({c}, '{{W}}', w), '{{J}}', j), '{{T}}', text), '{{S}}', s), '{{L}}', l) AS {c}"

    kept = f"list_filter({lines('text')}, lambda x: x <> '')"
    return (
        f"{template_values()}, parts AS (SELECT *, "
        f"{flat('text')} AS w, replace(replace({flat('text')}, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"') AS j, "
        f"{join(f'list_transform({kept}, lambda x, i: i || {lit('. Open ')} || x)')} AS s, "
        f"{join(f'list_transform({kept}, lambda x: {lit('Open ')} || x)')} AS l FROM ({docs})), "
        f"filled AS (SELECT {keys}, {', '.join(fill(c) for c in ('raw_text', 'c1', 'c2', 'c3'))} FROM parts JOIN tpl USING (tpl_id))"
    )


def completions() -> str:
    return filled("SELECT doc_id, text, doc_id % 40 AS tpl_id FROM documents", "doc_id")


QA_MARK = r"(?is)(\n\s*(?:\*\*)?\s*Q\d*[:\-.]?)"
QA_CUT = r"(?is)(?:^|\n)\s*(?:\*\*)?\s*Q\d*[:\-.]?\s*(.*?)\s*\n\s*(?:\*\*)?\s*A\d*[:\-.]?\s*([^\x01]*)"


def pair_list(x: str) -> str:
    """Pairs of a completion: a mark before every further question takes the place of the look-ahead."""
    marked = f"regexp_replace({x}, {lit(QA_MARK)}, chr(1) || '\\1', 'g')"
    qs = f"list_transform({every(marked, QA_CUT, 1)}, lambda q: replace(q, chr(1), ''))"
    text = f"list_zip({qs}, {every(marked, QA_CUT, 2)})"
    text = f"list_transform({text}, lambda p: {{'question': p[1], 'ans': p[2]}})"
    js = f"from_json({x}::JSON, '[{{\"question\":\"VARCHAR\",\"ans\":\"VARCHAR\"}}]')"
    return f"CASE WHEN json_valid({x}) THEN {js} ELSE {text} END"


def pairs() -> str:
    return (
        completions()
        + f", listed AS (SELECT *, {pair_list('raw_text')} AS p FROM filled), "
        "pairs AS (SELECT doc_id, c1, c2, c3, unnest(range(len(p))) AS match_idx, unnest(p) AS pr FROM listed)"
    )


def cleaned() -> str:
    a = "a"
    ctx = "substr(c2, 1, 1200)"
    early = f"CASE WHEN {hit(a, C.EXTERNAL_REFERENCE)} THEN 'external_refs' WHEN {any_hit(a, [C.SECTION_HEADING, C.UPPER_HEADING, C.BOLD_SPAN])} THEN 'heading_leak' END"
    vague = f"({any_hit(a, C.VAGUE_PHRASES)} AND NOT {hit(a, C.UI_TOKEN)}) OR ({count(a, C.STEP_NUMBER_SPACE)} = 1 AND NOT {hit(a, C.SINGLE_STEP_VERB)})"
    shared = f"len(list_intersect({every('lower(q)', C.KEYWORD)}, {every('lower(a)', C.KEYWORD)}))"
    step_rows = f"list_transform(list_filter({lines(a)}, lambda l: {hit('l', C.STEP_NUMBER)}), lambda l: {strip(sub(f'lower({strip('l')})', chr(92) + 'A' + chr(92) + 's*' + chr(92) + 'd+' + chr(92) + '.'))})"
    late = (
        f"CASE WHEN fixed IS NULL THEN 'unrepaired_placeholder' WHEN {vague} THEN 'too_vague' "
        f"WHEN {shared} < CASE WHEN {hit(a, C.UI_TOKEN)} THEN 1 ELSE 2 END THEN 'misaligned' "
        f"WHEN len({step_rows}) <> len(list_distinct({step_rows})) THEN 'dup_terminal' "
        f"WHEN {hit(f'right(lower({strip(a)}), 200)', C.SUCCESS_TAIL)} AND {hit(f'substr({ctx}, 1, 800)', C.STEP_START)} THEN 'early_stop' "
        f"WHEN {any_hit('lower(q)', C.MIN_STEPS_QUESTION)} AND {steps(a)} < 2 AND NOT {hit('lower(a)', C.MIN_STEPS_SINGLE_OK)} THEN 'min_steps' "
        f"WHEN {hit('lower(a)', C.TRIVIAL_PARAMETER)} AND {steps(a)} < 2 THEN 'trivial_create_parameter' END"
    )
    return pairs() + (
        f", k1 AS (SELECT * EXCLUDE (pr), {clean_question('pr.question')} AS q, {clean_answer(clean_block('pr.ans'))} AS a FROM pairs)"
        f", k2 AS (SELECT * REPLACE ({strip_meta('a')} AS a), CASE WHEN q = '' OR a = '' THEN 'empty_q_or_a' END AS e1 FROM k1)"
        f", k3 AS (SELECT * REPLACE ({expand(scrub('a'))} AS a), coalesce(e1, {early}) AS e2 FROM k2)"
        f", k4 AS (SELECT * REPLACE ({number_bullets('a')} AS a) FROM k3)"
        f", k5 AS (SELECT * REPLACE (CASE WHEN {number_gap('a')} THEN {renumber('a')} ELSE a END AS a) FROM k4)"
        f", k6 AS (SELECT *, {repaired('a', ctx)} AS fixed FROM k5)"
        f", k7 AS (SELECT * REPLACE (coalesce(fixed, a) AS a) FROM k6)"
        f", cleaned AS (SELECT doc_id, match_idx, c1, c2, substr(c3, 1, 1800) AS nxt, q, a, coalesce(e2, {late}) AS reason FROM k7)"
    )


def split_list(q: str, a: str) -> str:
    step = (
        "{'line': l, 'a': " + hit("lower(l)", C.ADD_STEP) + ", 'r': " + hit("lower(l)", C.REMOVE_STEP)
        + ", 'n': " + hit("l", C.NEUTRAL_STEP) + ", 's': " + hit("l", C.COMMON_SUFFIX_STEP) + "}"
    )
    return f"list_transform(list_filter({lines(a)}, lambda l: {hit('l', C.STEP_NUMBER)}), lambda l: {step})"


def splits() -> str:
    def text(own: str) -> str:
        rows = f"list_concat(pre, {own}, suf)"
        return renumber(join(f"list_transform({rows}, lambda x: x.line)"))

    q_add, q_rem = sub("q", C.TO_ADD, "add"), sub("q", C.TO_REMOVE, "remove")
    return cleaned() + (
        f", t1 AS (SELECT *, {split_list('q', 'a')} AS st FROM cleaned)"
        ", t2 AS (SELECT *, coalesce(list_position(list_transform(st, lambda x: NOT x.n AND (x.a OR x.r)), true), len(st) + 1) AS t FROM t1)"
        ", t3 AS (SELECT *, list_filter(st, lambda x, i: i < t AND (x.n OR NOT x.s)) AS pre, list_filter(st, lambda x, i: i >= t AND x.a) AS ad, "
        "list_filter(st, lambda x, i: i >= t AND NOT x.a AND x.r) AS rm, "
        "list_filter(st, lambda x, i: (i < t AND NOT x.n AND x.s) OR (i > t AND NOT x.a AND NOT x.r)) AS suf FROM t2)"
        f", t4 AS (SELECT *, CASE WHEN reason IS NOT NULL THEN [{{'q': q, 'a': a}}] WHEN len(ad) = 0 AND len(rm) = 0 THEN [{{'q': q, 'a': {renumber('a')}}}] "
        f"ELSE list_concat(CASE WHEN len(ad) > 0 THEN [{{'q': {q_add}, 'a': {text('ad')}}}] ELSE [] END, "
        f"CASE WHEN len(rm) > 0 THEN [{{'q': {q_rem}, 'a': {text('rm')}}}] ELSE [] END) END AS out FROM t3)"
        ", t5 AS (SELECT doc_id, match_idx, c1, c2, nxt, reason, unnest(range(len(out))) AS split_idx, unnest(out) AS o FROM t4)"
        ", splits AS (SELECT doc_id, match_idx, split_idx, c1, c2, nxt, reason, o.q AS q, "
        f"CASE WHEN reason IS NULL AND {number_gap('o.a')} THEN {renumber('o.a')} ELSE o.a END AS a FROM t5)"
    )


def covered(a: str, src: str) -> str:
    raw = every(a, C.STEP_NUMBER_BODY, 1)
    own = f"list_transform({raw}, lambda s: {normalize_step('s')})"
    last_raw = strip(f"{raw}[-1]")
    last, last_src = f"{own}[-1]", f"{src}[-1]"
    ok = (
        f"{words(last)} >= 4 AND NOT ends_with({last_raw}, ':') AND NOT {hit(f'lower({last_raw})', C.OPEN_PHRASE)} "
        f"AND {jaccard(own, src)} >= 0.6::DOUBLE AND (contains({last}, substr({last_src}, 1, 30)) OR contains({last_src}, substr({last}, 1, 30)))"
    )
    return f"CASE WHEN len({src}) = 0 THEN true ELSE coalesce(len({raw}) > 0 AND {ok}, false) END"


def judged() -> str:
    near = f"c1 || {NL} || c2"
    wide = f"{near} || {NL} || nxt"
    last_line = f"{lines(strip('a'))}[-1]"
    low = f"lower({strip(last_line)})"
    dangling = f"(ends_with({low}, ':') OR {hit(low, C.OPEN_PHRASE)} OR ends_with({low}, '...') OR {hit(last_line, C.SHORT_STEP)})"
    goes_on = (
        f"({hit('nxt', C.STEP_NUMBER_SPACE)} OR {hit('nxt', C.STEP_CANDIDATE)}) AND "
        f"len(list_filter({ui_terms('a')}, lambda t: contains(lower(nxt), t))) > 0"
    )
    return splits() + (
        f", src AS (SELECT *, {source_steps(near)} AS s1, {source_steps(wide)} AS s2 FROM splits)"
        f", judged AS (SELECT doc_id, match_idx, split_idx, q, a, CASE WHEN reason IS NOT NULL THEN reason "
        f"WHEN {steps('a')} < 2 AND NOT {hit('a', C.SHORT_ANSWER_VERB)} THEN 'post_split_too_short' "
        f"WHEN {dangling} THEN 'dangling_step' "
        f"WHEN NOT ({covered('a', 's1')} OR {covered('a', 's2')}) THEN 'coverage_fail' "
        f"WHEN {goes_on} THEN 'continuation_next_window' END AS reason FROM src)"
    )
