"""Expected results of the registered queries, as SQL over the same tables."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from qaloom import constants as C

from . import sql as S
from .sql import NL, lit

ORACLES: dict[str, str] = {}


def add(name: str, text: str) -> None:
    ORACLES[name] = text


# --- scalar text --------------------------------------------------------------
add("approx_tokens", f"SELECT doc_id, {S.approx_tokens('text')} AS tokens, {S.words('text')} AS words FROM documents")
add("clip_budget", "SELECT doc_id, md5(substr(text, 1, 400)) AS clipped FROM documents")
noisy = (
    f"'* -' || {NL} || replace(text, {NL}, {NL} || 'Note: seen' || {NL} || ' 3. -' || {NL} || '•' || {NL} || "
    f"'click .' || {NL} || 'note- you must go' || {NL}) || '....'"
)
add("clean_text", f"WITH n AS (SELECT doc_id, {noisy} AS x FROM documents) SELECT doc_id, {S.clean_block('x')} AS text FROM n")
add(
    "norm_question",
    f"WITH n AS (SELECT *, '** ' || replace(text, ' ', ' ' || chr(9)) || ' **' AS x FROM conversations) "
    f"SELECT conv_id, turn, {S.clean_question('x')} AS question, {S.question_key('text')} AS key FROM n",
)
add(
    "scrub_answers",
    f"WITH {S.pairs()}, c AS (SELECT doc_id, match_idx, {S.clean_answer(S.clean_block('pr.ans'))} AS a FROM pairs), "
    f"d AS (SELECT doc_id, match_idx, {S.strip_meta('a')} AS plain FROM c) SELECT *, {S.scrub('plain')} AS scrubbed FROM d",
)
add(
    "rework_steps",
    f"WITH n AS (SELECT doc_id, '- ' || replace(text, {NL}, {NL} || '* ') AS b, "
    f"'4. ' || replace(text, {NL}, {NL} || '9. ') || {NL} || 'end' AS num, 'Choose: * ' || replace(text, '. ', ' * ') AS i FROM documents) "
    f"SELECT doc_id, {S.number_bullets('b')} AS bulleted, {S.renumber('num')} AS renumbered, {S.number_gap('num')} AS gap, {S.expand('i')} AS expanded FROM n",
)
add(
    "repair_placeholders",
    f"WITH n AS (SELECT doc_id, text, translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS context, '1. Click . now' || {NL} || '2. ' || text || {NL} || '3. Press button' AS a FROM documents) "
    f"SELECT doc_id, {S.repaired('a', 'text')} AS plain, md5({S.repaired('a', 'context')}) AS loud FROM n",
)


# --- chunks and windows -------------------------------------------------------
def chunks(lines: int) -> str:
    rows = S.lines("text")
    return (
        f"cut AS (SELECT doc_id, {rows} AS rows FROM documents), "
        f"idx AS (SELECT doc_id, rows, unnest(range((len(rows) - 1) // {lines} + 1)) AS chunk_idx FROM cut), "
        f"chunks AS (SELECT doc_id, chunk_idx, array_to_string(rows[chunk_idx * {lines} + 1 : chunk_idx * {lines} + {lines}], {NL}) AS text FROM idx)"
    )


def window_rows(budget: int, lines: int) -> str:
    half = budget // 2
    first = min(half, budget - 1000) * 4
    return (
        f"{chunks(lines)}, ahead AS (SELECT doc_id, chunk_idx, text, lead(text, 1) OVER w AS n1, lead(text, 2) OVER w AS n2, "
        f"count(*) OVER (PARTITION BY doc_id) AS n FROM chunks WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_idx)), "
        f"one AS (SELECT *, substr(text, 1, {first}) AS c1 FROM ahead), "
        f"win AS (SELECT doc_id, chunk_idx AS window_index, c1, substr(coalesce(n1, text), 1, least({half}, {budget} - {S.approx_tokens('c1')}) * 4) AS c2, "
        f"coalesce(n2, '') AS c3, chunk_idx AS first, least(chunk_idx + 1, n - 1) AS second FROM one)"
    )


add("pair_windows", f"WITH {window_rows(1100, 2)} SELECT doc_id, window_index, c1, c2, md5(c3) AS c3, first, second FROM win")
prompt = "'Text one: ' || c1 || {0} || 'Text two: ' || c2 || {0} || 'End'".format(NL)
add(
    "prompt_overflow",
    f"WITH {window_rows(4000, 4)}, p AS (SELECT *, {prompt} AS whole FROM win), "
    f"o AS (SELECT *, {S.approx_tokens('whole')} > 500 AS too_long FROM p) "
    f"SELECT doc_id, window_index, md5(CASE WHEN too_long THEN 'Text one: ' || substr(c1, 1, 200) || {NL} || 'Text two: ' || {NL} || 'End' ELSE whole END) AS prompt, "
    f"CASE WHEN too_long THEN '' ELSE substr(c2, 1, 1200) END AS src_after, md5(substr(c3, 1, 1800)) AS src_next FROM o",
)
add(
    "merge_chunks",
    f"WITH {chunks(2)}, k AS (SELECT doc_id, chunk_idx, {S.strip('text')} AS text FROM chunks), "
    f"g AS (SELECT doc_id, (chunk_idx // 3)::BIGINT AS merged_idx, string_agg(text, {NL} || {NL} ORDER BY chunk_idx) AS text FROM k WHERE text <> '' GROUP BY ALL) "
    "SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY merged_idx) - 1 AS chunk_idx, text FROM g",
)
add(
    "merged_windows",
    f"WITH {chunks(1)}, k AS (SELECT doc_id, chunk_idx, {S.strip('text')} AS text FROM chunks WHERE chunk_idx % 4 < 2), "
    f"g AS (SELECT doc_id, chunk_idx // 2 AS m, string_agg(text, {NL} || {NL} ORDER BY chunk_idx) AS text FROM k WHERE text <> '' GROUP BY ALL), "
    "n AS (SELECT doc_id, row_number() OVER w - 1 AS i, text, lead(text, 1) OVER w AS n1, lead(text, 2) OVER w AS n2 FROM g "
    "WINDOW w AS (PARTITION BY doc_id ORDER BY m)), one AS (SELECT *, substr(text, 1, 8000) AS c1 FROM n) "
    f"SELECT doc_id, i AS window_index, md5(c1) AS c1, md5(substr(coalesce(n1, text), 1, least(2000, 4000 - {S.approx_tokens('c1')}) * 4)) AS c2, "
    "md5(coalesce(n2, '')) AS c3, i + CASE WHEN n1 IS NULL THEN 0 ELSE 1 END AS pair_end FROM one",
)


def elements() -> str:
    """Own patterns, not those of the library: everything up to the next block tag belongs to the piece before it."""
    names = json.dumps({n: chr(c) for n, c in name2codepoint.items()} | {"apos": "'", "nbsp": " "})
    blocks = "h[1-6]|p|li|div|article|section|nav|footer|header|aside|main|ul|ol|dl|dt|dd|table|thead|tbody|tfoot|tr|td|th|caption|pre|blockquote|form|body|html"
    visible = "html"
    for pattern in ("<!--.*?-->", "<!doctype[^>]*>", "<head[ >].*?</head>", "<head/?>", "<script.*?</script>", "<style.*?</style>"):
        visible = f"regexp_replace({visible}, {lit(pattern)}, '', 'gis')"
    visible = f"regexp_replace({visible}, '<br ?/?>', ' ', 'gi')"
    marked = f"regexp_replace({visible}, '<(/?({blocks}))([ ][^>]*)?/?>', chr(1) || '\\1' || chr(2), 'gi')"
    bare = f"regexp_replace({marked}, '</?[a-zA-Z][^>]*>', '', 'g')"
    entity = "&[a-zA-Z]+;"
    known = f"list_transform(regexp_extract_all(t, '{entity}'), lambda e: coalesce(json_extract_string({lit(names)}, '$.' || e[2:-2]), e))"
    plain = f"array_to_string(list_transform(list_zip(regexp_split_to_array(t, '{entity}'), {known}), lambda z: coalesce(z[1], '') || coalesce(z[2], '')), '')"
    return (
        f"pieces_ AS (SELECT page_id, string_split({bare}, chr(1)) AS ps FROM pages), "
        "found AS (SELECT page_id, unnest(ps) AS piece, unnest(range(len(ps))) AS place FROM pieces_), "
        "cut_ AS (SELECT page_id, place, CASE WHEN contains(piece, chr(2)) THEN lower(split_part(piece, chr(2), 1)) ELSE '' END AS tag, "
        "CASE WHEN contains(piece, chr(2)) THEN substr(piece, instr(piece, chr(2)) + 1) ELSE piece END AS t FROM found), "
        f"clean AS (SELECT page_id, place, tag, {S.strip(S.sub(plain, r'\s+', ' '))} AS text FROM cut_), "
        "elements AS (SELECT page_id, place, CASE WHEN regexp_matches(tag, '^(h[1-6]|li)$') THEN tag ELSE 'p' END AS tag, text FROM clean WHERE text <> '')"
    )


def body() -> str:
    over = "OVER (PARTITION BY page_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    places = ", ".join(f"max(CASE WHEN tag = 'h{i}' THEN place END) {over} AS p{i}" for i in range(1, 7))
    texts = ", ".join(f"last_value(CASE WHEN tag = 'h{i}' THEN text END IGNORE NULLS) {over} AS t{i}" for i in range(1, 7))
    valid = []
    for i in range(1, 7):
        above = [f"coalesce(p{j}, -1) < p{i}" for j in range(1, i)]
        valid.append(f"CASE WHEN p{i} IS NOT NULL{''.join(' AND ' + a for a in above)} THEN t{i} END")
    return (
        f"{elements()}, seen AS (SELECT *, {places}, {texts} FROM elements), "
        f"body AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY place) - 1 AS pos, "
        f"concat_ws(' > ', {', '.join(valid)}) AS headings, text FROM seen WHERE tag NOT LIKE 'h%')"
    )


add("html_blocks", f"WITH {body()} SELECT page_id, pos, headings, text FROM body")
add(
    "budget_chunks",
    f"WITH RECURSIVE {body()}, "
    "pieces AS (SELECT page_id, pos, headings, unnest(range((length(text) - 1) // 400 + 1)) AS part, text FROM body), "
    "cut AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos, part) AS n, headings, substr(text, part * 400 + 1, 400) AS text FROM pieces), "
    "walk AS (SELECT page_id, n, headings, text, 0::BIGINT AS chunk_idx FROM cut WHERE n = 1 UNION ALL "
    f"SELECT c.page_id, c.n, c.headings, CASE WHEN ok THEN joined ELSE c.text END, w_idx + CASE WHEN ok THEN 0 ELSE 1 END FROM "
    f"(SELECT c.page_id, c.n, c.headings, c.text, w.chunk_idx AS w_idx, w.text || {NL} || c.text AS joined, "
    f"w.headings = c.headings AND {S.approx_tokens(f'(w.text || {NL} || c.text)')} <= 100 AS ok FROM walk w JOIN cut c ON c.page_id = w.page_id AND c.n = w.n + 1) c) "
    f"SELECT page_id, chunk_idx, arg_max(CASE WHEN headings <> '' THEN headings || {NL} || text ELSE text END, n) AS text FROM walk GROUP BY page_id, chunk_idx",
)
add(
    "element_text",
    f"WITH {elements()}, j AS (SELECT page_id, coalesce(string_agg(text, {NL} ORDER BY place) FILTER (tag IN ('h1', 'p')), '') AS x FROM elements GROUP BY page_id) "
    f"SELECT p.page_id, coalesce({S.clean_block('x')}, '') AS text FROM pages p LEFT JOIN j USING (page_id)",
)


def cosine(a: str, b: str) -> str:
    x, y = S.word_set(a), S.word_set(b)
    return f"CASE WHEN len({x}) * len({y}) > 0 THEN len(list_intersect({x}, {y})) / sqrt((len({x}) * len({y}))::DOUBLE) ELSE 0 END"


sentences = S.sub("text", r"([.!?])\s+", r"\1" + "\n").replace("\\1\n'", f"\\1' || {NL}")
add(
    "similarity_chunks",
    "WITH RECURSIVE parts AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array("
    + sentences
    + f", '\\n+'), lambda s: {S.strip('s')}), lambda s: s <> '') AS p FROM documents), "
    "sent AS (SELECT doc_id, unnest(range(1, len(p) + 1)) AS n, unnest(p) AS s FROM parts), "
    "walk AS (SELECT doc_id, n, s AS chunk, s AS tail, s AS last, 1 AS k, 0 AS idx FROM sent WHERE n = 1 UNION ALL "
    f"SELECT doc_id, n, CASE WHEN ok THEN chunk || ' ' || s ELSE s END, CASE WHEN ok THEN last || {NL} || s ELSE s END, s, "
    "CASE WHEN ok THEN k + 1 ELSE 1 END, idx + CASE WHEN ok THEN 0 ELSE 1 END FROM "
    f"(SELECT t.doc_id, t.n, t.s, w.chunk, w.last, w.k, w.idx, length(w.chunk) + length(t.s) + 1 <= 400 AND "
    f"{cosine('w.tail', 't.s')} >= CASE WHEN w.k = 1 THEN 0.2::DOUBLE ELSE 0.15::DOUBLE END AS ok FROM walk w JOIN sent t ON t.doc_id = w.doc_id AND t.n = w.n + 1)), "
    "firsts AS (SELECT doc_id, idx + 1 AS n, arg_max(chunk, n) AS s FROM walk GROUP BY doc_id, idx), "
    "merge AS (SELECT doc_id, n, s AS chunk, 0 AS idx FROM firsts WHERE n = 1 UNION ALL "
    "SELECT doc_id, n, CASE WHEN ok THEN chunk || ' ' || s ELSE s END, idx + CASE WHEN ok THEN 0 ELSE 1 END FROM "
    f"(SELECT t.doc_id, t.n, t.s, w.chunk, w.idx, length(w.chunk) + length(t.s) + 1 <= 400 AND {cosine('w.chunk', 't.s')} >= 0.1::DOUBLE AS ok "
    "FROM merge w JOIN firsts t ON t.doc_id = w.doc_id AND t.n = w.n + 1)) "
    "SELECT doc_id, idx::BIGINT AS chunk_idx, arg_max(chunk, n) AS text FROM merge GROUP BY doc_id, idx",
)
step_sum = f"list_sum(list_transform(p, lambda x: least({S.steps('x.ans')}, 6)))"
score = (
    f"2.0::DOUBLE * len(p) + 0.30::DOUBLE * coalesce({step_sum}, 0) + 0.15::DOUBLE * {S.count('raw_text', C.UI_TOKEN)} "
    f"- 1.0::DOUBLE * {S.count('lower(raw_text)', C.VAGUE_SCORE_WORDS)}"
)
candidates = S.filled(
    "SELECT doc_id, text, cand_idx, (doc_id + cand_idx * 7) % 40 AS tpl_id FROM documents, range(5) r(cand_idx)", "doc_id, cand_idx"
)
add(
    "best_of_k",
    f"WITH {candidates}, l AS (SELECT doc_id, cand_idx, raw_text, {S.pair_list('raw_text')} AS p FROM filled), "
    f"s AS (SELECT *, {score} AS score FROM l), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, cand_idx) AS rn FROM s) "
    "SELECT doc_id, cand_idx, round(score, 6) AS score, md5(raw_text) AS raw FROM r WHERE rn = 1",
)

# --- pairs --------------------------------------------------------------------
add("parse_completions", f"WITH {S.pairs()} SELECT doc_id, match_idx, pr.question AS q_raw, pr.ans AS a_raw FROM pairs")
add("clean_stage", f"WITH {S.cleaned()} SELECT doc_id, match_idx, q AS question, a AS answer, reason AS drop_reason FROM cleaned")
add(
    "drop_reason",
    f"WITH {S.judged()} SELECT doc_id, match_idx, split_idx, q AS question, a AS answer, reason AS drop_reason FROM judged",
)
add("drop_summary", f"WITH {S.judged()} SELECT reason AS drop_reason, count(*) AS count FROM judged WHERE reason IS NOT NULL GROUP BY 1")
verbs = "['Go to', 'Choose', 'Add', 'Remove', 'Save', 'Look at', 'Associate']"
kept = f"list_filter({S.lines('text')}, lambda x: x <> '')"
add(
    "split_add_remove",
    f"WITH n AS (SELECT doc_id, 'How do I add or remove document ' || doc_id AS q, {S.join(f'list_transform({kept}, lambda x, i: i || {lit(". ")} || {verbs}[(doc_id + (i - 1) * 3) % 7 + 1] || {lit(" ")} || x)')} AS a FROM documents), "
    f"t1 AS (SELECT *, {S.split_list('q', 'a')} AS st FROM n), "
    "t2 AS (SELECT *, coalesce(list_position(list_transform(st, lambda x: NOT x.n AND (x.a OR x.r)), true), len(st) + 1) AS t FROM t1), "
    "t3 AS (SELECT *, list_filter(st, lambda x, i: i < t AND (x.n OR NOT x.s)) AS pre, list_filter(st, lambda x, i: i >= t AND x.a) AS ad, "
    "list_filter(st, lambda x, i: i >= t AND NOT x.a AND x.r) AS rm, "
    "list_filter(st, lambda x, i: (i < t AND NOT x.n AND x.s) OR (i > t AND NOT x.a AND NOT x.r)) AS suf FROM t2), "
    + "t4 AS (SELECT *, "
    + ", ".join(
        f"{S.renumber(S.join(f'list_transform(list_concat(pre, {own}, suf), lambda x: x.line)'))} AS {own}_text" for own in ("ad", "rm")
    )
    + f", {S.renumber('a')} AS plain FROM t3), "
    "o AS (SELECT doc_id, CASE WHEN len(ad) = 0 AND len(rm) = 0 THEN [{'q': q, 'a': plain}] ELSE list_concat("
    f"CASE WHEN len(ad) > 0 THEN [{{'q': {S.sub('q', C.TO_ADD, 'add')}, 'a': ad_text}}] ELSE [] END, "
    f"CASE WHEN len(rm) > 0 THEN [{{'q': {S.sub('q', C.TO_REMOVE, 'remove')}, 'a': rm_text}}] ELSE [] END) END AS l FROM t4), "
    "u AS (SELECT doc_id, unnest(range(len(l))) AS split_idx, unnest(l) AS p FROM o) SELECT doc_id, split_idx, p.q AS question, p.a AS answer FROM u",
)
cands = f"list_transform({S.every('source', C.STEP_CANDIDATE)}, lambda s: {S.sub(S.strip('s'), chr(92) + 's+', ' ')})"
add(
    "coverage_jaccard",
    f"WITH n AS (SELECT doc_id, {S.join(f'list_transform({kept}, lambda x, i: CASE WHEN (i - 1) % 5 = 4 THEN x ELSE {lit("Open ")} || x END)')} AS source, "
    f"{S.join(f'list_transform(list_filter({kept}, lambda x, i: (i - 1) % 5 <> 2), lambda x, i: i || {lit(". Open ")} || x)')} AS answer FROM documents), "
    f"s AS (SELECT *, {S.source_steps('source')} AS src, list_transform({S.every('answer', C.STEP_NUMBER_BODY, 1)}, lambda s: {S.normalize_step('s')}) AS own, "
    f"list_filter({cands}, lambda s: length(s) >= 10) AS c FROM n) "
    f"SELECT doc_id, len(src) AS source_steps, len(own) AS answer_steps, {S.jaccard('own', 'src')} AS jaccard, {S.covered('answer', 'src')} AS covered, "
    "md5(array_to_string(list_filter(c, lambda s, i: list_position(list_transform(c, lambda z: lower(z)), lower(s)) = i), '|')) AS candidates FROM s",
)
goes = f"({S.hit('n', C.STEP_NUMBER_SPACE)} OR {S.hit('n', C.STEP_CANDIDATE)}) AND len(list_filter(terms, lambda t: contains(lower(n), t))) >= "
add(
    "continuation",
    f"WITH {S.completions()}, k AS (SELECT doc_id, {S.ui_terms('raw_text')} AS terms, substr(c3, 1, 1800) || {NL} || 'Open ' || c1 AS n FROM filled) "
    f"SELECT doc_id, array_to_string(list_sort(terms), ',') AS terms, {goes} 1 AS one, {goes} 2 AS two FROM k",
)


def replies() -> str:
    return (
        f"w AS (SELECT doc_id, text, {S.flat('text')} AS w, {S.flat('text')} AS a FROM documents), "
        "replies AS (SELECT doc_id, w, a, CASE doc_id % 3 WHEN 0 THEN 'Q1: Steps to open the page of ' WHEN 1 THEN 'Q1: List all the pages of ' ELSE 'Q1: Why ' END "
        f"|| w || '?' || {NL} || 'q2. Describe in short how to reach ' || CASE WHEN doc_id % 2 = 0 THEN w ELSE '' END || {NL} || "
        f"'Q3: In which way can I open the page of ' || w || '? ' || {NL} || text AS raw_text FROM w), "
        f"asked AS (SELECT *, list_filter(list_transform({S.every('raw_text', C.PARAPHRASE_LINE, 1)}, lambda c: {S.strip('c')}), lambda c: c <> '' "
        f"AND (ends_with(c, '?') OR {S.hit('c', C.PARAPHRASE_VERB)}) AND {S.words('c')} >= 6 AND NOT {S.hit('c', C.PARAPHRASE_STEPS_TO)}) AS good FROM replies)"
    )


add("paraphrase_filter", f"WITH {replies()} SELECT doc_id, good[1] AS first, len(good) AS usable FROM asked")
add(
    "coverage_tags",
    f"WITH {S.pairs()}, l AS (SELECT doc_id, match_idx, lower(pr.question) AS q, lower(pr.ans) AS a FROM pairs) SELECT doc_id, match_idx, "
    f"{S.first_rule('q', C.QUESTION_INTENTS, C.DEFAULT_INTENT)} AS asked, {S.first_rule('a', C.ANSWER_INTENTS, C.DEFAULT_INTENT)} AS intent, "
    f"CASE WHEN {S.hit('a', C.ERROR_STATE)} THEN 'error_or_validation' ELSE 'happy_path' END AS state, "
    f"{S.first_rule('a', C.UI_AREAS, C.DEFAULT_UI_AREA)} AS ui_area FROM l",
)
own = {
    "asked": ([("\\bopen\\b", "open"), ("\\bpage\\b", "page")], "lower(q)"), "intent": ([("\\bsubmit\\b", "send"), ("\\bopen\\b", "open")], "lower(a)"),
    "ui_area": ([("\\bform\\b", "form"), ("\\bpage\\b", "page")], "lower(a)"),
}
shared = f"len(list_intersect({S.every('lower(q)', C.KEYWORD)}, {S.every('lower(a)', C.KEYWORD)}))"
add(
    "replaced_rules",
    f"WITH {S.pairs()}, l AS (SELECT doc_id, match_idx, pr.question AS q, pr.ans AS a FROM pairs) SELECT doc_id, match_idx, "
    + ", ".join(f"{S.first_rule(x, rules, 'none' if name == 'ui_area' else 'other')} AS {name}" for name, (rules, x) in own.items())
    + f", CASE WHEN {S.hit('lower(a)', '\\bclose\\b')} THEN 'error_or_validation' ELSE 'happy_path' END AS state, "
    f"({S.any_hit('a', C.VAGUE_PHRASES)} AND NOT {S.hit('a', 'form|entry')}) OR ({S.count('a', C.STEP_NUMBER_SPACE)} = 1 AND NOT {S.hit('a', '\\blook\\b')}) AS vague, "
    f"{shared} < CASE WHEN {S.hit('a', 'form|entry')} THEN 1 ELSE 2 END AS misaligned FROM l",
)
add(
    "tag_counts",
    f"WITH {S.pairs()}, l AS (SELECT lower(pr.ans) AS a FROM pairs), g AS ("
    f"SELECT 'intent' AS tag, {S.first_rule('a', C.ANSWER_INTENTS, C.DEFAULT_INTENT)} AS value FROM l UNION ALL "
    f"SELECT 'state', CASE WHEN {S.hit('a', C.ERROR_STATE)} THEN 'error_or_validation' ELSE 'happy_path' END FROM l UNION ALL "
    f"SELECT 'ui_area', coalesce(nullif({S.first_rule('a', C.UI_AREAS, C.DEFAULT_UI_AREA)}, 'listing'), '__none__') FROM l) "
    "SELECT tag, value, count(*) AS count FROM g GROUP BY ALL",
)

# --- dedup --------------------------------------------------------------------
add(
    "exact_dedup",
    f"WITH k AS (SELECT doc_id, {S.question_key('text')} AS q FROM documents) SELECT doc_id, "
    "CASE WHEN row_number() OVER (PARTITION BY q ORDER BY doc_id) = 1 THEN 'accepted' ELSE 'q_text_exact_dup' END AS status FROM k",
)
add(
    "new_questions",
    f"WITH e AS (SELECT {S.question_key('text')} AS q FROM conversations WHERE turn >= 2 UNION SELECT {S.question_key('text')} FROM documents) "
    f"SELECT conv_id, turn FROM conversations WHERE {S.question_key('text')} NOT IN (SELECT q FROM e)",
)


def walk(key: str, parents: bool = False, name: str = "") -> str:
    """Sequential first-wins over ``nodes(ord, e, s, p)``, whose lists name the earlier rivals by test."""
    parent = ", parent" if parents else ""
    gate = "n.parent IS NOT NULL AND NOT list_contains(w.acc, n.parent) OR " if parents else ""
    own = "CASE WHEN parent IS NOT NULL AND status <> 'accepted' THEN 'para_' || status ELSE status END AS status" if parents else "status"
    alive = " WHERE parent IS NULL OR list_contains(acc, parent)" if parents else ""
    return (
        f"num AS (SELECT *, row_number() OVER (ORDER BY ord) AS rn FROM nodes), "
        f"walk(rn, acc) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT n.rn, CASE WHEN {gate}list_has_any(list_concat(n.e, list_concat(n.s, n.p)), w.acc) "
        f"THEN w.acc ELSE list_append(w.acc, n.ord) END FROM walk w JOIN num n ON n.rn = w.rn + 1), "
        f"last AS (SELECT arg_max(acc, rn) AS acc FROM walk), "
        f"told AS (SELECT ord{parent}, acc, CASE WHEN list_contains(acc, ord) THEN 'accepted' WHEN list_has_any(e, acc) THEN 'q_text_exact_dup' "
        f"WHEN list_has_any(s, acc) THEN 'q_text_sem_dup' ELSE 'pair_sem_dup' END AS status FROM num, last)"
        + (f", {name} AS (SELECT ord AS {key}, {own} FROM told{alive})" if name else f" SELECT ord AS {key}, {own} FROM told{alive}")
    )


def rivals(q: str, p: str, tq: str, tp: str) -> str:
    """Nodes with their earlier rivals, from ``base(ord, ...)`` with an exact key and two word sets."""
    def sized(x: str, t: str) -> str:
        return f"least(u{x}, v{x}) >= greatest(u{x}, v{x}) * {t} * {t} - 0.001 AND u{x} > 0 AND v{x} > 0"

    def close(x: str, t: str) -> str:
        return f"CASE WHEN {sized(x, t)} THEN len(list_intersect(a.{x}, b.{x})) >= sqrt((u{x} * v{x})::DOUBLE) * {t}::DOUBLE ELSE false END"

    sizes = f"len({q}) AS n{q}, len({p}) AS n{p}"
    hashed = ", ".join(f"list_transform({x}, lambda w: hash(w)) AS {x}" for x in (q, p))
    return (
        f"sets AS MATERIALIZED (SELECT ord, k, {hashed}, {sizes} FROM base), "
        f"near AS MATERIALIZED (SELECT a.ord AS u, b.ord AS v, a.k = b.k AS e, a.n{q} AS u{q}, b.n{q} AS v{q}, a.n{p} AS u{p}, b.n{p} AS v{p} FROM sets a JOIN sets b ON b.ord < a.ord "
        f"WHERE a.k = b.k OR least(a.n{q}, b.n{q}) >= greatest(a.n{q}, b.n{q}) * {tq} * {tq} - 0.001 OR least(a.n{p}, b.n{p}) >= greatest(a.n{p}, b.n{p}) * {tp} * {tp} - 0.001), "
        f"rel AS (SELECT u, v, e, {close(q, tq)} AS s, {close(p, tp)} AS p FROM near JOIN sets a ON a.ord = u JOIN sets b ON b.ord = v), "
        "hits AS (SELECT u, list(v) FILTER (e) AS e, list(v) FILTER (s) AS s, list(v) FILTER (p) AS p FROM rel WHERE e OR s OR p GROUP BY u)"
    )


empty = "coalesce(h.{0}, []::BIGINT[]) AS {0}"
lists = ", ".join(empty.format(x) for x in "esp")
both = "source || ' ' || lang || ' ' || text"
add(
    "greedy_dedup",
    f"WITH RECURSIVE base AS (SELECT doc_id AS ord, {S.question_key('text')} AS k, {S.word_set('text')} AS qs, {S.word_set(both)} AS ps FROM documents), "
    f"{rivals('qs', 'ps', '0.92', '0.90')}, nodes AS (SELECT b.ord, {lists} FROM base b LEFT JOIN hits h ON h.u = b.ord), {walk('doc_id')}",
)
add(
    "paraphrase_dedup",
    f"WITH RECURSIVE {replies()}, rows AS (SELECT doc_id * 2 AS ord, NULL::BIGINT AS parent, 'How do I open the page of ' || w || ' in the tool?' AS q, a FROM asked "
    "UNION ALL SELECT doc_id * 2 + 1, doc_id * 2, good[1], a FROM asked WHERE len(good) > 0), "
    f"base AS (SELECT ord, parent, {S.question_key('q')} AS k, {S.word_set(S.question_key('q'))} AS qs, {S.word_set("q || ' || ' || a")} AS ps FROM rows), "
    f"{rivals('qs', 'ps', '0.92', '0.95')}, nodes AS (SELECT b.ord, b.parent, {lists} FROM base b LEFT JOIN hits h ON h.u = b.ord), {walk('ord', True)}",
)
add(
    "dense_dedup",
    "WITH RECURSIVE rel AS (SELECT a.vec_id AS u, b.vec_id AS v FROM embeddings a JOIN embeddings b ON b.vec_id < a.vec_id "
    "AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.40), hits AS (SELECT u, list(v) AS s FROM rel GROUP BY u), "
    "nodes AS (SELECT e.vec_id AS ord, []::BIGINT[] AS e, coalesce(h.s, []::BIGINT[]) AS s, []::BIGINT[] AS p FROM embeddings e LEFT JOIN hits h ON h.u = e.vec_id), "
    + walk("vec_id"),
)


letters = ", ".join(f"(length(x) - length(replace(x, '{c}', '')))::DOUBLE" for c in "abcdefghijklmnopqrstuvwxyz")
exchange_rows = (
    "ex AS (SELECT row_number() OVER (ORDER BY u.conv_id, u.turn) AS ord, u.text AS q, a.text AS a FROM conversations u "
    "JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' WHERE u.role = 'user')"
)
add(
    "embedder_dedup",
    f"WITH RECURSIVE {exchange_rows}, kq AS (SELECT ord, {S.question_key('q')} AS x FROM ex), kp AS (SELECT ord, lower(q || ' || ' || a) AS x FROM ex), "
    f"vq AS (SELECT ord, x, [{letters}] AS v FROM kq), vp AS (SELECT ord, [{letters}] AS v FROM kp), "
    "rel AS (SELECT a.ord AS u, b.ord AS v, a.x = b.x AS e, list_cosine_similarity(a.v, b.v) >= 0.995 AS s, list_cosine_similarity(c.v, d.v) >= 0.9985 AS p "
    "FROM vq a JOIN vq b ON b.ord < a.ord JOIN vp c ON c.ord = a.ord JOIN vp d ON d.ord = b.ord), "
    "hits AS (SELECT u, list(v) FILTER (e) AS e, list(v) FILTER (s) AS s, list(v) FILTER (p) AS p FROM rel WHERE e OR s OR p GROUP BY u), "
    f"nodes AS (SELECT b.ord, {lists} FROM ex b LEFT JOIN hits h ON h.u = b.ord), {walk('ord', name='final')} "
    "SELECT conv_id, turn, status FROM final JOIN (SELECT row_number() OVER (ORDER BY u.conv_id, u.turn) AS ord, u.conv_id, u.turn FROM conversations u "
    "JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' WHERE u.role = 'user') USING (ord)",
)


# --- sampling -----------------------------------------------------------------
def grown(ratio: str) -> str:
    return (
        f"c AS (SELECT greatest(count(*) FILTER (toxic = 1), trunc({ratio}::DOUBLE * count(*))::BIGINT) - count(*) FILTER (toxic = 1) AS need, "
        "count(*) FILTER (toxic = 1) AS m, count(*) AS n FROM labels), "
        "r AS (SELECT doc_id, toxic, row_number() OVER (ORDER BY md5('42:' || doc_id)) - 1 AS i FROM labels WHERE toxic = 1), "
        "d AS (SELECT j % m AS i, j // m + 1 AS copy_no FROM (SELECT unnest(range(need)) AS j, m FROM c)), "
        "grown AS (SELECT doc_id, toxic::BIGINT AS toxic, 0::BIGINT AS copy_no FROM labels UNION ALL SELECT doc_id, toxic::BIGINT, copy_no FROM r JOIN d USING (i))"
    )


add("rebalance", f"WITH {grown('0.20')} SELECT doc_id, toxic, copy_no FROM grown")
add(
    "size_cap",
    f"WITH {grown('0.90')}, o AS (SELECT doc_id, copy_no, row_number() OVER (ORDER BY md5('42:' || doc_id || ':' || copy_no)) AS rn FROM grown) "
    "SELECT doc_id, copy_no FROM o, c WHERE rn <= trunc(n * 1.5)",
)


def cuts(source: str, key: str) -> str:
    """Split of every ``key`` of ``source`` by the exact cut points."""
    return (
        f"z AS (SELECT count(*) AS n FROM {source}), y0 AS (SELECT n, trunc(n * 0.90::DOUBLE)::BIGINT AS tr0, trunc(n * 0.05::DOUBLE)::BIGINT AS va0 FROM z), "
        "y1 AS (SELECT n, CASE WHEN n >= 3 AND va0 = 0 THEN greatest(1, tr0 - 1) ELSE tr0 END AS tr1, CASE WHEN n >= 3 AND va0 = 0 THEN 1 ELSE va0 END AS va1 FROM y0), "
        "y2 AS (SELECT n, CASE WHEN n >= 4 AND tr1 + va1 = n AND tr1 > va1 THEN tr1 - 1 ELSE tr1 END AS tr, "
        "CASE WHEN n >= 4 AND tr1 + va1 = n AND tr1 <= va1 THEN va1 - 1 ELSE va1 END AS va FROM y1), "
        f"rk AS (SELECT {key}, row_number() OVER (ORDER BY md5('42:' || {key})) AS rn FROM {source}), "
        f"dealt AS (SELECT {key}, CASE WHEN rn <= tr THEN 'train' WHEN rn <= tr + va THEN 'val' ELSE 'test' END AS split FROM rk, y2)"
    )


add("split_exact", f"WITH {cuts('documents', 'doc_id')} SELECT doc_id, split FROM dealt")
add(
    "split_grouped",
    f"WITH k AS (SELECT doc_id, md5({S.question_key('text')}) AS g FROM documents), s AS (SELECT DISTINCT g FROM k), {cuts('s', 'g')} "
    "SELECT doc_id, split FROM k JOIN dealt USING (g)",
)
add(
    "split_leaks",
    f"WITH {cuts('documents', 'doc_id')}, k AS (SELECT {S.question_key('text')} AS q, split FROM documents JOIN dealt USING (doc_id)) "
    "SELECT md5(q) AS question, array_to_string(list_sort(list(DISTINCT split)), ',') AS splits, count(*) AS rows FROM k GROUP BY q HAVING count(DISTINCT split) > 1",
)
add(
    "pack_sequences",
    f"WITH t AS (SELECT md5('42:' || conv_id || ':' || turn) AS k, text AS x FROM conversations), "
    f"n AS (SELECT *, {S.approx_tokens('x')} AS tok FROM t), r AS (SELECT *, (sum(tok) OVER (ORDER BY k) - tok)::BIGINT AS before FROM n), "
    "p AS (SELECT *, unnest(range(before // 200, (before + tok - 1) // 200 + 1)) AS bin FROM r), "
    "c AS (SELECT bin, x, before, greatest(before, bin * 200) AS f, least(before + tok, bin * 200 + 200) AS e FROM p) "
    "SELECT bin, count(*) AS rows, sum(e - f)::BIGINT AS tokens, md5(string_agg(substr(x, (f - before) * 4 + 1, (e - f) * 4), '' ORDER BY f)) AS text FROM c GROUP BY 1",
)

# --- records ------------------------------------------------------------------
EXCHANGES = (
    "ex AS (SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer, s.text AS system FROM conversations u "
    "LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' "
    "LEFT JOIN conversations s ON s.conv_id = u.conv_id AND s.turn = u.turn - 1 AND s.role = 'system' WHERE u.role = 'user')"
)
ROWS = (
    f"{EXCHANGES}, flat AS (SELECT conv_id, turn, 0 AS o, 'system' AS role, system AS content FROM ex WHERE system IS NOT NULL UNION ALL "
    "SELECT conv_id, turn, 1, 'user', question FROM ex UNION ALL SELECT conv_id, turn, 2, 'assistant', answer FROM ex WHERE answer IS NOT NULL), "
    "msgs AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn ORDER BY o) - 1 AS pos, role, content FROM flat)"
)
add(
    "build_messages",
    f"WITH {EXCHANGES} SELECT conv_id, turn, unnest([0, 1, 2])::BIGINT AS pos, unnest(['system', 'user', 'assistant']) AS role, "
    f"unnest([{lit(C.SYSTEM_TEXT)}, question, answer]) AS content FROM ex WHERE answer IS NOT NULL",
)
CONVERTED = (
    f"{ROWS}, conv AS (SELECT conv_id, turn, pos, 0 AS sub, CASE role WHEN 'system' THEN 'developer' ELSE role END AS role, "
    f"CASE role WHEN 'assistant' THEN 'analysis' END AS name, CASE role WHEN 'system' THEN {lit(C.DEVELOPER_TEXT)} "
    f"WHEN 'assistant' THEN {lit(C.REASONING_PREFIX)} || {NL} || content ELSE content END AS content FROM msgs "
    "UNION ALL SELECT conv_id, turn, pos, 1, role, 'final', content FROM msgs WHERE role = 'assistant')"
)
add(
    "convert_format",
    f"WITH {CONVERTED} SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn ORDER BY pos, sub) - 1 AS pos, role, name, content FROM conv",
)
add(
    "row_dispatch",
    f"WITH {ROWS}, c AS (SELECT conv_id, turn, count(*) AS turns, max(CASE WHEN role = 'user' THEN content END) AS q FROM msgs GROUP BY ALL) "
    "SELECT 'flat' AS form, 2::BIGINT AS turns, question AS user FROM ex WHERE answer IS NOT NULL UNION ALL SELECT 'legacy', turns, q FROM c UNION ALL SELECT 'current', turns, q FROM c",
)
add(
    "training_records",
    f"WITH {S.judged()} SELECT lpad((doc_id % 50)::VARCHAR, 3, '0') AS doc_path, doc_id // 50 AS window_index, match_idx, split_idx, doc_id // 50 + 1 AS pair_end, "
    f"{S.first_rule('lower(a)', C.ANSWER_INTENTS, C.DEFAULT_INTENT)} AS intent, "
    f"CASE WHEN {S.hit('lower(a)', C.ERROR_STATE)} THEN 'error_or_validation' ELSE 'happy_path' END AS state, "
    f"{S.first_rule('lower(a)', C.UI_AREAS, C.DEFAULT_UI_AREA)} AS ui_area, {lit(C.SYSTEM_TEXT)} AS system, q AS user, a AS assistant FROM judged WHERE reason IS NULL",
)
add("sharegpt", f"WITH {ROWS} SELECT conv_id, turn, pos, role, content FROM msgs")
add("jsonl_roundtrip", ORACLES["sharegpt"])


def header(level: str) -> str:
    text = f"<|start|>system<|message|>{C.CHAT_IDENTITY}\nCurrent date: 2025-01-01\n\nReasoning: {level}\n\n{C.CHAT_CHANNELS}<|end|>"
    return lit(text).replace("\n", f"' || {NL} || '")


def developer(text: str) -> str:
    return f"'<|start|>developer<|message|>' || {NL} || {NL} || '# Instructions' || {NL} || {NL} || {text} || '<|end|>'"


USER = "'<|start|>user<|message|>' || question || '<|end|>'"
FINAL = "'<|start|>assistant<|channel|>final<|message|>' || "
add(
    "render_chat",
    f"WITH {EXCHANGES} SELECT conv_id, turn, {header('medium')} || CASE WHEN coalesce(system, '') <> '' THEN {developer('system')} ELSE '' END || {USER} || "
    f"CASE WHEN coalesce(answer, '') <> '' THEN {FINAL} answer ELSE '<|start|>assistant' END AS text FROM ex",
)
SAID = "'<|start|>assistant<|channel|>{0}<|message|>' || {1} || CASE WHEN {2} AND pos = total - 1 THEN '' ELSE '<|end|>' END"
add(
    "render_conversations",
    "WITH t AS (SELECT *, role = 'assistant' AND turn % 3 = 0 AS thinks, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY conv_id) AS total "
    "FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY role = 'system', turn)), "
    "c AS (SELECT conv_id, max(turn) FILTER (role = 'user') AS asked, arg_max(role = 'assistant' AND text <> '', turn) AS open, "
    "arg_max(thinks AND text = '', turn) AS musing, string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (role = 'system') AS instruction FROM t GROUP BY conv_id), "
    "b AS (SELECT conv_id, turn, pos, total - (SELECT count(*) FROM conversations s WHERE s.conv_id = t.conv_id AND s.role = 'system') AS total, role, text, thinks FROM t WHERE role <> 'system'), "
    "p AS (SELECT conv_id, turn, CASE role WHEN 'user' THEN '<|start|>user<|message|>' || text || '<|end|>' WHEN 'assistant' THEN "
    f"CASE WHEN thinks AND turn > coalesce(asked, -1) THEN {SAID.format('analysis', chr(39) + 'Thought of turn ' + chr(39) + ' || turn', 'musing')} ELSE '' END || "
    f"CASE WHEN text <> '' THEN {SAID.format('final', 'text', 'open')} ELSE '' END ELSE '' END AS piece FROM b JOIN c USING (conv_id)), "
    "j AS (SELECT conv_id, string_agg(piece, '' ORDER BY turn) AS body FROM p GROUP BY conv_id) "
    f"SELECT conv_id, 0::BIGINT AS part, 1::BIGINT AS parts, {header('medium')} || CASE WHEN coalesce(instruction, '') <> '' THEN {developer('instruction')} ELSE '' END || "
    "coalesce(body, '') || CASE WHEN open OR musing THEN '' ELSE '<|start|>assistant' END AS text FROM c LEFT JOIN j USING (conv_id)",
)
add(
    "render_prompt",
    f"WITH {EXCHANGES} SELECT conv_id, turn, {header('medium')} || {developer(lit(C.SYSTEM_TEXT))} || {USER} || '<|start|>assistant' AS text FROM ex",
)
thought = "'<|start|>assistant<|channel|>analysis<|message|>{0}' || "
add(
    "render_reasoning",
    f"WITH {EXCHANGES} SELECT conv_id, turn, {header('high')} || {USER} || {thought.format('Look it up.')} "
    "CASE WHEN turn % 3 = 0 THEN '' ELSE '<|end|>' END || "
    "'<|start|>assistant<|channel|>commentary to=functions.lookup <|constrain|>json<|message|>{}<|call|>' || "
    "CASE WHEN turn % 4 = 0 THEN '<|start|>python' ELSE '<|start|>functions.lookup' END || ' to=assistant<|message|>found<|end|>' || "
    f"{thought.format('Now answer.')} CASE WHEN turn % 3 = 0 THEN '' ELSE '<|end|>' || {FINAL} answer END AS text FROM ex WHERE answer IS NOT NULL",
)
add(
    "training_text",
    f"WITH {EXCHANGES} SELECT {header('medium')} || {USER} || {FINAL} answer AS text FROM ex WHERE answer IS NOT NULL",
)

# --- statistics and plans -----------------------------------------------------
add(
    "corpus_stats",
    f"WITH {EXCHANGES} SELECT count(*) AS total, round(avg({S.words('question')}), 6) AS avg_q_words, "
    f"round(avg({S.words("coalesce(answer, '')")}), 6) AS avg_a_words FROM ex",
)


def plan(source: str, key: str, devices: int) -> str:
    return (
        f"c AS (SELECT {key}, count(*) AS n FROM {source} GROUP BY 1), "
        "e AS (SELECT *, (CASE WHEN n < 200 THEN 12 WHEN n < 500 THEN 10 WHEN n < 1500 THEN 8 ELSE 6 END)::BIGINT AS epochs, least(64, greatest(8, n // 10)) AS t FROM c), "
        f"b AS (SELECT *, greatest(1, t // {devices}) AS per_device_bs FROM e), "
        f"a AS (SELECT *, greatest(1, t // (per_device_bs * {devices})) AS grad_accum FROM b), "
        f"s AS (SELECT *, per_device_bs * grad_accum * {devices} AS target_eff_batch FROM a), "
        "m AS (SELECT *, (ceil(n / target_eff_batch::DOUBLE) * epochs)::BIGINT AS max_steps FROM s), "
        "plan AS (SELECT *, greatest(1e-6::DOUBLE, least(5e-5::DOUBLE * (target_eff_batch / 32.0::DOUBLE), 5e-4::DOUBLE)) AS learning_rate, "
        "greatest(10, trunc(0.03::DOUBLE * max_steps)::BIGINT) AS warmup_steps FROM m)"
    )


add(
    "train_plan",
    f"WITH {plan('documents', 'lang', 2)} SELECT lang, n, epochs, per_device_bs, grad_accum, target_eff_batch, max_steps, learning_rate, warmup_steps FROM plan",
)
add("step_totals", "WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY 1) SELECT source, n, (ceil(n / 16.0) * 3)::BIGINT AS steps FROM c")
TRIALS = (
    "trials AS (SELECT p_brand AS brand, p_partkey AS number, CASE WHEN p_partkey % 2 = 0 THEN p_size::DOUBLE END AS bs, "
    "CASE WHEN p_partkey % 2 = 0 THEN p_size / 1000.0::DOUBLE END AS lr, CASE WHEN p_partkey % 2 = 1 THEN (p_size % 5 + 1)::DOUBLE END AS ep, "
    "CASE WHEN p_partkey % 2 = 1 THEN 0.1::DOUBLE END AS wd, "
    "CASE WHEN p_partkey % 10 = 0 THEN 'inf'::DOUBLE WHEN p_partkey % 11 = 0 THEN 'nan'::DOUBLE ELSE floor(p_retailprice / 10) END AS value, "
    "p_partkey % 7 <> 0 AS done, p_partkey % 3 = 0 AS has_loss, p_retailprice AS price FROM part), "
    "best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY value, number) AS rn FROM trials "
    "WHERE done AND isfinite(value)) WHERE rn = 1)"
)
add("best_trial", f"WITH {TRIALS} SELECT brand, number, value FROM best")
add("trial_value", f"WITH {TRIALS} SELECT number, price AS value, NOT has_loss AS unset FROM trials")
add(
    "final_plan",
    f"WITH {TRIALS}, {plan('(SELECT p_brand AS brand FROM part)', 'brand', 2)}, "
    "f AS (SELECT plan.brand, n, coalesce(trunc(ep)::BIGINT, epochs) AS epochs, coalesce(trunc(bs)::BIGINT, per_device_bs) AS per_device_bs, grad_accum, "
    "coalesce(lr, learning_rate) AS learning_rate, 0.05::DOUBLE AS lora_dropout, coalesce(wd, 0.01::DOUBLE) AS weight_decay "
    "FROM plan LEFT JOIN best ON best.brand = plan.brand), "
    "g AS (SELECT *, (ceil(n / (per_device_bs * grad_accum * 2)::DOUBLE) * epochs)::BIGINT AS max_steps FROM f) "
    "SELECT *, greatest(10, trunc(0.03::DOUBLE * max_steps)::BIGINT) AS warmup_steps FROM g",
)

# --- files --------------------------------------------------------------------
add(
    "converted_splits",
    f"WITH {CONVERTED}, ids AS (SELECT conv_id, turn, conv_id || ':' || turn AS id FROM ex), {cuts('ids', 'id')} "
    "SELECT split, role, name, content FROM conv JOIN ids USING (conv_id, turn) JOIN dealt USING (id)",
)
add(
    "saved_splits",
    f"WITH {cuts('documents', 'doc_id')} SELECT split, lang, count(*) AS rows FROM documents JOIN dealt USING (doc_id) GROUP BY ALL",
)
add(
    "saved_completions",
    f"WITH {S.completions()} SELECT 'part' || doc_id % 5 || '.v1' AS doc_stem, doc_id AS window_index, md5(raw_text) AS raw FROM filled",
)
add(
    "generate_completions",
    f"SELECT doc_id, unnest([0, 1])::BIGINT AS cand_idx, md5('Q: What is it?' || {NL} || 'A: ' || text) AS raw FROM documents WHERE length(text) % 7 <> 0 AND length(text) % 11 <> 0",
)
add(
    "scan_files",
    "WITH p AS (SELECT page_id, html, coalesce(page_id, 0) % 3 AS kind, coalesce(page_id // 256, -1) AS block FROM pages), "
    """l AS (SELECT *, CASE WHEN kind <> 2 THEN coalesce(html, '') WHEN html IS NULL THEN '{}' ELSE '{"html":' || to_json(html) || '}' END AS line FROM p) """
    f"SELECT block, CASE WHEN kind = 2 THEN 'json' ELSE 'txt' END AS ending, kind = 1 AS deep, CAST(sum(strlen(line) + 1) AS BIGINT) AS length, "
    f"md5(string_agg(line || {NL}, '' ORDER BY page_id)) AS content FROM l GROUP BY kind, block",
)
add("json_arrays", ORACLES["jsonl_roundtrip"])
add("batched_rows", "SELECT doc_id, length(text) AS letters FROM documents")
add("saved_trials", f"WITH {TRIALS} SELECT number, value, ep AS epochs FROM trials WHERE done")

# --- the whole flow -----------------------------------------------------------
FLOW = (
    f"{S.judged()}, numbered AS (SELECT *, row_number() OVER (ORDER BY lpad((doc_id % 50)::VARCHAR, 3, '0'), doc_id // 50, match_idx, split_idx) AS ord "
    f"FROM judged WHERE reason IS NULL), "
    f"base AS (SELECT ord, {S.question_key('q')} AS k, {S.word_set(S.question_key('q'))} AS qs, {S.word_set("q || ' || ' || a")} AS ps FROM numbered), "
    f"{rivals('qs', 'ps', '0.92', '0.95')}, nodes AS (SELECT b.ord, {lists} FROM base b LEFT JOIN hits h ON h.u = b.ord), "
)
add(
    "dataset_drops",
    f"WITH RECURSIVE {FLOW} {walk('ord', name='final')}, "
    "r AS (SELECT reason FROM judged WHERE reason IS NOT NULL UNION ALL SELECT status FROM final WHERE status <> 'accepted') "
    "SELECT reason AS drop_reason, count(*) AS count FROM r GROUP BY 1",
)
record_id = (
    """'{"doc_path":"' || lpad((doc_id % 50)::VARCHAR, 3, '0') || '","window_index":' || doc_id // 50 || ',"match_idx":' || match_idx """
    """|| ',"split_idx":' || split_idx || ',"para_idx":0}'"""
)
add(
    "dataset_splits",
    f"WITH RECURSIVE {FLOW} {walk('ord', name='final')}, "
    f"rec AS (SELECT {record_id} AS id, {S.words('q')} AS qw, {S.words('a')} AS aw, {S.hit('lower(a)', C.ERROR_STATE)} AS err "
    "FROM numbered JOIN final USING (ord) WHERE status = 'accepted'), "
    "c AS (SELECT count(*) AS total, count(*) FILTER (err) AS m, greatest(count(*) FILTER (err), trunc(0.2::DOUBLE * count(*))::BIGINT) - count(*) FILTER (err) AS need FROM rec), "
    "cand AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || id)) - 1 AS i FROM rec WHERE err), "
    "draws AS (SELECT j % m AS i, j // m + 1 AS copy_no FROM (SELECT unnest(range(need)) AS j, m FROM c)), "
    "grown AS (SELECT id || '::0' AS cid, qw, aw FROM rec UNION ALL "
    "SELECT id || ':state=error_or_validation:' || copy_no, qw, aw FROM cand JOIN draws USING (i)), "
    f"{cuts('grown', 'cid')} SELECT split, count(*) AS total, round(avg(qw), 6) AS avg_q_words, round(avg(aw), 6) AS avg_a_words "
    "FROM grown JOIN dealt USING (cid) GROUP BY 1",
)
