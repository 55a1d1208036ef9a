"""Fixed values.

Everything in this module is a fixed value that has to agree with the rules it
re-states for the results to agree: word lists, patterns, role names, texts and
numeric defaults. There is no logic here.

Patterns are written for java.util.regex. ``(?U)`` gives ``\\s \\w \\b`` their
Unicode meaning and ``(?d)`` makes ``\\n`` the only line end.
"""

# --- cleaning -----------------------------------------------------------------
ANSWER_CORRECTIONS = {"appreciate option": "appropriate option"}
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
NOTE_ACTION = r"(?Uid)\b(click|select|enter|must|required|ensure|choose|navigate|save|submit|delete|clone|search)\b"
BULLETS_ONLY = r"(?Ud)\A[.\-*•\s]+\z"
BARE_CLICK = r"(?Ud)\Aclick\s*\.\z"
NOTE_START = r"\Anote[:\-]"
EMPTY_NUMBERED_LINE = r"(?Udm)^\s*\d+\.\s*[.\-:]?\s*$"
TRAILING_DOTS = r"(?d)\.{2,}$"
META_REMARK = r"(?Uid)(?:^|\n)\s*(note:)?\s*the extracted q&a pairs.*$"
WHITE_SPACE = (
    "\t\n\u000b\u000c\r\u001c\u001d\u001e\u001f \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
LINE_BREAKS = "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085  ]"

# --- question / answer text ---------------------------------------------------
QA_BLOCK = (
    r"(?Uids)(?:^|\n)\s*(?:\*\*)?\s*Q\d*[:\-.]?\s*(.*?)\s*\n\s*(?:\*\*)?\s*A\d*[:\-.]?\s*(.*?)"
    r"(?=\n\s*(?:\*\*)?\s*Q\d*[:\-.]?|\z)"
)
QA_BLOCK_STRICT = (
    r"(?Uids)(?:^|\n)\s*(?:\*\*)?\s*Q\d*[:\-.]\s*(.*?)\s*\n\s*(?:\*\*)?\s*A\d*[:\-.]\s*(.*?)"
    r"(?=\n\s*(?:\*\*)?\s*Q\d*[:\-.]|\z)"
)
PARAPHRASE_LINE = r"(?Uidm)^\s*Q\d+\s*[:\-.]\s*(.+)$"
PARAPHRASE_VERB = r"(?Uid)\A(list|show|describe|identify|explain)\b"
PARAPHRASE_STEPS_TO = r"(?Uid)\A\s*steps to\b"

# --- steps --------------------------------------------------------------------
STEP_LINE = r"(?Udm)^\s*(\d+)\.\s*(.+?)\s*$"
STEP_NUMBER = r"(?Udm)^\s*\d+\."
STEP_NUMBER_SPACE = r"(?Udm)^\s*\d+\.\s+"
STEP_NUMBER_BODY = r"(?Udm)^\s*\d+\.\s+(.+)$"
STEP_START = r"(?Uidm)^\s*(?:\d+\.|\-|\*)\s+\w+"
STEP_CANDIDATE = r"(?Uidm)^\s*\d+\.\s+.+$|^\s*(Click|Select|Enter|Choose|Go to|Open|Press)\b.+"
BULLET_LINE = r"(?Ud)\A\s*(?:\-\s+|\*\s+|•\s+)"
NUMBERED_LINE = r"(?Ud)\A\s*\d+\.\s+"
INLINE_BULLET = r"(?Ud)\*\s+\S"
INLINE_BULLET_SPLIT = r"(?Ud)\s*\*\s+"
OPEN_PHRASE = r"(?Ud)\b(including|such as|for example|consists of|following)\b$"
SHORT_STEP = r"(?Ud)\A\s*\d+\.\s+\S+(?:\s+\S+){0,2}\s*$"

# --- user interface words -----------------------------------------------------
BUTTON_HINTS = ["Save", "Submit", "Add", "Back", "Delete", "Clone", "Search", "Cancel", "OK", "Next", "Finish", "Update"]
UI_TOKEN = r"(?Ui)\[(Save|Submit|Add|Back|Delete|Search|OK|Cancel|Next|Finish)\]|icon|button|drop-?down|field|tab"
UI_LABEL = r"\[([^\]]+)\]"
UI_BUTTON_WORD = r"(?Ui)\b(Save|Submit|Add|Back|Delete|Clone|Search|Cancel|OK|Next|Finish|Update)\b"
UI_WIDGET_WORD = r"(?Ui)\b(icon|button|drop-?down|field|tab|section|pane)\b"
UPPER_TOKEN = r"(?U)\b[A-Z][A-Z0-9_]{2,}\b"
PLACEHOLDER = r"(?Uid)\b(click|press|select)\s+(?:\.|button\b\s*$)"
ANGLE_IMAGE = r"(?Ui)<\s*image\s*\d+\s*>"
POINTER_PHRASE = r"(?Ui)\b(click|press|select)\s+(?:here|this|there)\b"

# --- validators ---------------------------------------------------------------
EXTERNAL_REFERENCE = r"(?i)refer to (the )?(table|figure|image)|below table|above figure"
SECTION_HEADING = r"(?Udm)^\s*(Section\s+\d+)"
UPPER_HEADING = r"(?Udm)^[A-Z][A-Z\s\-]{5,}$"
BOLD_SPAN = r"\*\*[^*]+\*\*"
VAGUE_PHRASES = [
    r"(?Ui)\benter the required details\b",
    r"(?Ui)\benter relevant information\b",
    r"(?Ui)\bmake the necessary changes\b",
    r"(?Uid)\bclick add\b$",
    r"(?Ui)\bthe application displays the result\b",
]
SINGLE_STEP_VERB = r"(?Ui)\b(save|submit|exit|open|expand|search)\b"
KEYWORD = r"[a-z]{3,}"
SUCCESS_TAIL = r"(?i)record saved|saved successfully|success|acknowledg(e|ment)|confirmation displayed"
MIN_STEPS_SINGLE_OK = r"(?U)\b(open|expand|collapse|search|save|submit|confirm|click\s+\[[^\]]+\])\b"
MIN_STEPS_QUESTION = [
    r"(?U)\bcreate|add|new\b",
    r"(?U)\bupdate|edit|modify\b",
    r"(?U)\bdelete|remove|terminate|eliminate\b",
]
TRIVIAL_PARAMETER = r"(?U)\bcreate parameter\b"
SHORT_ANSWER_VERB = r"(?Ui)\bexpand|open|search|save|submit\b"
VAGUE_SCORE_WORDS = r"(?U)\brequired details|relevant information|necessary changes|etc\."

# --- add / remove split -------------------------------------------------------
NEUTRAL_STEP = r"(?Uid)\b(open|go to|navigate|from the listing|on the .* page)\b"
COMMON_SUFFIX_STEP = r"(?Ui)\b(save|submit|confirm|ok)\b"
ADD_STEP = r"(?U)\b(move right|add|associate|create parameter)\b"
REMOVE_STEP = r"(?U)\bremove\b"
TO_ADD = r"(?i)(add or remove|remove)"
TO_REMOVE = r"(?i)(add or remove|add)"

# --- tags ---------------------------------------------------------------------
DEFAULT_INTENT = "configure/ui"
QUESTION_INTENTS = [
    (r"(?U)\bclone|copy|duplicate\b", "clone/copy"),
    (r"(?U)\bdelete|remove\b", "delete"),
    (r"(?U)\bupdate|edit|modify\b", "update"),
    (r"(?U)\bcreate|add|new\b", "create"),
    (r"(?U)\bsearch|filter|find\b", "search/filter"),
]
ANSWER_INTENTS = [
    (r"(?U)\bdelete|remove\b", "delete"),
    (r"(?U)\bcreate|new\b", "create"),
    (r"(?U)\bupdate|edit|modify\b", "update"),
    (r"(?U)\bsearch|find|filter\b", "search/filter"),
]
ERROR_STATE = r"(?U)\berror|invalid|required|cannot be blank|denied|timeout|unsuccessful\b"
UI_AREAS = [
    (r"(?U)\blisting\b", "listing"),
    (r"(?U)\bpop-?up|modal\b", "modal_popup"),
    (r"(?U)\btoolbar\b", "toolbar"),
    (r"(?U)\btab\b", "tabs"),
]
DEFAULT_UI_AREA = "detail_form"

# --- messages -----------------------------------------------------------------
SYSTEM_TEXT = (
    "You are a highly knowledgeable assistant specialized in domain-specific instructions. "
    "Always provide step-by-step, accurate, and context-aware answers. Never assume; rely only "
    "on given information. Avoid general knowledge unless explicitly asked. Use concise, formal language."
)
DEVELOPER_TEXT = (
    "You are a helpful assistant that explains your reasoning clearly, then gives a concise final answer."
)
REASONING_PREFIX = "(Domain reasoning)"
CHAT_IDENTITY = "You are ChatGPT, a large language model trained by OpenAI.\nKnowledge cutoff: 2024-06"
CHAT_CHANNELS = (
    "# Valid channels: analysis, commentary, final. Channel must be included for every message."
)
BUILTIN_TOOLS = ["python", "browser.search", "browser.open", "browser.find"]

# --- element categories kept from a partitioned document ----------------------
ELEMENT_CATEGORIES = ["NarrativeText", "Title", "ListItem"]

# --- drop reasons, in the order in which they are tested ----------------------
PAIR_REASONS = [
    "empty_q_or_a", "external_refs", "heading_leak", "unrepaired_placeholder", "too_vague",
    "misaligned", "dup_terminal", "early_stop", "min_steps", "trivial_create_parameter",
]
SPLIT_REASONS = ["post_split_too_short", "dangling_step", "coverage_fail", "continuation_next_window"]
DEDUP_REASONS = ["q_text_exact_dup", "q_text_sem_dup", "pair_sem_dup"]
PARAPHRASE_REASONS = ["para_q_text_exact_dup", "para_q_text_sem_dup", "para_pair_sem_dup"]

# --- quick looks before a pattern is tried --------------------------------------
#: STEP_LINE with all that follows the body; stripped bodies and numbers are the same, in less time
STEP_LINE_REST = r"(?Udm)^\s*(\d+)\.\s*(.+)$"
#: Pieces of which every match of a pattern holds at least one, once lower-cased where the pattern ignores case. Unicode
#: matches i also with \u0131 and \u0130 (i and \u0307 in lower case) and s also with \u017f, so pieces avoid these letters or give all forms.
PIECES = {
    VAGUE_PHRASES[0]: ("enter the requ",),
    VAGUE_PHRASES[1]: ("enter relevant",),
    VAGUE_PHRASES[2]: ("make the nece",),
    VAGUE_PHRASES[3]: ("ck add",),
    VAGUE_PHRASES[4]: ("the appl",),
    UI_TOKEN: ("[", "icon", "\u0131con", "\u0307con", "button", "drop", "field", "f\u0131eld", "\u0307eld", "tab"),
    UI_LABEL: ("[",),
    UI_BUTTON_WORD: ("ave", "ubm", "add", "back", "delete", "clone", "earch", "cancel", "ok", "next", "fin", "f\u0131n", "fi\u0307n", "update"),
    UI_WIDGET_WORD: ("icon", "\u0131con", "\u0307con", "button", "drop", "field", "f\u0131eld", "\u0307eld", "tab", "ect", "pane"),
    EXTERNAL_REFERENCE: ("refer to ", "below table", "above figure"),
    BOLD_SPAN: ("**",),
    META_REMARK: ("q&a pa",),
    ANGLE_IMAGE: ("<",),
    POINTER_PHRASE: ("here", "thi", "th\u0131"),
    TRAILING_DOTS: ("..",),
    TRIVIAL_PARAMETER: ("create parameter",),
    VAGUE_SCORE_WORDS: ("required details", "relevant information", "necessary changes", "etc."),
    ADD_STEP: ("move right", "add", "associate", "create parameter"),
    REMOVE_STEP: ("remove",),
    COMMON_SUFFIX_STEP: ("ave", "ubm", "conf", "ok"),
    ERROR_STATE: ("error", "invalid", "required", "cannot be blank", "denied", "timeout", "unsuccessful"),
    MIN_STEPS_QUESTION[0]: ("create", "add", "new"),
    MIN_STEPS_QUESTION[1]: ("update", "edit", "modify"),
    MIN_STEPS_QUESTION[2]: ("delete", "remove", "terminate", "eliminate"),
    QUESTION_INTENTS[0][0]: ("clone", "copy", "duplicate"),
    QUESTION_INTENTS[1][0]: ("delete", "remove"),
    QUESTION_INTENTS[4][0]: ("search", "filter", "find"),
    ANSWER_INTENTS[1][0]: ("create", "new"),
    ANSWER_INTENTS[3][0]: ("search", "find", "filter"),
    UI_AREAS[0][0]: ("listing",),
    UI_AREAS[1][0]: ("pop", "modal"),
    UI_AREAS[2][0]: ("toolbar",),
    UI_AREAS[3][0]: ("tab",),
}
