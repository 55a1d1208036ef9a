"""All tunable settings, as one immutable value passed to the operators."""

from __future__ import annotations

from dataclasses import dataclass, field

from . import constants as C


@dataclass(frozen=True)
class Rules:
    seed: int = 42
    split: tuple = (0.90, 0.05, 0.05)

    # prompt and context sizes, in approximate tokens
    context_tokens: int = 8192
    answer_tokens: int = 2048
    content_budget: int = 4000
    overflow_clip: int = 2000
    after_chars: int = 1200
    next_chars: int = 1800
    candidates: int = 5

    # chunking
    merge_count: int = 1
    chunk_tokens: int = 1000
    initial_threshold: float = 0.75
    appending_threshold: float = 0.70
    merging_threshold: float = 0.40
    max_chunk_chars: int = 6000

    # validation
    min_jaccard: float = 0.60
    continuation_overlap: int = 1
    repair_placeholders: bool = True
    drop_unrepaired: bool = True
    strict_markers: bool = False
    #: False: the intended rule; True: what the rule computes when taken literally
    as_run: bool = False

    # dedup
    question_threshold: float = 0.92
    pair_threshold: float = 0.95

    # records
    keep_system: bool = True
    system_text: str = C.SYSTEM_TEXT
    tag_coverage: bool = True

    # rebalance: tag -> {value: least share of the original rows}
    rebalance: bool = True
    targets: dict = field(default_factory=lambda: {"state": {"error_or_validation": 0.20}})
    growth_cap: float = 1.5

    # rule lists that a user may replace
    button_hints: tuple = tuple(C.BUTTON_HINTS)
    vague_phrases: tuple = tuple(C.VAGUE_PHRASES)
    success_tail: str = C.SUCCESS_TAIL
    question_intents: tuple = tuple(C.QUESTION_INTENTS)
    answer_intents: tuple = tuple(C.ANSWER_INTENTS)
    default_intent: str = C.DEFAULT_INTENT
    error_state: str = C.ERROR_STATE
    ui_areas: tuple = tuple(C.UI_AREAS)
    default_ui_area: str = C.DEFAULT_UI_AREA
    #: what reads like the interface, and verbs that make a single step clear enough
    ui_token: str = C.UI_TOKEN
    single_step_verb: str = C.SINGLE_STEP_VERB
    element_categories: tuple = tuple(C.ELEMENT_CATEGORIES)
    corrections: dict = field(default_factory=lambda: dict(C.ANSWER_CORRECTIONS))
