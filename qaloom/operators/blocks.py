"""Documents to chunks. Everything here works inside one row, so none of it shuffles."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.text import clean_block, let, scan, strip
from ..rules import Rules

HIDDEN = r"(?is)<!--.*?-->|<!doctype[^>]*>|<head\b.*?</head\s*>|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
BREAK = r"(?i)<br\s*/?>"
#: tags that begin a new piece of text; all other tags vanish without a trace
BORDER = (
    r"(?i)<(/?(?:h[1-6]|p|li|div|td|th|tr|table|caption|thead|tbody|tfoot|ul|ol|dl|dt|dd|pre|blockquote|section|article|"
    r"header|footer|nav|main|aside|form|fieldset|legend|figure|figcaption|address|details|summary|hr|body|html))(?:\s[^>]*)?/?>"
)
TAG = r"</?[a-zA-Z][^>]*>"
PIECE = r"(?:\x01([^\x02]*)\x02|^)([^\x01]*)"
ENTITY = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);"

BODY = "struct<headings:string,text:string>"


def named_entities() -> str:
    """The named characters of HTML 4 as JSON, from Python's own table."""
    return json.dumps({name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'", "nbsp": " "})


def unescape(text: Column) -> Column:
    """Entities to characters in one pass, so that ``&amp;lt;`` stays ``&lt;``; unknown names stay as they are."""
    names = F.from_json(F.lit(named_entities()), "map<string,string>")

    parts = F.split(text, ENTITY)
    found = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(1))
    decoded = F.transform(found, lambda e: F.coalesce(_numbered(e), F.try_element_at(names, e), F.concat(F.lit("&"), e, F.lit(";"))))
    joined = F.array_join(F.transform(parts, lambda p, i: F.concat(p, F.coalesce(F.get(decoded, i), F.lit("")))), "")
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def _numbered(entity: Column) -> Column:
    """The character of ``#8217`` or ``#x2019``; a number that is no character becomes U+FFFD, a name null."""
    base16 = F.conv(F.substring(entity, 3, 6), 16, 10)
    code = F.when(F.lower(F.substring(entity, 2, 1)) == "x", base16).otherwise(F.substring(entity, 2, 7)).try_cast("int")
    bad = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    wide = F.unhex(F.lpad(F.hex(F.when(bad, F.lit(0xFFFD)).otherwise(code)), 8, "0"))
    return F.when(entity.startswith("#"), F.decode(wide, "UTF-32"))


def html_elements(html: Column) -> Column:
    """All text of a page in order, as ``array<struct<tag,text>>``.

    A heading, paragraph or list item lasts to the next tag of a block; all other text of a page (cells, quotes,
    loose text, text after a closing tag) is a paragraph ``p``. Tags inside a block, known or not, vanish and their
    text stays. The head, scripts, styles and comments are no text.
    """
    flat = F.regexp_replace(F.translate(html, "\x01\x02", ""), HIDDEN, "")
    flat = F.regexp_replace(F.regexp_replace(flat, BREAK, " "), BORDER, "\x01$1\x02")
    flat = F.regexp_replace(flat, TAG, "")
    found = F.arrays_zip(
        F.regexp_extract_all(flat, F.lit(PIECE), F.lit(1)).alias("tag"),
        F.regexp_extract_all(flat, F.lit(PIECE), F.lit(2)).alias("text"),
    )

    def element(b: Column) -> Column:
        tag = F.lower(b["tag"])
        own = F.when(tag.rlike("^(h[1-6]|li)$"), tag).otherwise(F.lit("p"))
        return F.struct(own.alias("tag"), strip(F.regexp_replace(unescape(b["text"]), r"(?U)\s+", " ")).alias("text"))

    return F.filter(F.transform(found, element), lambda b: b["text"] != "")


def under_headings(elements: Column) -> Column:
    """Body elements with the headings above them joined as ``h1 > h2 > ...``."""
    def step(path: Column, e: Column) -> tuple[Column, Column]:
        heading = e["tag"].startswith("h")
        level = F.substring(e["tag"], 2, 1).try_cast("int") - 1
        moved = F.transform(path, lambda p, i: F.when(i < level, p).when(i == level, e["text"]))
        body = F.struct(F.array_join(path, " > ").alias("headings"), e["text"].alias("text"))
        return F.when(heading, moved).otherwise(path), F.when(~heading, body)

    start = F.array_repeat(F.lit(None).cast("string"), 6)
    return let(elements, lambda own: scan(own, start, step, BODY)["out"])


def budget_chunks(body: Column, tokens: int = 1000) -> Column:
    """Merge neighbours under the same headings while the merged text fits; cut what is too long."""
    size = tokens * 4

    def pieces(b: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.length(b["text"]) - 1) / size).cast("int"))
        return F.transform(
            starts,
            lambda i: F.struct(
                b["headings"].alias("headings"), F.substring(b["text"], i * size + 1, F.lit(size)).alias("text")
            ),
        )

    def step(open_: Column, b: Column) -> tuple[Column, Column]:
        joined = F.concat_ws("\n", open_["text"], b["text"])
        together = F.length(open_["text"]) + 1 + F.length(b["text"])
        fits = F.coalesce((open_["headings"] == b["headings"]) & (together <= size), F.lit(False))
        merged = F.struct(b["headings"].alias("headings"), joined.alias("text"))
        return F.when(fits, merged).otherwise(b), F.when(~fits, open_)

    return let(F.flatten(F.transform(body, pieces)), lambda own: let(scan(own, F.lit(None).cast(BODY), step, BODY), _with_last))


def _with_last(done: Column) -> Column:
    """The outputs of a walk and what its state still holds."""
    return F.when(done["state"].isNull(), done["out"]).otherwise(F.array_append(done["out"], done["state"]))


def html_chunks(pages: DataFrame, doc: str, html: str = "html", rules: Rules = Rules()) -> DataFrame:
    """Pages to chunks: elements, heading path, token budget; the path stands above the chunk text."""
    chunks = budget_chunks(under_headings(html_elements(F.col(html))), rules.chunk_tokens)
    text = F.when(F.col("c.headings") != "", F.concat_ws("\n", "c.headings", "c.text")).otherwise(F.col("c.text"))
    return (
        pages.select(doc, F.posexplode(chunks).alias("chunk_idx", "c"))
        .select(doc, "chunk_idx", text.alias("text"))
        .filter(F.col("text") != "")
    )


def element_text(elements: Column, categories=tuple(C.ELEMENT_CATEGORIES)) -> Column:
    """Clean text of the elements of the wanted categories; empty for an unreadable document."""
    kept = F.filter(
        elements, lambda e: e["category"].isin(*categories) & F.coalesce(e["text"] != "", F.lit(False))
    )
    return F.coalesce(clean_block(F.array_join(F.transform(kept, lambda e: e["text"]), "\n")), F.lit(""))


# --- chunks by similarity of neighbouring sentences ---------------------------
def sentence_split(text: Column) -> Column:
    parts = F.split(F.regexp_replace(text, r"(?U)([.!?])\s+", "$1\n"), r"\n+")
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def _word_set(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))


def set_cosine(left: Column, right: Column) -> Column:
    """Cosine of two word sets; zero when either is empty."""
    norm = F.sqrt(F.size(left).cast("double") * F.size(right))
    return F.when(norm > 0, F.size(F.array_intersect(left, right)) / norm).otherwise(F.lit(0.0))


def _similarity(a: Column, b: Column) -> Column:
    return let(_word_set(a), lambda x: let(_word_set(b), lambda y: set_cosine(x, y)))


def similarity_chunks(text: Column, rules: Rules = Rules()) -> Column:
    """Chunks of a text by the similarity of neighbouring sentences, in two passes.

    First pass: a sentence joins the chunk before it when it is similar enough to its last two
    sentences (a lone sentence has its own threshold) and the chunk keeps within its size.
    Second pass: neighbouring chunks merge when they are similar enough and fit together.
    """
    limit = rules.max_chunk_chars
    start = F.lit(None).cast("struct<chunk:string,tail:string,n:int>")

    def grow(acc: Column, s: Column) -> tuple[Column, Column]:
        needed = F.when(acc["n"] == 1, rules.initial_threshold).otherwise(rules.appending_threshold)
        joins = F.coalesce(
            (F.length(acc["chunk"]) + F.length(s) + 1 <= limit) & (_similarity(acc["tail"], s) >= needed), F.lit(False)
        )
        last = F.when(acc["n"] == 1, acc["chunk"]).otherwise(F.element_at(F.split(acc["tail"], "\n"), -1))
        grown = F.struct(
            F.concat_ws(" ", acc["chunk"], s).alias("chunk"), F.concat_ws("\n", last, s).alias("tail"), (acc["n"] + 1).alias("n")
        )
        fresh = F.struct(s.alias("chunk"), s.alias("tail"), F.lit(1).alias("n"))
        return F.when(joins, grown).otherwise(fresh), F.when(~joins, acc["chunk"])

    def merge(acc: Column, c: Column) -> tuple[Column, Column]:
        joins = F.coalesce(
            (F.length(acc) + F.length(c) + 1 <= limit) & (_similarity(acc, c) >= rules.merging_threshold), F.lit(False)
        )
        return F.when(joins, F.concat_ws(" ", acc, c)).otherwise(c), F.when(~joins, acc)

    def finish(done: Column) -> Column:
        last = done["state"]["chunk"]
        return F.when(last.isNull(), done["out"]).otherwise(F.array_append(done["out"], last))

    first = let(sentence_split(text), lambda own: let(scan(own, start, grow, "string"), finish))
    return let(first, lambda own: let(scan(own, F.lit(None).cast("string"), merge, "string"), _with_last))
