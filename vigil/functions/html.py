"""Text of HTML on the JVM side: elements by nesting depth, text nodes, character references. Column expressions, no UDF.

What counts is what an HTML tree would hold: an element reaches to the closing tag of its own depth (or to the end, when it is
never closed), script, style and comment contents are no text, references are decoded once, after the tags are cut away.
"""

from __future__ import annotations

import functools
import html.entities
import json
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions.clean import py_strip

NON_TEXT = r"(?is)<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)"
#: a tag; a '>' within quotes does not end it, a '<' that no name follows is text
TAG = r"""<[a-zA-Z/!?](?:"[^"]*"|'[^']*'|[^'">]+)*+>|<[a-zA-Z/!?][^>]*>"""
REFERENCE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][-.a-zA-Z0-9]*);?"
# The references that nearly all texts keep to.
FREQUENT = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&#39;", "'"))
_BUCKETS = 256


@functools.cache
def _named() -> str:
    """The HTML 5 reference names (from the Python library's table) as JSON: an array of small maps, found by the CRC of the name,
    because a look-up in a map compares one key after the other."""
    buckets: list[dict[str, str]] = [{} for _ in range(_BUCKETS)]
    for name, text in html.entities.html5.items():
        name = name.rstrip(";")
        buckets[zlib.crc32(name.encode()) % _BUCKETS][name] = text
    return json.dumps(buckets)


@functools.cache
def _latin() -> str:
    """What code points 128 to 159 mean in a numeric reference: windows-1252, as rule; undefined ones are themselves."""
    return "".join(bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(128, 160))


def _numbered(digits: Column, base: int) -> Column:
    """The character of a numeric reference; U+FFFD where there is none."""
    short = F.regexp_replace(digits, "^0+", "")
    code = F.when(F.length(short) <= 7, F.conv(F.concat(F.lit("0"), short), base, 10).cast("long")).otherwise(F.lit(1 << 40).cast("long"))
    bad = (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    own = F.decode(F.unhex(F.lpad(F.hex(F.when(bad, F.lit(0xFFFD).cast("long")).otherwise(code)), 8, "0")), "UTF-32")
    return F.when(code.between(128, 159), F.substring(F.lit(_latin()), (code - 127).cast("int"), F.lit(1))).otherwise(own)


def _decoded(token: Column, closed: bool) -> Column:
    """A token that begins with '&' as text; names that are not in the table stay as written."""
    bare = F.regexp_replace(F.substring(token, F.lit(2), F.length(token)), ";$", "")
    bucket = F.get(F.from_json(F.lit(_named()), "array<map<string,string>>"), (F.crc32(bare) % _BUCKETS).cast("int"))
    numeric = (
        F.when(bare.rlike("^#[0-9]"), _numbered(F.substring(bare, F.lit(2), F.length(bare)), 10))
        .when(bare.rlike("^#[xX]"), _numbered(F.substring(bare, F.lit(3), F.length(bare)), 16))
    )
    out = F.coalesce(numeric, F.try_element_at(bucket, bare), token)
    if closed:
        out = F.when(token.endswith(";"), out).otherwise(token)
    for written, text in reversed(FREQUENT):
        out = F.when(token == written, text).otherwise(out)
    return F.when(token == "&", token).otherwise(out)


def unescape(text: Column, closed: bool = False) -> Column:
    """Character references decoded, each once; numeric ones, and the names of HTML 5 with or without a semicolon (``closed``:
    with one only, the rule for attribute values)."""
    tokens = F.regexp_extract_all(text, F.lit(rf"{REFERENCE}|[^&]+|&"), F.lit(0))
    decoded = F.array_join(F.transform(tokens, lambda t: F.when(t.startswith("&"), _decoded(t, closed)).otherwise(t)), "")
    return F.when(text.contains("&"), decoded).otherwise(text)


def without_non_text(fragment: Column) -> Column:
    """Scripts, styles and comments as an empty tag each: they part the text around them."""
    return F.regexp_replace(fragment, NON_TEXT, "<!>")


def text_nodes(cleaned: Column) -> Column:
    """array<string> of stripped, non-empty text nodes of a fragment without scripts, styles and comments."""
    return F.filter(F.transform(F.split(cleaned, TAG), lambda p: py_strip(unescape(p))), lambda p: p != "")


def element(cleaned: Column, tag: str) -> Column:
    """The inside of the first ``tag`` element, elements of the same name within it included; NULL when there is none.

    One fold over the tags of that name keeps the depth: the element ends where it returns to 0."""
    mark = rf"(?i)</?{tag}(?=[\s/>])[^>]*>"
    tags = F.regexp_extract_all(cleaned, F.lit(mark), F.lit(0))

    def state(first: Column, last: Column, depth: Column, seen: Column) -> Column:
        return F.struct(first.alias("first"), last.alias("last"), depth.alias("depth"), seen.alias("seen"))

    def step(acc: Column, t: Column) -> Column:
        empty, closing, inside = t.endswith("/>"), t.startswith("</"), acc["first"] >= 0
        depth = F.when(closing, F.when(inside, acc["depth"] - 1).otherwise(0)).when(empty, acc["depth"]).otherwise(acc["depth"] + 1)
        first = F.when(~inside & ~closing, acc["seen"]).otherwise(acc["first"])
        ends = (first >= 0) & (depth == 0)
        done = acc["last"] >= 0
        return state(F.when(done, acc["first"]).otherwise(first), F.when(done, acc["last"]).when(ends, acc["seen"]).otherwise(acc["last"]),
                     F.when(done, acc["depth"]).otherwise(depth), acc["seen"] + 1)

    none = F.lit(-1)

    def inner(acc: Column) -> Column:
        last = F.when(acc["last"] >= 0, acc["last"]).otherwise(acc["seen"])  # never closed: up to the end
        # piece i + 1 (from 1: i + 2) follows tag i; the tags between the pieces stay separators
        return F.when(acc["first"] >= 0, F.array_join(F.slice(F.split(cleaned, mark), acc["first"] + 2, last - acc["first"]), f"<{tag}>"))

    return F.aggregate(tags, state(none, none, F.lit(0), F.lit(0)), step, inner)
