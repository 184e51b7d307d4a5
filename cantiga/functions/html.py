"""HTML pieces by regular expression, as columns.

Markup is cut into segments with ``split`` at the opening tags, so a new ``<p>``,
``<li>`` or ``<a>`` ends the one before it, as in HTML5. Every pattern is linear in
the length of the page.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantiga.functions.text import unescape, ws_trim
from cantiga.schemas import Selector

# The rest of a tag; a ">" inside quotes does not end it, unless the quotes do not pair.
_ATTRS = r"""(?:(?:[^>"']++|"[^"]*+"|'[^']*+')*+(?=>)|[^>]*+)"""
_ANY_TAG = "<[^>]*>"
# More segments than a page can have; start plus length must stay an int.
_TO_END = 2_000_000_000

# Comments, scripts and styles hold no text. They leave an empty tag behind, so that
# the text before and after stays two pieces.
_HIDDEN = r"(?is)<(?:!--.*?--|script\b.*?</script\s*|style\b.*?</style\s*)>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, also where it is used twice."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip_hidden(html: Column) -> Column:
    return F.regexp_replace(html, _HIDDEN, "<!>")


def open_tag(sel: Selector) -> str:
    """Pattern of the opening tag, the class matched as a whole token."""
    tag = rf"(?i)<{re.escape(sel.tag)}(?=[\s>/])"
    if sel.css_class is None:
        return tag + _ATTRS + ">"
    name = f"(?-i:{re.escape(sel.css_class)})"
    value = (
        rf""""(?:[^"]*\s)?{name}(?:\s[^"]*)?"|'(?:[^']*\s)?{name}(?:\s[^']*)?'"""
        rf"""|{name}(?=[\s>])"""
    )
    return rf"{tag}[^>]*?\sclass\s*=\s*(?:{value}){_ATTRS}>"


def segments(html: Column, pattern: str) -> Column:
    """What follows each match of ``pattern``, up to the next match."""
    return F.slice(F.split(html, pattern), 2, _TO_END)


def before_close(segment: Column, tag: str) -> Column:
    """A segment up to its closing tag, or whole where the tag is left open."""
    return F.regexp_extract(segment, rf"(?is)^(.*?)(?:</{re.escape(tag)}\s*>|\z)", 1)


def attribute(attrs: Column, name: str) -> Column:
    """Decoded attribute value; NULL when absent, ``''`` when empty."""
    raw = F.regexp_extract(
        attrs, rf"""(?is)(?:^|[\s"']){name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1
    )
    return let(
        raw,
        lambda quoted: F.when(
            quoted != "",
            let(F.regexp_replace(quoted, r"""(?s)^(["'])(.*)\1$""", "$2"), unescape),
        ),
    )


def plain_text(html: Column) -> Column:
    """Text with the tags removed and nothing put in their place."""
    return let(F.regexp_replace(html, _ANY_TAG, ""), unescape)


def text_lines(html: Column) -> Column:
    """Non-blank text pieces between tags, each trimmed, joined by line breaks."""
    pieces = F.transform(F.split(html, _ANY_TAG), lambda piece: ws_trim(unescape(piece)))
    return F.array_join(F.filter(pieces, lambda piece: piece != ""), "\n")


def anchors(html: Column) -> Column:
    """Each ``<a>`` as ``struct(attrs, inner)``, in page order."""
    opened = F.transform(
        segments(html, r"(?i)<a(?=[\s>/])"),
        lambda seg: F.struct(
            F.regexp_extract(seg, f"(?s)^({_ATTRS})>", 1).alias("attrs"),
            F.regexp_extract(seg, rf"(?is)^{_ATTRS}>(.*?)(?:</a\s*>|\z)", 1).alias("inner"),
        ),
    )
    return opened


def with_inner(df: DataFrame, html: str, sel: Selector, out: str) -> DataFrame:
    """Add the inner HTML of the first matching element; NULL when there is none.

    The element may hold others of its own tag. The text after the opening tag is
    split at every such tag and a running depth finds the closing one.
    """
    tag = re.escape(sel.tag)
    opens = rf"(?i)^<{tag}(?=[\s>/])"
    closes = rf"(?i)^</{tag}(?=[\s>/])"
    start = F.struct(
        F.lit(0).alias("depth"), F.lit(0).alias("inside"), F.lit(False).alias("closed")
    )

    def step(state: Column, part: Column) -> Column:
        depth = (
            state["depth"]
            + F.when(part.rlike(closes), F.lit(-1)).when(part.rlike(opens), F.lit(1)).otherwise(0)
        )
        closed = state["closed"] | (depth < 0)
        return F.struct(
            depth.alias("depth"),
            (state["inside"] + F.when(closed, F.lit(0)).otherwise(1)).alias("inside"),
            closed.alias("closed"),
        )

    rest, parts = f"_rest_{out}", f"_parts_{out}"
    return (
        df.withColumn(rest, F.get(F.split(F.col(html), open_tag(sel), 2), F.lit(1)))
        .withColumn(parts, F.split(F.col(rest), rf"(?i)(?=</?{tag}[\s>/])"))
        .withColumn(
            out,
            F.array_join(
                F.slice(parts, F.lit(1), F.aggregate(parts, start, step)["inside"]), ""
            ),
        )
        .drop(rest, parts)
    )
