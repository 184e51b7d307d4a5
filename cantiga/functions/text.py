"""Text columns: whitespace, cleaning for language detection, numbers, HTML entities."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as whitespace, as a regex class body and
# as a list of characters to trim. Both name the same set.
WS_CLASS = r"\t-\r\x1c-\x1f\x85\p{Z}"
WS_CHARS = "".join(
    chr(c)
    for c in [
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    ]
)

# Entities decoded by plain replacement, the ampersand last so that
# "&amp;lt;" becomes "&lt;" and stops there.
COMMON_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]
# Names that need their semicolon, and those that also stand without it.
_CLOSED_ENTITIES = json.dumps({n[:-1]: text for n, text in html5.items() if n.endswith(";")})
_OPEN_NAMES = {n: text for n, text in html5.items() if not n.endswith(";")}
_OPEN_ENTITIES, _LONGEST_OPEN = json.dumps(_OPEN_NAMES), max(map(len, _OPEN_NAMES))
_OTHER_ENTITY = "&(?!(?:lt|gt|quot|apos|nbsp|copy|middot|amp);)(?:#[0-9xX]|[A-Za-z])"


def ws_trim(col: Column) -> Column:
    """Drop whitespace of any kind at both ends (``trim`` knows U+0020 only)."""
    return F.btrim(col, F.lit(WS_CHARS))


def ws_collapse(col: Column) -> Column:
    """Each run of whitespace becomes one space; a single space is left alone."""
    return F.regexp_replace(col, f"[{WS_CLASS}]{{2,}}|[{WS_CLASS}&&[^ ]]", " ")


def drop_digits(col: Column) -> Column:
    return F.regexp_replace(col, "[0-9]+", "")


def keep_word_chars(col: Column) -> Column:
    """Delete everything but letters, numbers, ``_`` and whitespace."""
    return F.regexp_replace(col, rf"[^a-zA-Z \p{{L}}\p{{N}}_{WS_CLASS}]+", "")


def clean_for_detection(col: Column) -> Column:
    """Trim, collapse whitespace, drop digits, then punctuation, in that order.

    Whitespace is not collapsed again, so a removed number leaves two spaces.
    """
    return keep_word_chars(drop_digits(ws_collapse(ws_trim(col))))


def dotted_int(col: Column) -> Column:
    """``1.234.567`` to 1234567; NULL for anything that is not a whole number."""
    digits = ws_trim(F.replace(col, F.lit("."), F.lit("")))
    return F.when(digits.rlike("^[+-]?[0-9]+$"), digits.try_cast("bigint"))


def utf8_text(col: Column) -> Column:
    """Bytes to text, dropping bytes that are not valid UTF-8."""
    valid = F.make_valid_utf8(col.cast("string"))
    return F.replace(valid, F.lit("�"), F.lit(""))


def _unescape_common(col: Column) -> Column:
    for entity, char in COMMON_ENTITIES:
        col = F.replace(col, F.lit(entity), F.lit(char))
    return col


def _windows_1252() -> dict[str, str]:
    """Numbers 128 to 159 mean Windows-1252 characters in HTML, but for five without one."""
    found = {n: bytes([n]).decode("cp1252", "ignore") for n in range(0x80, 0xA0)}
    return {str(n): char for n, char in found.items() if char}


def _code_point(number: Column) -> Column:
    """Character of a code point; NULL outside Unicode and for surrogates."""
    ok = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    remapped = F.from_json(F.lit(json.dumps(_windows_1252())), "map<string,string>")
    plain = F.when(ok, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
    return F.coalesce(F.try_element_at(remapped, number.cast("string")), plain)


def _unescape_piece(piece: Column) -> Column:
    """Decode the one entity a piece may start with.

    A name with its semicolon is looked up whole. Otherwise the longest beginning that stands
    without one is decoded, and what follows it is text. Numbers may lack the semicolon too.
    """
    closed = F.from_json(F.lit(_CLOSED_ENTITIES), "map<string,string>")
    open_ = F.from_json(F.lit(_OPEN_ENTITIES), "map<string,string>")
    name = F.regexp_extract(piece, "^&([A-Za-z][0-9A-Za-z]*)", 1)
    whole = F.try_element_at(closed, F.regexp_extract(piece, "^&([A-Za-z][0-9A-Za-z]*);", 1))
    beginnings = F.transform(
        F.sequence(F.lit(_LONGEST_OPEN), F.lit(2), F.lit(-1)),
        lambda n: F.when(n <= F.length(name), F.struct(n.alias("n"), F.try_element_at(open_, F.substring(name, F.lit(1), n)).alias("text"))),
    )
    longest = F.get(F.filter(beginnings, lambda b: b["text"].isNotNull()), F.lit(0))
    decimal = _code_point(F.regexp_extract(piece, "^&#([0-9]{1,8})(?![0-9])", 1).try_cast("bigint"))
    digits = F.regexp_extract(piece, "^&#[xX]([0-9A-Fa-f]{1,8})(?![0-9A-Fa-f])", 1)
    hexadecimal = _code_point(F.conv(F.nullif(digits, F.lit("")), 16, 10).try_cast("bigint"))
    return (
        F.when(decimal.isNotNull(), F.concat(decimal, F.regexp_replace(piece, "^&#[0-9]+;?", "")))
        .when(hexadecimal.isNotNull(), F.concat(hexadecimal, F.regexp_replace(piece, "^&#[xX][0-9A-Fa-f]+;?", "")))
        .when(whole.isNotNull(), F.concat(whole, F.regexp_replace(piece, "^&[0-9A-Za-z]+;", "")))
        .when(longest.isNotNull(), F.concat(longest["text"], F.substring(piece, longest["n"] + 2, F.length(piece))))
        .otherwise(piece)
    )


def unescape(col: Column) -> Column:
    """Decode HTML entities.

    Text with common entities only takes the short way of plain replacements. Other names,
    names without their semicolon and numbers send the text through one pass over its pieces.
    """
    pieces = F.transform(F.split(col, "(?=&)"), _unescape_piece)
    return F.when(col.rlike(_OTHER_ENTITY), F.array_join(pieces, "")).otherwise(
        _unescape_common(col)
    )
