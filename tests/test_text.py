import re

import pytest
from conftest import column
from pyspark.sql import functions as F

from cantiga.functions import names as N
from cantiga.functions import text as X


def test_trim_takes_every_kind_of_whitespace(texts):
    values = ["  a b ", "  x　", "\x1c\x85y\x1f", "\t\n", "", "z"]
    assert column(texts(*values), X.ws_trim(F.col("t"))) == [v.strip() for v in values]


def test_whitespace_class_is_the_one_of_python(texts):
    chars = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    got = column(texts(*chars), F.col("t").rlike(f"^[{X.WS_CLASS}]$"))
    assert got == [c.isspace() for c in chars]
    assert sorted(X.WS_CHARS) == [c for c in chars if c.isspace()]


@pytest.mark.parametrize(
    "value",
    [
        "  Oi,  mundo\n\ncruel! 12 vezes 3x ",
        "um 1 dois",
        "São João — não_é? ½ ²",
        "tab\tand nbsp line",
        " 12 ",
        "!!!",
        "",
    ],
)
def test_clean_for_detection(texts, value):
    # Trim, collapse, drop digits, drop everything but word characters and whitespace.
    expected = re.sub(r"\s+", " ", value.strip())
    expected = re.sub(r"[^\w\s]", "", re.sub(r"[0-9]+", "", expected))
    assert column(texts(value), X.clean_for_detection(F.col("t"))) == [expected]


def test_removed_number_leaves_two_spaces(texts):
    assert column(texts("um 1 dois"), X.clean_for_detection(F.col("t"))) == ["um  dois"]


def test_dotted_int(texts):
    values = ["1234", "1.234.567", " 12 ", "1,234", "", "12 mil", "1_000", "3.000.000.000", None, "-5"]
    expected = [1234, 1234567, 12, None, None, None, None, 3_000_000_000, None, -5]
    assert column(texts(*values), X.dotted_int(F.col("t"))) == expected


def test_unescape(texts):
    cases = {
        "a &amp; b": "a & b",
        "&amp;lt;": "&lt;",
        "&lt;p&gt; &quot;x&quot; &apos;": "<p> \"x\" '",
        "&copy;&nbsp;&middot;": "© ·",
        "cora&ccedil;&atilde;o &amp; paix&atilde;o": "coração & paixão",
        "&#231;&#xE7;&#x1F600;": "çç😀",
        "&#146;&#x80;&#x9f;&#129;": "\u2019\u20ac\u0178\x81",
        "&#0;&#55296;&#99999999;": "&#0;&#55296;&#99999999;",
        "&unknown; & &": "&unknown; & &",
        "&eacute;&amp;lt;": "é&lt;",
        "": "",
    }
    got = column(texts(*cases), X.unescape(F.col("t")))
    assert got == list(cases.values())


def test_invalid_bytes_are_dropped(spark):
    raw = [bytearray(b"ol\xc3\xa1\xff!"), bytearray(b"\xc3"), bytearray(b"ok")]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(raw)], "i int, b binary")
    assert column(df, X.utf8_text(F.col("b"))) == [bytes(b).decode("utf-8", "ignore") for b in raw]


def test_letter_bucket(texts):
    cases = {
        "Ana": "A", "ana": "A", "3 Palavrinhas": "#", "٣": "#", "Ágape": "Other",
        "²": "Other", "ﬆ": "Other", "!": "Other", "": "Other", "ß": "Other", "zé": "Z",
    }
    assert column(texts(*cases), N.letter_bucket(F.col("t"))) == list(cases.values())


def test_bucket_order_is_plain_string_order():
    keys = ["#", *"ABCDEFGHIJKLMNO", "Other", *"PQRSTUVWXYZ"]
    assert sorted(keys) == keys


def test_paths_and_slugs(spark):
    row = spark.range(1).select(
        N.artist_path(F.lit("ana")),
        N.song_path(F.lit("ana"), F.lit("s1")),
        N.strip_slashes(F.lit("//a//")),
        N.last_segment(F.lit("/x/y/song/")),
        N.last_segment(F.lit("song")),
        N.url_path(F.lit("https://h.example/a/b/?q=/c#d")),
        N.url_host(F.lit("https://h.example/a/b")),
    ).first()
    assert list(row) == ["/ana/", "/ana/s1", "a", "song", "song", "/a/b/", "h.example"]


def test_export_name_and_body(spark):
    long = "ç" * 255
    row = spark.range(1).select(
        N.export_name(F.lit("AC/DC"), F.lit("T.N.T/live")),
        N.file_name(N.export_name(F.lit(long), F.lit("one"))),
        N.file_name(N.export_name(F.lit(long), F.lit("two"))),
        N.export_body(F.lit("Artist"), F.lit("Song"), F.lit("a\n\nb")),
    ).first()
    assert row[0] == "AC_DC - T.N.T_live.txt"
    assert row[1] != row[2] and all(len(x.encode()) <= 255 for x in row[1:3])
    whole = spark.range(1).select(N.export_name(F.lit(long), F.lit("one")), N.file_name(F.lit("a - b.txt"))).first()
    assert list(whole) == [long + " - one.txt", "a - b.txt"]
    assert row[3] == "Song\nArtist\n\na\n\nb"
