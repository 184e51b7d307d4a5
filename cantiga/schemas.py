"""Table schemas and page layouts.

Schemas are always given, never inferred, so that an empty or freshly created
table has the same shape as a full one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(*field) for field in fields])


PAGES = _schema(
    ("page_id", T.LongType(), True),
    ("url", T.StringType(), True),
    ("html", T.StringType(), True),
)

ARTISTS = _schema(
    ("id", T.LongType(), True),
    ("name", T.StringType(), True),
    ("slug", T.StringType(), True),
    ("views", T.LongType(), True),
    ("added_date", T.TimestampNTZType(), True),
)

SONGS = _schema(
    ("id", T.LongType(), True),
    ("artist_id", T.LongType(), True),
    ("name", T.StringType(), True),
    ("slug", T.StringType(), True),
    ("views", T.LongType(), True),
    ("added_date", T.TimestampNTZType(), True),
)

LYRICS = _schema(
    ("id", T.LongType(), True),
    ("song_id", T.LongType(), True),
    ("content", T.StringType(), True),
    ("last_updated", T.TimestampNTZType(), True),
)

TABLES = {"artists": ARTISTS, "songs": SONGS, "lyrics": LYRICS}

RULES = _schema(
    ("scope", T.StringType(), True),
    ("keyword", T.StringType(), True),
)

QUARANTINE = _schema(
    ("source", T.StringType(), True),
    ("key", T.StringType(), True),
    ("rule", T.StringType(), True),
    ("detail", T.StringType(), True),
)

# Names and slugs hold at most this many characters.
MAX_NAME_CHARS = 255


@dataclass(frozen=True)
class Selector:
    """An element by tag and, where given, one of its class tokens."""

    tag: str
    css_class: str | None = None


@dataclass(frozen=True)
class SiteLayout:
    """Where a site keeps its link list, song lists, view counts and lyrics.

    The class names are fixed values of the page format; another site passes its own.
    ``index_path`` is the page that lists the artists.
    """

    index_path: str = "/"
    views: Selector = Selector("div", "head-info-exib")
    song_row: Selector = Selector("li", "songList-table-row")
    song_link: Selector = Selector("a", "songList-table-songName")
    lyrics: Selector = Selector("div", "lyric-original")
