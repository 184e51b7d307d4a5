"""Page table to rows: links, view counts, song lists and lyric text.

All of it is row by row and stays in the JVM; no step here shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantiga.functions import html as H
from cantiga.functions import names as N
from cantiga.functions.text import dotted_int, ws_trim
from cantiga.schemas import Selector, SiteLayout

_BOLD = r"(?i)<b(?=[\s>/])"


def link_array(html: Column) -> Column:
    """Links as an array of ``struct(pos, name, slug)``, for every ``<a>`` with an href."""
    found = F.transform(
        H.anchors(html),
        lambda a, i: F.struct(
            i.alias("pos"),
            ws_trim(H.plain_text(a["inner"])).alias("name"),
            N.strip_slashes(H.attribute(a["attrs"], "href")).alias("slug"),
        ),
    )
    return F.filter(found, lambda link: N.is_single_segment(link["slug"]))


def song_array(html: Column, row: Selector, link: Selector) -> Column:
    """Song list rows as an array of ``struct(pos, name, slug)``.

    The first matching link of a row names the song; a row without one gives nothing.
    """
    tag = H.open_tag(link)

    def first_link(segment: Column, pos: Column) -> Column:
        body = H.before_close(segment, row.tag)
        return F.struct(
            pos.alias("pos"),
            F.regexp_extract(body, f"(?s)({tag})", 1).alias("opened"),
            F.get(F.split(body, tag, 2), F.lit(1)).alias("rest"),
        )

    def parts(found: Column) -> Column:
        return F.struct(
            found["pos"].alias("pos"),
            ws_trim(H.attribute(found["opened"], "title")).alias("title"),
            ws_trim(H.plain_text(H.before_close(found["rest"], link.tag))).alias("text"),
            N.last_segment(H.attribute(found["opened"], "href")).alias("slug"),
        )

    def song(part: Column) -> Column:
        title = F.nullif(part["title"], F.lit(""))
        return F.struct(
            part["pos"].alias("pos"),
            F.coalesce(title, part["text"]).alias("name"),
            part["slug"].alias("slug"),
        )

    rows = F.transform(H.segments(html, H.open_tag(row)), first_link)
    songs = F.transform(F.transform(rows, parts), song)
    return F.filter(songs, lambda found: found["slug"].isNotNull())


def explode_rows(df: DataFrame, array: str, keep: list[str]) -> DataFrame:
    """One row per array entry, with the kept columns beside it."""
    return df.select(*keep, F.explode(array).alias("_row")).select(*keep, "_row.*")


def extract_links(pages: DataFrame) -> DataFrame:
    """Artist links of each page: ``page_id, pos, name, slug``."""
    found = pages.select("page_id", link_array(H.strip_hidden(F.col("html"))).alias("links"))
    return explode_rows(found, "links", ["page_id"])


def extract_songs(pages: DataFrame, row: Selector, link: Selector) -> DataFrame:
    """Song list rows of each page: ``page_id, pos, name, slug``."""
    found = pages.select(
        "page_id", song_array(H.strip_hidden(F.col("html")), row, link).alias("songs")
    )
    return explode_rows(found, "songs", ["page_id"])


def with_views_text(df: DataFrame, html: str, sel: Selector, out: str) -> DataFrame:
    """Add the text of the first ``<b>`` in the view counter; NULL when there is none."""
    box = f"_box_{out}"
    bold = F.get(F.split(F.col(box), _BOLD, 2), F.lit(1))
    inner = F.regexp_extract(bold, r"(?is)^[^>]*>(.*?)(?:</b\s*>|\z)", 1)
    return (
        H.with_inner(df, html, sel, box).withColumn(out, H.plain_text(inner)).drop(box)
    )


def with_lyric_text(df: DataFrame, html: str, sel: Selector, out: str) -> DataFrame:
    """Add the lyric text; NULL when the page has no lyric container.

    Pieces of a paragraph are joined by a line break and paragraphs by a blank line.
    An empty paragraph still counts.
    """
    box = f"_box_{out}"
    paragraphs = F.transform(
        H.segments(F.col(box), r"(?i)<p(?=[\s>/])"),
        lambda seg: H.text_lines(
            F.regexp_extract(seg, r"(?is)^[^>]*>(.*?)(?:</p\s*>|\z)", 1)
        ),
    )
    return (
        H.with_inner(df, html, sel, box)
        .withColumn(out, F.array_join(paragraphs, "\n\n"))
        .drop(box)
    )


def song_views(text: Column) -> Column:
    """A song without a view counter has 0 views; one that is no number gives NULL."""
    return F.when(text.isNull(), F.lit(0).cast("bigint")).otherwise(dotted_int(text))


def extract_site(pages: DataFrame, layout: SiteLayout) -> DataFrame:
    """One pass over a site's pages.

    The path tells what a page is: the artist index, an artist (one segment) or a song
    (two). Each page is only searched for what its kind holds. Gives ``page_id, kind,
    path, views_text, links, songs, content``; the page itself is not carried on. The
    path of an index page is its whole URL.
    """
    path = N.strip_slashes(N.url_path(F.col("url")))
    index = layout.index_path.strip("/")
    depth = F.size(F.split(path, "/"))
    kind = (
        F.when(path == index, "index")
        .when((path != "") & (depth == 1), "artist")
        .when(depth == 2, "song")
    )
    # An index may come in several pages that differ in the query only.
    place = F.when(kind == "index", F.col("url")).otherwise(path)
    typed = (
        pages.select("page_id", place.alias("path"), kind.alias("kind"), "html")
        .where(F.col("kind").isNotNull())
        .withColumn("html", H.strip_hidden(F.col("html")))
        .withColumn("_index", F.when(F.col("kind") == "index", F.col("html")))
        .withColumn("_artist", F.when(F.col("kind") == "artist", F.col("html")))
        .withColumn("_song", F.when(F.col("kind") == "song", F.col("html")))
        .withColumn("_counted", F.coalesce("_artist", "_song"))
    )
    typed = with_views_text(typed, "_counted", layout.views, "views_text")
    typed = with_lyric_text(typed, "_song", layout.lyrics, "content")
    return typed.select(
        "page_id",
        "kind",
        "path",
        "views_text",
        link_array(F.col("_index")).alias("links"),
        song_array(F.col("_artist"), layout.song_row, layout.song_link).alias("songs"),
        "content",
    )
