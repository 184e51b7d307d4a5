"""A crawl as three tables, whatever layout the pages came in.

artists  ``slug, name, seq``                     artist links, in page order
views    ``slug, views, views_text``             view count found for an artist
songs    ``artist_slug, slug, name, seq``        song list entries
lyrics   ``artist_slug, slug, page, views, views_text, content``   one row per song page

``page`` is the arrival of a page and its id, ``seq`` a page and the place on it: the position
in the crawl, unique within each table. A crawl in one piece is arrival 0.

Pages are parsed once, without a shuffle, and their rows can be kept: a crawl is put
together from the parsed rows of any number of arrivals, and a page fetched again counts as
its last copy.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantiga.functions import html as H
from cantiga.functions import names as N
from cantiga.functions.text import dotted_int, ws_trim
from cantiga.operators.extract import (
    explode_rows,
    extract_site,
    song_views,
    with_lyric_text,
)
from cantiga.operators.skew import lookup_join, small
from cantiga.schemas import Selector, SiteLayout
from cantiga.session import materialize


@dataclass(frozen=True)
class Crawl:
    artists: DataFrame
    views: DataFrame
    songs: DataFrame
    lyrics: DataFrame


class Crawler(Protocol):
    """How pages of a layout become a crawl: row by row, and then together."""

    def parse(self, pages: DataFrame) -> DataFrame:
        """Narrow rows and texts of pages, with their ``page_id`` and without their HTML."""

    def assemble(self, parsed: DataFrame, stored: DataFrame | None = None) -> Crawl:
        """The crawl of parsed rows with their ``page``, after which artists are ``stored``."""

    def waiting(self, parsed: DataFrame, artists: DataFrame, songs: DataFrame) -> DataFrame:
        """The parsed rows, or what is left of them, that later pages may still need.

        ``artists`` and ``songs`` are the stored ones after a run over the rows.
        """


def page_of(arrival: int | Column, page_id: str = "page_id") -> Column:
    arrival = F.lit(arrival) if isinstance(arrival, int) else arrival
    return F.struct(arrival.cast("bigint").alias("arrival"), F.col(page_id).cast("bigint").alias("page_id"))


def position(page: Column, pos: Column) -> Column:
    return F.struct(page.alias("page"), pos.cast("int").alias("pos"))


def before_all() -> Column:
    """A position before every page."""
    none = F.lit(-1).cast("bigint")
    return position(F.struct(none.alias("arrival"), none.alias("page_id")), F.lit(-1))


def crawl_pages(pages: DataFrame, crawler: Crawler) -> Crawl:
    """Crawl of pages that came together; they are parsed and written once."""
    parsed = crawler.parse(pages).withColumn("page", page_of(0))
    kinds = ["kind"] if "kind" in parsed.columns else None
    return crawler.assemble(materialize(parsed, "parsed", partition_by=kinds))


def crawl_site(pages: DataFrame, layout: SiteLayout) -> Crawl:
    return crawl_pages(pages, SitePages(layout))


def crawl_articles(pages: DataFrame) -> Crawl:
    return crawl_pages(pages, ArticlePages())


def _latest(parsed: DataFrame, keys: list[str]) -> DataFrame:
    """Parsed rows without the older copies of a page.

    The copies to skip are few, so they are listed and the texts stay where they are. The
    rows that are left are written once, for all the tables made of them, if any go.
    """
    copies = parsed.select("page", *keys)
    last = copies.groupBy(*keys).agg(F.max("page").alias("page"))
    stale = materialize(copies.join(last, [*keys, "page"], "left_anti").select("page"), "stale")
    if stale.isEmpty():
        return parsed
    kept = parsed.join(F.broadcast(stale) if small(stale) else stale, "page", "left_anti")
    return materialize(kept.select(*parsed.columns), "current")


@dataclass(frozen=True)
class SitePages:
    """A site with index pages, artist pages and song pages."""

    layout: SiteLayout

    def parse(self, pages: DataFrame) -> DataFrame:
        return extract_site(pages, self.layout)

    def assemble(self, parsed: DataFrame, stored: DataFrame | None = None) -> Crawl:
        return _site_crawl(_latest(parsed, ["kind", "path"]))

    def waiting(self, parsed: DataFrame, artists: DataFrame, songs: DataFrame) -> DataFrame:
        """Links to artists that are not stored, artist pages of these, entries of songs that
        are not stored, and song pages that no stored artist lists.

        A song page that was listed has been judged: it is looked at again when a new copy
        of it comes, for which its entry waits.
        """
        current = _latest(parsed, ["kind", "path"])
        known = artists.select(F.col("slug").alias("artist_slug"), F.col("id").alias("artist_id"))

        def entries(rows: DataFrame, name: str) -> DataFrame:
            """The entries that are left, together again per page."""
            return rows.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("pos", "name", "slug"))).alias(name))

        index = current.where(F.col("kind") == "index")
        links = explode_rows(index, "links", ["page"])
        links = links.join(known.select(F.col("artist_slug").alias("slug")), "slug", "left_anti")
        index = index.drop("links").join(entries(links, "links"), "page")

        lists = current.where(F.col("kind") == "artist").join(known, F.col("path") == F.col("artist_slug"), "left")
        lists = materialize(lists.drop("artist_slug"), "waiting-lists")
        listed = explode_rows(lists.withColumnRenamed("path", "artist_slug"), "songs", ["page", "artist_slug", "artist_id"])
        stored = songs.select("artist_id", "slug")
        left = entries(listed.join(stored, ["artist_id", "slug"], "left_anti"), "songs")
        none = F.array().cast(parsed.schema["songs"].dataType)
        lists = lists.drop("songs").join(left, "page", "left").where(F.col("artist_id").isNull() | F.col("songs").isNotNull())
        lists = lists.withColumn("songs", F.coalesce("songs", none))

        parts = F.split("path", "/")
        named = current.where(F.col("kind") == "song").select(
            "page", F.get(parts, F.lit(0)).alias("artist_slug"), F.get(parts, F.lit(1)).alias("slug")
        )
        judged = listed.where(F.col("artist_id").isNotNull()).select("artist_slug", "slug").distinct()
        named = named.join(judged, ["artist_slug", "slug"], "left_anti")
        named = lookup_join(named, known, "artist_slug", "left", "slug").join(stored, ["artist_id", "slug"], "left_anti")
        named = materialize(named.select("page"), "waiting-songs")
        # Texts stay where they are while the pages can be broadcast.
        texts = current.where(F.col("kind") == "song").join(F.broadcast(named) if small(named) else named, "page", "left_semi")
        parts_ = [rows.select(*parsed.columns) for rows in (index, lists, texts)]
        return parts_[0].unionByName(parts_[1]).unionByName(parts_[2])


@dataclass(frozen=True)
class ArticlePages:
    """Single-song pages: the host is the artist, the page is the song.

    An artist has the views of their most viewed page, or of one before that is stored.
    """

    def parse(self, pages: DataFrame) -> DataFrame:
        return extract_articles(pages).drop("url")

    def assemble(self, parsed: DataFrame, stored: DataFrame | None = None) -> Crawl:
        return _article_crawl(_latest(parsed, ["page_id"]), stored)

    def waiting(self, parsed: DataFrame, artists: DataFrame, songs: DataFrame) -> DataFrame:
        """Pages of artists that are not stored, as none of their pages had a view count."""
        current = _latest(parsed, ["page_id"])
        hosts = current.select("host").distinct().join(artists.select(F.col("slug").alias("host")), "host", "left_anti")
        hosts = materialize(hosts, "waiting-hosts")
        kept = current.join(F.broadcast(hosts) if small(hosts) else hosts, "host", "left_semi")
        return kept.select(*parsed.columns)


def _site_crawl(current: DataFrame) -> Crawl:
    index = current.where(F.col("kind") == "index")
    artist = current.where(F.col("kind") == "artist")
    song = current.where(F.col("kind") == "song")
    links = explode_rows(index, "links", ["page"])
    listed = explode_rows(
        artist.withColumnRenamed("path", "artist_slug"), "songs", ["page", "artist_slug"]
    )
    seq = position(F.col("page"), F.col("pos")).alias("seq")
    parts = F.split("path", "/")
    return Crawl(
        artists=links.select("slug", "name", seq),
        views=artist.select(
            F.col("path").alias("slug"),
            dotted_int(F.col("views_text")).alias("views"),
            "views_text",
        ),
        songs=listed.select("artist_slug", "slug", "name", seq),
        lyrics=song.select(
            F.get(parts, F.lit(0)).alias("artist_slug"),
            F.get(parts, F.lit(1)).alias("slug"),
            "page",
            song_views(F.col("views_text")).alias("views"),
            "views_text",
            "content",
        ),
    )


def extract_articles(pages: DataFrame) -> DataFrame:
    """Pages of many sites with one song each.

    Gives ``page_id, url, host, name, views, content``.

    The heading names the song, the article's paragraphs are its lyrics, and the number
    in the path is its view count.
    """
    heading = F.get(F.split(F.col("html"), r"(?i)<h1(?=[\s>/])", 2), F.lit(1))
    title = F.regexp_extract(heading, r"(?is)^[^>]*>(.*?)(?:</h1\s*>|\z)", 1)
    cleaned = pages.select(
        "page_id",
        "url",
        N.url_host(F.col("url")).alias("host"),
        dotted_int(F.regexp_extract(N.url_path(F.col("url")), "^/[a-z]+/([0-9]+)", 1)).alias(
            "views"
        ),
        H.strip_hidden(F.col("html")).alias("html"),
    )
    return with_lyric_text(cleaned, "html", Selector("article"), "content").select(
        "page_id",
        "url",
        "host",
        ws_trim(H.plain_text(title)).alias("name"),
        "views",
        "content",
    )


def _article_crawl(found: DataFrame, stored: DataFrame | None = None) -> Crawl:
    seq = position(F.col("page"), F.lit(0))
    per_host = found.groupBy(F.col("host").alias("slug")).agg(
        F.max("views").alias("views"), F.min(seq).alias("seq")
    )
    if stored is not None:
        before = stored.select("slug", F.col("views").alias("_before"))
        per_host = per_host.join(before, "slug", "left").withColumn("views", F.greatest("views", "_before"))
    slug = F.col("page_id").cast("string").alias("slug")
    artist_slug = F.col("host").alias("artist_slug")
    views_text = F.col("views").cast("string").alias("views_text")
    return Crawl(
        artists=per_host.select("slug", F.col("slug").alias("name"), "seq"),
        views=per_host.select("slug", "views", views_text),
        songs=found.select(artist_slug, slug, "name", seq.alias("seq")),
        lyrics=found.select(artist_slug, slug, "page", "views", views_text, "content"),
    )
