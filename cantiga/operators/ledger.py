"""What became of everything a crawl named: one outcome for each artist, song and page.

Lists and pages meet in one full outer join per level, and what the steps of a run kept is
looked up by the same keys, so nothing can leave a run without a row here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantiga.operators import checks
from cantiga.operators.skew import lookup_join

SONG = ["artist_slug", "slug"]


def _flag(rows: DataFrame, keys: list[str], name: str, value: Column | None = None) -> DataFrame:
    """``keys`` with a column that is only there for these rows."""
    return rows.select(*keys, (F.lit(True) if value is None else value).alias(name)).dropDuplicates(keys)


def artist_outcomes(crawl, before: DataFrame, incoming: DataFrame, processed: DataFrame) -> DataFrame:
    """``level, key, outcome, detail`` of every listed artist and every artist page.

    stored      new in the catalogue            known       stored before, went on to its songs
    no_page     listed, without a page          unlisted    a page that no list names
    no_count    the page has no view counter    bad_number  its view count is no number
    rule        left out by a keyword           constraint  breaks a rule of the table
    """
    listed = _flag(crawl.artists, ["slug"], "_listed")
    pages = crawl.views.select("slug", "views", "views_text", F.lit(True).alias("_page")).dropDuplicates(["slug"])
    both = (
        listed.join(pages, "slug", "full_outer")
        .join(_flag(before, ["slug"], "_old"), "slug", "left")
        .join(_flag(incoming, ["slug"], "_valid", checks.is_valid("artists")), "slug", "left")
        .join(_flag(processed, ["slug"], "_done"), "slug", "left")
    )
    outcome = (
        F.when(F.col("_done"), F.when(F.col("_old"), "known").otherwise("stored"))
        .when(F.col("_listed").isNull() & F.col("_old").isNull(), "unlisted")
        .when(F.col("_page").isNull(), "no_page")
        .when(F.col("views_text").isNull() & F.col("views").isNull(), "no_count")
        .when(F.col("views").isNull(), "bad_number")
        .when(F.col("_listed").isNull() & F.col("_valid").isNull(), "unlisted")
        .when(F.col("_valid") == F.lit(False), "constraint")
        .otherwise("rule")
    )
    detail = F.when(outcome == "bad_number", F.col("views_text"))
    return both.select(F.lit("artist").alias("level"), F.col("slug").alias("key"), outcome.alias("outcome"), detail.alias("detail"))


def song_outcomes(crawl, before: DataFrame, processed: DataFrame, found: DataFrame, judged: DataFrame) -> DataFrame:
    """``level, key, outcome, detail`` of every listed song and every song page.

    stored          new in the catalogue          known         stored before
    orphan          a page that no list names     no_page       listed, without a page
    unknown_artist  its artist did not go on      no_container  the page holds no lyrics
    bad_number      its view count is no number   language      in another language
    rule            left out by a keyword or its length
    constraint      breaks a rule of the table
    """
    listed = _flag(crawl.songs, SONG, "_listed")
    page = ["views", "views_text", F.col("content").isNotNull().alias("_content"), F.lit(True).alias("_page")]
    pages = crawl.lyrics.select(*SONG, *page).dropDuplicates(SONG)
    owner = processed.select(F.col("slug").alias("artist_slug"), F.col("id").alias("artist_id"))
    kept = _flag(judged, SONG, "_kept", F.col("kept"))
    both = lookup_join(listed.join(pages, SONG, "full_outer").join(kept, SONG, "left"), owner, "artist_slug", "left", "slug")
    own = ["artist_id", "slug"]
    both = both.join(_flag(before, own, "_old"), own, "left")
    both = both.join(_flag(found, own, "_valid", checks.is_valid("songs")), own, "left")
    outcome = (
        F.when(F.col("_kept"), "stored")
        .when(F.col("_old"), "known")
        .when(F.col("_listed").isNull(), "orphan")
        .when(F.col("artist_id").isNull(), "unknown_artist")
        .when(F.col("_valid").isNull(), "rule")
        .when(~F.col("_valid"), "constraint")
        .when(F.col("_page").isNull(), "no_page")
        .when(~F.col("_content"), "no_container")
        .when(F.col("views").isNull(), "bad_number")
        .when(F.col("_kept").isNull(), "rule")
        .otherwise("language")
    )
    detail = F.when(outcome == "bad_number", F.col("views_text"))
    key = F.concat_ws("/", *SONG)
    return both.select(F.lit("song").alias("level"), key.alias("key"), outcome.alias("outcome"), detail.alias("detail"))


def losses(outcomes: DataFrame) -> DataFrame:
    """What a run could not use."""
    return outcomes.where(~F.col("outcome").isin("stored", "known"))
