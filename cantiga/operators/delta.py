"""What is new or changed: keyed anti-joins and lookups between crawl and catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantiga.functions import names as N
from cantiga.operators.skew import lookup_join


def once_per_key(crawled: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """One row per key with the first name, the last views and the first position.

    This is what writing the rows one after the other leaves behind. Rows of a key are
    folded before the shuffle, so a key with many copies costs no more than another.
    """
    return crawled.groupBy(*keys).agg(
        F.min_by("name", seq).alias("name"),
        F.max_by("views", seq).alias("views"),
        F.min(seq).alias(seq),
    )


def latest_per_key(rows: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """The whole last row of each key. ``seq`` is unique within a key.

    Only keys and positions are aggregated; the wide columns move once.
    """
    last = rows.groupBy(*keys).agg(F.max(seq).alias(seq))
    return rows.join(last, [*keys, seq], "left_semi")


def new_artists(crawled: DataFrame, stored: DataFrame) -> DataFrame:
    """Artists not stored. ``crawled`` has one row per slug."""
    return crawled.join(stored.select("slug"), "slug", "left_anti")


def new_songs(crawled: DataFrame, stored: DataFrame) -> DataFrame:
    """Songs not stored. ``crawled`` has one row per song, so no key is large."""
    keys = ["artist_id", "slug"]
    return crawled.join(stored.select(*keys), keys, "left_anti")


def views_changed(old: Column, new: Column) -> Column:
    return ~old.eqNullSafe(new)


def artist_delta(crawled: DataFrame, stored: DataFrame) -> DataFrame:
    """What each crawled artist calls for: ``add``, ``update`` or ``keep``.

    Artists without a view count are left out.
    """
    old = stored.select("slug", F.col("id"), F.col("views").alias("old_views"))
    action = (
        F.when(F.col("id").isNull(), "add")
        .when(views_changed(F.col("old_views"), F.col("views")), "update")
        .otherwise("keep")
    )
    return (
        crawled.where(F.col("views").isNotNull())
        .join(old, "slug", "left")
        .withColumn("action", action)
    )


def refresh_views(stored: DataFrame, crawled: DataFrame) -> DataFrame:
    """Stored artists with the crawled view count where there is one."""
    fresh = crawled.select("slug", F.col("views").alias("_fresh"))
    return (
        stored.join(fresh, "slug", "left")
        .withColumn("views", F.coalesce("_fresh", "views"))
        .select(*stored.columns)
    )


def processed_artists(added: DataFrame, existing: DataFrame) -> DataFrame:
    return added.unionByName(existing)


def songs_with_artist(songs: DataFrame, artists: DataFrame, spread: str = "slug") -> DataFrame:
    """Crawled songs with the id of their artist; songs of other artists are left out."""
    ids = artists.select(F.col("slug").alias("artist_slug"), F.col("id").alias("artist_id"))
    return lookup_join(songs, ids, "artist_slug", "inner", spread)


def pages_of(pages: DataFrame, entities: DataFrame, path: str = "path") -> DataFrame:
    """Pages with the entity their path names, the outer slashes not compared."""
    keyed = pages.withColumn("_path", N.strip_slashes(N.url_path(F.col("url"))))
    wanted = entities.withColumn("_path", N.strip_slashes(F.col(path)))
    return lookup_join(keyed, wanted, "_path", "inner", "page_id").drop("_path")


def split_stored_lyrics(songs: DataFrame, lyrics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lyrics already stored for the songs, and the songs whose page is still needed."""
    ids = songs.select(F.col("id").alias("song_id"))
    stored = lyrics.join(ids, "song_id", "left_semi")
    missing = songs.join(
        lyrics.select(F.col("song_id").alias("id")), "id", "left_anti"
    )
    return stored, missing
