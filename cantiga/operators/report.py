"""Counts, rankings, release rows and release notes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantiga.functions import names as N
from cantiga.operators.skew import lookup_join
from cantiga.session import materialize

# Fixed value: artists named in the release notes.
TOP_ARTISTS = 5


def by_name(artists: DataFrame, collation: str | None = None) -> DataFrame:
    """Artists in name order: by code point, or by a named collation."""
    name = F.collate("name", collation) if collation else F.col("name")
    return artists.orderBy(name, "id")


def grouped_by_letter(artists: DataFrame, seq: str = "seq") -> DataFrame:
    """Artists with their letter bucket, buckets in key order, arrival order inside.

    A sorted table and not one list per bucket: a bucket may hold most of the artists.
    """
    return artists.withColumn("bucket", N.letter_bucket(F.col("name"))).orderBy("bucket", seq)


def letter_counts(artists: DataFrame) -> DataFrame:
    return (
        artists.groupBy(N.letter_bucket(F.col("name")).alias("bucket"))
        .agg(
            F.count("*").alias("artists"),
            F.min("slug").alias("first_slug"),
            F.max("slug").alias("last_slug"),
        )
        .orderBy("bucket")
    )


def release_names(lyrics: DataFrame, songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Names for released lyrics: ``song_id, seq, song, artist, artist_id, filename``.

    Where two songs give the same file name the later one stays, and among equal
    positions the larger id. ``lyrics`` needs a unique ``song_id`` and a ``seq``.
    """
    owners = artists.select(F.col("id").alias("artist_id"), F.col("name").alias("artist"))
    titled = songs.select(
        F.col("id").alias("song_id"), "artist_id", F.col("name").alias("song")
    )
    wanted = lyrics.select("song_id", "seq").join(titled, "song_id")
    named = lookup_join(wanted, owners, "artist_id", "inner", "song_id").withColumn(
        "filename", N.export_name(F.col("artist"), F.col("song"))
    )
    # Position and id are unique, so the names behind them decide nothing.
    last = F.max(F.struct("seq", "song_id", "song", "artist", "artist_id")).alias("_last")
    return named.groupBy("filename").agg(last).select("_last.*", "filename")


def release_rows(lyrics: DataFrame, songs: DataFrame, artists: DataFrame) -> DataFrame:
    """One text file per released song: ``filename, body, bucket``.

    The lyric text moves once, to the names of its song.
    """
    names = release_names(lyrics, songs, artists)
    return lyrics.select("song_id", "content").join(names, "song_id").select(
        "filename",
        N.export_body(F.col("artist"), F.col("song"), F.col("content")).alias("body"),
        N.letter_bucket(F.col("artist")).alias("bucket"),
    )


def artist_stats(lyrics: DataFrame, songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Released songs per artist: ``artist_id, name, views, songs, first_seq``.

    Songs are counted per artist before the artists are joined.
    """
    owned = songs.select(F.col("id").alias("song_id"), "artist_id")
    counts = (
        lyrics.select("song_id", "seq")
        .join(owned, "song_id")
        .groupBy("artist_id")
        .agg(F.count("*").alias("songs"), F.min("seq").alias("first_seq"))
    )
    return counts.join(
        artists.select(F.col("id").alias("artist_id"), "name", "views"), "artist_id"
    ).select("artist_id", "name", "views", "songs", "first_seq")


def top_artists(stats: DataFrame, n: int = TOP_ARTISTS) -> DataFrame:
    """The most viewed artists; among equals the first seen comes first."""
    return stats.orderBy(F.desc("views"), "first_seq").limit(n)


def release_totals(stats: DataFrame) -> DataFrame:
    """Songs added and artists they belong to, from one row per artist."""
    return stats.agg(
        F.coalesce(F.sum("songs"), F.lit(0)).alias("lyrics"), F.count("*").alias("artists")
    )


def release_notes(stats: DataFrame, title: str) -> DataFrame:
    """The notes in Markdown, as one row ``notes``."""
    entry = F.concat(
        F.lit("- **"), F.col("name"), F.lit("** ("), F.col("songs"), F.lit(" songs)\n")
    )
    top = top_artists(stats).select(
        F.struct((-F.col("views")).alias("rank"), "first_seq", "name", entry.alias("line")).alias("_e")
    )
    lines = top.agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list("_e")), lambda e: e["line"]), ""
        ).alias("lines")
    )
    totals = release_totals(stats)
    return totals.select(
        F.concat(
            F.lit(f"# {title}\n\nAdded "),
            F.col("lyrics"),
            F.lit(" new songs from "),
            F.col("artists"),
            F.lit(" artists.\n\n## Top Artists\n"),
            lines.scalar(),
        ).alias("notes")
    )


def run_report(counted: dict[str, tuple[DataFrame, str, Column]]) -> DataFrame:
    """One row per letter bucket and one column per thing counted.

    ``counted`` maps a column name to rows, their artist name column, and how much one
    row counts.
    """
    names = list(counted)
    parts = [
        df.groupBy(N.letter_bucket(F.col(artist)).alias("bucket"))
        .agg(F.sum(weight.cast("bigint")).alias(name))
        .select(
            "bucket",
            *[F.col(c) if c == name else F.lit(0).cast("bigint").alias(c) for c in names],
        )
        for name, (df, artist, weight) in counted.items()
    ]
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("bucket")
        .agg(*[F.sum(c).alias(c) for c in names])
        .orderBy("bucket")
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table: ``table_name, n_rows``."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def row_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """``added, changed, removed``: how many rows differ, by a unique key and a digest of all columns."""

    def digests(df: DataFrame, name: str) -> DataFrame:
        nulls = [F.col(c).isNull() for c in df.columns]
        return df.select(key, F.xxhash64(*df.columns, *nulls).alias(name))

    both = digests(before, "old").join(digests(after, "new"), key, "full_outer")
    return both.agg(
        F.count_if(F.col("old").isNull()).alias("added"),
        F.count_if(F.col("old") != F.col("new")).alias("changed"),
        F.count_if(F.col("new").isNull()).alias("removed"),
    )
