"""Full and incremental runs: a crawl into the next version of the catalogue.

A run stages its tables, publishes them together, and then writes the release. Each
table is written once and read back, so no step is computed twice and the later joins
know true sizes. The wide lyric text is shuffled once, to the ids of the songs kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantiga.operators import checks, delta, ledger, report, upsert
from cantiga.operators.language import detect_language
from cantiga.operators.rules import exclude_keywords, within_length
from cantiga.operators.skew import BROADCAST_ROWS, lookup_join, small
from cantiga.plans.crawl import Crawl, before_all, position
from cantiga.session import materialize
from cantiga.sources.rules import LyricRules
from cantiga.sources.store import CatalogueStore, create_backup
from cantiga.sources.textfiles import write_bundle, write_song_files


@dataclass(frozen=True)
class Detector:
    """A trained profile, the languages it tells apart, and the one to keep."""

    profile: DataFrame
    langs: list[str]
    target: str = "pt"


@dataclass(frozen=True)
class RunResult:
    """What a run published. ``lyrics`` are the new lyrics with their ``seq``."""

    version: int
    lyrics: DataFrame
    report: DataFrame
    quarantine: DataFrame
    # What became of every listed artist and song and of every page, one row each.
    outcomes: DataFrame


def process_artists(
    crawl: Crawl, stored: DataFrame, full: bool
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Artists to write, the slugs that go on to their songs, and what was unreadable.

    A full run takes every listed artist with a view count. An incremental run takes
    listed artists that are new, and refreshes all stored ones from their own page; a
    stored artist goes on even when the page gave no count.
    """
    first = crawl.artists.groupBy("slug").agg(
        F.min_by("name", "seq").alias("name"), F.min("seq").alias("seq")
    )
    counted = crawl.views.where(F.col("views").isNotNull()).select("slug", "views")
    bad = checks.crawl_violations(
        crawl.views,
        "artists",
        F.col("slug"),
        F.col("views").isNull(),
        F.coalesce("views_text", F.lit("")),
        "views",
    )
    if full:
        incoming = first.join(counted, "slug")
        return incoming, incoming.select("slug"), bad
    added = delta.new_artists(first, stored).join(counted, "slug")
    refreshed = stored.select("slug", "name", before_all().alias("seq")).join(
        counted, "slug"
    )
    slugs = delta.processed_artists(added.select("slug"), stored.select("slug"))
    return added.unionByName(refreshed), slugs, bad


def process_songs(crawl: Crawl, artists: DataFrame, stored: DataFrame) -> DataFrame:
    """Listed songs of the artists that are not stored, one row per song.

    Gives ``artist_id, artist_slug, slug, name, seq``.
    """
    owned = delta.songs_with_artist(crawl.songs, artists)
    once = owned.groupBy("artist_id", "artist_slug", "slug").agg(
        F.min_by("name", "seq").alias("name"), F.min("seq").alias("seq")
    )
    return delta.new_songs(once, stored)


def missing_lyrics(artists: DataFrame, songs: DataFrame, lyrics: DataFrame) -> DataFrame:
    """Stored songs of the artists that have no lyrics yet, shaped like found songs."""
    owner = artists.select(F.col("id").alias("artist_id"), F.col("slug").alias("artist_slug"))
    missing = delta.split_stored_lyrics(songs, lyrics)[1]
    return lookup_join(
        missing.select("id", "artist_id", "slug", "name", before_all().alias("seq")),
        owner,
        "artist_id",
        "inner",
        "slug",
    )


def texts_of(crawl: Crawl, pages: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``page, content`` and the other columns of ``pages``, one row per page.

    Texts stay where they are while the pages can be broadcast, else move once by page.
    """
    texts = crawl.lyrics.select("page", "content")
    return texts.join(F.broadcast(pages) if small(pages, limit) else pages, "page")


def judge_lyrics(
    crawl: Crawl,
    songs: DataFrame,
    detector: Detector,
    rules: LyricRules | None = None,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """The songs whose page holds lyrics that keep the rules, with views, page, and ``kept``.

    ``kept`` says whether the language is the one asked for. The text stays in the crawl and
    is fetched by ``page`` later. Rules are applied once, and only the texts of listed songs
    are scored. A song that is stored already has no place in a list of this crawl: its place
    is its own page.
    """
    keys = ["artist_slug", "slug"]
    wanted = crawl.lyrics.where(F.col("content").isNotNull() & F.col("views").isNotNull())
    passing = wanted.select("page", *keys, "views", "content")
    if rules is not None:
        passing = passing.where(
            within_length(F.col("content"), rules.min_length, rules.max_length)
        )
        passing = exclude_keywords(passing, rules.keywords, "lyrics", "page", "content")
        passing = materialize(passing.select("page", *keys, "views"), "passing-pages")
    own = position(F.col("page"), F.lit(-1))
    listed = songs.join(passing.select("page", *keys, "views"), keys)
    listed = listed.withColumn("seq", F.when(F.col("id").isNull(), F.col("seq")).otherwise(own))
    listed = materialize(listed, "listed-songs")
    chosen = texts_of(crawl, listed.select("page"), limit)
    spoken = detect_language(chosen, detector.profile, detector.langs, "page", "content")
    kept = spoken.where(F.col("lang") == detector.target).select("page", F.lit(True).alias("kept"))
    return listed.join(kept, "page", "left").withColumn("kept", F.coalesce("kept", F.lit(False)))


def process_lyrics(
    crawl: Crawl,
    songs: DataFrame,
    detector: Detector,
    rules: LyricRules | None = None,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """The songs whose page holds lyrics to keep: the columns of ``songs`` with ``views`` and ``page``."""
    return judge_lyrics(crawl, songs, detector, rules, limit).where("kept").drop("kept")


def _run(
    store: CatalogueStore,
    crawl: Crawl,
    detector: Detector,
    batch_id: str,
    batch_ts: datetime,
    full: bool,
    rules: LyricRules | None,
    retry_missing_lyrics: bool,
    partial: bool = False,
) -> RunResult | None:
    """Stage and publish; None when the batch is known or the crawl lists no artist.

    A ``partial`` crawl may list none if some are stored.
    """
    if store.has_batch(batch_id):
        return None
    staged = store.begin()
    before = store.tables(staged.base)
    if crawl.artists.isEmpty() and not (partial and not before["artists"].isEmpty()):
        return None

    incoming, slugs, unreadable = process_artists(crawl, before["artists"], full)
    if rules is not None:
        incoming = exclude_keywords(incoming, rules.keywords, "artists", "slug", "name")
    incoming = materialize(incoming, "incoming-artists")
    valid = incoming.where(checks.is_valid("artists"))
    artists = store.stage(
        staged, "artists", upsert.upsert_artists(before["artists"], valid, batch_ts)
    )
    processed = artists.join(slugs, "slug", "left_semi")
    if rules is not None:
        processed = exclude_keywords(processed, rules.keywords, "artists", "slug", "name")
    processed = materialize(processed, "processed-artists")

    found = process_songs(crawl, processed, before["songs"])
    if rules is not None:
        found = found.withColumn("_key", checks.key_text(["artist_id", "slug"]))
        found = exclude_keywords(found, rules.keywords, "titles", "_key", "name").drop("_key")
    found = materialize(found, "found-songs")
    candidates = found.where(checks.is_valid("songs")).withColumn(
        "id", F.lit(None).cast("bigint")
    )
    if retry_missing_lyrics:
        candidates = candidates.unionByName(
            missing_lyrics(processed, before["songs"], before["lyrics"])
        )
    judged = materialize(judge_lyrics(crawl, candidates, detector, rules), "judged-songs")
    chosen = judged.where("kept").drop("kept")
    kept = chosen.where(F.col("id").isNull()).drop("id")
    kept = materialize(
        upsert.assign_ids(kept, ["artist_id", "slug"], before["songs"]), "new-songs"
    )
    store.stage_added(
        staged, "songs", kept.withColumn("added_date", upsert.batch_time(batch_ts))
    )

    retried = chosen.where(F.col("id").isNotNull()).select(*kept.columns)
    sung = kept.unionByName(retried).select(F.col("id").alias("song_id"), "page", "seq")
    ids = materialize(upsert.assign_ids(sung, ["song_id"], before["lyrics"]), "lyric-ids")
    added = store.stage_added(
        staged,
        "lyrics",
        texts_of(crawl, ids).withColumn("last_updated", upsert.batch_time(batch_ts)),
    )
    version = store.publish(staged, batch_ts, batch_id)

    lyrics = added.join(sung.select("song_id", "seq"), "song_id")
    quarantine = (
        checks.row_violations(incoming, "artists")
        .unionByName(checks.row_violations(found, "songs"))
        .unionByName(unreadable)
        .unionByName(
            checks.crawl_violations(
                crawl.lyrics,
                "songs",
                checks.key_text(["artist_slug", "slug"]),
                F.col("views").isNull(),
                F.col("views_text"),
                "views",
            )
        )
    )
    one = F.lit(1)
    owner = processed.select(F.col("id").alias("artist_id"), F.col("name").alias("artist"))
    old = before["artists"].select("slug", F.col("views").alias("old_views"))
    updated = processed.join(old, "slug").where(
        delta.views_changed(F.col("old_views"), F.col("views"))
    )
    counted = report.run_report(
        {
            "artists_processed": (processed, "name", one),
            "new_artists": (processed.join(old, "slug", "left_anti"), "name", one),
            "artists_updated": (updated, "name", one),
            "new_songs": (_per_artist(found, owner), "artist", F.col("rows")),
            "lyrics_kept": (_per_artist(kept, owner), "artist", F.col("rows")),
        }
    )
    outcomes = ledger.artist_outcomes(crawl, before["artists"], incoming, processed).unionByName(
        ledger.song_outcomes(crawl, before["songs"], processed, found, judged)
    )
    return RunResult(version, lyrics, counted, quarantine, outcomes)


def _per_artist(songs: DataFrame, owner: DataFrame) -> DataFrame:
    """Songs counted per artist before the artists are joined: ``artist, rows``."""
    counts = songs.groupBy("artist_id").agg(F.count("*").alias("rows"))
    return counts.join(owner, "artist_id").select("artist", "rows")


def run_full(
    store: CatalogueStore,
    crawl: Crawl,
    detector: Detector,
    batch_id: str,
    batch_ts: datetime,
    rules: LyricRules | None = None,
    retry_missing_lyrics: bool = False,
) -> RunResult | None:
    """Process every listed artist, their new songs and the lyrics to keep."""
    return _run(store, crawl, detector, batch_id, batch_ts, True, rules, retry_missing_lyrics)


def run_incremental(
    store: CatalogueStore,
    crawl: Crawl,
    detector: Detector,
    batch_id: str,
    batch_ts: datetime,
    rules: LyricRules | None = None,
    retry_missing_lyrics: bool = False,
    partial: bool = False,
) -> RunResult | None:
    """Add new artists, refresh the views of stored ones, and add new songs.

    With ``partial`` the crawl is only what came since the last run: it need not list an
    artist when there are stored ones.
    """
    return _run(store, crawl, detector, batch_id, batch_ts, False, rules, retry_missing_lyrics, partial)


def create_release(
    store: CatalogueStore,
    lyrics: DataFrame,
    output: str,
    batch_ts: datetime,
    title: str = "Catalogue Update",
    version: int | None = None,
) -> DataFrame | None:
    """Write the release of new lyrics; None when there are none.

    Text files, a compressed bundle and the notes go under a folder named after the day and
    the version, so that releases of one day stay apart; a backup of that version goes
    beside them. ``version`` is the run's, by default the newest. Returns the notes.
    """
    if lyrics.isEmpty():
        return None
    row = store.version(version)
    tables = store.tables(row)
    folder = f"{output.rstrip('/')}/release-{batch_ts:%Y%m%d}-{row['version']}"
    rows = materialize(
        report.release_rows(lyrics, tables["songs"], tables["artists"]), "release"
    )
    write_song_files(rows, f"{folder}/texts")
    write_bundle(rows, f"{folder}/bundle")
    create_backup(store, f"{output.rstrip('/')}/backups", batch_ts, row)
    stats = report.artist_stats(lyrics, tables["songs"], tables["artists"])
    notes = report.release_notes(materialize(stats, "artist-stats"), title)
    # The text writer ends the row with the notes' last line break.
    last_break = F.regexp_replace("notes", "\n$", "").alias("value")
    notes.select(last_break).coalesce(1).write.mode("overwrite").text(f"{folder}/notes")
    return notes
