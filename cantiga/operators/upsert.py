"""Keyed inserts and updates as whole-table joins, and ids for new rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantiga.operators.delta import latest_per_key, once_per_key
from cantiga.operators.skew import small
from cantiga.session import materialize

_DIGEST_CHARS = 4


def batch_time(batch_ts: datetime) -> Column:
    """The time of a run as it is written, in no time zone."""
    return F.lit(batch_ts.isoformat(sep=" ")).cast("timestamp_ntz")


def assign_ids(new: DataFrame, keys: list[str], stored: DataFrame) -> DataFrame:
    """Add dense ids above the largest stored one, in the order of the keys' digests.

    A digest spreads keys evenly whatever they look like, so its first characters make
    65,536 even buckets. Rows are numbered inside their bucket and moved up by the
    count of the buckets before: no step sorts the table in one task, and a rerun gives
    the same ids. ``keys`` identify a row. ``new`` is read twice.
    """
    key = F.concat_ws("/", *keys)
    hashed = new.withColumn("_digest", F.md5(key)).withColumn(
        "_bucket", F.substring("_digest", 1, _DIGEST_CHARS)
    )
    counts = hashed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # At most 65,536 rows, whatever the size of the table.
    offsets = counts.select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    top = stored.agg(F.coalesce(F.max("id"), F.lit(0).cast("bigint"))).scalar()
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", *keys))
    return (
        hashed.withColumn("_place", place)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn("id", (top + F.col("_offset") + F.col("_place")).cast("bigint"))
        .drop("_digest", "_bucket", "_place", "_offset")
    )


def _set_views(stored: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    fresh = batch.select(*keys, F.col("views").alias("_fresh"))
    return (
        stored.join(fresh, keys, "left")
        .withColumn("views", F.coalesce("_fresh", "views"))
        .select(*stored.columns)
    )


def _upsert(stored: DataFrame, incoming: DataFrame, keys: list[str], batch_ts: datetime) -> DataFrame:
    """One join of both sides: rows without an id are new, the others may get new views."""
    batch = once_per_key(incoming, keys).select(
        *keys, F.col("name").alias("_name"), F.col("views").alias("_views")
    )
    both = materialize(stored.join(batch, keys, "full_outer"), "upserted")
    known = F.col("id").isNotNull()
    kept = both.where(known).withColumn("views", F.coalesce("_views", "views"))
    fresh = both.where(~known).drop("id").withColumn("name", F.col("_name"))
    added = (
        assign_ids(fresh, keys, stored)
        .withColumn("views", F.coalesce("_views", F.lit(0).cast("bigint")))
        .withColumn("added_date", batch_time(batch_ts))
    )
    return kept.select(*stored.columns).unionByName(added.select(*stored.columns))


def upsert_artists(stored: DataFrame, incoming: DataFrame, batch_ts: datetime) -> DataFrame:
    """Insert by slug, or set the views only; name and date of a stored artist stay."""
    return _upsert(stored, incoming, ["slug"], batch_ts)


def upsert_songs(stored: DataFrame, incoming: DataFrame, batch_ts: datetime) -> DataFrame:
    """Insert by artist and slug, or set the views only."""
    return _upsert(stored, incoming, ["artist_id", "slug"], batch_ts)


def update_views(artists: DataFrame, updates: DataFrame, seq: str = "seq") -> DataFrame:
    """Set views by artist id, the last update of an id wins; an unknown id does nothing."""
    last = updates.groupBy("id").agg(F.max_by("views", seq).alias("views"))
    return _set_views(artists, last, ["id"])


def added_lyrics(batch: DataFrame, stored: DataFrame, batch_ts: datetime) -> DataFrame:
    """Lyrics of songs without any, one row per song, with their ids.

    Ids are given to the song ids alone; the text joins them afterwards.
    """
    fresh = batch.select("song_id").join(stored.select("song_id"), "song_id", "left_anti")
    fresh = materialize(fresh, "fresh")
    ids = assign_ids(fresh, ["song_id"], stored)
    return (
        batch.join(ids, "song_id")
        .withColumn("last_updated", batch_time(batch_ts))
        .select(*stored.columns)
    )


def upsert_lyrics(stored: DataFrame, incoming: DataFrame, batch_ts: datetime) -> DataFrame:
    """Insert by song, or replace the content and its date. The last content wins.

    Stored texts that stay are passed on as they are; only a batch too large to broadcast
    moves them. A null content replaces nothing.
    """
    batch = latest_per_key(incoming, ["song_id"]).select("song_id", "content")
    batch = materialize(batch, "lyric-batch")
    keys = batch.where(F.col("content").isNotNull()).select("song_id")
    same = stored.join(F.broadcast(keys) if small(keys) else keys, "song_id", "left_anti")
    replaced = (
        batch.where(F.col("content").isNotNull())
        .join(stored.select("id", "song_id"), "song_id")
        .withColumn("last_updated", batch_time(batch_ts))
    )
    parts = [df.select(*stored.columns) for df in (same, replaced)]
    return parts[0].unionByName(parts[1]).unionByName(added_lyrics(batch, stored, batch_ts))
