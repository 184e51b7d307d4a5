from collections import Counter

import pytest
from conftest import DAY_1, DAY_2
from pyspark.sql import functions as F

from cantiga.operators import checks, delta, skew, upsert
from cantiga.schemas import ARTISTS, LYRICS, SONGS
from cantiga.sources.store import lookup

CRAWLED = "slug string, name string, views bigint, seq bigint"


def artists(spark, *rows):
    return spark.createDataFrame([(*r, DAY_1) for r in rows], ARTISTS)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_new_artist_gets_an_id(spark):
    crawled = spark.createDataFrame([("test", "Test", 1000, 0)], CRAWLED)
    out = upsert.upsert_artists(artists(spark), crawled, DAY_1).collect()
    assert [(r["id"], r["name"], r["views"], r["added_date"]) for r in out] == [(1, "Test", 1000, DAY_1)]


def test_known_artist_changes_views_only(spark):
    stored = artists(spark, (1, "Old name", "test", 500))
    crawled = spark.createDataFrame([("test", "New name", 1000, 0)], CRAWLED)
    out = upsert.upsert_artists(stored, crawled, DAY_2).collect()
    assert [tuple(r) for r in out] == [(1, "Old name", "test", 1000, DAY_1)]


def test_batch_keeps_first_name_and_last_views(spark):
    crawled = spark.createDataFrame(
        [("a", "third", 3, 30), ("a", "first", 1, 10), ("a", "second", 2, 20)], CRAWLED
    )
    out = upsert.upsert_artists(artists(spark), crawled, DAY_1)
    assert rows_of(out, "name", "views") == [("first", 3)]


def test_action_for_each_crawled_artist(spark):
    stored = artists(spark, (1, "A", "a", 10), (2, "B", "b", 20), (3, "N", "n", None))
    crawled = spark.createDataFrame(
        [("a", "A", 10, 0), ("b", "B", 21, 1), ("c", "C", 5, 2), ("d", "D", None, 3), ("n", "N", 1, 4)],
        CRAWLED,
    )
    found = delta.artist_delta(crawled, stored)
    assert rows_of(found, "slug", "action") == [
        ("a", "keep"), ("b", "update"), ("c", "add"), ("n", "update"),
    ]


def test_refresh_keeps_rows_without_a_result(spark):
    stored = artists(spark, (1, "A", "a", 10), (2, "B", "b", 20), (3, "C", "c", 30))
    crawled = spark.createDataFrame([("a", 11), ("b", None)], "slug string, views bigint")
    assert rows_of(delta.refresh_views(stored, crawled), "slug", "views") == [("a", 11), ("b", 20), ("c", 30)]


def test_new_and_existing_artists_are_both_processed(spark):
    stored = artists(spark, (1, "A", "a", 10))
    crawled = spark.createDataFrame([("a", "A", 10, 0), ("b", "B", 5, 1)], CRAWLED)
    added = delta.new_artists(crawled, stored).select("slug")
    assert rows_of(delta.processed_artists(added, stored.select("slug")), "slug") == [("a",), ("b",)]


def test_new_songs_are_per_artist(spark):
    stored = spark.createDataFrame([(1, 1, "S", "s", 0, DAY_1)], SONGS)
    crawled = spark.createDataFrame([(1, "s"), (2, "s"), (1, "t")], "artist_id bigint, slug string")
    assert rows_of(delta.new_songs(crawled, stored), "artist_id", "slug") == [(1, "t"), (2, "s")]


def test_update_views_by_id(spark):
    stored = artists(spark, (1, "A", "a", 10), (2, "B", "b", 20))
    updates = spark.createDataFrame([(1, 5, 0), (1, 7, 1), (9, 1, 2)], "id bigint, views bigint, seq bigint")
    assert rows_of(upsert.update_views(stored, updates), "id", "views") == [(1, 7), (2, 20)]


def test_upsert_songs(spark):
    stored = spark.createDataFrame([(4, 1, "S", "s", 10, DAY_1)], SONGS)
    incoming = spark.createDataFrame(
        [(1, "s", "Other", 12, 0), (1, "t", "T", 3, 1), (2, "s", "S2", None, 2)],
        "artist_id bigint, slug string, name string, views bigint, seq bigint",
    )
    out = upsert.upsert_songs(stored, incoming, DAY_2)
    assert rows_of(out, "artist_id", "slug", "name", "views") == [
        (1, "s", "S", 12), (1, "t", "T", 3), (2, "s", "S2", 0),
    ]
    assert sorted(r["id"] for r in out.collect()) == [4, 5, 6]


def test_upsert_lyrics_replaces_content_and_date(spark):
    stored = spark.createDataFrame([(1, 10, "old", DAY_1), (2, 20, "same", DAY_1)], LYRICS)
    text = "one\ntwo\n\n  three \n"
    incoming = spark.createDataFrame(
        [(10, "middle", 0), (10, text, 1), (30, "new", 2)], "song_id bigint, content string, seq bigint"
    )
    out = upsert.upsert_lyrics(stored, incoming, DAY_2)
    assert rows_of(out, "id", "song_id", "content", "last_updated") == [
        (1, 10, text, DAY_2), (2, 20, "same", DAY_1), (3, 30, "new", DAY_2),
    ]


def test_ids_are_dense_distinct_and_repeatable(spark):
    new = spark.range(1000).select((F.col("id") % 7).alias("artist_id"), F.concat(F.lit("s"), "id").alias("slug"))
    stored = spark.createDataFrame([(41,)], "id bigint")
    first = rows_of(upsert.assign_ids(new, ["artist_id", "slug"], stored), "id", "slug")
    again = rows_of(upsert.assign_ids(new.repartition(13), ["artist_id", "slug"], stored), "id", "slug")
    assert sorted(i for i, _ in first) == list(range(42, 1042))
    assert first == again


def test_running_a_batch_again_changes_nothing(spark):
    crawled = spark.createDataFrame([("a", "A", 1, 0), ("b", "B", 2, 1)], CRAWLED)
    once = upsert.upsert_artists(artists(spark), crawled, DAY_1)
    twice = upsert.upsert_artists(once, crawled, DAY_2)
    assert rows_of(once, "*") == rows_of(twice, "*")


def test_stored_lyrics_need_no_page(spark):
    songs = spark.createDataFrame([(i, 1, "S", f"s{i}", 0, DAY_1) for i in (1, 2, 3)], SONGS)
    lyrics = spark.createDataFrame([(1, 2, "x", DAY_1), (2, 9, "y", DAY_1)], LYRICS)
    stored, missing = delta.split_stored_lyrics(songs, lyrics)
    assert rows_of(stored, "song_id") == [(2,)] and rows_of(missing, "id") == [(1,), (3,)]


def test_lookup_by_keys(spark):
    stored = artists(spark, (1, "A", "a", 10), (2, "B", "b", 20))
    keys = spark.createDataFrame([("b",), ("b",), ("x",)], "slug string")
    assert rows_of(lookup(stored, keys, "slug"), "id") == [(2,)]


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one key; some keys are NULL."""
    left = spark.range(3000).select(
        F.col("id").alias("uid"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 97))
        .alias("k"),
    )
    right = spark.range(60).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v"))
    extra = spark.createDataFrame([("hot", -1), ("hot", -2), (None, -3)], "k string, v bigint")
    return left, right.unionByName(extra)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_is_the_plain_join(hot, how):
    left, right = hot
    plain = left.join(right, "k", how)
    salted = skew.salted_join(left, right, "k", how, "uid", target=100)
    assert Counter(map(tuple, salted.select(*plain.columns).collect())) == Counter(map(tuple, plain.collect()))


def test_heavy_keys_are_split_by_a_row_target(hot):
    left, _ = hot
    assert [tuple(r) for r in skew.heavy_keys(left, "k", target=300).collect()] == [("hot", 4)]
    assert skew.heavy_keys(left, "k", target=5000).collect() == []


def test_no_part_of_a_heavy_key_is_above_twice_the_target(spark, monkeypatch):
    """A key with 30 % of the rows among very many others; no table of all counts is written."""
    key = F.when(F.col("id") % 10 < 3, F.lit(-1)).otherwise(F.col("id"))
    left = spark.range(100_000).select("id", key.alias("k"))
    written = []
    monkeypatch.setattr(skew, "materialize", lambda df, name: written.append((name, df.count())) or df)
    heavy = skew.heavy_keys(left, "k", target=2000)
    assert written == [("heavy-keys", 1)]
    parts = left.join(heavy, "k").groupBy(F.pmod(F.xxhash64("id"), F.col("_salts")).alias("part")).count()
    assert parts.agg(F.max("count")).first()[0] <= 4000 and parts.count() == 15


def test_lookup_join_beyond_the_broadcast_limit(hot):
    left, right = hot
    small = skew.lookup_join(left, right, "k", "inner", "uid").count()
    assert small == skew.lookup_join(left, right, "k", "inner", "uid", limit=1).count()


def test_outer_join_is_refused(hot):
    with pytest.raises(ValueError, match="full"):
        skew.salted_join(*hot, "k", "full", "uid")


def test_constraint_report(spark):
    stored = artists(spark, (1, "A", "a", 1), (2, None, "a", 1), (3, "x" * 256, "c", 1))
    songs = spark.createDataFrame(
        [(1, 1, "S", "s", 0, DAY_1), (2, 1, "S", "s", 0, DAY_1), (3, 9, "S", "t", 0, DAY_1), (4, 9, "S", "u", 0, DAY_1)],
        SONGS,
    )
    lyrics = spark.createDataFrame([(1, 1, None, DAY_1), (2, 8, "x", DAY_1)], LYRICS)
    assert rows_of(checks.constraint_report(stored, songs, lyrics), "*") == sorted(
        [
            ("artists", "a", "not_null", "name"),
            ("artists", "a", "unique", "2"),
            ("artists", "c", "max_length", "name"),
            ("songs", "1/s", "unique", "2"),
            ("songs", "9", "reference", "2"),
            ("lyrics", "1", "not_null", "content"),
            ("lyrics", "8", "reference", "1"),
        ],
        key=str,
    )
    good = stored.where(checks.is_valid("artists"))
    assert rows_of(good, "id") == [(1,)]
