"""Shape of the physical plans at a size where nothing may be broadcast unseen."""

import contextlib
import io
import re

import pytest
from conftest import DAY_1
from pyspark.sql import functions as F

from cantiga.operators import delta, extract, language, report, rules, upsert
from cantiga.schemas import ARTISTS, LYRICS, PAGES, SONGS, SiteLayout


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    data = {
        "pages": spark.createDataFrame([(1, "http://h/a/", "<a href='/b/'>b</a>")], PAGES),
        "artists": spark.createDataFrame([(1, "A", "a", 1, DAY_1)], ARTISTS),
        "songs": spark.createDataFrame([(1, 1, "S", "s", 1, DAY_1)], SONGS),
        "lyrics": spark.createDataFrame([(1, 1, "x", DAY_1)], LYRICS),
    }
    for name, df in data.items():
        df.write.parquet(str(root / name))
    return {name: spark.read.schema(df.schema).parquet(str(root / name)) for name, df in data.items()}


@pytest.fixture
def no_auto_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def crawled(tables):
    return tables["artists"].select("slug", "name", "views", F.col("id").alias("seq"))


PLANS = {
    "links": lambda t: extract.extract_links(t["pages"]),
    "songs": lambda t: extract.extract_songs(t["pages"], SiteLayout().song_row, SiteLayout().song_link),
    "site": lambda t: extract.extract_site(t["pages"], SiteLayout()),
    "rules": lambda t: t["lyrics"].where(rules.within_length(F.col("content"))),
    "new_artists": lambda t: delta.new_artists(crawled(t), t["artists"]),
    "new_songs": lambda t: delta.new_songs(t["songs"], t["songs"]),
    "artist_delta": lambda t: delta.artist_delta(crawled(t), t["artists"]),
    "refresh_views": lambda t: delta.refresh_views(t["artists"], t["artists"]),
    "upsert_artists": lambda t: upsert.upsert_artists(t["artists"], crawled(t), DAY_1),
    "upsert_songs": lambda t: upsert.upsert_songs(
        t["songs"], t["songs"].withColumn("seq", F.col("id")), DAY_1
    ),
    "upsert_lyrics": lambda t: upsert.upsert_lyrics(
        t["lyrics"], t["lyrics"].withColumn("seq", F.col("id")), DAY_1
    ),
    "assign_ids": lambda t: upsert.assign_ids(t["songs"].drop("id"), ["artist_id", "slug"], t["songs"]),
    "release_rows": lambda t: report.release_rows(
        t["lyrics"].withColumn("seq", F.col("id")), t["songs"], t["artists"]
    ),
    "artist_stats": lambda t: report.artist_stats(
        t["lyrics"].withColumn("seq", F.col("id")), t["songs"], t["artists"]
    ),
}


@pytest.mark.parametrize("name", PLANS)
def test_no_cross_join_and_no_python(tables, no_auto_broadcast, name):
    text = plan(PLANS[name](tables))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoop|Python|ArrowEval|MapIn", text)


@pytest.mark.parametrize("name", ["links", "songs", "site", "rules"])
def test_row_work_does_not_shuffle(tables, name):
    assert "Exchange" not in plan(PLANS[name](tables))


def test_scan_reads_only_what_is_needed(tables):
    text = plan(report.artist_stats(tables["lyrics"].withColumn("seq", F.col("id")), tables["songs"], tables["artists"]))
    schemas = re.findall(r"ReadSchema: (\S+)", text)
    assert schemas and not any("content" in s or "added_date" in s for s in schemas)
    text = plan(tables["songs"].where(F.col("artist_id") == 7).select("id"))
    assert "PushedFilters: [IsNotNull(artist_id), EqualTo(artist_id,7)]" in text
    assert "ReadSchema: struct<id:bigint,artist_id:bigint>" in text


def test_top_artists_take_a_bounded_heap(spark):
    stats = spark.range(10).selectExpr("id as artist_id", "id as views", "id as first_seq")
    assert "TakeOrderedAndProject" in plan(report.top_artists(stats))


def test_trigram_scores_are_added_up_before_the_shuffle(spark, tables):
    profile = language.lang_profile(
        spark.createDataFrame([("pt", "uma canção"), ("en", "one song")], "lang string, text string")
    )
    texts = tables["lyrics"].repartition(8)
    text = plan(language.lang_scores(texts, profile, ["en", "pt"], "id", "content"))
    steps = ("Generate", "BroadcastHashJoin", "HashAggregate", "Exchange")
    order = [name for name in re.findall(r"\n\(\d+\) (\w+)", text) if name in steps]
    # The first exchange is the test's own.
    assert order[:5] == ["Exchange", *steps]
