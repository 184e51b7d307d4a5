"""One query per operator, over the driver's tables.

Pages stand for the crawl: the host is the artist and the page is the song. What was
fetched over plain ``http`` is the stored catalogue, and all pages are the new crawl.
Customers, orders, line items, documents and conversations stand for artists, songs,
song list entries, lyrics and lyric updates where size matters.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cantiga.functions import html as H
from cantiga.functions import names as N
from cantiga.functions.text import clean_for_detection, dotted_int, unescape
from cantiga.operators import checks, delta, extract, language, report, rules, upsert
from cantiga.plans.crawl import (
    ArticlePages,
    SitePages,
    crawl_articles,
    crawl_site,
    extract_articles,
)
from cantiga.plans.runs import (
    Detector,
    RunResult,
    create_release,
    process_artists,
    process_lyrics,
    process_songs,
    run_full,
    run_incremental,
)
from cantiga.schemas import ARTISTS, LYRICS, RULES, SONGS, Selector, SiteLayout
from cantiga.session import materialize, shared_folder, spread
from cantiga.sources.pages import decode_pages, read_pages
from cantiga.sources.store import (
    CatalogueStore,
    create_backup,
    lookup,
    restore_newest,
    version_diff as diff_of_versions,
)
from cantiga.sources.rules import LyricRules, read_keywords
from cantiga.sources.textfiles import (
    read_bundle,
    read_song_files,
    song_folder,
    write_bundle,
    write_song_files,
)
from cantiga.streaming.arrivals import run_arrivals

FIRST = datetime(2024, 1, 1)
SECOND = datetime(2024, 1, 8)

LANGS = ["de", "en", "es", "fr"]
TARGET = "es"

KEYWORDS = [("lyrics", "worthless"), ("lyrics", "Of  the"), ("lyrics", "des ou"), ("titles", "the")]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_pages(spark, f"{sf}/pages.parquet")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(_table(spark, sf, "documents"), "doc_id")


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _is_stored(url: str = "url") -> Column:
    return F.col(url).startswith("http://")


def _cents(col: str) -> Column:
    return F.round(F.col(col) * 100).cast("bigint")


# --- extraction -------------------------------------------------------------------


def extract_links(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_links(_pages(spark, sf))


def extract_lyrics(spark: SparkSession, sf: str) -> DataFrame:
    return extract_articles(_pages(spark, sf)).select("page_id", "name", "content")


def _counter_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with a view counter put before the article, left out on plain ``http``."""
    number = F.col("page_id") * 1_234_567 + 89
    dotted = F.replace(F.format_number(number, 0), F.lit(","), F.lit("."))
    counter = F.concat(
        F.lit('<div id="n" class="box head-info-exib"><div>seen</div> <b> '),
        dotted,
        F.lit(" </b></div><article>"),
    )
    html = F.when(_is_stored(), F.col("html")).otherwise(
        F.replace(F.col("html"), F.lit("<article>"), counter)
    )
    return _pages(spark, sf).select("page_id", "url", html.alias("html"))


def extract_views(spark: SparkSession, sf: str) -> DataFrame:
    clean = _counter_pages(spark, sf).withColumn("html", H.strip_hidden(F.col("html")))
    counted = extract.with_views_text(clean, "html", SiteLayout().views, "views_text")
    return counted.select(
        "page_id",
        dotted_int(F.col("views_text")).alias("artist_views"),
        extract.song_views(F.col("views_text")).alias("song_views"),
    )


def _titled_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages whose link list is a song list, titles blank on plain ``http``."""
    title = F.when(_is_stored(), F.lit(" ")).otherwise(F.lit(" About $1 "))
    entry = F.concat(
        F.lit('<li class="songList-table-row">'),
        F.lit('<a title="'),
        title,
        F.lit('" class="songList-table-songName" href="/x/$1/">'),
    )
    html = F.regexp_replace(F.col("html"), F.lit('<li><a href="/([^"]*)">'), entry)
    return _pages(spark, sf).select("page_id", "url", html.alias("html"))


def song_names(spark: SparkSession, sf: str) -> DataFrame:
    layout = SiteLayout()
    return extract.extract_songs(_titled_pages(spark, sf), layout.song_row, layout.song_link)


def paths(spark: SparkSession, sf: str) -> DataFrame:
    host, song = N.url_host(F.col("url")), F.col("page_id").cast("string")
    return _table(spark, sf, "pages").select(
        "page_id",
        N.artist_path(host).alias("artist_path"),
        N.song_path(host, song).alias("song_path"),
        N.url_path(F.col("url")).alias("page_path"),
    )


def page_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Pages joined to the entities their paths name; several pages share a path."""
    pages = _table(spark, sf, "pages")
    entities = pages.select(N.url_path(F.col("url")).alias("path")).distinct()
    return delta.pages_of(pages, entities).select("page_id", "path")


def decoded_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Page bodies as bytes with invalid ones put in, read back as text."""
    broken = F.concat(F.encode("html", "UTF-8"), F.unhex(F.lit("FFC0")), F.encode("url", "UTF-8"))
    bodies = _table(spark, sf, "pages").select("page_id", "url", broken.alias("body"))
    return decode_pages(bodies).select("page_id", F.md5("html").alias("digest"))


# --- text, buckets, rules ---------------------------------------------------------


def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    documents = _documents(spark, sf)
    return documents.select("doc_id", clean_for_detection(F.col("text")).alias("cleaned"))


# Entities with and without a use of their own for what follows.
ENTITIES = [
    "eacute", "copy", "not", "notit", "notin", "hellip", "AMP", "amp", "lt", "CounterClockwiseContourIntegral",
    "fjlig", "nosuch", "#233", "#xE9", "#128", "reg", "szlig", "paraX", "Aacute", "times", "middot", "#x110000",
]
ENTITY_ENDS = [";", "", " ", "x", "=", "."]


def decoded_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Headings with an entity put behind them, its semicolon there or not."""
    pages = extract_articles(_pages(spark, sf)).select("page_id", F.replace("name", F.lit("&"), F.lit("+")).alias("name"))
    entity = F.get(F.array(*map(F.lit, ENTITIES)), (F.col("page_id") % len(ENTITIES)).cast("int"))
    turn = F.floor(F.col("page_id") / len(ENTITIES)) % len(ENTITY_ENDS)
    end = F.get(F.array(*map(F.lit, ENTITY_ENDS)), turn.cast("int"))
    text = F.concat("name", F.lit(" A&"), entity, end, F.lit("Z &amp;lt; &quot;"))
    return pages.select("page_id", unescape(text).alias("decoded"))


def _text_artists(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents").select(
        F.col("text").alias("name"),
        F.concat(F.lit("d"), "doc_id").alias("slug"),
        F.col("doc_id").alias("seq"),
    )


def letter_buckets(spark: SparkSession, sf: str) -> DataFrame:
    priorities = _table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("name"),
        F.concat(F.lit("o"), "o_orderkey").alias("slug"),
        F.col("o_orderkey").alias("seq"),
    )
    return report.letter_counts(_text_artists(spark, sf).unionByName(priorities))


def artists_by_letter(spark: SparkSession, sf: str) -> DataFrame:
    return report.grouped_by_letter(_text_artists(spark, sf)).select("bucket", "slug", "seq")


def _rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KEYWORDS, RULES)


def exclude_keywords(spark: SparkSession, sf: str) -> DataFrame:
    documents = _documents(spark, sf)
    kept = rules.exclude_keywords(documents, _rules(spark), "lyrics", "doc_id", "text")
    return kept.select("doc_id", "n_chars")


def exclude_listed_phrases(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that quote no page heading: a list that grows with the data."""
    headings = extract_articles(_pages(spark, sf)).select(
        F.lit("lyrics").alias("scope"), F.col("name").alias("keyword")
    )
    listed = materialize(headings, "headings")
    documents = _documents(spark, sf)
    kept = rules.exclude_keywords(documents, listed, "lyrics", "doc_id", "text")
    return kept.select("doc_id", "n_chars")


def exclude_long_list(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the way that takes lists of any length."""
    headings = extract_articles(_pages(spark, sf)).select(
        F.lit("lyrics").alias("scope"), F.col("name").alias("keyword")
    )
    listed = materialize(headings, "headings")
    kept = rules.exclude_keywords(_documents(spark, sf), listed, "lyrics", "doc_id", "text", pattern_keywords=0)
    return kept.select("doc_id", "n_chars")


def length_bounds(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents")
    return documents.where(rules.within_length(F.col("text"))).select("doc_id", "n_chars")


# --- language ---------------------------------------------------------------------


def _profile(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(language.lang_profile(_documents(spark, sf)), "profile")


def lang_profile(spark: SparkSession, sf: str) -> DataFrame:
    return language.lang_profile(_documents(spark, sf))


def lang_detect(spark: SparkSession, sf: str) -> DataFrame:
    documents = _documents(spark, sf)
    return language.detect_language(documents, _profile(spark, sf), LANGS, "doc_id", "text")


def lang_confusion(spark: SparkSession, sf: str) -> DataFrame:
    """Pages by the language in their path and the language found in their text."""
    articles = materialize(extract_articles(_pages(spark, sf)), "articles")
    found = language.detect_language(articles, _profile(spark, sf), LANGS, "page_id", "content")
    label = F.regexp_extract("url", "^[a-z]+://[^/]+/([a-z]+)/", 1).alias("label")
    return (
        articles.select("page_id", label)
        .join(found, "page_id")
        .groupBy("label", "lang")
        .agg(F.count("*").alias("pages"))
    )


def lang_filter(spark: SparkSession, sf: str) -> DataFrame:
    documents = _documents(spark, sf)
    kept = language.filter_language(
        documents, _profile(spark, sf), LANGS, TARGET, "doc_id", "text"
    )
    return kept.select("doc_id", "n_chars")


# --- delta ------------------------------------------------------------------------


def _hosts(spark: SparkSession, sf: str, stored: bool) -> DataFrame:
    """Hosts as artists. The stored side has one view less on pages with a query."""
    articles = extract_articles(_table(spark, sf, "pages"))
    views = F.col("views")
    if stored:
        articles = articles.where(_is_stored())
        views = views - F.col("url").contains("?").cast("bigint")
    return articles.groupBy("host").agg(
        F.max(views).alias("views"), F.min("page_id").alias("seq")
    ).select(F.col("host").alias("slug"), F.col("host").alias("name"), "views", "seq")


def _stored_hosts(spark: SparkSession, sf: str) -> DataFrame:
    empty = spark.createDataFrame([], ARTISTS)
    return upsert.upsert_artists(empty, _hosts(spark, sf, True), FIRST)


def new_artists(spark: SparkSession, sf: str) -> DataFrame:
    crawled = _hosts(spark, sf, False)
    return delta.new_artists(crawled, _stored_hosts(spark, sf)).select("slug", "views")


def _host_songs(spark: SparkSession, sf: str) -> DataFrame:
    """Every page as a song of its host, with the host's id."""
    empty = spark.createDataFrame([], ARTISTS)
    artists = upsert.upsert_artists(empty, _hosts(spark, sf, False), FIRST)
    songs = extract_articles(_pages(spark, sf)).select(
        F.col("host").alias("artist_slug"),
        F.col("page_id").cast("string").alias("slug"),
        "name",
        "views",
        "url",
        F.col("page_id").alias("seq"),
    )
    return delta.songs_with_artist(songs, materialize(artists, "hosts"))


def songs_with_artist(spark: SparkSession, sf: str) -> DataFrame:
    return _host_songs(spark, sf).select("artist_id", "artist_slug", "slug", "name")


def new_songs(spark: SparkSession, sf: str) -> DataFrame:
    songs = _host_songs(spark, sf)
    stored = songs.where(_is_stored()).select("artist_id", "slug")
    return delta.new_songs(songs, stored).select("artist_id", "slug", "name")


def artist_delta(spark: SparkSession, sf: str) -> DataFrame:
    found = delta.artist_delta(_hosts(spark, sf, False), _stored_hosts(spark, sf))
    return found.select("slug", "id", "views", "old_views", "action")


def refresh_views(spark: SparkSession, sf: str) -> DataFrame:
    """Stored hosts with the counts of their pages that are served securely."""
    articles = extract_articles(_table(spark, sf, "pages")).where(~_is_stored())
    fresh = articles.groupBy(F.col("host").alias("slug")).agg(F.max("views").alias("views"))
    return delta.refresh_views(_stored_hosts(spark, sf), fresh).select("id", "slug", "views")


def processed_artists(spark: SparkSession, sf: str) -> DataFrame:
    stored = _stored_hosts(spark, sf)
    added = delta.new_artists(_hosts(spark, sf, False), stored)
    columns = ["slug", "name", "views"]
    return delta.processed_artists(added.select(*columns), stored.select(*columns))


def _order_songs(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("artist_id"),
        F.concat("o_orderpriority", F.lit("/"), "o_orderstatus").alias("name"),
        F.col("o_orderkey").cast("string").alias("slug"),
        _cents("o_totalprice").alias("views"),
        upsert.batch_time(FIRST).alias("added_date"),
    )


def _customer_artists(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.lower("c_name").alias("slug"),
        _cents("c_acctbal").alias("views"),
        upsert.batch_time(FIRST).alias("added_date"),
    )


def _document_lyrics(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("doc_id").alias("song_id"),
        F.col("text").alias("content"),
        upsert.batch_time(FIRST).alias("last_updated"),
    )


def lyrics_to_extract(spark: SparkSession, sf: str) -> DataFrame:
    songs, lyrics = _order_songs(spark, sf), _document_lyrics(spark, sf)
    stored, missing = delta.split_stored_lyrics(songs, lyrics)
    return stored.select("song_id", F.lit("stored").alias("state")).unionByName(
        missing.select(F.col("id").alias("song_id"), F.lit("missing").alias("state"))
    )


def key_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Songs of the artists in debt."""
    keys = _table(spark, sf, "customer").where("c_acctbal < 0")
    wanted = keys.select(F.col("c_custkey").alias("artist_id"))
    return lookup(_order_songs(spark, sf), wanted, "artist_id").select("id", "artist_id")


def lookup_artist_by_slug(spark: SparkSession, sf: str) -> DataFrame:
    """Artists by the names that orders were written by, in other cases and with one unknown."""
    keys = _table(spark, sf, "customer").where("c_acctbal > 9000").select(F.lower("c_name").alias("slug"))
    unknown = spark.createDataFrame([("nobody",)], "slug string")
    return lookup(_customer_artists(spark, sf), keys.unionByName(unknown), "slug").select("id", "slug")


def lookup_artist_by_id(spark: SparkSession, sf: str) -> DataFrame:
    keys = _table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id"))
    return lookup(_customer_artists(spark, sf), keys, "id", "slug").select("id", "name")


def lookup_song_by_id(spark: SparkSession, sf: str) -> DataFrame:
    keys = _table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"))
    return lookup(_order_songs(spark, sf), keys, "id", "slug").select("id", "artist_id")


def lookup_lyrics_by_song(spark: SparkSession, sf: str) -> DataFrame:
    keys = _table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("song_id"))
    return lookup(_document_lyrics(spark, sf), keys, "song_id").select("song_id", F.md5("content").alias("digest"))


# --- writes -----------------------------------------------------------------------


def upsert_artists(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with money are stored; each order names its customer with new views."""
    customers = _table(spark, sf, "customer")
    stored = lookup(
        _customer_artists(spark, sf),
        customers.where("c_acctbal >= 0").select(F.col("c_custkey").alias("id")),
        "id",
        spread="slug",
    )
    incoming = _table(spark, sf, "orders").select(
        F.concat(F.lit("customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("slug"),
        F.concat(F.lit("From "), "o_orderpriority").alias("name"),
        _cents("o_totalprice").alias("views"),
        F.col("o_orderkey").alias("seq"),
    )
    result = upsert.upsert_artists(stored, incoming, SECOND)
    return result.select("id", "name", "slug", "views", _stamp("added_date"))


def _stamp(column: str) -> Column:
    return F.date_format(column, "yyyyMMdd").alias(column)


def update_views(spark: SparkSession, sf: str) -> DataFrame:
    updates = _table(spark, sf, "orders").select(
        (F.col("o_custkey") * 2).alias("id"),
        _cents("o_totalprice").alias("views"),
        F.col("o_orderkey").alias("seq"),
    )
    result = upsert.update_views(_customer_artists(spark, sf), updates)
    return result.select("id", "slug", "views")


def upsert_songs(spark: SparkSession, sf: str) -> DataFrame:
    """Finished orders are stored; line items bring all orders, several times over."""
    orders = _table(spark, sf, "orders")
    finished = orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"))
    stored = lookup(_order_songs(spark, sf), finished, "id", spread="slug")
    items = _table(spark, sf, "lineitem").join(
        orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey"
    )
    place = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    incoming = items.select(
        F.col("o_custkey").alias("artist_id"),
        F.col("l_orderkey").cast("string").alias("slug"),
        F.concat(F.lit("Part "), "l_partkey").alias("name"),
        _cents("l_extendedprice").alias("views"),
        place.alias("seq"),
    )
    result = upsert.upsert_songs(stored, incoming, SECOND)
    return result.select("id", "artist_id", "name", "slug", "views")


def upsert_lyrics(spark: SparkSession, sf: str) -> DataFrame:
    """Documents are stored; the turns of a conversation replace a text one by one."""
    stored = _document_lyrics(spark, sf)
    incoming = _table(spark, sf, "conversations").select(
        (F.col("conv_id") * 13).alias("song_id"),
        F.col("text").alias("content"),
        (F.col("conv_id") * 100_000 + F.col("turn")).alias("seq"),
    )
    result = upsert.upsert_lyrics(stored, incoming, SECOND)
    return result.select("id", "song_id", F.md5("content").alias("digest"), _stamp("last_updated"))


def assign_ids(spark: SparkSession, sf: str) -> DataFrame:
    new = _table(spark, sf, "orders").select(
        F.col("o_custkey").alias("artist_id"), F.col("o_orderkey").cast("string").alias("slug")
    )
    stored = _table(spark, sf, "part").select(F.col("p_partkey").alias("id"))
    return upsert.assign_ids(new, ["artist_id", "slug"], stored).select("id", "artist_id", "slug")


def constraint_report(spark: SparkSession, sf: str) -> DataFrame:
    """Artists in debt are missing, songs share slugs, titles are whole texts."""
    artists = _customer_artists(spark, sf).where("views >= 0").withColumn(
        "slug", F.concat(F.col("slug").substr(-3, 3), F.lit("x"))
    )
    songs = _order_songs(spark, sf).withColumn("slug", F.col("name"))
    texts = _document_lyrics(spark, sf)
    titles = texts.select(
        F.col("id"),
        F.lit(None).cast("bigint").alias("artist_id"),
        F.col("content").alias("name"),
        F.concat(F.lit("t"), "id").alias("slug"),
        F.lit(0).cast("bigint").alias("views"),
        F.col("last_updated").alias("added_date"),
    )
    lyrics = texts.withColumn("song_id", F.col("id") * 20)
    return checks.constraint_report(artists, songs.unionByName(titles), lyrics)


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Balances as view counts; those with a thousands comma are no numbers."""
    crawled = _table(spark, sf, "customer").select(
        F.lower("c_name").alias("slug"), F.format_number("c_acctbal", 2).alias("views_text")
    )
    return checks.crawl_violations(
        crawled,
        "artists",
        F.col("slug"),
        dotted_int(F.col("views_text")).isNull(),
        F.col("views_text"),
        "views",
    )


# --- release ----------------------------------------------------------------------


def _release_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    lyrics = _document_lyrics(spark, sf).withColumn("seq", F.col("song_id"))
    return lyrics, _order_songs(spark, sf), _customer_artists(spark, sf)


def release_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = report.release_rows(*_release_tables(spark, sf))
    return rows.select("filename", F.md5("body").alias("digest"), "bucket")


def song_files(spark: SparkSession, sf: str) -> DataFrame:
    """The release written as one text file per song, then read back."""
    path = _scratch(spark, "texts")
    write_song_files(report.release_rows(*_release_tables(spark, sf)), path)
    files = read_song_files(spark, song_folder(spark, path))
    return files.select("filename", F.md5("body").alias("digest"))


def song_bundle(spark: SparkSession, sf: str) -> DataFrame:
    """The release written as compressed bundles by letter, then read back."""
    folder = _scratch(spark, "bundle")
    write_bundle(report.release_rows(*_release_tables(spark, sf)), folder)
    return read_bundle(spark, folder).select("filename", F.md5("body").alias("digest"), "bucket")


def _page_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with lyrics per host, shaped like the statistics of a release."""
    sung = extract_articles(_pages(spark, sf)).where("content <> ''")
    return sung.groupBy(F.col("host").alias("name")).agg(
        F.max("views").alias("views"),
        F.count("*").alias("songs"),
        F.min("page_id").alias("first_seq"),
    )


def top_artists(spark: SparkSession, sf: str) -> DataFrame:
    return report.top_artists(_page_stats(spark, sf))


def artist_stats(spark: SparkSession, sf: str) -> DataFrame:
    return report.artist_stats(*_release_tables(spark, sf))


def release_totals(spark: SparkSession, sf: str) -> DataFrame:
    return report.release_totals(report.artist_stats(*_release_tables(spark, sf)))


def release_notes(spark: SparkSession, sf: str) -> DataFrame:
    return report.release_notes(
        report.artist_stats(*_release_tables(spark, sf)), "Catalogue Update"
    )


def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    lyrics, songs, artists = _release_tables(spark, sf)
    return report.table_counts({"artists": artists, "songs": songs, "lyrics": lyrics})


def artists_by_name(spark: SparkSession, sf: str) -> DataFrame:
    parts = _table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name")
    )
    return report.by_name(parts)


# --- runs -------------------------------------------------------------------------


def _detector(spark: SparkSession, sf: str) -> Detector:
    return Detector(_profile(spark, sf), LANGS, TARGET)


def _catalogue(store: CatalogueStore) -> DataFrame:
    """All lyrics of a catalogue with their song and artist."""
    tables = store.tables()
    artists = tables["artists"].select(
        F.col("id").alias("artist_id"),
        F.col("slug").alias("artist"),
        F.col("views").alias("artist_views"),
    )
    songs = tables["songs"].select(
        F.col("id").alias("song_id"),
        "artist_id",
        F.col("name").alias("song"),
        "slug",
        F.col("views").alias("song_views"),
    )
    lyrics = tables["lyrics"].select(
        F.col("id").alias("lyric_id"), "song_id", F.md5("content").alias("digest")
    )
    return lyrics.join(songs, "song_id").join(artists, "artist_id")


def full_run(spark: SparkSession, sf: str) -> DataFrame:
    store = CatalogueStore(spark, _scratch(spark, "store"))
    crawl = crawl_articles(_pages(spark, sf))
    run_full(store, crawl, _detector(spark, sf), "first", FIRST)
    return _catalogue(store)


def _two_runs(spark: SparkSession, sf: str) -> tuple[CatalogueStore, RunResult]:
    pages, detector = _pages(spark, sf), _detector(spark, sf)
    store = CatalogueStore(spark, _scratch(spark, "store"))
    run_full(store, crawl_articles(pages.where(_is_stored())), detector, "first", FIRST)
    return store, run_incremental(store, crawl_articles(pages), detector, "second", SECOND)


def incremental_run(spark: SparkSession, sf: str) -> DataFrame:
    return _catalogue(_two_runs(spark, sf)[0])


def run_report(spark: SparkSession, sf: str) -> DataFrame:
    return _two_runs(spark, sf)[1].report


def run_release(spark: SparkSession, sf: str) -> DataFrame:
    """The notes of the release that follows a full run."""
    store = CatalogueStore(spark, _scratch(spark, "store"))
    crawl = crawl_articles(_pages(spark, sf))
    result = run_full(store, crawl, _detector(spark, sf), "first", FIRST)
    return create_release(store, result.lyrics, _scratch(spark, "release"), FIRST)


def _site_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A site made of the pages: each is an artist whose link list is the song list."""
    source = _counter_pages(spark, sf)
    artist = F.concat(F.lit("p"), "page_id")
    row = F.concat(
        F.lit('<li class="songList-table-row"><a class="songList-table-songName" href="/'),
        artist,
        F.lit('/$1">'),
    )
    home = F.concat(F.lit("http://site.example/artists/all?page="), "page_id")
    entry = F.concat(F.lit('<p><a href="/'), artist, F.lit('/">Artist '), "page_id", F.lit("</a>"))
    index = source.select((F.col("page_id") * 100).alias("page_id"), home.alias("url"), entry.alias("html"))
    own = F.concat(F.lit("http://site.example/"), artist, F.lit("/"))
    artists = source.select(
        (F.col("page_id") * 100 + 1).alias("page_id"),
        own.alias("url"),
        F.regexp_replace("html", F.lit('<li><a href="/([^"]*)">'), row).alias("html"),
    )
    lyrics = F.replace(
        F.replace(F.col("html"), F.lit("<article>"), F.lit('<div class="lyric-original wide"><div>')),
        F.lit("</article>"),
        F.lit("</div></div>"),
    )
    links = F.transform(
        extract.link_array(F.col("html")), lambda link: link["slug"]
    )
    songs = source.select(
        "page_id", F.posexplode(links).alias("pos", "slug"), lyrics.alias("html")
    ).select(
        (F.col("page_id") * 100 + 2 + F.col("pos")).alias("page_id"),
        F.concat(F.lit("http://site.example/"), artist, F.lit("/"), "slug").alias("url"),
        "html",
    )
    return index.unionByName(artists).unionByName(songs)


def site_run(spark: SparkSession, sf: str) -> DataFrame:
    """A full run over a site with index, artist and song pages."""
    pages = materialize(_site_pages(spark, sf), "site-pages")
    store = CatalogueStore(spark, _scratch(spark, "store"))
    crawl = crawl_site(pages, SiteLayout(index_path="/artists/all"))
    run_full(store, crawl, _detector(spark, sf), "site", FIRST)
    return _catalogue(store).drop("lyric_id", "song_id", "artist_id")


def snapshot_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per table after a backup, after clearing, and after the restore."""
    store = CatalogueStore(spark, _scratch(spark, "store"))
    backup = _scratch(spark, "backups")
    staged = store.begin()
    store.stage(staged, "artists", _customer_artists(spark, sf))
    store.stage(staged, "songs", _order_songs(spark, sf))
    store.stage(staged, "lyrics", _document_lyrics(spark, sf))
    store.publish(staged, FIRST, "load")
    create_backup(store, backup, FIRST)
    before = store.counts().withColumnRenamed("n_rows", "stored")
    store.publish(store.empty(), FIRST, "clear")
    cleared = store.counts().withColumnRenamed("n_rows", "cleared")
    restore_newest(store, backup, SECOND)
    after = store.counts().withColumnRenamed("n_rows", "restored")
    return before.join(cleared, "table_name").join(after, "table_name")


def stream_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Pages arrive as two loads of files, each taken by an incremental run over all so far."""
    pages, arrivals = _pages(spark, sf), _scratch(spark, "arrivals")
    store = CatalogueStore(spark, _scratch(spark, "store"))
    detector, checkpoint = _detector(spark, sf), _scratch(spark, "stream")
    for part, when in ((pages.where(_is_stored()), FIRST), (pages.where(~_is_stored()), SECOND)):
        part.write.mode("append").parquet(arrivals)
        run_arrivals(spark, arrivals, checkpoint, store, ArticlePages(), detector, when)
    return _catalogue(store)


def stream_site(spark: SparkSession, sf: str) -> DataFrame:
    """Songs, artists and lists of a site arrive in this order, a file and a run each."""
    pages, arrivals = materialize(_site_pages(spark, sf), "site-pages"), _scratch(spark, "arrivals")
    path = N.strip_slashes(N.url_path(F.col("url")))
    depth = F.when(path == "artists/all", 0).otherwise(F.size(F.split(path, "/")))
    for kind in (2, 1, 0):
        pages.where(depth == kind).coalesce(1).write.mode("append").parquet(arrivals)
    store = CatalogueStore(spark, _scratch(spark, "store"))
    crawler = SitePages(SiteLayout(index_path="/artists/all"))
    checkpoint = _scratch(spark, "stream")
    run_arrivals(
        spark, arrivals, checkpoint, store, crawler, _detector(spark, sf), FIRST, max_files_per_batch=1
    )
    return _catalogue(store).drop("lyric_id", "song_id", "artist_id")


def restore_then_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """A run is undone by a restore and runs again, to the same catalogue."""
    pages, detector = _pages(spark, sf), _detector(spark, sf)
    store, backup = CatalogueStore(spark, _scratch(spark, "store")), _scratch(spark, "backups")
    run_full(store, crawl_articles(pages.where(_is_stored())), detector, "first", FIRST)
    create_backup(store, backup, FIRST)
    crawl = crawl_articles(pages)
    for _ in range(2):
        restore_newest(store, backup, SECOND)
        run_incremental(store, crawl, detector, "second", SECOND)
    return _catalogue(store)


def _lossy_site(spark: SparkSession, sf: str) -> DataFrame:
    """The site with losses: lists, artist pages and lyric containers are gone on some languages."""
    source = _pages(spark, sf).select(F.col("page_id").alias("source"), F.col("url").alias("from"))
    site = _site_pages(spark, sf).withColumn("source", F.floor(F.col("page_id") / 100)).join(source, "source")
    kind = F.when(F.col("page_id") % 100 == 0, "list").when(F.col("page_id") % 100 == 1, "artist").otherwise("song")
    unlisted = F.col("from").contains("/es/") & F.col("from").contains("?")
    gone = ((kind == "list") & unlisted) | ((kind == "artist") & F.col("from").contains("/de/"))
    bare = (kind == "song") & F.col("from").contains("/fr/")
    html = F.when(bare, F.replace("html", F.lit("lyric-original"), F.lit("other"))).otherwise(F.col("html"))
    return site.where(~gone).select("page_id", "url", html.alias("html"))


def run_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """What became of every listed artist and song and of every page of a site with losses."""
    pages = materialize(_lossy_site(spark, sf), "site-pages")
    store = CatalogueStore(spark, _scratch(spark, "store"))
    crawl = crawl_site(pages, SiteLayout(index_path="/artists/all"))
    result = run_full(store, crawl, _detector(spark, sf), "site", FIRST)
    return result.outcomes.select("level", "key", "outcome")


RUN_RULES = [("artists", "net"), ("titles", "the"), ("titles", "de"), ("lyrics", "que la"), ("lyrics", "Del  Y")]
RUN_LENGTHS = (150, 3000)


def run_with_rules(spark: SparkSession, sf: str) -> DataFrame:
    """A full run under rules that are read from a file."""
    path = _scratch(spark, "rules")
    spark.createDataFrame(RUN_RULES, RULES).write.json(path)
    listed = LyricRules(read_keywords(spark, path), TARGET, *RUN_LENGTHS)
    store = CatalogueStore(spark, _scratch(spark, "store"))
    run_full(store, crawl_articles(_pages(spark, sf)), _detector(spark, sf), "first", FIRST, listed)
    return _catalogue(store)


def init_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per table after creating them, after a load, and after creating them again."""
    store = CatalogueStore(spark, _scratch(spark, "store"))
    store.init(FIRST)
    created = store.counts().withColumnRenamed("n_rows", "created")
    staged = store.begin()
    store.stage(staged, "artists", _customer_artists(spark, sf))
    store.publish(staged, FIRST, "load")
    store.init(SECOND)
    again = store.counts().withColumnRenamed("n_rows", "again")
    return created.join(again, "table_name").withColumn("version", F.lit(store.current()["version"]))


def empty_crawl(spark: SparkSession, sf: str) -> DataFrame:
    """Versions and results of a run that lists no artist, before and after one that does, and of a release of nothing."""
    pages, detector = _pages(spark, sf), _detector(spark, sf)
    store = CatalogueStore(spark, _scratch(spark, "store"))
    nothing = crawl_articles(pages.where("url IS NULL"))
    results = []
    for name, crawl in (("empty", nothing), ("pages", crawl_articles(pages)), ("empty again", nothing)):
        result = run_incremental(store, crawl, detector, name, FIRST)
        results.append((name, result is not None, store.manifest().count()))
    release = create_release(store, store.table("lyrics").limit(0), _scratch(spark, "release"), FIRST)
    results.append(("release", release is not None, store.manifest().count()))
    counted = store.counts().where("table_name = 'artists'").select(F.col("n_rows").alias("artists"))
    return spark.createDataFrame(results, "step string, done boolean, versions bigint").crossJoin(F.broadcast(counted))


def step_artists(spark: SparkSession, sf: str) -> DataFrame:
    """The artists that an incremental run writes when the pages of plain ``http`` are stored."""
    stored = _stored_hosts(spark, sf)
    incoming, _, _ = process_artists(crawl_articles(_pages(spark, sf)), stored, full=False)
    return incoming.select("slug", "name", "views")


def _crawled_hosts(spark: SparkSession, sf: str) -> DataFrame:
    empty = spark.createDataFrame([], ARTISTS)
    return materialize(upsert.upsert_artists(empty, _hosts(spark, sf, False), FIRST), "hosts")


def step_songs(spark: SparkSession, sf: str) -> DataFrame:
    """Listed songs that are not stored, when those of plain ``http`` are."""
    crawl, artists = crawl_articles(_pages(spark, sf)), _crawled_hosts(spark, sf)
    stored = _host_songs(spark, sf).where(_is_stored())
    return process_songs(crawl, artists, stored).select("artist_slug", "slug", "name")


def step_lyrics(spark: SparkSession, sf: str) -> DataFrame:
    """The new songs whose page is in the language to keep."""
    crawl, artists = crawl_articles(_pages(spark, sf)), _crawled_hosts(spark, sf)
    none = spark.createDataFrame([], SONGS)
    listed = process_songs(crawl, artists, none).withColumn("id", F.lit(None).cast("bigint"))
    kept = process_lyrics(crawl, listed, _detector(spark, sf))
    return kept.select("artist_slug", "slug", "name", "views")


def version_diff(spark: SparkSession, sf: str) -> DataFrame:
    """What the second of two runs changed in each table."""
    store, result = _two_runs(spark, sf)
    return diff_of_versions(store, result.version - 1, result.version)


QUERIES = {
    f.__name__: f
    for f in [
        extract_links,
        extract_lyrics,
        extract_views,
        song_names,
        paths,
        page_entities,
        decoded_pages,
        clean_text,
        letter_buckets,
        artists_by_letter,
        exclude_keywords,
        exclude_listed_phrases,
        length_bounds,
        lang_profile,
        lang_detect,
        lang_confusion,
        lang_filter,
        new_artists,
        songs_with_artist,
        new_songs,
        artist_delta,
        refresh_views,
        processed_artists,
        lyrics_to_extract,
        key_lookup,
        upsert_artists,
        update_views,
        upsert_songs,
        upsert_lyrics,
        assign_ids,
        constraint_report,
        quarantine,
        release_rows,
        song_files,
        song_bundle,
        top_artists,
        artist_stats,
        release_totals,
        release_notes,
        table_counts,
        artists_by_name,
        full_run,
        incremental_run,
        run_report,
        run_release,
        site_run,
        snapshot_roundtrip,
        stream_incremental,
        stream_site,
        restore_then_rerun,
        run_quarantine,
        run_with_rules,
        exclude_long_list,
        decoded_entities,
        init_tables,
        empty_crawl,
        step_artists,
        step_songs,
        step_lyrics,
        lookup_artist_by_slug,
        lookup_artist_by_id,
        lookup_song_by_id,
        lookup_lyrics_by_song,
        version_diff,
    ]
}
