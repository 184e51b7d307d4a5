
import shutil

import pytest
from conftest import DAY_1, DAY_2

from cantiga.operators.language import lang_profile
from cantiga.plans.crawl import SitePages, before_all, crawl_site
from cantiga.operators import ledger, report
from cantiga.plans.runs import (
    Detector,
    create_release,
    process_lyrics,
    run_full,
    run_incremental,
    texts_of,
)
from cantiga.schemas import LYRICS, PAGES, RULES, SONGS, SiteLayout
from cantiga.sources.rules import LyricRules
from cantiga.sources.store import CatalogueStore, backups, create_backup, restore_newest
from cantiga.streaming.arrivals import run_arrivals

LAYOUT = SiteLayout(index_path="/list")
PT = "o coração canta uma canção de amor e paz, não sei se você vem"
EN = "the heart sings a song of love and peace, will you come"


@pytest.fixture(scope="module")
def detector(spark):
    samples = spark.createDataFrame([("pt", PT), ("en", EN)], "lang string, text string")
    return Detector(lang_profile(samples).cache(), ["en", "pt"], "pt")


@pytest.fixture
def store(spark, tmp_path):
    return CatalogueStore(spark, str(tmp_path / "store"))


def index(*artists):
    links = "".join(f'<a href="/{slug}/">{name}</a>' for slug, name in artists)
    return ("http://h/list", links)


def artist(slug, views, *songs):
    rows = "".join(
        f'<li class="songList-table-row"><a class="songList-table-songName" href="/{slug}/{s}/">{s.upper()}</a></li>'
        for s in songs
    )
    counter = "" if views is None else f'<div class="head-info-exib"><b>{views}</b></div>'
    return (f"http://h/{slug}/", counter + rows)


def song(slug, name, text, views=None):
    counter = "" if views is None else f'<div class="head-info-exib"><b>{views}</b></div>'
    body = "" if text is None else f'<div class="lyric-original"><p>{text}</p></div>'
    return (f"http://h/{slug}/{name}/", counter + body)


FIRST = [
    index(("ana", "Ana"), ("bia", "Bia"), ("caio", "Caio"), ("dora", "Dora"), ("ana", "Again")),
    artist("ana", "1.000", "s1", "s2", "s1", "s4"),
    artist("bia", "2.000", "b1", "b2"),
    artist("caio", None, "c1"),
    artist("dora", "1,234", "d1"),
    song("ana", "s1", PT, "50"),
    song("ana", "s2", EN, "60"),
    song("ana", "s4", None, "1"),
    song("bia", "b1", PT, "many"),
    song("bia", "b2", PT + "<br>fim"),
    song("caio", "c1", PT),
    song("dora", "d1", PT),
]
SECOND = [
    index(("ana", "Ana"), ("eva", "Eva")),
    artist("ana", "1.500", "s1", "s2"),
    artist("bia", "2.000", "b1", "b2", "b3"),
    artist("eva", "10", "e1"),
    song("ana", "s1", PT, "99"),
    song("ana", "s2", EN, "60"),
    song("bia", "b1", PT, "7"),
    song("bia", "b3", PT),
    song("eva", "e1", "old " + EN),
    song("eva", "e1", PT, "3"),
]


@pytest.fixture(scope="module")
def crawls(spark):
    """Crawls of the two states of the site; the page files are written once."""

    def of(items):
        table = spark.createDataFrame([(i, *item) for i, item in enumerate(items)], PAGES)
        return crawl_site(table, LAYOUT)

    return {"first": of(FIRST), "second": of(SECOND)}


@pytest.fixture(scope="module")
def first_run(spark, crawls, detector, tmp_path_factory):
    """A catalogue after a full run over the first state, and what the run gave."""
    root = tmp_path_factory.mktemp("first") / "store"
    store = CatalogueStore(spark, str(root))
    return root, run_full(store, crawls["first"], detector, "one", DAY_1)


@pytest.fixture
def loaded(spark, first_run, tmp_path):
    """A copy of that catalogue to go on from."""
    shutil.copytree(first_run[0], tmp_path / "loaded")
    return CatalogueStore(spark, str(tmp_path / "loaded"))


def crawl(pages, items):
    return crawl_site(pages(*items), LAYOUT)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def lyrics_of(store):
    tables = store.tables()
    named = (
        tables["lyrics"]
        .join(tables["songs"].selectExpr("id as song_id", "artist_id", "slug", "views"), "song_id")
        .join(tables["artists"].selectExpr("id as artist_id", "slug as artist"), "artist_id")
    )
    return rows(named, "artist", "slug", "views", "content")


def test_full_then_incremental_run(spark, crawls, detector, first_run, loaded, tmp_path):
    first, store = first_run[1], loaded
    assert rows(store.table("artists"), "slug", "name", "views") == [
        ("ana", "Ana", 1000), ("bia", "Bia", 2000),
    ]
    assert lyrics_of(store) == [("ana", "s1", 50, PT), ("bia", "b2", 0, PT + "\nfim")]
    assert rows(first.report, "*") == [("A", 1, 1, 0, 3, 1), ("B", 1, 1, 0, 2, 1)]
    assert rows(first.quarantine, "*") == [
        ("artists", "caio", "views", ""),
        ("artists", "dora", "views", "1,234"),
        ("songs", "bia/b1", "views", "many"),
    ]

    before = store.current()["tables"]["lyrics"]
    second = run_incremental(store, crawls["second"], detector, "two", DAY_2)
    # Lyrics are added as a folder; what was there is not written again.
    assert store.current()["tables"]["lyrics"][: len(before)] == before
    assert rows(store.table("artists"), "slug", "name", "views", "added_date") == [
        ("ana", "Ana", 1500, DAY_1), ("bia", "Bia", 2000, DAY_1), ("eva", "Eva", 10, DAY_2),
    ]
    assert lyrics_of(store) == [
        ("ana", "s1", 50, PT), ("bia", "b1", 7, PT), ("bia", "b2", 0, PT + "\nfim"),
        ("bia", "b3", 0, PT), ("eva", "e1", 3, PT),
    ]
    assert rows(second.report, "*") == [
        ("A", 1, 0, 1, 1, 0), ("B", 1, 0, 0, 2, 2), ("E", 1, 1, 0, 1, 1),
    ]
    for name in ("artists", "songs", "lyrics"):
        ids = [r[0] for r in rows(store.table(name), "id")]
        assert ids == list(range(1, len(ids) + 1))

    notes = create_release(store, second.lyrics, str(tmp_path / "out"), DAY_2, "Songs").first()[0]
    assert notes == (
        "# Songs\n\nAdded 3 new songs from 2 artists.\n\n## Top Artists\n"
        "- **Bia** (2 songs)\n- **Eva** (1 songs)\n"
    )
    folder = tmp_path / "out" / f"release-20240308-{second.version}"
    assert sorted(p.name for p in (folder / "texts").glob("*/??/*.txt")) == [
        "Bia - B1.txt", "Bia - B3.txt", "Eva - E1.txt",
    ]
    assert next((folder / "notes").glob("*.txt")).read_text() == notes
    assert backups(spark, str(tmp_path / "out" / "backups")).count() == 1


def test_same_crawl_again_changes_nothing(crawls, detector, loaded, tmp_path):
    before = {n: rows(df, "*") for n, df in loaded.tables().items()}
    again = run_incremental(loaded, crawls["first"], detector, "two", DAY_2)
    assert {n: rows(df, "*") for n, df in loaded.tables().items()} == before
    assert create_release(loaded, again.lyrics, str(tmp_path / "out"), DAY_2) is None
    assert not (tmp_path / "out").exists()


def test_known_batch_and_empty_crawl_do_nothing(pages, crawls, detector, loaded):
    version = loaded.current()["version"]
    assert run_full(loaded, crawl(pages, FIRST[1:]), detector, "none", DAY_1) is None
    assert run_incremental(loaded, crawls["second"], detector, "one", DAY_2) is None
    assert loaded.current()["version"] == version


def test_full_run_leaves_unlisted_artists_alone(crawls, detector, loaded):
    run_full(loaded, crawls["second"], detector, "two", DAY_2)
    assert [r[:2] for r in lyrics_of(loaded)] == [("ana", "s1"), ("bia", "b2"), ("eva", "e1")]


def test_song_without_lyrics_is_retried_on_request(spark, crawls, detector, loaded):
    staged = loaded.begin()
    ana = loaded.table("artists").where("slug = 'ana'").first()["id"]
    song = spark.createDataFrame([(9, ana, "S1", "s1", 5, DAY_1)], SONGS)
    loaded.stage(staged, "songs", song)
    loaded.stage(staged, "lyrics", spark.createDataFrame([], LYRICS))
    loaded.publish(staged, DAY_1, "lonely")
    run_incremental(loaded, crawls["first"], detector, "two", DAY_2)
    assert [r[:2] for r in lyrics_of(loaded)] == [("bia", "b2")]
    result = run_incremental(
        loaded, crawls["first"], detector, "three", DAY_2, retry_missing_lyrics=True
    )
    assert ("ana", "s1", 5, PT) in lyrics_of(loaded)
    assert rows(result.lyrics, "song_id") == [(9,)]


def test_rules_drop_artists_titles_and_texts(spark, pages, detector, store):
    items = [
        index(("ana", "Ana"), ("bia", "Padre Bia")),
        artist("ana", "1", "s1", "missa", "s3", "s4"),
        artist("bia", "2", "b1"),
        song("ana", "s1", PT),
        song("ana", "missa", PT),
        song("ana", "s3", PT + " Ave, Maria"),
        song("ana", "s4", "não sei"),
        song("bia", "b1", PT),
    ]
    words = [("artists", "padre"), ("titles", "Missa"), ("lyrics", "ave maria")]
    rules = LyricRules(spark.createDataFrame(words, RULES), min_length=20)
    run_full(store, crawl(pages, items), detector, "one", DAY_1, rules)
    assert lyrics_of(store) == [("ana", "s1", 0, PT)]
    assert rows(store.table("artists"), "slug") == [("ana",)]


def test_arriving_files_are_taken_once(spark, pages, detector, store, tmp_path):
    arrivals, seen = str(tmp_path / "pages"), []

    def run():
        run_arrivals(
            spark, arrivals, str(tmp_path / "stream"), store,
            SitePages(LAYOUT), detector, DAY_1, on_result=seen.append,
        )

    pages(*FIRST).coalesce(1).write.parquet(arrivals)
    run()
    assert len(seen) == 1 and len(lyrics_of(store)) == 2
    pages(*SECOND).coalesce(1).write.mode("append").parquet(arrivals)
    run()
    assert len(seen) == 2 and len(lyrics_of(store)) == 5
    batches = [r["batch_id"] for r in store.manifest().orderBy("version").collect()]
    stream = batches[0].split("/")[0]
    assert len(stream) == 36 and batches == [f"{stream}/0", f"{stream}/1"]

    # The stream forgets its last batch and plays it again.
    for name in ("1", ".1.crc"):
        (tmp_path / "stream" / "commits" / name).unlink(missing_ok=True)
    run()
    assert len(seen) == 2 and store.manifest().count() == 2


@pytest.mark.parametrize("files", [None, 1])
def test_pages_that_arrive_apart_from_their_list(spark, pages, detector, store, tmp_path, files):
    arrivals = str(tmp_path / "pages")
    for part in (FIRST[5:], FIRST[1:5], FIRST[:1]):  # songs first, the list last
        pages(*part).coalesce(1).write.mode("append").parquet(arrivals)
        run_arrivals(
            spark, arrivals, str(tmp_path / "stream"), store, SitePages(LAYOUT), detector, DAY_1, max_files_per_batch=files
        )
    assert lyrics_of(store) == [("ana", "s1", 50, PT), ("bia", "b2", 0, PT + "\nfim")]
    assert store.manifest().count() == 1


def test_a_run_reads_what_waits_and_its_own_rows(spark, pages, detector, store, tmp_path):
    """What was matched is not read again, however many batches came before."""
    read = []

    class Counting(SitePages):
        def assemble(self, parsed, stored=None):
            read.append(parsed.count())
            return super().assemble(parsed, stored)

    arrivals = str(tmp_path / "pages")
    for i in range(6):
        one = [index((f"a{i}", f"A{i}")), artist(f"a{i}", "10", f"s{i}"), song(f"a{i}", f"s{i}", PT)]
        one[0] = (f"http://h/list?page={i}", one[0][1])
        pages(*one).coalesce(1).write.mode("append").parquet(arrivals)
        run_arrivals(spark, arrivals, str(tmp_path / "stream"), store, Counting(LAYOUT), detector, DAY_1)
    assert read == [3] * 6 and len(lyrics_of(store)) == 6


def test_what_waits_is_matched_by_later_pages(spark, pages, detector, store, tmp_path):
    arrivals = str(tmp_path / "pages")
    read = []

    class Counting(SitePages):
        def assemble(self, parsed, stored=None):
            read.append(sorted(r["path"] for r in parsed.select("path").collect()))
            return super().assemble(parsed, stored)

    def arrive(*part):
        pages(*part).coalesce(1).write.mode("append").parquet(arrivals)
        run_arrivals(spark, arrivals, str(tmp_path / "stream"), store, Counting(LAYOUT), detector, DAY_1)

    arrive(index(("ana", "Ana"), ("bia", "Bia")), artist("ana", "5", "s1", "s2"), song("ana", "s1", PT), song("bia", "b1", PT))
    assert lyrics_of(store) == [("ana", "s1", 0, PT)]
    # A page that was judged waits for a new copy, a page without a list for its list.
    arrive(song("ana", "s2", EN))
    assert read[-1] == ["ana", "ana/s2", "bia/b1", "http://h/list"]
    arrive(artist("bia", "7", "b1"))
    assert read[-1] == ["ana", "bia", "bia/b1", "http://h/list"]
    arrive(song("ana", "s2", PT))
    assert read[-1] == ["ana", "ana/s2"]
    assert [r[:2] for r in lyrics_of(store)] == [("ana", "s1"), ("ana", "s2"), ("bia", "b1")]
    arrive(artist("ana", "9", "s1"))
    assert read[-1] == ["ana"] and store.table("artists").where("slug = 'ana' and views = 9").count() == 1


def test_arrivals_after_a_restore_are_read_again(spark, pages, detector, store, tmp_path):
    arrivals, backup = str(tmp_path / "pages"), str(tmp_path / "backups")

    def arrive(*part):
        pages(*part).coalesce(1).write.mode("append").parquet(arrivals)
        run_arrivals(spark, arrivals, str(tmp_path / "stream"), store, SitePages(LAYOUT), detector, DAY_1)

    arrive(index(("ana", "Ana")), artist("ana", "5", "s1", "s2"), song("ana", "s1", PT))
    create_backup(store, backup, DAY_1)
    arrive(song("ana", "s2", PT))
    assert len(lyrics_of(store)) == 2
    restore_newest(store, backup, DAY_2)
    assert len(lyrics_of(store)) == 1
    arrive(index(("ana", "Ana")))
    assert [r[:2] for r in lyrics_of(store)] == [("ana", "s1"), ("ana", "s2")]


def test_everything_a_crawl_names_has_one_outcome(spark, pages, detector, store):
    rules = spark.createDataFrame([("artists", "rei"), ("titles", "t1"), ("lyrics", "proibido")], RULES)
    crawl = crawl_site(
        pages(
            *FIRST, ("http://h/list?page=2", index(("rei", "O Rei"), ("nil", "Nil"))[1]), artist("rei", "5", "r1"), artist("zoe", "5", "z1"),
            song("bia", "x9", PT), song("rei", "r1", PT), song("ana", "s4", None),
        ),
        LAYOUT,
    )
    result = run_full(store, crawl, detector, "one", DAY_1, LyricRules(rules, "pt", 1, 4000))
    found = sorted(map(tuple, result.outcomes.collect()), key=repr)
    keys = [r[:2] for r in found]
    assert len(keys) == len(set(keys))
    by = {r[1]: r[2] for r in found}
    assert {k: by[k] for k in ("rei", "nil", "zoe", "caio", "dora")} == {
        "rei": "rule", "nil": "no_page", "zoe": "unlisted", "caio": "no_count", "dora": "bad_number",
    }
    assert by["bia/x9"] == "orphan" and by["rei/r1"] == "unknown_artist" and by["zoe/z1"] == "unknown_artist"
    listed = {f"{r['artist_slug']}/{r['slug']}" for r in crawl.songs.collect()} | {f"{r['artist_slug']}/{r['slug']}" for r in crawl.lyrics.collect()}
    assert {k for k in by if "/" in k} == listed
    assert ledger.losses(result.outcomes).count() == sum(v not in ("stored", "known") for v in by.values())


def test_large_page_numbers_and_long_lists(spark, detector, store):
    items = [index(("ana", "Ana")), artist("ana", "7", *[f"s{i}" for i in range(30)]), song("ana", "s29", PT)]
    table = spark.createDataFrame([((1 << 44) + i, *item) for i, item in enumerate(items)], PAGES)
    run_full(store, crawl_site(table, LAYOUT), detector, "one", DAY_1)
    assert lyrics_of(store) == [("ana", "s29", 0, PT)]


def test_only_listed_pages_are_scored(spark, crawls, detector):
    songs = spark.createDataFrame([(None, 1, "ana", "s1", "S1")], "id bigint, artist_id bigint, artist_slug string, slug string, name string")
    songs = songs.withColumn("seq", before_all())
    for limit in (0, 50_000):
        kept = process_lyrics(crawls["first"], songs, detector, limit=limit)
        assert rows(kept, "artist_slug", "slug", "views") == [("ana", "s1", 50)]
        assert texts_of(crawls["first"], kept.select("page"), limit).count() == 1


def test_retried_lyrics_of_one_file_name(spark, crawls, detector, loaded, tmp_path):
    staged = loaded.begin()
    ana = loaded.table("artists").where("slug = 'ana'").first()["id"]
    listed = [(8, ana, "x/y", "s1", 5, DAY_1), (9, ana, "x_y", "s9", 5, DAY_1), (10, ana, "q", "s10", 5, DAY_1)]
    loaded.stage(staged, "songs", spark.createDataFrame(listed, SONGS))
    loaded.stage(staged, "lyrics", spark.createDataFrame([], LYRICS))
    loaded.publish(staged, DAY_1, "lonely")
    more = [*FIRST, song("ana", "s9", PT), song("ana", "s10", PT)]
    table = spark.createDataFrame([(i, *item) for i, item in enumerate(more)], PAGES)
    result = run_incremental(loaded, crawl_site(table, LAYOUT), detector, "two", DAY_2, retry_missing_lyrics=True)
    names = report.release_names(result.lyrics, loaded.table("songs"), loaded.table("artists"))
    assert rows(names, "filename", "song") == [("Ana - q.txt", "q"), ("Ana - x_y.txt", "x_y"), ("Bia - B2.txt", "B2")]


def test_batches_after_a_backup_run_again(crawls, detector, loaded, tmp_path):
    backup = str(tmp_path / "backups")
    create_backup(loaded, backup, DAY_1)
    run_incremental(loaded, crawls["second"], detector, "two", DAY_2)
    after = lyrics_of(loaded)
    restore_newest(loaded, backup, DAY_2)
    assert loaded.has_batch("one") and not loaded.has_batch("two") and len(lyrics_of(loaded)) == 2
    assert run_incremental(loaded, crawls["second"], detector, "two", DAY_2) is not None
    assert lyrics_of(loaded) == after and loaded.has_batch("two")
    loaded.publish(loaded.empty(), DAY_2, "clear")
    assert loaded.has_batch("clear") and not loaded.has_batch("one") and not loaded.has_batch("two")


def test_releases_of_one_day_stay_apart(crawls, detector, loaded, first_run, tmp_path):
    out = str(tmp_path / "out")
    create_release(loaded, first_run[1].lyrics, out, DAY_1, version=first_run[1].version)
    second = run_incremental(loaded, crawls["second"], detector, "two", DAY_1)
    create_release(loaded, second.lyrics, out, DAY_1, version=second.version)
    folders = sorted(p.name for p in (tmp_path / "out").iterdir() if p.name.startswith("release"))
    assert folders == ["release-20240301-0", "release-20240301-1"]
