from pathlib import Path

import pytest
from conftest import DAY_1, DAY_2
from pyspark.sql import functions as F

from cantiga.operators import report
from cantiga.plans import queries
from cantiga.schemas import ARTISTS, LYRICS, SONGS, TABLES
from cantiga.sources import textfiles
from cantiga.sources.store import (
    CatalogueStore,
    CommitConflict,
    backups,
    create_backup,
    newest_backup,
    restore_backup,
    restore_newest,
    version_diff,
)
from cantiga.sources.textfiles import (
    read_bundle,
    read_song_files,
    song_folder,
    write_bundle,
    write_song_files,
)

TEXT = "Rain on the roof\nall night\n\nand a dry street\n  by noon "


@pytest.fixture
def tables(spark):
    return {
        "artists": spark.createDataFrame(
            [(1, "Artist One", "one", 1000, DAY_1), (2, "Artist Two", "two", 2000, DAY_1)], ARTISTS
        ),
        "songs": spark.createDataFrame(
            [(1, 1, "Song A", "a", 5, DAY_1), (2, 2, "Song/B", "b", 6, DAY_1)], SONGS
        ),
        "lyrics": spark.createDataFrame([(1, 1, TEXT, DAY_1), (2, 2, "text", DAY_1)], LYRICS),
    }


@pytest.fixture
def store(spark, tmp_path):
    return CatalogueStore(spark, str(tmp_path / "store"))


def load(store, tables, batch="load"):
    staged = store.begin()
    for name, df in tables.items():
        store.stage(staged, name, df)
    return store.publish(staged, DAY_1, batch)


def counts(store):
    return {r["table_name"]: r["n_rows"] for r in store.counts().collect()}


def contents(store):
    return {n: sorted(map(tuple, df.collect())) for n, df in store.tables().items()}


def test_init_creates_empty_tables_once(store):
    assert counts(store) == dict.fromkeys(TABLES, 0)
    store.init(DAY_1)
    store.init(DAY_2)
    assert store.manifest().count() == 1 and store.current()["version"] == 0
    assert counts(store) == dict.fromkeys(TABLES, 0)
    assert store.table("songs").schema == SONGS


def test_round_trip_keeps_every_value(store, tables):
    load(store, tables)
    assert contents(store) == {n: sorted(map(tuple, df.collect())) for n, df in tables.items()}


def test_staged_rows_are_invisible_until_published(store, tables):
    load(store, tables)
    before = contents(store)
    staged = store.begin()
    store.stage(staged, "artists", tables["artists"].limit(0))
    store.stage_added(staged, "lyrics", tables["lyrics"])
    assert contents(store) == before
    store.publish(staged, DAY_2, "next")
    assert counts(store) == {"artists": 0, "songs": 2, "lyrics": 4}


def test_failed_stage_leaves_the_old_version(store, tables):
    load(store, tables)
    before = contents(store)
    staged = store.begin()
    broken = tables["songs"].withColumn("name", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception, match="boom"):
        store.stage(staged, "songs", broken)
    assert contents(store) == before


def test_second_writer_of_a_version_is_told(store, tables):
    load(store, tables)
    mine, theirs = store.begin(), store.begin()
    store.stage(theirs, "artists", tables["artists"].limit(1))
    store.stage(mine, "artists", tables["artists"].limit(0))
    store.publish(theirs, DAY_2, "theirs")
    with pytest.raises(CommitConflict):
        store.publish(mine, DAY_2, "mine")
    assert counts(store)["artists"] == 1


def test_backup_clear_restore(spark, store, tables, tmp_path):
    root = str(tmp_path / "backups")
    load(store, tables)
    before = contents(store)
    first = create_backup(store, root, DAY_1)
    store.publish(store.empty(), DAY_1, "clear")
    assert counts(store) == dict.fromkeys(TABLES, 0)
    second = create_backup(store, root, DAY_1)
    assert newest_backup(spark, root) == second and first.startswith("v=20240301-1-")
    restore_backup(store, root, first, DAY_2)
    assert contents(store) == before
    restore_newest(store, root, DAY_2)
    assert counts(store) == dict.fromkeys(TABLES, 0)
    assert backups(spark, root).count() == 2


def test_missing_backup_is_an_error(spark, store, tmp_path):
    assert restore_newest(store, str(tmp_path / "none"), DAY_1) is None
    with pytest.raises(FileNotFoundError):
        restore_backup(store, str(tmp_path / "none"), "v=20240301-1-x", DAY_1)


def released(tables):
    return tables["lyrics"].selectExpr("song_id", "content", "song_id as seq")


def files_of(folder):
    return {p.name: p.read_text(encoding="utf-8") for p in Path(folder).glob("*/*") if not p.name.startswith(".")}


def test_song_files_keep_the_text(spark, tables, tmp_path):
    rows = report.release_rows(released(tables), tables["songs"], tables["artists"])
    path = str(tmp_path / "texts")
    assert song_folder(spark, path) is None
    first = write_song_files(rows, path)
    assert song_folder(spark, path) == first
    assert set(files_of(first)) == {"Artist One - Song A.txt", "Artist Two - Song_B.txt"}
    body = files_of(first)["Artist One - Song A.txt"]
    assert body == "Song A\nArtist One\n\n" + TEXT
    assert body.split("\n\n", 1)[1] == TEXT
    second = write_song_files(rows.limit(1), path)
    assert song_folder(spark, path) == second and len(files_of(second)) == 1 and len(files_of(first)) == 2
    nothing = write_song_files(rows.limit(0), path)
    assert song_folder(spark, path) == nothing and files_of(nothing) == {}


def test_song_files_are_read_by_bucket(spark, tmp_path):
    ids = spark.range(9000)
    name = "CASE id WHEN 1 THEN '_a+b' WHEN 2 THEN '.c%20d' WHEN 3 THEN 'é ~#?' ELSE 'n' || id END"
    sources = {
        "documents": ids.selectExpr("id AS doc_id", "'text ' || id AS text"),
        "orders": ids.selectExpr(
            "id AS o_orderkey", "id AS o_custkey", "'1+x' AS o_orderpriority", "'F' AS o_orderstatus", "1.0D AS o_totalprice"
        ),
        "customer": ids.selectExpr("id AS c_custkey", f"{name} AS c_name", "1.0D AS c_acctbal"),
    }
    for table, rows in sources.items():
        rows.write.parquet(str(tmp_path / f"{table}.parquet"))
    found = queries.song_files(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() <= 256
    wanted = queries.release_rows(spark, str(tmp_path)).select("filename", "digest").collect()
    assert len(wanted) == 9000 and sorted(found.collect()) == sorted(wanted)


def test_song_files_are_read_by_byte(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(textfiles, "_BATCH_BYTES", 4)
    bodies = {f"{i}.txt": b"\r\n x \xc3\xa9\n" * i for i in range(5)} | {"raw.txt": b"\xff\x00"}
    rows = spark.createDataFrame(list(bodies.items()), "filename string, body binary")
    folder = write_song_files(rows.withColumn("body", F.col("body").cast("string")), str(tmp_path / "texts"))
    for path in (folder, f"file://{folder}/"):
        back = read_song_files(spark, path).withColumn("body", F.col("body").cast("binary")).collect()
        assert {r["filename"]: bytes(r["body"]) for r in back} == bodies and len(back) == len(bodies)
    nothing = write_song_files(rows.limit(0).withColumn("body", F.lit("")), str(tmp_path / "texts"))
    assert read_song_files(spark, nothing).count() == 0


def test_a_broken_export_leaves_the_release_before(spark, tables, tmp_path, monkeypatch):
    rows = report.release_rows(released(tables), tables["songs"], tables["artists"])
    path = str(tmp_path / "texts")
    first = write_song_files(rows, path)
    bad = rows.selectExpr("filename", "raise_error('boom') as body")
    with pytest.raises(Exception, match="boom"):
        write_song_files(bad, path)
    # The driver is lost when all files are written and before they are listed.
    monkeypatch.setattr(textfiles.F, "current_timestamp", lambda: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        write_song_files(rows.limit(1), path)
    assert song_folder(spark, path) == first and len(files_of(first)) == 2


def data_files(root):
    return {p for p in Path(root).rglob("*.parquet")}


def test_a_backup_copies_only_new_folders(spark, store, tables, tmp_path):
    root = str(tmp_path / "backups")
    load(store, tables)
    create_backup(store, root, DAY_1)
    there = data_files(root)
    again = create_backup(store, root, DAY_2)
    assert data_files(root) == there and newest_backup(spark, root) == again
    staged = store.begin()
    store.stage_added(staged, "songs", tables["songs"].limit(0))
    store.publish(staged, DAY_2, "more")
    create_backup(store, root, DAY_2)
    assert {p.parent.parent.name for p in data_files(root) - there} <= {"songs"}
    before = contents(store)
    store.publish(store.empty(), DAY_2, "clear")
    restore_newest(store, root, DAY_2)
    assert contents(store) == before


def test_versions_are_compared_by_row(spark, store, tables):
    load(store, tables)
    first = store.current()["version"]
    staged = store.begin()
    changed = tables["artists"].where("id <> 2").withColumn("views", F.lit(None).cast("bigint"))
    added = tables["artists"].where("id = 1").withColumn("id", F.lit(77).cast("bigint"))
    store.stage(staged, "artists", changed.unionByName(added))
    store.publish(staged, DAY_2, "more")
    found = {r["table_name"]: tuple(r)[1:] for r in version_diff(store, first, first + 1).collect()}
    n = tables["artists"].where("id <> 2").count()
    assert found == {"artists": (1, n, tables["artists"].where("id = 2").count()), "songs": (0, 0, 0), "lyrics": (0, 0, 0)}
    with pytest.raises(ValueError):
        version_diff(store, first, 99)


def test_same_file_name_keeps_the_last_song(spark, tables):
    songs = spark.createDataFrame(
        [(i, 1, name, f"s{i}", 0, DAY_1) for i, name in [(1, "x/y"), (2, "x_y"), (3, "z")]], SONGS
    )
    lyrics = spark.createDataFrame([(1, "a", 10), (2, "b", 5), (3, "c", 7)], "song_id bigint, content string, seq bigint")
    rows = report.release_rows(lyrics, songs, tables["artists"]).collect()
    assert {r["filename"]: r["body"][-1] for r in rows} == {
        "Artist One - x_y.txt": "a", "Artist One - z.txt": "c",
    }


def test_bundle_is_by_letter(spark, tables, tmp_path):
    rows = report.release_rows(released(tables), tables["songs"], tables["artists"])
    write_bundle(rows, str(tmp_path / "bundle"))
    assert [p.name for p in (tmp_path / "bundle").iterdir() if p.is_dir()] == ["bucket=A"]
    parts = list((tmp_path / "bundle" / "bucket=A").glob("*.json.gz"))
    assert parts
    back = {r["filename"]: r["body"] for r in read_bundle(spark, str(tmp_path / "bundle")).collect()}
    assert back == {r["filename"]: r["body"] for r in rows.collect()}


def test_release_notes(tables):
    stats = report.artist_stats(released(tables), tables["songs"], tables["artists"])
    assert report.release_notes(stats, "My Songs").first()["notes"] == (
        "# My Songs\n\nAdded 2 new songs from 2 artists.\n\n## Top Artists\n"
        "- **Artist Two** (1 songs)\n- **Artist One** (1 songs)\n"
    )


def test_top_five_ties_keep_first_seen_order(spark):
    rows = [(i, f"n{i}", 10 if i < 6 else None, 1, 100 - i) for i in range(8)]
    stats = spark.createDataFrame(rows, "artist_id bigint, name string, views bigint, songs bigint, first_seq bigint")
    assert [r["artist_id"] for r in report.top_artists(stats).collect()] == [5, 4, 3, 2, 1]
    notes = report.release_notes(stats, "T").first()["notes"]
    assert [line[4:6] for line in notes.splitlines() if line.startswith("- ")] == ["n5", "n4", "n3", "n2", "n1"]


def test_artists_sorted_and_grouped(spark):
    df = spark.createDataFrame(
        [(3, "ana", 0), (1, "Ana", 1), (2, "Ana", 2), (4, "Élis", 3), (5, "9x", 4), (6, "Pa", 5)],
        "id bigint, name string, seq bigint",
    )
    assert [r["id"] for r in report.by_name(df).collect()] == [5, 1, 2, 6, 3, 4]
    assert [r["id"] for r in report.by_name(df, "UNICODE").collect()] == [5, 3, 1, 2, 4, 6]
    grouped = [(r["bucket"], r["id"]) for r in report.grouped_by_letter(df).collect()]
    assert grouped == [("#", 5), ("A", 3), ("A", 1), ("A", 2), ("Other", 4), ("P", 6)]


def test_manifest_lists_folders_that_exist(store, tables):
    load(store, tables)
    for folders in store.current()["tables"].values():
        assert all((Path(store.root) / folder).is_dir() for folder in folders)
