"""The catalogue as versioned Parquet tables under one root.

    root/data/<table>/<token>/   immutable files, written once
    root/manifest/               one row per published version

A version lists the folders that make up each table. A writer stages its folders first
and adds the manifest row last, in one file that appears whole or not at all, so readers
see all tables of a version or none. New rows are added as one more folder; only tables
with changed rows are written anew. One writer at a time; if two publish the same version
number, the first one stays and the other is told.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cantiga.operators.report import row_changes, table_counts
from cantiga.operators.skew import lookup_join
from cantiga.schemas import TABLES

_MANIFEST = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("token", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        # The version whose rows this one goes on from; none after a clearing.
        T.StructField("origin", T.LongType()),
        T.StructField("committed_at", T.TimestampNTZType()),
        T.StructField("published_at", T.TimestampNTZType()),
        T.StructField("tables", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    ]
)

_BACKUPS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("stamp", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("version", T.LongType()),
        T.StructField("committed_at", T.TimestampNTZType()),
        # The folders under the backup root that make up each table.
        T.StructField("tables", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    ]
)


class CommitConflict(RuntimeError):
    """Another writer published the same version first."""


def read_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON rows under ``path``; none when nothing was ever written there."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def add_row(spark: SparkSession, path: str, schema: T.StructType, row: tuple) -> None:
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").json(path)


@dataclass
class Staged:
    """Folders written for a version that is not published yet, and the version before.

    ``origin`` is the version whose batches the new one goes on from: the one before, but
    for a restored or cleared catalogue.
    """

    base: Row | None
    origin: int | None = None
    tables: dict[str, list[str]] = field(default_factory=dict)


class CatalogueStore:
    """Artists, songs and lyrics in versions."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._manifest_path = f"{self.root}/manifest"

    def manifest(self) -> DataFrame:
        return read_rows(self.spark, self._manifest_path, _MANIFEST)

    def current(self) -> Row | None:
        """The newest version; of two with one number, the first published."""
        newest = self.manifest().orderBy(F.desc("version"), "published_at", "token")
        return newest.limit(1).first()

    def init(self, batch_ts: datetime) -> None:
        """Create the three tables, empty, unless there is a version already."""
        if self.current() is None:
            self.publish(self.empty(), batch_ts, "init")

    def begin(self) -> Staged:
        base = self.current()
        return Staged(base, base["version"] if base else None)

    def empty(self) -> Staged:
        """Empty tables, also the way to clear a catalogue."""
        staged = self.begin()
        staged.origin = None
        for name, schema in TABLES.items():
            self.stage(staged, name, self.spark.createDataFrame([], schema))
        return staged

    def version(self, number: int | None = None) -> Row | None:
        """The manifest row of a version, by default the newest; None when there is none."""
        if number is None:
            return self.current()
        found = self.manifest().where(F.col("version") == number)
        return found.orderBy("published_at", "token").limit(1).first()

    def table(self, name: str) -> DataFrame:
        return self.tables()[name]

    def tables(self, version: Row | None = None) -> dict[str, DataFrame]:
        """The three tables of a version, by default the newest."""
        row = version or self.current()
        return {name: self._read(name, row["tables"][name] if row else []) for name in TABLES}

    def counts(self) -> DataFrame:
        return table_counts(self.tables())

    def has_batch(self, batch_id: str) -> bool:
        """Whether the newest version goes back to a run of this batch.

        Versions follow each other but where the catalogue was restored or cleared; only
        those turns are read, to see which spans of versions the newest one descends from.
        """
        current = self.current()
        if current is None:
            return False
        rows = self.manifest()
        found = {r["version"] for r in rows.where(F.col("batch_id") == batch_id).select("version").collect()}
        if not found:
            return False
        follows = F.col("origin") == F.col("version") - 1
        turns = rows.where(~F.coalesce(follows, F.lit(False))).orderBy(F.desc("version"))
        top = current["version"]
        for turn in turns.select("version", "origin").collect():
            if turn["version"] > top:
                continue
            if any(turn["version"] <= v <= top for v in found):
                return True
            if turn["origin"] is None:
                return False
            top = turn["origin"]
        return any(v <= top for v in found)

    def _read(self, name: str, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], TABLES[name])
        paths = [f"{self.root}/{folder}" for folder in folders]
        return self.spark.read.schema(TABLES[name]).parquet(*paths)

    def _write(self, name: str, df: DataFrame) -> str:
        folder = f"data/{name}/{uuid.uuid4().hex}"
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name].fields]
        df.select(*columns).write.parquet(f"{self.root}/{folder}")
        return folder

    def stage(self, staged: Staged, name: str, df: DataFrame) -> DataFrame:
        """Write a table anew for the coming version and read it back."""
        staged.tables[name] = [self._write(name, df)]
        return self._read(name, staged.tables[name])

    def stage_added(self, staged: Staged, name: str, df: DataFrame) -> DataFrame:
        """Write rows to add to the table as it is now, and read back those rows."""
        before = list(staged.base["tables"][name]) if staged.base else []
        folder = self._write(name, df)
        staged.tables[name] = before + [folder]
        return self._read(name, [folder])

    def publish(self, staged: Staged, batch_ts: datetime, batch_id: str) -> int:
        """Make the staged folders the next version; other tables stay as they are.

        The check for another writer is a help, not a lock: one writer at a time.
        """
        base = staged.base
        tables = {name: list(base["tables"][name]) if base else [] for name in TABLES}
        tables.update(staged.tables)
        version = base["version"] + 1 if base else 0
        token = uuid.uuid4().hex
        now = datetime.now(UTC).replace(tzinfo=None)
        add_row(
            self.spark,
            self._manifest_path,
            _MANIFEST,
            (version, token, batch_id, staged.origin, batch_ts, now, tables),
        )
        mine = self.manifest().where(F.col("version") == version)
        first = mine.orderBy("published_at", "token").limit(1).first()
        if first["token"] != token:
            raise CommitConflict(f"version {version} was published by another writer")
        return version


def backups(spark: SparkSession, backup_root: str) -> DataFrame:
    return read_rows(spark, f"{backup_root.rstrip('/')}/manifest", _BACKUPS)


def create_backup(
    store: CatalogueStore, backup_root: str, batch_ts: datetime, version: Row | None = None
) -> str:
    """Back up a version's tables; gives the name of the backup, ``v=<date>-<seq>``.

    A backup is a list of folders. The folders of a catalogue never change, so only those
    that no listed backup has are copied, and the list is added when all are there.
    """
    spark, backup_root = store.spark, backup_root.rstrip("/")
    stamp = batch_ts.strftime("%Y%m%d")
    listed = backups(spark, backup_root)
    seq = (listed.where(F.col("stamp") == stamp).agg(F.max("seq")).first()[0] or 0) + 1
    name = f"v={stamp}-{seq}-{uuid.uuid4().hex[:8]}"
    row = version or store.current()
    tables = {table: list(row["tables"][table]) if row else [] for table in TABLES}
    held = listed.select(F.explode(F.map_values("tables")).alias("f")).select(F.explode("f").alias("folder"))
    wanted = [folder for folders in tables.values() for folder in folders]
    there = {r["folder"] for r in held.where(F.col("folder").isin(wanted)).distinct().collect()}
    for table, folders in tables.items():
        for folder in folders:
            if folder not in there:
                # A copy that was broken off is written again.
                copy = spark.read.schema(TABLES[table]).parquet(f"{store.root}/{folder}")
                copy.write.mode("overwrite").parquet(f"{backup_root}/{folder}")
    origin = row["version"] if row else None
    add_row(spark, f"{backup_root}/manifest", _BACKUPS, (name, stamp, seq, origin, batch_ts, tables))
    return name


def newest_backup(spark: SparkSession, backup_root: str) -> str | None:
    order = F.struct("committed_at", "stamp", "seq")
    return backups(spark, backup_root).agg(F.max_by("path", order)).first()[0]


def restore_backup(
    store: CatalogueStore, backup_root: str, name: str, batch_ts: datetime
) -> int:
    """Replace the catalogue by a backup. A backup that is not listed is an error.

    Batches that ran after the backup count as not run, and can run again.
    """
    spark, backup_root = store.spark, backup_root.rstrip("/")
    listed = backups(spark, backup_root).where(F.col("path") == name).first()
    if listed is None:
        raise FileNotFoundError(f"no backup {name} under {backup_root}")
    staged = store.begin()
    staged.origin = listed["version"]
    for table, schema in TABLES.items():
        paths = [f"{backup_root}/{folder}" for folder in listed["tables"][table]]
        copy = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
        store.stage(staged, table, copy)
    return store.publish(staged, batch_ts, f"restore {name}")


def restore_newest(store: CatalogueStore, backup_root: str, batch_ts: datetime) -> int | None:
    """Restore the newest backup, as before an incremental run; None when there is none."""
    name = newest_backup(store.spark, backup_root)
    return None if name is None else restore_backup(store, backup_root, name, batch_ts)


def version_diff(store: CatalogueStore, before: int, after: int) -> DataFrame:
    """``table_name, added, changed, removed``: rows that differ between two versions, by id.

    Folders that both versions list hold equal rows and are not read. A version that does
    not exist is an error.
    """
    rows = [store.version(number) for number in (before, after)]
    if None in rows:
        raise ValueError(f"no version {before if rows[0] is None else after}")
    found = None
    for name in TABLES:
        lists = [list(row["tables"][name]) for row in rows]
        own = [[folder for folder in a if folder not in b] for a, b in (lists, lists[::-1])]
        counted = row_changes(*(store._read(name, folders) for folders in own), "id")
        counted = counted.select(F.lit(name).alias("table_name"), "*")
        found = counted if found is None else found.unionByName(counted)
    return found


def lookup(table: DataFrame, keys: DataFrame, key: str, spread: str = "id") -> DataFrame:
    """Rows of a table for a table of keys; a missing key gives no row.

    ``spread`` is a unique column of the table, for keys with very many rows.
    """
    return lookup_join(table, keys.select(key).distinct(), key, "left_semi", spread)
