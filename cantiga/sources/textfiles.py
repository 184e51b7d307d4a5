"""Release files: one text file per song, and compressed bundles by letter.

    path/<token>/<bucket>/<file name>    one folder per writing, 256 buckets by hash
    path/manifest/                       one row per complete writing

A writing goes to a folder of its own and is listed when all tasks are done. Nothing is moved
or deleted: until then, and if it breaks off, the one before is the release.

Reading tasks take whole buckets and list these folders themselves, so there is neither a list
of all files in the driver nor a task for every few files.
"""

from __future__ import annotations

import sys
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from cantiga.functions.names import file_name

_WRITINGS = "token string, written_at timestamp"
_BUCKETS = 256
# A reading task hands its texts on when it has this many bytes of them.
_BATCH_BYTES = 8_000_000


def _open(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _bucket(number: int) -> str:
    return f"{number % _BUCKETS:02x}"


class SongTextWriter(DataSourceArrowWriter):
    """Tasks write batches of files into the buckets of a new folder.

    File names are unique in a release, so a task that runs again writes the same files
    over its own.
    """

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        filesystem, folder = _open(self.path)
        made: set[str] = set()
        for batch in iterator:
            names, bodies = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("filename", "body"))
            for name, body in zip(names, bodies, strict=True):
                bucket = f"{folder}/{_bucket(zlib.crc32(name))}"
                if bucket not in made:
                    filesystem.create_dir(bucket, recursive=True)
                    made.add(bucket)
                with filesystem.open_output_stream(f"{bucket}/{name.decode()}") as out:
                    out.write(body)
        return WriterCommitMessage()

    def commit(self, messages) -> None:
        filesystem, folder = _open(self.path)
        filesystem.create_dir(folder, recursive=True)

    def abort(self, messages) -> None:
        from pyarrow import fs

        filesystem, folder = _open(self.path)
        if filesystem.get_file_info(folder).type != fs.FileType.NotFound:
            filesystem.delete_dir(folder)


class SongTextSource(DataSource):
    """``df.write.format("songtext")`` for columns ``filename`` and ``body``, into a new folder."""

    @classmethod
    def name(cls) -> str:
        return "songtext"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return SongTextWriter(self.options["path"])


def write_song_files(rows: DataFrame, path: str) -> str:
    """One UTF-8 text file per row, in a folder all executors can write to; gives that folder.

    Only here are names cut to what a file system takes; rows and bundles hold them whole.
    """
    # Executors get the writer itself and need no copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark, token = rows.sparkSession, uuid.uuid4().hex
    spark.dataSource.register(SongTextSource)
    folder = f"{path.rstrip('/')}/{token}"
    files = rows.select(file_name(F.col("filename")).alias("filename"), "body")
    files.write.format("songtext").mode("append").save(folder)
    listed = spark.range(1).select(F.lit(token).alias("token"), F.current_timestamp().alias("written_at"))
    listed.coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/manifest")
    return folder


def song_folder(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest complete writing; None when there is none."""
    from cantiga.sources.store import read_rows

    listed = read_rows(spark, f"{path.rstrip('/')}/manifest", _WRITINGS)
    token = listed.agg(F.max_by("token", F.struct("written_at", "token"))).first()[0]
    return None if token is None else f"{path.rstrip('/')}/{token}"


def read_song_files(spark: SparkSession, folder: str) -> DataFrame:
    """The files of one writing, under the names they have on disk: ``filename, body``."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    def read(buckets: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        filesystem, root = _open(folder.rstrip("/"))
        names, bodies, size = [], [], 0
        for number in (n for batch in buckets for n in batch.column(0).to_pylist()):
            bucket = fs.FileSelector(f"{root}/{_bucket(number)}", allow_not_found=True)
            for found in filesystem.get_file_info(bucket):
                with filesystem.open_input_stream(found.path, compression=None) as file:
                    bodies.append(file.read())
                names.append(found.base_name)
                size += len(bodies[-1])
                if size >= _BATCH_BYTES:
                    yield _files(names, bodies)
                    names, bodies, size = [], [], 0
        yield _files(names, bodies)

    # Several tasks per core, for small releases fewer than there are buckets.
    tasks = min(_BUCKETS, 8 * spark.sparkContext.defaultParallelism)
    buckets = spark.range(0, _BUCKETS, 1, tasks)
    files = buckets.mapInArrow(read, "filename string, body binary")
    return files.select("filename", F.col("body").cast("string").alias("body"))


def _files(names: list[str], bodies: list[bytes]) -> pa.RecordBatch:
    columns = {"filename": pa.array(names, pa.string()), "body": pa.array(bodies, pa.binary())}
    return pa.RecordBatch.from_pydict(columns)


def write_bundle(rows: DataFrame, path: str, max_records: int = 1_000_000) -> None:
    """All texts as compressed JSON lines, one folder per letter bucket.

    Tasks write their own rows of each bucket without a shuffle, so a bucket with most
    of the songs is still written by all of them.
    """
    (
        rows.select("bucket", "filename", "body")
        .write.mode("overwrite")
        .partitionBy("bucket")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", max_records)
        .json(path)
    )


def read_bundle(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("filename string, body string, bucket string").json(path)
