"""Incremental runs over page files as they arrive.

What a page holds may need another page: a song belongs to the artist that lists it, and
either may come first. After each run, what is still unmatched is kept: links to artists that
are not stored, list entries without a stored song, song pages that no list names, each in
its latest copy. The next run reads that and its own rows. What was matched is in the
catalogue, so the rows a run reads do not grow with the batches before it.

The parsed rows of every arrival are kept too, without HTML, for a catalogue that is
restored: a run then goes on from what waited after the newest batch that the restored
version goes back to, and reads the arrivals since.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cantiga.plans.crawl import Crawler, page_of
from cantiga.plans.runs import Detector, RunResult, run_incremental
from cantiga.schemas import PAGES
from cantiga.sources.rules import LyricRules
from cantiga.sources.store import CatalogueStore, add_row, read_rows

_ARRIVALS = T.StructType(
    [
        T.StructField("arrival", T.LongType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("folder", T.StringType()),
    ]
)


def keep_arrival(store: CatalogueStore, batch_id: str, pages: DataFrame, crawler: Crawler) -> int:
    """Write the parsed rows of a batch beside the catalogue; gives the number of the arrival.

    A batch is listed when its folder is complete, once: one that is played again keeps
    its place among the others.
    """
    spark, root = store.spark, f"{store.root}/arrivals"
    listed = read_rows(spark, f"{root}/manifest", _ARRIVALS)
    known = listed.where(F.col("batch_id") == batch_id).agg(F.min("arrival")).first()[0]
    if known is not None:
        return known
    arrival = (listed.agg(F.max("arrival")).first()[0] or 0) + 1
    folder = f"data/{uuid.uuid4().hex}"
    crawler.parse(pages).withColumn("page", page_of(arrival)).write.parquet(f"{root}/{folder}")
    add_row(spark, f"{root}/manifest", _ARRIVALS, (arrival, batch_id, folder))
    return arrival


def rows_to_read(store: CatalogueStore, arrival: int) -> DataFrame:
    """What waited after the newest run that still counts, and the arrivals since, up to ``arrival``."""
    spark, root = store.spark, f"{store.root}/arrivals"
    kept = read_rows(spark, f"{root}/waiting", _ARRIVALS).where(F.col("arrival") < arrival)
    since, folders = 0, []
    for row in kept.orderBy(F.desc("arrival")).collect():
        if store.has_batch(row["batch_id"]):
            since, folders = row["arrival"], [row["folder"]]
            break
    listed = read_rows(spark, f"{root}/manifest", _ARRIVALS).where(F.col("arrival").between(since + 1, arrival))
    folders += [r["folder"] for r in listed.orderBy("arrival").select("folder").collect()]
    return spark.read.parquet(*(f"{root}/{folder}" for folder in folders))


def keep_waiting(store: CatalogueStore, arrival: int, batch_id: str, rows: DataFrame) -> None:
    """Write what waits after a run; it is listed when it is complete."""
    folder = f"data/{uuid.uuid4().hex}"
    rows.write.parquet(f"{store.root}/arrivals/{folder}")
    add_row(store.spark, f"{store.root}/arrivals/waiting", _ARRIVALS, (arrival, batch_id, folder))


def run_arrivals(
    spark: SparkSession,
    pages_dir: str,
    checkpoint: str,
    store: CatalogueStore,
    crawler: Crawler,
    detector: Detector,
    batch_ts: datetime,
    rules: LyricRules | None = None,
    on_result: Callable[[RunResult], None] | None = None,
    max_files_per_batch: int | None = None,
) -> None:
    """Feed every page file not seen before to an incremental run, then stop.

    The stream's checkpoint remembers the files. A batch that is played again after a
    failure finds its id in the catalogue's manifest and does nothing. How the files are
    dealt to batches changes when a row is added, not whether it is. Runs before the first
    artist list publish nothing, and their pages are kept for later.
    """

    def one_batch(pages: DataFrame, number: int) -> None:
        # The stream's own id, kept in its checkpoint: a new checkpoint is a new stream.
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch_id = f"{stream}/{number}"
        if store.has_batch(batch_id):
            return
        arrival = keep_arrival(store, batch_id, pages, crawler)
        parsed = rows_to_read(store, arrival)
        crawl = crawler.assemble(parsed, store.table("artists"))
        result = run_incremental(store, crawl, detector, batch_id, batch_ts, rules, partial=True)
        if result is None:
            return
        tables = store.tables(store.version(result.version))
        keep_waiting(store, arrival, batch_id, crawler.waiting(parsed, tables["artists"], tables["songs"]))
        if on_result is not None:
            on_result(result)

    reader = spark.readStream.schema(PAGES)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    query = (
        reader.parquet(pages_dir)
        .writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
