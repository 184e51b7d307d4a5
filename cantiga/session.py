"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "cantiga", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` adds or overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, or a temporary one for a local test session.

    On a cluster the folder must be named: executors cannot read the driver's disk.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="cantiga-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def materialize(
    df: DataFrame, name: str, partition_by: list[str] | None = None, compression: str | None = None
) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later steps start from files, so a lost executor costs one task and not the
    whole lineage, and Catalyst knows the true size when it chooses a join. Tables of
    much text take less disk with a ``compression`` stronger than the session's.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, partitionBy=partition_by, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """A scan of a few small files over all cores, before work that is heavy per row.

    A scan that has a partition per core already, as large tables have, stays as it is.
    Only for tables as read: counting the partitions of a join would run it. ``key`` is
    a unique column; without one, rows are dealt out in turn.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key) if key else df.repartition(cores)
