"""Constraint checks. What breaks a rule goes to a quarantine table, not to a crash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantiga.schemas import MAX_NAME_CHARS

# Required columns, length-limited columns and natural keys per table.
REQUIRED = {
    "artists": ["name", "slug"],
    "songs": ["artist_id", "name", "slug"],
    "lyrics": ["song_id", "content"],
}
LIMITED = {"artists": ["name", "slug"], "songs": ["name", "slug"], "lyrics": []}
NATURAL_KEY = {"artists": ["slug"], "songs": ["artist_id", "slug"], "lyrics": ["song_id"]}


def key_text(keys: list[str]) -> Column:
    return F.concat_ws("/", *[F.col(k).cast("string") for k in keys])


def _row_rules(table: str) -> list[tuple[Column, str, str]]:
    missing = [(F.col(c).isNull(), "not_null", c) for c in REQUIRED[table]]
    long = [(F.char_length(c) > MAX_NAME_CHARS, "max_length", c) for c in LIMITED[table]]
    return missing + long


def is_valid(table: str) -> Column:
    """Whether a row keeps the rules that need no other row."""
    bad = F.lit(False)
    for condition, _, _ in _row_rules(table):
        bad = bad | F.coalesce(condition, F.lit(False))
    return ~bad


def row_violations(df: DataFrame, table: str) -> DataFrame:
    """Missing and too long values, one row each, in one pass."""
    found = [
        F.when(condition, F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("detail")))
        for condition, rule, column in _row_rules(table)
    ]
    return (
        df.select(
            F.lit(table).alias("source"),
            key_text(NATURAL_KEY[table]).alias("key"),
            F.explode(F.array_compact(F.array(*found))).alias("_v"),
        )
        .select("source", "key", "_v.rule", "_v.detail")
    )


def duplicate_violations(df: DataFrame, table: str) -> DataFrame:
    """Natural keys held by more than one row, counted before the shuffle."""
    keys = NATURAL_KEY[table]
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > 1)
        .select(
            F.lit(table).alias("source"),
            key_text(keys).alias("key"),
            F.lit("unique").alias("rule"),
            F.col("_n").cast("string").alias("detail"),
        )
    )


def orphan_violations(
    children: DataFrame, table: str, column: str, parents: DataFrame
) -> DataFrame:
    """References to a missing parent, one row per missing id with its row count.

    Children are counted per reference first, so a parent with many rows is one row in
    the join.
    """
    return (
        children.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("_n"))
        .join(parents.select(F.col("id").alias(column)), column, "left_anti")
        .select(
            F.lit(table).alias("source"),
            F.col(column).cast("string").alias("key"),
            F.lit("reference").alias("rule"),
            F.col("_n").cast("string").alias("detail"),
        )
    )


def constraint_report(artists: DataFrame, songs: DataFrame, lyrics: DataFrame) -> DataFrame:
    """Every broken rule of the three tables: ``source, key, rule, detail``."""
    tables = {"artists": artists, "songs": songs, "lyrics": lyrics}
    report = orphan_violations(songs, "songs", "artist_id", artists).unionByName(
        orphan_violations(lyrics, "lyrics", "song_id", songs)
    )
    for name, df in tables.items():
        report = report.unionByName(row_violations(df, name))
        report = report.unionByName(duplicate_violations(df, name))
    return report


def crawl_violations(rows: DataFrame, source: str, key: Column, bad: Column, detail: Column, rule: str) -> DataFrame:
    """Quarantine rows for crawled values that could not be used."""
    return rows.where(bad).select(
        F.lit(source).alias("source"),
        key.cast("string").alias("key"),
        F.lit(rule).alias("rule"),
        detail.cast("string").alias("detail"),
    )
