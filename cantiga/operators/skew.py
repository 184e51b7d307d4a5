"""Joins that hold when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantiga.session import materialize

# A lookup side of at most this many rows is broadcast. Lookup rows are an id and a
# few names of at most 255 characters, so this stays near 100 MB at the very worst.
BROADCAST_ROWS = 50_000

# A key with more rows than this is split, into as many parts as have this many rows each.
TARGET_ROWS = 1_000_000
# Keys that the sketch gives back and keys that it keeps track of. A count is too high by at
# most the rows over three quarters of what is kept, whatever the keys are.
HEAVY_KEYS, TRACKED_KEYS = 1000, 16_384


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` fits a broadcast. A table in Parquet answers from its footers."""
    return df.count() <= limit


def heavy_keys(df: DataFrame, key: str, target: int = TARGET_ROWS) -> DataFrame:
    """``key, _salts``: the keys that have more than ``target`` rows, and in how many parts to split each.

    One pass with a sketch of frequent items that tasks make and merge: a few numbers per task
    move, however many keys there are. At most ``HEAVY_KEYS`` keys come out, so on a table
    with more rows than as many targets, the target is raised to that share of the rows.
    """
    top = F.expr(f"approx_top_k(`{key}`, {HEAVY_KEYS}, {TRACKED_KEYS})").alias("_top")
    sketch = df.where(F.col(key).isNotNull()).agg(top, F.count("*").alias("_rows"))
    part = F.greatest(F.lit(float(target)), F.col("_rows") / HEAVY_KEYS)
    found = sketch.select(F.explode("_top").alias("_heavy"), part.alias("_part"))
    heavy = found.where(F.col("_heavy.count") > F.col("_part"))
    salts = F.ceil(F.col("_heavy.count") / F.col("_part")).cast("int")
    return materialize(heavy.select(F.col("_heavy.item").alias(key), salts.alias("_salts")), "heavy-keys")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    spread: str,
    target: int = TARGET_ROWS,
) -> DataFrame:
    """Equi-join whose heavy left keys are spread over tasks of about ``target`` rows each.

    ``spread`` is a left column that varies within a key. Right rows of a heavy key are
    repeated once per part, all others stay single, so the result is the plain join's.
    ``how`` may be ``inner``, ``left``, ``left_semi`` or ``left_anti``. ``left`` is read twice.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join cannot do a {how} join")
    # At most HEAVY_KEYS rows.
    heavy = F.broadcast(heavy_keys(left, key, target))
    zero = F.lit(0).cast("bigint")
    own = F.when(F.col("_salts").isNull(), zero).otherwise(F.pmod(F.xxhash64(spread), F.col("_salts")))
    every = F.sequence(zero, F.coalesce(F.col("_salts"), F.lit(1)).cast("bigint") - 1)
    salted = left.join(heavy, key, "left").withColumn("_salt", own).drop("_salts")
    copies = right.join(heavy, key, "left").withColumn("_salt", F.explode(every)).drop("_salts")
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    spread: str,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join rows to a lookup table: broadcast when it is small, salted otherwise."""
    if small(right, limit):
        return left.join(F.broadcast(right), key, how)
    return salted_join(left, right, key, how, spread)
