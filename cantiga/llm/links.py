"""Links between the members of buckets, and the components that links form.

Both near-duplicate operators propose candidates as buckets of ids. A bucket may hold a
third of all ids, so buckets above ``CHUNK`` members are cut into chunks, and every pair of
chunks becomes a group of its own. A group of ``linked`` never returns its pairs: it returns, per id, how
much it is linked to and one member of its local component, which keeps every connection.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantiga.session import materialize

# Members of a bucket that are compared in one piece, and rows of a group of small buckets.
CHUNK = 512
GROUP_ROWS = 8192
# Buckets whose sizes are broadcast: two numbers each, 16 MB at the most.
BROADCAST_BUCKETS = 1_000_000
# Pairs that are verified at a time, which bounds the memory of a comparison.
PAIRS_AT_ONCE = 1 << 16

Verify = Callable[[np.ndarray, np.ndarray], np.ndarray]


def candidate_groups(
    members: DataFrame, chunk: int = CHUNK, group_rows: int = GROUP_ROWS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Rows ``group, bucket, chunk, wide, id`` of every bucket with two members or more.

    ``members`` has ``bucket, id`` (both bigint), each pair once, and the columns to
    ``carry``; it is read twice. Small buckets share groups of about ``group_rows`` rows.
    In a large one, a member goes to one group for each chunk, its own included, where
    ``wide`` tells its chunks apart.
    """
    sizes = members.groupBy("bucket").agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    sizes = materialize(sizes, "bucket-sizes")
    buckets, rows = sizes.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0))).first()
    if buckets <= BROADCAST_BUCKETS:
        sizes = F.broadcast(sizes)
    groups = max(1, -(-rows // group_rows))
    chunks = F.ceil(F.col("_n") / F.lit(chunk)).cast("int")
    own = F.pmod(F.xxhash64("id", F.lit(7)), F.col("_chunks")).cast("int")
    dealt = members.join(sizes, "bucket").withColumn("_chunks", chunks).withColumn("chunk", own)
    cells = F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))
    dealt = dealt.select("bucket", "id", *carry, "chunk", "_chunks", cells.alias("_other"))
    low, high = F.least("chunk", "_other"), F.greatest("chunk", "_other")
    wide = F.col("_chunks") > 1
    group = F.when(wide, F.concat_ws(":", "bucket", low, high)).otherwise(
        F.pmod(F.xxhash64("bucket"), F.lit(groups)).cast("string")
    )
    cross = wide & (low != high)
    return dealt.select(group.alias("group"), "bucket", "chunk", cross.alias("wide"), "id", *carry)


def _pairs(bucket: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of equal buckets in a sorted array, a distance at a time."""
    start = np.arange(len(bucket) - 1)
    step = 1
    while len(start):
        start = start[start + step < len(bucket)]
        start = start[bucket[start] == bucket[start + step]]
        for at in range(0, len(start), PAIRS_AT_ONCE):
            piece = start[at : at + PAIRS_AT_ONCE]
            yield piece, piece + step
        step += 1


def _cross(chunk: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs between the two chunks of a group of a large bucket."""
    left, right = (np.flatnonzero(chunk == c) for c in (chunk.min(), chunk.max()))
    if not len(left) or chunk.min() == chunk.max():
        return
    rows = max(1, PAIRS_AT_ONCE // len(right))
    for at in range(0, len(left), rows):
        piece = left[at : at + rows]
        yield np.repeat(piece, len(right)), np.tile(right, len(piece))


def local_roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``count`` nodes the smallest node of its component."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def linked(groups: DataFrame, prepare: Callable[[pd.DataFrame], Verify]) -> DataFrame:
    """``id, root, links`` of every id with a verified partner in its group.

    ``groups`` holds ``group, bucket, chunk, wide, id`` and what ``prepare`` needs; a
    column ``n`` says how many rows an id stands for. ``prepare`` gets a group sorted by
    bucket; what it returns gets two index arrays and says which pairs link and count here.
    """

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["bucket", "id"], ignore_index=True)
        ids, node = np.unique(rows["id"].to_numpy(), return_inverse=True)
        weight = rows["n"].to_numpy() if "n" in rows else np.ones(len(rows), dtype=np.int64)
        links = np.zeros(len(ids), dtype=np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        wide = bool(rows["wide"].iloc[0])
        verify = prepare(rows)
        pairs = _cross(rows["chunk"].to_numpy()) if wide else _pairs(rows["bucket"].to_numpy())
        for left, right in pairs:
            keep = verify(left, right)
            left, right = left[keep], right[keep]
            if len(left):
                np.add.at(links, node[left], weight[right])
                np.add.at(links, node[right], weight[left])
                found.append((node[left], node[right]))
        if not found:
            return pd.DataFrame({"id": ids[:0], "root": ids[:0], "links": links[:0]})
        root = local_roots(len(ids), *(np.concatenate(x) for x in zip(*found, strict=True)))
        some = links > 0
        return pd.DataFrame({"id": ids[some], "root": ids[root[some]], "links": links[some]})

    schema = "id bigint, root bigint, links bigint"
    return groups.groupBy("group").applyInPandas(compare, schema)


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable, for every node of ``edges(a, b)``.

    Alternates between linking larger neighbours and smaller neighbours to the smallest
    one, until only stars are left: about log(n) rounds. A hub costs no more than another
    node, as minima are folded before the shuffle and joins of one row per node can be
    split. Each round is written, so that a lost executor repeats tasks of one round.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    links = edges.where("a <> b").select(high.alias("u"), low.alias("v")).distinct()
    links = materialize(links, "links")
    mark = _mark(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        links = materialize(links, "small-star")
        before, mark = mark, _mark(links)
        if mark == before:
            break
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.unionByName(roots)


def _mark(links: DataFrame) -> tuple:
    """Count and order-free checksum of the links, to see that a round changed nothing."""
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), total).first())
