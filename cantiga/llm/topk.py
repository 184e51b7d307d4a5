"""Exact top-k inner products by aggregating sorted lists without random access.

Each component of the candidate vectors is a sorted list. A query reads a list from its
high end where its own component is positive and from its low end where it is negative.
With every list read to the same depth, a candidate's score has

- an upper bound: a value not read yet is no better than the last one read, and
- a lower bound: it is no worse than the last one of the list.

Reading goes deeper until the k-th lower bound, or the k-th score found earlier, leaves few
candidates whose upper bound still reaches it. Those are scored in full; all others cannot
be among the k best. The bounds of a block of queries and a block of candidates are two
matrix products: replacing values beyond the depth by the last value read, or by the worst.

Queries and candidates are cut into blocks, and each pair of blocks is one group. A query
returns at most k rows from a group, so the rows to merge do not grow with copies.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cantiga.llm.vectors import _floats
from cantiga.session import materialize

SCALE = 64
# Rows of a group, and of the pieces it works on at a time.
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 8192
QUERY_PIECE, CANDIDATE_PIECE = 256, 1024
# Shares of the lists that are read before the bounds are looked at again.
DEPTHS = (0.5, 0.75)
_EXACT = 2.0**53


def _quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id, vec``: floor(scale * x) of each usable vector, as the bytes of doubles."""

    def read(batches):
        for batch in batches:
            packed = []
            for x in _floats(batch.column(1)):
                ok = x is not None and len(x) and np.isfinite(x).all()
                packed.append((np.floor(scale * x) + 0.0).tobytes() if ok else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["id", "vec"])

    plain = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v")
    )
    read_rows = plain.where(F.col("id").isNotNull()).mapInArrow(read, "id bigint, vec binary")
    return read_rows.where(F.col("vec").isNotNull()).dropDuplicates(["id", "vec"])


class _Best:
    """The k best candidates so far of each query of a piece, ties to smaller ids."""

    def __init__(self, queries: int, k: int) -> None:
        self.k, self.queries = k, queries
        self.query = np.empty(0, dtype=np.int64)
        self.id = np.empty(0, dtype=np.int64)
        self.score = np.empty(0)

    def threshold(self) -> np.ndarray:
        """The k-th score of each query; minus infinity while there are fewer."""
        out = np.full(self.queries, -np.inf)
        start = np.searchsorted(self.query, np.arange(self.queries))
        last = start + self.k - 1
        full = last < len(self.query)
        full[full] = self.query[last[full]] == np.flatnonzero(full)
        out[full] = self.score[last[full]].astype(float)
        return out

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        query, ids = np.append(self.query, query), np.append(self.id, ids)
        score = np.append(self.score, score)
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        keep = place < self.k
        self.query, self.id, self.score = query[keep], ids[keep], score[keep]


def _bounds(queries: np.ndarray, block: np.ndarray, lists: np.ndarray, depth: float):
    """Upper and lower bounds (queries x candidates) with each list read to ``depth``."""
    rows = len(block)
    at = min(rows - 1, int(rows * depth))
    high, low = lists[rows - 1 - at], lists[at]
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    upper = up @ np.maximum(block, high).T + down @ np.minimum(block, low).T
    lower = up @ np.where(block >= high, block, lists[0]).T
    lower += down @ np.where(block <= low, block, lists[-1]).T
    return upper, lower


def _scores(left: np.ndarray, right: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return np.einsum("ij,ij->i", left, right)
    ends = -(2**63), 2**63 - 1
    sums = (sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for x, y in zip(left, right, strict=True))
    return np.array([min(max(s, ends[0]), ends[1]) for s in sums], dtype=object)


def search_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> _Best:
    """The ``k`` best of ``vectors`` for each query, without rows of the query's own id."""
    best = _Best(len(queries), k)
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0))
    exact = most * queries.shape[1] < _EXACT
    for at in range(0, len(vectors), CANDIDATE_PIECE):
        block, own = vectors[at : at + CANDIDATE_PIECE], ids[at : at + CANDIDATE_PIECE]
        if exact:
            possible = np.zeros((len(queries), len(block)), dtype=bool)
            lists = np.sort(block, axis=0)
            self_row = query_ids[:, None] == own[None, :]
            known = best.threshold()
            open_ = np.arange(len(queries))
            for depth in DEPTHS:
                upper, lower = _bounds(queries[open_], block, lists, depth)
                lower[self_row[open_]] = -np.inf
                reach = known[open_]
                if len(block) > k:
                    reach = np.maximum(reach, np.partition(lower, len(block) - k, axis=1)[:, len(block) - k])
                possible[open_] = (upper >= reach[:, None]) & ~self_row[open_]
                open_ = open_[possible[open_].sum(axis=1) > 2 * k]
                if not len(open_):
                    break
        else:
            possible = query_ids[:, None] != own[None, :]
        query, row = np.nonzero(possible)
        for i in range(0, len(query), 1 << 15):
            q, r = query[i : i + (1 << 15)], row[i : i + (1 << 15)]
            best.add(q, own[r], _scores(queries[q], block[r], exact))
    return best


def exact_top_k(
    vectors: DataFrame,
    is_query,
    k: int = 20,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest inner products of each query.

    Components become floor(scale * x). Queries are the rows for which the column
    ``is_query`` (on ``id``) holds; candidates are all rows of other ids. Ties go to the
    smaller id. Vectors that are null, empty, or hold null or non-finite components, and
    rows without an id, take no part; vectors of other lengths are not compared. Rows
    repeated with their id count once. Scores beyond a bigint become its nearest value.
    """
    rows = materialize(_quantised(vectors, id_col, vector_col, scale), "quantised")
    rows = rows.withColumn("dim", F.length("vec"))
    sizes = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    query_blocks = max(1, -(-sizes["q"] // query_block))
    candidate_blocks = max(1, -(-sizes["n"] // candidate_block))

    def block(count: int, seed: int):
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(count)).cast("int")

    def every(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    asked = rows.where(is_query).select(
        "dim", block(query_blocks, 1).alias("qb"), every(candidate_blocks).alias("cb"), F.lit(True).alias("ask"), "id", "vec"
    )
    held = rows.select(
        "dim", every(query_blocks).alias("qb"), block(candidate_blocks, 2).alias("cb"), F.lit(False).alias("ask"), "id", "vec"
    )

    def search(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", ignore_index=True)
        matrix = np.frombuffer(b"".join(group["vec"]), dtype=np.float64).reshape(len(group), -1)
        ask, ids = group["ask"].to_numpy(), group["id"].to_numpy()
        vectors_, vector_ids = matrix[~ask], ids[~ask]
        parts = []
        asked_rows = np.flatnonzero(ask)
        for at in range(0, len(asked_rows) if len(vectors_) else 0, QUERY_PIECE):
            piece = asked_rows[at : at + QUERY_PIECE]
            best = search_block(ids[piece], matrix[piece], vector_ids, vectors_, k)
            key = pd.util.hash_array(group["vec"].iloc[piece].to_numpy(object)).astype(np.int64)
            parts.append(
                pd.DataFrame(
                    {
                        "query_id": ids[piece][best.query],
                        "key": key[best.query],
                        "vec_id": best.id,
                        "score": best.score.astype(np.int64),
                    }
                )
            )
        empty = pd.DataFrame({c: np.empty(0, dtype=np.int64) for c in ("query_id", "key", "vec_id", "score")})
        return pd.concat(parts) if parts else empty

    found = asked.unionByName(held).groupBy("dim", "qb", "cb").applyInPandas(
        search, "query_id bigint, key bigint, vec_id bigint, score bigint"
    )
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
