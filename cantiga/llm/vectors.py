"""Near-duplicate vectors by p-stable hashing in several tables.

A table cuts each of ``k`` random projections of the normalised vector into steps of
``WIDTH``; vectors with the same label and the same ``k`` steps share a bucket. Pairs of a
bucket are then compared by their exact cosine.

With d the distance of two unit vectors, one projection agrees with probability
p(d) = 1 - 2 Phi(-w/d) - 2d / (sqrt(2 pi) w) * (1 - exp(-w^2 / 2d^2)). ``k`` is chosen from
the number of vectors so that an unrelated vector (d = sqrt 2) is expected in a bucket at
most once, and the number of tables so that a pair exactly at the threshold is missed with
probability ``miss`` at most.

Equal vectors are one class with a count, so copies are never paired with each other.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantiga.llm.links import candidate_groups, components, linked
from cantiga.session import materialize

WIDTH = 2.0
MISS = 1e-4
SEED = 20_240_501


def agreement(distance: float, width: float = WIDTH) -> float:
    """Probability that one quantised projection of two vectors agrees."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_sizes(rows: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """Projections per table and number of tables for ``rows`` vectors."""
    near, far = agreement(math.sqrt(2 - 2 * threshold)), agreement(math.sqrt(2))
    k = max(4, math.ceil(math.log(max(2, rows)) / -math.log(far)))
    return k, math.ceil(math.log(miss) / math.log(1 - near**k))


def _floats(column: pa.ListArray) -> list[np.ndarray | None]:
    """Each list as doubles; None where it is null or holds a null."""
    flat = column.flatten()
    ends = np.cumsum(np.where(column.is_null(), 0, column.value_lengths().fill_null(0)))
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
    nulls = np.asarray(flat.is_null())
    out: list[np.ndarray | None] = []
    start = 0
    for end, missing in zip(ends, np.asarray(column.is_null()), strict=True):
        bad = missing or nulls[start:end].any()
        out.append(None if bad else values[start:end])
        start = end
    return out


def _usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``id, label, vec``: the doubles as bytes, null where the vector can't link."""

    def read(batches):
        for batch in batches:
            packed = []
            for x in _floats(batch.column(2)):
                ok = x is not None and len(x) and np.isfinite(x).all() and x.any()
                packed.append((x + 0.0).tobytes() if ok else None)  # + 0.0: no negative zero
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary())],
                ["id", "label", "vec"],
            )

    plain = vectors.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("v"),
    )
    return plain.mapInArrow(read, "id bigint, label string, vec binary")


def _unit(vec: np.ndarray) -> np.ndarray:
    vec = vec / np.abs(vec).max(axis=-1, keepdims=True)
    return vec / np.sqrt((vec * vec).sum(axis=-1, keepdims=True))


def _buckets(classes: DataFrame, k: int, tables: int) -> DataFrame:
    """``buckets``: per table a hash of the table, the label and the ``k`` steps."""

    def steps(batches):
        drawn: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for rows in batches:
            out = np.zeros((len(rows), tables), dtype=np.int64)
            sizes = rows["vec"].map(len).to_numpy() // 8
            for dim in np.unique(sizes):
                if dim not in drawn:
                    rng = np.random.default_rng([SEED, int(dim)])
                    drawn[dim] = rng.normal(size=(dim, k * tables)), rng.uniform(0, WIDTH, k * tables)
                at = np.flatnonzero(sizes == dim)
                vec = np.frombuffer(b"".join(rows["vec"].iloc[at]), dtype=np.float64).reshape(len(at), dim)
                cells = np.floor((_unit(vec) @ drawn[dim][0] + drawn[dim][1]) / WIDTH).astype(np.int64)
                label = pd.util.hash_array(rows["label"].iloc[at].to_numpy(object)).astype(np.uint64)
                for t in range(tables):
                    code = label * np.uint64(1_000_003) + np.uint64(t * 4_099 + dim)
                    for c in cells[:, t * k : (t + 1) * k].T:
                        code = _mix(code ^ c.astype(np.uint64))
                    out[at, t] = code.astype(np.int64)
            yield rows.assign(buckets=list(out))

    return classes.mapInPandas(steps, "id bigint, n bigint, label string, vec binary, buckets array<bigint>")


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (multiply and shift, wrapping)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def near_duplicate_vectors(
    vectors: DataFrame,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    miss: float = MISS,
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors link when their labels are equal and their cosine is ``threshold`` or more.
    ``n_links`` counts the other rows linked directly; ``component_id`` is the smallest id
    reachable. Null, empty, zero, and non-finite vectors, vectors with a null component,
    without a label or without an id, and vectors of another length link with nothing.
    Repeated rows are separate vectors that link. Other columns are not read.
    """
    base = materialize(_usable(vectors, id_col, vector_col, label_col), "vectors")
    can = F.col("vec").isNotNull() & F.col("label").isNotNull() & F.col("id").isNotNull()
    key = F.when(can, F.md5(F.concat(F.col("vec"), F.col("label").cast("binary"), F.length("vec").cast("string").cast("binary"))))
    keyed = base.withColumn("key", key)
    classes = keyed.where(can).groupBy("key").agg(
        F.min("id").alias("id"), F.count("*").alias("n"),
        F.any_value("label").alias("label"), F.any_value("vec").alias("vec"),
    )
    classes = materialize(classes, "vector-classes")
    # One id may name two different vectors: a class needs a number of its own.
    k, tables = table_sizes(classes.count(), threshold, miss)
    node = F.xxhash64("key")
    hashed = _buckets(classes.select(node.alias("id"), "n", "label", "vec"), k, tables)
    hashed = materialize(hashed, "vector-buckets")
    members = hashed.select("id", F.explode("buckets").alias("bucket")).distinct()
    groups = candidate_groups(members).join(hashed.select("id", "n", "label", "vec", "buckets"), "id")

    def prepare(rows: pd.DataFrame):
        size = rows["vec"].map(len).to_numpy()
        unit = np.zeros((len(rows), size.max() // 8))
        for dim in np.unique(size):
            at = np.flatnonzero(size == dim)
            vec = np.frombuffer(b"".join(rows["vec"].iloc[at]), dtype=np.float64)
            unit[at, : dim // 8] = _unit(vec.reshape(len(at), dim // 8))
        label = pd.factorize(rows["label"])[0]
        table = np.stack(rows["buckets"].to_numpy())
        own = (table == rows["bucket"].to_numpy()[:, None]).argmax(axis=1)

        def verify(left: np.ndarray, right: np.ndarray) -> np.ndarray:
            close = np.einsum("ij,ij->i", unit[left], unit[right]) >= threshold
            close &= (size[left] == size[right]) & (label[left] == label[right])
            at = np.flatnonzero(close)
            # A pair counts in the first table that has it together.
            first = (table[left[at]] == table[right[at]]).argmax(axis=1)
            close[at] = first == own[left[at]]
            return close

        return verify

    found = materialize(linked(groups, prepare), "vector-links")
    reach = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = classes.select("key", node.alias("node"), "n", F.col("id").alias("first"))
    named = named.join(links.withColumnRenamed("id", "node"), "node", "left").join(reach, "node", "left")
    named = materialize(named.withColumn("root", F.coalesce("root", "node")), "vector-nodes")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(least, "root").select(
        "key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    named = materialize(named, "vector-components")
    out = keyed.select("id", "key").join(named, "key", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
