"""Near-duplicate texts by 64-bit SimHash fingerprints.

A fingerprint is cut into ``SEGMENTS`` segments and mapped to the vector of their bit
counts. Changing one bit moves that vector by one step, so fingerprints at Hamming distance
2 or less have vectors at Manhattan distance 2 or less. Two such vectors share a grid point
at distance 1 or less from both: every fingerprint is entered at its own point and the ones
next to it, fingerprints that meet at a point are candidates, and their bits are compared.

Only distinct fingerprints are compared, so equal texts cost one entry.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cantiga.llm.links import candidate_groups, components, linked
from cantiga.session import materialize

SEGMENTS = 16
BITS = 64 // SEGMENTS
SHINGLE = 3
MAX_BITS = 2
_AT_ONCE = 1 << 15


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text's word shingles; 0 without a word.

    Words are runs without ASCII white space, lower-cased in A-Z only, which is what
    ``bytes.split`` and ``bytes.lower`` do. A bit is set when it is set in over half of
    the shingles' hashes. A text with fewer words than a shingle is one shingle.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    count = len(words) - shingle + 1
    ones = np.zeros(64, dtype=np.int64)
    hashed = xxhash.xxh64_digest
    for at in range(0, count, _AT_ONCE):
        piece = words[at : at + _AT_ONCE + shingle - 1]
        grams = zip(*(piece[i:] for i in range(shingle)), strict=False)
        digests = b"".join([hashed(b" ".join(g), 42) for g in grams])
        bits = np.unpackbits(np.frombuffer(digests, dtype=np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def fingerprints(documents: DataFrame, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The other columns of ``documents`` with ``fp``, the fingerprint as a signed bigint."""
    keys = [c for c in documents.columns if c != text_col]
    schema = documents.select(*keys).schema.add("fp", T.LongType())

    def read(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(len(keys)).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keys)], pa.array(fps.view(np.int64))], [*keys, "fp"]
            )

    return documents.select(*keys, F.col(text_col).cast("binary")).mapInArrow(read, schema)


def grid_points(fps: np.ndarray) -> np.ndarray:
    """For each fingerprint the codes of its grid point and its neighbours, -1 outside."""
    fps = fps.view(np.uint64)
    shifts = np.arange(SEGMENTS, dtype=np.uint64) * np.uint64(BITS)
    counts = np.bitwise_count((fps[:, None] >> shifts) & np.uint64((1 << BITS) - 1)).astype(np.int64)
    unit = np.int64(1) << (np.arange(SEGMENTS) * (BITS.bit_length())).astype(np.int64)
    home = counts @ unit
    up = np.where(counts < BITS, home[:, None] + unit, -1)
    down = np.where(counts > 0, home[:, None] - unit, -1)
    return np.hstack([home[:, None], up, down])


def link_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``node, root`` for the distinct fingerprints ``fp`` that link with another one.

    Exact for ``max_bits`` up to 2, the distance at which neighbouring grid points meet.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the grid meets at a Manhattan distance of at most 2")

    def enter(batches):
        for rows in batches:
            fp = rows["fp"].to_numpy()
            points = grid_points(fp)
            inside = points >= 0
            yield pd.DataFrame({"bucket": points[inside], "id": np.repeat(fp, inside.sum(axis=1))})

    def prepare(rows: pd.DataFrame):
        fp = rows["id"].to_numpy().view(np.uint64)
        return lambda left, right: np.bitwise_count(fp[left] ^ fp[right]) <= max_bits

    members = materialize(fps.mapInPandas(enter, "bucket bigint, id bigint"), "grid-points")
    found = linked(candidate_groups(members), prepare)
    edges = materialize(found.select(F.col("id").alias("a"), F.col("root").alias("b")), "fingerprint-links")
    return components(edges)


def row_hash(documents: DataFrame) -> Column:
    """Tells rows apart by all columns; equal rows are treated alike."""
    return F.xxhash64(*documents.columns, *[F.col(c).isNull() for c in documents.columns])


def near_duplicate_rows(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: ``doc_id, row, fp, root, component_id``, as ``near_duplicate_texts``.

    ``row`` is the hash of all columns (``row_hash``), ``root`` is the same for all rows of a
    component and for no others, whatever their ids are.
    """
    rows = documents.select(
        F.col(id_col).cast("bigint").alias("doc_id"), row_hash(documents).alias("row"), F.col(text_col).alias("text")
    )
    return _named(rows, shingle, max_bits).select("doc_id", "row", "fp", "root", "component_id")


def _named(rows: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """``rows`` (``doc_id, text`` and more) with ``fp, root, component_id`` and without the text."""
    rows = materialize(fingerprints(rows, "text", shingle), "fingerprints")
    first = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    reach = link_fingerprints(first.select("fp"), max_bits)
    rooted = first.join(reach, first["fp"] == reach["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialize(rooted.join(least, "root").select("fp", "root", "component_id"), "fingerprint-components")
    return rows.join(named, "fp")


def near_duplicate_texts(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    Fingerprints link at ``max_bits`` differing bits or fewer; ``component_id`` is the
    smallest id reachable. A null or empty text has the fingerprint zero and links like any
    other. Rows may repeat and ids may be null: a null id is never a component's id unless
    the component has no other. Other columns are not read.
    """
    rows = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return _named(rows, shingle, max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
