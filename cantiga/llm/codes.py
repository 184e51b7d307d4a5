"""Short codes for vectors: each part of a vector is named by its nearest codebook entry.

Components are whole numbers, floor(scale * x), and repeat a lot. A block of vectors is
therefore written as dictionaries: for every dimension the distinct numbers of the block, and
for every vector a code into them. To compare a block with a codebook, the squared difference
of every distinct number to the component of every entry is tabulated once; the distance of a
part to all entries is then a gather and an add per dimension. Nothing is multiplied per vector.

Blocks hold a bounded number of vectors, so tables are small whatever the values are. Sums
for new entries are added up in a task before they move: a few rows per task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantiga.llm.vectors import _floats
from cantiga.operators.skew import lookup_join
from cantiga.session import materialize

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
# Numbers in a block of vectors; with 64 components that is 8,192 vectors.
BLOCK_NUMBERS = 1 << 19
# Numbers beyond are held here: what a bigint holds, with room for differences.
MOST = 1 << 60
_BIGINT = 1 << 63
# Sums below stay exact in a double.
_EXACT = 1 << 53


def whole_numbers(vectors: list[np.ndarray], scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of equally long vectors as a matrix of 64-bit numbers, held at ``MOST``."""
    scaled = np.floor(np.multiply(np.stack(vectors), float(scale)))
    return np.clip(scaled, -float(MOST), float(MOST)).astype(np.int64)


def value_dictionaries(matrix: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """For each dimension its distinct numbers in order, and the matrix of codes into them."""
    codes = np.empty(matrix.shape, dtype=np.uint16)
    values = []
    for d in range(matrix.shape[1]):
        distinct, code = np.unique(matrix[:, d], return_inverse=True)
        values.append(distinct)
        codes[:, d] = code
    return values, codes


def squared_differences(values: list[np.ndarray], entries: np.ndarray) -> list[np.ndarray]:
    """For each dimension of a part a table: distinct numbers by entries.

    In 64 bits where a sum over the part fits, in Python's whole numbers otherwise.
    """
    most = max([int(np.abs(v).max(initial=0)) for v in values] + [max((abs(int(x)) for x in entries.flat), default=0)])
    fits = len(values) * (2 * most) ** 2 < _BIGINT
    kind = np.int64 if fits else object
    return [(v.astype(kind)[:, None] - entries[:, d].astype(kind)[None, :]) ** 2 for d, v in enumerate(values)]


def nearest(values: list[np.ndarray], codes: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest of ``entries`` (ties to the lower one) for every row, and the squared distance."""
    tables = squared_differences(values, entries)
    distance = tables[0][codes[:, 0]]
    for d in range(1, len(tables)):
        distance = distance + tables[d][codes[:, d]]
    index = distance.argmin(axis=1)
    return index, distance[np.arange(len(index)), index]


def _parts(block: dict, parts: int) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    width = len(block["values"]) // parts
    for p in range(parts):
        at = slice(p * width, (p + 1) * width)
        yield p, block["values"][at], block["codes"][:, at]


def _blocks(batch: pa.RecordBatch) -> Iterator[dict]:
    """The dictionaries and codes of written blocks, with the place of their rows."""
    for sizes, values, codes in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
        ends = np.cumsum(sizes)
        flat = np.frombuffer(values, dtype=np.int64)
        dictionaries = np.split(flat, ends[:-1])
        yield {"values": dictionaries, "codes": np.frombuffer(codes, dtype=np.uint16).reshape(-1, len(sizes))}


def encode(vectors: DataFrame, length: int, label: str, scale: int = SCALE) -> DataFrame:
    """Blocks of vectors of one length: ``sizes, values, codes, ids, labels``.

    ``vectors`` has ``id, label, v`` (an array of doubles). Vectors that are null, of another
    length, or hold null or non-finite components are left out.
    """
    rows = max(1, min(1 << 15, BLOCK_NUMBERS // max(1, length)))
    label_type = vectors.schema[label].dataType
    kind = f"sizes array<int>, values binary, codes binary, ids array<bigint>, labels array<{label_type.simpleString()}>"

    def read(batches):
        for batch in batches:
            found = _floats(batch.column(2))
            good = [i for i, x in enumerate(found) if x is not None and len(x) == length and np.isfinite(x).all()]
            for at in range(0, len(good), rows):
                some = good[at : at + rows]
                values, codes = value_dictionaries(whole_numbers([found[i] for i in some], scale))
                take, ends = pa.array(some, pa.int64()), pa.array([0, len(some)], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, batch.column(i).take(take)) for i in (0, 1)]
                sizes = pa.array([[len(v) for v in values]], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [sizes, pa.array([np.concatenate(values).tobytes()]), pa.array([codes.tobytes()]), *lists],
                    ["sizes", "values", "codes", "ids", "labels"],
                )

    return vectors.select("id", label, "v").mapInArrow(read, kind)


def first_codebooks(vectors: DataFrame, parts: int, entries: int, scale: int = SCALE) -> tuple[int, list[np.ndarray]]:
    """The common length, and per part the parts of the vectors with the smallest ids.

    The length is that of the usable vector with the smallest id; only ``entries`` rows
    come to the driver. A length that is no multiple of ``parts`` gives no codebook.
    """
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = vectors.where(F.col("v").isNotNull() & F.col("id").isNotNull() & ~bad).where((F.size("v") > 0) & (F.size("v") % parts == 0))
    order = ["id", "v"]
    length = usable.orderBy(*order).limit(1).select(F.size("v")).collect()
    if not length:
        return 0, []
    dims = length[0][0]
    rows = usable.where(F.size("v") == dims).orderBy(*order).limit(entries).select("v").collect()
    matrix = whole_numbers([np.array(r[0], dtype=np.float64) for r in rows], scale)
    return dims, [p.copy() for p in np.split(matrix, parts, axis=1)]


def _entry_sums(index: np.ndarray, distinct: np.ndarray, codes: np.ndarray, entries: int) -> np.ndarray:
    """The numbers of one dimension, added up per entry, exactly."""
    if int(np.abs(distinct).max(initial=0)) * len(index) < _EXACT:
        return np.bincount(index, weights=distinct[codes], minlength=entries).astype(np.int64).astype(object)
    sums = np.zeros(entries, dtype=object)
    np.add.at(sums, index, distinct.astype(object)[codes])
    return sums


def refine(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: every part goes to its nearest entry, and entries become the floors of their means."""

    def add_up(batches):
        sums = [np.zeros(b.shape, dtype=object) for b in books]
        counts = [np.zeros(len(b), dtype=np.int64) for b in books]
        for batch in batches:
            for block in _blocks(batch):
                for p, values, codes in _parts(block, len(books)):
                    index, _ = nearest(values, codes, books[p])
                    counts[p] += np.bincount(index, minlength=len(books[p]))
                    for d, distinct in enumerate(values):
                        sums[p][:, d] += _entry_sums(index, distinct, codes[:, d], len(books[p]))
        rows = [(p, e) for p in range(len(books)) for e in np.flatnonzero(counts[p]).tolist()]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p for p, _ in rows], pa.int32()),
                    pa.array([e for _, e in rows], pa.int32()),
                    pa.array([int(counts[p][e]) for p, e in rows], pa.int64()),
                    pa.array([[str(x) for x in sums[p][e]] for p, e in rows], pa.list_(pa.string())),
                ],
                ["part", "entry", "n", "sums"],
            )

    found = blocks.select("sizes", "values", "codes").mapInArrow(add_up, "part int, entry int, n bigint, sums array<string>")
    width = books[0].shape[1]
    totals = [F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(width)]
    # A row for each entry of each part, whatever the number of vectors.
    means = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *totals).collect()
    new = [b.copy() for b in books]
    for row in means:
        new[row["part"]][row["entry"]] = [int(row[f"s{d}"]) // row["n"] for d in range(width)]
    return new


def assign(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``vec_id, label, code, error`` of every encoded vector."""
    label_type = blocks.schema["labels"].dataType.elementType.simpleString()

    def name(batches):
        for batch in batches:
            ids, labels = batch.column(3), batch.column(4)
            for i, block in enumerate(_blocks(batch)):
                names = np.empty((len(block["codes"]), len(books)), dtype=np.uint8)
                error = np.zeros(len(block["codes"]), dtype=object)
                for p, values, codes in _parts(block, len(books)):
                    names[:, p], distance = nearest(values, codes, books[p])
                    error = error + distance
                yield pa.RecordBatch.from_arrays(
                    [
                        ids[i].values,
                        labels[i].values,
                        pa.array([row.tobytes().hex() for row in names]),
                        pa.array([min(int(e), _BIGINT - 1) for e in error], pa.int64()),
                    ],
                    ["vec_id", "label", "code", "error"],
                )

    return blocks.mapInArrow(name, f"vec_id bigint, label {label_type}, code string, error bigint")


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position, in decimal with commas."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.flat).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of all usable vectors, and the codebooks they point into.

    The rows are ``vec_id, label, code, error``; ``code`` has two hex digits per part and
    ``error`` is the squared distance to what the code stands for. Codebooks start as the
    parts of the ``entries`` vectors with the smallest ids (equal ids by their components).

    Left out are vectors that are null, empty, hold null or non-finite components, or differ
    in length from the usable vector with the smallest id; lengths must be a multiple of
    ``parts``. Rows without an id are coded and start no codebook. Repeated rows are coded
    each. Numbers beyond 2^60 are held there, and errors end at the largest bigint. With no
    usable row the result is empty. Other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("codes are two hex digits: 1 to 256 entries")
    plain = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v")
    )
    length, books = first_codebooks(plain, parts, entries, scale)
    if not books:
        label_type = plain.schema["label"].dataType.simpleString()
        empty = f"vec_id bigint, label {label_type}, code string, error bigint"
        return vectors.sparkSession.createDataFrame([], empty), []
    blocks = materialize(encode(plain, length, "label", scale), "vector-blocks")
    for _ in range(rounds):
        books = refine(blocks, books)
    return assign(blocks, books), books


def rebuild(code: str, books: list[np.ndarray]) -> np.ndarray:
    """The whole numbers that a code stands for."""
    return np.concatenate([books[p][i] for p, i in enumerate(bytes.fromhex(code))])


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the error summed over rows with an equal label, nulls together."""
    key = F.concat(F.when(F.col("label").isNull(), "-").otherwise("+"), F.coalesce(F.col("label").cast("string"), F.lit("")))
    keyed = materialize(coded.withColumn("_label", key), "vector-codes")
    whole = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_BIGINT - 1).cast("decimal(38,0)"))
    sums = keyed.groupBy("_label").agg(whole.cast("bigint").alias("label_error"))
    return lookup_join(keyed, sums, "_label", "left", "vec_id").drop("_label")


def bits_per_vector(parts: int = PARTS, entries: int = ENTRIES) -> int:
    """Bits of a code when each part takes as many as its entries need."""
    return parts * max(1, math.ceil(math.log2(entries)))
