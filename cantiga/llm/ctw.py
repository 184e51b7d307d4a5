"""Language-model scores by context-tree weighting, beside add-one word scores.

A text is its lower-cased words joined by spaces and closed by a line break. A byte is eight
binary decisions, each a node of a tree of 255 nodes. For each node there is a context tree
over the ``DEPTH`` bytes before, with Krichevsky-Trofimov counts at every depth. A context s
has the weighted probability

    Pw(s) = (Pe(s) + product of Pw over the next longer contexts) / 2,   Pw = Pe at the end,

so with w(s) = Pe(s) / (2 Pw(s)) the probability of a bit is the mixture along its contexts:
w(s) times the estimate at s, and 1 - w(s) times what the longer context says.

What is learned are counts of (context, byte) grams, folded from the longest contexts to the
empty one. A group of contexts that share their last two bytes is bounded by the alphabet and
not by the corpus; one of more than ``PIECE_GRAMS`` grams is cut by its third byte from the end.
Deepest contexts are worked on ``_CONTEXTS`` at a time, and the driver sees one row per byte.

The corpus is written in blocks of about ``BLOCK_BYTES`` of text. Each block asks once for the
distinct words it holds, and gets their counts back with its texts. Grams repeat far more
than words: a task asks for its distinct ones, and while all of them are at most
``BROADCAST_GRAMS`` their probabilities are broadcast. Beyond, blocks ask for grams as they
do for words, and nothing of the size of the vocabulary meets in one place.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantiga.session import materialize

DEPTH = 5
BLOCK_BYTES = 8 << 20
# Grams whose probabilities are broadcast: 16 bytes each and 12 for their places, 84 MB at the most.
BROADCAST_GRAMS = 3_000_000
# Grams of a group of contexts from which it is cut into pieces.
PIECE_GRAMS = 1 << 12
# Grams that a task folds at a time.
_FOLD = 1 << 20
# Bytes of text that are scored at once.
_SCORED = 1 << 18
_END = b"\n"
_NODES = 256
# Contexts that are worked on at a time.
_CONTEXTS = 2048
_LN2 = math.log(2.0)


def stream(text: bytes | None) -> tuple[list[bytes], bytes]:
    """The words of a text and the bytes that the model codes."""
    words = (text or b"").lower().split()
    return words, b" ".join(words) + _END


def grams(streams: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """A code per byte of the streams, with its ``depth`` bytes before; and their lengths.

    The byte is the lowest of the code, the byte before it the next one. Line breaks stand
    before a stream.
    """
    pad = _END * depth
    lengths = np.array([len(s) for s in streams], dtype=np.int64)
    whole = np.frombuffer(b"".join(x for s in streams for x in (pad, s)), dtype=np.uint8)
    codes = np.zeros(max(0, len(whole) - depth), dtype=np.int64)
    for i in range(depth + 1):
        codes <<= 8
        codes |= whole[i : len(whole) - depth + i]
    keep = np.ones(len(codes), dtype=bool)
    # Codes that end in the pad before a later stream are none of a text's bytes.
    ends = np.cumsum(lengths + depth)[:-1] - depth
    keep[(ends[:, None] + np.arange(depth)).ravel()] = False
    return codes[keep], lengths


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 0.5: eight steps up, then Stirling's series."""
    y = x + 8.0
    out = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi)
    out += 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    product = np.ones_like(x)
    for i in range(8):
        product *= x + i
    return out - np.log(product)


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    out = np.zeros(zeros.shape)
    at = (zeros + ones) > 0
    a, b = zeros[at], ones[at]
    out[at] = _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - math.log(math.pi) - _log_gamma(a + b + 1.0)
    return out


def bit_counts(bytes_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones at the 255 nodes (columns 1 to 255) from counts of 256 bytes."""
    tree = np.zeros((len(bytes_), 2 * _NODES))
    tree[:, _NODES:] = bytes_
    level = _NODES
    while level > 1:
        tree[:, level // 2 : level] = tree[:, level : 2 * level : 2] + tree[:, level + 1 : 2 * level : 2]
        level //= 2
    nodes = np.arange(_NODES)
    return tree[:, 2 * nodes] * (nodes > 0), tree[:, 2 * nodes + 1] * (nodes > 0)


def _weighted(log_kt: np.ndarray, longer: np.ndarray | None) -> np.ndarray:
    """log Pw from log Pe and the summed log Pw of the longer contexts, None at the end."""
    return log_kt if longer is None else np.logaddexp(log_kt, longer) - _LN2


class _Level:
    """The contexts of one depth: byte counts, estimates and weights at each bit node."""

    def __init__(self, counts: np.ndarray, longer: np.ndarray | None) -> None:
        self.counts = counts
        zeros, ones = bit_counts(counts)
        log_kt = _log_kt(zeros, ones)
        self.log_pw = _weighted(log_kt, longer)
        self.one = (ones + 0.5) / (zeros + ones + 1.0)
        self.weight = np.ones_like(log_kt) if longer is None else np.exp(log_kt - _LN2 - self.log_pw)


def _sum_by(parent: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Rows summed by their (sorted) parent number."""
    out = np.zeros((count, rows.shape[1]))
    starts = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
    out[parent[starts]] = np.add.reduceat(rows, starts, axis=0)
    return out


def _byte_rows(context: np.ndarray, byte: np.ndarray, n: np.ndarray, count: int) -> np.ndarray:
    out = np.zeros((count, _NODES))
    out[context, byte] = n
    return out


def _order(codes: np.ndarray, depth: int) -> np.ndarray:
    """Sort by the context from its last byte backwards, so that contexts nest."""
    return np.lexsort([codes & 255, *((codes >> (8 * d)) & 255 for d in range(depth, 0, -1))])


def _levels(
    codes: np.ndarray, n: np.ndarray, depth: int, top: int = 2
) -> tuple[list[_Level], list[np.ndarray], np.ndarray, np.ndarray]:
    """Levels ``top + 1`` to ``depth - 1`` of nested grams, and what they add to level ``top``.

    Gives the levels, each gram's context from ``top`` to ``depth``, and for every context of
    ``top`` bytes the byte counts and the summed log Pw of the next longer contexts. The deepest
    level is only summed here; see ``_deepest``.
    """
    numbers = []
    for d in range(top, depth + 1):
        context = (codes >> 8) & ((1 << (8 * d)) - 1)
        numbers.append(np.cumsum(np.append(0, context[1:] != context[:-1])))
    counts = longer = None
    for rows, level in _deepest(codes, n, numbers[-1]):
        first = numbers[-2][rows[0]] if depth > top else 0
        parent = numbers[-2][rows][np.flatnonzero(np.append(True, np.diff(numbers[-1][rows]) > 0))]
        width = numbers[-2][-1] + 1
        if counts is None:
            counts, longer = np.zeros((width, _NODES)), np.zeros((width, _NODES))
        local = parent - first
        counts[first : local[-1] + first + 1] += _sum_by(local, level.counts, local[-1] + 1)
        longer[first : local[-1] + first + 1] += _sum_by(local, level.log_pw, local[-1] + 1)
    levels = []
    for d in range(depth - 1, top, -1):
        level = _Level(counts, longer)
        levels.insert(0, level)
        here, above = numbers[d - top], numbers[d - top - 1]
        first = np.flatnonzero(np.append(True, np.diff(here) > 0))
        counts = _sum_by(above[first], level.counts, above[-1] + 1)
        longer = _sum_by(above[first], level.log_pw, above[-1] + 1)
    return levels, numbers, counts, longer


def _deepest(codes: np.ndarray, n: np.ndarray, number: np.ndarray) -> Iterator[tuple[np.ndarray, _Level]]:
    """The deepest level, a bounded number of contexts at a time, with the gram rows."""
    starts = np.flatnonzero(np.append(True, np.diff(number) > 0))
    for at in range(0, len(starts), _CONTEXTS):
        first = starts[at]
        last = starts[at + _CONTEXTS] if at + _CONTEXTS < len(starts) else len(codes)
        rows = np.arange(first, last)
        local = number[rows] - number[first]
        yield rows, _Level(_byte_rows(local, codes[rows] & 255, n[rows], local[-1] + 1), None)


def _path(byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eight nodes on the way to each byte, and the bit taken at each."""
    shifts = np.arange(7, -1, -1)
    leaf = byte[:, None] + _NODES
    return leaf >> (shifts + 1), ((leaf >> shifts) & 1).astype(bool)


def _mix(mixed: np.ndarray, rest: np.ndarray, level: _Level, context: np.ndarray, nodes: np.ndarray, bits: np.ndarray) -> None:
    """Add one depth's share to the probability of each gram's bits."""
    one, weight = level.one[context[:, None], nodes], level.weight[context[:, None], nodes]
    mixed += rest * weight * np.where(bits, one, 1 - one)
    rest *= 1 - weight


def _fold_piece(rows: pd.DataFrame, depth: int) -> pd.DataFrame:
    """What a piece of the contexts that share their last two bytes adds to the context of these."""
    codes, n = rows["gram"].to_numpy(), rows["n"].to_numpy(float)
    order = _order(codes, depth)
    _, _, counts, longer = _levels(codes[order], n[order], depth)
    return pd.DataFrame({"two": rows["two"].iloc[:1], "piece": rows["piece"].iloc[:1], "counts": [counts[0]], "longer": [longer[0]]})


def _fold_pair(rows: pd.DataFrame) -> pd.DataFrame:
    """The sums of the pieces, always in the same order."""
    rows = rows.sort_values("piece")
    return pd.DataFrame({"two": rows["two"].iloc[:1], **{c: [np.sum(np.stack(rows[c].to_numpy()), axis=0)] for c in ("counts", "longer")}})


def _fold_byte(rows: pd.DataFrame) -> pd.DataFrame:
    """What the contexts that share their last byte say to the context of this byte."""
    rows = rows.sort_values("two")
    level = _Level(*(np.stack(rows[c].to_numpy()) for c in ("counts", "longer")))
    return pd.DataFrame({"last": rows["two"].iloc[:1] & 255, "counts": [level.counts.sum(axis=0)], "longer": [level.log_pw.sum(axis=0)]})


def gram_probabilities(counts: DataFrame, depth: int = DEPTH, piece_grams: int = PIECE_GRAMS) -> DataFrame:
    """``gram, log_p`` (natural logarithm) from ``gram, n`` with ``n`` training counts."""
    if not 3 <= depth <= 5:
        raise ValueError("a depth of 3 to 5 bytes")
    two = F.shiftright("gram", 8).bitwiseAND(0xFFFF).cast("int").alias("two")
    # A row per pair of bytes with many grams: 65,536 narrow rows at most.
    large = counts.groupBy(two).agg(F.ceil(F.count("*") / piece_grams).alias("cut")).where("cut > 1")
    third = F.shiftright("gram", 24).bitwiseAND(0xFF)
    piece = F.coalesce(F.pmod(third, F.col("cut")), F.lit(0)).cast("int").alias("piece")
    cut = counts.select("gram", "n", two).join(F.broadcast(materialize(large, "large-contexts")), "two", "left")
    cut = cut.select("gram", "n", "two", piece)
    arrays = "counts array<double>, longer array<double>"
    pieces = cut.groupBy("two", "piece").applyInPandas(lambda rows: _fold_piece(rows, depth), f"two int, piece int, {arrays}")
    pieces = materialize(pieces, "context-pieces")
    # At most 65,536 rows, of which the driver sees 256 sums.
    pairs = materialize(pieces.groupBy("two").applyInPandas(_fold_pair, f"two int, {arrays}"), "contexts-2")
    last = F.col("two").bitwiseAND(0xFF)
    ones = pairs.groupBy(last).applyInPandas(_fold_byte, f"last int, {arrays}").toArrow().to_pandas()
    byte_counts, longer = np.zeros((256, 256)), np.zeros((256, 256))
    for last, c, w in ones.itertuples(index=False):
        byte_counts[last], longer[last] = c, w
    one = _Level(byte_counts, longer)
    none = _Level(byte_counts.sum(axis=0, keepdims=True), one.log_pw.sum(axis=0, keepdims=True))
    for level in (one, none):
        del level.counts, level.log_pw
    spread = counts.sparkSession.sparkContext.broadcast((none, one))

    def score(rows: pd.DataFrame, pair: pd.DataFrame) -> pd.DataFrame:
        codes, n = rows["gram"].to_numpy(), rows["n"].to_numpy(float)
        order = _order(codes, depth)
        codes, n = codes[order], n[order]
        levels, numbers, _, _ = _levels(codes, n, depth)
        levels.insert(0, _Level(*(np.stack(pair[c].to_numpy()) for c in ("counts", "longer"))))
        out = np.empty(len(codes))
        nothing, last = spread.value
        for some, deepest in _deepest(codes, n, numbers[-1]):
            nodes, bits = _path(codes[some] & 255)
            mixed, rest = np.zeros(nodes.shape), np.ones(nodes.shape)
            _mix(mixed, rest, nothing, np.zeros(len(some), dtype=np.int64), nodes, bits)
            _mix(mixed, rest, last, (codes[some] >> 8) & 255, nodes, bits)
            for level, number in zip(levels, numbers, strict=False):
                _mix(mixed, rest, level, number[some], nodes, bits)
            _mix(mixed, rest, deepest, numbers[-1][some] - numbers[-1][some[0]], nodes, bits)
            out[some] = np.log(mixed).sum(axis=1)
        return pd.DataFrame({"gram": codes, "log_p": out})

    told = pieces.select("two", "piece").join(pairs, "two")
    together = cut.groupBy("two", "piece").cogroup(told.groupBy("two", "piece"))
    return together.applyInPandas(score, "gram bigint, log_p double")


def _slot(codes: np.ndarray, bits: int) -> np.ndarray:
    """A place among 2 ** ``bits`` for each gram: the leading bits of a product with an odd number."""
    return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


class GramTable:
    """Log probabilities by gram: open addressing, at most half full, looked up in whole arrays.

    ``at`` holds the row number of the gram in each place, or -1. A gram lies in its own place
    or in the first free one after it.
    """

    def __init__(self, codes: np.ndarray, log_p: np.ndarray) -> None:
        self.codes, self.log_p = codes, log_p
        self.bits = max(4, (2 * len(codes)).bit_length())
        self.at = np.full(1 << self.bits, -1, dtype=np.int32)
        waiting = np.arange(len(codes), dtype=np.int32)
        place = _slot(codes, self.bits)
        while len(waiting):
            free = self.at[place] < 0
            self.at[place[free]] = waiting[free]
            # Of several that ask for one place, the last one written has it.
            lost = self.at[place] != waiting
            waiting, place = waiting[lost], (place[lost] + 1) & (len(self.at) - 1)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """The log probability of each gram; all must be there."""
        place = _slot(codes, self.bits)
        row = self.at[place]
        waiting = np.flatnonzero((row < 0) | (self.codes[row] != codes))
        while len(waiting):
            if (row[waiting] < 0).any():
                raise ValueError("a gram without a probability: the texts changed between the passes")
            place[waiting] = (place[waiting] + 1) & (len(self.at) - 1)
            row[waiting] = self.at[place[waiting]]
            waiting = waiting[(row[waiting] < 0) | (self.codes[row[waiting]] != codes[waiting])]
        return self.log_p[row]


def _numbered(block_bytes: int):
    """Adds ``block`` to batches of id, held_out and text: the task's partition and a piece of it."""

    def number(batches):
        from pyspark import TaskContext

        place = TaskContext.get().partitionId() << 32
        size = 0
        for batch in batches:
            lengths = np.array([len(t) if t is not None else 0 for t in batch.column(2).to_pylist()], dtype=np.int64)
            ends = size + np.cumsum(lengths)
            blocks = place + (ends - lengths) // block_bytes
            size = int(ends[-1]) if len(ends) else size
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(blocks)], ["doc_id", "held_out", "text", "block"])

    return number


class _GramCounts:
    """Distinct grams with their training counts, folded as they come."""

    def __init__(self) -> None:
        self.fresh: tuple[list, list] = ([], [])
        self.waiting = 0
        self.codes, self.counts = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def add(self, codes: np.ndarray, is_held: bool) -> None:
        self.fresh[is_held].append(codes)
        self.waiting += len(codes)
        if self.waiting > _FOLD:
            self.fold()

    def fold(self) -> None:
        codes, counts = [self.codes], [self.counts]
        for is_held, fresh in enumerate(self.fresh):
            if fresh:
                found, n = np.unique(np.concatenate(fresh), return_counts=True)
                codes.append(found)
                counts.append(n * (1 - is_held))
                fresh.clear()
        self.waiting = 0
        whole, n = np.concatenate(codes), np.concatenate(counts)
        order = np.argsort(whole, kind="stable")
        whole, n = whole[order], n[order]
        starts = np.flatnonzero(np.append(True, whole[1:] != whole[:-1])) if len(whole) else np.empty(0, dtype=np.int64)
        self.codes, self.counts = whole[starts], np.add.reduceat(n, starts) if len(starts) else n

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self.fold()
        out = self.codes, self.counts
        self.__init__()
        return out


def _together(texts: pd.Series) -> Iterator[tuple[int, int]]:
    """Places of neighbouring texts that are scored at once: ``_SCORED`` bytes, or one longer text."""
    first = size = 0
    for at, text in enumerate(texts):
        size += len(text or b"")
        if size >= _SCORED or at + 1 == len(texts):
            yield first, at + 1
            first, size = at + 1, 0


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of neighbouring values, so many at a time; no length is 0."""
    ends = np.cumsum(lengths)
    return np.array([values[end - n : end].sum() for end, n in zip(ends, lengths, strict=True)])


_ASKED = pa.schema([("block", pa.int64()), ("word", pa.binary()), ("gram", pa.int64()), ("n", pa.int64())])


def _rows(block: int | None, name: str, values: pa.Array, n: pa.Array) -> Iterator[pa.RecordBatch]:
    size = len(values)
    columns = {f.name: pa.nulls(size, f.type) for f in _ASKED} | {name: values, "n": n}
    if block is not None:
        columns["block"] = pa.array(np.full(size, block))
    yield from pa.Table.from_pydict(columns, schema=_ASKED).to_batches(max_chunksize=1 << 16)


def _asked(blocked: DataFrame, depth: int, words: bool, blockwise: bool) -> DataFrame:
    """Distinct words per block and distinct grams, with their training counts.

    Grams are distinct per task, or ``blockwise`` per block. A block that two tasks read asks twice.
    """

    def read(batches):
        block, counter, held, counted = None, Counter(), set(), _GramCounts()

        def words_of_block():
            for word in held:
                counter.setdefault(word, 0)
            yield from _rows(block, "word", pa.array(counter.keys(), pa.binary()), pa.array(counter.values(), pa.int64()))
            counter.clear()
            held.clear()

        def grams_so_far():
            codes, n = counted.take()
            yield from _rows(block if blockwise else None, "gram", pa.array(codes), pa.array(n))

        for batch in batches:
            for is_held, text, at in zip(*(batch.column(i) for i in (1, 2, 3)), strict=True):
                is_held, at = is_held.as_py(), at.as_py()
                if block is not None and at != block:
                    yield from words_of_block()
                    if blockwise or len(counted.codes) > 2 * _FOLD:
                        yield from grams_so_far()
                block = at
                own, coded = stream(text.as_py())
                counted.add(grams([coded], depth)[0], is_held)
                if words:
                    own.append(b"")  # the end, counted as a token
                    held.update(own) if is_held else counter.update(own)
        if block is not None:
            yield from words_of_block()
            yield from grams_so_far()

    return blocked.mapInArrow(read, "block bigint, word binary, gram bigint, n bigint")


def score_texts(
    documents: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    depth: int = DEPTH,
    block_bytes: int = BLOCK_BYTES,
    broadcast_grams: int = BROADCAST_GRAMS,
) -> DataFrame:
    """Scores of every document by models of those for which ``held_out`` is false.

    Gives ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``.
    Tokens are lower-cased words and one end; ``base_score`` is their add-one log10
    probability, ``score`` the context tree's log10 probability of the text. A null or empty
    text is one end. Rows may repeat and ids may be null: each row counts. Other columns
    are not read.
    """
    rows = documents.select(
        F.col(id_col).cast("bigint").alias("doc_id"), held_out.alias("held_out"), F.col(text_col).cast("binary").alias("text")
    )
    # Written once: both passes then see the same blocks, also when the rows come from a shuffle.
    blocked = rows.mapInArrow(_numbered(block_bytes), "doc_id bigint, held_out boolean, text binary, block bigint")
    blocked = materialize(blocked, "blocks", compression="zstd")
    asked = materialize(_asked(blocked, depth, True, False), "asked", compression="zstd")
    same = Window.partitionBy("word")
    words = asked.where("word is not null").select(
        "block", "word", F.sum("n").over(same).alias("n"), (F.row_number().over(same.orderBy("block")) == 1).alias("first")
    )
    words = materialize(words, "word-counts", compression="zstd")
    kinds = F.count(F.when(F.col("n") > 0, 1))
    total, distinct = words.where("first").agg(F.coalesce(F.sum("n"), F.lit(0)), kinds).first()
    gram_counts = asked.where("gram is not null").groupBy("gram").agg(F.sum("n").alias("n"))
    gram_counts = materialize(gram_counts, "gram-counts")
    chances = materialize(gram_probabilities(gram_counts, depth), "gram-probabilities")

    answers = words.select("block", "word", F.col("n").cast("double").alias("value"))
    spread = None
    if gram_counts.count() <= broadcast_grams:
        known = chances.toArrow()
        spread = documents.sparkSession.sparkContext.broadcast(GramTable(known["gram"].to_numpy(), known["log_p"].to_numpy()))
    else:
        wanted = _asked(blocked, depth, False, True).where("gram is not null").select("block", "gram")
        found = materialize(wanted, "asked-grams").join(chances, "gram")
        answers = answers.unionByName(found.select("block", "gram", F.col("log_p").alias("value")), allowMissingColumns=True)
    below = total + distinct + 1

    def score(docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        value, word = told["value"].to_numpy(), told["word"].to_numpy()
        if spread is None:
            gram = told["gram"].to_numpy()
            is_word = np.isnan(gram.astype(float))
            table = GramTable(gram[~is_word].astype(np.int64), value[~is_word])
            value, word = value[is_word], word[is_word]
        else:
            table = spread.value
        counts = dict(zip(word, value, strict=True))
        out = {name: [] for name in ("n_tokens", "n_known", "base_score", "score", "bits_per_byte")}
        for first, last in _together(docs["text"]):
            streams = [stream(text) for text in docs["text"].iloc[first:last]]
            tokens = [[*own, b""] for own, _ in streams]
            codes, lengths = grams([coded for _, coded in streams], depth)
            natural = _sums(table.find(codes), lengths)
            sizes = np.array([len(own) for own in tokens])
            c = np.fromiter((counts[w] for own in tokens for w in own), dtype=float, count=sizes.sum())
            out["n_tokens"].append(sizes)
            out["n_known"].append(_sums(c > 0, sizes))
            out["base_score"].append(_sums(np.log10((c + 1) / below), sizes))
            out["score"].append(natural / math.log(10))
            out["bits_per_byte"].append(-natural / _LN2 / lengths)
        whole = {name: np.concatenate(parts) if parts else [] for name, parts in out.items()}
        return pd.DataFrame({"doc_id": docs["doc_id"].astype("Int64"), "held_out": docs["held_out"], "train_tokens": total, **whole})[names]

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
    schema = (
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double, bits_per_byte double"
    )
    return blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(score, schema)
