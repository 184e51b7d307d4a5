"""Which ids of one tokenizer stand for which ids of another, counted over a corpus.

Both tokenizers cut the same bytes. Where both have an end, the text is cut into groups, and
all ids of a group are linked across. Most groups are one id on either side with the same
bytes. For these an array from each id of A to the id of B with its bytes is made once, and
their documents are counted in vectors as long as the vocabulary, one per task. Only pairs of
other groups are rows that are shuffled.

Each text is tokenised once; its distinct pairs are written, and joined to the counts later.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantiga.operators.skew import lookup_join
from cantiga.session import materialize

# Bytes of text that are cut at a time, and pairs that are held at a time.
AT_ONCE, PAIRS_AT_ONCE = 1 << 20, 1 << 20
# Counts of pairs that are broadcast: three numbers each.
BROADCAST_PAIRS = 1_000_000
# Fixed value: how a byte-level tokenizer cuts text before it merges bytes.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters whose classes no version of Unicode changes: others go to the slower library.
_SETTLED = re.compile(r"[^\u0000-\u024F\u2010-\u2027\u20AC]")
# Fixed value: the space in pieces of the second kind of tokenizer.
PIECE_SPACE = "\u2581"


def byte_level_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the other bytes in order for the
    characters from 256 on.
    """
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTokenizer:
    """A byte-level BPE tokenizer file; special tokens in a text are plain text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        alphabet = byte_level_alphabet()
        special = {t["id"]: t["content"] for t in described["added_tokens"]}
        ranks = {i: bytes(map(alphabet.__getitem__, t)) for t, i in described["model"]["vocab"].items() if i not in special}
        self.bytes = [ranks[i] if i in ranks else special.get(i, "").encode() for i in range(max(ranks | special) + 1)]
        self.fast = self._fast(described, ranks)

    def _fast(self, described: dict, ranks: dict[int, bytes]):
        """The same merges in a faster library, if ids are the order of the merges."""
        merges = [m if isinstance(m, list) else m.split(" ") for m in described["model"]["merges"]]
        vocabulary = described["model"]["vocab"]
        order = [vocabulary["".join(m)] for m in merges]
        if described["normalizer"] or described["pre_tokenizer"].get("add_prefix_space") or order != list(range(256, 256 + len(order))):
            return None
        try:
            import tiktoken
        except ImportError:
            return None
        return tiktoken.Encoding("merges", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks={b: i for i, b in ranks.items()}, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        settled = [self.fast is not None and (t.isascii() or not _SETTLED.search(t)) for t in texts]
        rest = iter(self.slow.encode_batch_fast([t for t, s in zip(texts, settled, strict=True) if not s], add_special_tokens=False))
        return [self.fast.encode_ordinary(t) if s else next(rest).ids for t, s in zip(texts, settled, strict=True)]


class PieceTokenizer:
    """A SentencePiece model with byte fallback."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace(PIECE_SPACE, " ").encode())
        # Pieces come before the single bytes that the model falls back to.
        self.order = sorted(range(len(self.bytes)), key=lambda i: (self.model.is_byte(i), i))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def identity_map(a: list[bytes], b: list[bytes], order: list[int]) -> np.ndarray:
    """For each id of A the first id of B, in ``order``, with the same bytes; -1 for none."""
    named: dict[bytes, int] = {}
    for i in order:
        named.setdefault(b[i], i)
    return np.array([named.get(x, -1) if x else -1 for x in a], dtype=np.int64)


class _Cut:
    """Two tokenizers, and what is worked out once for both."""

    def __init__(self, a, b) -> None:
        self.a, self.b = a, b
        self.same = identity_map(a.bytes, b.bytes, b.order)
        self.lengths = [np.array([len(x) for x in t.bytes], dtype=np.int64) for t in (a, b)]
        # Ids in decimal with the sign behind them, by id and whether it ends its side of a group.
        signs = [(b",", b"|"), (b",", b";")]
        self.starts = (0, 2 * len(a.bytes))
        self.names = np.array([b"%d%s" % (i, s) for t, two in zip((a, b), signs, strict=True) for i in range(len(t.bytes)) for s in two])

    def cut(self, texts: list[bytes | None]) -> dict:
        """Per text: numbers of tokens, groups and links, the digest; and all distinct pairs."""
        kept, encoded = [], []
        decoded = [(t or b"").decode("utf-8", "replace") for t in texts]
        asked = [i for i, t in enumerate(decoded) if t]
        sides = self.a.encode([" " + decoded[i] for i in asked]), self.b.encode([decoded[i] for i in asked])
        for i, *ids in zip(asked, *sides, strict=True):
            whole = b" " + texts[i]
            if all(b"".join(map(t.bytes.__getitem__, x)) == whole for t, x in zip((self.a, self.b), ids, strict=True)):
                kept.append(i)
                encoded.append(ids)
        out = {c: np.zeros(len(texts), dtype=np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
        out["digest"] = [""] * len(texts)
        empty = np.empty(0, dtype=np.int64)
        out["same"], out["pairs"] = (empty, empty, empty), (empty, empty, empty, empty)
        if kept:
            self._groups(np.array(kept), encoded, out)
        return out

    def _groups(self, kept: np.ndarray, encoded: list, out: dict) -> None:
        ids = [np.array([i for pair in encoded for i in pair[s]], dtype=np.int64) for s in (0, 1)]
        counts = [np.array([len(pair[s]) for pair in encoded]) for s in (0, 1)]
        # Both sides have the same bytes, so ends are counted on over all texts.
        ends = [np.cumsum(self.lengths[s][ids[s]]) for s in (0, 1)]
        last = [self._among(ends[s], ends[1 - s]) for s in (0, 1)]
        group = [np.cumsum(x) - x for x in last]
        sizes = [np.diff(np.flatnonzero(x), prepend=-1) for x in last]
        text_of = np.repeat(np.arange(len(kept)), counts[0])[last[0]]
        n_groups = np.bincount(text_of, minlength=len(kept))
        for name, values in zip(("n_a", "n_b", "n_groups"), (*counts, n_groups), strict=True):
            out[name][kept] = values
        out["n_links"][kept] = np.add.reduceat(sizes[0] * sizes[1], np.cumsum(n_groups) - n_groups)
        self._digests(kept, ids, counts, group, sizes, last, out)

        first = [np.cumsum(x) - x for x in sizes]
        single = (sizes[0] == 1) & (sizes[1] == 1)
        left, right = ids[0][first[0]], ids[1][first[1]]
        plain = single & (self.same[left] == right)
        same = [(text_of[plain], left[plain], np.ones(int(plain.sum()), dtype=np.int64))]
        pairs = []
        for text, a, b, times in self._crossed(ids, group, ~plain, text_of):
            by_map = self.same[a] == b
            same.append((text[by_map], a[by_map], times[by_map]))
            pairs.append(_added((text[~by_map], a[~by_map], b[~by_map]), times[~by_map], self.spans))
        text, a, times = _added([np.concatenate(x) for x in zip(*(s[:2] for s in same), strict=True)], np.concatenate([s[2] for s in same]), self.spans)
        out["same"] = kept[text], a, times
        if pairs:
            columns = [np.concatenate(x) for x in zip(*pairs, strict=True)]
            text, a, b, times = _added(columns[:3], columns[3], self.spans)
            out["pairs"] = kept[text], a, b, times

    @property
    def spans(self) -> tuple[int, int]:
        return len(self.a.bytes), len(self.b.bytes)

    @staticmethod
    def _among(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which of the rising numbers ``x`` are in the rising numbers ``y``."""
        place = np.minimum(np.searchsorted(y, x), len(y) - 1)
        return y[place] == x

    def _digests(self, kept, ids, counts, group, sizes, last, out) -> None:
        """The hashes of the groups written out: A's ids of a group, then B's."""
        before = [np.concatenate([[0], np.cumsum(x)]) for x in sizes]
        place_a = np.arange(len(ids[0])) + before[1][group[0]]
        place_b = np.arange(len(ids[1])) + before[0][group[1] + 1]
        names = np.empty(len(ids[0]) + len(ids[1]), dtype=np.int64)
        for side, place in enumerate((place_a, place_b)):
            names[place] = self.starts[side] + 2 * ids[side] + last[side]
        ends = np.cumsum(counts[0] + counts[1])
        for i, start, end in zip(kept.tolist(), (ends - counts[0] - counts[1]).tolist(), ends.tolist(), strict=True):
            # Shorter names are filled up with zero bytes.
            written = self.names[names[start:end]].tobytes().translate(None, b"\0")
            out["digest"][i] = hashlib.sha256(written[:-1]).hexdigest()

    def _crossed(self, ids, group, chosen, text_of) -> Iterator[tuple]:
        """``text, a, b, times`` of the distinct ids of the chosen groups, some pairs at a time."""
        sides = []
        for side in (0, 1):
            mine = chosen[group[side]]
            key = group[side][mine] * self.spans[side] + ids[side][mine]
            distinct, times = np.unique(key, return_counts=True)
            sides.append((distinct // self.spans[side], distinct % self.spans[side], times))
        (ga, a, ta), (gb, b, tb) = sides
        start, stop = np.searchsorted(gb, ga, "left"), np.searchsorted(gb, ga, "right")
        width = stop - start
        row = 0
        total = np.cumsum(width)
        while row < len(ga):
            done = total[row - 1] if row else 0
            end = max(row + 1, int(np.searchsorted(total, done + PAIRS_AT_ONCE, "right")))
            w = width[row:end]
            at = np.repeat(start[row:end] - (np.cumsum(w) - w), w) + np.arange(w.sum())
            which = np.repeat(np.arange(row, end), w)
            yield text_of[ga[which]], a[which], b[at], ta[which] * tb[at]
            row = end


def _added(columns: list[np.ndarray], times: np.ndarray, spans: tuple[int, int]) -> list[np.ndarray]:
    """The distinct rows of ``text, a`` or ``text, a, b`` in order, with their times added up."""
    key = columns[0]
    for column, span in zip(columns[1:], spans, strict=False):
        key = key * span + column
    distinct, where = np.unique(key, return_inverse=True)
    sums = np.bincount(where, weights=times, minlength=len(distinct)).astype(np.int64)
    out = [sums]
    for span in reversed(spans[: len(columns) - 1]):
        out.insert(0, distinct % span)
        distinct = distinct // span
    return [distinct, *out]



_CUTS: dict[tuple[str, str], _Cut] = {}


def _cut_of(paths: tuple[str, str]) -> _Cut:
    """One per worker process."""
    if paths not in _CUTS:
        _CUTS[paths] = _Cut(ByteTokenizer(paths[0]), PieceTokenizer(paths[1]))
    return _CUTS[paths]


_ROWS = (
    "id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, digest string, "
    "same array<int>, same_times array<bigint>, pairs array<bigint>, times array<bigint>, "
    "counted array<int>, documents array<bigint>"
)
_NAMES = [f.split()[0] for f in _ROWS.split(", ")]
# A pair as one number: the id of A times this, and the id of B.
PAIR = 1 << 32


def _lists(owner: np.ndarray, values: np.ndarray, rows: int, kind: pa.DataType) -> pa.ListArray:
    """Values sorted by their row as one list per row."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def aligned_texts(documents: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Per row of ``id, text`` (bytes) its numbers, digest and distinct pairs; per task its vector of counts."""

    def read(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        cut = _cut_of(paths)
        vector = np.zeros(len(cut.a.bytes), dtype=np.int64)
        for batch in batches:
            texts, at = batch.column(1), 0
            while at < len(texts):
                some: list[bytes | None] = []
                size = 0
                while at + len(some) < len(texts) and (not some or size < AT_ONCE):
                    some.append(texts[at + len(some)].as_py())
                    size += len(some[-1] or b"")
                found = cut.cut(some)
                n = len(some)
                owner, same, same_times = found["same"]
                vector += np.bincount(same, minlength=len(vector))
                row, a, b, times = found["pairs"]
                nothing = pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, n),
                        *[pa.array(found[c]) for c in ("n_a", "n_b", "n_groups", "n_links")],
                        pa.array(found["digest"], pa.string()),
                        _lists(owner, same, n, pa.int32()),
                        _lists(owner, same_times, n, pa.int64()),
                        _lists(row, a * PAIR + b, n, pa.int64()),
                        _lists(row, times, n, pa.int64()),
                        *nothing,
                    ],
                    _NAMES,
                )
                at += n
        counted = np.flatnonzero(vector)
        if len(counted):
            lists = [pa.array([counted.tolist()], pa.list_(pa.int32())), pa.array([vector[counted].tolist()], pa.list_(pa.int64()))]
            others = [pa.nulls(1, t) for t in (*[pa.int64()] * 5, pa.string(), pa.list_(pa.int32()), *[pa.list_(pa.int64())] * 3)]
            yield pa.RecordBatch.from_arrays([*others, *lists], _NAMES)

    return documents.mapInArrow(read, _ROWS)


def align(
    documents: DataFrame,
    byte_tokenizer: str,
    piece_tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The alignment of the corpus and of each document.

    First ``a, b, documents, best``: how many documents link the ids, and whether no other id
    of B has more with that id of A. Then per row of ``documents``: ``doc_id, n_a, n_b,
    n_groups, n_links, n_best, count_sum, groups_sha256``, where ``n_best`` links are between
    ids that are best and ``count_sum`` adds up the documents of all links.

    The paths are those of a byte-level BPE file and a SentencePiece model that every executor
    has. A text that is null, empty, or that a tokenizer does not give back byte by byte has no
    tokens: all zeros and no digest. Each row is a document, whether rows or ids repeat or ids
    are null. Other columns are not read.
    """
    rows = documents.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text"))
    read = aligned_texts(rows, (byte_tokenizer, piece_tokenizer)).withColumn("row", F.monotonically_increasing_id())
    read = materialize(read, "aligned-texts")
    texts = read.where(F.col("counted").isNull())
    vectors = read.where(F.col("counted").isNotNull())

    vocabulary = F.explode(F.arrays_zip(F.col("counted").alias("a"), F.col("documents").alias("n"))).alias("v")
    same = vectors.select(vocabulary).groupBy("v.a").agg(F.sum("v.n").alias("documents"))
    # Pairs of irregular groups only: counted before they move.
    irregular = texts.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("documents"))
    irregular = irregular.withColumn("a", F.shiftright("pair", 32).cast("int"))
    same, irregular = materialize(same, "same-counts"), materialize(irregular, "pair-counts")
    most = same.unionByName(irregular.select("a", "documents")).groupBy("a").agg(F.max("documents").alias("most"))
    # A row for each id of A at the most.
    most = F.broadcast(materialize(most, "best-counts"))
    best = (F.col("documents") == F.col("most")).alias("best")
    same = materialize(same.join(most, "a").select("a", "documents", best), "same-best")
    irregular = materialize(irregular.join(most, "a").select("pair", "documents", best), "pair-best")

    def summed(linked: DataFrame) -> DataFrame:
        of_best = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0))
        return linked.groupBy("row").agg(of_best.alias("n_best"), F.sum(F.col("times") * F.col("documents")).alias("count_sum"))

    met = texts.select("row", F.explode(F.arrays_zip(F.col("same").alias("a"), F.col("same_times").alias("times"))).alias("l"))
    by_map = summed(met.select("row", "l.*").join(F.broadcast(same), "a"))
    met = texts.select("row", F.explode(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))).alias("l"))
    by_pair = summed(lookup_join(met.select("row", "l.*"), irregular, "pair", "inner", "row", BROADCAST_PAIRS))
    both = by_map.unionByName(by_pair).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))

    zero = F.lit(0).cast("bigint")
    per_text = texts.select("row", "id", "n_a", "n_b", "n_groups", "n_links", "digest").join(both, "row", "left")
    per_text = per_text.select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), F.col("digest").alias("groups_sha256"),
    )
    spark = documents.sparkSession
    cut = _cut_of((byte_tokenizer, piece_tokenizer))
    ids = spark.createDataFrame([(i, int(b)) for i, b in enumerate(cut.same) if b >= 0], "a int, b bigint")
    pairs = same.join(F.broadcast(ids), "a").select(F.col("a").cast("bigint"), "b", "documents", "best").unionByName(
        irregular.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(PAIR - 1).alias("b"), "documents", "best")
    )
    return pairs, per_text
