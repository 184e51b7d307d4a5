"""Pack tokenised documents into sequences of near-equal length.

A document's ids, closed by one end id, are cut into pieces: full sequences first, the rest
into pieces of at most ``CUT`` ids. Full pieces are sequences of their own. The others are
dealt by a hash into groups of about ``GROUP`` pieces, and each group is split into windows
by Karmarkar-Karp differencing: every piece starts as a partial partition with one filled
window; the two partitions with the largest imbalance are merged, fullest windows with
emptiest, until one is left. When its fullest window exceeds the capacity, the group is
split again into one more window.

Ids are only counted and checksummed: a piece can be cut again from its document.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
import zlib
from array import array
from itertools import chain
from string import punctuation

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantiga.session import materialize

CAPACITY = 2048
CUT = 512
GROUP = 1024
END_ID = 1
# Words whose ids a worker remembers before it lets go of those not met since, and bytes of
# text it looks at together.
MEMORY = 600_000
# Words of more pre-tokens than this are not remembered.
JUNK = 3
AT_ONCE = 1 << 20
# Sequence numbers kept for a group; a group has far fewer pieces.
_MOST_WINDOWS = 1 << 24
_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


# Fixed value: how the tokenizer cuts a text, once it is normalised by these steps.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALISED = ["NFC", "Replace", "Lowercase"]


def _class(kind: str) -> str:
    """Characters of a Unicode class among the settled ones, as the body of a regex class."""
    return "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == kind)


# Characters that no version of Unicode puts into another class and no normal form changes,
# and whose lower case is one of them.
_SMALL = "".join(re.escape(chr(c)) for c in range(0x250) if max(chr(c).lower()) < chr(0x250) and len(chr(c).lower()) == 1)
_SETTLED = re.compile(f"[{_SMALL}\u2010-\u2027\u20ac]*")
_SPACE = r"\t-\r \x85\xa0"
_PRETOKEN = re.compile(
    PRETOKENS.replace(r"[^\s\p{L}\p{N}]", f"[^{_SPACE}{_class('L')}{_class('N')}]")
    .replace(r"[\p{L}]", f"[{_class('L')}]")
    .replace(r"[\p{N}]", f"[{_class('N')}]")
)


class WordTokenizer:
    """Ids of texts by a tokenizer that never joins what ASCII white space parts.

    For such a tokenizer a text's ids are those of its words in order, so the ids of a word
    are asked for once and remembered. Words are cut further into the tokenizer's own
    pre-tokens where these are known, and pre-tokens are asked for many at a time: their ends
    show in the ids, as the last piece of each has the word-end suffix. Junk is mostly new
    words, but of few pre-tokens. Only upper and lower case of A-Z is folded, for tokenizers
    that lower-case.

    Memory is kept in two generations: when one is full, the one before is forgotten, and
    what is met again goes into the new one.
    """

    def __init__(self, path: str, memory: int = MEMORY) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memory = memory
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.older: tuple[dict[bytes, bytes], dict[str, bytes]] = ({}, {})
        suffix = "</w>"
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.folds = self.whole("A b") == self.whole("a B")
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cuts = _cuts_as_known(path)

    def whole(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit numbers, asked for directly."""
        return _pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def ids(self, texts: list[bytes]) -> list[bytes]:
        for kind, memory in enumerate((self.known, self.parts)):
            if len(memory) > self.memory:
                self.older[kind].clear()
                self.older[kind].update(memory)
                memory.clear()
        plain = [not any(s in t for s in self.special) for t in texts]
        # A letter and a combining mark (these start with one byte) may be one character in one case only.
        words = [(t.lower() if self.folds and b"\xcc" not in t else t).split() if p else [] for t, p in zip(texts, plain, strict=True)]
        known, older = self.known, self.older[0]
        new = set(chain.from_iterable(words)).difference(known)
        known.update((w, older[w]) for w in new if w in older)
        junk = self._learn([w for w in new if w not in older])
        found = [
            b"".join(map(known.__getitem__, ws)) if p else self.whole(t.decode("utf-8", "replace"))
            for t, ws, p in zip(texts, words, plain, strict=True)
        ]
        for word in junk:
            del known[word]
        return found

    def _learn(self, words: list[bytes]) -> list[bytes]:
        """Cut each word into what can be asked for together, or leave it whole.

        Gives the words of many pre-tokens, which are seldom met again and not remembered.
        """
        texts = [word.decode("utf-8", "replace") for word in words]
        settled, cut = (_SETTLED.fullmatch if self.cuts else lambda t: None), _PRETOKEN.findall
        split = [cut(t.lower()) if settled(t) else self._letters_apart(t) for t in texts]
        parts, older = self.parts, self.older[1]
        new = set(chain.from_iterable(split)).difference(parts)
        parts.update((p, older[p]) for p in new if p in older)
        new = sorted(p for p in new if p not in older)
        # A letter whose lower case is more than letters would join with what follows.
        together = [p for p in new if settled(p) or p.lower().isalpha()]
        for at in range(0, len(together), 4096):
            self._ask_together(together[at : at + 4096])
        self._ask_each([p for p in new if p not in parts])
        known, part = self.known, parts.__getitem__
        for word, pieces in zip(words, split, strict=True):
            known[word] = b"".join(map(part, pieces))
        return [word for word, pieces in zip(words, split, strict=True) if len(pieces) > JUNK]

    @staticmethod
    def _letters_apart(text: str) -> list[str]:
        """Letters and the ASCII marks behind them, where a word is that."""
        core = text.rstrip(punctuation)
        return [p for p in (core, text[len(core) :]) if p] if core.lower().isalpha() else [text]

    def _ask_together(self, words: list[str]) -> None:
        packed = self.whole(" ".join(words))
        ends = np.flatnonzero(self.ends[np.frombuffer(packed, dtype="<u4")]) + 1
        if len(ends) != len(words):  # some word is more than one piece to this tokenizer
            self._ask_each(words)
            return
        start = 0
        for word, end in zip(words, (4 * ends).tolist(), strict=True):
            self.parts[word] = packed[start:end]
            start = end

    def _ask_each(self, words: list[str]) -> None:
        for word, found in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True):
            self.parts[word] = _pack(found.ids)


def _cuts_as_known(path: str) -> bool:
    """Whether the tokenizer file cuts texts by ``PRETOKENS`` after the known normalisation."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    steps = (described.get("normalizer") or {}).get("normalizers") or []
    cuts = ((described.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    return [s["type"] for s in steps] == NORMALISED and (cuts.get("pattern") or {}).get("Regex") == PRETOKENS


def _pack(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    """One per worker process, so that its memory outlives a task."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def cut(tokens: int, capacity: int = CAPACITY, piece: int = CUT) -> list[tuple[int, int]]:
    """``start, length`` of the pieces of a document of ``tokens`` ids."""
    full = tokens // capacity * capacity
    out = [(at, capacity) for at in range(0, full, capacity)]
    return out + [(at, min(piece, tokens - at)) for at in range(full, tokens, piece)]


def pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, piece: int = CUT) -> DataFrame:
    """The pieces of ``doc_id, text`` (bytes) with the CRC-32 of their ids."""

    def read(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = _tokenizer(tokenizer)
        end = _pack([END_ID])
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            at = 0
            while at < len(doc_ids):
                some: list[bytes] = []
                size = 0
                while at + len(some) < len(doc_ids) and (not some or size < AT_ONCE):
                    some.append(texts[at + len(some)].as_py() or b"")
                    size += len(some[-1])
                rows: list[tuple] = []
                for doc_id, ids in zip(doc_ids[at : at + len(some)], words.ids(some), strict=True):
                    ids += end
                    tokens = len(ids) // 4
                    for start, length in cut(tokens, capacity, piece):
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        rows.append((doc_id, start, length, crc, tokens))
                columns = zip(*rows, strict=True)
                names = [f.split()[0] for f in _PIECES.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
                at += len(some)

    return documents.mapInArrow(read, _PIECES)


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: the items of each of ``windows`` windows of near-equal sums."""
    left, right = array("q", [-1] * len(sizes)), array("q", [-1] * len(sizes))
    heap = []
    for item, size in enumerate(sizes):
        sums, nodes = np.zeros(windows, dtype=np.int64), np.full(windows, -1, dtype=np.int64)
        sums[0], nodes[0] = size, item
        heap.append((-size, item, sums, nodes))
    heapq.heapify(heap)
    turn = len(sizes)
    while len(heap) > 1:
        (_, _, a_sums, a), (_, _, b_sums, b) = heapq.heappop(heap), heapq.heappop(heap)
        sums, b = a_sums + b_sums[::-1], b[::-1]
        both = (a >= 0) & (b >= 0)
        nodes = np.where(a >= 0, a, b)
        nodes[both] = len(left) + np.arange(both.sum())
        left.extend(a[both].tolist())
        right.extend(b[both].tolist())
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        sums -= sums[-1]
        heapq.heappush(heap, (-int(sums[0]), turn, sums, nodes))
        turn += 1
    out = []
    for root in heap[0][3].tolist() if heap else []:
        items, stack = [], [root] if root >= 0 else []
        while stack:
            node = stack.pop()
            if left[node] < 0:
                items.append(node)
            else:
                stack += (left[node], right[node])
        out.append(items)
    return out


def pack_group(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows of at most ``capacity``; one more is tried while the fullest exceeds it."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        out = difference(sizes, windows)
        if max((sum(sizes[i] for i in items) for items in out), default=0) <= capacity:
            return [items for items in out if items]
        windows += 1


def pack(
    documents: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    piece: int = CUT,
    group: int = GROUP,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``tokenizer`` is the path of a tokenizer file that every executor has. A null or empty
    text is one end id. Rows may repeat and ids may be null: each row is packed by itself.
    Other columns are not read.
    """
    rows = documents.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text")
    )
    cut_ = pieces(rows, tokenizer, capacity, piece).withColumn("row", F.monotonically_increasing_id())
    cut_ = materialize(cut_, "pieces")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    full = cut_.where(F.col("length") == capacity).select(
        *columns, (F.col("row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    rest = cut_.where(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group))
    dealt = rest.withColumn("group", F.pmod(F.xxhash64("row", "ids_crc32"), F.lit(groups)))

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["row"], ignore_index=True)
        sizes = rows["length"].tolist()
        windows = pack_group(sizes, capacity)
        number = int(rows["group"].iloc[0])
        order, ids, offsets = [], [], []
        for i, items in enumerate(windows):
            at = 0
            for item in sorted(items):
                order.append(item)
                ids.append(2 * (number * _MOST_WINDOWS + i))
                offsets.append(at)
                at += sizes[item]
        return rows.iloc[order][columns].assign(sequence_id=ids, offset=offsets)

    packed = dealt.groupBy("group").applyInPandas(fill, f"{_PIECES}, sequence_id bigint, offset bigint")
    return full.unionByName(packed)
