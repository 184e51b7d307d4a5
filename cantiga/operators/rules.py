"""Keyword and length rules.

Matching ignores case, keeps accents and takes whole words. Anything that is not a
word character separates words, in the text and in the keyword.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cantiga.operators.skew import BROADCAST_ROWS, lookup_join, small
from cantiga.session import materialize

# Shortest and longest lyric kept, in characters.
MIN_LYRIC_CHARS = 100
MAX_LYRIC_CHARS = 4000

# Up to this many keywords become one pattern; a longer list is joined.
PATTERN_KEYWORDS = 20_000
# Up to this many keywords go to the tasks as hashes; in a longer list they are joined by a word.
BROADCAST_KEYWORDS = 2_000_000
# Keywords are looked for by their first words, one after the other up to this many, and then whole.
FIRST_WORDS = 3
# Bytes of text whose words are in memory at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
# Texts that are looked at to see which words are rare.
SAMPLE_TEXTS = 10_000


def word_form(col: Column) -> Column:
    """Lower-cased words with one space between and around them."""
    words = F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}_]+", " ")
    return F.concat(F.lit(" "), F.btrim(words), F.lit(" "))


def keywords_of(rules: DataFrame, scope: str) -> DataFrame:
    """The distinct keywords of a scope in word form."""
    form = F.btrim(word_form(F.col("keyword"))).alias("keyword")
    return rules.where(F.col("scope") == scope).select(form).where("keyword <> ''").distinct()


def _words(text: str) -> Column:
    """The words of a text in word form, in order; none of a null."""
    words = F.split(F.btrim(word_form(F.col(text))), " ")
    return F.coalesce(F.filter(words, lambda w: w != ""), F.array().cast("array<string>"))


def keyword_anchors(df: DataFrame, key: str, text: str, keywords: DataFrame) -> DataFrame:
    """``word, at, n, keyword``: the rarest word of each keyword, its place in it, and its length.

    How rare a word is comes from a sample of at most about ``SAMPLE_TEXTS`` texts; it decides
    how many places are looked at and never what is found.
    """
    step = max(1, df.count() // SAMPLE_TEXTS)
    sample = df.where(F.pmod(F.xxhash64(key), F.lit(step)) == 0).select(F.explode(_words(text)).alias("word"))
    placed = keywords.select("keyword", F.posexplode(F.split("keyword", " ")).alias("at", "word"))
    listed = placed.select("word").distinct()
    counts = sample.groupBy("word").agg(F.count("*").alias("seen")).join(listed, "word", "left_semi")
    ranked = placed.join(counts, "word", "left")
    # Of equally rare words the longest, then the first.
    rank = F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), (-F.length("word")).alias("short"), "at", "word")
    anchors = ranked.groupBy("keyword").agg(F.min(rank).alias("a"), F.count("*").cast("int").alias("n"))
    return anchors.select("a.word", "a.at", "n", "keyword")


class _Words:
    """The words of a block of texts in word form, and hashes of any run of them.

    A hash is a polynomial over the bytes of the run, modulo 2^64, from sums over the block.
    """

    _BASE = 0x9E3779B97F4A7C15
    _INVERSE = pow(_BASE, -1, 1 << 64)

    def __init__(self, forms: list[str]) -> None:
        raws = [form.encode() for form in forms]
        self.raw = b"".join(raws)
        data = np.frombuffer(self.raw, dtype=np.uint8)
        edges = np.flatnonzero(np.diff((data != 32).astype(np.int8), prepend=0, append=0))
        # A form ends in a space, so no word runs from one text into the next.
        self.starts, self.ends = edges[::2], edges[1::2]
        self.text = np.searchsorted(np.cumsum([len(raw) for raw in raws]), self.starts, side="right")
        powers = self._powers(self._BASE, len(data))
        self._sums = np.append(np.uint64(0), np.cumsum(data.astype(np.uint64) * powers))
        self._back = self._powers(self._INVERSE, len(data))

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        powers = np.full(n, base, dtype=np.uint64)
        powers[:1] = 1
        return np.cumprod(powers)

    def runs(self, first: np.ndarray, size: int) -> np.ndarray:
        """Those of the words ``first`` with ``size - 1`` more words of their text behind them."""
        first = first[first + size <= len(self.starts)]
        return first[self.text[first] == self.text[first + size - 1]]

    def hashes(self, first: np.ndarray, size: int) -> np.ndarray:
        start, end = self.starts[first], self.ends[first + size - 1]
        return (self._sums[end] - self._sums[start]) * self._back[start]

    def run(self, first: int, size: int) -> str:
        return self.raw[self.starts[first] : self.ends[first + size - 1]].decode()


def _blocks(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Parts of a column of texts with about ``BLOCK_BYTES`` each, and where they start."""
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, BLOCK_BYTES + (ends[at - 1] if at else 0), side="right")))
        yield at, column.slice(at, to - at).to_pylist()
        at = to


def _in_sorted(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(listed, values), len(listed) - 1)
    return listed[at] == values


def _hash_keywords(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``n, hash`` of each keyword, and of its first words with ``n`` from -1 on downwards."""
    for batch in batches:
        for _, keywords in _blocks(batch.column(0)):
            words = _Words([f" {keyword} " for keyword in keywords])
            first, counts = np.unique(words.text, return_index=True, return_counts=True)[1:]
            for n in np.unique(counts):
                own = first[counts == n]
                for size, sign in ((n, n), *((k, -k) for k in range(1, min(n - 1, FIRST_WORDS) + 1))):
                    found = np.unique(words.hashes(own, size)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), sign, dtype=np.int64)), pa.array(found)], ["n", "hash"])


def _listed_runs(df: DataFrame, key: str, text: str, keywords: DataFrame) -> DataFrame:
    """``key, keyword``: the runs of words whose hash is that of a keyword, once for each text.

    The hashes of the keywords, and of their first words, go to the tasks as sorted arrays. A run
    that begins like no keyword falls away after a word or two, and no word becomes a row.
    """
    found = keywords.select("keyword").mapInArrow(_hash_keywords, "n bigint, hash bigint").distinct().toArrow()
    n, hashes = found.column("n").to_numpy(), found.column("hash").to_numpy().view(np.uint64)
    spread = df.sparkSession.sparkContext.broadcast({int(k): np.sort(hashes[n == k]) for k in np.unique(n)})

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = spread.value
        for batch in batches:
            for at, forms in _blocks(batch.column(1)):
                words = _Words(forms)
                open_ = np.arange(len(words.starts))
                rows: list[np.ndarray] = []
                said: list[str] = []
                for size in range(1, max(listed, default=0) + 1):
                    if size > FIRST_WORDS and size not in listed:
                        continue
                    open_ = words.runs(open_, size)
                    hashes = words.hashes(open_, size)
                    if size in listed and len(open_):
                        hit = np.flatnonzero(_in_sorted(hashes, listed[size]))
                        # Once for each text and keyword.
                        once = np.unique(np.stack([words.text[open_[hit]].astype(np.uint64), hashes[hit]]), axis=1, return_index=True)[1]
                        hit = open_[hit[once]]
                        rows.append(words.text[hit])
                        said += [words.run(i, size) for i in hit]
                    if size <= FIRST_WORDS:
                        first = listed.get(-size)
                        open_ = open_[_in_sorted(hashes, first)] if first is not None else open_[:0]
                if said:
                    keys = batch.column(0).take(pa.array(np.concatenate(rows) + at))
                    yield pa.RecordBatch.from_arrays([keys, pa.array(said, pa.string())], [key, "keyword"])

    form = F.make_valid_utf8(F.coalesce(word_form(F.col(text)), F.lit("")))
    read = df.select(F.col(key), form.alias("_form"))
    schema = StructType([read.schema[0], StructField("keyword", StringType())])
    return read.mapInArrow(look, schema)


def matching_ids(
    df: DataFrame, key: str, text: str, keywords: DataFrame, limit: int = BROADCAST_KEYWORDS
) -> DataFrame:
    """Keys of the rows whose text holds any keyword, for lists of any length.

    Up to ``limit`` keywords are looked for by their hashes where the texts are, and what is
    found is compared with the keywords in a join. In a longer list every keyword is looked
    for by its rarest word, see ``matching_by_anchor``.
    """
    keywords = materialize(keywords.select("keyword"), "keywords")
    if not small(keywords, limit):
        return matching_by_anchor(df, key, text, keywords, min(limit, BROADCAST_ROWS))
    said = materialize(_listed_runs(df, key, text, keywords), "listed-runs")
    return lookup_join(said, keywords, "keyword", "left_semi", key).select(key).distinct()


def matching_by_anchor(df: DataFrame, key: str, text: str, keywords: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The same by the rarest word of each keyword.

    Words that are no anchor fall away in the scan; where an anchor stands, the run of words
    around it is compared. Anchors of one word need no comparison. A list beyond ``limit`` is
    joined with heavy words spread.
    """
    anchors = materialize(keyword_anchors(df, key, text, keywords), "keyword-anchors")
    words = df.select(F.col(key), _words(text).alias("_words"))
    placed = words.select(key, F.posexplode("_words").alias("_pos", "word"))
    met = lookup_join(placed, anchors, "word", "inner", key, limit).where(F.col("_pos") >= F.col("at"))
    run = F.struct((F.col("_pos") - F.col("at") + 1).alias("start"), "n", "keyword")
    # One row per text: whether a single word decides, and the runs to compare otherwise.
    runs = met.groupBy(key).agg(
        F.max(F.col("n") == 1).alias("_sure"), F.collect_set(F.when(F.col("n") > 1, run)).alias("_runs")
    )
    runs = materialize(runs, "keyword-runs")
    sure = runs.where("_sure").select(key)
    open_ = runs.where("not _sure").select(key, "_runs")
    there = words.join(F.broadcast(open_) if small(open_, limit) else open_, key)

    def said(run: Column) -> Column:
        return F.array_join(F.slice("_words", run["start"], run["n"]), " ") == run["keyword"]

    return sure.unionByName(there.where(F.exists("_runs", said)).select(key))


def _any_of(words: list[str]) -> str:
    """Pattern for any of the sorted words, shared beginnings written once.

    A word that begins with another one adds nothing to whether there is a match.
    """
    shared = os.path.commonprefix([words[0], words[-1]])
    if words[0] == shared:
        return re.escape(shared)
    branches = groupby(words, key=lambda word: word[len(shared)])
    tails = [_any_of([word[len(shared) :] for word in group]) for _, group in branches]
    return re.escape(shared) + "(?:" + "|".join(tails) + ")"


def exclude_keywords(
    df: DataFrame,
    rules: DataFrame,
    scope: str,
    key: str,
    text: str,
    pattern_keywords: int = PATTERN_KEYWORDS,
) -> DataFrame:
    """Drop the rows whose text holds a keyword of the scope. ``key`` is unique."""
    keywords = keywords_of(rules, scope)
    listed = [row[0] for row in keywords.limit(pattern_keywords + 1).collect()]
    if not listed:
        return df
    if len(listed) <= pattern_keywords:
        pattern = " " + _any_of(sorted(f"{keyword} " for keyword in listed))
        return df.where(~F.coalesce(word_form(F.col(text)).rlike(pattern), F.lit(False)))
    return df.join(matching_ids(df, key, text, keywords), key, "left_anti")


def within_length(
    col: Column, shortest: int = MIN_LYRIC_CHARS, longest: int = MAX_LYRIC_CHARS
) -> Column:
    return F.char_length(col).between(shortest, longest)
