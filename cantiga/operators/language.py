"""Language detection by letter trigrams, trained from a labelled table.

Scores are whole numbers (log probabilities in millionths), so the order in which
Spark adds them up does not matter. Texts are cleaned by columns; the trigrams of a block of
texts are then counted or added up as arrays, so that no row is made of a trigram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cantiga.functions.text import clean_for_detection
from cantiga.operators.skew import lookup_join, salted_join, small
from cantiga.session import materialize

# A profile row holds one trigram and one number per language.
PROFILE_BROADCAST_ROWS = 500_000
# Bytes of text whose trigrams are in memory at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
# A trigram as a number: three code points of 21 bits.
_BITS = 21


def padded(cleaned: Column) -> Column:
    """The lower-cased text that trigrams are cut from.

    A space stands before and behind the text, so that its ends count as ends of words and a
    text of one or two characters has trigrams too. A text without any but spaces has none.
    """
    text = F.concat(F.lit(" "), F.lower(cleaned), F.lit(" "))
    return F.when(F.btrim(cleaned) != "", text).otherwise(F.substring(cleaned, 1, 0))


def trigrams(cleaned: Column) -> Column:
    """All overlapping trigrams of the lower-cased text, in one pass over it."""
    return F.regexp_extract_all(padded(cleaned), F.lit(r"(?s)(?=(...))."), 1)


def _prepared(text: str) -> Column:
    """What a task reads of a text: no null, and valid UTF-8."""
    return F.make_valid_utf8(F.coalesce(padded(clean_for_detection(F.col(text))), F.lit("")))


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts, the last column, have about ``BLOCK_BYTES`` each."""
    ends = np.cumsum(pc.binary_length(batch.column(batch.num_columns - 1)).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        size = BLOCK_BYTES + (ends[at - 1] if at else 0)
        to = max(at + 1, int(np.searchsorted(ends, size, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _gram_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams of all texts as numbers, one text after the other, and how many each text has."""
    points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = (points[:-2] << 2 * _BITS) | (points[1:-1] << _BITS) | points[2:]
    # A trigram does not run from one text into the next.
    ends = np.cumsum(sizes)
    inside = np.ones(len(points), dtype=bool)
    inside[np.maximum(ends - 2, ends - sizes)[sizes > 0]] = False
    inside[ends[sizes > 0] - 1] = False
    return codes[inside[: len(codes)]], np.maximum(sizes - 2, 0)


def _code(gram: str) -> int:
    first, second, third = map(ord, gram)
    return (first << 2 * _BITS) | (second << _BITS) | third


def _gram(code: Column) -> Column:
    """A trigram from its number. Cleaned text has no byte order mark, so none is taken for one."""
    points = [F.shiftright(code, shift).bitwiseAND((1 << _BITS) - 1) for shift in (2 * _BITS, _BITS, 0)]
    return F.decode(F.unhex(F.concat(*[F.lpad(F.hex(p), 8, "0") for p in points])), "UTF-32")


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, code, n`` of each block, from ``lang, text``."""
    names = ["lang", "code", "n"]
    for batch in batches:
        for block in _blocks(batch):
            found = block.column(0).dictionary_encode(null_encoding="encode")
            lang = found.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(lang, kind="stable")
            codes, sizes = _gram_codes(block.column(1).take(pa.array(order)))
            per_lang = np.bincount(lang[order], weights=sizes, minlength=len(found.dictionary)).astype(np.int64)
            for i, own in enumerate(np.split(codes, np.cumsum(per_lang)[:-1])):
                code, n = np.unique(own, return_counts=True)
                name = found.dictionary.take(pa.array(np.full(len(code), i)))
                yield pa.RecordBatch.from_arrays([name, pa.array(code), pa.array(n.astype(np.int64))], names)


def _millionths(probability: Column) -> Column:
    return F.round(F.log(probability) * 1_000_000).cast("bigint")


def lang_profile(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Trigram profile per language: ``lang, gram, n, logp, default_logp``.

    Add-one smoothing over the vocabulary of all languages. ``default_logp`` is what a
    trigram the language never showed scores.
    """
    texts = labelled.select(F.col(lang).alias("lang"), _prepared(text).alias("text"))
    schema = StructType([texts.schema[0], StructField("code", LongType()), StructField("n", LongType())])
    counted = texts.mapInArrow(_count_grams, schema)
    counts = counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    counts = materialize(counts.select("lang", _gram(F.col("code")).alias("gram"), "n"), "gram-counts")
    vocabulary = counts.agg(F.count_distinct("gram").alias("v"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    size = F.col("total") + vocabulary.scalar()
    return (
        lookup_join(counts, totals, "lang", "inner", "gram")
        .withColumn("logp", _millionths((F.col("n") + 1) / size))
        .withColumn("default_logp", _millionths(F.lit(1) / size))
        .select("lang", "gram", "n", "logp", "default_logp")
    )


def _text_sums(texts: DataFrame, wide: DataFrame, n_langs: int, key: str, text: str) -> DataFrame:
    """``key, grams, gain_0, ...``: trigrams of each key and what they add up to per language.

    ``wide`` is small: it goes to the tasks as one sorted array of trigrams and one of gains per
    language, 0 for a trigram that the language or the profile never showed.
    """
    gains = [f"gain_{i}" for i in range(n_langs)]
    # Trigrams are distinct and at most ``PROFILE_BROADCAST_ROWS`` come to the driver.
    listed = wide.where(F.char_length("gram") == 3).select("gram", *gains).toArrow()
    codes = np.array([_code(gram) for gram in listed.column("gram").to_pylist()], dtype=np.int64)
    order = np.argsort(codes)
    values = [pc.fill_null(listed.column(gain), 0).to_numpy()[order] for gain in gains]
    spread = texts.sparkSession.sparkContext.broadcast((codes[order], [np.append(v, 0) for v in values]))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, values = spread.value
        for batch in batches:
            for block in _blocks(batch):
                codes, sizes = _gram_codes(block.column(1))
                if not len(codes):
                    continue
                at = np.searchsorted(known, codes)
                met = at < len(known)
                met[met] = known[at[met]] == codes[met]
                at[~met] = len(known)
                full = sizes > 0
                first = np.cumsum(sizes[full]) - sizes[full]
                sums = [np.add.reduceat(v[at], first) for v in values]
                keys = block.column(0).filter(pa.array(full))
                yield pa.RecordBatch.from_arrays([keys, *map(pa.array, (sizes[full], *sums))], [key, "grams", *gains])

    read = texts.select(F.col(key), _prepared(text).alias("_text"))
    schema = StructType([read.schema[0], *(StructField(c, LongType()) for c in ("grams", *gains))])
    added = read.mapInArrow(add_up, schema)
    return added.groupBy(key).agg(*[F.sum(c).alias(c) for c in ("grams", *gains)])


def lang_scores(
    texts: DataFrame,
    profile: DataFrame,
    langs: list[str],
    key: str,
    text: str,
    broadcast_rows: int = PROFILE_BROADCAST_ROWS,
) -> DataFrame:
    """Score of every language for every text with at least one trigram.

    With a profile small enough to broadcast, trigrams are looked up in a sorted array where
    they are made and added up per text: a text is one row from the start, and that row moves.
    A larger profile joins counted trigrams instead, common ones salted.
    """
    gains = [
        F.max(F.when(F.col("lang") == lang, F.col("logp") - F.col("default_logp"))).alias(
            f"gain_{i}"
        )
        for i, lang in enumerate(langs)
    ]
    wide = profile.where(F.col("lang").isin(langs)).groupBy("gram").agg(*gains)
    wide = materialize(wide, "profile")
    defaults = profile.groupBy("lang").agg(F.max("default_logp").alias("d"))
    if small(wide, broadcast_rows):
        sums = _text_sums(texts, wide, len(langs), key, text)
    else:
        grams = texts.select(
            F.col(key),
            F.explode(trigrams(clean_for_detection(F.col(text)))).alias("gram"),
        )
        counted = grams.groupBy(key, "gram").agg(F.count("*").alias("n"))
        joined = salted_join(materialize(counted, "text-grams"), wide, "gram", "left", key)
        sums = joined.groupBy(key).agg(
            F.sum("n").alias("grams"),
            *[
                F.sum(F.coalesce(F.col(f"gain_{i}") * F.col("n"), F.lit(0))).alias(f"gain_{i}")
                for i in range(len(langs))
            ],
        )
    scores = [
        (
            F.col(f"gain_{i}")
            + F.col("grams") * defaults.where(F.col("lang") == lang).select("d").scalar()
        ).alias(f"score_{i}")
        for i, lang in enumerate(langs)
    ]
    return sums.select(key, "grams", *scores)


def detect_language(
    texts: DataFrame, profile: DataFrame, langs: list[str], key: str, text: str
) -> DataFrame:
    """Best language of each text: ``key, lang, score``.

    Texts left empty after cleaning have no row. On equal scores the last
    language in alphabetical order wins.
    """
    scores = lang_scores(texts, profile, langs, key, text)
    best = F.greatest(
        *[
            F.struct(F.col(f"score_{i}").alias("score"), F.lit(lang).alias("lang"))
            for i, lang in enumerate(langs)
        ]
    )
    return scores.select(key, best.alias("_best")).select(key, "_best.lang", "_best.score")


def filter_language(
    texts: DataFrame, profile: DataFrame, langs: list[str], target: str, key: str, text: str
) -> DataFrame:
    """Keep texts in the target language. ``key`` must be unique, so nothing is skewed."""
    keep = detect_language(texts, profile, langs, key, text).where(F.col("lang") == target)
    return texts.join(keep.select(key), key, "left_semi")
