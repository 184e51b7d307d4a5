"""Benchmark passages in training texts: found word by word, and removed.

Both sides are cut into normalised words. The benchmark gives its windows of ``WINDOW`` words
(an item with fewer words is one window), as a set of hashes that is broadcast after its size
is checked; a larger set is joined with hot hashes spread. A document gives the hash of every
window it has, and only those that the set holds go on, with the words they should be. The
texts of these few documents are read once more, and each hit is compared word by word.

What is found depends on the text alone, so equal texts are settled once.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantiga.operators.skew import lookup_join, salted_join, small
from cantiga.session import materialize

# A word is a run of letters, digits and characters beyond ASCII. In lower-cased
# text that is ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``; this finds the same runs in the text as it is.
# Java takes ten times as long for the ranges that are left out as for those that are meant.
ANY_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
WINDOW = 10
# Windows whose hashes and words are broadcast, and the bytes of those words.
BROADCAST_WINDOWS, BROADCAST_BYTES = 500_000, 64 << 20
# Found texts whose hits are broadcast to the documents: a digest and a few numbers each.
BROADCAST_TEXTS = 200_000


def lower_ascii(text: Column) -> Column:
    """A to Z lower-cased, all else as it is. Plain ASCII takes the short way."""
    folded = F.translate(text, ascii_uppercase, ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(folded)


def runs(text: Column) -> Column:
    """The words of a text as they stand there, in order; none of a null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(ANY_WORD), 0), F.array().cast("array<string>"))


def words(text: Column) -> Column:
    """The normalised words of a text, in order; none of a null.

    They are lower-cased one by one: most are plain ASCII, also where the text is not.
    """
    return F.transform(runs(text), lower_ascii)


def _starts(count: Column, size: Column | int) -> Column:
    """The places where a window of ``size`` words starts; none in shorter texts."""
    size = F.lit(size) if isinstance(size, int) else size
    return F.when(count >= size, F.sequence(F.lit(1), count - size + 1)).otherwise(F.array().cast("array<int>"))


def text_digest(text: Column) -> Column:
    """Tells texts apart; a null is an empty text, as neither has a word."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _fits(grams: DataFrame) -> bool:
    """Whether windows fit a broadcast, by their number and their bytes."""
    rows, size = grams.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("gram")), F.lit(0))).first()
    return rows <= BROADCAST_WINDOWS and size <= BROADCAST_BYTES


def item_windows(items: DataFrame, item_id: str, text: str, window: int = WINDOW) -> DataFrame:
    """Distinct ``item_id, n, gram, key``: the windows of each item, their words and their hash."""
    cut = items.select(F.col(item_id).cast("string").alias("item_id"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    sized = cut.withColumn("n", F.least(F.size("w"), F.lit(window)))
    grams = F.transform(_starts(F.size("w"), F.col("n")), lambda i: F.slice(F.col("w"), i, F.col("n")))
    exploded = sized.select("item_id", "n", F.explode(grams).alias("gram"))
    key = F.xxhash64(F.transform("gram", lambda w: F.xxhash64(w)))
    return exploded.select("item_id", "n", F.array_join("gram", " ").alias("gram"), key.alias("key")).distinct()


def _window_keys(hashes: Column, count: Column, sizes: list[int]) -> Column:
    """``struct(pos, n, key)`` of every window of the sizes, from the hashes of the words."""

    def of_size(size: int) -> Column:
        return F.transform(
            _starts(count, size),
            lambda i: F.struct(i.alias("pos"), F.lit(size).alias("n"), F.xxhash64(F.slice(hashes, i, size)).alias("key")),
        )

    return F.concat(*[of_size(size) for size in sizes])


def _candidates(texts: DataFrame, grams: DataFrame, sizes: list[int]) -> DataFrame:
    """``digest, hits``: texts with windows whose hash is in the set, and the words each should have."""
    hashes = F.transform(words(F.col("text")), lambda w: F.xxhash64(w))
    cut = texts.select("digest", hashes.alias("h"))
    keyed = cut.select("digest", F.explode(_window_keys(F.col("h"), F.size("h"), sizes)).alias("w"))
    keyed = keyed.select("digest", "w.pos", "w.n", "w.key")
    listed = grams.select("n", "key", "gram").distinct()
    if _fits(listed):
        met = keyed.join(F.broadcast(listed), ["n", "key"])
    else:
        listed = listed.groupBy("key", "n").agg(F.collect_set("gram").alias("grams"))
        met = salted_join(keyed, listed.withColumnRenamed("n", "_n"), "key", "inner", "digest")
        met = met.where(F.col("n") == F.col("_n")).withColumn("gram", F.explode("grams"))
    # Copies of a text fold before they move.
    return met.groupBy("digest").agg(F.collect_set(F.struct("pos", "n", "gram")).alias("hits"))


def _merged(hits: Column) -> Column:
    """Disjoint ``struct(first, last)`` of word places, from sorted hits with ``pos`` and ``n``."""

    def add(spans: Column, hit: Column) -> Column:
        last = F.try_element_at(spans, F.lit(-1))
        end = hit["pos"] + hit["n"] - 1
        longer = F.struct(last["first"].alias("first"), F.greatest(last["last"], end).alias("last"))
        joined = F.concat(F.slice(spans, 1, F.greatest(F.size(spans) - 1, F.lit(0))), F.array(longer))
        new = F.concat(spans, F.array(F.struct(hit["pos"].alias("first"), end.alias("last"))))
        return F.when((F.size(spans) > 0) & (last["last"] >= hit["pos"]), joined).otherwise(new)

    return F.aggregate(hits, F.array().cast("array<struct<first:int,last:int>>"), add)


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per distinct text with a benchmark window: ``digest, spans, items``.

    ``spans`` are the disjoint runs of hit words, ``first`` to ``last`` counted from 1;
    ``items`` are the ids of the items with a window in the text, as strings in order. Items
    without an id hit words and are not listed.
    """
    found = materialize(item_windows(benchmark, item_col, item_text_col, window), "benchmark-windows")
    # As many as a window has words, at the most.
    sizes = sorted(row["n"] for row in found.select("n").distinct().collect())
    texts = documents.select(text_digest(F.col(text_col)).alias("digest"), F.col(text_col).alias("text"))
    if not sizes:
        return documents.sparkSession.createDataFrame([], "digest string, spans array<struct<first:int,last:int>>, items array<string>")
    met = materialize(_candidates(texts, found, sizes), "leak-candidates")

    # The texts themselves settle what the hashes found.
    asked = F.broadcast(met.select("digest")) if small(met, BROADCAST_TEXTS) else met.select("digest")
    named = texts.join(asked, "digest", "left_semi").select("digest", words(F.col("text")).alias("w"))
    named = named.dropDuplicates(["digest"]).join(met, "digest")

    def said(hit: Column) -> Column:
        return F.array_join(F.slice("w", hit["pos"], hit["n"]), " ") == hit["gram"]

    checked = named.select("digest", F.array_sort(F.filter("hits", said)).alias("hits")).where(F.size("hits") > 0)
    checked = materialize(checked, "leaks")

    held = checked.select("digest", F.explode(F.array_distinct(F.transform("hits", lambda h: h["gram"]))).alias("gram"))
    owners = found.where("item_id IS NOT NULL").select("gram", "item_id")
    if _fits(owners):
        owned = held.join(F.broadcast(owners), "gram")
    else:
        owned = salted_join(held, owners.groupBy("gram").agg(F.collect_set("item_id").alias("ids")), "gram", "inner", "digest")
        owned = owned.withColumn("item_id", F.explode("ids"))
    items = owned.groupBy("digest").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    spans = checked.select("digest", _merged(F.col("hits")).alias("spans"))
    none = F.array().cast("array<string>")
    return spans.join(items, "digest", "left").select("digest", "spans", F.coalesce("items", none).alias("items"))


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words of the spans and what stands between them."""
    between = F.split(text, ANY_WORD, -1)
    found = F.regexp_extract_all(text, F.lit(ANY_WORD), 0)
    # What stands before a word, and the word; at the end what stands after the last one.
    empty = F.lit("")
    pieces = F.flatten(F.zip_with(between, found, lambda gap, word: F.array(F.coalesce(gap, empty), F.coalesce(word, empty))))

    def kept(pieces: Column) -> Column:
        # Word i is piece 2 * i. Kept are the pieces from behind one span to before the next.
        start = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: 2 * s["last"]))
        stop = F.concat(F.transform(spans, lambda s: 2 * s["first"]), F.array(F.size(pieces) + 1))
        return F.array_join(F.zip_with(start, stop, lambda a, b: F.array_join(F.slice(pieces, a + 1, b - a - 1), "")), "")

    return F.transform(F.array(pieces), kept)[0]


def _with_leaks(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` (``digest, n_words`` and more) with ``leak``; null ``spans`` where nothing was hit."""
    found = materialize(found, "leak-spans")
    rows = rows.withColumn("at", F.monotonically_increasing_id())
    rows = lookup_join(rows, found, "digest", "left", "at", BROADCAST_TEXTS)
    hit = F.aggregate("spans", F.lit(0), lambda total, s: total + s["last"] - s["first"] + 1)
    leak = F.struct(
        F.col("n_words").cast("bigint").alias("n_words"),
        F.coalesce(hit, F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<first:int,last:int>>")).alias("spans"),
    )
    return rows.withColumn("leak", leak)


def leak_report(
    documents: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per document: its id, ``n_words, n_hit, items, spans``. Texts are not carried.

    ``n_hit`` words are inside a benchmark window; see ``decontaminate`` for odd input.
    """
    found = find_leaks(documents, benchmark, text_col, item_col, item_text_col, window)
    text = F.col(text_col)
    rows = documents.select(F.col(id_col).alias("id"), text_digest(text).alias("digest"), F.size(runs(text)).alias("n_words"))
    return _with_leaks(rows, found).select(F.col("id").alias(id_col), "leak.*")


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    remove: str = "spans",
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """``documents`` with ``leak``: ``struct(n_words, n_hit, items, spans)``, and hit words removed.

    ``remove`` is ``"spans"`` (hit words go from the text), ``"documents"`` (documents with a
    hit go) or ``"nothing"``. All other columns stay as they are; where one is named ``leak``
    already, ours gets underscores before it. A null or empty text, or one without a word, has
    no hit and stays. Equal rows are treated alike, ids may repeat or be null. An empty
    benchmark hits nothing, and items without a word have no window.
    """
    if remove not in ("spans", "documents", "nothing"):
        raise ValueError('remove must be "spans", "documents" or "nothing"')
    found = find_leaks(documents, benchmark, text_col, item_col, item_text_col, window)
    text = F.col(text_col)
    # The caller's columns go in one struct, so that no name of theirs meets one of ours.
    rows = documents.select(
        F.struct(*documents.columns).alias("row"), text_digest(text).alias("digest"), F.size(runs(text)).alias("n_words")
    )
    rows = _with_leaks(rows, found)
    if remove == "documents":
        rows = rows.where(F.col("spans").isNull())
    text = F.col("row")[text_col]
    cleaned = F.when(F.col("spans").isNull(), text).otherwise(without_spans(text, F.col("spans")))
    columns = [(cleaned if remove == "spans" and c == text_col else F.col("row")[c]).alias(c) for c in documents.columns]
    name = "leak"
    while name in documents.columns:
        name = f"_{name}"
    return rows.select(*columns, F.col("leak").alias(name))
