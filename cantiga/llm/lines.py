"""Line dedup: delete later copies of runs of lines that repeat.

The corpus is a sequence of line ids, cut at document ends. Its suffix array is built by
prefix doubling: a suffix's rank is the number of suffixes before its group, groups agree in
their first ``k`` lines, and a round orders each group by the rank ``k`` lines further on, so
that groups agree in ``2 k`` lines. A line that occurs once ends every run, so only repeated
lines take part, and a group is done when it has one suffix or has reached an end.

A group of two or more suffixes at prefix length ``k`` is an interval of the array with a
longest common prefix of ``k`` or more. Every member but the earliest starts a later copy of
``k`` lines. A maximal repeated run of ``l`` lines is covered by the copies of the two
powers of two at its start and its end, which overlap; so the union of overlapping copies
is exactly the union of overlapping maximal runs, and that union is what is deleted.

Ranks are counted per pair of ranks before they are shuffled, so a line with a third of all
rows costs one row per follower, and the followers of a common line are numbered in parts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantiga.llm.mixing import word_count
from cantiga.session import materialize

# Runs with fewer words than this are left alone.
MIN_WORDS = 5
# Repeated lines of a bucket that is ordered in one piece, and ranks of one among followers.
BUCKET_ROWS = 1 << 16
# Documents with runs and runs that are broadcast: two or three numbers each, 32 MB at most.
BROADCAST_RUNS = 500_000

_PLACE = ["doc_id", "mark", "pos"]


def text_mark(doc_id: Column, text: Column) -> Column:
    """Tells apart rows that share an id or have none; equal rows are treated alike."""
    return F.xxhash64(doc_id, text, doc_id.isNull(), text.isNull())


def _lines(documents: DataFrame) -> DataFrame:
    """``doc_id, mark, pos, h1, h2, words`` for each line of ``doc_id, mark, text``."""
    each = documents.select("doc_id", "mark", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    # 64 bits, 32 other bits and the length: a name for the line.
    second = F.hash(F.col("line"), F.length("line"))
    return each.select(*_PLACE, F.xxhash64("line").alias("h1"), second.alias("h2"), word_count(F.col("line")).cast("int").alias("words"))


def _first_ranks(lines: DataFrame) -> DataFrame:
    """Ranks of the repeated lines: ``h1, h2, r, first``.

    Names are ordered in even buckets of their leading bits, moved up by the counts of the
    buckets before, so that no task orders all of them.
    """
    names = lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct(*_PLACE)).alias("first"))
    names = materialize(names.where("n > 1"), "repeated-lines")
    bits = max(1, (names.count() // BUCKET_ROWS).bit_length())
    names = names.withColumn("b", F.shiftrightunsigned("h1", 64 - bits))
    counts = names.groupBy("b").agg(F.sum("n").alias("all"))
    # One row per bucket: a few thousand at the most.
    before = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("b", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("b").orderBy("h1", "h2").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0)) + 1
    return names.join(F.broadcast(offsets), "b").select("h1", "h2", rank.alias("r"), "first")


def _follower_ranks(pairs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``pairs`` of ``r, r2`` that ``n`` suffixes have, with ``before``: suffixes of the same ``r`` and a smaller ``r2``.

    A rank with more followers than a bucket has them dealt by ranges of ``r2``, moved up by the
    counts of the ranges before, so that no task orders all followers of a common line.
    """
    pairs = materialize(pairs, "follower-pairs")
    # At most the pairs over ``bucket_rows``.
    hot = pairs.groupBy("r").agg(F.count("*").alias("followers")).where(F.col("followers") > bucket_rows)
    hot = F.broadcast(materialize(hot.select("r", F.lit(True).alias("hot")), "hot-ranks"))
    whole = F.floor(F.col("r2") / bucket_rows)
    dealt = pairs.join(hot, "r", "left").withColumn("part", F.when(F.col("hot"), whole).otherwise(F.lit(-1)))
    counts = dealt.where("hot").groupBy("r", "part").agg(F.sum("n").alias("all"))
    before = Window.partitionBy("r").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("r", "part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("r", "part").orderBy("r2").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    placed = placed.join(offsets, ["r", "part"], "left")
    moved = F.col("before") + F.coalesce("offset", F.lit(0))
    return placed.select(*pairs.columns, moved.alias("before"))


def suffix_ranks(lines: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The suffix array of the repeated lines, with the copies its intervals reveal.

    Gives ``doc_id, mark, pos, words, r, reach``: the suffix's rank, equal for suffixes
    that agree to their end, and how many lines from here on occurred earlier: the largest
    power of two, less where the run of repeated lines ends, or 0.
    """
    # Equal rows take their lines along twice; the copies are at one place.
    ranked = lines.join(_first_ranks(lines), ["h1", "h2"]).dropDuplicates(_PLACE)
    here = F.struct(*_PLACE)
    run = F.col("pos") - F.row_number().over(Window.partitionBy("doc_id", "mark").orderBy("pos"))
    state = ranked.select(
        *_PLACE, "words", run.alias("run"), "r", (here > F.col("first")).cast("int").alias("reach"), F.lit(True).alias("live")
    )
    whole = Window.partitionBy("doc_id", "mark", "run")
    state = state.withColumn("left", F.max("pos").over(whole) + 1 - F.col("pos"))
    state = materialize(state, "suffixes-1")
    # Finished suffixes are written once and only looked at by those before them.
    live, done, k = state.where("live"), [state.where("not live")], 1
    while live.limit(1).count():
        along = Window.partitionBy("doc_id", "mark", "run").orderBy("pos")
        seen = reduce(DataFrame.unionByName, done, live)
        seen = seen.withColumn("r2", F.coalesce(F.lead("r", k).over(along), F.lit(0))).where("live")
        seen = materialize(seen, f"suffix-pairs-{k}")
        pairs = seen.groupBy("r", "r2").agg(F.count("*").alias("n"), F.min(here).alias("first"))
        pairs = _follower_ranks(pairs, bucket_rows).select(
            "r", "r2", (F.col("r") + F.col("before")).alias("new"), "first",
            ((F.col("n") > 1) & (F.col("r2") > 0)).alias("still"),
        )
        later = F.col("still") & (here > F.col("first"))
        state = seen.join(pairs, ["r", "r2"]).select(
            *_PLACE, "words", "run", F.col("new").alias("r"),
            F.when(later, F.least(F.lit(2 * k), "left")).otherwise(F.col("reach")).alias("reach"),
            F.col("still").alias("live"), "left",
        )
        k *= 2
        state = materialize(state, f"suffixes-{k}")
        live = state.where("live")
        done.append(state.where("not live"))
    return reduce(DataFrame.unionByName, done).drop("run", "live", "left")


def repeated_runs(suffixes: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, mark, runs``: per document the runs to delete, as an array of ``start, end``.

    Copies that overlap form one run; runs under ``min_words`` words stay.
    """
    order = Window.partitionBy("doc_id", "mark").orderBy("pos")
    copies = suffixes.where("reach > 0")
    covered = F.max(F.col("pos") + F.col("reach")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce((F.col("pos") >= covered).cast("int"), F.lit(1))
    copies = copies.withColumn("_start", starts)
    copies = copies.withColumn("stretch", F.sum("_start").over(order))
    runs = copies.groupBy("doc_id", "mark", "stretch").agg(
        F.min("pos").alias("start"), (F.max("pos") + 1).alias("end"), F.sum("words").alias("words")
    )
    runs = runs.where(F.col("words") >= min_words).groupBy("doc_id", "mark")
    return runs.agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("runs"))


def _without(text: Column, runs: Column) -> Column:
    """The text's lines without the runs; linear in the lines."""
    lines = F.split(text, "\n")
    kept_from = F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["end"]))
    kept_to = F.concat(F.transform(runs, lambda r: r["start"]), F.array(F.size(lines)))
    pieces = F.zip_with(kept_from, kept_to, lambda a, b: F.slice(lines, a + 1, b - a))
    return F.array_join(F.flatten(pieces), "\n")


def dedup_lines(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """``documents`` with the later copies of repeated lines deleted from the text.

    Adds ``n_lines`` and ``n_deleted``. Earlier means a smaller id (none comes first), then
    the hash of id and text, then the line's place. Lines end at line breaks and are equal
    when all their characters are. A null text stays null with no line; an empty text is
    one empty line, too short to delete. Rows that are equal in id and text are treated as
    one: each gets the same result. Other columns are kept as they are.
    """
    clash = {"n_lines", "n_deleted"} & set(documents.columns)
    kept = documents.drop(*clash)
    own = kept.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    marked = own.select("doc_id", text_mark(F.col("doc_id"), F.col("text")).alias("mark"), "text")
    lines = materialize(_lines(marked), "lines")
    runs = materialize(repeated_runs(suffix_ranks(lines), min_words), "line-runs")
    rows, listed = runs.agg(F.count("*"), F.coalesce(F.sum(F.size("runs")), F.lit(0))).first()
    # The mark covers a null id as well.
    runs = runs.select("mark", "runs")
    mark = text_mark(F.col(id_col).cast("bigint"), F.col(text_col))
    # The caller's columns go in one struct, so that no name of theirs meets one of ours.
    whole = kept.select(F.struct(*kept.columns).alias("doc"), mark.alias("mark"))
    # Few runs go to the texts; many, and the texts, move once by the mark.
    few = rows + listed <= BROADCAST_RUNS
    joined = whole.join(F.broadcast(runs) if few else runs, "mark", "left")
    text = F.col("doc")[text_col]
    left = F.when(F.col("runs").isNull(), text).otherwise(_without(text, F.col("runs")))
    deleted = F.aggregate("runs", F.lit(0), lambda total, r: total + r["end"] - r["start"])
    return joined.select(
        *[(left if c == text_col else F.col("doc")[c]).alias(c) for c in kept.columns],
        F.coalesce(F.size(F.split(text, "\n")), F.lit(0)).alias("n_lines"),
        F.coalesce(deleted, F.lit(0)).alias("n_deleted"),
    )
