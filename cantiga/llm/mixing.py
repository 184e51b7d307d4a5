"""Mix sources to target weights by pivotal dependent rounding.

A source's documents should be taken ``target / size`` times each. The whole part of that
is taken for certain; what is left is a probability per document, and pivotal rounding
turns the probabilities of a source into zeros and ones: two documents transfer mass, as
much as possible in a direction drawn at random, until one of them is decided, and the
other meets the next document. Mass is probability times words, so the words taken keep
their sum. The last undecided document of a source goes to the nearer side, so a source
misses its target by at most half a document. All others keep their probability in
expectation.

Documents are dealt into blocks of about ``BLOCK`` by a hash. Each block returns one
undecided document, and those are dealt into blocks again: a reduction tree of about
log(n) / log(BLOCK) levels. Draws are hashes of the documents, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantiga.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
BLOCK = 64
SEED = 11

_UNIT = "struct<doc_id:bigint,mark:bigint,size:bigint,p:double>"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, max_repeats: int = MAX_REPEATS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources in code-point order, null last, take the weights in turn and share the whole
    size. A target stops at ``max_repeats`` times its source; the excess goes to the others
    by weight. With sources in the order of (cap / weight), the capped ones come first, so
    one pass finds the level at which the rest share what is left. One row per source.
    """
    turn = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(turn, F.lit(len(weights))).cast("int") + 1)
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_repeats)
    rows = materialize(rows.withColumn("ratio", F.col("cap") / F.col("weight")), "mix-sources")
    total = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"), F.coalesce(F.sum("weight"), F.lit(0)).alias("w")).first()
    before = Window.orderBy("ratio", F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(total["all"]) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    share = left / (F.lit(total["w"]) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    level = rows.select("ratio", share.alias("share")).where("ratio > share").agg(F.min_by("share", "ratio")).first()[0]
    target = F.col("cap").cast("double")
    if level is not None:
        target = F.least(target, F.col("weight") * F.lit(float(level)))
    return rows.select("source", "source_size", target.alias("target"))


def _draw(a: Column, b: Column, level: int) -> Column:
    """A number in [0, 1) that depends on two units only."""
    drawn = F.xxhash64(a["mark"], b["mark"], a["size"], b["size"], F.lit(SEED + level))
    return F.pmod(drawn, F.lit(1 << 53)).cast("double") / float(1 << 53)


def _meet(state: Column, unit: Column, level: int) -> Column:
    """One step: the undecided unit of ``state`` meets ``unit``."""
    a = state["open"]
    mass_a, room_a = a["p"] * a["size"], (1 - a["p"]) * a["size"]
    mass_b, room_b = unit["p"] * unit["size"], (1 - unit["p"]) * unit["size"]
    up, down = F.least(room_a, mass_b), F.least(mass_a, room_b)
    rises = _draw(a, unit, level) * (up + down) < down
    # The smaller side decides; comparing masses avoids rounding it.
    p_a = F.when(rises, F.when(room_a <= mass_b, 1.0).otherwise(a["p"] + mass_b / a["size"])).otherwise(
        F.when(mass_a <= room_b, 0.0).otherwise(a["p"] - room_b / a["size"])
    )
    p_b = F.when(rises, F.when(room_a <= mass_b, unit["p"] - room_a / unit["size"]).otherwise(0.0)).otherwise(
        F.when(mass_a <= room_b, unit["p"] + mass_a / unit["size"]).otherwise(1.0)
    )

    def moved(x: Column, p: Column) -> Column:
        return F.struct(x["doc_id"].alias("doc_id"), x["mark"].alias("mark"), x["size"].alias("size"), p.alias("p"))

    a_done = (p_a <= 0.0) | (p_a >= 1.0)
    new_a, new_b = moved(a, p_a), moved(unit, p_b)
    met = F.when(
        a_done, F.struct(new_b.alias("open"), F.concat(state["done"], F.array(new_a)).alias("done"))
    ).otherwise(F.struct(new_a.alias("open"), F.concat(state["done"], F.array(new_b)).alias("done")))
    first = F.struct(unit.alias("open"), state["done"].alias("done"))
    return F.when(a.isNull(), first).otherwise(met)


def pivotal_round(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """Decide every unit: ``part, doc_id, mark, size, taken`` with ``taken`` 0 or 1.

    ``units`` has ``part`` (the units that share mass), ``doc_id, mark, size, p`` with
    positive sizes and 0 < p < 1. ``mark`` is a hash that deals and draws.
    """
    decided: DataFrame | None = None
    level = 0
    while True:
        units = materialize(units, f"mix-level-{level}")
        counts = units.groupBy("part").agg(F.ceil(F.count("*") / F.lit(block)).alias("blocks"))
        counts = materialize(counts, "mix-blocks")
        last = (counts.agg(F.max("blocks")).first()[0] or 0) <= 1
        unit = F.struct(F.xxhash64("mark", F.lit(level)).alias("h"), "doc_id", "mark", "size", "p")
        dealt = units.join(counts, "part").groupBy(
            "part", F.pmod(F.xxhash64("mark", F.lit(~level)), F.col("blocks")).alias("block")
        ).agg(F.sort_array(F.collect_list(unit)).alias("units"))
        ordered = F.transform("units", lambda u: F.struct(u["doc_id"].alias("doc_id"), u["mark"].alias("mark"), u["size"].alias("size"), u["p"].alias("p")))
        start = F.from_json(F.lit("{}"), f"open {_UNIT}, done array<{_UNIT}>")
        start = F.struct(start["open"].alias("open"), F.array().cast(f"array<{_UNIT}>").alias("done"))
        folded = dealt.select("part", F.aggregate(ordered, start, lambda s, u: _meet(s, u, level)).alias("s"))
        folded = materialize(folded, "mix-folded")
        done = folded.select("part", F.inline("s.done"))
        open_ = folded.where("s.open is not null").select("part", "s.open.*")
        if last:
            # One undecided document per source: to the nearer side, which halves the miss.
            done = done.unionByName(open_.withColumn("p", F.when(F.col("p") >= 0.5, 1.0).otherwise(0.0)))
        else:
            fixed = (F.col("p") <= 0.0) | (F.col("p") >= 1.0)
            done = done.unionByName(open_.where(fixed))
            units = open_.where(~fixed)
        done = done.select("part", "doc_id", "mark", "size", F.col("p").cast("int").alias("taken"))
        decided = done if decided is None else decided.unionByName(done)
        if last:
            return decided
        level += 1


def mix(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    max_repeats: int = MAX_REPEATS,
    weights: tuple[int, ...] = WEIGHTS,
) -> DataFrame:
    """How often each document is taken: ``doc_id, mark, size, source_size, target, copies, taken``.

    ``size`` counts words (null text: 0), ``taken`` is ``copies`` times ``size``. A source
    of null is a source of its own. Documents without a word are taken the whole part of
    their source's share. Rows may repeat and ids may be null: each row is a document.
    ``mark`` is a hash of the row's id, source and text, for joining back. Other columns
    are not read.
    """
    rows = documents.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        row_mark(F.col(id_col), F.col(text_col), F.col(source_col)).alias("mark"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
    )
    rows = materialize(rows, "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, max_repeats, weights)
    part = F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull())
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # A share this close to a whole number is one that a division has missed.
    whole = F.when(F.abs(share - F.round(share)) < 1e-9, F.round(share)).otherwise(F.floor(share))
    targets = targets.withColumn("part", part).withColumn("whole", whole.cast("bigint"))
    targets = materialize(targets.withColumn("p", F.greatest(share - F.col("whole"), F.lit(0.0))), "mix-targets")
    rows = rows.withColumn("part", part).join(targets.drop("source"), "part")
    rows = materialize(rows, "mix-shares")
    open_ = (F.col("p") > 1e-9) & (F.col("size") > 0)
    decided = pivotal_round(rows.where(open_).select("part", "doc_id", "mark", "size", "p"))
    mixed = decided.join(targets.select("part", "source_size", "target", "whole"), "part").unionByName(
        rows.where(~open_).select("part", "doc_id", "mark", "size", F.lit(0).alias("taken"), "source_size", "target", "whole")
    )
    copies = F.col("whole") + F.col("taken")
    return mixed.select(
        "doc_id", "mark", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def row_mark(doc_id: Column, text: Column, source: Column) -> Column:
    """A hash that tells rows apart; equal rows are interchangeable."""
    return F.xxhash64(doc_id, text, source, doc_id.isNull(), text.isNull(), source.isNull())
