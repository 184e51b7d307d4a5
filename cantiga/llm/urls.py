"""URL filter: path rules first, then the ratio of two character language models.

URLs that a rule decides train two smoothed Markov models of variable order, one of
accepted and one of rejected URLs. Each order is interpolated with the one below it by how
many different characters follow a context (Witten-Bell), so a context is used as far as it
was seen. A URL without a rule is judged by its log-likelihood difference per character
against a threshold calibrated on rule-decided URLs kept out of training. The models read
whole URLs: scheme, host (A-Z lower-cased), path, query and fragment.

Everything is columns, joins and aggregations. Equal URLs count once. Counts are folded at the
highest order before they are spread over the lower ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantiga.session import materialize

ORDER = 5
# One text in five that a rule decides is kept for the threshold.
CALIBRATION = 5
# A URL with more rows than this gets its score in as many parts as have this many rows each.
HOT_ROWS = 1_000_000
# Scores are folded into steps of this size to find the threshold.
STEP = 0.01
_START, _END = "\u0001", "\u0002"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """``verdict`` (allow or block) for a host with its subdomains and a path prefix."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def whole_url(url: Column) -> Column:
    """All of the URL with its host lower-cased; a null is empty, and one without ``://`` stays as it is."""
    given = F.coalesce(url, F.lit(""))
    front, host = F.regexp_extract(given, "(?s)^(.*?://)", 1), host_of(given)
    rest = F.substring(given, F.length(front) + F.length(host) + 1, F.length(given))
    return F.when(front == "", given).otherwise(F.concat(front, host, rest))


def rule_for(host: Column, path: Column, rules: list[UrlRule], field: str) -> Column:
    """``field`` of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(getattr(rule, field))).otherwise(out)
    return out


def _events(texts: DataFrame, order: int, *keep: str) -> DataFrame:
    """A row per character and one for the end: ``context`` (``order`` long) and ``sym``."""
    padded = F.concat(F.lit(_START * order), F.col("text"), F.lit(_END))
    chars = F.filter(F.split(padded, ""), lambda c: c != "")
    rows = texts.withColumn("_chars", chars)
    each = F.transform(
        F.sequence(F.lit(1), F.size("_chars") - order),
        lambda i: F.struct(
            F.array_join(F.slice(F.col("_chars"), i, order), "").alias("context"),
            F.element_at(F.col("_chars"), i + order).alias("sym"),
        ),
    )
    return rows.select(*keep, F.inline(each))


def train(texts: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """Counts of accepted (``a``) and rejected (``r``) texts, from ``text, accepted``.

    The first table has ``k, c, sym, a, r`` for a context ``c`` of ``k`` characters; the
    second ``k, c, a_all, r_all, a_kinds, r_kinds``.
    """
    longest = _events(texts, order, "accepted").groupBy("context", "sym").agg(
        F.count(F.when(F.col("accepted"), 1)).alias("a"),
        F.count(F.when(~F.col("accepted"), 1)).alias("r"),
    )
    longest = materialize(longest, "url-events")
    spread = longest.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(order))))
    spread = spread.withColumn("c", F.expr("right(context, k)"))
    grams = spread.groupBy("k", "c", "sym").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    grams = materialize(grams, "url-grams")
    contexts = grams.groupBy("k", "c").agg(
        F.sum("a").alias("a_all"), F.sum("r").alias("r_all"),
        F.count(F.when(F.col("a") > 0, 1)).alias("a_kinds"),
        F.count(F.when(F.col("r") > 0, 1)).alias("r_kinds"),
    )
    return grams, contexts


def _log_likelihood(parts: Column, kind: str) -> Column:
    """Interpolate upwards from 1/256 over the orders of one event."""
    def up(p: Column, x: Column) -> Column:
        # Order 0 always leaves a little for unseen characters.
        kinds = x[f"{kind}_kinds"] + F.when(x["k"] == 0, 1).otherwise(0)
        total = x[f"{kind}_all"] + kinds
        return F.when(total > 0, (x[kind] + kinds * p) / total).otherwise(p)

    return F.ln(F.aggregate(parts, F.lit(1 / 256), up))


def event_ratios(events: DataFrame, grams: DataFrame, contexts: DataFrame, order: int) -> DataFrame:
    """``context, sym, ratio``: the log of accepted over rejected for each distinct event."""
    spread = events.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(order))))
    spread = spread.withColumn("c", F.expr("right(context, k)"))
    # Order 0 has one context, which every event needs: a row of totals.
    base = contexts.where("k = 0").drop("k", "c").first()
    totals = base.asDict() if base else {}
    # Rows of order 0 match no context there; their own text spreads them over the tasks.
    longer = contexts.where("k > 0").withColumnRenamed("c", "_at")
    joined = spread.join(grams, ["k", "c", "sym"], "left")
    joined = joined.withColumn("_at", F.when(F.col("k") == 0, F.col("context")).otherwise(F.col("c")))
    joined = joined.join(longer, ["k", "_at"], "left")

    def filled(name: str) -> Column:
        at_zero = F.lit(totals.get(name, 0)) if name.endswith(("_all", "_kinds")) else F.col(name)
        return F.coalesce(F.when(F.col("k") == 0, at_zero).otherwise(F.col(name)), F.lit(0)).alias(name)

    fields = [filled(n) for n in ("a", "r", "a_all", "r_all", "a_kinds", "r_kinds")]
    parts = joined.groupBy("context", "sym").agg(F.sort_array(F.collect_list(F.struct("k", *fields))).alias("parts"))
    ratio = _log_likelihood(F.col("parts"), "a") - _log_likelihood(F.col("parts"), "r")
    return parts.select("context", "sym", ratio.alias("ratio"))


def threshold(scored: DataFrame) -> float:
    """The score from which accepting is right most evenly for both classes.

    ``scored`` has ``score, accepted``. Maximises recall of accepted plus recall of
    rejected over steps of ``STEP``; 0 when a class is missing.
    """
    steps = scored.groupBy(F.floor(F.col("score") / STEP).alias("step")).agg(
        F.count(F.when(F.col("accepted"), 1)).alias("a"), F.count(F.when(~F.col("accepted"), 1)).alias("r")
    )
    steps = materialize(steps, "url-steps")
    total = steps.agg(F.sum("a").alias("a"), F.sum("r").alias("r")).first()
    if not total["a"] or not total["r"]:
        return 0.0
    # At most a few thousand steps, as a character's ratio is bounded by its counts.
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    rejected = F.coalesce(F.sum("r").over(below), F.lit(0)) / F.lit(total["r"])
    lost = F.coalesce(F.sum("a").over(below), F.lit(0)) / F.lit(total["a"])
    best = steps.select("step", (rejected - lost).alias("gain")).orderBy(F.desc("gain"), F.abs("step"), "step").first()
    return float(best["step"]) * STEP


def filter_urls(
    pages: DataFrame,
    rules: list[UrlRule],
    id_col: str = "page_id",
    url_col: str = "url",
    order: int = ORDER,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, score``, one row per page.

    A URL that is null or has no ``://`` has an empty host and path. ``score`` is the mean
    log ratio per character of the whole URL, for URLs without a rule, else null; a null or
    empty URL is one end character. Repeated rows stay. Only the id and the URL are read.
    """
    url = F.col(url_col)
    rows = pages.select(
        F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), whole_url(url).alias("text")
    )
    rows = rows.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules, "name"))
    rows = rows.withColumn("decided", rule_for(F.col("host"), F.col("path"), rules, "verdict"))
    rows = materialize(rows, "urls")

    counted = rows.groupBy("text", (F.col("decided") == "allow").alias("accepted")).agg(F.count("*").alias("n"))
    texts = counted.withColumn("parts", F.ceil(F.col("n") / HOT_ROWS)).drop("n")
    kept_out = F.pmod(F.xxhash64("text"), F.lit(CALIBRATION)) == 0
    known = F.col("accepted").isNotNull()
    texts = materialize(texts.withColumn("judged", ~known | kept_out), "url-texts")
    grams, contexts = train(texts.where(~F.col("judged")), order)

    judged = texts.where("judged").withColumn("key", F.unhex(F.md5("text")))
    places = materialize(_events(judged, order, "key"), "url-places")
    ratios = event_ratios(places.select("context", "sym").distinct(), grams, contexts, order)
    # Rounded, so that the order of the sum cannot tip a verdict.
    score = F.round(F.avg("ratio"), 9).alias("score")
    scores = places.join(materialize(ratios, "url-ratios"), ["context", "sym"]).groupBy("key").agg(score)
    scored = judged.select("key", "text", "accepted", "parts").join(materialize(scores, "url-scores"), "key")
    scored = materialize(scored, "url-judged")
    at = threshold(scored.where(known))

    # A URL with a large share of the rows has its score in several parts. Of such URLs there are
    # at most the rows over HOT_ROWS, so a hash of each goes to all rows.
    free = scored.where(~known).select("text", "score", F.xxhash64("text").alias("h"))
    hot = scored.where(~known & (F.col("parts") > 1)).groupBy(F.xxhash64("text").alias("h")).agg(F.max("parts").alias("parts"))
    hot = F.broadcast(materialize(hot, "url-hot"))
    parts = F.coalesce("parts", F.lit(1))
    free = free.join(hot, "h", "left").select("text", "score", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))).alias("part"))
    decided = rows.where(F.col("decided").isNotNull()).withColumn("score", F.lit(None).cast("double"))
    open_ = rows.where(F.col("decided").isNull()).withColumn("h", F.xxhash64("text")).join(hot, "h", "left")
    open_ = open_.withColumn("part", F.pmod(F.xxhash64("page_id"), parts).cast("int")).join(free, ["text", "part"])
    verdict = F.coalesce("decided", F.when(F.col("score") >= at, "allow").otherwise("block"))
    columns = ["page_id", "host", "path", "rule", verdict.alias("verdict"), "score"]
    return decided.select(*columns).unionByName(open_.select(*columns))
