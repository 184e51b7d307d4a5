"""Quality classifier: a sparse ensemble of rules over statistics of the text.

Small boosted trees over the statistics give paths, and every path is a rule: a conjunction
of comparisons. A logistic regression with an L1 penalty keeps the rules that matter. The
rules with weights compile into one Spark column over the statistics, so what was learned
can be read, and scoring needs no model on the executors.

Learning uses a bounded sample of labelled rows (``SAMPLE`` by default, taken by a hash) and
happens on the driver; statistics of all texts are computed where the texts are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000
TREES, DEPTH, BINS, SHRINK = 20, 3, 32, 0.3
SEED = 5
# Loss (nats a row) that fewer rules may cost.
SLACK = 0.001

STATISTICS = (
    "words", "word_length", "distinct_words", "repeated_words", "distinct_pairs", "upper",
    "symbols", "marks", "exclaims", "digits", "bars", "line_words", "distinct_lines",
)

# Classes of bytes: 1 upper, 2 lower or beyond ASCII, 3 digit, 4 . , ; : ' " - ( ), 5 ! ?, 6 |, 7 other marks, 0 white space.
_CLASS = np.full(256, 7, dtype=np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[65:91], _CLASS[97:123], _CLASS[128:], _CLASS[48:58] = 1, 2, 2, 3
_CLASS[list(b".,;:'\"-()")], _CLASS[list(b"!?")], _CLASS[ord("|")] = 4, 5, 6
_AT_ONCE = 1 << 20


def statistics(text: bytes | None) -> tuple[float, ...]:
    """The ``STATISTICS`` of a text, all finite; zeros for an empty one."""
    text = text or b""
    words = text.split()
    if not words:
        return (0.0,) * len(STATISTICS)
    classes = np.zeros(8, dtype=np.int64)
    for at in range(0, len(text), _AT_ONCE):
        piece = np.frombuffer(text, dtype=np.uint8, count=min(_AT_ONCE, len(text) - at), offset=at)
        classes += np.bincount(_CLASS[piece], minlength=8)
    count, letters, black = len(words), classes[1] + classes[2], len(text) - classes[0]
    after = words[1:]
    lines = text.split(b"\n")
    return (
        float(np.log1p(count)),
        black / count,
        len(set(words)) / count,
        sum(map(bytes.__eq__, words, after)) / count,
        len(set(zip(words, after, strict=False))) / max(1, count - 1),
        classes[1] / max(1, letters),
        classes[7] / count,
        classes[4] / count,
        classes[5] / count,
        classes[3] / black,
        classes[6] / count,
        count / len(lines),
        len(set(lines)) / len(lines),
    )


def text_statistics(text: Column) -> Column:
    """A struct of the ``STATISTICS`` of a text column."""

    @F.pandas_udf(", ".join(f"{name} double" for name in STATISTICS))
    def measure(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(t) for t in texts], columns=list(STATISTICS), dtype=float)

    # Declared random so that a filter and a projection do not each compute it.
    return measure.asNondeterministic()(text.cast("binary"))


@dataclass(frozen=True)
class Rule:
    """``weight`` for texts that meet every condition ``(statistic, above, limit)``."""

    weight: float
    conditions: tuple[tuple[str, bool, float], ...]

    def column(self, stats: Column) -> Column:
        met = [stats[n] > limit if above else stats[n] <= limit for n, above, limit in self.conditions]
        return F.when(reduce(Column.__and__, met), self.weight).otherwise(0.0)


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    rules: tuple[Rule, ...]

    def score(self, stats: Column) -> Column:
        """Probability of good quality as a column over the struct ``stats``."""
        total = reduce(Column.__add__, (r.column(stats) for r in self.rules), F.lit(self.intercept))
        return 1.0 / (1.0 + F.exp(-total))


def _grow(binned: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, rng: np.random.Generator) -> list[tuple]:
    """Paths of one tree: ``(conditions, value, rows)`` with ``(feature, above, bin)``."""
    features = rng.choice(binned.shape[1], size=max(2, binned.shape[1] // 2), replace=False)
    paths, open_ = [], [((), np.arange(len(binned)))]
    for _ in range(DEPTH):
        following = []
        for conditions, rows in open_:
            g, h = gradient[rows], hessian[rows]
            best = None
            for f in features:
                sums = np.cumsum(np.bincount(binned[rows, f], g, BINS))
                weight = np.cumsum(np.bincount(binned[rows, f], h, BINS))
                left, right = weight[:-1], weight[-1] - weight[:-1]
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = sums[:-1] ** 2 / (left + 1) + (sums[-1] - sums[:-1]) ** 2 / (right + 1)
                gain = np.where((left < 1) | (right < 1), -1.0, gain - sums[-1] ** 2 / (weight[-1] + 1))
                at = int(gain.argmax())
                if gain[at] > 1e-6 and (best is None or gain[at] > best[0]):
                    best = (gain[at], int(f), at)
            if best is None:
                continue
            _, f, at = best
            above = binned[rows, f] > at
            for side, chosen in ((False, rows[~above]), (True, rows[above])):
                path = (*conditions, (f, side, at))
                value = gradient[chosen].sum() / (hessian[chosen].sum() + 1)
                paths.append((path, value, chosen))
                following.append((path, chosen))
        open_ = following
    return paths


def _tightest(path: tuple) -> tuple:
    """The path with one condition a feature and side."""
    limits: dict[tuple, int] = {}
    for f, above, at in path:
        limits[f, above] = (max if above else min)(at, limits.get((f, above), at))
    return tuple(sorted((f, above, at) for (f, above), at in limits.items()))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lasso(met: np.ndarray, label: np.ndarray, penalty: float, rounds: int = 250) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty by accelerated proximal gradient."""
    rows, count = met.shape
    along = np.ones(count + 1, dtype=met.dtype)
    for _ in range(20):  # the largest curvature, by power iteration
        along /= np.linalg.norm(along)
        out = met @ along[:-1] + along[-1]
        along = np.append(met.T @ out, out.sum()).astype(met.dtype)
    step = 4 * rows / (1.05 * np.linalg.norm(along))
    weight, ahead, t = np.zeros(count + 1), np.zeros(count + 1), 1.0
    for _ in range(rounds):
        error = (_sigmoid(met @ ahead[:-1].astype(met.dtype) + ahead[-1]) - label).astype(met.dtype)
        new = ahead - step * np.append(met.T @ error, error.sum()) / rows
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * penalty, 0)
        faster = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, weight, t = new + (t - 1) / faster * (new - weight), new, faster
    return float(weight[-1]), weight[:-1]


def fit(values: np.ndarray, label: np.ndarray, penalties: tuple[float, ...] = (0.02, 0.01, 0.005, 0.002, 0.001)) -> RuleEnsemble:
    """Learn an ensemble from statistics (rows x ``STATISTICS``) and labels 0 or 1.

    The penalty is the largest whose loss on a fifth of the rows is within ``SLACK`` of the
    smallest, for few rules. Without rows, or with one class only, the ensemble has no rule
    and says how common the class is.
    """
    rows = len(label)
    share = (label.sum() + 0.5) / (rows + 1)
    prior = float(np.log(share / (1 - share)))
    if rows < 20 or label.min() == label.max():
        return RuleEnsemble(prior, ())
    rng = np.random.default_rng(SEED)
    edges = [np.unique(np.quantile(values[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(values.shape[1])]
    binned = np.stack([np.searchsorted(e, values[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    margin, conditions = np.full(rows, prior), {}
    for _ in range(TREES):
        p = _sigmoid(margin)
        paths = _grow(binned, label - p, p * (1 - p), rng)
        longest = max((len(c) for c, _, _ in paths), default=0)
        for path, value, chosen in paths:
            conditions.setdefault(_tightest(path), None)
            if len(path) == longest:
                margin[chosen] += SHRINK * value
    paths = list(conditions)
    met = np.ones((rows, len(paths)), dtype=np.float32)
    for i, path in enumerate(paths):
        for f, above, at in path:
            met[:, i] *= (binned[:, f] > at) == above
    inside = met.mean(axis=0)
    some = (inside > 0.001) & (inside < 0.999)
    met, paths = met[:, some], [p for p, s in zip(paths, some, strict=True) if s]
    if not paths:
        return RuleEnsemble(prior, ())
    check = rng.random(rows) < 0.2
    losses = []
    for penalty in penalties:
        base, weight = _lasso(met[~check], label[~check], penalty)
        p = np.clip(_sigmoid(met[check] @ weight + base), 1e-9, 1 - 1e-9)
        losses.append(-(label[check] * np.log(p) + (1 - label[check]) * np.log(1 - p)).mean())
    chosen = next(p for p, loss in zip(penalties, losses, strict=True) if loss <= min(losses) + SLACK)
    base, weight = _lasso(met, label, chosen)
    rules = [
        Rule(float(w), tuple((STATISTICS[f], above, float(edges[f][at])) for f, above, at in path))
        for w, path in zip(weight, paths, strict=True)
        if abs(w) > 1e-3
    ]
    return RuleEnsemble(base, tuple(rules))


def learn(
    documents: DataFrame,
    labels: DataFrame,
    chosen: Column | None = None,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
) -> RuleEnsemble:
    """Fit on at most ``sample`` labelled documents for which ``chosen`` (on the id) holds.

    Labels other than 0 and 1, and rows without an id, are left out. An id with several
    texts or labels counts once per label, with one of its texts.
    """
    named = labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("int").alias("label"))
    named = named.where(F.col("id").isNotNull() & F.col("label").isin(0, 1)).distinct()
    if chosen is not None:
        named = named.where(chosen)
    named = named.orderBy(F.xxhash64("id"), "id", "label").limit(sample)
    texts = documents.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    # At most ``sample`` rows of two numbers.
    found = texts.join(F.broadcast(named), "id").select("id", "label", text_statistics(F.col("text")).alias("stats"))
    rows = found.groupBy("id", "label").agg(F.min("stats").alias("stats")).select("id", "label", "stats.*")
    rows = rows.toArrow().to_pandas().sort_values(["id", "label"])
    return fit(rows[list(STATISTICS)].to_numpy(float), rows["label"].to_numpy(float))


def score_quality(
    documents: DataFrame, ensemble: RuleEnsemble, text_col: str = "text", threshold: float = 0.3
) -> DataFrame:
    """``documents`` with ``score`` and ``predicted`` (1 from ``threshold`` on).

    Null and empty texts have statistics of zero and a score like any other. Columns of the
    same names are replaced; all others are kept.
    """
    kept = documents.drop("score", "predicted")
    # The caller's columns go in one struct, so that no name of theirs meets one of ours.
    measured = kept.select(F.struct(*kept.columns).alias("doc"), text_statistics(F.col(text_col)).alias("stats"))
    scored = measured.select("doc", ensemble.score(F.col("stats")).alias("score"))
    return scored.select("doc.*", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether the CRC-32 of the id as text has this remainder; false without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))
