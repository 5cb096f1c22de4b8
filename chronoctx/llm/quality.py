"""Quality classifier: a sparse rule ensemble.

Small trees are boosted on statistics of labelled texts; every path from a root
to a node is a rule, a conjunction of bounds on statistics. A logistic model
with a lasso penalty gives the rules weights, most of them zero. The rules that
stay become one Spark column expression, so scoring is a projection.

The statistics read the whole text and nothing else. The model is fitted on at
most ``max_rows`` labelled rows, taken by the hash of their id; scoring covers
all rows. A null text counts as empty and is scored as such. Without two classes
the score is the share of the one class there is (one half for no labels).
Repeated labels of a document count once each. Rows stand alone; repeated rows,
ties and clashing extra columns do not matter; an empty table gives an empty
result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from chronoctx.llm.common import free_name, let, text_of

MAX_ROWS = 12_000
TREES = 60
DEPTH = 3
BINS = 24
LEAST_ROWS = 8
SHRINK = 0.2
#: Penalties of the lasso path, largest first; held-back rows choose one.
PENALTIES = (0.03, 0.02, 0.01, 0.006, 0.003, 0.002, 0.001)

STATISTICS = (
    "log_chars", "log_words", "word_length", "upper", "digits", "symbols", "marks", "lines",
    "distinct", "repeats", "short", "capitals",
)


def _share(text: Column, kept: str, length: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[^{kept}]", "")) / length


def statistics(text: Column) -> Column:
    """A struct of numbers about a text."""
    def of_words(v: Column) -> Column:
        text, words = v["text"], v["words"]
        chars, count = F.greatest(F.length(text), F.lit(1)), F.greatest(F.size(words), F.lit(1))
        same = F.filter(words, lambda w, i: w == F.get(words, i - 1))
        values = {
            "log_chars": F.log1p(F.length(text)),
            "log_words": F.log1p(F.size(words)),
            "word_length": F.length(text) / count,
            "upper": _share(text, r"\p{Lu}", chars),
            "digits": _share(text, "0-9", chars),
            "symbols": _share(text, r"#$%&*|@~^=<>{}\[\]_+/\\", chars),
            "marks": _share(text, "!?.,;:", chars),
            "lines": _share(text, "\n", chars),
            "distinct": F.size(F.array_distinct(words)) / count,
            "repeats": F.size(same) / count,
            "short": F.size(F.filter(words, lambda w: F.length(w) <= 2)) / count,
            "capitals": F.size(F.filter(words, lambda w: w.rlike(r"^\p{Lu}"))) / count,
        }
        return F.struct(*[values[name].cast("double").alias(name) for name in STATISTICS])

    return let(F.struct(text.alias("text"), F.split(text, r"\s+").alias("words")), of_words)


@dataclass(frozen=True)
class Rule:
    """Bounds ``(statistic, above, value)``: above the value, or not above it."""

    bounds: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for i, above, value in self.bounds:
            out &= (x[:, i] > value) == above
        return out

    def column(self, stats: Column) -> Column:
        out = F.lit(True)
        for i, above, value in self.bounds:
            field = stats[STATISTICS[i]]
            out = out & ((field > value) if above else (field <= value))
        return out


@dataclass(frozen=True)
class Model:
    base: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self, stats: Column) -> Column:
        total = F.lit(self.base)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(stats), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.base + sum((w * r.holds(x) for r, w in self.rules), np.zeros(len(x))))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _best_split(codes: np.ndarray, gradient: np.ndarray, weight: np.ndarray) -> tuple[float, int, int] | None:
    """The statistic and bin whose split gains most, by sums per bin."""
    best = None
    total_g, total_w, n = gradient.sum(), weight.sum(), len(codes)
    for i in range(codes.shape[1]):
        g = np.cumsum(np.bincount(codes[:, i], gradient, BINS))[:-1]
        w = np.cumsum(np.bincount(codes[:, i], weight, BINS))[:-1]
        c = np.cumsum(np.bincount(codes[:, i], minlength=BINS))[:-1]
        gain = g * g / (w + 1) + (total_g - g) ** 2 / (total_w - w + 1) - total_g ** 2 / (total_w + 1)
        gain[(c < LEAST_ROWS) | (n - c < LEAST_ROWS)] = -np.inf
        k = int(np.argmax(gain))
        if np.isfinite(gain[k]) and gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
            best = (float(gain[k]), i, k)
    return best


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """Every path of boosted trees on quantile bins, each rule once."""
    cuts = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) for i in range(x.shape[1])]
    codes = np.column_stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(cuts)])
    chance, z = np.random.default_rng(7), np.zeros(len(y))
    rules: dict[Rule, None] = {}

    def grow(rows: np.ndarray, bounds: tuple, gradient: np.ndarray, weight: np.ndarray, depth: int) -> None:
        split = _best_split(codes[rows], gradient[rows], weight[rows]) if depth and len(rows) >= 2 * LEAST_ROWS else None
        if split is None:
            z[rows] += SHRINK * gradient[rows].sum() / (weight[rows].sum() + 1)
            return
        _, i, k = split
        if k >= len(cuts[i]):
            return
        high = codes[rows, i] > k
        for above, part in ((True, rows[high]), (False, rows[~high])):
            path = (*bounds, (i, above, float(cuts[i][k])))
            rules[Rule(path)] = None
            grow(part, path, gradient, weight, depth - 1)

    for number in range(TREES):
        p = _sigmoid(z)
        rows = np.flatnonzero(chance.random(len(y)) < 0.5)
        # The trees' depth varies, so short rules and long ones both come up.
        grow(rows, (), y - p, np.maximum(p * (1 - p), 1e-6), 1 + number % DEPTH)
        z = np.clip(z, -6, 6)
    return list(rules)


def _lasso(hits: np.ndarray, y: np.ndarray, penalty: float, start: np.ndarray, steps: int = 150) -> np.ndarray:
    """Logistic weights with an L1 penalty, by accelerated proximal steps. The
    first column is the constant and is not penalised."""
    step = 4 * len(y) / max(1e-9, np.linalg.norm(hits, 2) ** 2)
    w, ahead, t = start.copy(), start.copy(), 1.0
    shrink = np.full(len(w), penalty * step)
    shrink[0] = 0
    for _ in range(steps):
        gradient = hits.T @ (_sigmoid(hits @ ahead) - y) / len(y)
        moved = ahead - step * gradient
        new = np.sign(moved) * np.maximum(np.abs(moved) - shrink, 0)
        following = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / following * (new - w), new, following
    return w


def fit_rules(x: np.ndarray, y: np.ndarray) -> Model:
    """The model of statistics ``x`` and labels ``y``."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Model(float(np.log(share / (1 - share))), ())
    back = np.random.default_rng(3).random(len(y)) < 0.2
    if back.all() or not back.any() or y[~back].min() == y[~back].max():
        back[:] = False
    rules = tree_rules(x[~back], y[~back])
    hits = np.column_stack([np.ones(len(y)), *[r.holds(x) for r in rules]]).astype(np.float32)
    w = np.zeros(hits.shape[1], np.float32)
    best, choice = np.inf, w
    for penalty in PENALTIES:
        w = _lasso(hits[~back], y[~back], penalty, w)
        p = np.clip(_sigmoid(hits @ w), 1e-6, 1 - 1e-6)[back if back.any() else slice(None)]
        t = y[back] if back.any() else y
        loss = float(-(t * np.log(p) + (1 - t) * np.log(1 - p)).mean())
        if loss < best:
            best, choice = loss, w
    kept = [(r, float(v)) for r, v in zip(rules, choice[1:]) if abs(v) > 1e-4]
    return Model(float(choice[0]), tuple(kept))


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether a row is kept from training."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fit on the texts of at most ``max_rows`` labelled rows, which are few and
    so reach every task."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    sample = (
        usable.select("doc_id", F.col("quality").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)
    )
    rows = (
        docs.select("doc_id", text_of("text").alias("text")).join(F.broadcast(sample), "doc_id")
        .select("label", statistics(F.col("text")).alias("s")).select("label", "s.*")
        .orderBy(F.xxhash64(*STATISTICS, "label"), *STATISTICS, "label").limit(max_rows)
        .orderBy(*STATISTICS, "label").collect()  # repeated ids can give more rows than were taken
    )
    x = np.array([[r[name] for name in STATISTICS] for r in rows], dtype=float).reshape(-1, len(STATISTICS))
    return fit_rules(x, np.array([r["label"] for r in rows], dtype=float))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per document."""
    stats = docs.select("doc_id", statistics(text_of("text")).alias("stats"))
    scored = stats.select("doc_id", held_out().alias("held_out"), model.column(F.col("stats")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that the model takes for good ones, as they are."""
    name = free_name(docs, "_quality_statistics")
    stats = docs.withColumn(name, statistics(text_of("text")))
    return stats.where(model.column(F.col(name)) >= 0.5).drop(name)
