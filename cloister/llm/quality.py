"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees, each grown on a random part of the training rows and of the statistics, give their paths as conjunctive
rules. A logistic regression with an L1 penalty weighs the rules; those whose weight is not 0 are compiled, with the
statistics, into Spark column expressions, so scoring is one projection without Python or a shuffle.

The statistics see the whole text and nothing else. Training takes the ``train_rows`` labelled rows whose hashed ids are
smallest, a bounded sample; rows of the held-out fold (crc32 of the id as text, modulo 5, is 0) are never among them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GAP

#: Name of each statistic and what it is of the text, its words and its lines.
STATISTICS = (
    "chars", "words", "lines", "word_chars", "line_chars", "distinct_words", "distinct_lines", "symbols", "digits", "capitals",
    "stops", "commas", "longest_word", "short_words", "marked_words", "lone_marks", "long_lines",
)


def with_statistics(df: DataFrame, text: Column, name: str = "stats", filtered: bool = False) -> DataFrame:
    """``df`` with all statistics of a text as one array of doubles; 0 where a share has nothing to divide by.

    Words and lines are columns of their own first, so that a text is split once and not for every statistic. Where rows
    are filtered by the array, it comes from a generator, below which Spark can't push the filter's conditions: it would
    make the statistics again for each of them.
    """
    kept = [F.col(f"`{c}`") for c in df.columns]
    t = F.coalesce(text, F.lit(""))
    cut = df.select(*kept, t.alias("__t"), F.split(t, GAP, -1).alias("__w"), F.split(t, "\n", -1).alias("__l"))
    cut = cut.select(*kept, "__t", F.array_remove("__w", "").alias("__w"), F.array_remove("__l", "").alias("__l"))
    t, words, lines = F.col("__t"), F.col("__w"), F.col("__l")

    def number(x: Column) -> Column:
        return x.cast("double")

    def share(a: Column, b: Column) -> Column:
        return F.when(b > 0, number(a) / number(b)).otherwise(F.lit(0.0))

    def chars_of(kind: str) -> Column:
        return F.length(t) - F.length(F.regexp_replace(t, kind, ""))

    n, w, k = F.length(t), F.size(words), F.size(lines)
    parts = [
        number(n),
        number(w),
        number(k),
        # Characters of words: all but white space, which is what splits them.
        share(n - chars_of(GAP), w),
        share(n, k),
        share(F.size(F.array_distinct(words)), w),
        share(F.size(F.array_distinct(lines)), k),
        share(chars_of(r"[^\p{L}\p{N}\s.,;:!?'\"()\-]+"), n),
        share(chars_of(r"\p{N}+"), n),
        share(chars_of(r"\p{Lu}+"), n),
        share(chars_of(r"[.!?]+"), n),
        share(chars_of(r"[,;:]+"), n),
        number(F.coalesce(F.array_max(F.transform(words, lambda x: F.length(x))), F.lit(0))),
        share(F.size(F.filter(words, lambda x: F.length(x) <= 3)), w),
        share(F.size(F.filter(words, lambda x: x.rlike(r"[^\p{L}\p{N}.,;:!?'\"()\-]$"))), w),
        share(F.size(F.filter(words, lambda x: F.length(x) == 1)), w),
        share(F.size(F.filter(lines, lambda x: F.length(x) > 400)), k),
    ]
    made = F.array(*parts)
    return cut.select(*kept, (F.explode(F.array(made)) if filtered else made).alias(name))


Rule = tuple[tuple[int, bool, float], ...]


@dataclass(frozen=True)
class RuleModel:
    """score = 1 / (1 + exp(-(bias + sum of the weights of the rules that hold)))"""

    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self, stats: Column) -> Column:
        total = F.lit(float(self.bias))
        for rule, weight in self.rules:
            holds = F.lit(True)
            for k, above, cut in rule:
                holds = holds & ((stats[k] > cut) if above else (stats[k] <= cut))
            total = total + F.when(holds, F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def score(self, stats: np.ndarray) -> np.ndarray:
        total = np.full(len(stats), self.bias)
        for rule, weight in self.rules:
            total += weight * _holds(rule, stats)
        return 1 / (1 + np.exp(-total))

    def describe(self) -> list[str]:
        return [f"{w:+.4f}  " + " and ".join(f"{STATISTICS[k]} {'>' if up else '<='} {cut:.6g}" for k, up, cut in rule) for rule, w in sorted(self.rules, key=lambda x: -abs(x[1]))]


def _holds(rule: Rule, stats: np.ndarray) -> np.ndarray:
    out = np.ones(len(stats), bool)
    for k, above, cut in rule:
        out &= (stats[:, k] > cut) if above else (stats[:, k] <= cut)
    return out


def _cuts(values: np.ndarray, most: int = 32) -> np.ndarray:
    """Midpoints between neighbouring quantiles."""
    q = np.unique(np.quantile(values, np.linspace(0, 1, most + 1)))
    return (q[1:] + q[:-1]) / 2


def _paths(bins: np.ndarray, cuts: list[np.ndarray], y: np.ndarray, rows: np.ndarray, features: np.ndarray, depth: int, least: int, path: Rule, out: list[Rule]) -> None:
    """Grow a tree by Gini gain over binned statistics; every node below the root adds its path."""
    if path:
        out.append(path)
    if depth == 0 or len(rows) < 2 * least:
        return
    best, target = (1e-9, -1, -1), y[rows]
    n, s = len(rows), target.sum()
    for k in features:
        size = len(cuts[k]) + 1
        count = np.cumsum(np.bincount(bins[rows, k], minlength=size))[:-1]
        ones = np.cumsum(np.bincount(bins[rows, k], weights=target, minlength=size))[:-1]
        ok = (count >= least) & (n - count >= least)
        if not ok.any():
            continue
        left, right = ones**2 / np.maximum(count, 1), (s - ones) ** 2 / np.maximum(n - count, 1)
        gain = np.where(ok, left + right - s * s / n, -1)
        at = int(np.argmax(gain))
        if gain[at] > best[0]:
            best = (gain[at], int(k), at)
    _, k, at = best
    if k < 0:
        return
    low = bins[rows, k] <= at
    for side, above in ((rows[low], False), (rows[~low], True)):
        _paths(bins, cuts, y, side, features, depth - 1, least, (*path, (k, above, float(cuts[k][at]))), out)


def _tightest(rule: Rule) -> Rule:
    """The rule with one condition for each statistic and side."""
    cuts: dict[tuple[int, bool], float] = {}
    for k, above, cut in rule:
        old = cuts.get((k, above), cut)
        cuts[k, above] = max(old, cut) if above else min(old, cut)
    return tuple((k, above, cut) for (k, above), cut in sorted(cuts.items()))


def _lasso(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on standardised 0/1 columns, by accelerated proximal gradient steps."""
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    n, m = x.shape
    z = ((x - mean) / spread).astype(np.float64)
    v = np.ones(m)
    for _ in range(30):
        v = z.T @ (z @ v)
        v /= np.linalg.norm(v) or 1
    step = 1 / (0.25 * (np.linalg.norm(z @ v) ** 2 / n + 1) * 1.05)
    w, b = np.zeros(m), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    u, c, t = w.copy(), b, 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(z @ u + c))) - y
        new = u - step * (z.T @ error / n)
        new, nb = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0), c - step * error.mean()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        u, c = new + (t - 1) / nt * (new - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = new, nb, nt
    return b - float(np.sum(w * mean / spread)), w / spread


def fit_rules(stats: np.ndarray, y: np.ndarray, trees: int = 48, depth: int = 3, penalty: float = 0.002, rounds: int = 400, seed: int = 5) -> RuleModel:
    """Rules from trees, weighed by the lasso. Without rows the score is 0.5; with one kind of label only it is constant."""
    if not len(y):
        return RuleModel(0.0, ())
    prior = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    if y.min() == y.max():
        return RuleModel(prior, ())
    random = np.random.default_rng(seed)
    cuts = [_cuts(stats[:, k]) for k in range(stats.shape[1])]
    # A value equal to a cut is below it, as in the rules.
    bins = np.stack([np.searchsorted(c, stats[:, k], side="left") for k, c in enumerate(cuts)], axis=1)
    usable = np.array([k for k, c in enumerate(cuts) if len(c)])
    if not len(usable):
        return RuleModel(prior, ())
    least = max(5, len(y) // 200)
    found: list[Rule] = []
    for _ in range(trees):
        rows = np.sort(random.choice(len(y), max(1, len(y) * 2 // 3), replace=False))
        features = np.sort(random.choice(usable, max(1, min(len(usable), (len(usable) + 1) // 2)), replace=False))
        _paths(bins, cuts, y.astype(float), rows, features, depth, least, (), found)
    rules = list(dict.fromkeys(_tightest(r) for r in found))
    held = np.array([_holds(r, stats) for r in rules]).T.astype(np.float32) if rules else np.zeros((len(y), 0), np.float32)
    different = np.unique(held, axis=1, return_index=True)[1] if rules else []
    different = [k for k in sorted(different) if 0 < held[:, k].sum() < len(y)]
    if not different:
        return RuleModel(prior, ())
    bias, weights = _lasso(held[:, different], y.astype(float), penalty, rounds)
    return RuleModel(bias, tuple((rules[k], float(w)) for k, w in zip(different, weights) if w))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", train_rows: int = 12_000, **options: float) -> RuleModel:
    """Fit on at most ``train_rows`` labelled documents outside the held-out fold.

    Labels that are null, or of no document, are left out; where an id has several, 1 is taken if at least half are 1.
    """
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").alias("label"))
    known = known.filter("doc_id is not null and label is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    # The bound makes the broadcast's size known: two numbers for each of at most `train_rows` ids.
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows = with_statistics(texts.join(F.broadcast(sample), "doc_id"), F.col("text")).select("doc_id", "label", "stats")
    rows = rows.dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")
    stats = np.array(rows["stats"].tolist(), dtype=float).reshape(-1, len(STATISTICS))
    return fit_rules(stats, rows["label"].to_numpy(), **options)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **options: float) -> DataFrame:
    """Score every document: doc_id, held_out, score (0 to 1, higher for better texts), predicted (score >= threshold).

    A null text counts as empty, and empty texts are scored like any other. Rows with equal or null ids are documents of
    their own. An empty table gives no rows. Other columns of either table are ignored.
    """
    model = train(docs, labels, id_col, text_col, **options)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows = with_statistics(rows, F.col("text"))
    scored = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.column(F.col("stats")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **options: float) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    model = train(docs, labels, id_col, text_col, **options)
    names = [f"`{c}`" for c in docs.columns]
    rows = with_statistics(docs.select(F.struct(*names).alias("__doc")), F.col("__doc")[text_col], "__stats", filtered=True)
    return rows.filter(model.column(F.col("__stats")) >= threshold).select("__doc.*")
