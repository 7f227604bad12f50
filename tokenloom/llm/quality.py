"""Quality classifier: a sparse rule ensemble over text statistics, run as one column expression.

Shallow trees are grown on random rows and statistics, every path from a root becomes a rule (a conjunction
of thresholds), and a lasso logistic regression leaves few rules with a weight. The model is a list of
rules, so scoring is arithmetic over columns inside the JVM, on whole texts.

* Statistics see the text alone. Null text counts as empty; empty texts have a score like others.
* Training takes at most `TRAIN_ROWS` labelled rows, in hash order of their ids; rows without id, label or document are
  left out, and a document with several labels counts with each. With no rows, or one class only, the score is constant.
* Scoring neither joins nor groups: repeated rows, repeated ids and other columns pass unharmed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Most labelled rows that a model is fitted on; they are collected with their statistics.
TRAIN_ROWS = 12_000
TREES, DEPTH, BINS = 40, 3, 24
# L1 penalty per row, and iterations of the proximal gradient.
PENALTY, STEPS = 4e-4, 400
LEAST_ROWS = 10
CUT = 0.3
FOLDS = 5


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text as doubles, by name."""
    filled = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(filled, "[ \\t\\n\\r]+"), lambda w: w != "")
    n_words = F.greatest(F.size(words), F.lit(1))
    n_chars = F.greatest(F.char_length(filled), F.lit(1))
    counts = {
        "upper": "\\p{Lu}",
        "digit": "[0-9]",
        "stop": "[.!?]",
        "comma": ",",
        "pipe": "\\|",
        "bang": "!!",
        "symbol": "[^\\p{L}\\p{N}\\s.,!?|'\"-]",
    }
    found = {
        "words": F.size(words).cast("double"),
        "word_length": n_chars / n_words,
        "distinct": F.size(F.array_distinct(words)) / n_words,
        "lines": F.regexp_count(filled, F.lit("\\n")) / n_words,
    }
    for name, pattern in counts.items():
        found[name] = F.regexp_count(filled, F.lit(pattern)) / n_chars
    return {name: value.cast("double") for name, value in found.items()}


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    value: float


@dataclass(frozen=True)
class Model:
    """A bias, and rules with their weights: a rule adds its weight where all its conditions hold."""

    bias: float
    rules: tuple[tuple[float, tuple[Condition, ...]], ...]

    def score(self, values: dict[str, Column]) -> Column:
        total = F.lit(self.bias)
        for weight, conditions in self.rules:
            holds = F.lit(True)
            for c in conditions:
                holds = holds & ((values[c.name] > c.value) if c.above else (values[c.name] <= c.value))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def held_out(doc_id: Column) -> Column:
    """The fold that is never learnt from: the CRC-32 of the id as text is divisible by five."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, text: str, doc_id: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Names, statistics and labels of at most `TRAIN_ROWS` labelled rows outside the held-out fold."""
    known = labels.select(labels[doc_id].alias("id"), labels[label].cast("int").alias("label")).dropna().distinct()
    # Bounded by the limit, so it may be sent to every task.
    chosen = known.where(~held_out(F.col("id"))).orderBy(F.xxhash64("id"), "id", "label").limit(TRAIN_ROWS)
    rows = docs.select(docs[doc_id].alias("id"), docs[text].alias("text")).join(F.broadcast(chosen), "id")
    values = statistics(F.col("text"))
    # Repeated documents could exceed the bound: the same number of rows is kept of them.
    picked = rows.select("id", "label", *[v.alias(n) for n, v in values.items()]).orderBy(F.xxhash64("id", "words"), "id", "label", *values)
    table = picked.limit(TRAIN_ROWS).toPandas()
    return list(values), table[list(values)].to_numpy(float), table["label"].to_numpy(int)


def fit(names: list[str], x: np.ndarray, y: np.ndarray, seed: int = 11) -> Model:
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(float(np.log(share / (1 - share))), ())
    rules = list(dict.fromkeys(_tree_rules(names, x, y, np.random.default_rng(seed))))
    holds = np.stack([_holds(rule, names, x) for rule in rules], 1).astype(float)
    bias, weights = _lasso(holds, y.astype(float))
    kept = sorted(((float(w), r) for w, r in zip(weights, rules) if abs(w) > 1e-6), key=lambda p: (-abs(p[0]), str(p[1])))
    return Model(float(bias), tuple(kept))


def _holds(rule: tuple[Condition, ...], names: list[str], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        column = x[:, names.index(c.name)]
        out &= column > c.value if c.above else column <= c.value
    return out


def _tree_rules(names, x, y, rng):
    """Rules of all paths of all trees; thresholds lie between neighbouring quantiles."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    rules = []

    def grow(rows, path, depth):
        if path:
            rules.append(tuple(sorted(path, key=lambda c: (c.name, c.above, c.value))))
        if depth == DEPTH or len(rows) < 2 * LEAST_ROWS or y[rows].min() == y[rows].max():
            return
        best = None
        for f in rng.choice(x.shape[1], max(2, x.shape[1] // 3), replace=False):
            column = x[rows, f]
            for cut in cuts[f]:
                right = column > cut
                n = int(right.sum())
                if n < LEAST_ROWS or len(rows) - n < LEAST_ROWS:
                    continue
                a, b = y[rows][right].mean(), y[rows][~right].mean()
                impurity = n * a * (1 - a) + (len(rows) - n) * b * (1 - b)
                if best is None or impurity < best[0]:
                    best = impurity, f, float(cut), right
        if best is not None:
            _, f, cut, right = best
            grow(rows[right], [*path, Condition(names[f], True, cut)], depth + 1)
            grow(rows[~right], [*path, Condition(names[f], False, cut)], depth + 1)

    for _ in range(TREES):
        grow(rng.choice(len(y), min(len(y), 3000)), [], 0)
    return rules


def _lasso(holds: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on all weights but the bias, by accelerated proximal gradient."""
    n, k = holds.shape
    scale = 4.0 / (np.linalg.norm(np.column_stack([holds, np.ones(n)]), 2) ** 2 / n)
    w, previous, bias, previous_bias = np.zeros(k), np.zeros(k), 0.0, 0.0
    for step in range(STEPS):
        ahead = step / (step + 3)
        v, c = w + ahead * (w - previous), bias + ahead * (bias - previous_bias)
        slope = (1 / (1 + np.exp(-(holds @ v + c))) - y) / n
        previous, previous_bias = w, bias
        moved = v - scale * (holds.T @ slope)
        w = np.sign(moved) * np.maximum(np.abs(moved) - scale * PENALTY, 0)
        bias = c - scale * slope.sum()
    return bias, w


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", doc_id: str = "doc_id") -> Model:
    return fit(*training_rows(docs, labels, label, text, doc_id))


def scored(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """`docs` with the column `name`: the score of every whole text, between 0 and 1."""
    values = statistics(docs[text])
    nested = docs.select(F.struct("*").alias("row"), F.struct(*[v.alias(n) for n, v in values.items()]).alias("stat"))
    score = model.score({n: F.col(f"stat.{n}") for n in values})
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c != name]
    return nested.select(*kept, score.alias(name))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", cut: float = CUT) -> DataFrame:
    """The rows of `docs` whose text is predicted to be of quality 1; all columns stay as they are."""
    model = train(docs, labels, "quality", text, doc_id)
    name = "_score"
    while name in docs.columns:
        name = f"_{name}"
    return scored(docs, model, text, name).where(F.col(name) >= cut).drop(name)
