"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees are boosted in turn, one feature after the other, so each feature ends with one
lookup table over its bins; the strongest pairs then get tables of their own from trees that cut
both features once. A score is the sigmoid of an intercept plus one table entry per feature and
pair.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickframe.llm.rows import id_and_text, map_rows, map_texts
from tickframe.llm.workers import tidy

SAMPLE = 20_000  # labelled rows the model is fitted on, at most
BINS = 32
PAIR_BINS = 8
PAIRS = 8
ROUNDS = 60
RATE = 0.15
LEAVES = 4
FEATURES = (
    "log_chars", "log_words", "word_length", "long_words", "one_letter_words", "distinct_words",
    "distinct_pairs", "top_word", "upper", "digits", "other_marks", "top_mark", "marked_words",
    "marks_in_words", "line_length", "repeated_lines", "non_ascii", "capital_starts", "vowels",
)


def text_features(text: str) -> tuple:
    """The features of one text, all zero for an empty one; the whole text is read."""
    n = len(text)
    words = text.split()
    m = len(words)
    if not m:
        return (np.log1p(n),) + (0.0,) * (len(FEATURES) - 1)
    data = text.encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, digits = counts[65:91].sum(), counts[48:58].sum()
    marks = counts[33:127].copy()
    marks[[k - 33 for k in (*range(48, 58), *range(65, 91), *range(97, 123), 44, 46)]] = 0
    lines = [x for x in text.split("\n") if x]
    seen = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, m)
    plain = sum(map(str.isalpha, words))
    last_mark = sum(not w[-1].isalnum() and w[-1] not in ".," for w in words)
    vowels = counts[[65, 69, 73, 79, 85, 97, 101, 105, 111, 117]].sum()
    letters = upper + counts[97:123].sum()
    return (
        np.log1p(n), np.log1p(m), lengths.mean(), (lengths > 12).mean(), (lengths == 1).mean(),
        len(seen) / m, len(set(zip(words, words[1:]))) / m, max(seen.values()) / m,
        upper / n, digits / n, marks.sum() / n, marks.max() / n, last_mark / m, 1 - plain / m,
        np.log1p(n / max(len(lines), 1)), 1 - len(set(lines)) / max(len(lines), 1),
        1 - counts[:128].sum() / len(data), sum(w[0].isupper() for w in words) / m,
        vowels / max(letters, 1),
    )


def feature_rows(texts: list) -> np.ndarray:
    return np.array([text_features(t or "") for t in texts], float).reshape(len(texts), len(FEATURES))


@dataclass
class AdditiveModel:
    intercept: float = 0.0
    edges: list = field(default_factory=list)  # inner bin edges of each feature
    tables: list = field(default_factory=list)  # one value per bin
    pair_edges: list = field(default_factory=list)
    pairs: list = field(default_factory=list)  # (feature, feature)
    pair_tables: list = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            out += table[np.searchsorted(self.edges[j], x[:, j], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            out += table[
                np.searchsorted(self.pair_edges[a], x[:, a], side="right"),
                np.searchsorted(self.pair_edges[b], x[:, b], side="right"),
            ]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _shallow_tree(grad: np.ndarray, hess: np.ndarray, leaves: int) -> np.ndarray:
    """Step value of every bin: greedy cuts of the bin order while they gain, a Newton step a leaf."""
    g, h = np.concatenate(([0], np.cumsum(grad))), np.concatenate(([0], np.cumsum(hess)))
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)
    parts = [(0, len(grad))]
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(parts):
            if b - a > 1:
                cuts = np.arange(a + 1, b)
                won = gain(a, cuts) + gain(cuts, b) - gain(a, b)
                at = int(np.argmax(won))
                if won[at] > best[0]:
                    best = (won[at], k, int(cuts[at]))
        if best[1] is None:
            break
        a, b = parts[best[1]]
        parts[best[1] : best[1] + 1] = [(a, best[2]), (best[2], b)]
    step = np.zeros(len(grad))
    for a, b in parts:
        step[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return step


def _quarters(grad: np.ndarray, hess: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, step of every cell) of the best tree that cuts both features once."""
    g = np.pad(grad.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    h = np.pad(hess.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    best = (-1.0, 0, 0)
    total = 0.0
    for i in range(1, grad.shape[0]):
        for j in range(1, grad.shape[1]):
            total = sum(
                q(g) ** 2 / (q(h) + 1.0)
                for q in (
                    lambda c: c[i, j], lambda c: c[i, -1] - c[i, j], lambda c: c[-1, j] - c[i, j],
                    lambda c: c[-1, -1] - c[i, -1] - c[-1, j] + c[i, j],
                )
            )
            if total > best[0]:
                best = (total, i, j)
    gain, i, j = best
    step = np.zeros_like(grad)
    if gain >= 0:
        for rows in (slice(0, i), slice(i, None)):
            for cols in (slice(0, j), slice(j, None)):
                step[rows, cols] = grad[rows, cols].sum() / (hess[rows, cols].sum() + 1.0)
    return gain, step


def fit_additive(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Fit on a matrix of features and 0/1 labels. No rows or one class give a constant model."""
    model = AdditiveModel()
    share = (y.sum() + 0.5) / (len(y) + 1)
    model.intercept = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return model
    d = x.shape[1]
    model.edges = [_edges(x[:, j], BINS) for j in range(d)]
    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(d)]
    binned = [np.searchsorted(model.edges[j], x[:, j], side="right") for j in range(d)]
    coarse = [np.searchsorted(model.pair_edges[j], x[:, j], side="right") for j in range(d)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    raw = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(d):
            grad, hess = slopes()
            size = len(model.tables[j])
            step = RATE * _shallow_tree(
                np.bincount(binned[j], grad, size), np.bincount(binned[j], hess, size), LEAVES
            )
            model.tables[j] += step
            raw += step[binned[j]]
    width = [len(e) + 1 for e in model.pair_edges]

    def cells(a: int, b: int):
        at = coarse[a] * width[b] + coarse[b]
        grad, hess = slopes()
        shape = (width[a], width[b])
        size = width[a] * width[b]
        return np.bincount(at, grad, size).reshape(shape), np.bincount(at, hess, size).reshape(shape)

    usable = [j for j in range(d) if width[j] > 1]
    gains = sorted(((-_quarters(*cells(a, b))[0], a, b) for i, a in enumerate(usable) for b in usable[i + 1 :]))
    model.pairs = [(a, b) for _, a, b in gains[:PAIRS]]
    model.pair_tables = [np.zeros((width[a], width[b])) for a, b in model.pairs]
    for _ in range(ROUNDS // 4):
        for table, (a, b) in zip(model.pair_tables, model.pairs):
            step = RATE * _quarters(*cells(a, b))[1]
            table += step
            raw += step[coarse[a], coarse[b]]
    return model


def fit_quality(
    docs: DataFrame, labels: DataFrame, learn: Column | None = None, sample: int = SAMPLE,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> AdditiveModel:
    """Fit on at most ``sample`` labelled rows, chosen by a hash of the identifier.

    ``learn`` says which rows of ``labels`` may be used. Null identifiers and labels other than
    0 and 1 are left out. Only the sample, bounded in rows, is sent to the executors and only its
    features come back.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    if learn is not None:
        usable = usable.where(learn)
    chosen = (
        usable.select(F.col(id_col).alias("row_id"), F.col(label_col).cast("int").alias("_label"))
        .orderBy(F.xxhash64("row_id"), "row_id", "_label").limit(sample)
    )
    rows = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "row_id").select("row_text", "_label")
    schema = "label int, features array<double>"

    def run(batches):
        for b in batches:
            x = feature_rows(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(list(x), pa.list_(pa.float64()))], names=["label", "features"])

    got = rows.mapInArrow(tidy(run), schema).toPandas().sort_values(["label"], kind="stable")
    x = np.array(got["features"].tolist(), float).reshape(len(got), len(FEATURES))
    order = np.lexsort((*x.T, got["label"].to_numpy()))  # independent of the order of the tasks
    return fit_additive(x[order], got["label"].to_numpy(float)[order])


def quality_scores(
    docs: DataFrame, model: AdditiveModel, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ``score``, ``predicted``) of every document.

    Null and empty texts are scored like any other, with all features zero. Repeated rows give
    repeated results; other columns are not read.
    """

    def start():
        return lambda texts: [model.score(feature_rows(texts))]

    scored = map_texts(docs, id_col, text_col, [T.StructField("score", T.DoubleType())], start)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: AdditiveModel, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows that score below ``threshold``.

    Repeated rows share their score; null and empty texts are scored too; no rows give none.
    """
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            good = model.score(feature_rows(b.column(at).to_pylist())) >= threshold
            yield b.filter(pa.array(good, pa.bool_()))

    return map_rows(docs, run)
