"""Toxicity by a classifier chain.

The categories of the labels are predicted one after the other. Each has a linear model over the presence of
features; from the second on, the model also sees the probabilities of the categories before it. So that it learns
from probabilities like those it will meet, these are predicted out of fold: each fold by a model trained on the
others. Models are fitted on a bounded sample of labelled documents and applied to every document.

Features are terms, which are words and their first four letters, and marks of terms that are frequent in the
document (at least twice, and one or three in a hundred words).
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from itertools import chain as chained

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_and_text, let_go, per_batch, texts_of

WORD = re.compile(r"[^\W\d_]{2,}")
FOLDS = 5
#: Shares of a document's words from which a term counts as frequent; each adds a "+" to its name.
FREQUENT = (0.01, 0.03)
#: Words a worker remembers the features of.
CACHE = 100_000


def terms(word: str) -> list[str]:
    return [word, f"^{word[:4]}"] if len(word) > 4 else [word]


def marks(counts: Counter, n: int) -> list[str]:
    return [t + "+" * k for t, c in counts.items() for k in range(1 + (c > 1) * sum(c >= share * n for share in FREQUENT))]


def features(text: str) -> list[str]:
    words = WORD.findall(text.lower())
    counts: Counter = Counter()
    for word, n in Counter(words).items():
        for t in terms(word):
            counts[t] += n
    return sorted(marks(counts, len(words)))


def _sparse(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([i for r in rows for i in r], np.int64), np.array([len(r) for r in rows], np.int64)


def fit(columns: np.ndarray, rows: np.ndarray, n: int, width: int, dense: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 150) -> np.ndarray:
    """Logistic regression with an L2 penalty by accelerated gradient steps. Features are the ones at
    (rows, columns), then the dense columns, then the constant."""
    size = width + dense.shape[1] + 1
    w, momentum = np.zeros(size), np.zeros(size)
    # The curvature is at most a quarter of the largest squared row norm times n; bounded by feature counts.
    counts = np.bincount(columns, minlength=width)
    scale = np.concatenate([np.sqrt(counts + 1.0), np.sqrt((dense**2).sum(0) + 1.0), [math.sqrt(n + 1.0)]])
    widest = (np.bincount(rows, minlength=n).max() if len(rows) else 0) + dense.shape[1] + 1
    rate = 4.0 / (widest + l2)
    for step in range(steps):
        ahead = w + momentum * (step / (step + 3.0))
        v = ahead / scale
        z = np.bincount(rows, v[columns], minlength=n) + dense @ v[width:-1] + v[-1]
        miss = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = np.concatenate([np.bincount(columns, miss[rows], minlength=width), dense.T @ miss, [miss.sum()]]) / scale
        g[:-1] += l2 * ahead[:-1] / scale[:-1] ** 2
        new = ahead - rate * g
        momentum, w = new - w, new
    return w / scale


def _predict(w: np.ndarray, columns: np.ndarray, rows: np.ndarray, n: int, width: int, dense: np.ndarray) -> np.ndarray:
    z = np.bincount(rows, w[columns], minlength=n) + dense @ w[width:-1] + w[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_chain(words: list[list[str]], labels: list[list[float | None]], folds: list[int], max_features: int = 2048, least_z: float = 4.0) -> dict:
    """``words``: the distinct words of each document; ``labels``: its categories in chain order, None where
    unknown. Features are the words most clearly tied to a category (z of the log odds at least ``least_z``)."""
    y = np.array([[np.nan if v is None else float(v) for v in row] for row in labels], float).reshape(len(labels), -1)
    seen: dict[str, int] = {}
    for row in words:
        for w in row:
            seen[w] = seen.get(w, 0) + 1
    names = sorted(w for w, c in seen.items() if c >= 5)
    place = {w: i for i, w in enumerate(names)}
    columns, lengths = _sparse([[place[w] for w in row if w in place] for row in words])
    rows = np.repeat(np.arange(len(words)), lengths)
    z = np.zeros(len(names))
    for c in range(y.shape[1]):
        known, yes = ~np.isnan(y[:, c]), y[:, c] == 1
        with_word = [np.bincount(columns[m[rows]], minlength=len(names)) + 0.5 for m in (known & yes, known & ~yes)]
        totals = [(known & yes).sum() + 1.0, (known & ~yes).sum() + 1.0]
        odds = [np.log(k / np.maximum(t - k, 0.5)) for k, t in zip(with_word, totals)]
        spread = np.sqrt(sum(1 / k + 1 / np.maximum(t - k, 0.5) for k, t in zip(with_word, totals)))
        z = np.maximum(z, np.abs(odds[0] - odds[1]) / spread)
    chosen = sorted(np.flatnonzero(z >= least_z).tolist(), key=lambda i: (-z[i], names[i]))[:max_features]
    number = np.full(len(names), -1)
    number[chosen] = np.arange(len(chosen))
    keep = number[columns] >= 0 if len(columns) else np.zeros(0, bool)
    columns, rows = number[columns[keep]], rows[keep]
    width, n, fold = len(chosen), len(words), np.array(folds, int)
    dense, models = np.zeros((n, 0)), []
    for c in range(y.shape[1]):
        known = ~np.isnan(y[:, c])

        def trained(on: np.ndarray) -> np.ndarray:
            index = np.cumsum(on) - 1
            mine = on[rows]
            return fit(columns[mine], index[rows[mine]], int(on.sum()), width, dense[on], y[on, c])

        if len(np.unique(y[known, c])) < 2:
            rate = float(y[known, c].mean()) if known.any() else 0.0
            edge = math.log(max(rate, 1e-9) / max(1 - rate, 1e-9))
            models.append(np.concatenate([np.zeros(width + c), [edge]]))
            held = np.full(n, rate)
        else:
            models.append(trained(known))
            held = _predict(models[-1], columns, rows, n, width, dense)
            for f in range(FOLDS):
                if len(np.unique(y[known & (fold != f), c])) == 2:
                    other = _predict(trained(known & (fold != f)), columns, rows, n, width, dense)
                    held = np.where(fold == f, other, held)
        dense = np.concatenate([dense, held[:, None]], axis=1)
    return {"words": {names[i]: k for k, i in enumerate(chosen)}, "models": models}


def train(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = ("quality", "toxic"), max_labelled: int = 8_000, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The chain, fitted on at most about ``max_labelled`` labelled documents, chosen by a hash of their id.

    Labels with a null id or no text are left out; a document labelled twice differently counts with the larger
    label. The sample is what one task reads, which its bound keeps small.
    """
    marks = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_labelled")).agg(*(F.max(F.col(c).cast("double")).alias(f"_y{i}") for i, c in enumerate(categories)))
    total = marks.count()
    share = min(1.0, 0.98 * max_labelled / total) if total else 1.0
    marks = marks.filter(F.pmod(F.xxhash64("_labelled"), F.lit(1_000_000)) < int(share * 1_000_000))
    text = docs.select(F.col(id_col).cast("long").alias("_labelled"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    # At most max_labelled rows of numbers: small whatever the size of the corpus.
    sample = text.join(F.broadcast(marks), "_labelled").dropDuplicates(["_labelled"])

    def shrink(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = [features(t) for t in texts_of(batch)]
        return pa.RecordBatch.from_arrays([batch.column("_labelled"), pa.array(words, pa.list_(pa.string())), *(batch.column(f"_y{i}") for i in range(len(categories)))], names=["_labelled", "words", *(f"_y{i}" for i in range(len(categories)))])

    ys = ", ".join(f"_y{i} double" for i in range(len(categories)))
    shrunk = per_batch(sample, shrink, f"_labelled bigint, words array<string>, {ys}")

    def learn(batches):
        let_go()
        ids, words, marked, names = [], [], [], {}
        for batch in batches:
            ids += batch.column("_labelled").to_pylist()
            words += [[names.setdefault(w, w) for w in row] for row in batch.column("words").to_pylist()]
            marked += list(zip(*(batch.column(f"_y{i}").to_pylist() for i in range(len(categories)))))
        if not ids:
            return
        order = sorted(range(len(ids)), key=ids.__getitem__)
        made = fit_chain([words[i] for i in order], [list(marked[i]) for i in order], [k % FOLDS for k in range(len(order))])
        yield pa.RecordBatch.from_arrays([pa.array([list(made["words"])], pa.list_(pa.string())), pa.array([[m.tolist() for m in made["models"]]], pa.list_(pa.list_(pa.float64())))], names=["words", "models"])

    found = shrunk.repartition(1).mapInArrow(learn, "words array<string>, models array<array<double>>").collect()
    if not found or not found[0]["models"]:
        return {"words": {}, "models": [np.array([0.0] * c + [-20.7]) for c in range(len(categories))]}
    return {"words": {w: i for i, w in enumerate(found[0]["words"])}, "models": [np.array(m) for m in found[0]["models"]]}


class Scorer:
    """A fitted chain in one Python worker, with the terms of the words met so far that are features."""

    def __init__(self, chain: dict):
        self.number, self.models = chain["words"], chain["models"]
        self.known = {w.rstrip("+") for w in self.number}
        self.cache: dict[str, tuple[str, ...]] = {}

    def counts(self, words: list[str]) -> Counter:
        got = list(map(self.cache.get, words))
        if None in got:
            for w, found in zip(words, got):
                if found is None and w not in self.cache:
                    self.cache[w] = tuple(t for t in terms(w) if t in self.known)
            got = map(self.cache.__getitem__, words)
        return Counter(chained.from_iterable(filter(None, got)))

    def probabilities(self, texts: list[str]) -> np.ndarray:
        """One row per text, one column per category."""
        if len(self.cache) > CACHE:
            self.cache.clear()
        found = []
        for text in texts:
            words = WORD.findall(text.lower())
            found.append([self.number[m] for m in marks(self.counts(words), len(words)) if m in self.number])
        columns, lengths = _sparse(found)
        rows, dense, width = np.repeat(np.arange(len(texts)), lengths), np.zeros((len(texts), 0)), len(self.number)
        for model in self.models:
            p = _predict(model, columns, rows, len(texts), width, dense)
            dense = np.concatenate([dense, p[:, None]], axis=1)
        return dense


_SCORERS: dict[str, Scorer] = {}


def score(docs: DataFrame, chain: dict, categories: tuple[str, ...] = ("quality", "toxic"), text_col: str = "text", prefix: str = "p_") -> DataFrame:
    """All columns of the input and one probability column per category, named ``prefix`` + category (which
    must not be among them). Null and empty texts have no words and get the models' base rates; rows are
    neither dropped nor merged."""
    sent, key = docs.sparkSession.sparkContext.broadcast(chain), uuid.uuid4().hex
    names = [prefix + c for c in categories]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Scorer(sent.value)
        p = _SCORERS[key].probabilities(texts_of(batch, text_col))
        return pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(p[:, i]) for i in range(len(names)))], names=[*batch.schema.names, *names])

    clash = set(names) & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are taken; choose another prefix")
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)])
    return per_batch(docs, work, schema)
