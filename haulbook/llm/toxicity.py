"""A toxicity classifier that is regularised by counterfactuals.

Logistic regression over the presence of words and word beginnings. In labelled sentences that mention a group,
the group's term is swapped for another of its kind, and the squared change of the sentence's score is
added to the loss: what a sentence says counts, not whom it names, which lowers the false positives on neutral mentions.

Fitted on at most ``max_rows`` labelled rows (the smallest of a seeded hash of the id), which bounds what the
driver gets; scored are whole texts of all rows. A null or empty text has no features and gets
the score of the intercept. Rows without a label, or with a null one, are not learned from; a document labelled more
than once is toxic if one label says so; equal texts have equal scores. Without labelled rows, or with one class only,
the score is the share of toxic ones (0 without rows). An empty table gives an empty result. ``score`` and
``predicted`` replace columns of these names; others are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulbook.llm.common import add_columns, slices

FOLDS, HELD_OUT_FOLD = 5, 0
MAX_ROWS = 20_000
MIN_ROWS_OF_FEATURE = 3
MIN_RATIO = 8.0
BEGINNINGS = (4, 5)
PENALTY = 1.0  # of squared weights, for the whole sample
COUNTERFACTUAL = 10.0
STEPS = 400
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n]+")
REMEMBERED = 1 << 18

# Groups of terms that can stand for each other; a parameter of the operator.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men"),
    ("woman", "man"),
    ("female", "male"),
    ("girl", "boy"),
    ("girls", "boys"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "indigenous"),
    ("african", "european", "american", "mexican", "chinese", "indian", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "heterosexual", "homosexual", "queer"),
    ("transgender", "cisgender"),
    ("immigrant", "native"),
    ("immigrants", "natives"),
    ("disabled", "deaf", "blind"),
    ("old", "young"),
)


def word_features(word: str) -> list[str]:
    """A lower-case word, and its beginnings (marked, so that they are no words)."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def words_of(text: str | None) -> set[str]:
    """The distinct words of a whole text in lower case."""
    if not text:
        return set()
    if len(text) < 4 << 20:
        return set(WORD.findall(text.lower()))
    return {m[0].lower() for m in WORD.finditer(text)}


def swapped(sentence: str, groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> list[str]:
    """The sentence with its identity terms replaced by each other term of their kind, once for each turn;
    empty if it names no group."""
    turn = {t: (g, i) for g in groups for i, t in enumerate(g)}
    lower = sentence.lower()
    found = [turn[w] for w in WORD.findall(lower) if w in turn]
    if not found:
        return []

    def other(step: int):
        def term(m: re.Match) -> str:
            if m[0] not in turn:
                return m[0]
            group, i = turn[m[0]]
            return group[(i + step) % len(group)]

        return WORD.sub(term, lower)

    return [other(step) for step in range(1, max(len(g) for g, _ in found))]


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    intercept: float = 0.0
    constant: float | None = None  # the score of every text, if nothing could be fitted

    def score(self, text: str | None, memory: dict[str, float | None] | None = None) -> float:
        """Probability of label 1; ``memory`` keeps the features of words between calls."""
        if self.constant is not None:
            return self.constant
        memory = {} if memory is None else memory
        hits: set[str] = set()
        for word in words_of(text):
            known = memory.get(word)
            if known is None:
                known = memory[word] = tuple(f for f in word_features(word) if f in self.weights)
            hits.update(known)
        total = self.intercept + sum(self.weights[f] for f in sorted(hits))
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def _sparse(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the ones of a 0/1 matrix."""
    lengths = [len(r) for r in rows]
    columns = np.array([c for r in rows for c in r], np.int64)
    return np.repeat(np.arange(len(rows)), lengths), columns


def fit(
    rows: list[list[int]],
    labels: np.ndarray,
    features: int,
    pairs: list[tuple[list[int], list[int]]],
    penalty: float = PENALTY,
    counterfactual: float = COUNTERFACTUAL,
    steps: int = STEPS,
) -> tuple[np.ndarray, float]:
    """Weights and intercept: balanced log loss, squared weights, and squared score changes of the pairs."""
    r, c = _sparse(rows)
    pr, pc = _sparse([a for a, _ in pairs])
    qr, qc = _sparse([b for _, b in pairs])
    n, positive = len(labels), labels.mean()
    share = np.where(labels == 1, 0.5 / positive, 0.5 / (1 - positive)) / n
    w, b = np.zeros(features), 0.0
    m, v = np.zeros(features + 1), np.zeros(features + 1)
    for step in range(1, steps + 1):
        z = np.bincount(r, w[c], n) + b
        error = share * (1 / (1 + np.exp(-z)) - labels)
        grad = np.bincount(c, error[r], features) + penalty * w / n
        if pairs:
            change = np.bincount(pr, w[pc], len(pairs)) - np.bincount(qr, w[qc], len(pairs))
            pull = 2 * counterfactual * change / len(pairs)
            grad += np.bincount(pc, pull[pr], features) - np.bincount(qc, pull[qr], features)
        whole = np.append(grad, error.sum())
        m, v = 0.9 * m + 0.1 * whole, 0.999 * v + 0.001 * whole**2
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def _feature_counts(rows: DataFrame) -> DataFrame:
    """(feature, toxic, clean): in how many rows of either class each feature occurs; summed per task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            names = list(counts[0].keys() | counts[1].keys())
            arrays = [pa.array(names, pa.string()), *(pa.array([c[x] for x in names], pa.int64()) for c in counts[::-1])]
            return pa.RecordBatch.from_arrays(arrays, names=["feature", "toxic", "clean"])

        for batch in batches:
            for part in slices(batch, "text"):
                for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    counts[toxic].update({f for w in words_of(text) for f in word_features(w)})
                if len(counts[0]) + len(counts[1]) > 1 << 20:
                    yield out()
                    counts = (Counter(), Counter())
        yield out()

    parts = rows.select("text", "toxic").mapInArrow(count, "feature string, toxic long, clean long")
    return parts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_rows: int = MAX_ROWS,
    groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
    counterfactual: float = COUNTERFACTUAL,
    min_ratio: float = MIN_RATIO,
) -> Model:
    """A model from the labelled rows where ``train`` (a condition on the id) holds.

    Features are all words and beginnings whose presence tells enough about the class: their log
    likelihood ratio is at least ``min_ratio``, which chance gives to one feature in some ten thousand. They are of the
    ``max_rows`` rows only, and so is what the driver gets.
    """
    known = labels.filter(train & F.col(label).isin(0, 1) & F.col(id_column).isNotNull())
    known = known.groupBy(F.col(id_column).alias("id")).agg(F.max(label).cast("int").alias("toxic"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    known = docs.sparkSession.createDataFrame(known.collect(), known.schema)  # at most max_rows ids and labels
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).join(F.broadcast(known), "id")
    rows = rows.select("id", "text", "toxic")
    n1, n = rows.agg(F.sum("toxic"), F.count("*")).first()
    if not n or n1 in (0, n):
        return Model(constant=float(n1 or 0) / n if n else 0.0)
    a, b = F.col("toxic"), F.col("clean")

    def part(seen: Column, of: float) -> Column:
        """One term of the likelihood ratio of feature and class."""
        return F.when(seen > 0, seen * F.log(seen * n / ((a + b) * of))).otherwise(0.0)

    ratio = part(a, n1) + part(b, n - n1)
    counted = _feature_counts(rows).filter((a + b >= MIN_ROWS_OF_FEATURE) & (ratio >= min_ratio))
    chosen = counted.orderBy(F.desc(ratio), "feature")
    names = [r["feature"] for r in chosen.select("feature").collect()]
    index = {f: i for i, f in enumerate(names)}

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(words: set[str]) -> list[int]:
            return sorted({index[f] for w in words for f in word_features(w) if f in index})

        terms = {t for g in groups for t in g}
        for batch in batches:
            for part in slices(batch, "text"):
                ids, toxic, here, pairs = part.column(0), part.column(2), [], []
                for value in part.column(1).to_pylist():
                    words, changed = words_of(value), {}
                    here.append(found(words))
                    if not terms.isdisjoint(words):
                        for sentence in SENTENCE.findall(value):
                            for other in swapped(sentence, groups):
                                x, y = found(words_of(sentence)), found(words_of(other))
                                both = set(x) & set(y)  # what is left of either has no say
                                pair = tuple(i for i in x if i not in both), tuple(i for i in y if i not in both)
                                if any(pair):
                                    changed[pair] = None
                    pairs.append([[list(x), list(y)] for x, y in changed])
                kind = pa.list_(pa.list_(pa.list_(pa.int32())))
                arrays = [ids, toxic, pa.array(here, pa.list_(pa.int32())), pa.array(pairs, kind)]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "toxic", "here", "pairs"])

    kind = rows.schema["id"].dataType.simpleString()
    located = rows.mapInArrow(locate, f"id {kind}, toxic int, here array<int>, pairs array<array<array<int>>>")
    sample = sorted(located.collect(), key=lambda r: (r["id"], r["here"]))  # at most max_rows short lists
    pairs = [(x, y) for r in sample for x, y in r["pairs"]]
    labels01 = np.array([r["toxic"] for r in sample], float)
    weights, intercept = fit([r["here"] for r in sample], labels01, len(names), pairs, counterfactual=counterfactual)
    return Model(dict(zip(names, weights.tolist(), strict=True)), intercept)


def with_toxicity(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``score`` and ``predicted`` (1 from 0.5 on) of every whole text; no shuffle."""
    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]

    def work():
        memory: dict = {}

        def apply(texts: list) -> list[pa.Array]:
            if len(memory) > REMEMBERED:
                memory.clear()
            scores = [model.score(t, memory) for t in texts]
            return [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())]

        return apply

    return add_columns(df, text, fields, work)
