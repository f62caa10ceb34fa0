"""Toxicity by non-negative positive-unlabelled learning.

A linear model over the set of a text's features (its words, and the first
``PREFIXES`` letters of each) is trained in numpy from confirmed toxic texts
(positive) and unlabelled texts.  It minimises the class-prior-corrected
estimate of the risk

    prior * R(positive, +1) + max(0, R(unlabelled, -1) - prior * R(positive, -1))

under the sigmoid loss.  The second part stands for the risk of the unseen
negatives; where it falls below zero, the step goes against it instead of
with it, so that the model doesn't just memorise the positives.  The class
prior is the share of toxic texts among the labelled ones.

The vocabulary is drawn from the sampled texts: features that stand in at
least ``MIN_DF`` of the positives, in a larger share of them than of the
unlabelled ones by ``MIN_Z`` standard errors; the ``MAX_VOCABULARY`` most
telling ones.

Training reads bounded samples drawn by a hash of the id:
``MAX_POSITIVES`` toxic texts and ``MAX_UNLABELLED`` of all texts that may be
learnt from; where rows share an id, one of them.  Features are counted by Spark jobs; only counts and the sampled
texts' feature numbers reach the driver.  Scoring covers every whole text.
Labels, language, source and id are no inputs of a score.

Null and empty texts have no feature and score by the intercept alone; with
no positive sample every text scores 0.  Equal texts score alike.  Rows with
a null id are scored, not learnt from.  An input column named like an output
column is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordstats.llm.common import bound_batches, id_remainder, table, with_replaced
from wordstats.operators.lookup import store

MAX_POSITIVES = 3000
MAX_UNLABELLED = 12000
PREFIXES = range(3, 9)
MIN_DF = 4
MIN_Z = 4.0
MAX_VOCABULARY = 4096
STEPS = 400
RATE = 0.1
L2 = 3e-4
THRESHOLD = 0.7
#: Words whose features a worker remembers.
REMEMBERED = 100_000

_WORD = re.compile(r"\w+")


def features_of(word: str) -> list[str]:
    return [word + "$", *[word[:n] for n in PREFIXES if n <= len(word)]]


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def features(text: str | None) -> set[str]:
    return {f for w in words_of(text) for f in features_of(w)}


@dataclass
class Index:
    """Numbers of the vocabulary's features."""

    numbers: dict[str, int]
    _known: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False, compare=False)

    def of(self, text: str | None) -> set[int]:
        found: set[int] = set()
        known, numbers = self._known, self.numbers
        for w in words_of(text):
            hits = known.get(w)
            if hits is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                hits = known[w] = tuple(numbers[f] for f in features_of(w) if f in numbers)
            if hits:
                found.update(hits)
        return found


@dataclass
class Model:
    index: Index
    weights: np.ndarray
    intercept: float

    def score(self, text: str | None) -> float:
        found = sorted(self.index.of(text))
        return float(sigmoid(self.weights[found].sum() + self.intercept))


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def _draw(rows: DataFrame, most: int, salt: int) -> DataFrame:
    """At most ``most`` of the rows' ids, by a hash of the id."""
    return (rows.select("doc_id").distinct()
            .orderBy(F.xxhash64("doc_id", F.lit(salt)), "doc_id").limit(most))


def _sample(docs: DataFrame, labels: DataFrame, use: Column) -> tuple[DataFrame, float]:
    """Sampled texts (doc_id, positive, text), stored, and the class prior."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & use)
             .select("doc_id", "toxic"))
    counts = known.agg(F.count("*").alias("n"), F.sum(F.col("toxic").cast("long")).alias("pos")).first()
    prior = (counts["pos"] or 0) / counts["n"] if counts["n"] else 0.0
    own = docs.filter(F.col("doc_id").isNotNull() & use).select("doc_id", "text")
    drawn = (_draw(known.filter(F.col("toxic") == 1), MAX_POSITIVES, 1).withColumn("positive", F.lit(True))
             .unionByName(_draw(own, MAX_UNLABELLED, 2).withColumn("positive", F.lit(False))))
    # MAX_POSITIVES + MAX_UNLABELLED ids at most: a bounded table, and one of
    # each id's rows, chosen within each task first.
    rows = (own.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "positive")
            .agg(F.min_by("text", F.xxhash64("text")).alias("text")))
    return store(rows, "sample"), prior


def _counts(texts: DataFrame, wanted: Broadcast | None) -> DataFrame:
    """(f, n): the number of texts with each feature (of the wanted ones)."""
    @F.pandas_udf("array<string>")
    def found(batch: pd.Series) -> pd.Series:
        if wanted is None:
            return pd.Series([sorted(features(t)) for t in batch], dtype=object)
        return pd.Series([sorted(features(t) & wanted.value) for t in batch], dtype=object)

    return (texts.select(F.explode(found("text")).alias("f")).groupBy("f")
            .agg(F.count("*").alias("n")))


def vocabulary(sample: DataFrame) -> list[str]:
    """The features that tell the positive sample from the unlabelled one."""
    sc = sample.sparkSession.sparkContext
    sizes = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    n_pos, n_unl = sizes.get(True, 0), sizes.get(False, 0)
    if not n_pos or not n_unl:
        return []
    # Bounded by the features of MAX_POSITIVES texts that MIN_DF of them share.
    pos = {r["f"]: r["n"] for r in _counts(sample.filter("positive"), None)
           .filter(F.col("n") >= MIN_DF).collect()}
    wanted = sc.broadcast(frozenset(pos))
    unl = {r["f"]: r["n"] for r in _counts(sample.filter("not positive"), wanted).collect()}
    told = []
    for f, a in pos.items():
        b = unl.get(f, 0)
        share = (a + b) / (n_pos + n_unl)
        error = (share * (1 - share) * (1 / n_pos + 1 / n_unl)) ** 0.5
        if error and a / n_pos - b / n_unl >= MIN_Z * error:
            told.append(((b / n_unl - a / n_pos) / error, f))
    return [f for _, f in sorted(told)[:MAX_VOCABULARY]]


class _Rows:
    """Texts as rows of feature numbers."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.n, self.width = len(rows), width
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        self.col = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)

    def margins(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.col], minlength=self.n) + w[-1]

    def gradient(self, slopes: np.ndarray) -> np.ndarray:
        g = np.bincount(self.col, weights=slopes[self.row], minlength=self.width + 1)
        g[-1] = slopes.sum()
        return g / self.n


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], width: int, prior: float) -> np.ndarray:
    """``width`` weights and the intercept that minimise the non-negative risk."""
    pos, unl = _Rows(positive, width), _Rows(unlabelled, width)
    w = np.zeros(width + 1)
    w[-1] = -1.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        p, u = sigmoid(pos.margins(w)), sigmoid(unl.margins(w))
        # Sigmoid loss of class +1 is 1 - s, of class -1 is s; their slopes are -+ s (1 - s).
        pos_slope, unl_slope = pos.gradient(p * (1 - p)), unl.gradient(u * (1 - u))
        if u.mean() - prior * p.mean() >= 0:
            grad = -2 * prior * pos_slope + unl_slope
        else:  # the estimate of the negatives' risk is below zero: step back
            grad = prior * pos_slope - unl_slope
        grad[:-1] += L2 * prior * w[:-1]
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        w = w - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return w


def train(docs: DataFrame, labels: DataFrame, use: Column) -> Model:
    """The model learnt from the rows that ``use`` (over the id) allows."""
    bound_batches(docs.sparkSession)
    sample, prior = _sample(docs, labels, use)
    index = Index({f: i for i, f in enumerate(vocabulary(sample))})
    width = len(index.numbers)
    if not width or not 0 < prior < 1:
        return Model(index, np.zeros(width), -1000.0)
    numbered = sample.sparkSession.sparkContext.broadcast(index.numbers)

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Index(numbered.value)
        for batch in batches:
            yield pd.Series([sorted(own.of(t)) for t in batch], dtype=object)

    rows: dict[bool, list] = {True: [], False: []}
    for r in sample.select("positive", "doc_id", encode("text").alias("x")).toLocalIterator():
        rows[r["positive"]].append((r["doc_id"], r["x"]))
    pos, unl = ([np.array(x, dtype=np.int64) for _, x in sorted(rows[k])] for k in (True, False))
    w = fit(pos, unl, width, prior)
    return Model(index, w[:-1], float(w[-1]))


def score_texts(docs: DataFrame, model: Broadcast, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from THRESHOLD)."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([model.value.score(t) for t in batch], dtype=float)

    scored = with_replaced(docs, {"score": score(F.col(text))})
    return with_replaced(scored, {"predicted": F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)})


def learnable() -> Column:
    """Rows whose labels may be learnt from: the id's remainder isn't 1."""
    return id_remainder(3) != 1


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: learn from the rows that may be learnt from, score all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = spark.sparkContext.broadcast(train(docs, table(spark, sf_dir, "labels"), learnable()))
    held_out = F.coalesce(id_remainder(3) == 1, F.lit(False))
    return (score_texts(docs.select("doc_id", "text", held_out.alias("held_out")), model)
            .select("doc_id", "held_out", "score", "predicted"))
