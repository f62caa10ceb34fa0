import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from wordstats.llm import toxicity

from llm_tables import AWKWARD, SF_MID, docs_of  # noqa: F401


def test_held_out_accuracy(spark):
    rows = toxicity.query(spark, SF_MID).collect()
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    assert len(rows) == docs.count()
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [(r, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    toxic = [r.predicted for r, t in held if t]
    clean = [r.predicted for r, t in held if not t]
    assert sum(toxic) >= 0.5 * len(toxic) and sum(clean) <= 0.03 * len(clean)


def test_learns_from_positive_and_unlabelled_only():
    rng = np.random.default_rng(1)
    noise = lambda: rng.choice(40, 3, replace=False) + 5
    marks = lambda: rng.choice(5, 2, replace=False)
    positive = [np.concatenate((marks(), noise())) for _ in range(300)]
    toxic = [i % 10 == 0 for i in range(3000)]
    unlabelled = [np.concatenate((marks(), noise())) if t else noise() for t in toxic]
    w = toxicity.fit(positive, unlabelled, 45, 0.1)
    assert (w == toxicity.fit(positive, unlabelled, 45, 0.1)).all()
    score = toxicity.sigmoid(toxicity._Rows(unlabelled, 45).margins(w))
    toxic = np.array(toxic)
    assert (score[toxic] >= 0.7).mean() > 0.95 and (score[~toxic] >= 0.7).mean() < 0.01


def test_awkward_rows(spark, docs_of):
    docs = docs_of(AWKWARD).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(5, 1, 1), (6, 0, 0), (6, 0, 0), (None, 1, 1), (7, None, None), (3, 0, 0),
                                    (4, 0, 0), (8, 1, 0)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0), labels.filter("toxic = 0")):
        model = toxicity.train(docs, known, F.lit(True))
        rows = toxicity.score_texts(docs, spark.sparkContext.broadcast(model)).collect()
        assert len(rows) == len(AWKWARD)
        assert all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    model = spark.sparkContext.broadcast(toxicity.train(docs_of([]), labels.limit(0), F.lit(True)))
    assert toxicity.score_texts(docs_of([]), model).count() == 0


def test_rows_of_one_id_are_learnt_from_once(spark, docs_of):
    docs = docs_of([(1, f"text {i}") for i in range(40)] + [(1, None), (2, "two"), (3, "three"), (3, "three")])
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    sample, _ = toxicity._sample(docs, labels, F.lit(True))
    assert sorted((r.doc_id, r.positive) for r in sample.collect()) == [
        (1, False), (1, True), (2, False), (3, False)]
    again, _ = toxicity._sample(docs.repartition(7), labels, F.lit(True))
    assert sorted(map(str, sample.collect())) == sorted(map(str, again.collect()))


def brute_score(model, text):
    """The score from the words as the module's text describes the features."""
    words = set(re.findall(r"\w+", (text or "").lower()))
    found = {w + "$" for w in words} | {w[:n] for w in words for n in toxicity.PREFIXES if n <= len(w)}
    total = math.fsum(model.weights[model.index.numbers[f]] for f in found if f in model.index.numbers)
    return float(toxicity.sigmoid(total + model.intercept))


def test_scores_equal_a_plain_loop(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    model = toxicity.train(docs, spark.read.parquet(f"{SF_MID}/labels.parquet"), toxicity.learnable())
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = toxicity.query(spark, SF_MID).collect()
    assert len(rows) == len(texts)
    for r in rows:
        score = brute_score(model, texts[r.doc_id])
        assert abs(score - r.score) < 1e-9 and r.predicted == int(r.score >= 0.7)


def plain_risk(w, pos, unl, prior):
    """(the positives' part, the negatives' part) of the risk with the sigmoid loss."""
    s = lambda rows: [1 / (1 + math.exp(-(sum(w[i] for i in r) + w[-1]))) for r in rows]
    p, u = s(pos), s(unl)
    lost = sum(1 - x for x in p) / len(p)
    negative = sum(u) / len(u) - prior * sum(p) / len(p)
    return prior * lost, negative


def test_fit_follows_the_risk_s_slope(monkeypatch):
    """The first steps of the descent, with slopes taken from the risk itself
    (later ones turn round where the negatives' part is zero, where rounding
    may decide which way a step goes)."""
    monkeypatch.setattr(toxicity, "STEPS", 40)
    rng = np.random.default_rng(4)
    pos = [rng.choice(6, 2, replace=False) for _ in range(15)]
    unl = [rng.choice(6, 2, replace=False) for _ in range(25)]
    for prior in (0.2, 0.85):    # (at 0.9 a slope is 0 at the start, and rounding decides its step)
        w = np.zeros(7)
        w[-1] = -1.0
        m, v, below = np.zeros(7), np.zeros(7), 0
        for step in range(1, toxicity.STEPS + 1):
            negative = plain_risk(w, pos, unl, prior)[1]
            below += negative < 0
            goal = (lambda x: sum(plain_risk(x, pos, unl, prior))) if negative >= 0 else (
                lambda x: -plain_risk(x, pos, unl, prior)[1])
            grad = np.array([(goal(w + d) - goal(w - d)) / 2e-5 for d in np.eye(7) * 1e-5])
            grad[:-1] += toxicity.L2 * prior * w[:-1]
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            w = w - toxicity.RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        assert (below > 0) == (prior == 0.85)   # the step back is taken there only
        assert np.abs(toxicity.fit(pos, unl, 6, prior) - w).max() < 1e-6
