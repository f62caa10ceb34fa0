"""Secret scans: fixed patterns plus character Markov models.

Three base patterns (``BASE`` below) find assignments, access keys and long
hexadecimal runs.  On top, tokens outside the base spans, and what the base
spans leave of tokens, are scored by
two first-order character Markov models, one of random strings and one of
ordinary identifiers; a token of any length whose log-likelihood ratio per
character and in total passes the thresholds is a span of kind ``markov``.  The models are
trained from labelled samples: values that the base patterns found (random)
and the other identifiers of the same documents (ordinary), over a bounded
sample of documents drawn by a hash of the id, plus random strings drawn
from fixed alphabets with a fixed seed.

Spans are in code points, end exclusive.  Null and empty texts have no
spans; equal texts have equal spans.  Rows with a null id are scanned like
others.  Extra columns pass through; an input column named like an output
column is replaced.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordstats.llm.common import bound_batches, table, with_replaced

# The base patterns, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ASSIGN_MIN = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_MIN = 20
HEX = re.compile(r"[0-9a-f]{24,}")
# One of these is in every text that the first pattern fits.
ASSIGN_WORDS = ("passw", "secret", "token", "api")

#: Assigned values from this length on, and identifiers, are what the models learn from.
TOKEN_MIN = 20
IDENTIFIER = re.compile(r"[A-Za-z0-9_-]+")
#: Log-likelihood ratio (natural logarithm) from which a token is a secret.
MIN_RATIO = 20.0
MIN_RATIO_PER_CHAR = 0.8
#: Documents sampled for training, and random strings per alphabet.
TRAIN_DOCS = 4000
RANDOM_STRINGS = 400
# Alphabets of the random strings (hexadecimal, base32, base62, base64).
ALPHABETS = (
    "0123456789abcdef",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
)
SYMBOLS = 128
#: Characters of the tokens that the models score.
TOKEN_CHARACTERS = np.isin(np.arange(SYMBOLS), [ord(c) for c in ALPHABETS[3] + "_=-"])
#: Characters scored at a time (and up to the end of a token).
CHUNK = 1 << 16
_NO_TOKEN = re.compile(r"[^A-Za-z0-9+/_=-]")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, in order of start,
    then of kind."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                  if len(m[2]) >= ASSIGN_MIN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= ACCESS_MIN]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _codes(token: str) -> np.ndarray:
    """Character codes with a start mark; what isn't ASCII counts as one symbol."""
    return np.concatenate(([0], np.minimum(np.frombuffer(token.encode("utf-32-le"), "<u4"),
                                           SYMBOLS - 1))).astype(np.int64)


def training_counts(text: str | None) -> dict[tuple[int, int, int], int]:
    """(class, character, next character) counts of one text: class 1 for
    values in base spans, 0 for the other identifiers."""
    counts: dict[tuple[int, int, int], int] = {}
    if not text:
        return counts
    spans = base_spans(text)
    samples = [(1, text[s:e]) for s, k, e in spans if k]
    samples += [(1, m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= TOKEN_MIN]
    covered = 0
    at = 0
    for m in IDENTIFIER.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():
            covered = max(covered, spans[at][2])
            at += 1
        if m.start() >= covered:
            samples.append((0, m[0]))
    for label, token in samples:
        codes = _codes(token).tolist()
        for a, b in zip(codes, codes[1:]):
            counts[label, a, b] = counts.get((label, a, b), 0) + 1
    return counts


def train(docs: DataFrame, sample: int = TRAIN_DOCS) -> np.ndarray:
    """The log ratio of the two models' transition probabilities, a
    ``SYMBOLS`` x ``SYMBOLS`` array."""
    bound_batches(docs.sparkSession)
    drawn = (docs.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct()
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))

    @F.pandas_udf("array<struct<label:int,a:int,b:int,n:long>>")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"label": k[0], "a": k[1], "b": k[2], "n": n}
                           for k, n in training_counts(t).items()] for t in texts], dtype=object)

    # `sample` ids at most: a bounded table.
    rows = (docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id", "left_semi")
            .select(F.explode(count("text")).alias("c"))
            .groupBy("c.label", "c.a", "c.b").agg(F.sum("c.n").alias("n")).collect())
    seen = np.zeros((2, SYMBOLS, SYMBOLS))
    for r in rows:
        seen[r["label"], r["a"], r["b"]] = r["n"]
    rng = random.Random(20)
    for alphabet in ALPHABETS:
        for _ in range(RANDOM_STRINGS):
            codes = _codes("".join(rng.choices(alphabet, k=40)))
            np.add.at(seen[1], (codes[:-1], codes[1:]), 1)
    smooth = seen + 0.5
    log_p = np.log(smooth / smooth.sum(axis=2, keepdims=True))
    return log_p[1] - log_p[0]


def markov_spans(text: str, base: list[tuple[int, int, int]], ratio: np.ndarray) -> list[tuple[int, int, int]]:
    """Tokens, cut at the base spans, that look random to the models."""
    out = []
    free = np.ones(len(text), dtype=bool)
    for s, _, e in base:
        free[s:e] = False
    at = 0
    while at < len(text):
        after = _NO_TOKEN.search(text, at + CHUNK)
        end = after.start() if after else len(text)
        codes = _codes(text[at:end])[1:]
        edges = np.flatnonzero(np.diff(TOKEN_CHARACTERS[codes] & free[at:end], prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        steps = ratio[codes[:-1], codes[1:]]
        sums = np.concatenate(([0.0], np.cumsum(steps)))
        least = np.maximum(MIN_RATIO, MIN_RATIO_PER_CHAR * (ends - starts))
        scores = ratio[0, codes[starts]] + sums[ends - 1] - sums[starts]
        # Running sums are rounded: what is near the threshold is summed on its own.
        for i in np.flatnonzero(scores >= least - 1e-3):
            s, e = int(starts[i]), int(ends[i])
            if float(ratio[0, codes[s]] + steps[s:e - 1].sum()) >= least[i]:
                out.append((at + s, 3, at + e))
        at = end
    return out


def find_spans(text: str | None, ratio: np.ndarray) -> tuple[list, list]:
    """(base spans, all spans) of one whole text."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, sorted(base + markov_spans(text, base, ratio))


def written(spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end, comma-joined."""
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact_text(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """``text`` with the union of the spans replaced, each run by one mark."""
    out, at = [], 0
    merged: list[list[int]] = []
    for s, _, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    for s, e in merged:
        out += [text[at:s], mark]
        at = e
    return "".join(out) + text[at:]


def scan(docs: DataFrame, model: Broadcast, text: str = "text") -> DataFrame:
    """``docs`` with ``n_assign``, ``n_access``, ``n_hex``, ``n_markov``,
    ``base_sha256`` and ``spans``."""
    names = ["n_assign", "n_access", "n_hex", "n_markov", "base_sha256", "spans"]

    @F.pandas_udf("n_assign long, n_access long, n_hex long, n_markov long, "
                  "base_sha256 string, spans string")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ratio = model.value
        for batch in batches:
            rows = []
            for t in batch:
                base, spans = find_spans(t, ratio)
                kinds = [k for _, k, _ in spans]
                rows.append((*[kinds.count(k) for k in range(4)],
                             hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
            yield pd.DataFrame(rows, columns=names)

    out = with_replaced(docs, {"_found": found(F.col(text))})
    return with_replaced(out, {c: F.col("_found")[c] for c in names}).drop("_found")


def redact(docs: DataFrame, model: Broadcast, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``mark``; a
    null text stays null."""
    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ratio = model.value
        for batch in batches:
            yield pd.Series([t if not t or not (spans := find_spans(t, ratio)[1])
                             else redact_text(t, spans, mark) for t in batch], dtype=object)

    return docs.withColumn(text, clean(F.col(text)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: every document's spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = spark.sparkContext.broadcast(train(docs))
    return scan(docs, model).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
                                    "spans", "n_markov")
