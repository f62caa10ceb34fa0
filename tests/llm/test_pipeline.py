"""Every stage of the pipeline on awkward rows, held against plain Python."""

import collections
import math
import random
import re

import pytest

import corpus_pipeline
from wordstats.llm import secrets, toxicity
from wordstats.operators.lookup import store
from wordstats.session import scratch_dir

from llm_tables import AWKWARD, DOC_SCHEMA, SF, docs_of  # noqa: F401
from test_byte_bpe import reference_encoder
from test_secrets import brute_base
from test_simhash import brute_components, brute_fingerprint
from test_toxicity import brute_score

COLUMNS = corpus_pipeline.COLUMNS


def awkward():
    """Rows that the given table lacks."""
    rng = random.Random(3)
    rows = [(i if i is None else 900_000 + i, t, "en", "hot") for i, t in AWKWARD]
    rows += [(910_000, f"note {i} password = hunter2{i}xyz and AKIA{'Q7' * 9}", "en", None) for i in range(4)]
    rows += [(910_010 + i, "key " + "".join(rng.choices(secrets.ALPHABETS[2], k=36)) + " end", "de", "rare")
             for i in range(6)]
    base = " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rng.randrange(99))
                    for _ in range(400))
    rows += [(911_000 + i, base + f" tail{i % 2}", "en", f"s{i}") for i in range(8)]      # near copies
    return [(d, t, lang, source, len(t) if t is not None else None) for d, t, lang, source in rows]


@pytest.fixture(scope="module")
def stages(spark):
    """(docs before, rows after) of every stage, each on its predecessor's output."""
    docs = (spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS)
            .unionByName(spark.createDataFrame(awkward(), DOC_SCHEMA)).repartition(5))
    docs = store(docs, "pipeline-test")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = store(stage(spark, docs, SF), name)
        out[name] = (docs, docs.collect(), after.collect())
        docs = after
    return out


def rows_of(rows):
    return collections.Counter(tuple(r[c] for c in COLUMNS) for r in rows)


def test_toxicity(spark, stages):
    docs, before, after = stages["toxicity"]
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"), toxicity.learnable())
    assert rows_of(after) == rows_of(r for r in before if brute_score(model, r.text) < toxicity.THRESHOLD)
    assert 0 < len(after) < len(before)


def test_near_duplicates(stages):
    _, before, after = stages["near_duplicates"]
    roots = brute_components({brute_fingerprint(r.text) for r in before})
    groups = collections.Counter(roots[brute_fingerprint(r.text)] for r in after)
    assert set(groups.values()) == {1}
    assert groups.keys() == {roots[brute_fingerprint(r.text)] for r in before}
    assert not rows_of(after) - rows_of(before)
    assert len(after) < len(before)


def test_kept_rows_follow_no_partitioning(spark, stages):
    docs, _, after = stages["near_duplicates"]
    for parts in (1, 3):
        again = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(parts), SF)
        assert rows_of(again.collect()) == rows_of(after)


def brute_markov(text, base, ratio):
    """Token runs outside the base spans, scored character by character."""
    covered = {i for s, _, e in base for i in range(s, e)}
    marks = "".join("\0" if i in covered else c for i, c in enumerate(text))
    code = lambda c: min(ord(c), 127)
    spans = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]+", marks):
        word = m[0]
        terms = [ratio[0, code(word[0])]] + [ratio[code(a), code(b)] for a, b in zip(word, word[1:])]
        if math.fsum(terms) >= max(secrets.MIN_RATIO, secrets.MIN_RATIO_PER_CHAR * len(word)):
            spans.append((m.start(), 3, m.end()))
    return spans


def test_secrets(stages):
    docs, before, after = stages["secrets"]
    ratio = secrets.train(docs)
    expected = collections.Counter()
    changed = 0
    for r in before:
        text = r.text
        if text:
            base = brute_base(text)
            spans = base + brute_markov(text, base, ratio)
            if spans:
                changed += 1
                marked = bytearray(len(text))
                for s, _, e in spans:
                    marked[s:e] = b"\1" * (e - s)
                # spans that touch are one run
                text = re.sub("\1+", "[SECRET]", "".join("\1" if m else c for c, m in zip(text, marked)))
        expected[(r.doc_id, text, r.lang, r.source, None if text is None else len(text))] += 1
    assert changed and rows_of(after) == expected


def test_mixing(stages):
    _, before, after = stages["mixing"]
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    sizes = collections.Counter()
    for r in before:
        sizes[r.source] += size(r)
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(ordered)}
    capped: set = set()
    while True:     # cut the targets above their caps, share out the rest again
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        open_weight = sum(weight[s] for s in ordered if s not in capped)
        target = {s: 2 * sizes[s] if s in capped else left * weight[s] / open_weight for s in ordered}
        above = {s for s in ordered if target[s] > 2 * sizes[s] + 1e-9}
        if not above:
            break
        capped |= above
    copies, had = rows_of(after), rows_of(before)
    assert not copies.keys() - had.keys()
    for key, n in had.items():
        rate = target[key[3]] / sizes[key[3]] if sizes[key[3]] else 0
        assert n * math.floor(rate + 1e-9) <= copies[key] <= n * math.ceil(rate - 1e-9)
    taken = collections.Counter()
    for r in after:
        taken[r.source] += size(r)
    for s in ordered:       # within five deviations of the draws
        wide = math.sqrt(sum(size(r) ** 2 for r in before if r.source == s)) * 0.5
        assert abs(taken[s] - target[s]) <= 5 * wide + 1e-6


def test_tokens(stages):
    _, before, after = stages["tokens"]
    encoder = reference_encoder()
    expected = collections.Counter()
    for r in before:
        ids = tuple(encoder.encode_ordinary(r.text or ""))
        expected[(r.doc_id, r.lang, r.source, len(ids), ids)] += 1
    assert collections.Counter((r.doc_id, r.lang, r.source, r.n_tokens, tuple(r.ids)) for r in after) == expected


def test_empty_tables(spark):
    empty = scratch_dir(spark, "empty")
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
