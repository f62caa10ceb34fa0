import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from wordstats.llm import secrets

from llm_tables import AWKWARD, SF_MID, docs_of, mid_docs  # noqa: F401


def brute_base(text):
    """The base patterns as the contract words them."""
    found = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                         text, re.ASCII):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


@pytest.fixture(scope="module")
def model(spark):
    return spark.sparkContext.broadcast(
        secrets.train(spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")))


def test_query_base_equals_brute_force(spark, mid_docs):
    rows = secrets.query(spark, SF_MID).collect()
    assert len(rows) == len(mid_docs)
    for r in rows:
        base = brute_base(mid_docs[r.doc_id] or "")
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, k, _ in base) for x in range(3))
        text = secrets.written(base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) - {""} <= set(r.spans.split(","))
    # clean prose isn't flagged
    assert sum(r.n_markov > 0 for r in rows) <= 0.01 * len(rows)


def test_patterns_on_edge_cases():
    texts = ['token: secret=abcdef123', 'API_KEY = "abc" password=longenough', "AKIAAKIA" + "A" * 12 + " AKIA1",
             "f" * 23 + " " + "f" * 24, 'token="' + "0a" * 20 + '"', "PASSWORD:'x+/_.=-9' ſecret=abcdefg", "é" * 3 + "apikey=123456",
             "toKen=abcdefg Key apiKEY=1234567"]
    for t in texts:
        assert secrets.base_spans(t) == brute_base(t)


def test_markov_finds_random_strings_and_leaves_identifiers(model, mid_docs):
    rng = random.Random(5)
    hits = 0
    for _ in range(200):
        secret = "".join(rng.choices(secrets.ALPHABETS[2], k=32))
        text = f"is the of {secret} and"
        hits += secrets.find_spans(text, model.value)[1] == [(10, 3, 42)]
    assert hits >= 190
    words = " ".join(re.findall(r"[a-zA-Z]{9,}", " ".join(mid_docs[i] or "" for i in range(50)))).split()
    joined = ["_".join(words[i:i + 3]) for i in range(0, 300, 3)]
    assert sum(bool(secrets.find_spans(t, model.value)[1]) for t in joined) <= 2


def test_awkward_rows_and_redaction(spark, docs_of, model):
    docs = docs_of([*AWKWARD, (20, "é token=abcdef123456 and AKIA" + "B" * 16), (21, None)]).withColumn("spans", F.lit("x"))
    rows = {r.doc_id: r for r in secrets.scan(docs, model).collect()}
    assert rows[20].spans == "assign:2:20,access:25:45"
    assert rows[0].spans == "" and rows[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    clean = {r.doc_id: r.text for r in secrets.redact(docs, model).collect()}
    assert clean[20] == "é [SECRET] and [SECRET]" and clean[0] is None and clean[3] == "word"
    assert secrets.redact_text("abcdef", [(1, 0, 3), (2, 2, 4), (4, 1, 5)], "*") == "a*f"
    empty = docs_of([])
    ratio = spark.sparkContext.broadcast(secrets.train(empty))
    assert secrets.scan(empty, ratio).count() == 0


def test_rest_of_a_token_beside_a_base_span_is_scored(model):
    rng = random.Random(6)
    for _ in range(20):
        key = "".join(rng.choices(secrets.ALPHABETS[2], k=40))
        hexa = "".join(rng.choices("0123456789abcdef", k=32))
        cases = [("AKIA" + "B7" * 10 + "/" + key, [(0, 1, 24), (24, 3, 65)]),
                 (key + "-" + hexa, [(0, 3, 41), (41, 2, 73)]),
                 (hexa + "_" + key, [(0, 2, 32), (32, 3, 73)])]
        for text, spans in cases:
            at = len("is the ")
            assert secrets.find_spans(f"is the {text} and", model.value)[1] == [
                (s + at, k, e + at) for s, k, e in spans]


def test_short_random_tokens_are_found(model):
    rng = random.Random(7)
    found = sum(secrets.find_spans("of the " + "".join(rng.choices(secrets.ALPHABETS[2], k=16)) + " and",
                                   model.value)[1] == [(7, 3, 23)] for _ in range(100))
    assert found >= 95


def test_chunks_do_not_change_spans(model, monkeypatch):
    rng = random.Random(8)
    parts = ["the", "and", "é", "x=1", "f" * 30]
    text = " ".join(rng.choice([*parts, "".join(rng.choices(secrets.ALPHABETS[3], k=rng.randint(5, 40)))])
                    for _ in range(300))
    whole = secrets.find_spans(text, model.value)
    assert sum(k == 3 for _, k, _ in whole[1]) > 20
    for size in (1, 7, 100):
        monkeypatch.setattr(secrets, "CHUNK", size)
        assert secrets.find_spans(text, model.value) == whole
