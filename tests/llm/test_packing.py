import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordstats.llm import packing

from llm_tables import AWKWARD, SF_MID, docs_of  # noqa: F401


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return t


def whole_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def check_sequences(rows, window):
    """Every sequence is gapless from 0 and full, or a power of two long."""
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at == window or (at < window and at & (at - 1) == 0)
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def documents_of(rows):
    """The ids of every document, put together from its pieces; documents
    that share an id are told apart by their number of tokens."""
    out = []
    by_doc = {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, list(r.ids)))
    for (doc_id, tokens), pieces in by_doc.items():
        pieces.sort()
        copies = sum(s == 0 for s, _ in pieces)
        assert sum(len(p) for _, p in pieces) == copies * tokens
        if copies == 1:
            out.append((doc_id, [i for _, p in pieces for i in p]))
        else:
            out += [(doc_id, None)] * copies
    return out


def test_query_equals_the_library(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    rows = packing.query(spark, SF_MID).collect()
    check_sequences(rows, packing.WINDOW)
    covered = {}
    for r in rows:
        ids = np.array(whole_ids(tokenizer, texts[r.doc_id]), dtype="<u4")
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
        covered.setdefault(r.doc_id, []).append((r.start, r.length))
    assert set(covered) == set(texts)
    for doc_id, pieces in covered.items():
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length


@pytest.mark.parametrize("window", [2048, 64, 7, 1])
def test_awkward_rows(spark, docs_of, tokenizer, window):
    rows = AWKWARD + [(20, "a\x1cb c\x1fd\x85e f᠎g"), (21, "<|endoftext|> it's DON'T İ é ﬁ 12345"),
                      (22, "\U0001f600" * 300)]
    docs = docs_of(rows).withColumn("ids", F.lit("clash")).withColumn("length", F.lit(-1))
    pieces, plan = packing.pack(docs, packing.default_tokenizer(spark), window=window)
    got = pieces.collect()
    check_sequences(got, window)
    assert len({r.sequence_id for r in got}) == plan.sequences
    found = documents_of(got)
    want = [(i, whole_ids(tokenizer, t)) for i, t in rows]
    assert sorted((str(i) for i, _ in found)) == sorted(str(i) for i, _ in want)
    for i, ids in found:
        assert ids is None or (i, ids) in want
    whole = {r.sequence_id: list(r.ids) for r in packing.sequences(pieces).collect()}
    for r in got:
        assert whole[r.sequence_id][r.offset:r.offset + r.length] == list(r.ids)


def test_empty_table_and_hot_length(spark, docs_of):
    model = packing.default_tokenizer(spark)
    pieces, plan = packing.pack(docs_of([(1, "x")]).limit(0), model)
    assert pieces.count() == 0 and plan.sequences == 0
    # one length for all: nothing fills a window, so they are laid out and cut
    docs = docs_of([(i, "word " * 1500) for i in range(100)], parts=7)
    pieces, plan = packing.pack(docs, model)
    rows = pieces.collect()
    check_sequences(rows, packing.WINDOW)
    assert plan.laid == sum(r.length for r in rows) == 100 * 1501
    assert len(rows) <= 100 + plan.sequences


@pytest.fixture(scope="module")
def ids_of():
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return packing.TextIds(f.read())


def test_texts_split_as_the_tokenizer_does(tokenizer, ids_of):
    texts = [f"Ab{chr(c)}cd {chr(c)}' {chr(c)}s" for c in
             [*range(0xd800), *range(0xe000, 0x11000), *range(0x1d100, 0x1d200), *range(0x1f000, 0x1fb00)]]
    texts += ["ΟΔΟΣ Σ ΣΑΣ it's", "e\u0301 A\u030a n\u0303o", "I'LL we'Re 'S ''s '' 's", "x1y22z", "a\u0345\u0301"]
    for text in texts:
        assert ids_of(text, None).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, ascii(text)


def test_match_table_is_bounded(tokenizer, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(packing, "KEPT_WORDS", 5)
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        ids_of = packing.TextIds(f.read())
    text = " ".join(f"w{i % 23} {'y' * 100}" for i in range(90))
    assert ids_of(text, None).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert all(len(t) <= 5 and len(t.before) <= 5 for t in (ids_of.of_word, ids_of.of_match))


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        packing.TextIds(f.read())


def test_combinations_equal_brute_force():
    rng = np.random.default_rng(5)
    for window in (6, 17, 40):
        present = np.unique(rng.integers(1, window, 12))
        got = {tuple(x for x in row if x) for row in packing.combinations(present, window).tolist()}
        p = present.tolist()
        want = {(a, b) for a in p for b in p if a <= b and a + b == window}
        want |= {(a, b, c) for a in p for b in p for c in p if a <= b <= c and a + b + c == window}
        assert got == want
    assert len(packing.combinations(np.array([], dtype=np.int64), 8)) == 0


def test_least_squares_is_optimal(monkeypatch):
    monkeypatch.setattr(packing, "SMALLEST_STEP", 1e-9)
    monkeypatch.setattr(packing, "TOLERANCE", 1e-12)
    rng = np.random.default_rng(6)
    for window in (12, 30):
        target = rng.integers(0, 1000, window + 1)
        target[0] = target[window] = 0
        columns = packing.combinations(np.flatnonzero(target), window)
        x = packing.least_squares(columns, target)
        a = np.zeros((window + 1, len(columns)))
        for j, c in enumerate(columns.tolist()):
            for length in c:
                a[length, j] += length > 0
        slope = a.T @ (target - a @ x)
        # the conditions of a non-negative least squares solution
        assert (x >= 0).all() and (slope < 1e-3).all() and (np.abs(slope[x > 1e-6]) < 1e-3).all()


def test_plan_places_each_piece_once():
    rng = np.random.default_rng(7)
    for window, n in ((64, 5000), (64, 30), (256, 20000)):
        lengths = np.minimum(rng.geometric(2 / window, n), window)
        histogram = {int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True))}
        histogram[window // 2 + 1] = histogram.get(window // 2 + 1, 0) + n // 2        # a hot length
        plan = packing.make_plan(histogram, window)
        for length, count in histogram.items():
            at = 0
            for i in sorted((i for i in plan.intervals if i.length == length), key=lambda i: i.lo):
                assert i.lo == at and i.hi > i.lo
                at = i.hi
            assert at == count
        assert plan.combined > 0
