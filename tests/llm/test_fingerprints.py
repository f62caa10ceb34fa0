import hashlib

from pyspark.sql import functions as F

from wordstats.llm import fingerprints as fp

from llm_tables import AWKWARD, SF_MID, docs_of, mid_docs  # noqa: F401


def numbered(words, k):
    """(k-mer, occurrence number, position), by brute force."""
    seen, out = {}, []
    for i in range(max(1, len(words) - k + 1) if words else 0):
        gram = tuple(words[i:i + k])
        out.append((gram, seen.get(gram, 0), i))
        seen[gram] = seen.get(gram, 0) + 1
    return out


def brute_signatures(spark, texts, k=fp.K):
    """The same signatures with Python loops over the k-mers; only the hash
    function is Spark's."""
    import re

    rows = []
    for d, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]{1,%d}" % fp.TOKEN_CHARS, text)
        rows += [(d, list(g), n, i) for g, n, i in numbered(words, k)]
    hashed = spark.createDataFrame(rows, "d int, gram array<string>, n int, i int").withColumn(
        "h", F.shiftright(F.shiftleft(F.xxhash64("gram"), 32), 32)).withColumn(
        "e", F.shiftright(F.xxhash64(F.col("h"), F.col("n")), 32)).collect()
    per = {}
    for r in hashed:
        per.setdefault(r.d, []).append((r.e, r.i))
    tuples = []
    for d in range(len(texts)):
        items = sorted(per.get(d, []))
        for j in range(fp.SKETCHES):
            start = (-(1 << 63) + j * ((1 << 64) // fp.SKETCHES)) >> 32
            turned = sorted(items, key=lambda x: ((x[0] - start) % (1 << 32), x[1]))[:fp.MINIMA]
            inorder = [e % (1 << 32) for e, _ in sorted(turned, key=lambda x: x[1])]
            tuples.append((d, j, inorder))
    sig = {}
    for r in (spark.createDataFrame(tuples, "d int, j int, t array<long>")
              .select("d", "j", F.xxhash64("t").bitwiseAND(F.lit((1 << 32) - 1)).alias("x")).collect()):
        sig.setdefault(r.d, {})[r.j] = r.x
    return [[0] * fp.SKETCHES if not per.get(d) else [sig[d][j] for j in range(fp.SKETCHES)]
            for d in range(len(texts))]


def test_signature_equals_brute_force(spark, mid_docs):
    texts = [mid_docs[i] for i in sorted(mid_docs)[:40]] + [t or "" for _, t in AWKWARD]
    df = spark.createDataFrame(list(enumerate(texts)), "d int, text string")
    got = {r.d: list(r.sig) for r in df.select("d", fp.signature(F.col("text")).alias("sig")).collect()}
    assert [got[d] for d in range(len(texts))] == brute_signatures(spark, texts)


def test_order_matters(spark):
    words = [f"w{i}" for i in range(60)]
    turned = words[30:] + words[:30]
    a, b, c = (" ".join(w) for w in (words, turned, words[:55] + ["z"] * 5))
    row = spark.createDataFrame([(a, b, c)], "a string, b string, c string").select(
        *[fp.likeness(fp.signature(F.col("a")), fp.signature(F.col(x))).alias(x) for x in "abc"]).first()
    assert row.a == 1.0 and row.c > 0.5 and row.b < 0.8


def test_query(spark, mid_docs):
    rows = fp.query(spark, SF_MID).collect()
    ids = sorted(mid_docs)
    assert sorted(r.doc_id for r in rows) == ids
    following = dict(zip(ids, ids[1:] + ids[:1]))
    by_text, print_of = {}, {r.doc_id: r.fingerprint for r in rows}
    for r in rows:
        text, nxt = mid_docs[r.doc_id], mid_docs[following[r.doc_id]]
        q = len(text) // 4
        edited = text[:len(text) - q] + nxt[:q]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        parts = lambda x: [x[i:i + 8] for i in range(0, len(x), 8)]
        same = lambda a, b: sum(x == y for x, y in zip(parts(a), parts(b))) / fp.SKETCHES
        assert r.near_edited == same(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == same(r.fingerprint, print_of[following[r.doc_id]])
    long = [r for r in rows if r.n_chars > 500]
    assert sum(r.near_edited > r.near_next for r in long) > 0.97 * len(long)


def test_next_with_awkward_rows(spark, docs_of):
    docs = docs_of(AWKWARD).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for parts in (1, 4, 40):
        got = fp.with_next(docs, "doc_id", ["text"], parts).collect()
        order = sorted(AWKWARD, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        texts = [(r[0], r[1] or "") for r in order]
        want = sorted(zip(texts, [t for _, t in texts[1:] + texts[:1]]), key=str)
        assert sorted((((r.doc_id, r.text), r.next.text) for r in got), key=str) == want
    assert fp.with_next(docs_of([]).select("doc_id", "text"), "doc_id", ["text"]).count() == 0
