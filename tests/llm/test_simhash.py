import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from wordstats.llm import simhash
from wordstats.llm.components import components

from llm_tables import AWKWARD, SF_MID, docs_of, mid_docs  # noqa: F401


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """fingerprint -> smallest fingerprint reachable at 3 or fewer bits, over all pairs."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    a = np.array(fps, dtype=np.uint64)
    for i, f in enumerate(fps):
        for j in np.nonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= 3)[0]:
            x, y = sorted((find(f), find(fps[i + 1 + j])))
            root[y] = x
    return {f: find(f) for f in fps}


def test_query_equals_brute_force(spark, mid_docs):
    rows = simhash.query(spark, SF_MID).collect()
    fp = {d: brute_fingerprint(t) for d, t in mid_docs.items()}
    roots = brute_components(fp.values())
    lowest = {}
    for d in sorted(fp):
        lowest.setdefault(roots[fp[d]], d)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {
        (d, f"{f:016x}", lowest[roots[f]]) for d, f in fp.items()}
    assert len(rows) == len(fp)


def linked_fingerprints(n, seed):
    """Fingerprints in chains and dense clusters, and single ones."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n)]
    for centre in out[:5]:
        for _ in range(n):
            out.append(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    chain = out[5]
    for _ in range(n // 4):
        chain ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
        out.append(chain)
    return sorted(set(out))


def test_links_connect_what_all_pairs_connect(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 40)
    for seed in (1, 2):
        fps = linked_fingerprints(300, seed)
        signed = [f - (1 << 64) if f >> 63 else f for f in fps]
        df = spark.createDataFrame([(f,) for f in signed], "fp long")
        want = brute_components(fps)
        groups = {}
        for r in components(simhash.links(df)).collect():
            groups.setdefault(r.root, set()).add(r.node & ((1 << 64) - 1))
        brute = {}
        for f, r in want.items():
            brute.setdefault(r, set()).add(f)
        assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in brute.values() if len(g) > 1)


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 8), (5, 1), (20, 21), (21, 22), (22, 23), (23, 24), (1, 2)]
    df = spark.createDataFrame(edges, "a long, b long")
    assert {(r.node, r.root) for r in components(df).collect()} == {
        (1, 1), (2, 1), (3, 1), (5, 1), (8, 8), (9, 8), *[(i, 20) for i in range(20, 25)]}
    line = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in components(line).collect()} == {0}
    assert components(df.limit(0)).count() == 0


def test_awkward_rows(spark, docs_of):
    docs = docs_of(AWKWARD).withColumn("fp", F.lit("clash")).withColumn("component", F.lit("clash"))
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(AWKWARD)
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert {by[i].component for i in (0, 1, 2)} == {0} and by[0].fp == 0
    assert by[5].component == by[6].component == 5
    # without an id: "no id" twice makes a component without a key, null text is with row 0
    assert sorted(str(r.component) for r in rows if r.doc_id is None) == ["0", "None", "None"]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["0", "3", "4", "5", "7", "8", "9", "None"]
    assert simhash.keep_one(docs_of([])).count() == 0 and simhash.near_duplicates(docs_of([])).count() == 0


def test_unlike_texts_under_one_id_all_stay(spark, docs_of):
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(40)) for _ in range(30)]
    roots = brute_components([brute_fingerprint(t) for t in texts])
    assert len(set(roots.values())) == 30  # no two are near copies
    hot = [(7, t) for t in texts[:20]]
    # copies of hot texts under other ids, larger and smaller; a hot text twice; texts without an id
    rows = [*hot, hot[0], hot[0], (9, texts[1]), (3, texts[2]), (3, texts[20]), (3, texts[20]),
            *[(i, texts[i]) for i in range(21, 25)], (None, texts[25]), (None, texts[26]),
            (None, texts[26]), (None, texts[3])]
    kept = sorted((str(r.doc_id), r.text) for r in simhash.keep_one(docs_of(rows)).collect())
    lowest = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        lowest.setdefault(t, i)
    assert kept == sorted((str(i), t) for t, i in lowest.items())


def test_keep_one_is_the_same_for_any_partitioning(spark):
    rows = [(5, "one two three four five", f"s{i}", i) for i in (3, 1, 2, 0)] + [(6, "quite another text here", "s", 9)]
    kept = set()
    for parts in (1, 2, 3, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _key long").repartition(parts)
        kept.add(tuple(sorted(tuple(r) for r in simhash.keep_one(docs).collect())))
    assert kept == {((5, "one two three four five", "s0", 0), (6, "quite another text here", "s", 9))}
