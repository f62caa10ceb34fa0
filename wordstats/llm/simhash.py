"""SimHash near-duplicates found through pivot distance tables.

Fingerprint: the text's words (A-Z lower-cased, split at ASCII white space)
form shingles; a fingerprint bit is 1 if it is set in over half the
shingles' XXH64 hashes.  Two fingerprints link at ``MAX_BITS`` or fewer
differing bits.

Pivot distance tables: Hamming distances to reference fingerprints are
computed once per distinct fingerprint.  The distances of two linked
fingerprints to any reference differ by at most ``MAX_BITS``; and of
``BANDS`` disjoint bands of bits, at least ``BANDS - MAX_BITS`` hold no
differing bit, so that the distances to references *within* some
``BANDS - MAX_BITS`` bands together don't differ at all.  So there is one
banded table per choice of bands: fingerprints meet as candidates only when
all their coordinates in one of these tables are equal (an equality join,
not a scan of pairs), pairs whose maximum coordinate difference over the
table of whole-fingerprint references exceeds ``MAX_BITS`` are discarded,
and the survivors' differing bits are counted.  Nothing is missed.

Copies share a fingerprint and are grouped before any of this.  A table
entry shared by many distinct fingerprints is cut into blocks of about
``BLOCK`` by a hash, and pairs of blocks are compared as tasks of their own;
a task emits one link per pair of connected sub-groups, not all pairs, so
links grow with the rows.  Components are found by star contraction over
the stored links.

Null and empty texts have fingerprint zero and link like any other.  Fewer
words than a shingle: the whole sequence.  Null ids can't name a component:
such rows take part, and their component is named by the smallest id in it,
null where it has none.  Repeated rows and extra columns pass through.
"""

from __future__ import annotations

import random
import uuid
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordstats.llm.common import bound_batches, table, with_replaced
from wordstats.llm.components import components
from wordstats.operators.lookup import store

SHINGLE = 3
MAX_BITS = 3
BANDS = 5
#: References per banded table (5 bits of each distance go into the key) and
#: whole-fingerprint references.
BAND_REFERENCES = 12
REFERENCES = 16
#: Table entries with more distinct fingerprints than this are compared in blocks.
PAIR_LIMIT = 16
BLOCK = 1024
#: Shingles hashed at a time.
CHUNK = 1 << 15


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one whole text (unsigned)."""
    import xxhash

    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for start in range(0, n, CHUNK):
        hashes = np.fromiter((digest(join(words[i:i + shingle]), 42)
                              for i in range(start, min(n, start + CHUNK))), dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint of each text, as a signed long."""
    bound_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(np.array([fingerprint_of(t, shingle) for t in batch],
                                     dtype=np.uint64).view(np.int64))

    return with_replaced(docs, {out: simhash(F.col(text))})


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def references(count: int, seed: int) -> list[int]:
    """Reference fingerprints, as signed longs."""
    rng = random.Random(seed)
    return [_signed(rng.getrandbits(64)) for _ in range(count)]


def band_masks(max_bits: int = MAX_BITS, bands: int = BANDS) -> list[int]:
    """Masks of every choice of ``bands - max_bits`` bands, as signed longs."""
    edges = [64 * i // bands for i in range(bands + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [_signed(sum(c)) for c in combinations(masks, bands - max_bits)]


def distance(fp: Column, reference: int, mask: int = -1) -> Column:
    """Hamming distance to a reference fingerprint within a mask."""
    return F.bit_count(fp.bitwiseXOR(F.lit(reference)).bitwiseAND(F.lit(mask)))


def banded_tables(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, tab, coords): one row per fingerprint and banded table, the
    coordinates (distances to the table's references, each below 32) packed
    into a long."""
    entries = []
    for t, mask in enumerate(band_masks(max_bits)):
        packed = F.lit(0).cast("long")
        for r in references(BAND_REFERENCES, 100 + t):
            packed = F.shiftleft(packed, 5).bitwiseOR(distance(F.col("fp"), r, mask).cast("long"))
        entries.append(F.struct(F.lit(t).alias("tab"), packed.alias("coords")))
    return fps.select("fp", F.explode(F.array(*entries)).alias("e")).select("fp", "e.tab", "e.coords")


def close(a: Column, b: Column, max_bits: int = MAX_BITS) -> Column:
    """The whole-fingerprint table's maximum coordinate difference test, then
    the differing bits."""
    survives = F.lit(True)
    for r in references(REFERENCES, 7):
        survives = survives & (F.abs(distance(a, r) - distance(b, r)) <= max_bits)
    return survives & (F.bit_count(a.bitwiseXOR(b)) <= max_bits)


_REFS = np.array(references(REFERENCES, 7), dtype=np.int64).view(np.uint64)


def _close_matrix(a: np.ndarray, b: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of linked fingerprints of two blocks: the maximum
    coordinate difference first, then the differing bits of the survivors."""
    da = np.bitwise_count(a[:, None] ^ _REFS).astype(np.int8)
    db = np.bitwise_count(b[:, None] ^ _REFS).astype(np.int8)
    survive = np.abs(da[:, None, 0] - db[None, :, 0]) <= max_bits
    for r in range(1, 4):
        survive &= np.abs(da[:, None, r] - db[None, :, r]) <= max_bits
    i, j = np.nonzero(survive)
    for r in range(4, REFERENCES, 4):
        keep = (np.abs(da[i, r:r + 4] - db[j, r:r + 4]) <= max_bits).all(axis=1)
        i, j = i[keep], j[keep]
    linked = np.bitwise_count(a[i] ^ b[j]) <= max_bits
    return i[linked], j[linked]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1, the smallest node reachable over links i-j."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def block_links(own: np.ndarray, other: np.ndarray | None, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect what is linked inside one block (``other`` None), or
    between two blocks given that each block's inner links are known."""
    i, j = _close_matrix(own, own, max_bits)
    root = _forest(len(own), i, j)
    if other is None:
        member = np.nonzero(root != np.arange(len(own)))[0]
        return list(zip(own[member].tolist(), own[root[member]].tolist()))
    i, j = _close_matrix(other, other, max_bits)
    other_root = _forest(len(other), i, j)
    i, j = _close_matrix(own, other, max_bits)
    pairs = {(int(root[x]), int(other_root[y])) for x, y in zip(i.tolist(), j.tolist())}
    return [(int(own[x]), int(other[y])) for x, y in sorted(pairs)]


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect all that are
    within ``max_bits``.  ``fps`` has distinct ``fp``."""
    entries = store(banded_tables(fps, max_bits), "banded")
    counts = entries.groupBy("tab", "coords").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    shared = store(entries.join(counts, ["tab", "coords"]), "shared")

    few = shared.filter(F.col("n") <= PAIR_LIMIT).select("tab", "coords", "fp")
    other = few.withColumnRenamed("fp", "fp2")
    pairs = (few.join(other, ["tab", "coords"])
             .filter((F.col("fp") < F.col("fp2")) & close(F.col("fp"), F.col("fp2"), max_bits))
             .select(F.col("fp").alias("a"), F.col("fp2").alias("b")))

    many = (shared.filter(F.col("n") > PAIR_LIMIT)
            .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
            .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    meets = many.withColumn("other", F.explode(every)).select(
        "tab", "coords", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        "block", "fp")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        x, y = int(group["x"].iloc[0]), int(group["y"].iloc[0])
        fp = np.sort(group.loc[group["block"] == x, "fp"].to_numpy()).view(np.uint64)
        rest = None if x == y else np.sort(group.loc[group["block"] == y, "fp"].to_numpy()).view(np.uint64)
        found = block_links(fp, rest, max_bits) if rest is None or len(rest) and len(fp) else []
        return pd.DataFrame({c: np.array([p[k] for p in found], dtype=np.uint64).view(np.int64)
                             for k, c in enumerate(("a", "b"))})

    dense = meets.groupBy("tab", "coords", "x", "y").applyInPandas(compare, "a long, b long")
    return pairs.unionByName(dense)


def grouped(docs: DataFrame, text: str = "text", shingle: int = SHINGLE,
            max_bits: int = MAX_BITS, key: str = "doc_id", hashed: bool = False) -> DataFrame:
    """(key, fp, root, component) of every row: the smallest fingerprint and
    the smallest key that can be reached from it over links; with ``hashed``
    also the text's hash (``_text``)."""
    own = [F.xxhash64(text).alias("_text")] if hashed else []
    marked = store(fingerprints(docs.select(F.col(key).alias("_key"), F.col(text).alias(text)), text, "fp", shingle)
                   .select("_key", "fp", *own), "fingerprints")
    firsts = store(marked.groupBy("fp").agg(F.min("_key").alias("_low")), "distinct")
    found = components(links(firsts.select("fp"), max_bits))
    rooted = store(firsts.join(found, firsts["fp"] == found["node"], "left")
                   .select("fp", "_low", F.coalesce("root", "fp").alias("root")), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("_low").alias("component"))
    named = rooted.join(lowest, "root").select(F.col("fp").alias("_fp"), "root", "component")
    return (marked.join(named, marked["fp"] == named["_fp"])
            .select(F.col("_key").alias(key), "fp", "root", "component", *(["_text"] if hashed else [])))


def near_duplicates(docs: DataFrame, text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, key: str = "doc_id") -> DataFrame:
    """(key, fp, component) of every row: the smallest key of the rows that
    can be reached from it over links."""
    return grouped(docs, text, shingle, max_bits, key).drop("root")


def written(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS,
             key: str = "doc_id") -> DataFrame:
    """``docs`` with one row per component: the one with the smallest key, or,
    where a component has no key, one of its rows.  Where unlike texts share
    a key, each of their components keeps a row.

    The decision is taken on narrow rows: a row goes by its key and its
    text's hash, and texts are joined with what stays, not with each other.
    Where a kept row has exact copies under its key, the smallest of them in
    the order of their columns stays (chosen first within each task), so that
    reruns agree however the rows are dealt out; columns must be orderable
    then.  Columns of any name pass through."""
    decided = grouped(docs, text, shingle, max_bits, key, hashed=True)
    rows = (decided.groupBy("root", F.col(key).alias("_key"), "_text")
            .agg(F.count("*").alias("_copies")))
    first = F.min(F.struct(F.col("_key").isNull().alias("nameless"), "_key", "_text", "_copies"))
    # What is joined is one struct under a new name, so no column can clash.
    tag = f"_stay_{uuid.uuid4().hex}"
    stay = store(rows.groupBy("root").agg(first.alias("_first"))
                 .select(F.struct("root", "_first._key", "_first._text", "_first._copies").alias(tag)), "stay")
    own = F.xxhash64(docs[text]) == F.col(f"{tag}._text")
    columns = [docs[c] for c in docs.columns]

    def kept(some: Column) -> DataFrame:
        return docs.join(stay.filter(some), docs[key].eqNullSafe(F.col(f"{tag}._key")) & own)

    single = kept(F.col(f"{tag}._copies") == 1).select(*columns)
    copied = (kept(F.col(f"{tag}._copies") > 1).groupBy(F.col(f"{tag}.root"))
              .agg(F.min(F.struct(*columns)).alias("_row")).select("_row.*"))
    return single.unionByName(copied)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: every document's fingerprint and component."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", written(F.col("fp")).alias("fingerprint"),
                                        F.col("component").alias("component_id"))
