"""Mixing sources to target weights.

Every source gets a target number of words: ``share`` times all words,
divided by the sources' weights; a target stops at ``cap`` times its
source's size, and what is cut off goes to the others by weight until no
target is above its cap.  With caps c, weights w and total T that fixed
point is target = min(c, level * w), where level is the largest of
(T - sum of c) / (sum of the other w) over the sets of sources with the
smallest c / w; one running sum over the sources finds it.

A source's repetition rate is target / size.  Each of its documents is
emitted floor(rate) times, plus once more when a hash of its id, its text and
the seed falls below the fraction, so reruns agree, and rows that share an id
(or have none) but not a text draw on their own.

Sources are ordered by code point, null last, and weighed by repeating
``WEIGHTS``.  Null and empty texts have size 0 and follow their source's
rate; a source of size 0 has target and rate 0.  Extra columns pass
through; an input column named like an output column is replaced.  An empty
table has no sources and gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordstats.llm.common import WORD, running_totals, table, whole_text, with_replaced
from wordstats.operators.lookup import store

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
SEED = 17


def n_words(col: str = "text") -> Column:
    return F.regexp_count(whole_text(col), F.lit(WORD)).cast("long")


def source_rates(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                 cap: int = CAP) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``, ``rate``.

    ``sizes`` has a source and a size per document; sizes are summed before
    anything is shuffled, and everything after works on one row per source."""
    per_source = store(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked, _ = running_totals(per_source, [F.col("source").asc_nulls_last()], F.lit(1))
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = store(ranked.select("source", "source_size",
                                  cycle[(F.col("_before") % len(weights)).cast("int")]
                                  .cast("long").alias("weight"),
                                  (F.col("source_size") * cap).alias("cap")), "weighed")
    # The running sums, of caps and of weights, in the order of cap / weight.
    order = [F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()]
    caps, all_caps = running_totals(weighed, order, F.col("cap"))
    both, all_weights = running_totals(caps.withColumnRenamed("_before", "caps_before"),
                                       order, F.col("weight"))
    total = share * all_caps / cap
    level = both.agg(F.max((F.lit(total) - F.col("caps_before"))
                           / (F.lit(all_weights) - F.col("_before")))).first()[0]
    target = F.least(F.col("cap").cast("double"), F.lit(level).cast("double") * F.col("weight"))
    # Stored: one row per source, whose size Spark then knows when it plans the join.
    return store(weighed.select("source", "source_size", target.alias("target"),
                                F.when(F.col("source_size") > 0, target / F.col("source_size"))
                                .otherwise(0.0).alias("rate")), "rates")


def text_digest(col: str = "text") -> Column:
    return F.md5(whole_text(col).cast("binary"))


def copies(rate: Column, doc_id: Column, digest: Column, seed: int = SEED) -> Column:
    """How often a document is emitted at ``rate``."""
    drawn = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null")), digest)
    draw = F.conv(F.substring(F.md5(drawn.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def plan_mix(docs: DataFrame, rates: DataFrame, digest: Column, seed: int = SEED, prefix: str = "") -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``copies`` (after ``prefix``);
    ``digest`` is the digest of a row's text.  The rates are joined
    null-safely, as one struct under a new name that no column can clash
    with; Spark broadcasts them when their stored size is below its threshold
    and otherwise splits a hot source's rows."""
    tag = f"_rate_{uuid.uuid4().hex}"
    r = rates.select(F.struct("source", "source_size", "target", "rate").alias(tag))
    joined = docs.join(r, docs["source"].eqNullSafe(F.col(f"{tag}.source")), "left")
    out = with_replaced(joined, {
        f"{prefix}source_size": F.col(f"{tag}.source_size"), f"{prefix}target": F.col(f"{tag}.target"),
        f"{prefix}copies": copies(F.col(f"{tag}.rate"), F.col("doc_id"), digest, seed)})
    return out.drop(tag)


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP,
        seed: int = SEED) -> DataFrame:
    """The mixture: every document's row, repeated as often as it is emitted."""
    sizes = docs.select("source", n_words().alias("size"))
    tag = f"_mix_{uuid.uuid4().hex}_"
    planned = plan_mix(docs, source_rates(sizes, weights, share, cap), text_digest(), seed, tag)
    n = F.col(f"{tag}copies")
    repeated = planned.filter(n > 0).withColumn(f"{tag}copy", F.explode(F.sequence(F.lit(1).cast("long"), n)))
    return repeated.select([F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: every document's share in the mixture."""
    docs = store(table(spark, sf_dir, "documents").select(
        "doc_id", "source", n_words().alias("size"), text_digest().alias("digest")), "sizes")
    planned = plan_mix(docs, source_rates(docs.select("source", "size")), F.col("digest"))
    return planned.select("doc_id", "size", "source_size", "target",
                          (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


ORACLE = """
WITH docs AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n
  FROM docs GROUP BY source),
weighed AS (
  SELECT source, source_size, [3, 1, 2][n % 3 + 1] AS weight, 2 * source_size AS cap FROM sources),
running AS (
  SELECT *, coalesce(sum(cap) OVER w, 0) AS caps_before, coalesce(sum(weight) OVER w, 0) AS weights_before
  FROM weighed
  WINDOW w AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT max((1.5 * (SELECT sum(source_size) FROM sources)::DOUBLE - caps_before::DOUBLE)
             / ((SELECT sum(weight) FROM weighed)::DOUBLE - weights_before::DOUBLE)) AS level FROM running),
rates AS (
  SELECT source, source_size, least(cap::DOUBLE, level * weight) AS target,
         CASE WHEN source_size > 0 THEN least(cap::DOUBLE, level * weight) / source_size ELSE 0.0 END AS rate
  FROM weighed, level),
planned AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, d.source,
         CAST(floor(r.rate) AS BIGINT) + CASE WHEN
           ('0x' || substr(md5('17:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || d.digest), 1, 8))::UBIGINT::DOUBLE / 4294967296.0
           < r.rate - floor(r.rate) THEN 1 ELSE 0 END AS copies
  FROM docs d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, source,
       CAST(copies AS BIGINT) AS copies
FROM planned
"""
