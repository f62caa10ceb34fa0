"""Connected components of a link table, as a distributed job.

Alternating large-star and small-star steps: every node links to the
smallest node it knows.  Links stay in tables; each round is written to the
shared checkpoint folder, which cuts lineage, and the loop ends when a round
leaves the links unchanged.  A hot node's neighbours are only ever joined
with, or reduced to, its minimum, so they are never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wordstats.operators.lookup import store


def _round(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links (a > b)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select(
        F.col("a").alias("_u"), F.least("a", "_m").alias("_m"))
    # Larger neighbours of u (the links whose smaller end is u) move to u's minimum.
    large = (links.join(least, links["b"] == least["_u"])
             .select("a", F.col("_m").alias("b")))
    # u and its smaller neighbours move to the smallest of them.
    low = large.groupBy("a").agg(F.min("b").alias("_m")).withColumnRenamed("a", "_u")
    moved = (large.join(low, large["a"] == low["_u"])
             .select(F.col("b").alias("a"), F.col("_m").alias("b")))
    return (moved.unionByName(low.select(F.col("_u").alias("a"), F.col("_m").alias("b")))
            .filter(F.col("a") != F.col("b")).distinct())


def _stored(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The stored links, and a count and checksum of them."""
    seen = Observation("links")
    done = store(links.observe(seen, F.count(F.lit(1)).alias("n"),
                               F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")), "links")
    return done, (seen.get["n"], seen.get["sum"])


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: comparable ids), root
    being the smallest node reachable.  A link's direction, repeats and
    self-links don't matter."""
    ordered = (links.filter(F.col("a") != F.col("b"))
               .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    current, state = _stored(ordered)
    while state[0]:
        current, after = _stored(_round(current))
        if after == state:
            break
        state = after
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())
