"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it
returns is written as Parquet and read again as the next one's ``docs``.

1. toxicity: documents scored as toxic go;
2. near-duplicates: one document of each SimHash component stays;
3. secrets: found secrets are replaced in the text;
4. mixing: documents are repeated or left out towards the sources' targets;
5. tokens: every document's byte-level BPE ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordstats.llm import byte_bpe, mixing, secrets, simhash, toxicity
from wordstats.llm.common import table
from wordstats.operators.lookup import store

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.learnable())
    scored = toxicity.score_texts(docs, spark.sparkContext.broadcast(model))
    return scored.filter(F.col("predicted") == 0).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs.select(*COLUMNS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    model = spark.sparkContext.broadcast(secrets.train(docs))
    # The length is counted anew for the changed texts; a null text has none.
    return (secrets.redact(docs, model)
            .withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs.select(*COLUMNS))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ids = byte_bpe.encode(docs.select(*COLUMNS), byte_bpe.default_ranks(spark))
    return ids.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("tokens", tokenise),
]

#: Models and a tokenizer are in the stages, so SQL can't give run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
