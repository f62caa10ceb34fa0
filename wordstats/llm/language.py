"""Language identification by compression.

For each language a raw-content zstandard dictionary is cut from a bounded
sample of labelled texts.  Texts are lower-cased and what isn't a letter is
taken as one space; then a text is compressed with every dictionary, and the
language whose dictionary gives the smallest size is chosen, and the choice
is rejected (``accepted`` false) when the margin over the runner-up is
narrow.  Long texts are compressed in blocks of ``BLOCK_BYTES`` bytes, all
of them, so that the dictionary stays within reach of every part.

Null texts and texts without a letter are ``und`` with score 0, and so is
everything when nothing could be learnt.  Equal sizes go to the language
with more labelled texts, then to the smaller code.  Rows with a null id or
label are not learnt from.  Repeated rows and extra columns pass through;
an input column named like an output column is replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordstats.llm.common import bound_batches, id_remainder, table, with_replaced

#: Labelled texts sampled per language for its dictionary.
SAMPLES = 128
#: Bytes of a dictionary.
DICT_BYTES = 128 << 10
#: Bytes compressed at a time.
BLOCK_BYTES = 8 << 10
LEVEL = 5
#: Narrowest margin, as a share of the runner-up's size, that is accepted.
MIN_MARGIN = 0.02
#: How fast the score rises with the margin.
SCORE_SCALE = 40.0

_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")
_COMPRESSORS: dict = {}


def letters(text: str) -> bytes:
    """The text's words in lower case, a space for all between them."""
    return _OTHER.sub(" ", text.lower()).encode()


def learn(docs: DataFrame, use: Column, samples: int = SAMPLES,
          dict_bytes: int = DICT_BYTES) -> list[tuple[str, bytes]]:
    """(language, dictionary bytes), most labelled texts first.

    ``samples`` texts per language are drawn by a hash of their id, first
    over the narrow columns; only the drawn texts, one of each id, reach the driver, each cut to a
    dictionary's size."""
    usable = docs.filter(use & F.col("lang").isNotNull() & (F.length("text") > 0))
    labelled = usable.select("doc_id", "lang")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    drawn = (labelled.distinct().withColumn("_n", F.row_number().over(order))
             .filter(F.col("_n") <= samples).select("doc_id", "lang"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    # At most `samples` ids per language: a bounded table, and one of each id's rows.
    rows = (usable.select("doc_id", "lang", F.left(F.col("text"), F.lit(dict_bytes)).alias("text"))
            .join(F.broadcast(drawn), ["doc_id", "lang"], "left_semi").groupBy("doc_id", "lang")
            .agg(F.min_by("text", F.xxhash64("text")).alias("text")).collect())
    texts: dict[str, list[bytes]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["doc_id"], r["text"])):
        texts.setdefault(r["lang"], []).append(letters(r["text"]))
    out = []
    for lang in sorted(texts, key=lambda x: (-sizes[x], x)):
        # Every sampled text gets an equal part of the dictionary.
        part = max(1, dict_bytes // len(texts[lang]))
        short = sorted(texts[lang], key=len)
        left, room = len(short), dict_bytes
        cuts = []
        for t in short:
            take = min(len(t), max(part, room // left))
            cuts.append(t[:take])
            room, left = room - take, left - 1
        out.append((lang, b" ".join(cuts)))
    return out


def _compressors(model: list[tuple[str, bytes]]):
    key = hash(tuple(model))
    if key not in _COMPRESSORS:
        import zstandard as zstd

        made = []
        for lang, raw in model:
            d = zstd.ZstdCompressionDict(raw, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            made.append((lang, zstd.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False,
                                                   write_content_size=False, write_dict_id=False)))
        _COMPRESSORS[key] = made
    return _COMPRESSORS[key]


def classify(compressors, text: str | None) -> tuple[str, float, bool]:
    """(language, score, accepted) of one whole text."""
    if not text or not compressors or _LETTER.search(text) is None:
        return "und", 0.0, False
    raw = letters(text)
    blocks = [raw[i:i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]
    sizes = [sum(len(c.compress(b)) for b in blocks) for _, c in compressors]
    best = min(range(len(sizes)), key=sizes.__getitem__)
    second = min((s for i, s in enumerate(sizes) if i != best), default=None)
    if second is None:
        return compressors[best][0], 1.0, True
    margin = (second - sizes[best]) / second
    return compressors[best][0], 1.0 - math.exp(-SCORE_SCALE * margin), margin >= MIN_MARGIN


def identify(docs: DataFrame, model: Broadcast, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``accepted``."""
    bound_batches(docs.sparkSession)

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compressors = _compressors(model.value)
        for batch in batches:
            yield pd.DataFrame([classify(compressors, t) for t in batch],
                               columns=["lang_pred", "score", "accepted"])

    found = with_replaced(docs, {"_found": predict(F.col(text))})
    return with_replaced(found, {c: F.col("_found")[c]
                                 for c in ("lang_pred", "score", "accepted")}).drop("_found")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: learn from documents outside the held-out remainder, predict all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rest = id_remainder(4)
    model = spark.sparkContext.broadcast(learn(docs, rest != 2))
    return (identify(docs.select("doc_id", "text", F.coalesce(rest == 2, F.lit(False)).alias("held_out")),
                     model)
            .select("doc_id", "held_out", "lang_pred", "score", "accepted"))
