import math
import re
import zlib

from pyspark.sql import functions as F

from wordstats.llm import language

from llm_tables import AWKWARD, SF_MID, docs_of  # noqa: F401


def test_held_out_accuracy(spark):
    rows = language.query(spark, SF_MID).collect()
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "de", "fr", "es", "und") for r in rows)
    held = [(r.lang_pred == truth[r.doc_id][0], r.score, r.accepted) for r in rows if r.held_out]
    assert sum(x for x, _, _ in held) >= 0.95 * len(held)
    sure = [x for x, _, accepted in held if accepted]
    assert len(sure) >= 0.8 * len(held) and sum(sure) >= 0.97 * len(sure)


def test_awkward_rows(spark, docs_of):
    rows = [(i, t, "en" if i != 7 else "xx") for i, t in AWKWARD] + [(30, "12 34 _ 5"), (31, "a" * 300_000, None)]
    docs = docs_of(rows).withColumn("score", F.lit("clash"))
    model = language.learn(docs, F.lit(True))
    assert [x for x, _ in model] == ["en", "xx"]
    assert all(len(d) <= language.DICT_BYTES + 2 * language.SAMPLES for _, d in model)
    got = language.identify(docs, spark.sparkContext.broadcast(model)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert {by[i].lang_pred for i in (0, 1, 2, 30)} == {"und"} and by[0].score == 0
    assert by[7].lang_pred == "xx" and by[5].lang_pred == by[6].lang_pred == "en"
    nothing = spark.sparkContext.broadcast(language.learn(docs_of([]), F.lit(True)))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(docs_of([]), nothing).count() == 0


def test_long_texts_use_all_blocks(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    compressors = language._compressors(language.learn(docs, F.lit(True)))
    en = " ".join(r.text for r in docs.filter("lang = 'en'").limit(40).collect())
    de = " ".join(r.text for r in docs.filter("lang = 'de'").limit(400).collect())
    assert language.classify(compressors, en[:20_000] + de[:200_000])[0] == "de"


def test_rows_of_one_id_are_learnt_from_once(spark, docs_of):
    hot = [(1, "abcdefgh " * 5000 + "klmnopq"[i % 7] * i) for i in range(1, 60)]
    rest = [(i, "zzzzzz yyyyyy") for i in range(2, 6)]
    (_, dictionary), = language.learn(docs_of([*hot, (1, None), *rest]), F.lit(True), samples=4, dict_bytes=40_000)
    # one row of the hot id and the others that were drawn
    assert dictionary.count(b"zzzzzz") >= 3 and len(dictionary) <= 40_000 + 4


def test_predictions_equal_a_plain_loop_over_dictionaries(spark):
    """Every text against every dictionary, block by block, on its own."""
    import zstandard

    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text", "lang")
    model = language.learn(docs, language.id_remainder(4) != 2)
    dictionaries = {lang: zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                    for lang, raw in model}
    rows = {r.doc_id: r for r in language.query(spark, SF_MID).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert rows.keys() == texts.keys()
    for doc_id, text in sorted(texts.items())[::10]:
        got = rows[doc_id]
        if not any(c.isalpha() for c in text or ""):
            assert (got.lang_pred, got.score) == ("und", 0)
            continue
        raw = " ".join(re.split(r"[\W\d_]+", text.lower())).encode()
        size = {}
        for lang, known in dictionaries.items():
            made = zstandard.ZstdCompressor(level=language.LEVEL, dict_data=known, write_checksum=False,
                                            write_content_size=False, write_dict_id=False)
            size[lang] = sum(len(made.compress(raw[i:i + language.BLOCK_BYTES]))
                             for i in range(0, len(raw), language.BLOCK_BYTES))
        best, second = sorted(size.values())[:2]
        assert size[got.lang_pred] == best
        margin = (second - best) / second
        assert got.accepted == (margin >= language.MIN_MARGIN)
        assert abs(got.score - (1 - math.exp(-language.SCORE_SCALE * margin))) < 1e-12
