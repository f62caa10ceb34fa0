import datetime as dt

from pyspark.sql import functions as F

from conftest import RAW_SCHEMA
from wordstats.operators.frequency import letter_frequency, position_frequency
from wordstats.operators.scoring import score_table, top_predictions, word_scores
from wordstats.operators.staging import stage_answers
from wordstats.plans.model import build_model

D = dt.date(2024, 1, 1)


def staged(spark, words):
    rows = [(i, w, D + dt.timedelta(days=i), "x", 1.0) for i, w in enumerate(words)]
    return stage_answers(spark.createDataFrame(rows, RAW_SCHEMA))


def test_rank_ties_share_rank(spark):
    lf = {r["letter"]: r for r in letter_frequency(staged(spark, ["ABCDE", "ABCDF"])).collect()}
    # A B C D twice each -> rank 1; E F once each -> rank 5 (gap after ties)
    assert {lf[c]["frequency_rank"] for c in "ABCD"} == {1}
    assert lf["E"]["frequency_rank"] == lf["F"]["frequency_rank"] == 5
    assert lf["A"]["frequency_pct"] == 20.0


def test_short_and_null_candidates(spark):
    s = staged(spark, ["ABCDE"])
    table = score_table(letter_frequency(s), position_frequency(s))
    cands = spark.createDataFrame([("ab",), (None,), ("abcde",)], "word string")
    out = {r["word"]: r for r in word_scores(cands, s, table).collect()}
    ab = out["AB"]
    assert (ab["letter_3"], ab["pos3_score"], ab["pos5_score"]) == ("", 0.0, 0.0)
    assert ab["pos1_score"] == 20.0 + 100.0
    assert out[None]["already_used"] is False and out[None]["total_score"] == 0.0
    assert out["ABCDE"]["already_used"] is True


def test_broadcast_and_shuffle_paths_agree(spark):
    s = staged(spark, ["CIGAR", "REBUT", "SISSY", "HUMPH", "AWAKE"])
    table = score_table(letter_frequency(s), position_frequency(s))
    cands = spark.createDataFrame([(w,) for w in ["crane", "slate", "sissy", "zzzzz", "qu"]],
                                  "word string")
    a = sorted(word_scores(cands, s, table, broadcast=True).collect())
    b = sorted(word_scores(cands, s, table, broadcast=False).collect())
    assert a == b


def test_top_predictions_ties_alphabetical_and_unused_only(spark):
    s = staged(spark, ["AAAAA"])
    table = score_table(letter_frequency(s), position_frequency(s))
    cands = spark.createDataFrame([(w,) for w in ["zzzzz", "yyyyy", "aaaaa", "xxxxx"]],
                                  "word string")
    top = top_predictions(word_scores(cands, s, table), k=2).orderBy("rank").collect()
    assert [(r["rank"], r["word"]) for r in top] == [(1, "XXXXX"), (2, "YYYYY")]


def test_model_invariants(spark):
    from conftest import SF_SMALL
    from wordstats.sources.corpus import candidate_words, raw_answers

    raw = raw_answers(spark, SF_SMALL)
    m = build_model(raw)
    n_words = m.staged.count()
    lf = letter_frequency(m.staged)
    pf = position_frequency(m.staged)
    assert lf.agg(F.sum("total_count")).first()[0] == 5 * n_words
    per_pos = {r[0]: r[1] for r in pf.groupBy("position").agg(F.sum("position_count")).collect()}
    assert per_pos == {p: n_words for p in range(1, 6)}
    assert m.answer_history().count() == n_words
    cands = candidate_words(spark, SF_SMALL)
    assert m.word_scores(cands).count() == cands.count()
    top = m.top_predictions(cands)
    assert top.count() == 10
    assert top.join(m.staged, top.word == m.staged.answer, "left_semi").count() == 0
