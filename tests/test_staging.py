import datetime as dt

from conftest import RAW_SCHEMA
from wordstats.operators.staging import stage_answers, staged_columns

D = dt.date(2024, 1, 1)


def raw(spark, rows):
    return spark.createDataFrame(
        [(i, a, D + dt.timedelta(days=i), "x", d) for i, (a, d) in enumerate(rows)], RAW_SCHEMA)


def test_word_features(spark):
    df = raw(spark, [("  cigar ", 4.0), ("HELLO", 3.0), ("EERIE", 2.9), ("LLAMA", None),
                     ("CRYPT", 5.0), ("TREES2", 1.0), ("FOUR", 1.0), (None, 1.0)])
    out = {r["answer"]: r for r in stage_answers(df).collect()}
    assert set(out) == {"CIGAR", "HELLO", "EERIE", "LLAMA", "CRYPT"}
    c = out["CIGAR"]
    assert [c[f"letter_{i}"] for i in range(1, 6)] == list("CIGAR")
    assert (c["vowel_count"], c["unique_letter_count"], c["difficulty_bucket"]) == (2, 5, "hard")
    assert out["HELLO"]["unique_letter_count"] == 3
    assert out["HELLO"]["difficulty_bucket"] == "medium"
    assert (out["EERIE"]["unique_letter_count"], out["EERIE"]["vowel_count"]) == (2, 4)
    assert out["EERIE"]["difficulty_bucket"] == "easy"
    assert (out["LLAMA"]["unique_letter_count"], out["LLAMA"]["vowel_count"]) == (1, 2)
    assert out["LLAMA"]["difficulty_bucket"] == "easy"
    assert out["CRYPT"]["vowel_count"] == 0


def test_schema(spark):
    df = stage_answers(raw(spark, [("cigar", 1.0)]))
    assert df.columns == staged_columns()
    types = dict(df.dtypes)
    assert types["puzzle_number"] == "bigint" and types["answer_year"] == "bigint"
    assert types["difficulty"] == "float" and types["vowel_count"] == "int"


def test_other_word_length(spark):
    df = raw(spark, [("abcdef", 1.0), ("abcde", 1.0)])
    out = stage_answers(df, n=6).collect()
    assert [r["answer"] for r in out] == ["ABCDEF"]
    assert out[0]["letter_6"] == "F"
