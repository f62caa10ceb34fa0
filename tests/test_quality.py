import datetime as dt

from conftest import RAW_SCHEMA, SF_SMALL
from wordstats.operators.quality import CHECKS, passes, quality_report
from wordstats.operators.staging import stage_answers


def test_declared_check_count():
    n_nn = sum(len(c.not_null) for c in CHECKS)
    n_u = sum(len(c.unique) for c in CHECKS)
    n_c = sum(c.no_duplicate_answers for c in CHECKS)
    assert (n_nn, n_u, n_c) == (39, 10, 1)


def test_seeded_violations_fail(spark):
    d = dt.date(2024, 1, 1)
    raw = spark.createDataFrame([
        (1, "CIGAR", d, "x", 1.0), (1, "CIGAR", d, "x", 1.0),   # duplicate id, date, pair
        (2, None, dt.date(2024, 1, 2), "x", 1.0),               # null answer
    ], RAW_SCHEMA)
    rep = quality_report({"raw_answers": raw, "staged_answers": stage_answers(raw)})
    got = {(r["relation"], r["check_name"], r["column_name"]): r["failures"] for r in rep.collect()}
    assert got[("raw_answers", "not_null", "answer")] == 1
    assert got[("raw_answers", "unique", "puzzle_number")] == 1
    assert got[("raw_answers", "unique", "date")] == 1
    assert got[("staged_answers", "no_duplicate_answers", "puzzle_number,answer")] == 1
    assert got[("staged_answers", "not_null", "letter_1")] == 0
    assert not passes(rep)


def test_gate_wants_every_declared_check(spark):
    raw = spark.createDataFrame([(1, "CIGAR", dt.date(2024, 1, 1), "x", 1.0)], RAW_SCHEMA)
    rep = quality_report({"raw_answers": raw})
    assert passes(rep) and not passes(rep, CHECKS)
    assert passes(rep, tuple(c for c in CHECKS if c.relation == "raw_answers"))


def test_clean_marts_pass(spark):
    from wordstats.plans.catalog import quality_relations

    rels = quality_relations(spark, SF_SMALL)
    rels.pop("raw_answers")   # the raw corpus adapter has documents without a word
    assert passes(quality_report(rels))
