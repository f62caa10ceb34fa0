"""Physical-plan properties that matter at scale."""

import pytest

from conftest import SF_SMALL
from wordstats.plans.catalog import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["stage_answers", "letter_frequency", "word_scores",
                                  "top_predictions", "answer_history", "quality_report",
                                  "ingest_counts", "corpus_letter_frequency"])
def test_no_python_in_plans(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in p


def test_scan_prunes_columns_and_pushes_null_filter(spark):
    p = plan(QUERIES["stage_answers"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint,text:string,n_chars:bigint>" in p


def test_top_predictions_is_a_distributed_top_k(spark):
    p = plan(QUERIES["top_predictions"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p or "WindowGroupLimit" in p


def test_lookups_broadcast_the_letter_table(spark):
    p = plan(QUERIES["word_scores"](spark, SF_SMALL))
    assert p.count("BroadcastHashJoin") >= 5


def test_frequencies_unpivot_in_one_scan(spark):
    p = plan(QUERIES["position_frequency"](spark, SF_SMALL))
    assert p.count("FileScan parquet") <= 2   # documents + labels, once each
    assert "Union" not in p


def final_plan(df) -> str:
    """The adaptive plan after the frame's own execution (reuse shows then)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_candidate_lookups_share_one_broadcast(spark):
    p = final_plan(QUERIES["word_scores"](spark, SF_SMALL))
    assert p.count("ReusedExchange") >= 4      # five lookups, one broadcast


def test_load_joins_only_rows_with_an_id(spark):
    from pyspark.sql import functions as F

    from wordstats.operators.ingest import label_batch
    from wordstats.sources.corpus import load_fixture

    table, batch = load_fixture(spark, SF_SMALL)
    plan = label_batch(batch, table, today=F.col("_today"))._jdf.queryExecution() \
        .optimizedPlan().toString()
    lines = plan.splitlines()
    assert lines[0].startswith("Union")
    second = "\n".join(lines[next(i for i, l in enumerate(lines) if l.startswith("+- ")):])
    # the id-less branch is labelled without the id joins
    assert "isnull(" in second and "LeftOuter" not in second
    assert "LeftOuter" in "\n".join(lines[:lines.index(second.splitlines()[0])])


def test_word_queries_read_documents_once(spark):
    from wordstats.plans.catalog import answers_and_candidates

    raw, candidates = answers_and_candidates(spark, SF_SMALL)
    for df in (raw, candidates):
        assert df.count() > 0
        assert not any(f.endswith(f"{SF_SMALL}/documents.parquet") for f in df.inputFiles())
