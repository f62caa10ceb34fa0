from pyspark.sql import functions as F

from conftest import SF_SMALL
from wordstats.plans.load import read_table
from wordstats.plans.refresh import RunConfig, read_candidates, read_mart, run
from wordstats.session import scratch_dir
from wordstats.sources.corpus import candidate_words, load_fixture
from wordstats.sources.pages import land_pages


def test_end_to_end_run(spark):
    base = scratch_dir(spark, "run")
    _, batch = load_fixture(spark, SF_SMALL, full=True)
    land_pages(batch.drop("_today"), f"{base}/landing")
    candidate_words(spark, SF_SMALL).write.option("header", True).csv(f"{base}/seed")
    cands = read_candidates(spark, f"{base}/seed")
    cfg = RunConfig(table_path=f"{base}/table", marts_path=f"{base}/marts",
                    landing=f"{base}/landing")
    first = run(spark, cfg, cands)
    assert first["published"] and first["load"]["inserted"] == 161
    top = read_mart(spark, cfg.marts_path, "top_predictions").collect()
    assert [r["rank"] for r in top] == list(range(1, 11))
    hist = read_mart(spark, cfg.marts_path, "answer_history")
    assert hist.count() == 161 and len(hist.columns) == 11
    # the same pages again: nothing new is stored
    second = run(spark, cfg, cands)
    assert second["load"]["inserted"] == 0
    assert read_table(spark, cfg.table_path).count() == 161
    # an empty load writes no partition, so the next load may reuse its id
    assert read_table(spark, cfg.table_path).select(F.max("load_id")).first()[0] == 0


def test_failed_checks_do_not_publish(spark):
    from wordstats.plans.refresh import published_run

    base = scratch_dir(spark, "run-gate")
    _, batch = load_fixture(spark, SF_SMALL, full=True)
    land_pages(batch.drop("_today"), f"{base}/landing")
    cands = candidate_words(spark, SF_SMALL)
    cfg = RunConfig(table_path=f"{base}/table", marts_path=f"{base}/marts",
                    landing=f"{base}/landing")
    good = run(spark, cfg, cands)
    assert good["published"] and published_run(spark, cfg.marts_path) == good["run"]
    # a candidate list with a repeated word breaks the unique check on word_scores
    bad = run(spark, RunConfig(table_path=cfg.table_path, marts_path=cfg.marts_path),
              cands.unionByName(cands.limit(1)))
    assert not bad["published"]
    failing = {(r["relation"], r["check_name"], r["column_name"])
               for r in bad["report"].filter("failures > 0").collect()}
    assert ("word_scores", "unique", "word") in failing
    assert published_run(spark, cfg.marts_path) == good["run"]


def test_command_line_run(spark):
    from wordstats.__main__ import main

    base = scratch_dir(spark, "cli")
    _, batch = load_fixture(spark, SF_SMALL, full=True)
    land_pages(batch.drop("_today"), f"{base}/landing")
    candidate_words(spark, SF_SMALL).write.option("header", True).csv(f"{base}/seed")
    code = main(["--table", f"{base}/table", "--marts", f"{base}/marts",
                 "--candidates", f"{base}/seed", "--landing", f"{base}/landing"])
    assert code == 0
    assert read_mart(spark, f"{base}/marts", "top_predictions").count() == 10


def test_published_marts_equal_direct_queries(spark):
    from wordstats.plans.catalog import QUERIES

    base = scratch_dir(spark, "run-eq")
    _, batch = load_fixture(spark, SF_SMALL, full=True)
    land_pages(batch.drop("_today"), f"{base}/landing")
    cfg = RunConfig(table_path=f"{base}/table", marts_path=f"{base}/marts",
                    landing=f"{base}/landing")
    assert run(spark, cfg, candidate_words(spark, SF_SMALL))["published"]
    for mart, query in [("letter_frequency", "letter_frequency"),
                        ("position_heatmap", "position_frequency"),
                        ("word_scores", "word_scores"),
                        ("top_predictions", "top_predictions")]:
        published = read_mart(spark, cfg.marts_path, mart, ordered=False)
        direct = QUERIES[query](spark, SF_SMALL).select(*published.columns)
        assert sorted(published.collect()) == sorted(direct.collect()), mart
