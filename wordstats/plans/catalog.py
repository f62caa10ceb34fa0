"""Named queries over a directory of corpus tables: ``(spark, sf_dir) -> DataFrame``.

Each query derives its word data from the corpus tables through
``wordstats.sources.corpus`` and runs over all of it.  Queries that read
the answers once stage them lazily; queries that read them several times
store the narrow answer rows once (``stored_raw``) so the text is scanned
once per query.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordstats.functions.text import word_tokens
from wordstats.functions.words import letter_cols, letter_names, vowel_count
from wordstats.operators import display as V
from wordstats.operators import reporting as R
from wordstats.operators.difficulty import difficulty_by_pattern
from wordstats.operators.frequency import (
    letter_frequency,
    letter_frequency_by,
    letter_frequency_from_counts,
    position_frequency,
    position_frequency_from_counts,
)
from wordstats.operators.ingest import (
    ALL_LABELS,
    LABELS,
    TABLE_COLUMNS,
    label_batch,
    label_counts,
    load_result,
    stored_with_counts,
)
from wordstats.operators.lookup import materialise, store
from wordstats.operators.quality import quality_report
from wordstats.operators.scoring import top_predictions
from wordstats.operators.staging import stage_answers
from wordstats.plans.incremental import (
    merged_difficulty_by_pattern,
    merged_letter_counts,
    read_trend,
    update_counts,
    update_trend,
)
from wordstats.plans.layout import bucketed
from wordstats.plans.load import insert_if_absent, read_refused, read_table, write_rows
from wordstats.plans.model import WordModel, letter_table, model_from_staged
from wordstats.plans.ordered import read_ordered, write_ordered
from wordstats.plans.refresh import MART_ORDER, publish, read_candidates, read_mart, write_mart
from wordstats.plans.tables import mart_tables, publish_tables
from wordstats.session import scratch_dir
from wordstats.sources.corpus import (
    candidate_words,
    corpus_tokens,
    corpus_words,
    latest_documents,
    load_fixture,
    raw_answers,
    table,
    window_end,
    word_docs,
)
from wordstats.sources.pages import PAGE, land_pages, read_pages
from wordstats.streaming.ingest import start_stream_load
from wordstats.streaming.keyed import keyed_counts, start_keyed_load

Query = Callable[[SparkSession, str], DataFrame]


# --- answers ----------------------------------------------------------------

def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged answers of the corpus, lazily (for single-pass queries)."""
    return stage_answers(raw_answers(spark, sf_dir))


def stored_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus's raw answers, stored once in the shared directory.

    The adapter reads every document's text; its output is one narrow row
    per document.  Queries that read the answers more than once (the letter
    table, then the lookups' probe side or the used-answer set; the stored
    rows, their high-water mark and ids in a load; a count before a window)
    read this copy, so the text is scanned once per query.
    """
    return store(raw_answers(spark, sf_dir), "raw")


def stored_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_answers(stored_raw(spark, sf_dir))


def _model(spark: SparkSession, sf_dir: str) -> WordModel:
    return model_from_staged(stored_staged(spark, sf_dir))


# --- core models ------------------------------------------------------------

def q_stage_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir)


def q_letter_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return letter_frequency(staged(spark, sf_dir))


def q_position_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return position_frequency(staged(spark, sf_dir))


def q_difficulty_by_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return difficulty_by_pattern(staged(spark, sf_dir))


def q_answer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _model(spark, sf_dir).answer_history()


def answers_and_candidates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Raw answers and candidate words, both from one stored pass over the
    documents' texts."""
    docs = store(word_docs(spark, sf_dir), "words")
    return raw_answers(spark, sf_dir, docs=docs), candidate_words(spark, sf_dir, docs=docs)


def q_word_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, candidates = answers_and_candidates(spark, sf_dir)
    return model_from_staged(stage_answers(raw)).word_scores(candidates)


def q_top_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_predictions(q_word_scores(spark, sf_dir))


# --- marts, stored and read back through the published pointer ---------------

def _mart_roundtrip(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    path = scratch_dir(spark, "marts")
    run_folder = f"{path}/_runs/query"
    write_mart(df, run_folder, name)
    publish(spark, path, run_folder)
    return read_mart(spark, path, name)


def q_letter_frequency_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart_roundtrip(spark, "letter_frequency", q_letter_frequency(spark, sf_dir))


def q_position_heatmap_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart_roundtrip(spark, "position_heatmap", q_position_frequency(spark, sf_dir))


def q_predictions_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart_roundtrip(spark, "top_predictions", q_top_predictions(spark, sf_dir))


def q_answer_history_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart_roundtrip(spark, "answer_history", q_answer_history(spark, sf_dir))


def q_difficulty_by_pattern_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart_roundtrip(spark, "difficulty_by_pattern", q_difficulty_by_pattern(spark, sf_dir))


def _in_read_order(mart: DataFrame, *columns: str) -> DataFrame:
    """The mart's columns with ``read_position``: each row's place as it is
    read.  For marts of bounded size (alphabet, patterns, top k)."""
    placed = mart.withColumn("_at", F.monotonically_increasing_id())
    return placed.select(*columns, F.row_number().over(Window.orderBy("_at")).cast("long")
                         .alias("read_position"))


def q_letter_frequency_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_read_order(q_letter_frequency_mart(spark, sf_dir), "letter", "total_count")


def q_position_heatmap_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_read_order(q_position_heatmap_mart(spark, sf_dir), "position", "letter",
                          "position_count")


def q_predictions_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_read_order(q_predictions_mart(spark, sf_dir), "rank", "word")


def q_difficulty_by_pattern_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_read_order(q_difficulty_by_pattern_mart(spark, sf_dir), "vowel_count",
                          "unique_letter_count", "difficulty_bucket", "avg_difficulty")


def _ordered_mart(spark: SparkSession, name: str, df: DataFrame) -> str:
    path = f"{scratch_dir(spark, 'ordered')}/{name}"
    write_ordered(df, path, MART_ORDER[name])
    return path


def q_answer_history_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every puzzle of the history with its place in the read order."""
    path = _ordered_mart(spark, "answer_history", q_answer_history(spark, sf_dir))
    return read_ordered(spark, path, position="read_position").select(
        "puzzle_number", "answer", "word_commonality_score", "read_position")


def q_word_scores_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scored word with its place in the read order."""
    path = _ordered_mart(spark, "word_scores", q_word_scores(spark, sf_dir))
    return read_ordered(spark, path, position="read_position").select(
        "word", "total_score", "already_used", "read_position")


def q_recent_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest puzzles, read from the first files of the ordered history."""
    path = _ordered_mart(spark, "answer_history", q_answer_history(spark, sf_dir))
    return read_ordered(spark, path, first=R.RECENT_ANSWERS, position="read_position").select(
        "puzzle_number", "answer", "answer_date", "word_commonality_score", "read_position")


def _database(spark: SparkSession, marts: dict[str, DataFrame]) -> str:
    """The marts written as a run and published as tables of a new database."""
    run_folder = f"{scratch_dir(spark, 'tables')}/_runs/query"
    for name, df in marts.items():
        write_mart(df, run_folder, name)
    database = f"marts_{uuid.uuid4().hex}"
    publish_tables(spark, run_folder, database, list(marts))
    return database


def q_predictions_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _database(spark, {"top_predictions": q_top_predictions(spark, sf_dir)})
    return spark.sql(f"SELECT * FROM {db}.top_predictions ORDER BY rank")


def q_letter_frequency_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _database(spark, {"letter_frequency": q_letter_frequency(spark, sf_dir)})
    return spark.sql(f"SELECT * FROM {db}.letter_frequency ORDER BY total_count DESC, letter")


def q_position_heatmap_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _database(spark, {"position_heatmap": q_position_frequency(spark, sf_dir)})
    return spark.sql(f"SELECT * FROM {db}.position_heatmap ORDER BY position, position_count DESC, letter")


def q_answer_history_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _database(spark, {"answer_history": q_answer_history(spark, sf_dir)})
    return spark.sql(f"SELECT * FROM {db}.answer_history ORDER BY puzzle_number DESC")


def q_mart_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published tables with the rows that the catalog knows of."""
    answers = stored_staged(spark, sf_dir)
    model = model_from_staged(answers)
    return mart_tables(spark, _database(spark, {
        "letter_frequency": model.letter_frequency(),
        "position_heatmap": model.position_frequency(),
        "difficulty_by_pattern": difficulty_by_pattern(answers),
        "answer_history": model.answer_history()}))


def q_predictions_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions whose candidates went through the CSV seed."""
    raw, candidates = answers_and_candidates(spark, sf_dir)
    seed = scratch_dir(spark, "seed")
    candidates.write.option("header", True).csv(f"{seed}/words")
    scores = model_from_staged(stage_answers(raw)).word_scores(read_candidates(spark, f"{seed}/words"))
    return top_predictions(scores)


# --- reports ----------------------------------------------------------------

def q_kpi_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.kpi_row(staged(spark, sf_dir))


def q_prediction_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.prediction_bars(q_top_predictions(spark, sf_dir))


def q_winner_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.winner_breakdown(q_top_predictions(spark, sf_dir))


def q_winner_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.winner_word(q_top_predictions(spark, sf_dir))


def q_kpi_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.kpi_display(q_kpi_row(spark, sf_dir))


def q_letter_bar_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.letter_bar_text(q_top_letters(spark, sf_dir))


def q_recent_answers_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.recent_answers_display(q_recent_answers(spark, sf_dir))


def q_heatmap_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.heatmap_display(q_position_heatmap(spark, sf_dir))


def q_top_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top_letters(q_letter_frequency(spark, sf_dir))


def q_position_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.position_heatmap(q_position_frequency(spark, sf_dir))


def q_strongest_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.strongest_letter(q_position_frequency(spark, sf_dir))


def q_difficulty_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the trend counts its rows before choosing a plan: two reads
    return R.difficulty_trend(stored_staged(spark, sf_dir))


def q_difficulty_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.difficulty_distribution(staged(spark, sf_dir))


def q_vowel_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.vowel_distribution(staged(spark, sf_dir))


#: Documents that ``recent_answers`` looks at, at most, before it reads them all.
RECENT_SEARCH = 100_000


def q_recent_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest answers, looked for among the documents of the largest ids:
    more and more of them until enough have an answer, so that as a rule a
    few texts are read; where answers are too rare for that, all are."""
    some = 4 * R.RECENT_ANSWERS
    while some <= RECENT_SEARCH:
        docs = latest_documents(spark, sf_dir, some).filter(F.col("doc_id").isNotNull())
        found = materialise(R.recent_answers(stage_answers(raw_answers(spark, sf_dir, docs=docs))))
        if found.rows == R.RECENT_ANSWERS:
            return found.df
        some *= 16
    return R.recent_answers(staged(spark, sf_dir))


def q_latest_raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = latest_documents(spark, sf_dir, R.LATEST_RAW_ROWS)
    return R.latest_raw_rows(raw_answers(spark, sf_dir, docs=docs))


# --- checks -----------------------------------------------------------------

def q_raw_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.answer_duplicates(raw_answers(spark, sf_dir))


def q_staged_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.answer_duplicates(staged(spark, sf_dir))


def q_word_repeat_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.word_repeats(staged(spark, sf_dir), 1)


def quality_relations(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    answers_raw, candidates = answers_and_candidates(spark, sf_dir)
    raw = store(answers_raw, "raw")
    answers = stage_answers(raw)
    model = model_from_staged(answers)
    lf = model.letter_frequency()
    pf = model.position_frequency()
    # Stored like the run stores its marts: two relations read the scores,
    # and the candidate scans and lookups then run once.
    scores = store(model.word_scores(candidates), "word_scores")
    return {
        "raw_answers": raw, "staged_answers": answers,
        "letter_frequency": lf, "position_frequency": pf,
        "difficulty_by_pattern": difficulty_by_pattern(answers),
        "letter_frequency_mart": lf, "position_heatmap_mart": pf,
        "answer_history": model.answer_history(), "word_scores": scores,
        "top_predictions": top_predictions(scores),
    }


def q_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(quality_relations(spark, sf_dir))


# --- loads ------------------------------------------------------------------

def fixture_today(spark: SparkSession, sf_dir: str) -> Column:
    """The load fixture's "today" as a scalar subquery over the id column."""
    return (table(spark, sf_dir, "documents")
            .agg(F.max("doc_id").alias("_max")).select(window_end(F.col("_max"))).scalar())


def _labelled(spark: SparkSession, sf_dir: str, accept_late: bool = False) -> DataFrame:
    stored, batch = load_fixture(spark, sf_dir, raw=stored_raw(spark, sf_dir))
    return label_batch(batch, stored, today=F.col("_today"), accept_late=accept_late)


def q_ingest_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).select(
        "page", "pos", F.col("_id").alias("puzzle_number"), "label")


def q_ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_counts(_labelled(spark, sf_dir))


def q_ingest_counts_accept_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_counts(_labelled(spark, sf_dir, accept_late=True))


def q_ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch rows landed as JSON page files, read back and loaded."""
    stored, batch = load_fixture(spark, sf_dir, raw=stored_raw(spark, sf_dir))
    landing = scratch_dir(spark, "landing")
    land_pages(batch.drop("_today"), landing)
    labelled = label_batch(read_pages(spark, landing), stored, today=fixture_today(spark, sf_dir))
    return load_result(stored, labelled)


def q_ingest_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, batch = load_fixture(spark, sf_dir, full=True, raw=stored_raw(spark, sf_dir))
    return load_result(stored, label_batch(batch, stored))


def q_ingest_full_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load with a ``today``, which bounds increments only."""
    stored, batch = load_fixture(spark, sf_dir, full=True, raw=stored_raw(spark, sf_dir))
    return load_result(stored, label_batch(batch, stored, today=F.col("_today")))


def _landed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, str]:
    """(stored rows, batch, a new landing folder)."""
    stored, batch = load_fixture(spark, sf_dir, raw=stored_raw(spark, sf_dir))
    return stored, batch.drop("_today"), scratch_dir(spark, "landing")


def q_ingest_plain_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental load from pages without a page number."""
    stored, batch, landing = _landed(spark, sf_dir)
    land_pages(batch, f"{landing}/numbered")
    (spark.read.schema(PAGE).json(f"{landing}/numbered").select("results", "has_more", "total")
     .write.json(f"{landing}/plain"))
    labelled = label_batch(read_pages(spark, f"{landing}/plain"), stored,
                           today=fixture_today(spark, sf_dir))
    return load_result(stored, labelled)


def q_ingest_repeated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental load from two fetches of the same pages: every result
    arrives twice under the same page and position."""
    stored, batch, landing = _landed(spark, sf_dir)
    for i in range(2):
        land_pages(batch, f"{landing}/fetch={i}")
    labelled = label_batch(read_pages(spark, f"{landing}/*"), stored,
                           today=fixture_today(spark, sf_dir))
    return load_result(stored, labelled)


def q_ingest_bad_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of a load where a broken copy of every page, cut off
    before its results, lies beside the whole one."""
    stored, batch, landing = _landed(spark, sf_dir)
    land_pages(batch, f"{landing}/whole")
    broken = batch.select("page").distinct().select(
        F.format_string('{"page": %d, "results": [', F.col("page")).alias("value"))
    broken.write.text(f"{landing}/broken")
    labelled = label_batch(read_pages(spark, f"{landing}/*"), stored,
                           today=fixture_today(spark, sf_dir))
    return label_counts(labelled)


def _land_two_fetches(batch: DataFrame, landing: str) -> None:
    """Two fetches as files without page numbers, in two folders: a small
    one of the even ids, then a larger one of all ids whose answers are
    written backwards.  Where the first has a valid row, it must win."""
    turned = batch.withColumn("answer", F.reverse("answer"))
    for i, rows in enumerate((batch.filter(F.col("game") % F.lit(2) == F.lit(0)), turned)):
        land_pages(rows, f"{landing}/numbered={i}")
        (rows.sparkSession.read.schema(PAGE).json(f"{landing}/numbered={i}").drop("page", "part", "_corrupt")
         .write.json(f"{landing}/plain/fetch={i}"))


def q_ingest_page_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental load of two fetches that disagree: the earlier file's
    row is inserted, whatever the files' sizes."""
    stored, batch, landing = _landed(spark, sf_dir)
    _land_two_fetches(batch, landing)
    labelled = label_batch(read_pages(spark, f"{landing}/plain/*"), stored,
                           today=fixture_today(spark, sf_dir))
    return load_result(stored, labelled)


def q_stream_page_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two fetches as a stream that finds both at once."""
    stored, batch, landing = _landed(spark, sf_dir)
    _land_two_fetches(batch, landing)
    base = scratch_dir(spark, "stream")
    write_rows(stored, f"{base}/table", load_id=0)
    start_stream_load(spark, f"{landing}/plain/*", f"{base}/table", f"{base}/checkpoint",
                      today=fixture_today(spark, sf_dir)).awaitTermination()
    return read_table(spark, f"{base}/table").select(*TABLE_COLUMNS)


def q_ingest_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental load into a table stored in buckets of the id, in two
    loads: the second one's pages are all pages again."""
    stored, batch, landing = _landed(spark, sf_dir)
    land_pages(batch, landing)
    pages = read_pages(spark, landing)
    path = f"{scratch_dir(spark, 'bucketed')}/table"
    bucketed(spark, path, 8)
    write_rows(stored, path, load_id=0)
    mark = F.lit(read_table(spark, path).agg(F.max("date").cast("string")).first()[0]).cast("date")
    middle = batch.select(F.floor((F.min("page") + F.max("page")) / F.lit(2))).scalar()
    today = fixture_today(spark, sf_dir)
    insert_if_absent(spark, path, pages.filter(F.col("page") <= middle), 1, today, mark=mark)
    insert_if_absent(spark, path, pages, 2, today, mark=mark)
    return read_table(spark, path).select(*TABLE_COLUMNS)


def q_ingest_all_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All counters of the incremental load, rows out of the fetch window
    included, beside the number of rows that came in."""
    stored, batch, landing = _landed(spark, sf_dir)
    land_pages(batch, landing)
    labelled = label_batch(read_pages(spark, landing), stored, today=fixture_today(spark, sf_dir),
                           outside=True)
    _, seen = stored_with_counts(labelled)
    arrived = batch.agg(F.count(F.lit(1)).alias("arrived"))
    return arrived.select(*[F.lit(n).cast("long").alias(l) for l, n in seen.items()], "arrived")


def _with_cut_dates(batch: DataFrame) -> DataFrame:
    """The batch with half of the dates cut after the month where there is no id."""
    cut = F.col("game").isNull() & (F.floor(F.col("pos") / F.lit(4)) % F.lit(2) == F.lit(0))
    return batch.withColumn("date", F.when(cut, F.substring("date", 1, 7)).otherwise(F.col("date")))


def q_ingest_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the incremental load refuses, with its reasons, as its
    quarantine folder holds them."""
    stored, batch, landing = _landed(spark, sf_dir)
    land_pages(_with_cut_dates(batch), landing)
    base = scratch_dir(spark, "quarantine")
    write_rows(stored, f"{base}/table", load_id=0)
    insert_if_absent(spark, f"{base}/table", read_pages(spark, landing), 1,
                     fixture_today(spark, sf_dir), quarantine_path=f"{base}/refused")
    return _refused(spark, base)


def q_stream_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream."""
    stored, batch, landing = _landed(spark, sf_dir)
    land_pages(_with_cut_dates(batch), landing)
    base = scratch_dir(spark, "quarantine")
    write_rows(stored, f"{base}/table", load_id=0)
    start_stream_load(spark, landing, f"{base}/table", f"{base}/checkpoint", today=fixture_today(spark, sf_dir),
                      quarantine_path=f"{base}/refused").awaitTermination()
    return _refused(spark, base)


def _refused(spark: SparkSession, base: str) -> DataFrame:
    return read_refused(spark, f"{base}/refused", f"{base}/table").select(
        "page", F.col("game").alias("puzzle_number"), "answer", "date", "reason")


def _streamed(spark: SparkSession, sf_dir: str, full: bool = False, start=start_stream_load,
              **source_options) -> str:
    """The incremental load as a stream: the stored rows are written as load
    0, then the pages land in two drops and an available-now stream loads
    each drop as it finds it.  A full load starts without stored rows, and
    the later pages land first.  Returns the base folder."""
    stored, batch = load_fixture(spark, sf_dir, full=full, raw=stored_raw(spark, sf_dir))
    base = scratch_dir(spark, "stream")
    path = f"{base}/table"
    if not full:
        write_rows(stored, path, load_id=0)
    pages = batch.drop("_today")
    middle = pages.select(F.floor((F.min("page") + F.max("page")) / F.lit(2))).scalar()
    today = fixture_today(spark, sf_dir)
    drops = [pages.filter(F.col("page") <= middle), pages.filter(F.col("page") > middle)]
    for i, part in enumerate(reversed(drops) if full else drops):
        land_pages(part, f"{base}/landing/drop={i}")
        q = start(spark, f"{base}/landing/*", path, f"{base}/checkpoint",
                  counts_path=f"{base}/counts", today=today, **source_options)
        q.awaitTermination()
    return base


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{_streamed(spark, sf_dir)}/table").select(*TABLE_COLUMNS)


def q_stream_ingest_single_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stream with one file per micro-batch."""
    base = _streamed(spark, sf_dir, maxFilesPerTrigger=1)
    return read_table(spark, f"{base}/table").select(*TABLE_COLUMNS)


def q_stream_ingest_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load as a stream, one file per micro-batch, later pages first."""
    base = _streamed(spark, sf_dir, full=True, maxFilesPerTrigger=1)
    return read_table(spark, f"{base}/table").select(*TABLE_COLUMNS)


def q_stream_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream with its ids in a state store."""
    base = _streamed(spark, sf_dir, start=start_keyed_load)
    return read_table(spark, f"{base}/table").select(*TABLE_COLUMNS)


def q_stream_keyed_arrived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What that stream stored, left out of its window, and saw in all, one
    file per micro-batch."""
    base = _streamed(spark, sf_dir, start=start_keyed_load, maxFilesPerTrigger=1)
    return keyed_counts(spark, f"{base}/counts").select(
        "inserted", "outside", sum((F.col(c) for c in ALL_LABELS), F.lit(0)).alias("arrived"))


def q_stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's stored counters, over all micro-batches."""
    counts = spark.read.parquet(f"{_streamed(spark, sf_dir)}/counts")
    return counts.agg(*[F.sum(c).alias(c) for c in LABELS])


def q_stream_all_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of the stream's counters, one file per micro-batch."""
    counts = spark.read.parquet(f"{_streamed(spark, sf_dir, maxFilesPerTrigger=1)}/counts")
    return counts.agg(*[F.sum(c).alias(c) for c in ALL_LABELS],
                      F.sum(sum((F.col(c) for c in ALL_LABELS), F.lit(0))).alias("arrived"))


# --- marts kept up from load to load ----------------------------------------

def _after_three_loads(spark: SparkSession, sf_dir: str, update: Callable[[str, str], object]) -> str:
    """The fixture's stored rows and its batch in two loads; ``update(table,
    state)`` runs after each of the three.  Returns the state's folder."""
    stored, batch, _ = _landed(spark, sf_dir)
    base = scratch_dir(spark, "incremental")
    path, state = f"{base}/table", f"{base}/state"
    write_rows(stored, path, load_id=0)
    update(path, state)
    mark = F.lit(read_table(spark, path).agg(F.max("date").cast("string")).first()[0]).cast("date")
    middle = batch.select(F.floor((F.min("page") + F.max("page")) / F.lit(2))).scalar()
    today = fixture_today(spark, sf_dir)
    for load, rows in enumerate((batch.filter(F.col("page") <= middle), batch.filter(F.col("page") > middle))):
        insert_if_absent(spark, path, rows, load + 1, today, mark=mark)
        update(path, state)
    return state


def q_incremental_letter_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _after_three_loads(spark, sf_dir, lambda t, s: update_counts(spark, t, s))
    return letter_frequency_from_counts(merged_letter_counts(spark, state))


def q_incremental_position_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _after_three_loads(spark, sf_dir, lambda t, s: update_counts(spark, t, s))
    return position_frequency_from_counts(merged_letter_counts(spark, state))


def q_incremental_difficulty_by_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _after_three_loads(spark, sf_dir, lambda t, s: update_counts(spark, t, s))
    return merged_difficulty_by_pattern(spark, state)


def q_incremental_difficulty_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_trend(spark, _after_three_loads(spark, sf_dir, lambda t, s: update_trend(spark, t, s)))


# --- corpus scale -------------------------------------------------------------

def _corpus_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = corpus_words(spark, sf_dir)
    return words.select("answer", *letter_cols(F.col("answer")))


def q_corpus_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_tokens(spark, sf_dir)


def q_corpus_letter_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return letter_frequency(_corpus_letters(spark, sf_dir))


def q_corpus_position_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return position_frequency(_corpus_letters(spark, sf_dir))


def q_corpus_top_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top_letters(q_corpus_letter_frequency(spark, sf_dir))


def q_corpus_position_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.position_heatmap(q_corpus_position_frequency(spark, sf_dir))


def q_corpus_strongest_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.strongest_letter(q_corpus_position_frequency(spark, sf_dir))


def q_corpus_vowel_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = [F.col(c) for c in letter_names()]
    return R.vowel_distribution(_corpus_letters(spark, sf_dir)
                                .select(vowel_count(letters).alias("vowel_count")))


def q_corpus_word_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates scored by the letters of all word tokens, whole texts; the
    used words are still the puzzle answers."""
    raw, candidates = answers_and_candidates(spark, sf_dir)
    letters = materialise(letter_table(_corpus_letters(spark, sf_dir)))
    return WordModel(stage_answers(raw), letters).word_scores(candidates)


def q_corpus_top_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_predictions(q_corpus_word_scores(spark, sf_dir))


def q_corpus_letter_frequency_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letter shares and ranks within each language of the corpus."""
    words = (table(spark, sf_dir, "documents")
             .select("lang", F.explode(word_tokens(F.col("text"))).alias("token"))
             .select("lang", F.upper("token").alias("answer")))
    return letter_frequency_by(words.select("lang", *letter_cols(F.col("answer"))), "lang")


QUERIES: dict[str, Query] = {
    "stage_answers": q_stage_answers,
    "letter_frequency": q_letter_frequency,
    "position_frequency": q_position_frequency,
    "difficulty_by_pattern": q_difficulty_by_pattern,
    "answer_history": q_answer_history,
    "word_scores": q_word_scores,
    "top_predictions": q_top_predictions,
    "kpi_row": q_kpi_row,
    "prediction_bars": q_prediction_bars,
    "winner_breakdown": q_winner_breakdown,
    "top_letters": q_top_letters,
    "position_heatmap": q_position_heatmap,
    "strongest_letter": q_strongest_letter,
    "difficulty_trend": q_difficulty_trend,
    "difficulty_distribution": q_difficulty_distribution,
    "vowel_distribution": q_vowel_distribution,
    "recent_answers": q_recent_answers,
    "latest_raw_rows": q_latest_raw_rows,
    "raw_duplicates": q_raw_duplicates,
    "staged_duplicates": q_staged_duplicates,
    "word_repeat_check": q_word_repeat_check,
    "quality_report": q_quality_report,
    "ingest_labels": q_ingest_labels,
    "ingest_counts": q_ingest_counts,
    "ingest_counts_accept_late": q_ingest_counts_accept_late,
    "ingest_incremental": q_ingest_incremental,
    "ingest_full": q_ingest_full,
    "stream_ingest": q_stream_ingest,
    "corpus_tokens": q_corpus_tokens,
    "corpus_letter_frequency": q_corpus_letter_frequency,
    "corpus_position_frequency": q_corpus_position_frequency,
    "corpus_letter_frequency_by_lang": q_corpus_letter_frequency_by_lang,
    "letter_frequency_mart": q_letter_frequency_mart,
    "position_heatmap_mart": q_position_heatmap_mart,
    "predictions_mart": q_predictions_mart,
    "answer_history_mart": q_answer_history_mart,
    "difficulty_by_pattern_mart": q_difficulty_by_pattern_mart,
    "ingest_full_today": q_ingest_full_today,
    "ingest_plain_pages": q_ingest_plain_pages,
    "ingest_repeated_pages": q_ingest_repeated_pages,
    "ingest_bad_documents": q_ingest_bad_documents,
    "ingest_page_order": q_ingest_page_order,
    "ingest_all_counts": q_ingest_all_counts,
    "ingest_bucketed": q_ingest_bucketed,
    "ingest_refused": q_ingest_refused,
    "stream_refused": q_stream_refused,
    "predictions_sql": q_predictions_sql,
    "letter_frequency_sql": q_letter_frequency_sql,
    "position_heatmap_sql": q_position_heatmap_sql,
    "answer_history_sql": q_answer_history_sql,
    "mart_tables": q_mart_tables,
    "stream_page_order": q_stream_page_order,
    "stream_all_counts": q_stream_all_counts,
    "stream_ingest_single_files": q_stream_ingest_single_files,
    "stream_ingest_full": q_stream_ingest_full,
    "stream_keyed": q_stream_keyed,
    "stream_keyed_arrived": q_stream_keyed_arrived,
    "stream_counts": q_stream_counts,
    "answer_history_read": q_answer_history_read,
    "word_scores_read": q_word_scores_read,
    "recent_history": q_recent_history,
    "incremental_letter_frequency": q_incremental_letter_frequency,
    "incremental_position_frequency": q_incremental_position_frequency,
    "incremental_difficulty_by_pattern": q_incremental_difficulty_by_pattern,
    "incremental_difficulty_trend": q_incremental_difficulty_trend,
    "corpus_top_letters": q_corpus_top_letters,
    "corpus_position_heatmap": q_corpus_position_heatmap,
    "corpus_strongest_letter": q_corpus_strongest_letter,
    "corpus_vowel_distribution": q_corpus_vowel_distribution,
    "corpus_word_scores": q_corpus_word_scores,
    "corpus_top_predictions": q_corpus_top_predictions,
    "letter_frequency_read": q_letter_frequency_read,
    "position_heatmap_read": q_position_heatmap_read,
    "predictions_read": q_predictions_read,
    "difficulty_by_pattern_read": q_difficulty_by_pattern_read,
    "predictions_from_csv": q_predictions_from_csv,
    "winner_word": q_winner_word,
    "kpi_text": q_kpi_text,
    "letter_bar_text": q_letter_bar_text,
    "recent_answers_display": q_recent_answers_display,
    "heatmap_display": q_heatmap_display,
}
