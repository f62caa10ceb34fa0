"""The end-to-end run: load -> stage -> marts -> checks -> publish.

Marts are written under a run-specific folder, the declared checks run on
what was written, and only when every check passes does the run become the
published one: a pointer with the run's folder is added to
``<marts>/_current``, whose latest entry counts.  Publishing copies nothing, however large the marts;
a failed run leaves the pointer, and so the published marts, untouched.
Everything runs on the cluster; the driver only sees the check report (one
row per check), the load counters (one row) and the pointer.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordstats.functions.words import DEFAULT_LENGTH, letter_names
from wordstats.operators.difficulty import difficulty_by_pattern
from wordstats.operators.quality import CHECKS, RelationChecks, passes, quality_report
from wordstats.operators.scoring import top_predictions
from wordstats.operators.frequency import letter_table_from_counts
from wordstats.operators.lookup import materialise
from wordstats.plans.incremental import merged_difficulty_by_pattern, merged_letter_counts, update_counts
from wordstats.plans.load import begin_load, finish_load, insert_if_absent, read_table
from wordstats.plans.model import WordModel, model_from_staged
from wordstats.plans.ordered import order_columns, read_ordered, write_ordered
from wordstats.plans.tables import HISTORY_VIEW, ORDERED, publish_tables
from wordstats.operators.staging import stage_answers
from wordstats.sources.pages import read_pages

# In the order in which they are written: predictions come from the written scores.
MARTS = ("letter_frequency", "position_heatmap", "difficulty_by_pattern", "answer_history",
         "word_scores", "top_predictions")

# Read-side orderings of the published marts ("-" = descending).
MART_ORDER = {
    "top_predictions": ["rank"],
    "letter_frequency": ["-total_count", "letter"],
    "position_heatmap": ["position", "-position_count", "letter"],
    "difficulty_by_pattern": ["-avg_difficulty", "vowel_count", "unique_letter_count",
                              "difficulty_bucket"],
    "answer_history": ["-puzzle_number"],
    "word_scores": ["-total_score", "word"],
}


@dataclass
class RunConfig:
    table_path: str
    marts_path: str
    landing: str | None = None        # new pages to load first, if any
    load_id: int | None = None        # None: an id that no other run has
    today: str | None = "current"     # last date of an increment; None: no bound
    accept_late: bool = False
    n: int = DEFAULT_LENGTH
    top_k: int = 10
    # Where counts are kept from run to run: a run then reads new loads only
    # for the letter, position and difficulty marts.
    state_path: str | None = None
    # Where the load's refused rows are kept with their reasons, if anywhere.
    quarantine_path: str | None = None
    # A database in which the published marts are views (see plans.tables).
    database: str | None = None


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """The candidate seed: CSV with a header and one column ``word``."""
    return spark.read.schema("word STRING").option("header", True).csv(path)


POINTER = "_current"


def published_run(spark: SparkSession, marts_path: str) -> str:
    """The folder of the published run, the latest pointer (raises when
    nothing is published)."""
    latest = (spark.read.schema("run STRING, at LONG").json(f"{marts_path.rstrip('/')}/{POINTER}")
              .orderBy(F.desc("at"), F.desc("run")).first())
    if latest is None:
        raise ValueError(f"nothing is published under {marts_path}")
    return latest["run"]


def publish(spark: SparkSession, marts_path: str, run_folder: str) -> None:
    """Add a pointer to the run.  Nothing is replaced, so readers find the
    former run until the new pointer is complete."""
    (spark.range(1).select(F.lit(run_folder).alias("run"), F.lit(time.time_ns()).alias("at"))
     .coalesce(1).write.mode("append").json(f"{marts_path.rstrip('/')}/{POINTER}"))


def write_mart(df: DataFrame, folder: str, name: str) -> None:
    """Store a mart in a run's folder."""
    if name in ORDERED:
        write_ordered(df, f"{folder}/{name}", MART_ORDER[name])
    else:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def stored_mart(spark: SparkSession, folder: str, name: str, first: int | None = None) -> DataFrame:
    if name in ORDERED:
        return read_ordered(spark, f"{folder}/{name}", first)
    return spark.read.parquet(f"{folder}/{name}")


def read_mart(spark: SparkSession, marts_path: str, name: str, ordered: bool = True,
              first: int | None = None) -> DataFrame:
    """A published mart, or its ``first`` rows in the read order: of the
    marts that are stored in it, only the files that hold them are read."""
    df = stored_mart(spark, published_run(spark, marts_path), name, first)
    if name == "answer_history":
        df = df.select(*HISTORY_VIEW)
    if ordered or first is not None:
        df = df.orderBy(*order_columns(MART_ORDER[name]))
    return df if first is None else df.limit(first)


def build_marts(raw: DataFrame, candidates: DataFrame, n: int = DEFAULT_LENGTH,
                top_k: int = 10, state_path: str | None = None) -> dict[str, DataFrame]:
    """All marts over ``raw``.  With ``state_path`` the letter, position and
    difficulty marts come from the counts kept there."""
    staged = stage_answers(raw, n)
    if state_path is None:
        model = model_from_staged(staged, n)
        patterns = difficulty_by_pattern(staged)
    else:
        counts = merged_letter_counts(raw.sparkSession, state_path, n)
        model = WordModel(staged, materialise(letter_table_from_counts(counts, n)), n)
        patterns = merged_difficulty_by_pattern(raw.sparkSession, state_path)
    scores = model.word_scores(candidates)
    return {
        "staged_answers": staged,
        "difficulty_by_pattern": patterns,
        "letter_frequency": model.letter_frequency(),
        "position_heatmap": model.position_frequency(),
        "answer_history": model.answer_history(),
        "word_scores": scores,
        "top_predictions": top_predictions(scores, top_k, n),
    }


def checks_for(n: int) -> tuple[RelationChecks, ...]:
    """The declared checks, with the letter columns of words of length n."""
    letters = set(letter_names(5))
    return tuple(replace(c, not_null=(*[x for x in c.not_null if x not in letters], *letter_names(n)))
                 if letters & set(c.not_null) else c for c in CHECKS)


def run(spark: SparkSession, cfg: RunConfig, candidates: DataFrame) -> dict:
    """One run; returns {'load': counters or None, 'published': bool,
    'report': the check report DataFrame (on storage)}."""
    counts = None
    if cfg.landing:
        batch = read_pages(spark, cfg.landing)
        if cfg.load_id is None:     # other runs may load at the same time
            counts = finish_load(spark, begin_load(spark, cfg.table_path, batch, cfg.today, cfg.accept_late),
                                 cfg.quarantine_path)
        else:
            counts = insert_if_absent(spark, cfg.table_path, batch, cfg.load_id,
                                      cfg.today, cfg.accept_late,
                                      quarantine_path=cfg.quarantine_path).first().asDict()

    raw = read_table(spark, cfg.table_path).drop("loaded_at", "load_id")
    # A table without loads has no counts to keep.
    kept = cfg.state_path is not None and not raw.isEmpty()
    if kept:
        update_counts(spark, cfg.table_path, cfg.state_path, cfg.n)
    marts = build_marts(raw, candidates, cfg.n, cfg.top_k, cfg.state_path if kept else None)
    stage = f"{cfg.marts_path.rstrip('/')}/_runs/{uuid.uuid4().hex}"
    written: dict[str, DataFrame] = {}
    for name in MARTS:
        mart = (top_predictions(written["word_scores"], cfg.top_k, cfg.n)
                if name == "top_predictions" else marts[name])
        write_mart(mart, stage, name)
        written[name] = stored_mart(spark, stage, name)
    relations = {
        "raw_answers": raw,
        "staged_answers": marts["staged_answers"],
        "letter_frequency": written["letter_frequency"],
        "position_frequency": written["position_heatmap"],
        "difficulty_by_pattern": written["difficulty_by_pattern"],
        "letter_frequency_mart": written["letter_frequency"],
        "position_heatmap_mart": written["position_heatmap"],
        "answer_history": written["answer_history"],
        "word_scores": written["word_scores"],
        "top_predictions": written["top_predictions"],
    }
    report_path = f"{stage}/_quality_report"
    checks = checks_for(cfg.n)
    quality_report(relations, checks).write.mode("overwrite").parquet(report_path)
    report = spark.read.parquet(report_path)
    ok = passes(report, checks)
    if ok:
        publish(spark, cfg.marts_path, stage)
        if cfg.database:
            publish_tables(spark, stage, cfg.database, MARTS)
    return {"load": counts, "published": ok, "report": report, "run": stage}
