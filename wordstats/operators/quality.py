"""Declared data-quality checks and the publish gate.

A check passes when it finds nothing:

* ``not_null``  -- failures = rows where the column is null;
* ``unique``    -- failures = distinct non-null values seen more than once;
* ``no_duplicate_answers`` -- failures = (puzzle_number, answer) pairs
  stored more than once.

Every declared check has a number.  A relation is read once: a row emits
``(check, value)`` for each unique check (integral and date values as longs,
other values as text) and, for a null check, only where the column is null,
so clean rows move nothing for their null checks.  What all relations emit
is counted in one aggregation, and a small second aggregation per check
yields its failures.
The report has one row per declared check: relation, check_name,
column_name, failures (0 for a relation with no rows).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordstats.functions.words import letter_names

REPORT_COLUMNS = ["relation", "check_name", "column_name", "failures"]


@dataclass(frozen=True)
class RelationChecks:
    relation: str
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    no_duplicate_answers: bool = False


# The declared checks per relation (39 not-null, 10 unique,
# 1 custom).
CHECKS: tuple[RelationChecks, ...] = (
    RelationChecks("raw_answers", ("puzzle_number", "answer", "date"), ("puzzle_number", "date")),
    RelationChecks("staged_answers",
                   ("puzzle_number", "answer", "answer_date", *letter_names(5)),
                   ("puzzle_number", "answer_date"), no_duplicate_answers=True),
    RelationChecks("letter_frequency",
                   ("letter", "total_count", "frequency_pct", "frequency_rank"), ("letter",)),
    RelationChecks("position_frequency", ("position", "letter", "position_count", "position_pct")),
    RelationChecks("difficulty_by_pattern",
                   ("vowel_count", "unique_letter_count", "difficulty_bucket")),
    RelationChecks("letter_frequency_mart",
                   ("letter", "total_count", "frequency_pct", "frequency_rank"), ("letter",)),
    RelationChecks("position_heatmap_mart",
                   ("position", "letter", "position_count", "position_pct")),
    RelationChecks("answer_history", ("puzzle_number", "answer", "answer_date"),
                   ("puzzle_number",)),
    RelationChecks("word_scores", ("word", "total_score", "already_used"), ("word",)),
    RelationChecks("top_predictions", ("rank", "word", "total_score"), ("rank", "word")),
)


DUPLICATE_PAIR = "puzzle_number,answer"


_AS_NUMBER = ("tinyint", "smallint", "int", "bigint", "date")


def _declared(checks: tuple[RelationChecks, ...]) -> list[tuple[str, str, str]]:
    """(relation, check_name, column_name) of every declared check; a check's
    number is its place in this list."""
    rows = []
    for spec in checks:
        rows += [(spec.relation, "not_null", c) for c in spec.not_null]
        rows += [(spec.relation, "unique", c) for c in spec.unique]
        if spec.no_duplicate_answers:
            rows.append((spec.relation, "no_duplicate_answers", DUPLICATE_PAIR))
    return rows


def _emitted(df: DataFrame, relation: str, declared: list[tuple[str, str, str]]) -> DataFrame:
    """(_id, _k, _s): what the relation's rows emit for their checks, the
    value in ``_k`` (as a long) or ``_s`` (as text)."""
    types = dict(df.dtypes)
    none = F.lit(None)

    def item(number, k, s):
        return F.struct(F.lit(number).alias("_id"), k.cast("long").alias("_k"),
                        s.cast("string").alias("_s"))

    cases = []
    for number, (of, check, name) in enumerate(declared):
        if of != relation:
            continue
        if check == "not_null":
            cases.append(F.when(F.col(name).isNull(), item(number, none, none)))
        elif check == "no_duplicate_answers":
            cases.append(item(number, F.col("puzzle_number"), F.col("answer")))
        else:
            col = F.col(name)
            value = (item(number, F.unix_date(col), none) if types[name] == "date"
                     else item(number, col, none) if types[name] in _AS_NUMBER
                     else item(number, none, col))
            cases.append(F.when(col.isNotNull(), value))
    return df.select(F.inline(F.array_compact(F.array(*cases))))


def quality_report(relations: dict[str, DataFrame],
                   checks: tuple[RelationChecks, ...] = CHECKS) -> DataFrame:
    """Run every check whose relation is given; one row per check.

    All relations feed one aggregation keyed by (check, value) -- a single
    shuffle for every check, with map-side partial aggregation so a hot
    value or a column of nulls collapses before it moves -- and one small
    aggregation per check turns the counts into failures.
    """
    declared = _declared(tuple(c for c in checks if c.relation in relations))
    rows = reduce(lambda a, b: a.unionByName(b),
                  [_emitted(relations[r], r, declared) for r in dict.fromkeys(d[0] for d in declared)])
    counted = rows.groupBy("_id", "_k", "_s").agg(F.count(F.lit(1)).alias("_n"))
    per_check = counted.groupBy("_id").agg(
        F.sum("_n").alias("_rows"), F.count(F.when(F.col("_n") > F.lit(1), F.lit(1))).alias("_dups"))
    spark = next(iter(relations.values())).sparkSession
    spec = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("number"), F.lit(r).alias("relation"), F.lit(k).alias("check_name"),
                 F.lit(c).alias("column_name")) for i, (r, k, c) in enumerate(declared)])))
    # One row per declared check: bounded.
    joined = spec.join(F.broadcast(per_check), F.col("number") == F.col("_id"), "left")
    failures = F.when(F.col("check_name") == F.lit("not_null"), F.col("_rows")) \
        .otherwise(F.col("_dups"))
    return joined.select("relation", "check_name", "column_name",
                         F.coalesce(failures, F.lit(0)).cast("long").alias("failures"))


def passes(report: DataFrame, checks: tuple[RelationChecks, ...] = ()) -> bool:
    """The publish gate: true when no check found anything and every check
    that ``checks`` declares is in the report (one or two small actions)."""
    if not report.filter(F.col("failures") > F.lit(0)).isEmpty():
        return False
    declared = _declared(checks)
    if not declared:
        return True
    reported = report.select("relation", "check_name", "column_name").distinct()
    # One row per declared check: bounded.
    return set(declared) <= {tuple(r) for r in reported.collect()}
