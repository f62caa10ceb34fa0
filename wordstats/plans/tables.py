"""The published marts as tables of Spark's catalog, for ``spark.sql``.

A run's marts become external tables over the run's folder, named after mart
and run, with the row count and column statistics that the optimiser reads
(one pass over the mart).  Under the mart's own name stands a view of the
latest run's table: replacing a view is one step, so a reader finds either
run's mart, whole.  Tables of earlier runs stay for readers that are still at
them; ``drop_old_tables`` takes them out of the catalog, and dropping an
external table removes no data.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Marts as large as the answers or the candidates are stored in their order.
ORDERED = ("answer_history", "word_scores")

# The columns of the history that readers see.
HISTORY_VIEW = ["puzzle_number", "answer", "answer_date", "day_name", "answer_year",
                "answer_month", "difficulty", "difficulty_bucket", "vowel_count",
                "unique_letter_count", "word_commonality_score"]

_MARK = "_run_"


def _table(name: str, run_folder: str) -> str:
    run = re.sub(r"\W", "_", run_folder.rstrip("/").rsplit("/", 1)[-1])
    return f"{name}{_MARK}{run}"


def publish_tables(spark: SparkSession, run_folder: str, database: str, names) -> None:
    """Tables of a run's marts, and the views that point to them."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name in names:
        table = f"`{database}`.`{_table(name, run_folder)}`"
        at = f"{run_folder.rstrip('/')}/{name}" + ("/rows" if name in ORDERED else "")
        # Schema (and partition column) as written.
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{at}'")
        if name in ORDERED:
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
        columns = HISTORY_VIEW if name == "answer_history" else [
            c for c in spark.table(table).columns if c not in ("_part", "_at")]
        listed = ", ".join(f"`{c}`" for c in columns)
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT {listed} FROM {table}")


def _tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{database}`").filter(~F.col("isTemporary")).select("tableName")


def mart_tables(spark: SparkSession, database: str) -> DataFrame:
    """(table_name, n_rows): the published marts, and the rows that the
    catalog's statistics give them.  One row per mart."""
    found = {}
    views = {r["viewName"] for r in spark.sql(f"SHOW VIEWS IN `{database}`").collect()}
    for view in sorted(views):
        under = spark.sql(f"SHOW CREATE TABLE `{database}`.`{view}`").first()[0]
        table = re.search(rf"\b{view}{_MARK}\w+", under)[0]
        described = spark.sql(f"DESCRIBE TABLE EXTENDED `{database}`.`{table}`").filter("col_name = 'Statistics'")
        found[view] = int(re.search(r"(\d+) rows", described.first()["data_type"])[1])
    return spark.createDataFrame(list(found.items()), "table_name string, n_rows long")


def drop_old_tables(spark: SparkSession, run_folder: str, names, database: str) -> list[str]:
    """Take the tables of other runs out of the catalog; their names."""
    current = {_table(name, run_folder) for name in names}
    old = [r["tableName"] for r in _tables(spark, database).collect()
           if _MARK in r["tableName"] and r["tableName"] not in current]
    for table in old:
        spark.sql(f"DROP TABLE `{database}`.`{table}`")
    return sorted(old)
