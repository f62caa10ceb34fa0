"""Word data derived from the test corpus tables.

The corpus holds no puzzles, so these projections stand in for the answer
table and the candidate list.  Each is a plain scan + projection (plus one
key-aligned join for the label flag), so the work grows linearly with the
corpus and no text is carried through a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordstats.functions.text import first_word_token, tokens, word_token_pattern, word_tokens
from wordstats.functions.words import DEFAULT_LENGTH

# The first puzzle date, and the label-derived difficulty rule
# difficulty = 1.0 + (n_chars mod 41) / 10.0 for labelled documents.
FIRST_DATE = "2021-06-19"
# Days from the first puzzle that a date can count (32-bit days from 1970): up
# to the year 5881580.  Past it dates start again every CALENDAR_DAYS days.
LAST_DAY = 2**31 - 2 - 18_797
CALENDAR_DAYS = 2_870_000
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
DIFFICULTY_MOD = 41
DIFFICULTY_BASE = 1.0
DIFFICULTY_STEP = 10.0

TEXT_TABLES = ("documents", "conversations", "benchmark")


# Declared schemas of the corpus tables read here (no inference job per read).
SCHEMAS = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    "benchmark": "item_id BIGINT, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def puzzle_date(day_offset):
    """The puzzle date ``day_offset`` days after the first puzzle, in the
    offsets' order up to ``LAST_DAY``, where the date type ends; dates of
    larger offsets start again."""
    held = day_offset.between(F.lit(-LAST_DAY), F.lit(LAST_DAY))
    days = F.when(held, day_offset).otherwise(day_offset % F.lit(CALENDAR_DAYS))
    return F.date_add(F.lit(FIRST_DATE).cast("date"), days.cast("int"))


def day_name(date):
    """The English name of the weekday (``date_format`` would go through a
    timestamp, which ends long before dates do)."""
    return F.get(F.array(*[F.lit(d) for d in DAY_NAMES]), F.weekday(date))


def date_text(date):
    """``date`` as yyyy-MM-dd, without the sign that Spark writes before
    years of five or more digits."""
    return F.ltrim(date.cast("string"), F.lit("+"))


def word_docs(spark: SparkSession, sf_dir: str, n: int = DEFAULT_LENGTH) -> DataFrame:
    """doc_id, n_chars, ``first`` (the first word token or null) and ``words``
    (the distinct upper-cased word tokens) of every document: what answers
    and candidates need of the texts, from one pass over them."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "n_chars", F.explode(F.array(word_tokens(F.col("text"), n))).alias("_toks"))
    return docs.select("doc_id", "n_chars", F.get("_toks", F.lit(0)).alias("first"),
                       F.array_distinct(F.transform("_toks", F.upper)).alias("words"))


def raw_answers(spark: SparkSession, sf_dir: str, n: int = DEFAULT_LENGTH,
                docs: DataFrame | None = None) -> DataFrame:
    """One raw answer row per document (of ``docs``, a stored ``word_docs``
    or some of the documents, where given).

    ``answer`` is the document's first word token padded with one space on
    each side (null when it has none); ``difficulty`` exists only for
    labelled documents.

    The label test is an IN-subquery in the projection: Spark plans it as an
    existence join (a row cannot fan out, whatever the label table holds),
    broadcast or shuffled by size, and drops it entirely from plans that
    never read ``difficulty``.

    The token comes out of a one-element ``explode``: as a generated column
    it is computed once, and filters on the answer (staging drops rows
    without one) stay above it instead of being pushed into the scan, where
    they would run the regular expression a second time.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id")
    if docs is None:
        docs = table(spark, sf_dir, "documents")
    first = F.col("first") if "first" in docs.columns else first_word_token(F.col("text"), n)
    joined = docs.select("doc_id", F.explode(F.array(first)).alias("_tok"),
                         "n_chars", F.col("doc_id").isin(labels).alias("_labelled"))
    date = puzzle_date(F.col("doc_id"))
    diff = (F.lit(DIFFICULTY_BASE)
            + (F.col("n_chars") % F.lit(DIFFICULTY_MOD)).cast("double") / F.lit(DIFFICULTY_STEP))
    return joined.select(
        F.col("doc_id").cast("long").alias("puzzle_number"),
        F.when(F.col("_tok").isNotNull(),
               F.concat(F.lit(" "), F.col("_tok"), F.lit(" "))).alias("answer"),
        date.alias("date"),
        day_name(date).alias("day_name"),
        F.when(F.col("_labelled"), diff.cast("float")).alias("difficulty"),
    )


def text_word_tokens(spark: SparkSession, sf_dir: str, name: str,
                     n: int = DEFAULT_LENGTH) -> DataFrame:
    """Every word token of table ``name`` (column ``token``), one row each."""
    return (table(spark, sf_dir, name)
            .select(F.explode(word_tokens(F.col("text"), n)).alias("token")))


def latest_documents(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """The documents from the k-th largest id on (and those without an id),
    found in the id column alone; the bound reaches the scan as a filter."""
    docs = table(spark, sf_dir, "documents")
    bound = (docs.select("doc_id").orderBy(F.desc_nulls_last("doc_id")).limit(k)
             .agg(F.min("doc_id")).scalar())
    return docs.filter((F.col("doc_id") >= bound) | F.col("doc_id").isNull())


def candidate_words(spark: SparkSession, sf_dir: str, n: int = DEFAULT_LENGTH,
                    docs: DataFrame | None = None) -> DataFrame:
    """Distinct upper-cased word tokens of all text tables (column ``word``);
    those of the documents from a stored ``word_docs`` where given.

    The dedup aggregates map-side first, so each task ships at most its own
    distinct words; the shuffle is bounded by the vocabulary, not the text.
    """
    parts = [docs.select(F.explode("words").alias("token")) if docs is not None and t == "documents"
             else text_word_tokens(spark, sf_dir, t, n) for t in TEXT_TABLES]
    allt = parts[0]
    for p in parts[1:]:
        allt = allt.unionByName(p)
    return allt.select(F.upper("token").alias("word")).distinct()


def corpus_tokens(spark: SparkSession, sf_dir: str, n: int = DEFAULT_LENGTH) -> DataFrame:
    """Every word token of ``documents`` with its document, 1-based token position and language."""
    # Filtered inside the array: other tokens never become rows.
    numbered = F.transform(tokens(F.col("text")), lambda t, i: F.struct(
        (i + 1).cast("long").alias("pos"), t.alias("token")))
    words = F.filter(numbered, lambda x: x["token"].rlike(word_token_pattern(n)))
    return (table(spark, sf_dir, "documents").select("doc_id", "lang", F.inline(words))
            .select("doc_id", "pos", "lang", "token"))


def corpus_words(spark: SparkSession, sf_dir: str, n: int = DEFAULT_LENGTH) -> DataFrame:
    """Every word token of ``documents`` upper-cased, as staged-like rows (``answer``).

    Positions are not needed for frequencies, so tokens are filtered inside
    the array before the explode and non-words never become rows.
    """
    return (table(spark, sf_dir, "documents")
            .select(F.explode(word_tokens(F.col("text"), n)).alias("token"))
            .select(F.upper("token").alias("answer")))


# Fixed values for the load fixture: the stored table holds the first 70%
# of ids; the last 10 days are after "today"; arrival pages hold 200 ids.
LOAD_CUT_NUM, LOAD_CUT_DEN = 7, 10
FUTURE_DAYS = 10
PAGE_IDS = 200
# Which ids get extra copies in the batch (all rows are kept either way):
INVALID_FIRST_EVERY = 5   # a null-answer copy arrives just before the row
REPEAT_EVERY = 7          # the row arrives again on the next page
LATE_EVERY = 11           # a stored row is sent again (late row)
NULL_ID_EVERY = 13        # a copy without an id


def window_end(last_id):
    """The load fixture's "today".  Where the last id has no date of its own,
    dates don't follow the ids, so that a fetch window over them would lose
    rows: the load fails instead."""
    past = F.concat(F.lit("no fetch window: dates end before id "), last_id.cast("string"))
    return F.when(last_id > F.lit(LAST_DAY), F.raise_error(past).cast("date")).otherwise(
        puzzle_date(last_id - F.lit(FUTURE_DAYS)))


def load_fixture(spark: SparkSession, sf_dir: str, full: bool = False,
                 n: int = DEFAULT_LENGTH,
                 raw: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(table, batch) for the incremental load, derived from ``raw_answers``.

    ``table``: rows with id <= cut and an answer, as stored (upper, stripped).
    ``batch``: page, pos, game, answer, date (text), day_name, difficulty,
    _today -- every row after the cut plus the copies described above.
    With ``full`` the table is empty and every row is in the batch.

    Each raw row yields all of its batch copies in one ``explode``, so the
    batch is one scan of the corpus, not one per kind of copy.  ``raw`` may
    be a stored copy of ``raw_answers`` when the caller reads it repeatedly.
    """
    if raw is None:
        raw = raw_answers(spark, sf_dir, n)
    # The id range comes from the id column alone (no text is read for it),
    # as scalar subqueries computed once.
    ids = table(spark, sf_dir, "documents").agg(F.max("doc_id").cast("long").alias("_max"))
    cut = (F.lit(-1).cast("long") if full else ids.select(
        F.floor(F.col("_max") * F.lit(LOAD_CUT_NUM) / F.lit(LOAD_CUT_DEN)).cast("long")).scalar())
    today = ids.select(window_end(F.col("_max"))).scalar()
    pid = F.col("puzzle_number")
    # Each scalar is referenced once; later expressions read the columns.
    bounded = raw.select("*", (pid <= cut).alias("_stored"), today.alias("_today"))
    stored = F.col("_stored")
    later = ~stored
    table_rows = (bounded.filter(stored & F.col("answer").isNotNull())
                  .select("puzzle_number", F.upper(F.trim("answer")).alias("answer"), "date",
                          "day_name", "difficulty"))

    slot = pid % F.lit(PAGE_IDS)
    page = F.floor(pid / F.lit(PAGE_IDS)).cast("long")
    answer = F.col("answer")
    no_answer = F.lit(None).cast("string")

    def copy(cond, page_col, k, game, ans):
        return F.when(cond, F.struct(page_col.alias("page"),
                                     (slot * F.lit(4) + F.lit(k)).cast("long").alias("pos"),
                                     game.alias("game"), ans.alias("answer")))

    every = lambda k: pid % F.lit(k) == F.lit(0)
    variants = F.array(
        copy(later, page, 1, pid, answer),
        copy(later & every(INVALID_FIRST_EVERY) & answer.isNotNull(), page, 0, pid, no_answer),
        copy(later & every(REPEAT_EVERY), page + F.lit(1), 2, pid, answer),
        copy(stored & every(LATE_EVERY), page, 3, pid, answer),
        copy(later & every(NULL_ID_EVERY), page, 3, F.lit(None).cast("long"), answer),
    )
    batch = (bounded.select(F.explode(variants).alias("_v"), "date", "day_name",
                            "difficulty", "_today")
             .filter(F.col("_v").isNotNull())
             .select("_v.page", "_v.pos", "_v.game", "_v.answer",
                     date_text(F.col("date")).alias("date"), "day_name",
                     "difficulty", "_today"))
    return table_rows, batch
