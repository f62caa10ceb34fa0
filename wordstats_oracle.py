"""Independent DuckDB SQL for every query in ``wordstats.plans.catalog``.

DuckDB's own ``round``; never generated from the Spark side.  The corpus
tables are views named after the Parquet files.
"""

from __future__ import annotations

# Raw answers: one row per document; first five-ASCII-letter token padded
# with spaces; difficulty only for labelled documents.
RAW = r"""
doc_first AS (
    SELECT doc_id, n_chars,
           list_filter(string_split_regex(text, '[ \n\t]+'),
                       lambda t: regexp_full_match(t, '[A-Za-z]{5}'))[1] AS tok
    FROM documents
),
raw_answers AS (
    SELECT doc_id AS puzzle_number,
           ' ' || tok || ' ' AS answer,
           DATE '2021-06-19' + CAST(doc_id AS INTEGER) AS date,
           dayname(DATE '2021-06-19' + CAST(doc_id AS INTEGER)) AS day_name,
           CASE WHEN doc_id IN (SELECT doc_id FROM labels)
                THEN CAST(1.0 + CAST(n_chars % 41 AS DOUBLE) / 10.0 AS FLOAT) END AS difficulty
    FROM doc_first
)"""

STAGED = RAW + r""",
clean AS (
    SELECT CAST(puzzle_number AS BIGINT) AS puzzle_number, upper(trim(answer)) AS w,
           CAST(date AS DATE) AS answer_date, day_name, difficulty
    FROM raw_answers
    WHERE answer IS NOT NULL AND length(trim(answer)) = 5
),
split AS (
    SELECT *, [substr(w, 1, 1), substr(w, 2, 1), substr(w, 3, 1),
               substr(w, 4, 1), substr(w, 5, 1)] AS ls
    FROM clean
),
staged AS (
    SELECT puzzle_number, w AS answer,
           ls[1] AS letter_1, ls[2] AS letter_2, ls[3] AS letter_3, ls[4] AS letter_4,
           ls[5] AS letter_5,
           answer_date, day_name,
           year(answer_date) AS answer_year,
           month(answer_date) AS answer_month,
           difficulty,
           CASE WHEN difficulty IS NULL OR difficulty < 3.0 THEN 'easy'
                WHEN difficulty < 4.0 THEN 'medium' ELSE 'hard' END AS difficulty_bucket,
           CAST(len(list_filter(ls, lambda x: x IN ('A', 'E', 'I', 'O', 'U'))) AS INTEGER)
               AS vowel_count,
           -- letters whose value occurs exactly once in the word
           CAST(len(list_filter(ls, lambda x: len(list_filter(ls, lambda y: y = x)) = 1))
                AS INTEGER) AS unique_letter_count
    FROM split
)"""

FREQ_PART = r""",
unpivoted AS (
    SELECT CAST(unnest(generate_series(1, 5)) AS INTEGER) AS position,
           unnest([letter_1, letter_2, letter_3, letter_4, letter_5]) AS letter
    FROM staged
),
letter_counts AS (
    SELECT letter, count(*) AS total_count FROM unpivoted GROUP BY letter
),
letter_freq AS (
    SELECT letter, total_count,
           round(total_count * 100.0 / (SELECT sum(total_count) FROM letter_counts), 4)
               AS frequency_pct,
           1 + (SELECT count(*) FROM letter_counts o WHERE o.total_count > c.total_count)
               AS frequency_rank
    FROM letter_counts c
),
position_freq AS (
    SELECT position, letter, count(*) AS position_count,
           round(count(*) * 100.0 / (SELECT count(*) FROM staged), 4) AS position_pct
    FROM unpivoted
    GROUP BY position, letter
)"""

LETTER_FREQ = STAGED + FREQ_PART

CANDIDATES = r""",
all_text AS (
    SELECT text FROM documents
    UNION ALL SELECT text FROM conversations
    UNION ALL SELECT text FROM benchmark
),
all_tokens AS (
    SELECT unnest(string_split_regex(text, '[ \n\t]+')) AS tok FROM all_text
),
candidates AS (
    SELECT DISTINCT upper(tok) AS word FROM all_tokens
    WHERE regexp_full_match(tok, '[A-Za-z]{5}')
)"""

SCORE_PART = CANDIDATES + r""",
cand_letters AS (
    SELECT upper(word) AS word,
           substr(upper(word), 1, 1) AS letter_1, substr(upper(word), 2, 1) AS letter_2,
           substr(upper(word), 3, 1) AS letter_3, substr(upper(word), 4, 1) AS letter_4,
           substr(upper(word), 5, 1) AS letter_5
    FROM candidates
),
per_position AS (
    SELECT c.word, c.letter_1, c.letter_2, c.letter_3, c.letter_4, c.letter_5,
        round(coalesce((SELECT frequency_pct FROM letter_freq f WHERE f.letter = c.letter_1), 0)
            + coalesce((SELECT position_pct FROM position_freq q WHERE q.position = 1 AND q.letter = c.letter_1), 0), 4) AS pos1_score,
        round(coalesce((SELECT frequency_pct FROM letter_freq f WHERE f.letter = c.letter_2), 0)
            + coalesce((SELECT position_pct FROM position_freq q WHERE q.position = 2 AND q.letter = c.letter_2), 0), 4) AS pos2_score,
        round(coalesce((SELECT frequency_pct FROM letter_freq f WHERE f.letter = c.letter_3), 0)
            + coalesce((SELECT position_pct FROM position_freq q WHERE q.position = 3 AND q.letter = c.letter_3), 0), 4) AS pos3_score,
        round(coalesce((SELECT frequency_pct FROM letter_freq f WHERE f.letter = c.letter_4), 0)
            + coalesce((SELECT position_pct FROM position_freq q WHERE q.position = 4 AND q.letter = c.letter_4), 0), 4) AS pos4_score,
        round(coalesce((SELECT frequency_pct FROM letter_freq f WHERE f.letter = c.letter_5), 0)
            + coalesce((SELECT position_pct FROM position_freq q WHERE q.position = 5 AND q.letter = c.letter_5), 0), 4) AS pos5_score,
        coalesce(c.word IN (SELECT answer FROM staged), false) AS already_used
    FROM cand_letters c
),
word_scores AS (
    SELECT word, letter_1, letter_2, letter_3, letter_4, letter_5,
           round(pos1_score + pos2_score + pos3_score + pos4_score + pos5_score, 4) AS total_score,
           pos1_score, pos2_score, pos3_score, pos4_score, pos5_score, already_used
    FROM per_position
),
top_predictions AS (
    SELECT * FROM (
        SELECT row_number() OVER (ORDER BY total_score DESC, word ASC NULLS LAST) AS rank,
               word, letter_1, letter_2, letter_3, letter_4, letter_5, total_score,
               pos1_score, pos2_score, pos3_score, pos4_score, pos5_score
        FROM word_scores WHERE NOT already_used
    ) WHERE rank <= 10
)"""

SCORES = LETTER_FREQ + SCORE_PART

HISTORY_PART = r""",
history_lookup AS (
    SELECT s.*,
           coalesce((SELECT frequency_pct FROM letter_freq f WHERE f.letter = s.letter_1), 0)
               AS letter_1_freq_pct,
           coalesce((SELECT frequency_pct FROM letter_freq f WHERE f.letter = s.letter_2), 0)
               AS letter_2_freq_pct,
           coalesce((SELECT frequency_pct FROM letter_freq f WHERE f.letter = s.letter_3), 0)
               AS letter_3_freq_pct,
           coalesce((SELECT frequency_pct FROM letter_freq f WHERE f.letter = s.letter_4), 0)
               AS letter_4_freq_pct,
           coalesce((SELECT frequency_pct FROM letter_freq f WHERE f.letter = s.letter_5), 0)
               AS letter_5_freq_pct
    FROM staged s
),
answer_history AS (
    SELECT *,
           round(letter_1_freq_pct + letter_2_freq_pct + letter_3_freq_pct
                 + letter_4_freq_pct + letter_5_freq_pct, 4) AS word_commonality_score
    FROM history_lookup
)"""
HISTORY = LETTER_FREQ + HISTORY_PART

PATTERN_PART = r""",
pattern_stats AS (
    SELECT vowel_count, unique_letter_count, difficulty_bucket,
           count(*) AS n, avg(difficulty) AS mean_d, min(difficulty) AS lo, max(difficulty) AS hi
    FROM staged WHERE difficulty IS NOT NULL
    GROUP BY ALL
),
difficulty_by_pattern AS (
    SELECT vowel_count, unique_letter_count, difficulty_bucket, n AS word_count,
           round(mean_d, 2) AS avg_difficulty, round(lo, 2) AS min_difficulty,
           round(hi, 2) AS max_difficulty
    FROM pattern_stats
)"""

EVERYTHING = SCORES + HISTORY_PART + PATTERN_PART


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


ORACLE: dict[str, str] = {
    "stage_answers": _with(STAGED, "SELECT * FROM staged"),
    "letter_frequency": _with(LETTER_FREQ, "SELECT * FROM letter_freq"),
    "position_frequency": _with(LETTER_FREQ, "SELECT * FROM position_freq"),
    "difficulty_by_pattern": _with(STAGED + PATTERN_PART, "SELECT * FROM difficulty_by_pattern"),
    "answer_history": _with(HISTORY, "SELECT * FROM answer_history"),
    "word_scores": _with(SCORES, "SELECT * FROM word_scores"),
    "top_predictions": _with(SCORES, "SELECT * FROM top_predictions"),
}

ORACLE.update({
    "kpi_row": _with(STAGED, """
SELECT count(*) AS total_puzzles, max(puzzle_number) AS latest_puzzle,
       avg(difficulty) AS avg_difficulty, avg(vowel_count) AS avg_vowels
FROM staged"""),
    "prediction_bars": _with(SCORES, """
SELECT rank, word, total_score,
       CASE WHEN max(total_score) OVER () > 0
            THEN total_score / max(total_score) OVER () * 100.0 ELSE 0.0 END AS score_pct
FROM top_predictions"""),
    "winner_breakdown": _with(SCORES, """
SELECT p.position, p.letter, p.score, 'Pos ' || p.position || ' (' || p.letter || ')' AS label
FROM top_predictions t,
     LATERAL (VALUES (1, t.letter_1, t.pos1_score), (2, t.letter_2, t.pos2_score),
                     (3, t.letter_3, t.pos3_score), (4, t.letter_4, t.pos4_score),
                     (5, t.letter_5, t.pos5_score)) AS p(position, letter, score)
WHERE t.rank = 1"""),
    "top_letters": _with(LETTER_FREQ, """
SELECT letter, total_count, frequency_pct, frequency_rank,
       CAST(trunc(frequency_pct * 2) AS INTEGER) AS bar_len,
       repeat('█', CAST(trunc(frequency_pct * 2) AS INTEGER)) AS bar,
       least(CAST(trunc(frequency_pct * 2) AS INTEGER) * 5, 100) AS bar_width
FROM letter_freq ORDER BY total_count DESC, letter LIMIT 10"""),
    "position_heatmap": _with(LETTER_FREQ, """
SELECT letter,
       coalesce(avg(position_pct) FILTER (WHERE position = 1), 0) AS position_1,
       coalesce(avg(position_pct) FILTER (WHERE position = 2), 0) AS position_2,
       coalesce(avg(position_pct) FILTER (WHERE position = 3), 0) AS position_3,
       coalesce(avg(position_pct) FILTER (WHERE position = 4), 0) AS position_4,
       coalesce(avg(position_pct) FILTER (WHERE position = 5), 0) AS position_5
FROM position_freq GROUP BY letter"""),
    "strongest_letter": _with(LETTER_FREQ, """
SELECT position, letter, position_pct FROM (
    SELECT *, row_number() OVER (PARTITION BY position ORDER BY position_pct DESC, letter) AS rn
    FROM position_freq) WHERE rn = 1"""),
    "difficulty_trend": _with(STAGED, """
SELECT puzzle_number, difficulty,
       avg(difficulty) OVER (ORDER BY puzzle_number ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
           AS rolling_avg
FROM staged WHERE difficulty IS NOT NULL"""),
    "difficulty_distribution": _with(STAGED, """
SELECT difficulty_bucket, count(*) AS puzzles,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS share_pct
FROM staged GROUP BY difficulty_bucket"""),
    "vowel_distribution": _with(STAGED, """
SELECT vowel_count, count(*) AS puzzles,
       vowel_count || ' vowel' || CASE WHEN vowel_count = 1 THEN '' ELSE 's' END AS label
FROM staged GROUP BY vowel_count"""),
    "recent_answers": _with(STAGED, """
SELECT puzzle_number, answer, answer_date, day_name, difficulty, difficulty_bucket,
       vowel_count, unique_letter_count
FROM staged ORDER BY puzzle_number DESC LIMIT 20"""),
    "latest_raw_rows": _with(RAW, """
SELECT puzzle_number, answer, date, day_name, difficulty
FROM raw_answers ORDER BY puzzle_number DESC LIMIT 5"""),
    "raw_duplicates": _with(RAW, """
SELECT puzzle_number, answer, count(*) AS times_used
FROM raw_answers GROUP BY puzzle_number, answer HAVING count(*) > 1"""),
    "staged_duplicates": _with(STAGED, """
SELECT puzzle_number, answer, count(*) AS times_used
FROM staged GROUP BY puzzle_number, answer HAVING count(*) > 1"""),
    "word_repeat_check": _with(STAGED, """
SELECT answer, count(*) AS times_used FROM staged GROUP BY answer HAVING count(*) > 1"""),
})


# Relation name in the report -> CTE holding it.
_RELATION_CTE = {
    "raw_answers": "raw_answers", "staged_answers": "staged",
    "letter_frequency": "letter_freq", "position_frequency": "position_freq",
    "difficulty_by_pattern": "difficulty_by_pattern",
    "letter_frequency_mart": "letter_freq", "position_heatmap_mart": "position_freq",
    "answer_history": "answer_history", "word_scores": "word_scores",
    "top_predictions": "top_predictions",
}


# The 50 checks, written out here on their own: (relation, not-null columns, unique columns).
_CHECKED = [
    ("raw_answers", "puzzle_number answer date", "puzzle_number date"),
    ("staged_answers", "puzzle_number answer answer_date letter_1 letter_2 letter_3 letter_4 letter_5",
     "puzzle_number answer_date"),
    ("letter_frequency", "letter total_count frequency_pct frequency_rank", "letter"),
    ("position_frequency", "position letter position_count position_pct", ""),
    ("difficulty_by_pattern", "vowel_count unique_letter_count difficulty_bucket", ""),
    ("letter_frequency_mart", "letter total_count frequency_pct frequency_rank", "letter"),
    ("position_heatmap_mart", "position letter position_count position_pct", ""),
    ("answer_history", "puzzle_number answer answer_date", "puzzle_number"),
    ("word_scores", "word total_score already_used", "word"),
    ("top_predictions", "rank word total_score", "rank word"),
]


def _quality_sql() -> str:
    parts = ["SELECT 'staged_answers' AS relation, 'no_duplicate_answers' AS check_name, "
             "'puzzle_number,answer' AS column_name, (SELECT count(*) FROM (SELECT 1 FROM staged "
             "GROUP BY puzzle_number, answer HAVING count(*) > 1)) AS failures"]
    for relation, not_null, unique in _CHECKED:
        cte = _RELATION_CTE[relation]
        parts += [f"SELECT '{relation}', 'not_null', '{c}', count(*) FILTER (WHERE {c} IS NULL) FROM {cte}"
                  for c in not_null.split()]
        parts += [f"SELECT '{relation}', 'unique', '{c}', (SELECT count(*) FROM (SELECT {c} FROM {cte} "
                  f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))" for c in unique.split()]
    return _with(EVERYTHING, "\nUNION ALL\n".join(parts))


ORACLE["quality_report"] = _quality_sql()


def _load_ctes(full: bool = False, accept_late: bool = False) -> str:
    """The load fixture and its labels: a row is skipped when its id is
    stored or an earlier valid row of the batch has it, failed when invalid,
    else inserted."""
    cut = "-1" if full else "CAST(floor(max(doc_id) * 7 / 10) AS BIGINT)"
    window = []
    if not (full or accept_late):
        window.append("(h.hwm IS NULL OR TRY_CAST(bt.date AS DATE) > h.hwm)")
    if not full:
        window.append("TRY_CAST(bt.date AS DATE) <= b.today")
    fetch = " AND ".join(window) if window else "TRUE"
    return RAW + rf""",
bounds AS (
    SELECT {cut} AS cut_id,
           DATE '2021-06-19' + CAST(max(doc_id) - 10 AS INTEGER) AS today
    FROM documents
),
stored AS (
    SELECT r.puzzle_number, upper(trim(r.answer)) AS answer, r.date, r.day_name, r.difficulty
    FROM raw_answers r, bounds b WHERE r.puzzle_number <= b.cut_id AND r.answer IS NOT NULL
),
src AS (
    SELECT r.*, r.puzzle_number // 200 AS pg, (r.puzzle_number % 200) * 4 AS slot,
           r.puzzle_number > b.cut_id AS later
    FROM raw_answers r, bounds b
),
batch AS (
    SELECT pg AS page, slot + 1 AS pos, puzzle_number AS game, answer, date, day_name, difficulty
    FROM src WHERE later
    UNION ALL
    SELECT pg, slot, puzzle_number, NULL, date, day_name, difficulty
    FROM src WHERE later AND puzzle_number % 5 = 0 AND answer IS NOT NULL
    UNION ALL
    SELECT pg + 1, slot + 2, puzzle_number, answer, date, day_name, difficulty
    FROM src WHERE later AND puzzle_number % 7 = 0
    UNION ALL
    SELECT pg, slot + 3, puzzle_number, answer, date, day_name, difficulty
    FROM src WHERE NOT later AND puzzle_number % 11 = 0
    UNION ALL
    SELECT pg, slot + 3, NULL, answer, date, day_name, difficulty
    FROM src WHERE later AND puzzle_number % 13 = 0
),
hwm AS (SELECT max(date) AS hwm FROM stored),
fetched AS (
    SELECT bt.*, TRY_CAST(strftime(bt.date, '%Y-%m-%d') AS DATE) AS d
    FROM batch bt, hwm h, bounds b
    WHERE TRY_CAST(bt.date AS DATE) IS NULL OR ({fetch})
),
marked AS (
    SELECT *, (game IS NOT NULL AND answer IS NOT NULL AND d IS NOT NULL) AS valid,
           coalesce(game IN (SELECT puzzle_number FROM stored), false) AS known
    FROM fetched
),
labelled AS (
    SELECT page, pos, game AS puzzle_number, answer, d, day_name, difficulty,
           CASE WHEN known THEN 'skipped'
                WHEN coalesce(sum(CASE WHEN valid THEN 1 ELSE 0 END) OVER (
                         PARTITION BY game ORDER BY page, pos
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0 THEN 'skipped'
                WHEN NOT valid THEN 'failed'
                ELSE 'inserted' END AS label
    FROM marked
),
load_counts AS (
    SELECT count(*) FILTER (WHERE label = 'inserted') AS inserted,
           count(*) FILTER (WHERE label = 'skipped') AS skipped,
           count(*) FILTER (WHERE label = 'failed') AS failed
    FROM labelled
),
after_load AS (
    SELECT puzzle_number, answer, date, day_name, difficulty FROM stored
    UNION ALL
    SELECT puzzle_number, upper(trim(answer)), d, day_name, difficulty
    FROM labelled WHERE label = 'inserted'
)"""


ORACLE.update({
    "ingest_labels": _with(_load_ctes(), "SELECT page, pos, puzzle_number, label FROM labelled"),
    "ingest_counts": _with(_load_ctes(), "SELECT * FROM load_counts"),
    "ingest_counts_accept_late": _with(_load_ctes(accept_late=True),
                                       "SELECT * FROM load_counts"),
    "ingest_incremental": _with(_load_ctes(), "SELECT * FROM after_load"),
    "ingest_full": _with(_load_ctes(full=True), "SELECT * FROM after_load"),
    "stream_ingest": _with(_load_ctes(), "SELECT * FROM after_load"),
})

CORPUS = r"""
doc_tokens AS (
    SELECT doc_id, lang, t.tok, t.pos
    FROM documents,
         LATERAL (SELECT unnest(string_split_regex(text, '[ \n\t]+')) AS tok,
                         generate_subscripts(string_split_regex(text, '[ \n\t]+'), 1) AS pos) t
),
corpus_tokens AS (
    SELECT doc_id, CAST(pos AS BIGINT) AS pos, lang, tok AS token
    FROM doc_tokens WHERE regexp_full_match(tok, '[A-Za-z]{5}')
),
corpus_letters AS (
    SELECT p.pos AS position, p.letter
    FROM (SELECT upper(token) AS w FROM corpus_tokens) c,
         LATERAL (VALUES (1, substr(w, 1, 1)), (2, substr(w, 2, 1)), (3, substr(w, 3, 1)),
                         (4, substr(w, 4, 1)), (5, substr(w, 5, 1))) AS p(pos, letter)
)"""

ORACLE.update({
    "corpus_tokens": _with(CORPUS, "SELECT * FROM corpus_tokens"),
    "corpus_letter_frequency": _with(CORPUS + r""",
corpus_counts AS (SELECT letter, count(*) AS total_count FROM corpus_letters GROUP BY letter)""",
                                     """
SELECT letter, total_count,
       round(total_count * 100.0 / (SELECT sum(total_count) FROM corpus_counts), 4)
           AS frequency_pct,
       1 + (SELECT count(*) FROM corpus_counts o WHERE o.total_count > c.total_count)
           AS frequency_rank
FROM corpus_counts c"""),
    "corpus_position_frequency": _with(CORPUS, """
SELECT position, letter, count(*) AS position_count,
       round(count(*) * 100.0 / (SELECT count(*) FROM corpus_tokens), 4) AS position_pct
FROM corpus_letters GROUP BY position, letter"""),
})

ORACLE.update({
    "letter_frequency_mart": _with(LETTER_FREQ, "SELECT * FROM letter_freq"),
    "position_heatmap_mart": _with(LETTER_FREQ, "SELECT * FROM position_freq"),
})

ORACLE["corpus_letter_frequency_by_lang"] = _with(CORPUS + r""",
lang_letters AS (
    SELECT c.lang, p.letter
    FROM (SELECT lang, upper(token) AS w FROM corpus_tokens) c,
         LATERAL (VALUES (substr(w, 1, 1)), (substr(w, 2, 1)), (substr(w, 3, 1)),
                         (substr(w, 4, 1)), (substr(w, 5, 1))) AS p(letter)
),
lang_counts AS (
    SELECT lang, letter, count(*) AS total_count FROM lang_letters GROUP BY lang, letter
)""", """
SELECT lang, letter, total_count,
       round(total_count * 100.0 / sum(total_count) OVER (PARTITION BY lang), 4) AS frequency_pct,
       rank() OVER (PARTITION BY lang ORDER BY total_count DESC) AS frequency_rank
FROM lang_counts""")


# --- stored and read back, further loads, whole-text reports ------------------

ORACLE.update({
    "predictions_mart": ORACLE["top_predictions"],
    "answer_history_mart": _with(HISTORY, """
SELECT puzzle_number, answer, answer_date, day_name, answer_year, answer_month, difficulty,
       difficulty_bucket, vowel_count, unique_letter_count, word_commonality_score
FROM answer_history"""),
    "difficulty_by_pattern_mart": ORACLE["difficulty_by_pattern"],
    # The copies of an id agree, so what is stored doesn't depend on their order.
    "ingest_full_today": ORACLE["ingest_full"],
    "ingest_plain_pages": ORACLE["ingest_incremental"],
    "ingest_repeated_pages": ORACLE["ingest_incremental"],
    "ingest_bucketed": ORACLE["ingest_incremental"],
    "stream_ingest_single_files": ORACLE["ingest_incremental"],
    "stream_keyed": ORACLE["ingest_incremental"],
    "stream_ingest_full": ORACLE["ingest_full"],
    "stream_counts": _with(_load_ctes(), "SELECT * FROM load_counts"),
    "ingest_bad_documents": _with(_load_ctes(), """
SELECT inserted, skipped, failed + (SELECT count(DISTINCT page) FROM batch) AS failed
FROM load_counts"""),
})

# Two fetches: even ids first, then all ids with their answers backwards.
ORACLE["ingest_page_order"] = _with(_load_ctes(), """
SELECT puzzle_number, answer, date, day_name, difficulty FROM stored
UNION ALL
SELECT puzzle_number, CASE WHEN puzzle_number % 2 = 0 THEN upper(trim(answer)) ELSE reverse(upper(trim(answer))) END,
       d, day_name, difficulty
FROM labelled WHERE label = 'inserted'""")
ORACLE["stream_page_order"] = ORACLE["ingest_page_order"]

ORACLE["ingest_all_counts"] = _with(_load_ctes(), """
SELECT inserted, skipped, failed, arrived - inserted - skipped - failed AS outside, arrived
FROM load_counts, (SELECT count(*) AS arrived FROM batch)""")
ORACLE["stream_all_counts"] = ORACLE["ingest_all_counts"]
ORACLE["stream_keyed_arrived"] = _with(_load_ctes(), """
SELECT inserted, arrived - inserted - skipped - failed AS outside, arrived
FROM load_counts, (SELECT count(*) AS arrived FROM batch)""")

# Half of the rows without an id have a date without a day: they are outside no window.
ORACLE["ingest_refused"] = _with(_load_ctes(), """
SELECT page, puzzle_number, answer, CAST(d AS VARCHAR) AS date,
       concat_ws(', ', CASE WHEN puzzle_number IS NULL THEN 'no id' END,
                       CASE WHEN answer IS NULL THEN 'no answer' END,
                       CASE WHEN d IS NULL THEN 'no date' END) AS reason
FROM labelled WHERE label = 'failed' AND NOT (puzzle_number IS NULL AND (pos // 4) % 2 = 0)
UNION ALL
SELECT page, game, answer, substr(CAST(date AS VARCHAR), 1, 7),
       CASE WHEN answer IS NULL THEN 'no id, no answer, ' ELSE 'no id, ' END || 'no whole date'
FROM batch WHERE game IS NULL AND (pos // 4) % 2 = 0""")
ORACLE["stream_refused"] = ORACLE["ingest_refused"]

# Marts as tables of the catalog.
ORACLE.update({
    "predictions_sql": ORACLE["predictions_mart"],
    "letter_frequency_sql": ORACLE["letter_frequency_mart"],
    "position_heatmap_sql": ORACLE["position_heatmap_mart"],
    "answer_history_sql": ORACLE["answer_history_mart"],
    "mart_tables": _with(HISTORY + PATTERN_PART, """
SELECT 'letter_frequency' AS table_name, count(*) AS n_rows FROM letter_freq
UNION ALL SELECT 'position_heatmap', count(*) FROM position_freq
UNION ALL SELECT 'difficulty_by_pattern', count(*) FROM difficulty_by_pattern
UNION ALL SELECT 'answer_history', count(*) FROM answer_history"""),
})

# The read orders: every row with its place.
ORACLE["answer_history_read"] = _with(HISTORY, """
SELECT puzzle_number, answer, word_commonality_score,
       row_number() OVER (ORDER BY puzzle_number DESC) AS read_position
FROM answer_history""")
ORACLE["word_scores_read"] = _with(SCORES, """
SELECT word, total_score, already_used,
       row_number() OVER (ORDER BY total_score DESC NULLS LAST, word ASC NULLS LAST) AS read_position
FROM word_scores""")
ORACLE["recent_history"] = _with(HISTORY, """
SELECT * FROM (
    SELECT puzzle_number, answer, answer_date, word_commonality_score,
           row_number() OVER (ORDER BY puzzle_number DESC) AS read_position
    FROM answer_history)
WHERE read_position <= 20""")

# Marts over the table as it is after the loads.
LOADED = _load_ctes() + STAGED[len(RAW):].replace("FROM raw_answers", "FROM after_load")
ORACLE["incremental_letter_frequency"] = _with(LOADED + FREQ_PART, "SELECT * FROM letter_freq")
ORACLE["incremental_position_frequency"] = _with(LOADED + FREQ_PART, "SELECT * FROM position_freq")
ORACLE["incremental_difficulty_by_pattern"] = _with(LOADED + PATTERN_PART, "SELECT * FROM difficulty_by_pattern")
ORACLE["incremental_difficulty_trend"] = _with(LOADED, """
SELECT puzzle_number, difficulty,
       avg(difficulty) OVER (ORDER BY puzzle_number ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
           AS rolling_avg
FROM staged WHERE difficulty IS NOT NULL""")

CORPUS_STAGED = CORPUS + r""",
corpus_staged AS (
    SELECT upper(token) AS answer, substr(upper(token), 1, 1) AS letter_1,
           substr(upper(token), 2, 1) AS letter_2, substr(upper(token), 3, 1) AS letter_3,
           substr(upper(token), 4, 1) AS letter_4, substr(upper(token), 5, 1) AS letter_5
    FROM corpus_tokens
)"""
# The same definitions of shares, over all word tokens in place of the answers.
CORPUS_FREQ = CORPUS_STAGED + FREQ_PART.replace("FROM staged", "FROM corpus_staged")


def _over_corpus(name: str) -> str:
    """A report's own SELECT over the corpus-wide shares."""
    return _with(CORPUS_FREQ, ORACLE[name].split(_with(LETTER_FREQ, ""), 1)[1])


ORACLE.update({f"corpus_{name}": _over_corpus(name)
               for name in ("top_letters", "position_heatmap", "strongest_letter")})
ORACLE["corpus_vowel_distribution"] = _with(CORPUS_STAGED + r""",
vowels AS (
    SELECT CAST(length(regexp_replace(answer, '[^AEIOU]', '', 'g')) AS INTEGER) AS vowel_count
    FROM corpus_staged
)""", """
SELECT vowel_count, count(*) AS puzzles,
       vowel_count || ' vowel' || CASE WHEN vowel_count = 1 THEN '' ELSE 's' END AS label
FROM vowels GROUP BY vowel_count""")
_CORPUS_SCORES = STAGED + "," + CORPUS_FREQ + SCORE_PART
ORACLE["corpus_word_scores"] = _with(_CORPUS_SCORES, "SELECT * FROM word_scores")
ORACLE["corpus_top_predictions"] = _with(_CORPUS_SCORES, "SELECT * FROM top_predictions")

# Marts as they are read: each row's place in the read order.
ORACLE.update({
    "letter_frequency_read": _with(LETTER_FREQ, """
SELECT letter, total_count, row_number() OVER (ORDER BY total_count DESC, letter) AS read_position
FROM letter_freq"""),
    "position_heatmap_read": _with(LETTER_FREQ, """
SELECT position, letter, position_count,
       row_number() OVER (ORDER BY position, position_count DESC, letter) AS read_position
FROM position_freq"""),
    "predictions_read": _with(SCORES, """
SELECT rank, word, row_number() OVER (ORDER BY rank) AS read_position FROM top_predictions"""),
    "difficulty_by_pattern_read": _with(STAGED + PATTERN_PART, """
SELECT vowel_count, unique_letter_count, difficulty_bucket, avg_difficulty,
       row_number() OVER (ORDER BY avg_difficulty DESC, vowel_count, unique_letter_count,
                          difficulty_bucket) AS read_position
FROM difficulty_by_pattern"""),
    "predictions_from_csv": ORACLE["top_predictions"],
})

# Texts as they are shown.
ORACLE.update({
    "winner_word": _with(SCORES, "SELECT rank, word, word AS rebuilt FROM top_predictions"),
    "kpi_text": _with(STAGED, """
SELECT format('{:,}', count(*)) AS total_puzzles, '#' || max(puzzle_number) AS latest_puzzle,
       printf('%.2f', avg(difficulty)) AS avg_difficulty,
       printf('%.1f', avg(vowel_count)) AS avg_vowels
FROM staged"""),
    # Shares have four decimals: rounded to one as decimals, half up.
    "letter_bar_text": _with(LETTER_FREQ, """
SELECT letter, repeat('█', CAST(trunc(frequency_pct * 2) AS INTEGER)) || ' '
       || CAST(round(CAST(frequency_pct AS DECIMAL(9, 4)), 1) AS DECIMAL(9, 1)) || '%' AS bar_text
FROM letter_freq ORDER BY total_count DESC, letter LIMIT 10"""),
    "recent_answers_display": _with(STAGED, """
SELECT puzzle_number AS "Puzzle #", answer AS "Answer", answer_date AS "Date", day_name AS "Day",
       difficulty AS "Difficulty", difficulty_bucket AS "Level", vowel_count AS "Vowels",
       unique_letter_count AS "Unique Letters"
FROM staged ORDER BY puzzle_number DESC LIMIT 20"""),
    "heatmap_display": "SELECT letter, " + ", ".join(
        f'position_{k} AS "Position {k}"' for k in range(1, 6))
        + f" FROM ({ORACLE['position_heatmap']})",
})
