import pytest

SF = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text[, lang, source]) rows."""
    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 len(r[1]) if r[1] else 0) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA).repartition(parts)
    return make


@pytest.fixture(scope="session")
def mid_docs(spark):
    """doc_id -> text of the middle-sized table."""
    return {r.doc_id: r.text for r in
            spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()}


# null text, empty, blank, one word, no white space, repeats, non-ASCII, very long
AWKWARD = [
    (0, None), (1, ""), (2, "   \t\n "), (3, "word"), (4, "x" * 5000), (5, "same words here"),
    (6, "same words here"), (6, "same words here"), (7, "ÄÖ é 漢字 🙂 mixed ünïcode text"),
    (8, "lorem ipsum dolor sit amet " * 8000), (9, "a b a b a b a b a b a b"), (None, "no id"),
    (None, "no id"), (None, None),
]
