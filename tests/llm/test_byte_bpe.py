import hashlib

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from wordstats.llm import byte_bpe

from llm_tables import AWKWARD, SF_MID, docs_of, mid_docs  # noqa: F401


def reference_encoder():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return byte_bpe.encoder(public_tokenizers.PATTERN, f.read())


def test_query_equals_library(spark, mid_docs):
    enc = reference_encoder()
    rows = byte_bpe.query(spark, SF_MID).collect()
    assert len(rows) == len(mid_docs)
    for r in rows:
        text = mid_docs[r.doc_id] or ""
        ids = enc.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_pieces_do_not_change_ids():
    enc = reference_encoder()
    texts = ["a  b\n\n c's 12ab  !? " * 400, "x" * 3000, "  \n \t " * 500 + "end", "it's   x y" * 300,
             "漢字 🙂\r\n" * 300, ""]
    for t in texts:
        for size in (1, 7, 50, 1000):
            assert "".join(byte_bpe.pieces(t, size)) == t
            assert byte_bpe.encode_text(enc, t, size) == enc.encode_ordinary(t)


def test_long_white_space():
    enc = reference_encoder()
    texts = ["a" + " " * 40 + "b!\x1c!\x1c  c" + "\n " * 30, " " * 50, "\t" * 33 + "x", "\x1c" * 60 + " \x1f" * 40,
             "word " * 30 + "\u3000" * 45 + "\u2028" * 3 + "!", "x" + "\x85\xa0" * 20 + " 's"]
    for t in texts:
        for size in (5, 1000):
            for run in (4, 16, 32):
                assert byte_bpe.encode_text(enc, t, size, run) == enc.encode_ordinary(t)
    # too long for the pattern itself
    for t in (" " * 1_200_000 + "a", "b" + "\n" * 1_200_000, ("x " + " " * 9000) * 100, "y" * 1_000_000):
        assert enc.decode_bytes(byte_bpe.encode_text(enc, t)) == t.encode()
    assert byte_bpe.encode_text(enc, " " * 20_000 + "a") == enc.encode_ordinary(" " * 20_000 + "a")


def test_awkward_rows_round_trip(spark, docs_of):
    model = byte_bpe.default_ranks(spark)
    docs = docs_of(AWKWARD).withColumn("ids", F.lit("clash")).withColumn("n_tokens", F.lit("clash"))
    out = byte_bpe.decode(byte_bpe.encode(docs, model), model).collect()
    assert len(out) == len(AWKWARD)
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in out)
    assert byte_bpe.encode(docs_of([]), model).count() == 0
    assert byte_bpe.round_trip(docs, model).filter("n_tokens = 0").count() == 3
