"""Byte-level BPE encoding and decoding with the tiktoken library.

``encode(df, ranks)`` adds the token ids of every whole text, ``decode``
turns ids back into raw bytes.  The rank file is read once on the driver
(its size is checked against ``MAX_RANK_BYTES``) and sent to the executors
as one broadcast, so workers need no file of their own; each worker builds
the encoder once.

Texts longer than ``PIECE_CHARS`` are cut before white space that follows
something else.  No match of the pattern runs over such a place and the
pattern's look-ahead is not affected by it, so the pieces' ids put together
are the whole text's ids; a text without such a place stays in one piece.

Runs of ``RUN_CHARS`` white space characters or more are too much for the
pattern's backtracking.  Such a run is one match up to its last character,
which belongs to what follows (all of it at the end of a text); that match
is encoded as a whole, without the pattern.

Null and empty texts have no ids and decode to no bytes.  Repeated rows,
ties and extra columns pass through; an input column named like an output
column is replaced.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import tiktoken
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordstats.llm.common import bound_batches, table, with_replaced

#: Longest text that is encoded in one call, in characters.
PIECE_CHARS = 1 << 16
#: Largest rank file that is broadcast.
MAX_RANK_BYTES = 64 << 20

#: White space runs from this length on are matched without the pattern.
RUN_CHARS = 1 << 13

# What \s means to the pattern (Python's own \s has more).
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BOUNDARY = re.compile(f"(?<=[^{_SPACE}])(?=[{_SPACE}])")
_ENCODERS: dict = {}


def load_ranks(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    """The rank file and the splitting pattern, as a broadcast."""
    if os.path.getsize(path) > MAX_RANK_BYTES:
        raise ValueError(f"{path} is larger than {MAX_RANK_BYTES} bytes")
    bound_batches(spark)
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast((pattern, f.read()))


class Encoder(tiktoken.Encoding):
    """The tiktoken encoder of a pattern, which can also take a text as one match."""

    def __init__(self, pattern: str, ranks: dict[bytes, int]):
        super().__init__("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.ranks = ranks

    @cached_property
    def one_match(self) -> tiktoken.Encoding:
        return tiktoken.Encoding("one match", pat_str=r"(?s:.+)", mergeable_ranks=self.ranks,
                                 special_tokens={})


def encoder(pattern: str, ranks: bytes) -> Encoder:
    """The encoder of a rank file, built once per process."""
    key = (pattern, hash(ranks))
    if key not in _ENCODERS:
        parsed = {base64.b64decode(token): int(rank)
                  for token, rank in (line.split() for line in ranks.splitlines() if line)}
        _ENCODERS[key] = Encoder(pattern, parsed)
    return _ENCODERS[key]


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` in pieces of about ``size`` characters, cut only where no
    match of the pattern can run across."""
    start = 0
    while len(text) - start > size:
        cut = _BOUNDARY.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def long_runs(text: str, run: int = RUN_CHARS) -> Iterator[tuple[int, int]]:
    """(start, end) of the matches made by white space runs of ``run``
    characters or more."""
    half = run // 2
    # Such a run holds a whole block of half its length: most texts have none.
    if len(text) >= run and any(text[i:i + half].isspace() for i in range(0, len(text) - half + 1, half)):
        for m in re.finditer(f"[{_SPACE}]{{{run},}}", text):
            yield m.start(), m.end() - (m.end() < len(text))


def encode_text(enc: Encoder, text: str | None, size: int = PIECE_CHARS, run: int = RUN_CHARS) -> list[int]:
    ids: list[int] = []
    at = 0
    for start, end in long_runs(text or "", run):
        ids += _encode_pieces(enc, text[at:start], size) + enc.one_match.encode_ordinary(text[start:end])
        at = end
    return ids + _encode_pieces(enc, text[at:] if text else "", size)


def _encode_pieces(enc: Encoder, text: str, size: int) -> list[int]:
    if len(text) <= size:
        return enc.encode_ordinary(text)
    return [i for piece in pieces(text, size) for i in enc.encode_ordinary(piece)]


def encode_column(model: Broadcast, text: Column) -> Column:
    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(*model.value)
        for batch in batches:
            yield pd.Series([np.asarray(encode_text(enc, t), dtype=np.int32) for t in batch],
                            dtype=object)

    return ids(text)


def decode_column(model: Broadcast, ids: Column) -> Column:
    @F.pandas_udf("binary")
    def raw(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(*model.value)
        for batch in batches:
            yield pd.Series([enc.decode_bytes([] if x is None else list(x)) for x in batch],
                            dtype=object)

    return raw(ids)


def encode(docs: DataFrame, model: Broadcast, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each text."""
    return with_replaced(docs, {out: encode_column(model, F.col(text))})


def decode(df: DataFrame, model: Broadcast, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes that each row's ids stand for."""
    return with_replaced(df, {out: decode_column(model, F.col(ids))})


def round_trip(docs: DataFrame, model: Broadcast, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` (of the ids as little-endian
    unsigned 32-bit integers) and ``decoded_sha256`` (of the decoded bytes):
    encoding and decoding in one pass that ships no ids."""
    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = encoder(*model.value)
        for batch in batches:
            rows = []
            for t in batch:
                ids = encode_text(enc, t)
                rows.append((len(ids),
                             hashlib.sha256(np.asarray(ids, dtype="<u4").tobytes()).hexdigest(),
                             hashlib.sha256(enc.decode_bytes(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    found = with_replaced(docs, {"_digest": digest(F.col(text))})
    return with_replaced(found, {c: F.col("_digest")[c]
                                 for c in ("n_tokens", "ids_sha256", "decoded_sha256")}).drop("_digest")


def default_ranks(spark: SparkSession, rank_file: str = "byte_bpe_50k.tiktoken") -> Broadcast:
    import public_tokenizers

    return load_ranks(spark, public_tokenizers.path(rank_file), public_tokenizers.PATTERN)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: every document's token count and digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (round_trip(docs, default_ranks(spark))
            .select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))
