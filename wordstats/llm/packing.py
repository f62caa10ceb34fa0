"""Packing documents into sequences of a fixed window, by non-negative least
squares over length combinations.

Every document's token ids, followed by an end id, are cut into whole windows
and one remainder shorter than a window.  Whole windows are sequences.  For
the remainders only the histogram of their lengths matters (``WINDOW`` - 1
numbers, whatever the input's size), so the plan is made on it:

1. all combinations of up to ``DEPTH`` lengths that fill a window exactly are
   enumerated, of lengths that occur;
2. how often each is to be used is the non-negative least squares solution
   against the histogram, found by coordinate descent on the largest
   decrease, which leaves few combinations in use;
3. counts are rounded, the most used combination first, and never take more
   remainders than there are;
4. residuals are packed greedily: the longest length is filled up with the
   longest that still fits, as often as the counts allow, where that fills
   the window; the lengths left over are laid one after the other and cut
   at the windows' ends.  What doesn't fill a last window is cut into
   sequences of powers of two, which need no padding.

So no sequence is padded.  The plan is a list of intervals: "remainders of
length L, numbers lo to hi, go to these sequences at this offset".  A
remainder's number among those of its length is its number in its task plus
how many the tasks before have; tasks count while they tokenise, so
remainders are neither sorted nor shuffled for it, and a length that a third
of all documents have is no group of its own anywhere.  Tokenised pieces are
stored once; the join with the tasks' counts is the only step that may
shuffle them (Spark broadcasts the counts where they are small).

Null and empty texts are documents of the end id alone.  Repeated rows and
null ids are documents of their own; ties don't exist, as documents are told
apart by their place.  Very long texts become many pieces, none longer than
a window.  An empty table gives no rows.  Other columns are not read.

Ids are those of the tokenizers library: the kind of tokenizer used here
lower-cases, drops white space and encodes the matches of a pattern each on
its own, so a worker keeps the ids of matches it has seen (``KEPT_WORDS``) instead of
asking the library again.  Other kinds of tokenizer are refused.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordstats.llm.common import bound_batches, table
from wordstats.operators.lookup import store

WINDOW = 2048
END_ID = 1
DEPTH = 3
#: Steps of the least squares solver, and the share of all remainders below
#: which a step's change counts as none.
MAX_STEPS = 20_000
TOLERANCE = 1e-7
#: A step of fewer sequences hardly changes a rounded count.
SMALLEST_STEP = 0.25
#: Words and matches whose ids a worker keeps, and the longest such one.
KEPT_WORDS = 200_000
KEPT_CHARS = 64
#: Largest tokenizer file that is broadcast.
MAX_TOKENIZER_BYTES = 64 << 20

# The tokenizer's pattern, and the same for words of the Latin
# blocks only, where its classes are short enough to write down.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTER = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\t-\r \x85\xa0"
_LATIN_END = "\u024f"
_LATIN = re.compile(f"[{_LETTER}]+|'(?:s|t|re|ve|m|ll|d)|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
_BEYOND_LATIN = re.compile(f"[^\\0-{_LATIN_END}]")
# split() takes four control characters for white space that the pattern doesn't.
_MORE = "\x1c\x1d\x1e\x1f"
_SPACES = re.compile(f"[{_SPACE}\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
# A byte as a printable character: itself where it prints, else from U+0100 on.
_PRINTABLE = {b: 0x100 + n for n, b in enumerate(
    [b for b in range(256) if not (0x21 <= b <= 0x7e or 0xa1 <= b <= 0xac or 0xae <= b)])}
_TOKENIZERS: dict = {}


# --- token ids ----------------------------------------------------------------

class Kept(dict):
    """key -> value, made on the first use.  Holds the ``limit`` keys used
    last and up to as many before them."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.before = make, limit, {}

    def __missing__(self, key: str) -> bytes:
        value = self.before.get(key) or self.make(key)
        if len(key) <= KEPT_CHARS:
            if len(self) >= self.limit:
                self.before = dict(self)
                self.clear()
            self[key] = value
        return value


class TextIds:
    """The ids of whole texts by a tokenizer file.

    A normalised text of the Latin blocks is split into the pattern's
    matches, whose ids the library's model gives.  Another text is split at
    white space, and its words beyond those blocks go to the library whole,
    as its Unicode version may differ from Python's.  Words and matches seen
    before are not asked for again."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        parts = json.loads(tokenizer_json)
        steps = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
        cuts = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
        if (steps != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]
                or (cuts[0]["behavior"], cuts[0]["invert"]) != ("Removed", True)
                or cuts[0]["pattern"].get("Regex") != PATTERN
                or cuts[1]["use_regex"] or cuts[1]["add_prefix_space"]):
            raise ValueError("expected a tokenizer that lower-cases, keeps the known pattern's matches, drops the rest")
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True      # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        self.of_match = Kept(self._of_match, KEPT_WORDS)
        self.of_word = Kept(self._of_word, KEPT_WORDS)

    def _of_match(self, match: str) -> bytes:
        if not (match.isascii() and match.isprintable()):
            # the model reads each byte as a printable character
            match = match.encode().decode("latin-1").translate(_PRINTABLE)
        return array("i", [t.id for t in self.model.tokenize(match)]).tobytes()

    def _of_word(self, word: str) -> bytes:
        if word.isascii() or _BEYOND_LATIN.search(word) is None:
            return b"".join(map(self.of_match.__getitem__, _LATIN.findall(word)))
        return array("i", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str | None, end: int | None = END_ID) -> np.ndarray:
        text = normalised(text or "")
        if _BEYOND_LATIN.search(text) is None:
            found = b"".join(map(self.of_match.__getitem__, _LATIN.findall(text)))
        else:
            found = b"".join(map(self.of_word.__getitem__, words_of(text)))
        if end is not None:
            found += array("i", [end]).tobytes()
        return np.frombuffer(found, dtype=np.int32)


def words_of(text: str) -> list[str]:
    if any(c in text for c in _MORE):
        return [w for w in _SPACES.split(text) if w]
    return text.split()


def normalised(text: str) -> str:
    text = unicodedata.normalize("NFC", text)
    # Python lower-cases a sigma by its place in the word, the tokenizer doesn't
    return text.lower() if "\u03a3" not in text else "".join(c.lower() for c in text)


def text_ids(tokenizer_json: str) -> TextIds:
    """The ids of a tokenizer, built once per process."""
    key = hash(tokenizer_json)
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = TextIds(tokenizer_json)
    return _TOKENIZERS[key]


def load_tokenizer(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file's text, as a broadcast."""
    if os.path.getsize(path) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{path} is larger than {MAX_TOKENIZER_BYTES} bytes")
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def tokenised(docs: DataFrame, model: Broadcast, key: str = "doc_id", text: str = "text",
              window: int = WINDOW, end: int | None = END_ID) -> DataFrame:
    """One row per whole window and per remainder of each document: its key,
    ``start`` and ``length`` in the document's ids, ``doc_tokens``, ``ids``,
    the task that made it (``part``) and its number there among the pieces
    of its length (``local``)."""
    bound_batches(docs.sparkSession)
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField(key, source.schema["key"].dataType), *[
        T.StructField(c, t) for c, t in (
            ("start", T.LongType()), ("length", T.IntegerType()), ("doc_tokens", T.LongType()),
            ("ids", T.ArrayType(T.IntegerType())), ("part", T.IntegerType()), ("local", T.LongType()))]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = text_ids(model.value)
        part = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, dtype=np.int64)
        for batch in batches:
            docs_ids = [ids_of(t, end) for t in batch.column(1).to_pylist()]
            sizes = np.array([len(x) for x in docs_ids], dtype=np.int64)
            pieces = -(-sizes // window)
            doc = np.repeat(np.arange(len(sizes)), pieces)
            first = np.cumsum(pieces) - pieces
            start = (np.arange(len(doc)) - first[doc]) * window
            length = np.minimum(sizes[doc] - start, window)
            local = np.empty(len(doc), dtype=np.int64)
            for i, n in enumerate(length.tolist()):
                local[i] = seen[n]
                seen[n] += 1
            offsets = np.r_[0, np.cumsum(length)].astype(np.int32)
            flat = np.concatenate(docs_ids) if docs_ids else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), pa.array(start), pa.array(length.astype(np.int32)),
                 pa.array(sizes[doc]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                 pa.array(np.full(len(doc), part, np.int32)), pa.array(local)],
                names=schema.fieldNames())

    return source.mapInArrow(cut, schema)


# --- the plan -----------------------------------------------------------------

@dataclass
class Interval:
    """Pieces of ``length`` numbered ``lo`` to ``hi``.  Where ``copies`` is 1
    or more, that many consecutive ones share a sequence, from ``offset`` on,
    and the first ones have sequence ``sequence``.  Where it is 0, the pieces
    lie one after the other from token ``offset`` of the laid-out tokens on."""

    length: int
    lo: int
    hi: int
    copies: int
    sequence: int
    offset: int


@dataclass
class Plan:
    intervals: list[Interval]
    #: Where the laid-out tokens are cut, and the sequence before each cut.
    window: int
    laid: int                   # laid-out tokens
    laid_sequence: int          # the first sequence that holds laid-out tokens
    sequences: int              # how many sequences there are
    combined: int               # remainders that the least squares solution places


def combinations(present: np.ndarray, window: int, depth: int = DEPTH) -> np.ndarray:
    """Rows of two to ``depth`` ascending lengths, zeros first, of the
    ``present`` (ascending) lengths that add up to the window."""
    have = np.zeros(window + 1, dtype=bool)
    have[present] = True
    found = [np.zeros((0, depth), dtype=np.int64)]
    base = present.reshape(-1, 1)
    for used in range(1, depth):
        rest = window - base.sum(axis=1)
        full = (rest >= base[:, -1]) & have[np.maximum(rest, 0)]
        found.append(np.pad(np.column_stack([base[full], rest[full]]), ((0, 0), (depth - used - 1, 0))))
        if used == depth - 1:
            break
        # one more length, not shorter than the last, with room for another
        row, nth = np.nonzero((present >= base[:, -1:]) & (2 * present <= rest[:, None]))
        base = np.column_stack([base[row], present[nth]])
    return np.concatenate(found)


def least_squares(columns: np.ndarray, target: np.ndarray) -> np.ndarray:
    """x >= 0 that brings the combinations' lengths, x times each, close to
    ``target`` (per length) in least squares: coordinate descent that always
    takes the combination with the largest decrease."""
    n, depth = columns.shape
    x = np.zeros(n)
    if not n:
        return x
    used = columns > 0
    rest = target.astype(np.float64).copy()
    rest[0] = 0.0
    # |a|^2 of a column: over its places, how often it holds that place's length
    norm = sum(((columns[:, i] == columns[:, j]) & used[:, i]).astype(np.float64)
               for i in range(depth) for j in range(depth))
    # which columns hold a length
    flat = np.flatnonzero(used)
    by_length = np.argsort(columns.ravel()[flat], kind="stable")
    holders = flat[by_length] // depth
    ends = np.searchsorted(columns.ravel()[flat][by_length], np.arange(len(target) + 1))
    slope = (rest[columns] * used).sum(axis=1)
    step = np.maximum(slope / norm, 0.0)
    gain = step * (2 * slope - step * norm)
    least = max(TOLERANCE * target.sum(), SMALLEST_STEP)
    for _ in range(MAX_STEPS):
        best = int(gain.argmax())
        move = step[best]
        if abs(move) < least:
            break
        x[best] += move
        touched = []
        for length, copies in zip(*np.unique(columns[best][used[best]], return_counts=True)):
            rest[length] -= move * copies
            touched.append(holders[ends[length]:ends[length + 1]])
            np.subtract.at(slope, touched[-1], move * copies)
        touched = np.concatenate(touched)
        step[touched] = np.maximum(slope[touched] / norm[touched], -x[touched])
        gain[touched] = step[touched] * (2 * slope[touched] - step[touched] * norm[touched])
    return x


def make_plan(histogram: dict[int, int], window: int = WINDOW, depth: int = DEPTH) -> Plan:
    """Where pieces go, by their lengths' counts."""
    count = np.zeros(window + 1, dtype=np.int64)
    for length, n in histogram.items():
        count[length] = n
    taken = np.zeros(window + 1, dtype=np.int64)        # numbers given out per length
    intervals: list[Interval] = []
    sequence = 0

    def place(lengths: list[int], times: int) -> None:
        """``times`` sequences that hold ``lengths`` each."""
        nonlocal sequence
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            copies = lengths.count(length)
            lo = int(taken[length])
            taken[length] += copies * times
            intervals.append(Interval(length, lo, lo + copies * times, copies, sequence, offset))
            offset += copies * length
        sequence += times

    if count[window]:
        place([window], int(count[window]))
    present = np.flatnonzero(count[:window])
    columns = combinations(present, window, depth)
    target = count.copy()
    target[window] = 0
    wanted = np.floor(least_squares(columns, target) + 0.5).astype(np.int64)
    for c in np.argsort(-wanted, kind="stable"):
        if wanted[c] == 0:
            break
        lengths = [int(x) for x in columns[c] if x]
        times = min(int(wanted[c]), *[int(count[x] - taken[x]) // lengths.count(x) for x in lengths])
        if times:
            place(lengths, times)
    combined = int(taken[:window].sum())

    # Residuals: fill up greedily where that fills the window.
    left = count - taken
    left[window] = 0
    over: list[int] = []
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        lengths, room = [], window
        free = left.copy()
        while room:
            fits = np.flatnonzero(free[:room + 1])
            if not len(fits):
                break
            length = int(fits[-1])
            more = min(room // length, int(free[length]))
            lengths += [length] * more
            free[length] -= more
            room -= more * length
        if room:
            over.append(longest)
            left[longest] = 0
            continue
        times = min(int(left[x]) // lengths.count(x) for x in set(lengths))
        place(lengths, times)
        for x in set(lengths):
            left[x] -= lengths.count(x) * times
    laid = 0
    for length in over:
        lo, hi = int(taken[length]), int(count[length])
        intervals.append(Interval(length, lo, hi, 0, 0, laid))
        laid += (hi - lo) * length
    return Plan(intervals, window, laid, sequence,
                sequence + laid // window + bin(laid % window).count("1"), combined)


def laid_cuts(plan: Plan, at: int, length: int) -> list[tuple[int, int, int, int]]:
    """(start in the piece, length, sequence, offset) of a laid-out piece's cuts."""
    window = plan.window
    whole = plan.laid // window * window
    out, done = [], 0
    while done < length:
        pos = at + done
        if pos < whole:
            seq, lo, hi = pos // window, pos // window * window, pos // window * window + window
        else:
            # the tail: powers of two, the largest first
            seq, lo, tail = whole // window, whole, plan.laid - whole
            hi = lo + (1 << (tail.bit_length() - 1))
            while pos >= hi:
                tail -= hi - lo
                seq, lo = seq + 1, hi
                hi = lo + (1 << (tail.bit_length() - 1))
        size = min(hi - pos, length - done)
        out.append((done, size, plan.laid_sequence + seq, pos - lo))
        done += size
    return out


# --- putting it to work ---------------------------------------------------------

def placed(pieces: DataFrame, plan: Plan, digest: bool = False) -> DataFrame:
    """``pieces`` (with ``before``: how many of their length are in earlier
    tasks) with their sequence and offset, cut where the plan cuts them;
    with ``digest`` the crc32 of each piece's ids instead of the ids."""
    intervals = sorted(plan.intervals, key=lambda i: (i.length, i.lo))
    numbers = np.array([(i.length, i.lo, i.hi, i.copies, i.sequence, i.offset) for i in intervals],
                       dtype=np.int64).reshape(len(intervals), 6)
    # A few per length of the window: bounded by it.
    model = pieces.sparkSession.sparkContext.broadcast((plan, numbers))
    key = pieces.columns[0]
    source = pieces.select(key, "start", "length", "doc_tokens", "ids", (F.col("before") + F.col("local")).alias("n"))
    fields = source.schema
    schema = T.StructType([fields[key], fields["start"], T.StructField("length", T.LongType()), fields["doc_tokens"],
                           T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
                           T.StructField("ids_crc32", T.LongType()) if digest else fields["ids"]])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, numbers = model.value
        shift = 1 << 44                     # (length, number) as one sortable number
        starts = numbers[:, 0] * shift + numbers[:, 1]
        for batch in batches:
            start, length, n = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2, 5))
            i = np.searchsorted(starts, length * shift + n, side="right") - 1
            _, lo, _, copies, sequence, offset = numbers[i].T
            nth = n - lo
            share = np.maximum(copies, 1)
            row, cut_at, size = np.arange(len(n)), np.zeros(len(n), np.int64), length.copy()
            seq, off = sequence + nth // share, offset + nth % share * length
            laid = np.flatnonzero(copies == 0)
            if len(laid):
                cuts = [(r, *c) for r in laid.tolist()
                        for c in laid_cuts(plan, int(offset[r] + nth[r] * length[r]), int(length[r]))]
                more = np.array(cuts, dtype=np.int64)
                keep = copies > 0
                row, cut_at, size, seq, off = (
                    np.concatenate([a[keep], more[:, j]])
                    for j, a in enumerate((row, cut_at, size, seq, off)))
            ids = batch.column(4)
            flat, base = ids.flatten(), np.r_[0, np.cumsum(length)]
            begins = base[row] + cut_at
            # the rows' ids, in the new order
            where = np.repeat(begins - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
            same = len(row) == len(n) and not len(laid)
            values = flat if same else pa.array(flat.to_numpy(zero_copy_only=False)[where])
            bounds = np.r_[0, np.cumsum(size)].astype(np.int32)
            if digest:
                raw = memoryview(np.ascontiguousarray(values.to_numpy(zero_copy_only=False), dtype="<u4")).cast("B")
                last = pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())],
                                pa.int64())
            else:
                last = pa.ListArray.from_arrays(pa.array(bounds), values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(start[row] + cut_at), pa.array(size),
                 batch.column(3).take(pa.array(row)), pa.array(seq), pa.array(off), last],
                names=schema.fieldNames())

    return source.mapInArrow(place, schema)


def pack(docs: DataFrame, model: Broadcast, key: str = "doc_id", text: str = "text", window: int = WINDOW,
         end: int | None = END_ID, depth: int = DEPTH, digest: bool = False) -> tuple[DataFrame, Plan]:
    """(pieces, plan): every piece's key, start, length, doc_tokens,
    sequence_id, offset and ids (with ``digest`` the ids' crc32 as
    little-endian unsigned 32-bit integers, ``ids_crc32``, instead)."""
    pieces = store(tokenised(docs, model, key, text, window, end), "pieces")
    counts = store(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "counts")
    # One row per length: bounded by the window.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = make_plan(histogram, window, depth)
    # A length has one row per task at most here, whatever the rows.
    ahead = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = store(counts.select("part", "length", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before")),
                   "before")
    joined = pieces.join(before, ["part", "length"])
    return placed(joined.select(*[pieces[c] for c in pieces.columns], "before"), plan, digest), plan


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the pieces put together, each sequence's in order."""
    item = F.struct("offset", "ids")
    return (pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(item)).alias("_p"))
            .select("sequence_id", F.flatten(F.transform("_p", lambda p: p["ids"])).alias("ids")))


def default_tokenizer(spark: SparkSession, name: str = "word_bpe_49k.json") -> Broadcast:
    import public_tokenizers

    return load_tokenizer(spark, public_tokenizers.path(name))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: every piece of every document, with its place."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces, _ = pack(docs, default_tokenizer(spark), digest=True)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
