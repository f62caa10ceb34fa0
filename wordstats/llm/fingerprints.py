"""Document fingerprints by Order MinHash.

A text's tokens are its runs of non-space characters, cut after
``TOKEN_CHARS`` characters (so that a text without spaces has many).  Its
k-mers are ``K`` tokens in a row (fewer tokens: the whole sequence), each
numbered by how often it occurred before in the text.  An order over the
numbered k-mers comes from a 32-bit hash of k-mer and number.  Each of the
``SKETCHES`` parts of the fingerprint takes the ``MINIMA`` smallest numbered
k-mers, puts them back into text order and hashes the tuple: the part stays
the same only if the same k-mers are there in the same order, which is what
makes the fingerprint sensitive to edit distance and not just to shared
words.  Part j's order is the hash order rotated by j / SKETCHES of its
range, so one sort serves all parts.

Two fingerprints' likeness is the share of equal parts.  Equal texts have
equal fingerprints; empty and null texts have all parts zero.

Only built-in functions are used: arrays and lambda expressions inside one
row, no row per k-mer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordstats.llm.common import let, table, whole_text

TOKEN_CHARS = 16
K = 3
SKETCHES = 32
MINIMA = 2
_TOP = 30
_HIGH = -(1 << 32)          # the upper 32 bits of a long
_LOW = (1 << 32) - 1


def _steps(array: Column) -> Column:
    """Descending powers of two up to the array's size, for binary search."""
    powers = F.array(*[F.lit(1 << p) for p in range(_TOP, -1, -1)])
    return F.filter(powers, lambda p: p <= F.size(array))


def _search(steps: Column, holds) -> Column:
    """The largest n for which ``holds`` is true at 1..n, if it's true up to
    some point and false (or null) beyond."""
    return F.aggregate(steps, F.lit(0), lambda n, p: F.when(holds(n + p), n + p).otherwise(n))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"[^\x20\x09-\x0D]{{1,{TOKEN_CHARS}}}"), F.lit(0))


def _numbered(words: Column, k: int) -> Column:
    """Sorted longs, one per k-mer: hash of (k-mer, occurrence number) above,
    position below."""
    grams = F.slice(
        F.transform(words, lambda _, i: F.shiftleft(F.xxhash64(F.slice(words, i + 1, k)), 32)
                    .bitwiseOR(i.cast("long"))),
        F.lit(1), F.greatest(F.size(words) - F.lit(k - 1), F.lit(1)))

    def hashed(grams: Column, steps: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            gram = F.shiftright(x, 32)

            def same(back: Column) -> Column:
                return F.shiftright(F.get(grams, i - back), 32) == gram

            # How many equal k-mers stand before it, in text order: most
            # often none, else found by binary search, as grams are sorted.
            number = F.when(same(F.lit(1)), _search(steps, same)).otherwise(F.lit(0))
            return (F.xxhash64(gram, number).bitwiseAND(F.lit(_HIGH))
                    .bitwiseOR(x.bitwiseAND(F.lit(_LOW))))

        return F.sort_array(F.transform(grams, one))

    return let(F.sort_array(grams), lambda g: let(_steps(g), lambda s: hashed(g, s)))


def signature(text: Column, sketches: int = SKETCHES, minima: int = MINIMA, k: int = K) -> Column:
    """The fingerprint of a text: an array of ``sketches`` 32-bit numbers (as longs)."""
    starts = F.array(*[F.lit(-(1 << 63) + j * ((1 << 64) // sketches)) for j in range(sketches)])
    offsets = F.array(*[F.lit(t) for t in range(minima)])

    def parts(order: Column, steps: Column) -> Column:
        def one(start: Column) -> Column:
            first = _search(steps, lambda n: F.get(order, n - 1) < start)
            return let(first, lambda at: picked(at))

        def picked(at: Column) -> Column:
            # position above, hash below: sorting puts them into text order
            chosen = F.transform(
                F.slice(offsets, F.lit(1), F.least(F.lit(minima), F.size(order))),
                lambda t: let(F.get(order, (at + t) % F.size(order)),
                              lambda x: F.shiftleft(x, 32).bitwiseOR(F.shiftrightunsigned(x, 32))))
            hashes = F.transform(F.sort_array(chosen), lambda y: y.bitwiseAND(F.lit(_LOW)))
            return F.xxhash64(hashes).bitwiseAND(F.lit(_LOW))

        return F.transform(starts, one)

    def whole(order: Column) -> Column:
        zeros = F.array_repeat(F.lit(0).cast("long"), sketches)
        return F.when(F.size(order) == 0, zeros).otherwise(
            let(_steps(order), lambda s: parts(order, s)))

    return let(F.coalesce(text, F.lit("")),
               lambda t: let(tokens(t), lambda w: let(_numbered(w, k), whole)))


def written(sig: Column) -> Column:
    """The fingerprint as text: eight hexadecimal digits per part."""
    return F.array_join(F.transform(sig, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column, sketches: int = SKETCHES) -> Column:
    """Share of equal parts, 0 to 1."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(sketches))


def fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text, as text."""
    return docs.withColumn(out, written(signature(F.col(text))))


def with_next(docs: DataFrame, key: str, payload: list[str], parts: int | None = None) -> DataFrame:
    """Every row with ``next``: the struct of ``payload`` columns of the row
    after it in order of ``key`` (null last), then of the payload; the row
    after the last is the first.

    The rows are dealt out once, by key ranges whose bounds are existing keys
    (approximate quantiles of the narrow key column, as many as partitions).
    The row at a range's lower bound is also dealt to the range before it,
    where it is the next of that range's last row."""
    spark = docs.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    order_key = F.coalesce(F.col(key), F.lit((1 << 63) - 1))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    # One row of `parts` numbers: its size follows the partition count, not the data.
    found = docs.agg(F.min(order_key).alias("low"),
                     F.percentile_approx(order_key, shares, 20 * parts).alias("cuts")).first()
    if found["low"] is None:
        bounds = [0]
    else:
        bounds = sorted({found["low"], *[c for c in found["cuts"] if parts > 1]})
    array = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = F.array(*[F.lit(1 << p) for p in range(len(bounds).bit_length(), -1, -1)])
    rows = docs.withColumn("_key", order_key)
    rank = let(F.col("_key"), lambda k: let(array, lambda a: _search(
        steps, lambda n: F.get(a, n - 1) <= k)))
    rows = rows.withColumn("_range", rank - 1)
    at_bound = F.col("_key") == F.get(array, F.col("_range"))
    before = F.when(F.col("_range") == 0, F.lit(len(bounds) - 1)).otherwise(F.col("_range") - 1)
    own = F.struct(F.col("_range").alias("r"), F.lit(False).alias("guest"))
    guest = F.struct(before.alias("r"), F.lit(True).alias("guest"))
    rows = rows.withColumn("_to", F.explode(F.when(at_bound, F.array(own, guest)).otherwise(F.array(own))))
    order = Window.partitionBy("_to.r").orderBy("_to.guest", F.col(key).isNull(), "_key", *payload)
    return (rows.withColumn("next", F.lead(F.struct(*payload)).over(order))
            .filter(~F.col("_to.guest")).drop("_key", "_range", "_to"))


def edited_text(text: Column, following: Column) -> Column:
    """``text`` with its last quarter replaced by as much of ``following``'s start."""
    n = F.length(text)
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - quarter),
                    F.substring(following, F.lit(1), quarter))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: fingerprints of every document and of its edited text.  A row
    with a null id comes after the others, in order of text."""
    docs = (table(spark, sf_dir, "documents").select("doc_id", whole_text().alias("text"))
            .withColumn("sig", signature(F.col("text"))))
    rows = with_next(docs, "doc_id", ["text", "sig"])
    rows = (rows.withColumn("edited", edited_text(F.col("text"), F.col("next.text")))
            .select("doc_id", F.length("text").cast("long").alias("n_chars"),
                    F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                    "sig", F.col("next.sig").alias("next_sig"),
                    signature(F.col("edited")).alias("edited_sig")))
    return rows.select("doc_id", "n_chars", "edited_sha256", written(F.col("sig")).alias("fingerprint"),
                       written(F.col("edited_sig")).alias("edited_fingerprint"),
                       likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
                       likeness(F.col("sig"), F.col("next_sig")).alias("near_next"))
