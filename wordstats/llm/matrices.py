"""Vectors as integer matrices: what the vector operators store and ship.

``chunks`` turns rows with an array column into records of up to
``CHUNK_ROWS`` vectors each: a little-endian integer matrix of the smallest
type that holds it, cut into column blocks where asked, beside the rows'
other columns as arrays.  A record is made from one batch of one input
partition, so nothing is shuffled to make it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_ROWS = 2048
#: Largest size of a quantised component: sums of squared differences of up to
#: 64 such components fit a 64-bit integer.
MAX_COMPONENT = 1 << 27


def finite(vector: Column) -> Column:
    """Whether a vector is there and holds neither nulls nor non-finite components."""
    v = vector.cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def quantise(rows: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * component), as 64-bit integers."""
    scaled = np.floor(rows * scale)
    if len(scaled) and np.abs(scaled).max(initial=0) > MAX_COMPONENT:
        raise ValueError(f"a vector component, times {scale:g}, is larger than {MAX_COMPONENT}")
    return scaled.astype(np.int64)


def padded(vectors: pa.ListArray, width: int) -> np.ndarray:
    """The vectors as rows of a matrix, shorter ones followed by zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def pack_ints(m: np.ndarray) -> tuple[str, bytes]:
    """(type, bytes) of an integer matrix, in the smallest type that holds it."""
    largest = int(np.abs(m).max(initial=0))
    kind = "<i2" if largest < 1 << 15 else "<i4" if largest < 1 << 31 else "<i8"
    return kind, m.astype(kind).tobytes()


def unpack_ints(kind: str, data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, dtype=kind).reshape(rows, -1).astype(np.int64)


def chunks(df: DataFrame, vector: str, scale: float, width: int, carry: Sequence[str] = (),
           columns: int | None = None) -> DataFrame:
    """(chunk, block, rows, kind, data, *carry): ``df``'s vectors, all finite
    and of at most ``width`` components, in blocks of ``columns`` columns.
    ``carry`` columns come as arrays, beside block 0 only."""
    step = columns or width
    source = df.select(F.col(vector).cast("array<double>").alias("_v"), *carry)
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("block", T.IntegerType()),
                           T.StructField("rows", T.IntegerType()), T.StructField("kind", T.StringType()),
                           T.StructField("data", T.BinaryType()),
                           *[T.StructField(c, T.ArrayType(source.schema[c].dataType)) for c in carry]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                some = batch.slice(at, CHUNK_ROWS)
                n = some.num_rows
                m = quantise(padded(some.column(0), width), scale)
                parts = [pack_ints(m[:, b:b + step]) for b in range(0, max(width, 1), step)]
                beside = []
                for i in range(len(carry)):
                    values = some.column(i + 1)
                    offsets = pa.array([0] + [n] * len(parts), pa.int32())
                    beside.append(pa.ListArray.from_arrays(offsets, values))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * len(parts), pa.int64()), pa.array(range(len(parts)), pa.int32()),
                     pa.array([n] * len(parts), pa.int32()), pa.array([k for k, _ in parts], pa.string()),
                     pa.array([d for _, d in parts], pa.binary()), *beside],
                    names=schema.fieldNames())
                chunk += 1

    return source.mapInArrow(cut, schema)
