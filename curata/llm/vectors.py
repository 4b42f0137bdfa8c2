"""Vectors of a table as numpy blocks, shared by the vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curata.llm.common import arrow_map, stage



def kind(vectors: DataFrame, vector: str) -> np.dtype:
    """How components are carried: as stored, so no bit is lost and floats take 4 bytes."""
    return np.dtype("<f4" if "float" in vectors.schema[vector].dataType.simpleString() else "<f8")


def valid_rows(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, float64 matrix) of the vectors that may take part: ``dim`` finite
    components, not all zero."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(np.nan_to_num(size.astype(float), nan=-1) == dim)
    if not len(rows) or not dim:
        return rows[:0], np.zeros((0, dim))
    values = column.take(pa.array(rows)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    x = values.reshape(len(rows), dim)  # a null component comes as NaN
    ok = np.isfinite(x).all(1) & (x != 0).any(1)
    return rows[ok], x[ok]


def dimension(vectors: DataFrame, vector: str) -> int:
    """The most frequent length of the vectors (the larger of equals); others take no part."""
    row = (vectors.where(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("d")).count()
           .orderBy(F.desc("count"), F.desc("d")).first())
    return row["d"] if row else 0


def pack(x: np.ndarray) -> pa.Array:
    """A matrix as binary values, one a row."""
    x = np.ascontiguousarray(x)
    width = x.shape[1] * x.itemsize if x.ndim == 2 else 0
    return pa.array([r.tobytes() for r in x] if width else [], pa.binary())


def unpack(column, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def doubles(column, dtype, width: int) -> np.ndarray:
    """Carried vectors as a float64 matrix."""
    return unpack(column, dtype, width).astype(np.float64)


def usable(vectors: DataFrame, key: str, vector: str, dim: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """Staged (id, *extra, x binary) of the rows whose vector takes part.

    ``extra`` columns have to be long integers."""
    dtype = kind(vectors, vector)

    def run(batches):
        for b in batches:
            rows, x = valid_rows(b.column(1), dim)
            if len(rows):
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), *[b.column(2 + i).take(at) for i in range(len(extra))], pack(x.astype(dtype))],
                                                 ["id", *extra, "x"])

    cols = [F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>"), *[F.col(c).cast("long").alias(c) for c in extra]]
    schema = "id bigint, " + "".join(f"{c} bigint, " for c in extra) + "x binary"
    return stage(arrow_map(vectors.select(*cols), run, schema))


def sample(staged: DataFrame, rows: int, dtype: np.dtype) -> np.ndarray:
    """Up to ``rows`` distinct vectors of the table, chosen by hash, as a matrix."""
    got = staged.select("x").distinct().orderBy(F.xxhash64("x"), "x").limit(rows).toArrow()["x"]
    return np.frombuffer(b"".join(got.to_pylist()), dtype).astype(np.float64).reshape(got.length(), -1) if got.length() else np.zeros((0, 0))
