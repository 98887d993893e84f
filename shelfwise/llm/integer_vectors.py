"""Vectors as whole numbers of 256ths, and exact sums over them."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SCALE = 256
EXACT = 2.0 ** 53  # whole numbers below are exact in double precision


def integer_rows(batches: Iterator[pa.RecordBatch], dims: int, limit: int, kind: str
                 ) -> Iterator[pa.RecordBatch]:
    """``vec_id`` and the bytes of ``floor(256 * x)`` of each vector of ``dims`` components that are
    neither null nor non-finite, and whose result is below ``limit``."""
    for batch in batches:
        fits = pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), dims), False)
        batch = batch.filter(fits)
        values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
        good = (np.abs(values) < limit // SCALE).all(1)  # false for NaN, which stands for null
        rows = np.floor(values[good].astype(np.float64) * SCALE).astype(kind)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(pa.array(good)), as_binary(rows)], names=["vec_id", "x"])


def as_binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def as_matrix(column, dims: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dims).astype(np.int64)


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left.T @ right`` of whole numbers without rounding: by doubles where all sums are below
    2**53, else by Python's numbers."""
    if not len(left):
        return np.zeros((left.shape[1], right.shape[1]), object)
    size = float(np.abs(left).max()) * float(np.abs(right).max()) * len(left)
    if size < EXACT:
        return (left.T.astype(np.float64) @ right.astype(np.float64)).astype(np.int64)
    return left.T.astype(object) @ right.astype(object)
