"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one numpy step works on; one longer text makes a step of its own.
STEP_BYTES = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_bytes(col: str) -> Column:
    """The text as UTF-8 bytes, a null as no bytes."""
    return F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")


def steps(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``limit`` bytes together; no text is cut."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes, dtype=np.int64) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def trimmed(run):
    """``run`` for mapInArrow; when its task ends, the worker gives its free memory back to the system. Workers outlive
    their tasks, so what they hoard would be missing to the tasks, of other kinds also, beside them."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library has it
            if trim:
                trim(0)

    return whole


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: the finaliser of a splittable generator (fixed constants)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def list_array(flat: pa.Array | np.ndarray, offsets: np.ndarray) -> pa.Array:
    values = flat if isinstance(flat, pa.Array) else pa.array(flat)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def sha256_of(col: Column) -> Column:
    return F.sha2(col, 256)
