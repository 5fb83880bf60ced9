"""Counts of hashed n-grams over a whole corpus, as arrays of fixed size."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small

BLOCK = 1 << 14


def slot_counts(docs: DataFrame, text: str, flag: str, slots: int, slots_of: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Array (2, slots): how often each slot occurs in all rows, and in rows whose ``flag`` is true.

    ``slots_of`` gives the slots of a batch of texts and the text of each. Each task adds up its own rows and sends
    blocks of the sums; tasks of the second stage add those up as they stream by. Only the final array,
    whose size is fixed, reaches the driver.
    """
    blocks = -(-slots // BLOCK)
    schema = "block int, counts binary"

    def emit(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Counts in as few bytes each as the largest needs, compressed: most are small."""
        for b, a in sums.items():
            packed = zlib.compress(a.astype(np.min_scalar_type(int(a.max()))).tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([packed], pa.binary())], ["block", "counts"])

    def unpack(packed: bytes) -> np.ndarray:
        raw = zlib.decompress(packed)
        return np.frombuffer(raw, f"u{len(raw) // (2 * BLOCK)}").reshape(2, BLOCK).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, blocks * BLOCK), np.int64)
        for b in small(batches):
            slot, doc = slots_of(b.column(0))
            flagged = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            total[0] += np.bincount(slot, minlength=total.shape[1])
            total[1] += np.bincount(slot[flagged[doc]], minlength=total.shape[1])
        parts = total.reshape(2, blocks, BLOCK)
        yield from emit({b: parts[:, b] for b in range(blocks) if parts[0, b].any()})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, a in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                one = unpack(a.as_py())
                sums[b] = sums[b] + one if b in sums else one
        yield from emit(sums)

    parts = docs.select(text, F.coalesce(F.col(flag), F.lit(False)).alias(flag)).mapInArrow(count, schema)
    out = np.zeros((2, blocks, BLOCK), np.int64)
    for row in parts.repartition("block").mapInArrow(add, schema).toArrow().to_pylist():
        out[:, row["block"]] = unpack(row["counts"])
    return out.reshape(2, -1)[:, :slots]


def flagged(docs: DataFrame, chosen: DataFrame, id_col: str, flag: str) -> DataFrame:
    """``docs`` with ``flag``: whether the id is among those of ``chosen``."""
    ids = chosen.select(id_col).dropna().distinct().withColumn(flag, F.lit(True))
    # a shuffle join at every size: a broadcast would be another plan on little data
    return docs.join(ids.hint("merge"), id_col, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
