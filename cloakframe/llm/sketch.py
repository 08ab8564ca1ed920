"""How common shingles are: one table of counters of fixed size over all documents.

The table is summed without ever holding more than two of it in a task, and serves
only to order shingles and to weigh costs: whatever its error, results stay whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .textscan import shingle_pieces

BITS = 22
#: Hashes that are counted at once.
_BATCH = 1 << 22
_REDUCERS = 16


def _pack(counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([zstandard.ZstdCompressor(level=1).compress(counts.tobytes())], pa.binary())], names=["counts"])


def _unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.int64)


def shingle_levels(docs: DataFrame, text_col: str, width: int = 5, bits: int = BITS) -> np.ndarray:
    """uint8 of 2**bits: for shingle hash h, levels[h mod 2**bits] is 0 if it is as rare as
    chance tells, else about 2 x log2 of the number of its occurrences."""
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, n = np.zeros(size, np.int64), [], 0
        for b in batches:
            for _, h, _ in shingle_pieces(b.column(0), width):
                held.append((h & np.uint64(size - 1)).astype(np.int32))
                n += len(h)
                if n >= _BATCH:
                    total += np.bincount(np.concatenate(held), minlength=size)
                    held, n = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=size)
        yield _pack(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            for blob in b.column(0):
                total += _unpack(blob.as_py())
        yield _pack(total)

    parts = docs.select(text_col).mapInArrow(count, "counts binary").repartition(_REDUCERS).mapInArrow(add, "counts binary")
    total = np.zeros(size, np.int64)
    for r in parts.toLocalIterator():  # REDUCERS rows of one table each
        total += _unpack(bytes(r["counts"]))
    noise = float(np.median(total))
    above = total - noise
    above[above < 4 * np.sqrt(noise + 1)] = 0
    return np.where(above > 0, np.minimum(255, 1 + np.floor(2 * np.log2(np.maximum(above, 1)))), 0).astype(np.uint8)


def estimate(levels: np.ndarray) -> np.ndarray:
    """Occurrences that levels stand for."""
    return np.where(levels > 0, 2.0 ** ((levels.astype(np.float64) - 1) / 2), 1.0)
