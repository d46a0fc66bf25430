"""Hashed byte n-grams of many texts at once, and their counts over a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kasane.llm.textbytes import STEP_BYTES


def bucketed(data: np.ndarray, offs: np.ndarray, width: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram of ``width`` bytes that ends at each byte; before a text stand blanks."""
    n = len(data)
    out = np.zeros(n, np.uint64)
    padded = np.concatenate([np.full(width - 1, 0x20, np.uint8), data])
    wide = padded.astype(np.uint64)
    for j in range(width):
        out = out << np.uint64(8) | wide[j : j + n]
    starts = offs[:-1][np.diff(offs) > 0]
    for j in range(width - 1):  # the first width - 1 places of a text do not look into the text before
        at = starts + j
        at = at[at < n]
        keep = np.uint64((1 << 8 * (j + 1)) - 1)
        blank = np.uint64(int.from_bytes(b" " * width, "big")) & ~keep & np.uint64((1 << 8 * width) - 1)
        inside = np.searchsorted(offs, at, "right") == np.searchsorted(offs, at - j, "right")
        at = at[inside]
        out[at] = (out[at] & keep) | blank
    return ((out * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def pieces(n: int, size: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """(from, to) of consecutive pieces of about ``size`` of a long array."""
    for at in range(0, n, size):
        yield at, min(n, at + size)


def histogram(texts: DataFrame, add: Callable[[pa.RecordBatch, dict[str, np.ndarray]], None], buckets: int) -> DataFrame:
    """(name, bucket, n): sums of the counts that ``add`` makes of every batch, for a few names that are known beforehand; a task emits its counts at the end."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            add(batch, sums)
        for name, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], ["name", "bucket", "n"])

    counted = texts.mapInArrow(work, "name string, bucket long, n long")
    return counted.groupBy("name", "bucket").agg(F.sum("n").alias("n"))


def sparse(counts: DataFrame) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(name, buckets, counts) of each name, one name at a time."""
    pairs = counts.groupBy("name").agg(F.collect_list(F.struct("bucket", "n")).alias("pairs"))
    for part in pairs.select("name", "pairs.bucket", "pairs.n").toLocalIterator():
        yield part["name"], np.array(part["bucket"], np.int64), np.array(part["n"], np.int64)


def table(counts: DataFrame, buckets: int) -> dict[str, np.ndarray]:
    """The counts by name as arrays of all buckets."""
    return {name: np.bincount(at, n, buckets).astype(np.int64) for name, at, n in sparse(counts)}
