"""Rows told by keys: documents named by id and text, kept or dropped without a shuffle of the texts where few are named; sets of 64-bit keys as bit fields."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kasane.llm.textbytes import mix
from kasane.plans.staging import sized

#: Bits of a field that goes to every task; fixed, whatever the number of keys.
FIELD_BITS = 1 << 23


#: Rows that go to Python at once where each holds a whole text.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Have texts sent to Python ``BATCH_ROWS`` at a time, unless the session asks for fewer; default batches of long texts fill the memory beside the heap."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def slots(keys: np.ndarray, bits: int = FIELD_BITS) -> np.ndarray:
    """Which bit stands for each key."""
    return (mix(keys) & np.uint64(bits - 1)).astype(np.int64)


def bit_field(entries: DataFrame, key: str = "key", bits: int = FIELD_BITS) -> bytes:
    """The keys of ``entries`` as a field of ``bits`` bits (a power of two), gathered as at most bits / 64 words: it has no false negatives."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(slots(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits))], ["slot"])

    field = np.zeros(bits // 64, np.int64)
    packed = entries.select(key).mapInArrow(work, "slot long").selectExpr("slot >> 6 AS word", "shiftleft(1L, int(slot & 63)) AS bit")
    for row in packed.groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")).toLocalIterator():
        field[row["word"]] = row["bits"]
    return field.tobytes()


def bits_of(field: bytes) -> np.ndarray:
    """A bit field as truth values."""
    return np.unpackbits(np.frombuffer(field, np.uint8), bitorder="little").astype(bool)


def _joined(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str, how: str) -> DataFrame:
    named = sized(keys).select(F.col("doc_id").alias("__key_id"), F.col("text_hash").alias("__key_hash"))
    return docs.join(named, same_row(docs, named, id_col, text_col), how)


def same_row(docs: DataFrame, named: DataFrame, id_col: str, text_col: str) -> Column:
    """Whether a row of ``docs`` is the one named by ``__key_id`` and ``__key_hash``."""
    return docs[id_col].cast("long").eqNullSafe(named["__key_id"]) & (F.xxhash64(docs[text_col].cast("string")) == named["__key_hash"])


def without_rows(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that the staged ``keys`` (doc_id, text_hash) do not name. Null ids and texts are values like others; repeated rows stay or go together; without keys all stay."""
    return _joined(docs, keys, id_col, text_col, "left_anti")


def with_rows(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that the staged ``keys`` (doc_id, text_hash) name. Null ids and texts are values like others; repeated rows stay or go together; without keys all go."""
    return _joined(docs, keys, id_col, text_col, "left_semi")
