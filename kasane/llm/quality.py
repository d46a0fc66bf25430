"""Quality rules: surface counts, and a hashed n-gram log-likelihood ratio of trusted text against the raw corpus.

Byte n-grams are hashed into 2 ** ``BITS`` buckets. Two multinomials are counted: the target over trusted
documents and the raw one over all documents; the target is smoothed towards the raw one, so a small trusted
sample tells little rather than something wrong. The score of a text is the mean over its
n-grams of log p_target - log p_raw, so its length does not matter, and every text is held against the same
fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kasane.llm.ngrams import bucketed, histogram, table
from kasane.llm.textbytes import NOT_BLANK, grams, line_hashes, line_words, lines, mix, per_text, span_hashes, spans, steps, utf8

WIDTH = 4
BITS = 16
BUCKETS = 1 << BITS
#: Mean log-likelihood ratio under which a text is rejected.
THRESHOLD = -0.45
#: Trusted documents that the target multinomial is fitted on, at most: those of the smallest hash of the id.
TRUSTED = 20_000
#: n-grams' worth of raw corpus that the target is smoothed with.
PRIOR = 50_000
REPEAT = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LEAD = np.ones(256, dtype=bool)  # bytes that begin a code point
_LEAD[0x80:0xC0] = False


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs twice or more."""
    _, at, n = np.unique(keys, return_inverse=True, return_counts=True)
    return n[at] > 1


def surface(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    n = len(offs) - 1
    s, e, first = spans(data, offs, NOT_BLANK)
    chars = per_text(NOT_BLANK[data] & _LEAD[data], offs)
    symbols = per_text(_SYMBOL[data], offs)

    ls, le, lfirst = lines(data, offs)
    full = line_words(data, offs, ls, le) > 0
    owner = np.repeat(np.arange(n), np.diff(lfirst))[full]
    keys = line_hashes(data, ls, le)[full] ^ mix(owner.astype(np.uint64))
    dup = np.bincount(owner, minlength=n) - np.bincount(owner[np.unique(keys, return_index=True)[1]], minlength=n)

    word_owner = np.repeat(np.arange(n), np.diff(first))
    gram = grams(span_hashes(data, s, e), REPEAT)
    inside = word_owner[: len(gram)] == word_owner[REPEAT - 1 :] if len(gram) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    at = at[_repeated(gram[at] ^ mix(word_owner[at].astype(np.uint64)))]
    cover = np.zeros(len(s) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + REPEAT, -1)
    repeat = per_text(np.cumsum(cover[:-1]) > 0, first)
    return [np.diff(first), chars, symbols, dup, repeat]


def fit(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """log p_target - log p_raw of each bucket. ``trusted``: (doc_id), ids of trusted documents.

    The raw counts are over all rows; without trusted documents every ratio is 0.
    """
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    known = np.sort(np.array([r[0] for r in ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRUSTED).collect()], np.int64))

    def add(batch: pa.RecordBatch, sums: dict[str, np.ndarray]) -> None:
        for part in steps(iter([batch]), "text"):
            data, offs = utf8(part.column("text"))
            at = bucketed(data, offs, WIDTH, BITS)
            good = np.isin(part.column("doc_id").fill_null(-1).to_numpy(), known) & part.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            for name, values in (("raw", at), ("target", at[np.repeat(good, np.diff(offs))])):
                sums[name] = sums.get(name, np.zeros(BUCKETS, np.int64)) + np.bincount(values, minlength=BUCKETS)

    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = table(histogram(two, add, BUCKETS), BUCKETS)
    raw, target = counts.get("raw", np.zeros(BUCKETS)), counts.get("target", np.zeros(BUCKETS))
    if not target.sum():
        return np.zeros(BUCKETS)
    p_raw = (raw + 1) / (raw.sum() + BUCKETS)
    return np.log((target + PRIOR * p_raw) / (target.sum() + PRIOR)) - np.log(p_raw)


def _measured(texts: pa.Array, ratio: np.ndarray) -> list[np.ndarray]:
    """The surface counts and the score of each text."""
    data, offs = utf8(texts)
    return [*surface(data, offs), per_text(ratio[bucketed(data, offs, WIDTH, BITS)], offs) / np.maximum(1, np.diff(offs))]


def _failed(n_words, n_repeat_words):
    """Whether the counts fail: of columns or arrays."""
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


_OUT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"


def scored(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, the surface counts, score): one row per row of ``docs``, repeated rows each for itself; a null or empty text scores 0.

    An empty table gives an empty table; other columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            names = ["doc_id", *(x.split()[0] for x in _OUT.split(", "))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, _measured(batch.column("text"), ratio))], names)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {_OUT}")


def judged(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``scored`` with base_failed and kept: one row per row of ``docs``.

    base_failed: fewer than ``MIN_WORDS`` words, or over ``MAX_REPEAT_PERCENT`` per cent of the words in repeated windows. kept: not
    base_failed, and a score of ``threshold`` or more. A null text has no words and fails. Repeated rows are judged each
    for itself; an empty table gives an empty table; other columns are ignored.
    """
    failed = _failed(F.col("n_words"), F.col("n_repeat_words"))
    rows = scored(docs, fit(docs, trusted, id_col, text_col), id_col, text_col).withColumn("base_failed", failed)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def kept(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, all columns kept: a filter in place, without a shuffle.

    Repeated rows are judged alike; a null text goes; an empty table gives an empty table.
    """
    ratio = fit(docs, trusted, id_col, text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text_col):
            n_words, _, _, _, repeat, score = _measured(batch.column(text_col), ratio)
            yield batch.filter(pa.array(~_failed(n_words, repeat) & (score >= threshold)))

    return docs.mapInArrow(work, docs.schema)
