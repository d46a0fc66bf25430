"""Deletion of repeated passages by winnowing.

Hashes of whole lines cannot see a passage that begins or ends in the middle of a line, so the items are parts of
lines: the stretches of ``PART`` words that begin at each word, over line ends too. A window is ``MIN_WORDS`` consecutive
words; of the parts within it the one of the smallest hash is its fingerprint. Equal windows have equal fingerprints
at equal places, so every passage that stands in two places holds a fingerprint that both share.

Fingerprints are joined over the whole corpus, and those of one place only are gone. From every other one the match is
extended to both sides: each window that it is the fingerprint of, from the one that reaches furthest to the left
to the one that reaches furthest to the right, is joined with the first place of its words. What an earlier place
holds as well is deleted. Overlapping windows run together, so that a deleted passage is the longest possible
match to the word, while no pair of places is ever formed but (place, first place).
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from kasane.llm.keyed import bit_field, bits_of, same_row, slots, without_rows
from kasane.llm.textbytes import NOT_BLANK, grams, mix, span_hashes, spans, steps, utf8
from kasane.plans.staging import BROADCAST_ROWS, release, sized, stage

#: Words of the shortest passage that is deleted: over 50.
MIN_WORDS = 51
#: Words of a part, the item that is hashed.
PART = 8
#: Bits of the largest field of shared fingerprints that is sent to every task; where 16 bits a fingerprint need more, places are joined to texts.
MOST_BITS = 1 << 25
#: Low bits of a key that hold a place, so that the smallest key tells where it stands.
_PLACE = (1 << 28) - 1


def fingerprint_places(hashes: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parts, windows, places): hash of the part from each word; first word of every window within one text; where its fingerprint begins.

    Of equal hashes in a window the rightmost counts.
    """
    size = min(PART, least)
    part, width, n = grams(hashes, size), least - size + 1, len(hashes) - least + 1
    if n <= 0:
        return part, np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = (part & np.uint64(~_PLACE & (1 << 64) - 1)) | (_PLACE - np.arange(len(part))).astype(np.uint64)
    reach = 1
    while 2 * reach <= width:  # the smallest of 2, 4, ... keys
        key = np.minimum(key[: len(key) - reach], key[reach:])
        reach *= 2
    key = np.minimum(key[:n], key[width - reach : width - reach + n])
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = np.flatnonzero(owner[:n] == owner[least - 1 :])
    return part, whole, _PLACE - (key[whole] & np.uint64(_PLACE)).astype(np.int64)


def _sums(hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Polynomials of hashes[lo[i]:hi[i]]."""
    base = 0x9E3779B97F4A7C15 | 1
    power, back = np.full(len(hashes) + 1, base, np.uint64), np.full(len(hashes) + 1, pow(base, -1, 1 << 64), np.uint64)
    power[0] = back[0] = 1
    power, back = np.multiply.accumulate(power), np.multiply.accumulate(back)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * power[:-1], out=sums[1:])
    return (sums[hi] - sums[lo]) * back[lo]


def window_hashes(hashes: np.ndarray, starts: np.ndarray, least: int) -> np.ndarray:
    """A hash of the ``least`` words from each start, in order."""
    return mix(_sums(hashes, starts, starts + least))


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offs = utf8(texts)
    s, e, first = spans(data, offs, NOT_BLANK)
    return span_hashes(data, s, e), first


def _whole_texts(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of all words of each text, in order."""
    return mix(_sums(hashes, first[:-1], first[1:]) ^ np.diff(first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _rows(batch: pa.RecordBatch, own: np.ndarray, **values: np.ndarray) -> pa.RecordBatch:
    """A row for each of ``own``, the places of the texts in the batch."""
    at = pa.array(own)
    return pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("text_hash").take(at), *map(pa.array, values.values())], ["doc_id", "text_hash", *values])


def _selected(least: int):
    """Fingerprints of every text, and a row for the whole text: its hash, and its number of words less than 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            hashes, first = _words(batch.column("text"))
            part, _, at = fingerprint_places(hashes, first, least)
            at = np.unique(at)
            own = np.searchsorted(first, at, "right") - 1
            long = np.flatnonzero(np.diff(first) >= least)
            fp = np.concatenate([part[at], _whole_texts(hashes, first)[long]]).view(np.int64)
            yield _rows(batch, np.concatenate([own, long]), fp=fp, start=np.concatenate([at - first[own], -np.diff(first)[long]]).astype(np.int32))

    return work


def _windows(batch: pa.RecordBatch, least: int, shared) -> pa.RecordBatch:
    """The windows of each text whose fingerprint is shared. ``shared``: of (fingerprints, their places, first word of each text), whether it is."""
    hashes, first = _words(batch.column("text"))
    part, window, at = fingerprint_places(hashes, first, least)
    good = shared(part[at], at, first)
    window, at = window[good], at[good]
    own = np.searchsorted(first, window, "right") - 1
    run = (window_hashes(hashes, window, least) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return _rows(batch, own, fp=part[at].view(np.int64), run=run, start=(window - first[own]).astype(np.int32))


_DOC = "doc_id long, text_hash long"
_WINDOW = f"{_DOC}, fp long, run int, start int"


def _windows_by_field(rows: DataFrame, common: DataFrame, least: int, bits: int) -> DataFrame:
    """Windows of shared fingerprints (and of a few others), told by a bit field that goes to every task."""
    field = rows.sparkSession.sparkContext.broadcast(bit_field(common, "fp", bits))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bits_of(field.value)
        for batch in steps(batches, "text"):
            yield _windows(batch, least, lambda fp, at, first: known[slots(fp, bits)])

    return rows.mapInArrow(work, _WINDOW)


def _windows_by_join(rows: DataFrame, prints: DataFrame, common: DataFrame, least: int) -> DataFrame:
    """Windows of shared fingerprints, whose places are joined to the texts."""
    met = prints.join(common, "fp", "left_semi").groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(F.collect_set("start").alias("met"))
    both = rows.join(met, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))).drop("__id", "__hash")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            met = batch.column("met")
            own = np.repeat(np.arange(len(met)), np.diff(np.asarray(met.offsets)))

            def shared(fp: np.ndarray, at: np.ndarray, first: np.ndarray, met=met, own=own) -> np.ndarray:
                known = np.zeros(first[-1] + 1, bool)
                known[first[own] + np.asarray(met.flatten())] = True
                return known[at]

            yield _windows(batch, least, shared)

    return both.mapInArrow(work, _WINDOW)


_MERGED = """
aggregate(runs, cast(array() AS array<struct<start: int, end: int>>), (done, x) ->
  if(size(done) > 0 and x.start <= element_at(done, -1).end,
     concat(slice(done, 1, size(done) - 1), array(struct(element_at(done, -1).start AS start, greatest(element_at(done, -1).end, x.end) AS end))),
     concat(done, array(struct(x.start AS start, x.end AS end)))))
"""


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, runs): for each document that repeats an earlier place, the ranges of words (start, end exclusive) to delete.

    Words are cut at ASCII blanks and compared by hashes of their bytes (a window by those of its fingerprint and of its words,
    96 bits together). A word is in a range if it stands in ``min_words``
    consecutive words that stand at an earlier place as well. Documents are ordered by id (null first), then text hash; a
    window of the document itself is earlier only if it ends before. Rows equal in id and text are one document. Null,
    blank and short texts repeat nothing; an empty table gives an empty table; other columns are ignored.

    A text that has the words of an earlier one is a range of its own and takes no part in the search for windows.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash")).where("text is not null")
    prints = stage(rows.mapInArrow(_selected(min_words), f"{_DOC}, fp long, start int"), "fingerprints")
    wholes, doc = prints.where("start < 0"), F.struct("doc_id", "text_hash")
    firsts = stage(wholes.groupBy("fp", "start").agg(F.min(doc).alias("lo"), F.max(doc).alias("hi")).where("lo <> hi").select("fp", "start", "lo"), "wholes")
    copies = stage(wholes.join(firsts, ["fp", "start"]).where("not (doc_id <=> lo.doc_id and text_hash = lo.text_hash)").selectExpr("doc_id", "text_hash", "0 AS start", "-start AS end"), "copies")
    if copies.count() <= BROADCAST_ROWS:  # else they are searched as well, to the same result
        rows, prints_left = without_rows(rows, copies, "doc_id", "text"), prints.where("start >= 0").join(F.broadcast(copies.select("doc_id", "text_hash")), ["doc_id", "text_hash"], "left_anti")
    else:
        prints_left = prints.where("start >= 0")
    at = F.struct("text_hash", "doc_id", "start")
    common = stage(prints_left.groupBy("fp").agg(F.min(at).alias("lo"), F.max(at).alias("hi")).where("lo <> hi").select("fp"), "common")
    bits = 1 << max(16, (16 * common.count() - 1).bit_length())
    if bits <= MOST_BITS:
        found = _windows_by_field(rows, common, min_words, bits)
    else:
        found = _windows_by_join(rows, prints_left, common, min_words)
    found = stage(found, "windows")
    release(prints, firsts, common)
    at = F.struct("doc_id", "text_hash", "start")
    firsts = stage(found.groupBy("fp", "run").agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "firsts")
    later = found.join(firsts, ["fp", "run"]).where(f"not (doc_id <=> first.doc_id and text_hash = first.text_hash and start < first.start + {min_words})")
    later = later.selectExpr("doc_id", "text_hash", "start", f"start + {min_words} AS end").union(copies)
    runs = later.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("runs"))
    out = stage(runs.select("doc_id", "text_hash", F.expr(_MERGED).alias("runs")), "runs")
    release(found, firsts, copies)
    return out


def without(text: str, runs: list[tuple[int, int]]) -> str:
    """``text`` less the words of ``runs``, and the blanks on one side of each run.

    A run that begins a line takes the blanks behind it along, another that ends a line (or the text) those before it.
    """
    data = np.frombuffer(text.encode(), np.uint8)
    s, e, _ = spans(data, np.array([0, len(data)]), NOT_BLANK)
    out, at = [], 0
    for lo, hi in runs:
        before, behind = int(e[lo - 1]) if lo else 0, int(s[hi]) if hi < len(s) else len(data)
        leads = not lo or b"\n" in data[before : s[lo]].tobytes()
        ends = hi == len(s) or b"\n" in data[e[hi - 1] : behind].tobytes()
        begin, end = (int(s[lo]), behind) if (leads and hi < len(s)) or not ends else (before, behind if hi == len(s) else int(e[hi - 1]))
        out.append(data[at : max(at, begin)].tobytes())
        at = max(at, end)
    out.append(data[at:].tobytes())
    return b"".join(out).decode()


@F.pandas_udf(StringType())
def _without(texts: pd.Series, runs: pd.Series) -> pd.Series:
    """New texts of documents with runs, given as start, end, start, ...; null for all others, whose text is not sent."""
    return pd.Series([None if t is None or r is None else without(t, [*itertools.batched(map(int, r), 2)]) for t, r in zip(texts, runs, strict=True)], dtype=object)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later repeats of passages deleted from the text, and a column ``deleted_runs`` (ranges of words, null if none).

    All columns and rows are kept, in their order of columns; a text that repeats earlier ones whole becomes empty.
    A null text stays null; an empty table gives an empty table; repeated rows are treated alike. A column named
    deleted_runs is replaced. Which words count as repeated is told at ``repeated_runs``.
    """
    runs = repeated_runs(docs, id_col, text_col, min_words)
    runs = sized(runs, BROADCAST_ROWS, "1 + size(runs)")
    runs = runs.select(F.col("doc_id").alias("__key_id"), F.col("text_hash").alias("__key_hash"), F.col("runs").alias("__runs"))
    joined = docs.join(runs, same_row(docs, runs, id_col, text_col), "left").drop("__key_id", "__key_hash")
    if "deleted_runs" in docs.columns:
        joined = joined.drop("deleted_runs")
    whole = F.col(text_col)
    cut = _without(F.when(F.col("__runs").isNotNull(), whole.cast("string")), F.expr("flatten(transform(__runs, r -> array(r.start, r.end)))"))
    kept = [c for c in docs.columns if c != "deleted_runs"]
    joined = joined.withColumn("__new", cut)
    new = F.when(F.col("__runs").isNull(), whole).otherwise(F.col("__new").cast(docs.schema[text_col].dataType))
    return joined.select(*(new.alias(c) if c == text_col else F.col(c) for c in kept), F.col("__runs").alias("deleted_runs"))
