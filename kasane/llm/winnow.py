"""Benchmark decontamination by winnowing.

Texts and benchmark items are cut into words; of every window of ``WINDOW`` consecutive k-grams of words the
smallest hash is kept, with its place. Windows of the same words keep the same fingerprint, so any span of
``SPAN`` = ``GRAM`` + ``WINDOW`` - 1 shared words holds one. Fingerprints of texts and items are joined and
each hit is extended word by word to both sides; spans of ``SPAN`` words or more count.

Items shorter than ``SPAN`` words have no full window: their whole word sequence is looked up as one gram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kasane.llm.keyed import bit_field, bits_of, slots, without_rows
from kasane.llm.textbytes import ALNUM, LOWER, grams, per_text, span_hashes, spans, steps, utf8, window_minima
from kasane.plans.staging import stage

SPAN = 10
GRAM = 5
WINDOW = SPAN - GRAM + 1


def words(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of a batch of texts, and the first word of each text (n + 1)."""
    data, offs = utf8(batch.column(column))
    data = LOWER[data]
    s, e, first = spans(data, offs, ALNUM)
    return span_hashes(data, s, e), first


def _owner(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def picked(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the winnowed ``GRAM``-grams; windows do not cross from one text to the next."""
    if len(hashes) < SPAN:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    gram = grams(hashes, GRAM)
    owner = _owner(first)
    whole = owner[: len(hashes) - SPAN + 1] == owner[SPAN - 1 :]
    at = window_minima(gram, WINDOW, whole)
    return at, gram[at]


def _around(hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
    """hashes[lo[i]:hi[i]] as a list column."""
    n = hi - lo
    ends = np.zeros(len(n) + 1, np.int32)
    np.cumsum(n, out=ends[1:])
    flat = np.repeat(lo - ends[:-1], n) + np.arange(ends[-1])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[flat].view(np.int64)))


_HIT = pa.struct([("key", pa.int64()), ("start", pa.int64()), ("lead", pa.int32()), ("near", pa.list_(pa.int64()))])
_HIT_SQL = "array<struct<key: bigint, start: bigint, lead: int, near: array<bigint>>>"


def _hits(batch: pa.RecordBatch, hashes: np.ndarray, first: np.ndarray, lengths: list[int], wanted: np.ndarray | None) -> pa.Array:
    """Per text its fingerprints, each with the words around it: as many on each side as a span through it can hold.

    ``lengths``: of the short items, whose grams are all looked up; ``wanted``: the filter, or None to keep all.
    """
    owner = _owner(first)
    at, key = picked(hashes, first)
    lo, hi = np.maximum(first[owner[at]], at - (WINDOW - 1)), np.minimum(first[owner[at] + 1], at + SPAN)
    parts = [(at, key, lo, hi)]
    for n in lengths:
        gram = grams(hashes, n, salt=n)
        one = np.flatnonzero(owner[: len(gram)] == owner[n - 1 :]) if len(gram) else np.zeros(0, np.int64)
        parts.append((one, gram[one], one, one + n))
    at, key, lo, hi = (np.concatenate(x) for x in zip(*parts, strict=True))
    if wanted is not None:
        kept = np.flatnonzero(wanted[slots(key)])
        at, key, lo, hi = at[kept], key[kept], lo[kept], hi[kept]
    order = np.argsort(owner[at], kind="stable") if len(at) else np.zeros(0, np.int64)
    at, key, lo, hi = at[order], key[order], lo[order], hi[order]
    own = owner[at]
    flat = pa.StructArray.from_arrays([pa.array(key.view(np.int64)), pa.array(at - first[own]), pa.array((at - lo).astype(np.int32)), _around(hashes, lo, hi)], fields=list(_HIT))
    ends = np.searchsorted(own, np.arange(len(first))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), flat)


def _of_texts(lengths: list[int], wanted: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bits_of(wanted)
        for batch in steps(batches, "text"):
            hashes, first = words(batch)
            hits = _hits(batch, hashes, first, lengths, bits)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(np.diff(first)), hits], ["doc_id", "text_hash", "n_words", "hits"])

    return run


def _of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items of ``SPAN`` words or more are winnowed; a shorter one has a single entry, its whole sequence."""
    for batch in steps(batches, "text"):
        hashes, first = words(batch)
        n = np.diff(first)
        hits = _hits(batch, hashes, first, [], None).to_pylist()
        for i in np.flatnonzero((n > 0) & (n < SPAN)):
            own = hashes[first[i] : first[i + 1]]
            hits[i] = [{"key": int(grams(own, len(own), salt=len(own)).view(np.int64)[0]), "start": 0, "lead": 0, "near": own.view(np.int64).tolist()}]
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(n), pa.array(hits, pa.list_(_HIT))], ["item_id", "n_words", "hits"])


_RUN = """
aggregate(sequence(1, {n}), 0, (run, i) -> if(run = i - 1 and {a} = {b}, i, run))
"""


def _extended(found: DataFrame) -> DataFrame:
    """Length of the match on each side of a joined fingerprint: words agree from its start to the right, and before it to the left."""
    right = _RUN.format(n="greatest(1, least(size(d_near) - d_lead, size(i_near) - i_lead))", a="try_element_at(d_near, d_lead + i)", b="try_element_at(i_near, i_lead + i)")
    left = _RUN.format(n="greatest(1, least(d_lead, i_lead))", a="if(i > d_lead, null, try_element_at(d_near, greatest(1, d_lead + 1 - i)))", b="if(i > i_lead, null, try_element_at(i_near, greatest(1, i_lead + 1 - i)))")
    return found.selectExpr("rid", "d_start", "entry", "least_words", f"{right} AS to_right", f"{left} AS to_left")


def contaminated_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, spans, items): one row per row of ``docs``.

    spans: the merged word spans (start, end exclusive) that any window of an item covers, in order;
    items: the ids, as strings, of the items with a window in the text, sorted. Null texts have no words. Repeated
    rows and items are each answered for themselves; a null item id counts as an item and appears in no list.
    Other columns are ignored. Words are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    bench = items.select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    shaped = stage(bench.mapInArrow(_of_items, f"item_id string, n_words long, hits {_HIT_SQL}"), "items")
    entries = shaped.select("item_id", "n_words", F.inline("hits"))
    lengths = [r[0] for r in shaped.where(f"n_words between 1 and {SPAN - 1}").select("n_words").distinct().collect()]
    wanted = spark.sparkContext.broadcast(bit_field(entries))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _of_texts(sorted(lengths), wanted.value)(batches)

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    marked = rows.mapInArrow(texts, f"doc_id {kind}, text_hash long, n_words long, hits {_HIT_SQL}")
    marked = stage(marked.withColumn("rid", F.monotonically_increasing_id()), "fingerprints")

    # Items that share a fingerprint and the words around it are one entry, so a common passage is compared once.
    least = F.least("n_words", F.lit(SPAN)).alias("least_words")
    index = entries.groupBy("key", F.col("lead").alias("i_lead"), F.col("near").alias("i_near"), least).agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    index = stage(index.withColumn("entry", F.monotonically_increasing_id()), "index")
    seen = marked.where("size(hits) > 0").select("rid", F.inline("hits")).withColumnsRenamed({"start": "d_start", "lead": "d_lead", "near": "d_near"})
    found = _extended(seen.join(index.drop("ids"), "key")).where("to_left + to_right >= least_words")
    per_doc = found.groupBy("rid").agg(
        F.sort_array(F.collect_set(F.expr("struct(d_start - to_left AS start, d_start + to_right AS end)"))).alias("runs"),
    )
    merged = per_doc.select(
        "rid",
        F.expr(
            """aggregate(runs, array(struct(-1L AS start, -1L AS end)), (done, x) ->
                 if(x.start <= element_at(done, -1).end,
                    concat(slice(done, 1, size(done) - 1), array(struct(element_at(done, -1).start AS start, greatest(element_at(done, -1).end, x.end) AS end))),
                    concat(done, array(struct(x.start AS start, x.end AS end)))),
                 done -> filter(done, x -> x.start >= 0))"""
        ).alias("spans"),
    )
    named = found.select("rid", "entry").distinct().join(index.select("entry", F.explode("ids").alias("item")), "entry")
    named = named.groupBy("rid").agg(F.sort_array(F.collect_set("item")).alias("items"))
    out = marked.drop("hits").join(merged, "rid", "left").join(named, "rid", "left")
    spans_or_none = "coalesce(spans, cast(array() AS array<struct<start: bigint, end: bigint>>))"
    return out.selectExpr(
        "doc_id",
        "text_hash",
        "n_words",
        f"aggregate({spans_or_none}, 0L, (n, x) -> n + x.end - x.start) AS n_hit",
        f"{spans_or_none} AS spans",
        "coalesce(items, cast(array() AS array<string>)) AS items",
    )


def decontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, all columns kept. Rows are told by id and text together.

    Null, blank and repeated rows stay as they are; an empty table on either side drops nothing.
    """
    hit = contaminated_spans(docs, items, id_col, text_col).where("n_hit > 0").select(F.col("doc_id").cast("long").alias("doc_id"), "text_hash")
    return without_rows(docs, stage(hit.distinct(), "hit"), id_col, text_col)
