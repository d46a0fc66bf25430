"""SimHash near-duplicates: fingerprints, a byte-position inverted index with count filtering, and groups.

Two fingerprints that differ in at most ``MAX_BITS`` = 2 bits agree in at least ``MIN_BYTES`` = 6 of their eight positional
bytes. Postings of single bytes would each hold a 256th of all fingerprints, and most of the pairs that meet there
would fail the count. So a posting names the guaranteed minimum at once: six positions and the six bytes that
stand there, for each of the 28 choices of six positions. Two fingerprints that meet in a posting are known to share
six positional bytes; a pair that shares fewer never meets, and one that may be linked always does.

In a posting only the two bytes at the other positions tell its entries apart, so it holds 65,536 entries at the most,
however many texts are near copies. There the tally of shared bytes is finished and pairs are verified: every entry is
looked up under the 136 values that differ from its own in one or two bits, so the work grows with the entries
and not with their pairs.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kasane.llm.keyed import with_rows, without_rows
from kasane.llm.textbytes import steps
from kasane.plans.components import connected_components
from kasane.plans.staging import stage

SHINGLE = 3
MAX_BITS = 2
MIN_BYTES = 8 - MAX_BITS
#: Shingles whose bits are counted at once.
PIECE = 1 << 15

_hash = functools.partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text; 0 where it has no word."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, PIECE):
        part = words[at : min(at + PIECE, n) + width - 1]
        shingles = zip(*(part[j:] for j in range(width)), strict=False) if len(part) >= width else [part]
        h = np.fromiter(map(_hash, map(b" ".join, shingles)), np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "text"):
        values = np.array([fingerprint(t) for t in batch.column("text").cast(pa.binary()).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values.view(np.int64)), batch.column("text_hash")], ["doc_id", "fp", "text_hash"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, text_hash): one row per row of ``docs``, fp as a signed 64-bit number."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    return rows.mapInArrow(_fingerprints, "doc_id long, fp long, text_hash long")


#: The choices of six positions, as (fixed positions, the two others), and the differences of one or two bits in the others.
_FIXED = [[i for i in range(8) if i not in two] for two in itertools.combinations(range(8), MAX_BITS)]
_FREE = [list(two) for two in itertools.combinations(range(8), MAX_BITS)]
_NEAR = np.array([1 << i for i in range(16)] + [1 << i | 1 << j for i, j in itertools.combinations(range(16), 2)], np.int64)


def _byte(position: int) -> str:
    return f"(shiftrightunsigned(fp, {8 * position}) & 255)"


def _packed(positions: list[int]) -> str:
    return " | ".join(f"({_byte(p)} << {8 * k})" for k, p in enumerate(positions))


def postings(fps: DataFrame) -> DataFrame:
    """(choice, six, rest): every fingerprint under each choice of six positions; six: the bytes there, rest: the two other bytes."""
    entries = [f"struct({k} AS choice, {_packed(fixed)} AS six, int({_packed(free)}) AS rest)" for k, (fixed, free) in enumerate(zip(_FIXED, _FREE, strict=True))]
    return fps.selectExpr(f"inline(array({', '.join(entries)}))")


def _unpacked(choice: np.ndarray, six: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The fingerprints of posting entries."""
    out = np.zeros(len(choice), np.uint64)
    fixed, free = np.array(_FIXED, np.uint64), np.array(_FREE, np.uint64)
    for table, packed in ((fixed, six), (free, rest)):
        for k in range(table.shape[1]):
            byte = (packed.astype(np.uint64) >> np.uint64(8 * k)) & np.uint64(255)
            out |= byte << (np.uint64(8) * table[choice, k])
    return out


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each posting within ``MAX_BITS`` bits, with the tally of shared bytes; every pair once over all postings."""
    for batch in batches:
        lists = batch.column("entries")
        n = np.diff(np.asarray(lists.offsets))
        own = np.repeat(np.arange(len(n)), n)
        key = np.sort(own << 16 | np.asarray(lists.flatten()).astype(np.int64))
        pairs = []
        for mask in _NEAR.tolist():
            other = key ^ mask
            at = np.minimum(np.searchsorted(key, other), max(len(key) - 1, 0))
            found = np.flatnonzero((key < other) & (key[at] == other)) if len(key) else np.zeros(0, np.int64)
            pairs.append(np.stack([key[found], other[found]], 1))
        a, b = np.concatenate(pairs).T
        lists_of = a >> 16
        choice, six = batch.column("choice").to_numpy(zero_copy_only=False)[lists_of], batch.column("six").to_numpy(zero_copy_only=False)[lists_of]
        u, v = _unpacked(choice, six, a & 0xFFFF), _unpacked(choice, six, b & 0xFFFF)
        equal = ((u ^ v)[:, None] >> (np.arange(8, dtype=np.uint64) * np.uint64(8))) & np.uint64(255) == 0
        tally = equal.sum(1)
        # of the postings in which a pair meets, that of the first choice answers for it: the choice whose six positions come first among the shared ones
        first = np.array([[i in fixed for i in range(8)] for fixed in _FIXED])
        able = (first[None, :, :] <= equal[:, None, :]).all(2)
        once = (tally >= MIN_BYTES) & (able.argmax(1) == choice)
        yield pa.RecordBatch.from_arrays([pa.array(u[once].view(np.int64)), pa.array(v[once].view(np.int64)), pa.array(tally[once])], ["u", "v", "shared"])


def links(fps: DataFrame) -> DataFrame:
    """(u, v, shared): every pair of fingerprints at most two bits apart, once, and how many positional bytes they share. ``fps``: fp, without repeats."""
    spread = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")  # a small table makes 28 times its rows
    lists = postings(spread).groupBy("choice", "six").agg(F.collect_list("rest").alias("entries")).where("size(entries) > 1")
    return lists.mapInArrow(_verified, "u long, v long, shared long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id, fp, text_hash): one row per row of ``docs``.

    Rows with one fingerprint are one node, named by their smallest id, so copies are never paired.
    component_id is the smallest id reachable over links of at most two differing bits. A null or blank text
    has fingerprint zero and is linked like any other. Null ids never name a group; a group of null ids alone
    has a null component_id. Repeated rows are returned as often as given. Other columns are ignored.
    """
    marked = stage(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    groups = stage(connected_components(links(nodes.select("fp"))), "groups")
    named = nodes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("group", F.coalesce("component", "fp"))
    least = named.groupBy("group").agg(F.min("least").alias("component_id"))
    moved = stage(named.select("fp", "group").join(least, "group").select("fp", "component_id"), "components")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return marked.join(moved, "fp").select("doc_id", hexed, "component_id", "fp", "text_hash")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", grouped: Callable[[DataFrame], DataFrame] = near_duplicates) -> DataFrame:
    """One row of ``docs`` for each group of near duplicates: that of the smallest id, all columns kept.

    Rows that share this id are told apart by their text (the smallest hash stays); repeated rows count once.
    Rows of null id are a group for each fingerprint that no row with an id is linked to. ``grouped`` gives the
    groups of (doc_id, text) as near_duplicates does. An empty table gives an empty table. Texts are not shuffled
    while the rows that go are few enough to be broadcast.
    """
    text = F.col(text_col).cast("string")
    light = stage(grouped(docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))).select("doc_id", "text_hash", "component_id", "fp"), "groups")
    heads = light.where("doc_id <=> component_id").withColumn("own", F.expr("if(component_id is null, fp, null)"))
    several = heads.groupBy("component_id", "own").agg(F.min("text_hash").alias("kept"), F.max("text_hash").alias("last")).where("kept <> last").drop("last")
    several = several.withColumnsRenamed({"component_id": "c", "own": "o"})
    beside = heads.join(several, F.expr("component_id <=> c and own <=> o")).where("text_hash <> kept")
    gone = stage(light.where("not (doc_id <=> component_id)").select("doc_id", "text_hash").union(beside.select("doc_id", "text_hash")).distinct(), "gone")
    more = stage(light.groupBy("doc_id", "text_hash").count().where("count > 1").select("doc_id", "text_hash"), "repeated")
    return _once(without_rows(docs, gone, id_col, text_col), more, id_col, text_col)


def _once(docs: DataFrame, repeated: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with one row for each id and text of ``repeated``."""
    if repeated.isEmpty():
        return docs
    again = with_rows(docs, repeated, id_col, text_col).dropDuplicates([id_col, text_col])
    return without_rows(docs, repeated, id_col, text_col).unionByName(again)
