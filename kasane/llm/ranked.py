"""Ranked lexical search by block-max pruning over a forward index.

Documents stand in blocks of ``BLOCK`` in the order of the table. A block is one row of the index: its documents with
their lengths, the words each of them holds with their counts (the forward index), and for every word of the block
the largest count and the smallest length of a document that holds it. From these two follows a bound of what the
word can add to a score in the block, whatever the statistics of the corpus, so an index need not be built anew when they change.

A search reads the bounds first. For each query the ``SEEDS`` blocks of highest bound are scored and give a first threshold,
the score of the last rank. Then every task sorts its blocks by the bound of a query, scores them in this order and stops
where the bound drops below the threshold, which rises with what the task finds. Documents that no bound rules out are
all scored, so the result is that of scoring every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kasane.llm.keyed import bit_field, bits_of, slots
from kasane.llm.textbytes import ALNUM, LOWER, give_back, span_hashes, spans, steps, utf8
from kasane.plans.staging import stage

TOP = 50
#: Documents of a block.
BLOCK = 32
#: Blocks of highest bound that give a query its first threshold.
SEEDS = 8
#: Words of queries that go to every task at once; more queries are searched in further rounds over the same index.
ROUND_WORDS = 200_000
#: Words that a query counts for at least, so that a round has ROUND_WORDS / LEAST_WORDS queries at most.
LEAST_WORDS = 40

_INDEX = """block long, n_docs long, n_words long, ids array<long>, lengths array<long>, ends array<int>, places array<int>, counts array<int>,
words array<long>, holders array<int>, most array<int>, least array<long>"""
_BOUNDS = ("block", "words", "most", "least")
_FOUND = "query long, doc_id long, score long"


class Queries(NamedTuple):
    """Words of a round of queries: sorted hashes with weights, and for each query which of them it has."""

    words: np.ndarray
    weights: np.ndarray
    query: np.ndarray
    first: np.ndarray
    at: np.ndarray


class Corpus(NamedTuple):
    """Documents with a word, and all their words."""

    docs: int
    words: int


def _held(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, word, count) of each different word of each text, in order of owner and word, and the lengths of all texts in words."""
    data, offs = utf8(batch.column(column))
    data = LOWER[data]
    s, e, first = spans(data, offs, ALNUM)
    lengths = np.diff(first)
    owner, word = np.repeat(np.arange(len(lengths)), lengths), span_hashes(data, s, e)
    order = np.lexsort((word, owner))
    owner, word = owner[order], word[order]
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (word[1:] != word[:-1])])[: len(owner)])
    return owner[new], word[new], np.diff(np.append(new, len(owner))), lengths


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values).cast(kind))


def _block(ids: list, lengths: np.ndarray, owner: np.ndarray, word: np.ndarray, count: np.ndarray) -> tuple:
    """One block, in the order of ``_SCHEMA``: ``owner`` counts from its first document."""
    words, place = np.unique(word.view(np.int64), return_inverse=True)
    order = np.argsort(place, kind="stable")
    start = np.searchsorted(place[order], np.arange(len(words)))
    holders = np.diff(np.append(start, len(place)))
    most = np.maximum.reduceat(count[order], start) if len(words) else count
    least = np.minimum.reduceat(lengths[owner][order], start) if len(words) else lengths[:0]
    return int((lengths > 0).sum()), int(lengths.sum()), ids, lengths, np.searchsorted(owner, np.arange(len(lengths)), "right"), place, count, words, holders, most, least


def _columns(blocks: list[tuple]) -> pa.RecordBatch:
    """Blocks as rows; numbers that fit are narrowed before they leave."""
    narrow = lambda x, kind: x.astype(kind.value_type.to_pandas_dtype()) if isinstance(x, np.ndarray) else x
    made = [pa.array([narrow(x, f.type) if pa.types.is_list(f.type) else x for x in column], f.type) for f, column in zip(_SCHEMA, zip(*blocks), strict=True)]
    return pa.RecordBatch.from_arrays(made, schema=_SCHEMA)


def index(docs: DataFrame, wanted: bytes | None = None, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The staged forward index of all rows of ``docs``, one row a block; with ``wanted`` (a bit field of word hashes) of these words only.

    Words are maximal runs of ASCII letters and digits and of other characters than ASCII, A-Z lower-cased; lengths count all of them.
    A null text has none. Repeated rows and null ids are documents like others; an empty table gives an empty index. Other columns are ignored.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bits_of(sent.value) if sent.value is not None else None
        for batch in steps(batches, "text"):
            owner, word, count, lengths = _held(batch, "text")
            if known is not None:
                kept = known[slots(word)]
                owner, word, count = owner[kept], word[kept], count[kept]
            ids, made = batch.column("doc_id"), []
            for lo in range(0, len(lengths), block):
                hi = min(lo + block, len(lengths))
                a, b = np.searchsorted(owner, [lo, hi])
                made.append(_block(ids[lo:hi].to_pylist(), lengths[lo:hi], owner[a:b] - lo, word[a:b], count[a:b]))
            yield _columns(made)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    plain = ", ".join(x.strip() for x in _INDEX.split(",")[1:])
    return stage(rows.mapInArrow(run, plain).select(F.monotonically_increasing_id().alias("block"), "*"), "blocks")


_KINDS = {"long": pa.int64(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
_SCHEMA = pa.schema([(x.split()[0], _KINDS[x.split()[1]]) for x in _INDEX.split(",")[1:]])


def impact(count: np.ndarray, length: np.ndarray, corpus: Corpus) -> np.ndarray:
    """What ``count`` occurrences in a text of ``length`` words are worth, before the word's weight; it rises with count and falls with length."""
    if len(length) and int(length.max()) * 50 * corpus.docs >= 1 << 63:
        m = np.array([50 + 50 * int(n) * corpus.docs // corpus.words for n in length], np.int64)
    else:
        m = 50 + (50 * length * corpus.docs) // max(corpus.words, 1)
    return (1_000_000_000 * count.astype(np.int64)) // (1000 * count.astype(np.int64) + 20 * m)


def _row(batch: pa.RecordBatch, name: str, i: int) -> np.ndarray:
    return batch.column(name)[i].values.to_numpy(zero_copy_only=False)


def _met(words: np.ndarray, asked: Queries) -> tuple[np.ndarray, np.ndarray]:
    """Places in the block and in the queries' words of the words they share."""
    at = np.searchsorted(asked.words, words)
    at[at == len(asked.words)] = 0
    here = np.flatnonzero(asked.words[at] == words) if len(asked.words) else np.zeros(0, np.int64)
    return here, at[here]


def bounds(batch: pa.RecordBatch, asked: Queries, corpus: Corpus) -> np.ndarray:
    """Blocks x queries: no document of the block scores more for the query."""
    out = np.zeros((batch.num_rows, len(asked.query)), np.int64)
    for i in range(batch.num_rows):
        here, at = _met(_row(batch, "words", i), asked)
        worth = np.zeros(len(asked.words), np.int64)
        worth[at] = asked.weights[at] * impact(_row(batch, "most", i)[here], _row(batch, "least", i)[here], corpus)
        sums = np.zeros(len(asked.at) + 1, np.int64)
        np.cumsum(worth[asked.at], out=sums[1:])
        out[i] = sums[asked.first[1:]] - sums[asked.first[:-1]]
    return out


class _Scorer:
    """Scores the documents of one block for any query; what the block's counts are worth is worked out once."""

    def __init__(self, batch: pa.RecordBatch, i: int, asked: Queries, corpus: Corpus) -> None:
        self.ids, ends = batch.column("ids")[i].values.to_pylist(), _row(batch, "ends", i)
        self.asked, place, lengths = asked, _row(batch, "places", i), _row(batch, "lengths", i)
        owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        here, at = _met(_row(batch, "words", i), asked)
        known = np.full(len(batch.column("words")[i]), -1)
        known[here] = at
        used = known[place] >= 0
        self.word, count, self.owner = known[place][used], _row(batch, "counts", i)[used], owner[used]
        self.ends = np.searchsorted(self.owner, np.arange(len(ends) + 1))
        self.worth = asked.weights[self.word] * impact(count, lengths[self.owner], corpus)
        self.mine = np.zeros(len(asked.words), bool)

    def scores(self, q: int) -> np.ndarray:
        at = self.asked.at[self.asked.first[q] : self.asked.first[q + 1]]
        self.mine[at] = True
        sums = np.zeros(len(self.worth) + 1, np.int64)
        np.cumsum(np.where(self.mine[self.word], self.worth, 0), out=sums[1:])
        self.mine[at] = False
        return sums[self.ends[1:]] - sums[self.ends[:-1]]


class _Best:
    """The highest scores of one query in one task, ties to the smaller id, null ids last."""

    def __init__(self, top: int, threshold: int) -> None:
        self.top, self.threshold, self.rows = top, threshold, []

    def add(self, ids: list, scores: np.ndarray) -> None:
        good = np.flatnonzero((scores > 0) & (scores >= self.threshold))
        if len(good):
            self.rows = sorted([*self.rows, *((-int(scores[i]), ids[i] is None, ids[i]) for i in good)], key=lambda r: (r[0], r[1], r[2] or 0))[: self.top]
            if len(self.rows) == self.top:
                self.threshold = max(self.threshold, -self.rows[-1][0])


def _scored(batches: Iterator[pa.RecordBatch], asked: Queries, corpus: Corpus, least: np.ndarray, top: int, only: dict | None = None) -> Iterator[pa.RecordBatch]:
    """The best documents of a task for each query, blocks in order of bound; ``only``: the queries of each block that are scored at all."""
    best = [_Best(top, int(x)) for x in least]
    for batch in batches:
        limit = bounds(batch, asked, corpus)
        if only is not None:
            names = batch.column("block").to_pylist()
            limit = np.where([np.isin(asked.query, only.get(b, [])) for b in names], limit, 0)
        made: dict[int, _Scorer] = {}
        for q in np.flatnonzero((limit >= np.maximum(least, 1)).any(axis=0)):
            for i in np.argsort(-limit[:, q], kind="stable"):
                if limit[i, q] < max(best[q].threshold, 1):
                    break
                if i not in made:
                    made[i] = _Scorer(batch, i, asked, corpus)
                best[q].add(made[i].ids, made[i].scores(q))
    rows = [(int(asked.query[q]), doc, -score) for q, b in enumerate(best) for score, _, doc in b.rows]
    give_back()
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["query", "doc_id", "score"])


def _ranked(found: DataFrame, top: int, salts: int = 64) -> DataFrame:
    """The ``top`` rows of each query with their rank; first by groups of tasks, so that no task holds what all tasks found for a query."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = Window.partitionBy("query", F.col("salt")).orderBy(*order)
    fewer = found.withColumn("salt", F.spark_partition_id() % salts).withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    return fewer.drop("salt").withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= top)


def query_words(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(query, item_id, words): each row of ``items`` under a number of its own, with the hashes of its different words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            owner, word, _, lengths = _held(batch, "text")
            ends = np.searchsorted(owner, np.arange(len(lengths) + 1))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), _lists(word.view(np.int64), ends, pa.int64())], ["item_id", "words"])

    rows = items.select(F.col(item_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()
    return stage(rows.mapInArrow(run, f"item_id {kind}, words array<long>").withColumn("query", F.monotonically_increasing_id()), "queries")


def _rounds(queries: DataFrame, most: int) -> list[DataFrame]:
    """The queries in parts whose words, and number, are few enough for every task; a single query is not divided."""
    total = queries.agg(F.sum(F.greatest(F.size("words"), F.lit(LEAST_WORDS)))).first()[0] or 0
    parts = 1 + 2 * total // most
    numbered = queries.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(parts)))
    return [numbered.where(F.col("part") == p) for p in range(parts)] if total else []


def _asked(queries: DataFrame, holders: DataFrame, corpus: Corpus) -> Queries:
    """A round of queries on the driver, with the weight of each word that a document holds."""
    weight = F.floor(1000 * F.log((2 * F.lit(corpus.docs).cast("double") + 2) / (2 * F.col("df") + 1)))
    rows = queries.select("query", F.explode("words").alias("word")).join(holders, "word").select("query", "word", weight.alias("weight"))
    got = rows.where("weight > 0").orderBy("query", "word").toPandas()
    words, first = np.unique(got["word"].to_numpy(np.int64), return_index=True)
    query, start = np.unique(got["query"].to_numpy(np.int64), return_index=True)
    return Queries(words, got["weight"].to_numpy(np.int64)[first], query, np.append(start, len(got)), np.searchsorted(words, got["word"].to_numpy(np.int64)))


def _search(blocks: DataFrame, asked: Queries, corpus: Corpus, top: int, seeds: int) -> DataFrame:
    """(query, rank, doc_id, score) of one round."""
    context = blocks.sparkSession.sparkContext
    sent = context.broadcast(asked)

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            limit = bounds(batch, sent.value, corpus)
            block = batch.column("block").to_numpy()
            for q, name in enumerate(sent.value.query):
                at = np.argsort(-limit[:, q], kind="stable")[:seeds]
                at = at[limit[at, q] > 0]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), name)), pa.array(block[at]), pa.array(limit[at, q])], ["query", "block", "bound"])

    by_bound = Window.partitionBy("query").orderBy(F.col("bound").desc(), "block")
    heads = blocks.select(*_BOUNDS).mapInArrow(highest, "query long, block long, bound long")
    first = heads.withColumn("rank", F.row_number().over(by_bound)).where(F.col("rank") <= seeds)
    only: dict[int, list] = {}
    for r in first.select("query", "block").collect():  # seeds rows a query of the round
        only.setdefault(r["block"], []).append(r["query"])
    chosen = context.broadcast(only)
    none = np.zeros(len(asked.query), np.int64)

    def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _scored(batches, sent.value, corpus, none, top, chosen.value)

    named = blocks.sparkSession.createDataFrame([(b,) for b in only], "block long")
    seed = _ranked(blocks.join(F.broadcast(named), "block", "left_semi").mapInArrow(seeded, _FOUND), top)
    least = {r["query"]: r["score"] for r in seed.where(F.col("rank") == top).select("query", "score").collect()}
    thresholds = context.broadcast(np.array([least.get(int(q), 0) for q in asked.query], np.int64))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _scored(batches, sent.value, corpus, thresholds.value, top)

    return _ranked(blocks.mapInArrow(scored, _FOUND), top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block: int = BLOCK, seeds: int = SEEDS, round_words: int = ROUND_WORDS) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` its ``top`` best documents with a score above 0, ranks from 1.

    With N documents that have a word, L words in all, a document of n words and a word in df documents, tf times in this one:
    the score sums w * (10^9 tf div (1000 tf + 20 m)) over the different words of the item, w = floor(1000 ln((2N + 2) / (2 df + 1))),
    m = 50 + (50 n N) div L. Equal scores stand by ascending doc_id, null ids last. Repeated documents and items each count for themselves, a null item id too;
    null and blank texts have no words and appear nowhere; an empty table on either side gives an empty result. Words are compared by 64-bit
    hashes. Other columns are ignored.

    The index holds the words of the items alone (a bit field of fixed size tells them); lengths and N, L count all words.
    """
    queries = query_words(items, item_col, item_text_col)
    wanted = bit_field(queries.select(F.explode("words").alias("key")))
    blocks = index(docs, wanted, id_col, text_col, block)
    total = blocks.agg(F.sum("n_docs"), F.sum("n_words")).first()
    corpus = Corpus(total[0] or 0, total[1] or 0)
    per_word = blocks.select(F.explode(F.arrays_zip("words", "holders")).alias("w")).groupBy(F.col("w.words").alias("word")).agg(F.sum("w.holders").alias("df"))
    holders = stage(per_word, "holders")
    found = [_search(blocks, asked, corpus, top, seeds) for part in _rounds(queries, round_words) if len((asked := _asked(part, holders, corpus)).query)]
    if not found:
        kind = queries.schema["item_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.union, found).join(queries.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
