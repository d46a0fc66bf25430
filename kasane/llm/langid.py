"""Language identification by mixtures: each text is a blend of languages whose shares are fitted by expectation-maximisation.

Every learned language is a smoothed multinomial over hashed byte trigrams. A text is cut into units of
``UNIT`` words; each unit comes from one language. For every text the shares of the languages are fitted by
EM on the unit likelihoods; then the language sets made of its 1, 2, ... strongest languages are fitted
again, and the set with the highest likelihood less ``PENALTY`` times log(units) a further language is chosen. A set is not tried once
the penalty alone exceeds what is lost by the best set so far, so the fits after the first cost no more than the languages that a text may hold.

There may be any number of languages. Of each the model holds the buckets that it has, 10 bytes a bucket; a task holds the likelihoods of ``CELLS`` units
and languages at once, and reads a text of more units block by block in every round.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kasane.llm.ngrams import bucketed, sparse
from kasane.llm.textbytes import ALNUM, LOWER, NOT_BLANK, spans, steps, utf8

WIDTH = 3
BITS = 15
BUCKETS = 1 << BITS
UNIT = 8
ROUNDS = 12
PENALTY = 2.0
#: Pseudo-count of every bucket.
SMOOTH = 0.5
#: Most that one unit can tell for a language against the others, in nats: a stray name or number does not make a language.
CLIP = 30.0
#: Shares up to this are what rounding leaves of a language outside the set; they are not named.
LEAST_SHARE = 0.005
UNDETERMINED = "und"
#: Languages of one step whose counts are gathered in a table of all buckets; more are sorted.
FEW = 16
#: Likelihoods, of a unit in a language, that a task holds at once.
CELLS = 1 << 21


class Model(NamedTuple):
    """Of each language the buckets that it has, their log p, and the log p of all others."""

    seen: list[np.ndarray]
    logs: list[np.ndarray]
    rest: np.ndarray

    def row(self, k: int) -> np.ndarray:
        """log p of every bucket in a language."""
        out = np.full(BUCKETS, self.rest[k])
        out[self.seen[k]] = self.logs[k]
        return out


#: Likelihoods of units and languages, with the first unit of each text (n + 1), block by block.
Blocks = Callable[[], Iterator[tuple[np.ndarray, np.ndarray]]]


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], Model]:
    """(languages in order, what is known of each), over all rows of ``docs`` with a language and a text.

    The driver and every task hold 10 bytes for each bucket that a language has: ``BUCKETS`` (0.3 MB) a language at most, and far less for a value that few texts
    have. Repeated rows count as often as given; an empty table has no languages; other columns are ignored.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text"):
            data, offs = utf8(part.column("text"))
            tags = part.column("lang").dictionary_encode()
            code = np.repeat(tags.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.diff(offs))
            key = code * BUCKETS + bucketed(LOWER[data], offs, WIDTH, BITS)
            if len(tags.dictionary) > FEW:
                key, n = np.unique(key, return_counts=True)
            else:
                n = np.bincount(key)
                key, n = np.flatnonzero(n), n[n > 0]
            yield pa.RecordBatch.from_arrays([tags.dictionary.take(pa.array(key // BUCKETS)), pa.array(key % BUCKETS), pa.array(n)], ["name", "bucket", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    counts = rows.mapInArrow(counted, "name string, bucket long, n long").groupBy("name", "bucket").agg(F.sum("n").alias("n"))
    found = sorted(sparse(counts), key=lambda x: x[0])
    known = [(at, n + SMOOTH, n.sum() + SMOOTH * BUCKETS) for _, at, n in found]
    return [name for name, _, _ in found], Model([at.astype(np.uint16) for at, _, _ in known], [np.log(n / total) for _, n, total in known], np.array([np.log(SMOOTH / total) for _, _, total in known]))


def _units(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last + 1 byte of each unit, and the first unit of each text (n + 1)."""
    s, e, first = spans(data, offs, NOT_BLANK)
    n_words = np.diff(first)
    n_units = -(-n_words // UNIT)
    bounds = np.concatenate([[0], np.cumsum(n_units)])
    owner = np.repeat(np.arange(len(n_words)), n_units)
    word = first[owner] + (np.arange(bounds[-1]) - bounds[owner]) * UNIT
    last = np.minimum(word + UNIT, first[owner + 1]) - 1
    return (s[word], e[last], bounds) if len(word) else (word, word, bounds)


def _likelihoods(at: np.ndarray, lo: np.ndarray, hi: np.ndarray, model: Model) -> np.ndarray:
    """Likelihood of each unit in each language, over that of the unit's best. ``at``: bucket of each byte."""
    ll = np.zeros((len(lo), len(model.rest)))
    if len(lo):
        begin, at = lo[0], at[lo[0] : hi[-1]]
        for k in range(len(model.rest)):
            sums = np.zeros(len(at) + 1)
            np.cumsum(model.row(k)[at], out=sums[1:])
            ll[:, k] = sums[hi - begin] - sums[lo - begin]
        ll -= ll.max(1, keepdims=True)
    return np.exp(np.maximum(ll, -CLIP))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros((len(values) + 1, values.shape[1]))
    np.cumsum(values, axis=0, out=out[1:])
    return out[bounds[1:]] - out[bounds[:-1]]


def _fitted(blocks: Blocks, n_units: np.ndarray, columns: np.ndarray | None, langs: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares in each text of its own ``columns`` (texts x size; None: all languages), and its log-likelihood with them."""
    n = np.maximum(1, n_units)[:, None]
    size = langs if columns is None else columns.shape[1]
    share = np.full((len(n_units), size), 1 / size)

    def mixed() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for p, bounds in blocks():
            owner = np.repeat(np.arange(len(n_units)), np.diff(bounds))
            yield (p if columns is None else np.take_along_axis(p, columns[owner], 1)) * share[owner], bounds

    for _ in range(ROUNDS):
        total = np.zeros_like(share)
        for r, bounds in mixed():
            total += _sums(r / np.maximum(r.sum(1, keepdims=True), 1e-300), bounds)
        share = np.where(n_units[:, None] > 0, total / n, share)
    value = sum(_sums(np.log(np.maximum(r.sum(1, keepdims=True), 1e-300)), bounds)[:, 0] for r, bounds in mixed())
    return share, value


def _of(blocks: Blocks, texts: np.ndarray) -> Blocks:
    """The units of some texts alone."""

    def some() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for p, bounds in blocks():
            counts = np.diff(bounds)
            yield p[np.repeat(texts, counts)], np.concatenate([[0], np.cumsum(counts[texts])])

    return blocks if texts.all() else some


def mixtures(blocks: Blocks, n_units: np.ndarray, langs: int) -> np.ndarray:
    """Shares of the languages in each text, within the set of languages of the highest penalised likelihood."""
    share, _ = _fitted(blocks, n_units, None, langs)
    order = np.argsort(-share, axis=1, kind="stable")
    best, best_value = np.zeros_like(share), np.full(len(n_units), -np.inf)
    cost = PENALTY * np.log(np.maximum(2, n_units))
    for size in range(1, langs + 1):
        open_ = -cost * (size - 1) > best_value  # no set has a likelihood above 1
        if not open_.any():
            break
        columns = order[open_, :size]
        own, value = _fitted(_of(blocks, open_), n_units[open_], columns, langs)
        value = value - cost[open_] * (size - 1)
        better = np.flatnonzero(open_)[value > best_value[open_]]
        rows = np.zeros((len(better), langs))
        np.put_along_axis(rows, order[better, :size], own[value > best_value[open_]], 1)
        best[better] = rows
        best_value[open_] = np.maximum(value, best_value[open_])
    return best


def text_shares(data: np.ndarray, offs: np.ndarray, model: Model, cells: int = CELLS) -> np.ndarray:
    """Shares of the languages in each of some texts, fitted in groups of texts of at most ``cells`` likelihoods; a longer text is a group of several blocks."""
    low, langs = LOWER[data], len(model.rest)
    at, (lo, hi, bounds) = bucketed(low, offs, WIDTH, BITS), _units(low, offs)
    most, out, begin = max(1, cells // langs), [], 0
    while begin < len(offs) - 1:
        end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + most, "right")) - 1)
        a, b = int(bounds[begin]), int(bounds[end])
        n_units = np.diff(bounds[begin : end + 1])
        if b - a <= most:
            p = _likelihoods(at, lo[a:b], hi[a:b], model)
            blocks = lambda p=p, own=bounds[begin : end + 1] - a: iter([(p, own)])
        else:
            blocks = lambda a=a, b=b: ((_likelihoods(at, lo[x:y], hi[x:y], model), np.array([0, y - x])) for x in range(a, b, most) for y in [min(b, x + most)])
        out.append(mixtures(blocks, n_units, langs))
        begin = end
    return np.concatenate(out) if out else np.zeros((0, langs))


def _letters(batch: pa.RecordBatch, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Whether each text has a letter; only texts without an ASCII one are decoded."""
    ascii_letter = ALNUM[data] & (data < 0x80) & (data > 0x39)
    sums = np.concatenate([[0], np.cumsum(ascii_letter)])
    found = sums[offs[1:]] > sums[offs[:-1]]
    for i in np.flatnonzero(~found & (np.diff(offs) > 0)):
        found[i] = any(map(str.isalpha, batch.column("text")[int(i)].as_py()))
    return found


def identify(docs: DataFrame, langs: list[str], model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, languages): one row per row of ``docs``.

    languages: the chosen set as (lang, share), strongest first, without shares of ``LEAST_SHARE`` or less; lang_pred and score are its
    first. A null text, a text without a letter, and any text where no language was learned is ``und`` with score 0 and an empty set.
    Repeated rows are answered each for itself; an empty table gives an empty table; other columns are ignored.
    """

    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            data, offs = utf8(batch.column("text"))
            known = _letters(batch, data, offs) if langs else np.zeros(batch.num_rows, bool)
            share = text_shares(data, offs, sent.value) if langs else np.zeros((batch.num_rows, 0))
            named = [np.flatnonzero(row > LEAST_SHARE) for row in share]
            sets = [[{"lang": langs[k], "share": float(row[k])} for k in at[np.argsort(-row[at], kind="stable")]] if ok else [] for row, at, ok in zip(share, named, known, strict=True)]
            top = [x[0] if x else {"lang": UNDETERMINED, "share": 0.0} for x in sets]
            kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x["lang"] for x in top]), pa.array([min(1.0, x["share"]) for x in top]), pa.array(sets, kind)],
                ["doc_id", "lang_pred", "score", "languages"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, lang_pred string, score double, languages array<struct<lang: string, share: double>>")


def held_out(id_col: str = "doc_id"):
    """Whether a document is kept out of learning; a null id is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
