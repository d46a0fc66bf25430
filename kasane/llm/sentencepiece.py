"""SentencePiece encoding and decoding by streaming Viterbi.

A lattice of pieces is walked from left to right. Only the boundaries within the longest piece before the
current one can begin a further piece, so no more is kept; whenever the back pointers of all boundaries in that
window lead through one boundary, everything before it is final and its ids are committed.

The score of a path is the model's: in a unigram model the sum of the piece scores, in a BPE model (whose
scores are merge ranks) a path survives if every two neighbouring pieces are what merging makes of their
characters, which leaves exactly one path to each boundary. Both give the ids that the model's own library
gives. Characters outside the vocabulary become byte pieces, or the unknown piece where a model has none.

Some boundaries are known beforehand to be where all paths meet: no piece holds a space mark after another
character, so all meet before every space mark that follows one, and around line feeds where no piece has one. These
are the first commits. A text is read in parts of ``PART`` characters that end at such a boundary, and the ids of a part
are committed before the next one is normalised, so what is held beside the ids does not grow with the text. Within
a part the stretches between such boundaries are walked side by side, a boundary at a time (``Lattice``), if they are short,
and one by one with a window and commits of its own (``paths``) if they are long. Equal short stretches are walked once
for as long as they are remembered.
"""

from __future__ import annotations

import itertools
import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kasane.llm.textbytes import steps

MARK = "▁"
#: Distinct cuts whose ids are remembered in one task, and the longest of them in characters.
REMEMBERED = 100_000
REMEMBERED_CHARS = 32
#: Cuts that are encoded together.
MANY = 4096
#: Characters of a text that are normalised and cut at once.
PART = 1 << 18
UNIGRAM, BPE = 1, 2
#: Ends before a space mark (a blank becomes one) that follows another character.
_MEET = re.compile(f"[^ {MARK}](?=[ {MARK}])")


class Model:
    """Vocabulary of a SentencePiece model, given as the bytes of its file."""

    def __init__(self, proto: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(proto)
        own = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.library = own
        self.kind = spec.trainer_spec.model_type
        self.unknown = own.unk_id()
        ids = range(own.vocab_size())
        self.pieces = [own.id_to_piece(i) for i in ids]
        self.scores = [own.get_score(i) for i in ids]
        plain = [i for i in ids if not (own.is_control(i) or own.is_unknown(i) or own.is_byte(i) or own.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.costs = {p: -self.scores[i] for p, i in self.ids.items()}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in ids if own.is_byte(i)}
        self.longest = max(map(len, self.ids), default=1)
        self.prefix = spec.normalizer_spec.add_dummy_prefix
        self.identity = spec.normalizer_spec.name == "identity" and not spec.normalizer_spec.remove_extra_whitespaces and spec.normalizer_spec.escape_whitespaces
        self.cuts = None
        if all(MARK not in p.lstrip(MARK) for p in self.ids):
            feed = "" if any("\n" in p for p in self.ids) else "\n"  # outside the vocabulary, it stands alone too
            self.cuts = re.compile((f"{feed}+|" if feed else "") + f"{MARK}*[^{MARK}{feed}]+|{MARK}+")
        self.floor = min((self.scores[i] for i in plain), default=0.0) - 10
        self.text = [b"" if own.is_control(i) else bytes([int(p[3:5], 16)]) if own.is_byte(i) else b" \xe2\x81\x87 " if own.is_unknown(i) else p.replace(MARK, " ").encode() for i, p in zip(ids, self.pieces, strict=True)]
        self.pairs: dict[tuple[str, str], bool] = {}

    def normalized(self, text: str, first: bool = True) -> str:
        if self.identity:
            return (MARK if self.prefix and text and first else "") + text.replace(" ", MARK)
        return self.library.normalize(text)

    def merged(self, text: str) -> list[str]:
        """The pieces that merging makes of a short text: the best-scored neighbours first, the leftmost of equals."""
        part, cost = list(text), self.costs.get
        waiting = [cost(a + b, np.inf) for a, b in itertools.pairwise(part)]
        while waiting and (least := min(waiting)) < np.inf:
            i = waiting.index(least)
            part[i : i + 2] = [part[i] + part[i + 1]]
            del waiting[i]
            if i:
                waiting[i - 1] = cost(part[i - 1] + part[i], np.inf)
            if i < len(waiting):
                waiting[i] = cost(part[i] + part[i + 1], np.inf)
        return part

    def neighbours(self, a: str, b: str) -> bool:
        """Whether merging leaves the two pieces as they are when they stand side by side; an empty ``a`` is the start of the text."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > REMEMBERED:
                self.pairs.clear()
            known = self.pairs[a, b] = self.judged(a, b)
        return known

    def judged(self, a: str, b: str) -> bool:
        return self.merged(a + b) == ([a, b] if a else [b])


def paths(model: Model, text: str) -> Iterator[list[str]]:
    """The best path through a normalised text in committed parts, as lists of pieces; characters outside the vocabulary stand for themselves.

    Of each boundary from ``base`` on, ``best`` holds the score of its surviving path and ``last`` the piece that
    path ends with, which is the back pointer.
    """
    ids, scores, longest, unigram, neighbours = model.ids, model.scores, model.longest, model.kind == UNIGRAM, model.neighbours
    base, n = 0, len(text)
    best, last = [0.0], [""]
    for to in range(1, n + 1):
        score, piece = -np.inf, ""
        for at in range(max(base, to - longest), to):
            p = text[at:to]
            own = ids.get(p)
            if own is None and at < to - 1:
                continue
            if unigram:
                s = best[at - base] + (model.floor if own is None else scores[own])
                if s > score:
                    score, piece = s, p
            elif neighbours(last[at - base], p):
                score, piece = 0.0, p
                break
        best.append(score)
        last.append(piece)
        if to == n or to - base >= 4 * longest:
            # lead the boundaries that a further piece can begin at back until they meet
            ends = {to} if to == n else set(range(to - longest + 1, to + 1))
            while len(ends) > 1:
                top = max(ends)
                ends.remove(top)
                ends.add(max(base, top - len(last[top - base])))
            meet = ends.pop()
            if meet > base:
                out, at = [], meet
                while at > base:
                    out.append(last[at - base])
                    at -= len(last[at - base])
                yield out[::-1]
                best, last, base = best[meet - base :], last[meet - base :], meet


def encoded(model: Model, text: str) -> Iterator[list[int]]:
    """Ids of a normalised text or cut, in committed parts."""
    for part in paths(model, text):
        out: list[int] = []
        for p in part:
            own = model.ids.get(p)
            if own is not None:
                out.append(own)
            elif model.bytes:
                out.extend(model.bytes[b] for b in p.encode())
            else:
                out.append(model.unknown)
        yield out


class Table:
    """Numbers by 64-bit keys, many looked up at once: open addressing over arrays of a fixed size."""

    MISSING = -1

    def __init__(self, bits: int) -> None:
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, self.MISSING, np.int32)
        self.used = 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        out = self.values[at]
        other = np.flatnonzero((self.keys[at] != keys) & (out != self.MISSING))
        while len(other):
            at[other] = (at[other] + 1) & self.mask
            out[other] = self.values[at[other]]
            other = other[(self.keys[at[other]] != keys[other]) & (out[other] != self.MISSING)]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """``keys`` are distinct and not in the table, ``values`` 0 or more."""
        for key, slot, value in zip(keys, self._slot(keys).tolist(), values.tolist(), strict=True):
            while self.values[slot] != self.MISSING:
                slot = (slot + 1) & self.mask
            self.keys[slot], self.values[slot] = key, value
        self.used += len(keys)


class Lattice:
    """The same walk over many short cuts of a BPE model at once, a boundary at a time.

    Substrings become pieces by their hashes. Which pairs of pieces may be neighbours is kept in a table; pairs that
    it lacks are decided by ``Model.judged`` once.
    """

    BASE = np.uint64(0x9E3779B97F4A7C15)
    PAIR_BITS = 21

    def __init__(self, model: Model) -> None:
        self.model = model
        self.start = len(model.pieces)
        self.size = np.array([len(p) for p in model.pieces])
        self.names = [*model.pieces, ""]
        self.pieces = Table(max(10, len(model.ids).bit_length() + 2))
        for n in range(1, model.longest + 1):
            own = [i for i in model.ids.values() if len(model.pieces[i]) == n]
            points = np.array([list(map(ord, model.pieces[i])) for i in own], np.uint64).reshape(-1, n)
            h = np.zeros(len(own), np.uint64)
            for j in range(n):
                h = h * self.BASE + points[:, j] + np.uint64(1)
            self.pieces.put(h, np.array(own, np.int64))
        self.pairs = Table(self.PAIR_BITS)

    def neighbours(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a * (self.start + 1) + b).astype(np.uint64)
        found = self.pairs.get(key)
        new = np.unique(key[found < 0])
        if len(new):
            if self.pairs.used + len(new) > 1 << (self.PAIR_BITS - 1):
                self.pairs = Table(self.PAIR_BITS)
                return self.neighbours(a, b)
            judged = [self.model.judged(self.names[k // (self.start + 1)], self.names[k % (self.start + 1)]) for k in new.tolist()]
            self.pairs.put(new, np.array(judged, np.int64))
            found = self.pairs.get(key)
        return found > 0

    def encode(self, cuts: list[str]) -> list[bytes | None]:
        """Ids of each cut as the bytes of 32-bit numbers; None for a cut with a character outside the vocabulary."""
        n = np.array([len(c) for c in cuts])
        width = int(n.max())
        points = np.zeros((len(cuts), width), np.uint64)
        points[np.arange(width) < n[:, None]] = np.frombuffer("".join(cuts).encode("utf-32-le"), np.uint32)
        pieces = np.full((self.model.longest + 1, len(cuts), width), -1, np.int32)  # by length and end
        h = np.zeros((len(cuts), 0), np.uint64)
        for size in range(1, min(self.model.longest, width) + 1):
            ends = slice(size - 1, width)
            h = (h[:, : width - size + 1] if size > 1 else np.zeros((len(cuts), width), np.uint64)) * self.BASE + points[:, ends] + np.uint64(1)
            pieces[size, :, ends] = self.pieces.get(h.ravel()).reshape(h.shape)
        last = np.full((len(cuts), width + 1), -1, np.int64)
        last[:, 0] = self.start
        for to in range(1, width + 1):
            open_ = np.flatnonzero(n >= to)
            for size in range(min(self.model.longest, to), 0, -1):
                b, a = pieces[size, open_, to - 1], last[open_, to - size]
                can = np.flatnonzero((b >= 0) & (a >= 0))
                can = can[self.neighbours(a[can], b[can].astype(np.int64))] if len(can) else can
                last[open_[can], to] = b[can]
                open_ = np.delete(open_, can)
        out = np.full((len(cuts), width), -1, np.int32)
        at, k = n.copy(), 0
        while (at > 0).any():
            live = np.flatnonzero(at > 0)
            p = last[live, at[live]]
            k += 1
            out[live, width - k] = p
            at[live] -= np.where(p >= 0, self.size[np.maximum(p, 0)], at[live])
            out[live[p < 0], 0] = -2
        broken = (last[np.arange(len(cuts)), n] < 0) | (out[:, 0] == -2)
        return [None if bad else row[row >= 0].tobytes() for row, bad in zip(out, broken.tolist(), strict=True)]


class Encoder(dict):
    """Remembers the ids of short cuts, as the bytes of 32-bit numbers.

    Once half of ``REMEMBERED`` cuts are held they become the old half, from which those that come again are taken back.
    """

    def __init__(self, proto: bytes) -> None:
        super().__init__()
        self.old: dict[str, bytes] = {}
        self.model = Model(proto)
        self.lattice = Lattice(self.model) if self.model.kind == BPE else None

    def __missing__(self, cut: str) -> bytes:
        return b"".join(np.array(part, np.int32).tobytes() for part in encoded(self.model, cut))

    def cut(self, text: str, first: bool = True) -> list[str]:
        whole = self.model.normalized(text, first)
        return self.model.cuts.findall(whole) if self.model.cuts else [whole]

    def learn(self, cuts: set[str]) -> None:
        """Encode the short ones of ``cuts`` that are not remembered yet, many at a time, like lengths together."""
        if len(self) > REMEMBERED // 2:
            self.old = dict(self)
            self.clear()
        lacking = [c for c in cuts if c not in self]
        self.update((c, self.old[c]) for c in lacking if c in self.old)
        new = sorted((c for c in lacking if c not in self.old and 0 < len(c) <= REMEMBERED_CHARS), key=len)
        for at in range(0, len(new), MANY):
            some = new[at : at + MANY]
            found = self.lattice.encode(some) if self.lattice else [None] * len(some)
            self.update((c, self.__missing__(c) if x is None else x) for c, x in zip(some, found, strict=True))

    def parts(self, text: str) -> Iterator[str]:
        """A text in parts of about ``PART`` characters that end where all paths meet; whole if the model gives no such places."""
        at, n = 0, len(text)
        if not (self.model.identity and self.model.cuts):
            at = n
            yield text
        while at < n:
            to = min(n, at + PART)
            if to < n:
                *_, near = (None, *(m.end() for m in _MEET.finditer(text, max(at, to - 4096), to)))
                beyond = None if near else _MEET.search(text, to - 1)
                to = near or (beyond.end() if beyond else n)
            yield text[at:to]
            at = to

    def committed(self, texts: list[str], first: bool = True) -> list[np.ndarray]:
        """Ids of each text; ``first``: they are the beginnings of texts, not further parts."""
        cuts = [self.cut(t, first) for t in texts]
        self.learn(set(itertools.chain.from_iterable(cuts)))
        return [np.frombuffer(b"".join(map(self.__getitem__, c)), np.int32) for c in cuts]

    def long(self, text: str) -> tuple[np.ndarray, bool]:
        """Ids of a long text, committed part by part, and whether they give it back."""
        done, exact = [], True
        for k, part in enumerate(self.parts(text)):
            (ids,) = self.committed([part], k == 0)
            exact = exact and self.decoded(ids, k == 0) == part.encode()
            done.append(ids)
        return np.concatenate(done), exact

    def encoded(self, texts: list[str]) -> list[tuple[np.ndarray, bool]]:
        """(ids, whether they give the text back) of each text: short ones side by side."""
        short = [t for t in texts if len(t) <= PART]
        ids = iter(self.committed(short))
        return [(own := next(ids), self.decoded(own) == t.encode()) if len(t) <= PART else self.long(t) for t in texts]

    def decoded(self, ids: np.ndarray, first: bool = True) -> bytes:
        """UTF-8 of ids; the space that encoding puts before a text is taken away from its ``first`` ones."""
        text = b"".join(map(self.model.text.__getitem__, ids.tolist()))
        return text[1:] if first and self.model.prefix and text[:1] == b" " else text


def encoder(proto: bytes) -> Encoder:
    """One encoder for a model in each Python worker, which outlives the tasks.

    Functions of this package travel by value, so their globals are new in every task; an entry among the loaded modules is not.
    """
    kept = sys.modules.setdefault("_kasane_worker", types.ModuleType("_kasane_worker")).__dict__
    if kept.get("proto") != proto:
        kept.update(proto=proto, encoder=Encoder(proto))
    return kept["encoder"]


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, n_tokens, exact): one row per row of ``docs``; exact: whether decoding the ids gives the text back.

    ``model_file`` is read by the driver; tasks get its bytes, which the vocabulary bounds. A null text is empty
    and has no ids. Repeated rows are encoded each for itself; an empty table gives an empty table; other columns are ignored.
    """
    with open(model_file, "rb") as f:
        proto = docs.sparkSession.sparkContext.broadcast(f.read())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(proto.value)
        for batch in steps(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids, exact = zip(*own.encoded(texts), strict=True)
            ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, pa.array(np.diff(ends).astype(np.int64)), pa.array(list(exact))], ["doc_id", "ids", "n_tokens", "exact"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, n_tokens long, exact boolean")


def decode(tokens: DataFrame, model_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): the text of each row's ids; null ids give an empty text, bytes that are not UTF-8 the replacement character.

    Repeated rows are decoded each for itself; an empty table gives an empty table; other columns are ignored.
    """
    with open(model_file, "rb") as f:
        proto = tokens.sparkSession.sparkContext.broadcast(f.read())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(proto.value)
        for batch in batches:
            texts = [own.decoded(np.array(x or [], np.int64)).decode(errors="replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = tokens.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")
