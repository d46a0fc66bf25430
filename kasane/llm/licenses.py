"""Licence scans with a positional index of rare licence words.

Templates are phrases and notices of licences, as word sequences; their postings name, for each licence word, the
templates and positions where it stands. The document frequency of every licence word is counted over all texts.
A file looks up its licence words from the highest inverse document frequency down, until every template whose
key phrase it may hold (all words of the phrase are in the file) has been proposed by ``LOOKUPS`` of them, or by as
many as the phrase has. Each place of a looked-up word proposes a start, the place less the position in the template; the proposals of
the words are intersected, and where all agree the key phrase is verified word for word (a phrase is all key). Around
a verified key phrase, the other words of a notice are in place if they stand within ``SHIFT`` words of where they
should; the notice counts if such words carry ``LEAST`` of its total inverse document frequency.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kasane.llm.ngrams import histogram, table
from kasane.llm.textbytes import ALNUM, LOWER, span_hashes, spans, steps, utf8

#: Share of a notice's inverse document frequency that must be in place.
LEAST = 0.6
#: Words of the key phrase that propose a start together.
LOOKUPS = 3
#: By how many words inserted or left out a word may have moved against the key phrase.
SHIFT = 4
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class Template(NamedTuple):
    """A phrase (no ``key``: every word must stand) or a notice with its mandatory key phrase."""

    label: str
    text: str
    key: str = ""
    base: bool = False


# The three given phrases, and the wording of public licences and of their notices.
TEMPLATES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
    Template("gpl-2", "gnu general public license version 2"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl-3", "gnu affero general public license"),
    Template("mpl-2", "mozilla public license version 2"),
    Template("epl-2", "eclipse public license version 2"),
    Template("epl-2", "eclipse public license 2 0"),
    Template("bsd", "under the bsd license"),
    Template("isc", "under the isc license"),
    Template("bsl-1", "boost software license version 1 0"),
    Template("cc0-1", "cc0 1 0 universal"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-sa", "creative commons attribution sharealike"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
    Template("proprietary", "all rights reserved"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software and to permit persons to whom the software is furnished to do so",
        "permission is hereby granted free of charge",
    ),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "permission is hereby granted free of charge",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above "
        "copyright notice and this permission notice appear in all copies",
        "with or without fee is hereby granted",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "source and binary forms",
    ),
    Template(
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "except in compliance with the license",
    ),
    Template("apache-2", "you may not use this file except in compliance with the license", "except in compliance with the license"),
    Template(
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at",
        "mozilla public license",
    ),
    Template(
        "gpl-3",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation "
        "either version 3 of the license or at your option any later version",
        "version 3 of the license",
    ),
    Template(
        "gpl-2",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation "
        "either version 2 of the license or at your option any later version",
        "version 2 of the license",
    ),
    Template("gpl-3", "either version 3 of the license or at your option any later version", "version 3 of the license"),
    Template("gpl-2", "either version 2 of the license or at your option any later version", "version 2 of the license"),
    Template(
        "zlib",
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely "
        "subject to the following restrictions",
        "permission is granted to anyone to use this software",
    ),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    Template(
        "bsl-1",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
        "any person or organization obtaining a copy",
    ),
)


def _words(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


def _hashes(words: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b" ".join(words), np.uint8)
    s, e, _ = spans(data, np.array([0, len(data)]), ALNUM)
    return span_hashes(data, s, e)


class Index(NamedTuple):
    """Words of the templates: sorted hashes, the word number of each hash, and the templates as word numbers."""

    hashes: np.ndarray
    numbers: np.ndarray
    templates: list[tuple[Template, np.ndarray, np.ndarray]]

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each licence word, -1 for other words."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], -1)


def index(templates: tuple[Template, ...] = TEMPLATES) -> Index:
    vocabulary = sorted({w for t in templates for w in _words(t.text)})
    own = {w: i for i, w in enumerate(vocabulary)}
    hashes = _hashes(vocabulary)
    order = np.argsort(hashes)
    shaped = []
    for t in templates:
        ids = np.array([own[w] for w in _words(t.text)])
        key = np.array([own[w] for w in _words(t.key)], np.int64)
        place = next((i for i in range(len(ids) - len(key) + 1) if np.array_equal(ids[i : i + len(key)], key)), 0)
        shaped.append((t, ids, np.arange(place, place + len(key)) if t.key else np.arange(len(ids))))
    return Index(hashes[order], order, shaped)


def document_frequency(docs: DataFrame, idx: Index, text_col: str = "text") -> np.ndarray:
    """In how many texts of ``docs`` each licence word stands; last, the number of texts."""
    n = len(idx.hashes)

    def add(batch: pa.RecordBatch, sums: dict[str, np.ndarray]) -> None:
        for part in steps(iter([batch]), "text"):
            data, offs = utf8(part.column("text"))
            data = LOWER[data]
            s, e, first = spans(data, offs, ALNUM)
            word = idx.number(span_hashes(data, s, e))
            at = np.flatnonzero(word >= 0)
            pairs = np.unique((np.searchsorted(first, at, "right") - 1) * n + word[at])
            counts = np.bincount(pairs % n, minlength=n + 1)
            counts[n] = part.num_rows
            sums["df"] = sums.get("df", np.zeros(n + 1, np.int64)) + counts

    rows = docs.select(F.col(text_col).cast("string").alias("text"))
    return table(histogram(rows, add, n + 1), n + 1).get("df", np.zeros(n + 1, np.int64))


def weights(df: np.ndarray) -> np.ndarray:
    """Inverse document frequency of each licence word; above 0, also for a word that every text holds."""
    return np.log1p(df[-1] / (1 + df[:-1])) + 1e-9


def lookups(idx: Index, idf: np.ndarray, most: int = LOOKUPS) -> list[np.ndarray]:
    """For each template the positions in its key phrase that files look up: those of its highest inverse document frequency, one for each word."""
    chosen = []
    for _, ids, must in idx.templates:
        first = {int(ids[j]): int(j) for j in must[::-1]}
        chosen.append(np.array(sorted(first.values(), key=lambda j: (-idf[ids[j]], j))[:most]))
    return chosen


def _starts(places: dict[int, np.ndarray], ids: np.ndarray, must: np.ndarray, positions: np.ndarray, word: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Where the looked-up words agree that the template begins and its key phrase stands in one text.

    ``places``: of each licence word. ``word`` and ``owner`` hold -1 for the length of the longest template, and more, at both ends.
    """
    starts = places[ids[positions[0]]] - positions[0]
    for j in positions[1:]:
        starts = np.intersect1d(starts, places[ids[j]] - j, assume_unique=True)
    good = owner[starts + must[0]] == owner[starts + must[-1]]
    for j in must:
        good &= word[starts + j] == ids[j]
    return starts[good]


def _shares(starts: np.ndarray, ids: np.ndarray, must: np.ndarray, idf: np.ndarray, word: np.ndarray, owner: np.ndarray, shift: int) -> np.ndarray:
    """What share of the template's inverse document frequency is in place."""
    home = owner[starts + must[0]]
    key = set(must.tolist())
    total = np.zeros(len(starts))
    for j, w in enumerate(ids):
        hit = np.full(len(starts), j in key)
        for d in range(-shift, shift + 1) if j not in key else ():
            hit |= (owner[starts + j + d] == home) & (word[starts + j + d] == w)
        total += np.where(hit, idf[w], 0.0)
    return np.minimum(total / idf[ids].sum(), 1.0)


def licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES, least: float = LEAST, shift: int = SHIFT
) -> DataFrame:
    """(doc_id, n_words, places): one row per row of ``docs``.

    places: (label, base, start, end, score) of every template found, by start, then label; words are counted from 0,
    end is exclusive; score is the share of the template's inverse document frequency in place. Where a longer notice
    of a label and a shorter one share their key phrase, both are found. A null text has no words. Repeated rows
    are answered each for itself; other columns are ignored; an empty table gives an empty table.
    """
    idx = index(templates)
    idf = weights(document_frequency(docs, idx, text_col))
    chosen = lookups(idx, idf)
    n = len(idx.hashes)
    keys = np.zeros((len(idx.templates), n), bool)
    for i, (_, ids, must) in enumerate(idx.templates):
        keys[i, ids[must]] = True
    pad = max(len(ids) for _, ids, _ in idx.templates) + shift
    kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            data, offs = utf8(batch.column("text"))
            data = LOWER[data]
            s, e, first = spans(data, offs, ALNUM)
            edge = np.full(pad, -1)
            word = np.concatenate([edge, idx.number(span_hashes(data, s, e)), edge])
            owner = np.concatenate([edge, np.repeat(np.arange(len(first) - 1), np.diff(first)), edge])
            at = np.flatnonzero(word >= 0)
            held = np.zeros((batch.num_rows, n), bool)
            held[owner[at], word[at]] = True
            may = np.stack([held[:, k].all(axis=1) for k in keys], axis=1)  # file, template: all words of the key phrase are there
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for i, (t, ids, must) in enumerate(idx.templates):
                if not may[:, i].any():
                    continue
                mine = at[may[owner[at], i]]
                places = {w: mine[word[mine] == w] for w in ids[chosen[i]]}
                starts = _starts(places, ids, must, chosen[i], word, owner)
                for p, x in zip(starts.tolist(), _shares(starts, ids, must, idf, word, owner, shift).tolist(), strict=True):
                    if x >= (least if t.key else 0):
                        doc = int(owner[p + must[0]])
                        at_word = p - pad - int(first[doc])
                        found[doc].append({"label": t.label, "base": t.base, "start": max(0, at_word), "end": min(at_word + len(ids), int(first[doc + 1] - first[doc])), "score": x})
            for x in found:
                x.sort(key=lambda f: (f["start"], f["label"], f["end"]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(first)), pa.array(found, kind)], ["doc_id", "n_words", "places"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    name = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {name}, n_words long, places array<struct<label: string, base: boolean, start: bigint, end: bigint, score: double>>")
