"""Many words looked for at once: an Aho-Corasick automaton reads a text in one pass, however many words a dictionary holds."""

from collections.abc import Iterable, Iterator, Mapping
from typing import Any

import ahocorasick
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Characters of all words of one automaton; a longer list is read by several, one after the other.
MOST_CHARS = 4_000_000


class Dictionary:
    """Words with a value each; picklable, so that it is sent to the tasks once."""

    def __init__(self, words: Mapping[str, Any]) -> None:
        self.automaton = ahocorasick.Automaton()
        for word, value in words.items():
            self.automaton.add_word(word, (len(word), value))
        self.automaton.make_automaton()
        self.lengths = sorted({len(w) for w in words}, reverse=True)
        self.last = {w[-1] for w in words}
        self.some = bool(words)

    def found(self, text: str) -> Iterator[tuple[int, int, Any]]:
        """(start, end, value) of every occurrence, overlapping ones too, by end."""
        for last, (size, value) in self.automaton.iter(text) if self.some else ():
            yield last + 1 - size, last + 1, value

    def at_end(self, text: str, end: int | None = None) -> Iterator[tuple[int, Any]]:
        """(start, value) of the words that end at ``end``, the longest first."""
        end = len(text) if end is None else end
        for size in self.lengths if end and text[end - 1] in self.last else ():
            if size <= end and self.automaton.exists(text[end - size : end]):
                yield end - size, self.automaton.get(text[end - size : end])[1]

    def any_in(self, text: str | None) -> bool:
        return text is not None and self.some and next(self.automaton.iter(text), None) is not None


def contains_any(spark: SparkSession, text: Column, words: Iterable[str]) -> Column:
    """Whether a text holds any of the words, which are few enough for the driver; empty words and null texts count for nothing."""
    parts: list[dict[str, None]] = [{}]
    size = 0
    for word in sorted({w for w in words if w}):
        if size and size + len(word) > MOST_CHARS:
            parts.append({})
            size = 0
        parts[-1][word] = None
        size += len(word)
    found = F.lit(False)
    for part in parts if parts[0] else []:
        found = found | _holds(spark.sparkContext.broadcast(Dictionary(part)))(text)
    return found


def _holds(sent: Broadcast):
    @F.pandas_udf("boolean")
    def holds(texts: pd.Series) -> pd.Series:
        return texts.map(sent.value.any_in)

    return holds
