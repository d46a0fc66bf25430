"""Dictionaries of words against plain searches."""

import random

from pyspark.sql import functions as F

from kasane.functions import automaton
from kasane.operators import integrity


def test_found_and_at_end():
    rng = random.Random(1)
    words = {"".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(40)}
    known = automaton.Dictionary({w: w.upper() for w in words})
    for _ in range(200):
        text = "".join(rng.choices("abcd", k=rng.randint(0, 30)))
        want = [(i, i + len(w), w.upper()) for w in words for i in range(len(text)) if text.startswith(w, i)]
        assert sorted(known.found(text)) == sorted(want)
        assert list(known.at_end(text)) == [(len(text) - len(w), w.upper()) for w in sorted(words, key=len, reverse=True) if text.endswith(w)]
    assert list(automaton.Dictionary({}).found("abc")) == []


def test_contains_any_in_several_automata(spark, monkeypatch):
    monkeypatch.setattr(automaton, "MOST_CHARS", 20)
    words = [f"w{i}x" for i in range(30)] + ["", None]
    rows = spark.createDataFrame([(i, f"a w{i}x b") for i in range(60)] + [(60, None), (61, "")], "i int, t string")
    got = {r.i: r.hit for r in rows.select("i", automaton.contains_any(spark, F.col("t"), words).alias("hit")).collect()}
    assert got == {i: i < 30 for i in range(62)}
    assert rows.where(automaton.contains_any(spark, F.col("t"), [])).count() == 0


def test_ignore_list_of_100_000_patterns(spark):
    links = spark.createDataFrame([(f"d/{i}", f"notes/p{i}.md") for i in range(500)], "path string, shown string")
    patterns = spark.range(100_000).selectExpr("concat('/p', id * 5, '.md') AS pattern")
    kept = integrity.not_ignored(links, patterns)
    assert {r.shown for r in kept.collect()} == {f"notes/p{i}.md" for i in range(500) if i % 5}
    assert integrity.not_ignored(links, patterns.limit(0)).count() == 500
