"""Ranked search against scoring every document in plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from kasane.llm import ranked
from kasane.llm.keyed import bit_field

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(c.lower() if c.isascii() else c for c in w) for w in WORD.findall(text or "")]


def plain(docs, items, top):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    out = []
    for item, text in items:
        rows = []
        for i, c in held:
            m = 100 - 50 + 50 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 20 * m)) for w in set(terms(text)) if c[w])
            if score > 0:
                rows.append((-score, i is None, i or 0))
        out += [(item, rank, None if null else i, -score) for rank, (score, null, i) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)] + ["Über", "naïve", "漢字", "A-b", "x_y", "3.5"]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 30, 200])))) for i in range(300)]
    docs += [(400 + i, docs[5][1]) for i in range(90)] + [docs[7], docs[7], (None, docs[9][1]), (None, None), (501, None), (502, " .,; "), (503, "solo"), (504, "w1 " * 5000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 40)))) for i in range(25)] + [(30, docs[5][1]), (31, None), (32, "never seen"), (33, "SOLO solo"), (None, "w1 w2"), (0, "w3"), (0, "w3")]
    return docs, items


@pytest.mark.parametrize(("top", "how"), [(50, {}), (5, {"block": 4, "seeds": 1}), (3, {"block": 1, "seeds": 2, "round_words": 150})])
def test_equals_scoring_all(spark, texts, top, how):
    docs, items = texts
    table = spark.createDataFrame([(i, t, 1, "q") for i, t in docs], "doc_id long, text string, query int, words string").repartition(5)
    asked = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, rank int").repartition(2)
    found = ranked.search(table, asked, top=top, **how)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert got == plain(docs, items, top)


def test_empty_tables(spark, empty):
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert ranked.search(empty, some).collect() == []
    assert ranked.search(docs, some.limit(0)).collect() == []
    assert [tuple(r) for r in ranked.search(docs, some).collect()] == plain([(1, "a b")], [(1, "a b")], 50)


def test_bounds_hold_and_spare_blocks(spark, texts, monkeypatch):
    """No document scores more than its block's bound, and blocks that cannot reach the last rank are not scored."""
    docs = [(i, " ".join(f"t{i // 8}x{j}" for j in range(20)) + " common") for i in range(320)]
    table = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    asked = ranked.query_words(spark.createDataFrame([(i, f"t{i}x1 t{i}x2 t{i}x3 common") for i in range(40)], "item_id long, text string"))
    blocks = ranked.index(table, bit_field(asked.selectExpr("explode(words) AS key")), block=8)
    rows = blocks.toArrow().combine_chunks().to_batches()
    corpus = ranked.Corpus(320, 320 * 21)
    holders = blocks.selectExpr("inline(arrays_zip(words, holders))").groupBy("words").agg({"holders": "sum"}).toDF("word", "df")
    queries = ranked._asked(asked, holders, corpus)
    limit = ranked.bounds(rows[0], queries, corpus)
    for i in range(rows[0].num_rows):
        scorer = ranked._Scorer(rows[0], i, queries, corpus)
        assert all(scorer.scores(q).max() <= limit[i, q] for q in range(len(queries.query)))
    made = []
    real = ranked._Scorer.scores
    monkeypatch.setattr(ranked._Scorer, "scores", lambda self, q: (made.append(q), real(self, q))[1])
    list(ranked._scored(iter(rows), queries, corpus, np.zeros(40, np.int64), 8))
    assert len(rows) == 1 and rows[0].num_rows == 40 and len(made) == 40  # one block of 40 for each query
