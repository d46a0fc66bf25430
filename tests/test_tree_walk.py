"""The recursive query against the walk in Python, over trees of every shape."""

import json
import random

from kasane.operators import tree

TAGS = ["MainProvision", "SupplProvision", "Chapter", "Section", "Subsection", "Article", "Paragraph", "Item", "Sentence", "", "X"]


def grown(rng, depth):
    children = [grown(rng, depth - 1) if depth and rng.random() < 0.7 else rng.choice(["text", "法", "", 'q"\\']) for _ in range(rng.randint(0, 4))]
    node = {"tag": rng.choice(TAGS), "attr": {k: str(rng.randint(0, 3)) for k in rng.sample(["Num", "AmendLawNum", "Function"], rng.randint(0, 2))}, "children": children}
    for key in rng.sample(["attr", "children", "tag"], 1 if rng.random() < 0.15 else 0):
        del node[key]
    return node


def plain(df):
    return sorted(((r.law_id, r.pos, r.parent_pos, r.end_pos, r.depth, r.part, r.tag, None if r.attr is None else sorted(r.attr.items()), r.text, r.chapter_pos, r.section_pos, r.article_pos, [tuple(x) for x in r.line]) for r in df.collect()), key=lambda x: x[:2])


def test_walked_is_flatten(spark):
    rng = random.Random(8)
    trees = [(f"L{i}", json.dumps({"tag": "Law", "attr": {}, "children": [grown(rng, rng.randint(0, 6)) for _ in range(3)]})) for i in range(25)]
    chain = "end"
    for i in range(150):
        chain = {"tag": ["Chapter", "Section", "Y"][i % 3], "children": [chain]}
    trees += [("deep", json.dumps(chain)), ("null", None), ("bad", "{"), ("list", "[1]"), ("word", '"x"'), ("none", "null"), ("leaf", '{"tag": "Law"}')]
    laws = spark.createDataFrame(trees, "law_id string, tree string").repartition(3)
    before = spark.conf.get("spark.sql.cteRecursionLevelLimit")
    got, want = tree.walked(laws), tree.flatten(laws)
    assert got.columns == want.columns
    assert plain(got) == plain(want)
    assert spark.conf.get("spark.sql.cteRecursionLevelLimit") == before
