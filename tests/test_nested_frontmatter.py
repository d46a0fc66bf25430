"""Nested front matter: what YAML means, and values that come back as they were."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kasane.functions import frontmatter as Y
from kasane.sources import landing

CASES = [
    ("a: 1\nb: x y # note\n# c\nc:\nd: ~\ne: 'it''s'\nf: \"q\\n\\u00e9\\\"\"", {"a": 1, "b": "x y", "c": None, "d": None, "e": "it's", "f": 'q\né"'}),
    ("tags:\n- 法\n- a: 1\n  b: [x, 'y, z', {k: v}]\n-\n  - p\n  - q\nlast: {}", {"tags": ["法", {"a": 1, "b": ["x", "y, z", {"k": "v"}]}, ["p", "q"]], "last": {}}),
    ("amend_law:\n  title: 昭和五十年法律第一号\n  num: 12\n  laws:\n    - id: A1\n      name: 民法\n    - id: A2\n  deep:\n    er:\n      est: yes\nnext: No", {"amend_law": {"title": "昭和五十年法律第一号", "num": 12, "laws": [{"id": "A1", "name": "民法"}, {"id": "A2"}], "deep": {"er": {"est": True}}}, "next": False}),
    ("long: one two\n  three\n\n  four\nlit: |\n  a\n    b\n\n  c\nfold: >-\n  a\n  b\n\n  c\nkeep: |+\n  x\n\nend: 'a\n  b'", {"long": "one two three\nfour", "lit": "a\n  b\n\nc\n", "fold": "a b\nc", "keep": "x\n\n", "end": "a b"}),
    ("url: https://e.f/a#b\ntime: 12:30\ndate: 2020-01-02\nzip: 007\nn: -1.5\ne: 1.0e+3\nbig: 123456789012345678901234567890", {"url": "https://e.f/a#b", "time": "12:30", "date": "2020-01-02", "zip": "007", "n": -1.5, "e": 1000.0, "big": 123456789012345678901234567890}),
    ("'a b': 1\n\"c:d\": 2\na: 3\na: 4", {"a b": 1, "c:d": 2, "a": 4}),
    ("m: {a: 1, 'b': [1,\n  2], c}\nl: []", {"m": {"a": 1, "b": [1, 2], "c": None}, "l": []}),
    ("", {}),
    ("- a\n- - b\n  - c", ["a", ["b", "c"]]),
]


@pytest.mark.parametrize(("text", "value"), CASES)
def test_read(text, value):
    assert json.loads(Y.to_json(text)) == value


@pytest.mark.parametrize("text", ["a: &x 1", "a: *x", "a: !t 1", "a: [1", 'a: "x', "a: b\n   c: d\n  e: f", "a: 1\n  b: 2", "\ta: 1", "a: [1] x", None])
def test_what_cannot_be_read_is_null(text):
    assert Y.to_json(text) is None


_TEXT = st.text(st.characters(exclude_categories=["Cs"]), max_size=12) | st.sampled_from(["yes", "null", "1", "1.5", "a: b", "- x", "# c", "x #y", "a\n\nb ", " lead", "[x", "{", "'q'", '"', "法:", "---", "~", "?", "-"])
_VALUE = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | _TEXT, lambda x: st.lists(x, max_size=4) | st.dictionaries(_TEXT, x, max_size=4), max_leaves=12)


@settings(max_examples=600, deadline=None)
@given(st.dictionaries(_TEXT, _VALUE, max_size=5))
def test_written_values_come_back(value):
    text = Y.to_yaml(json.dumps(value))
    assert json.loads(Y.to_json(text)) == value


def test_columns(spark):
    made = {"id": "JPLAW:1", "tags": ["a", "b"], "amend_law": {"n": 1, "text": "x\ny: z"}}
    rows = spark.createDataFrame([(1, json.dumps(made), "body\n--- x"), (2, "{}", "b"), (3, None, "plain"), (4, '{"amend_law": null}', "c")], "i int, fields string, body string")
    got = {r.i: r for r in rows.select("i", Y.parsed(Y.document(F.col("fields"), F.col("body"))).alias("x")).select("i", "x.json", "x.body", F.try_variant_get("x.front", "$.amend_law.text", "string").alias("t"), F.try_variant_get("x.front", "$.tags[1]", "string").alias("tag")).collect()}
    assert json.loads(got[1].json) == made and (got[1].body, got[1].t, got[1].tag) == ("body\n--- x", "x\ny: z", "b")
    assert (got[2].json, got[2].body, got[3].json, got[3].body) == ("{}", "b", None, "plain")
    more = {r.i: r.f for r in rows.select("i", Y.added(F.col("fields"), "amend_law", F.lit('{"k": 2}')).alias("f")).collect()}
    assert json.loads(more[1]) == made and json.loads(more[2]) == {"amend_law": {"k": 2}} and more[3] is None and json.loads(more[4]) == {"amend_law": None}


def test_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.md").write_text("---\nid: 1\namend_law:\n  laws:\n  - n: 民法\n---\n\n# T\n")
    (tmp_path / "y.md").write_text("no fields")
    (tmp_path / "z.md").write_text("---\na: [1\n---\nb")
    got = {r.path.rsplit("/", 1)[1]: (r.json, r.body, r.law) for r in landing.nested_markdown(spark, str(tmp_path)).select("path", "json", "body", F.try_variant_get("front", "$.amend_law.laws[0].n", "string").alias("law")).collect()}
    assert got == {"x.md": ('{"id": 1, "amend_law": {"laws": [{"n": "民法"}]}}', "# T", "民法"), "y.md": (None, "no fields", None), "z.md": (None, "b", None)}
