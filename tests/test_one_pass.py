"""What is read, shuffled or worked out once, and was more than once before."""

import __spark_entry__
import pytest

from kasane.operators import citations, integrity
from kasane.plans import statutes

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_openings_that_texts_share_are_read_once(monkeypatch):
    known, calls, sentence = citations.laws(frozenset({"刑法"})), [], citations._sentence
    monkeypatch.setattr(citations, "_sentence", lambda *a: calls.append(1) or sentence(*a))
    found = [citations.notes(f"民法第{i}条は", "刑法", False, known)[0] for i in range(1, 200)]
    assert len(calls) == 1 and {x["linked_end"] for x in found} == {"民法"} and [x["main"] for x in found] == [str(i) for i in range(1, 200)]


@pytest.mark.parametrize("text", ["（民法第一条）", "[[laws/x.md|民法第一条]]", "民法（昭和）第一条の規定に第二条", "改める。\n\n民法第一条", "あ" * 101 + "第一条", "あ" * 100 + "第一条"])
def test_openings_give_what_whole_texts_give(text, monkeypatch):
    known = citations.laws(frozenset({"刑法", "民法"}))
    both = [citations.notes(text, "刑法", f, known) for f in (False, True)]
    monkeypatch.setattr(citations, "_opening", lambda *_: None)
    assert both == [citations.notes(text, "刑法", f, known) for f in (False, True)] and both[0]


def test_citations_are_not_shuffled_by_law(spark):
    assert "hashpartitioning(target_law" not in plan(__spark_entry__.queries()["q_edges"](spark, SF))


def test_line_items_are_shuffled_once(spark):
    assert plan(statutes.line_items(spark, SF)).count("Exchange") == 1


def test_line_items_are_read_twice_for_applied_references(spark):
    assert plan(__spark_entry__.queries()["q_applied"](spark, SF)).count("FileScan parquet") == 2


def test_explicit_references_are_worked_out_once(spark):
    df = __spark_entry__.queries()["q_explicit_refs"](spark, SF)
    assert "(size(concat(" not in plan(df) and "Contains(text" in plan(df)


def test_names_are_looked_for_where_their_last_letters_stand(spark):
    rows = [("あ" * 300, "missing_article"), ("少年法" + "あ" * 197, "external_law"), ("少年法" + "あ" * 198, "missing_article"), ("方法は", "missing_article"), (None, "missing_article"), ("", "missing_article")]
    df = spark.createDataFrame(rows, "context string, want string")
    got = df.select("want", integrity.unresolved_reason(df.context).alias("got"))
    assert all(r.got == r.want for r in got.collect()) and "Contains(" in plan(got)
