"""Citation cases: each text with the articles it links and the edges it makes.

The texts are made from sentence patterns, one for each rule, with laws and numbers put in.
"""

import itertools
import pickle
import re
import time

import pytest

from kasane.operators import citations

CORPUS = [("民事訴訟法", "408AC0000000109"), ("刑事訴訟法", "323AC0000000131"), ("刑法", "140AC0000000045")]
HELD = "民事訴訟法 刑事訴訟法"
DIGITS = "〇一二三四五六七八九"


def kanji(n):
    """A number up to 999."""
    out = ""
    for unit, sign in ((100, "百"), (10, "十"), (1, "")):
        d = n // unit % 10
        out += "" if not d else sign if d == 1 and sign else DIGITS[d] + sign
    return out


def art(n, branch=0):
    return f"第{kanji(n)}条" + (f"の{kanji(branch)}" if branch else "")


def to(law, n, branch=0):
    return f"{law}:第{n}条" + (f"の{branch}" if branch else "")


def cases():
    """(law, fragment, text, laws held, links (law:article), external targets, edges to laws)."""
    for own, n, m in itertools.product(("民事訴訟法", "刑事訴訟法"), (12, 340), (58, 207)):
        other = next(x for x in HELD.split() if x != own)
        # articles of the law itself, one or more, with a branch
        yield own, False, f"裁判所は、{art(n)}に定めるところにより、{art(m, 3)}の期間を延ばす。", HELD, f"{to(own, n)} {to(own, m, 3)}", "", 2
        # a law of the corpus before the number, and its range to further numbers
        yield own, False, f"その手続には{other}{art(n)}及び{art(m)}の例による。", HELD, f"{to(other, n)} {to(other, m)}", "", 2
        # old and new laws are read as the law
        yield own, False, f"なお旧{other}{art(n)}による。", HELD, to(other, n), "", 1
        # a reset word ends the range of another law
        yield own, False, f"{other}{art(n)}に従う。前条の申立ては、{art(m)}による。", HELD, f"{to(other, n)} {to(own, m)}", "", 2
        # a law outside, known by name, takes its numbers along without a link
        yield own, False, f"登録は特許法{art(n)}、{art(m)}の例による。", HELD, "", "", 0
        # a law outside with its number in brackets is an external edge
        yield own, False, f"港湾荷役法（昭和三十年法律第七十号）{art(n)}に定める者", HELD, "", f"external:港湾荷役法#main#{n}", 0
        yield own, False, f"又は港湾荷役法（昭和三十年法律第七十号）{art(n, 2)}に定める者", HELD, "", f"external:港湾荷役法#main#{n}_2", 0
        # the law names itself
        yield own, False, f"この法律{art(n)}を守る。", HELD, to(own, n), "", 1
        # fragments of amendments link only what a law's name stands before
        yield own, True, f"{art(n)}を削る。", HELD, "", "", 0
        yield own, True, f"{art(m)}を加え、{own}{art(n)}を削る。", HELD, to(own, n), "", 1
        yield own, True, f"{own}の{art(n)}を削る。", HELD, to(own, n), "", 1
        yield own, True, f"{own}（施行前のもの）{art(n)}を削る。", HELD, to(own, n), "", 1
        yield own, True, f"{own}" + "い" * 70 + art(n), HELD, "", "", 0
        yield own, True, f"著作権法{art(n)}を削る。", HELD, "", "", 0
    # a linked law that the corpus lacks has a link and no edge
    yield "民事訴訟法", False, f"刑法{art(41)}の者", HELD, to("刑法", 41), "", 0
    yield "民事訴訟法", False, "", HELD, "", "", 0


CASES = list(cases())


@pytest.mark.parametrize("held", sorted({c[3] for c in CASES}))
def test_cases(spark, held):
    own = [(i, c) for i, c in enumerate(CASES) if c[3] == held]
    ids = dict(CORPUS)
    corpus = spark.createDataFrame([(n, ids[n], True) for n in held.split()], "law_name string, law_id string, has_main boolean")
    rows = [(i, c[2], c[0], "X", "JPLAW:X#main#1", c[1]) for i, c in own] + [(-1, None, "民法", "X", "n", False)]
    texts = spark.createDataFrame(rows, "text_id long, text string, law_name string, law_id string, node_id string, fragment boolean")
    decided = citations.resolved(texts, corpus).cache()
    edges = citations.edges(decided, corpus).orderBy("text_id", "ord").collect()
    shown = {r.text_id: r.text for r in citations.linked_text(decided).collect()}
    for i, (_, _, text, _, links, external, n_edges) in own:
        found = [f"{m[1]}:{m[2]}" for m in re.finditer(r"\[\[laws/([^/]+)/本文/([^.]+)\.md\|", shown[i])]
        assert found == links.split(), text
        assert re.sub(r"\[\[[^|\]]+\|([^\]]+)\]\]", r"\1", shown[i]) == text
        assert [e.to for e in edges if e.text_id == i and e.kind] == external.split(), text
        assert sum(e.text_id == i and not e.kind for e in edges) == n_edges, text
    assert shown[-1] is None


def test_a_sentence_without_end_takes_time_in_proportion():
    """Tables and lists have no full stop: what stands before a citation is not read again for each of them."""
    known = citations.laws(frozenset(["民事訴訟法"]))
    one = f"{art(12)}、特許法{art(7)}（刑事訴訟法{art(9)}）[[a|{art(3)}]]及び民事訴訟法{art(5, 2)}と"
    took = {}
    for times in (500, 4000):
        at = time.process_time()
        found = citations.notes(one * times, "刑事訴訟法", True, known)
        took[times] = time.process_time() - at
        assert len(found) == 5 * times
        assert [x["scope"] for x in found[-5:]] == ["民事訴訟法"] * 5 and [x["linked_end"] for x in found[-5:]] == [None, None, "刑事訴訟法", None, "民事訴訟法"]
    assert took[4000] < 24 * took[500]


def test_a_dictionary_of_any_size(spark):
    """100,000 laws' names: the texts name some of them, right before a citation and as the scope of a sentence."""
    names = {f"第{i}号事業法": f"folder{i}" for i in range(100_000)}
    known = citations.laws(frozenset(), names, frozenset(f"他{i}法" for i in range(1000)))
    found = citations.notes(f"第77777号事業法{art(3)}及び{art(4)}。第5号事業法による。他999法の{art(5)}、{art(6)}", "民法", False, known)
    assert [(x["linked_end"], x["scope"], x["other_end"]) for x in found] == [("folder77777", None, None), (None, "folder77777", None), (None, None, "他999法"), (None, None, None)]
    assert len(pickle.dumps(known)) < 100_000_000


def test_a_bare_citation_in_a_fragment_before_its_provision(spark):
    """Before の規定に a fragment's citation needs a name right before it: the law's own, a linked one, or a word for itself."""
    texts = [f"民事訴訟法{art(3)}及び{art(4)}の規定により", f"民事訴訟法の{art(3)}の規定により", f"x刑法{art(3)}の規定に", f"この法律{art(3)}の規定に", f"特許法{art(3)}の規定に"]
    rows = [(10 * f + i, t, "民事訴訟法", "X", "n", bool(f)) for i, t in enumerate(texts) for f in (0, 1)]
    table = spark.createDataFrame(rows, "text_id long, text string, law_name string, law_id string, node_id string, fragment boolean")
    corpus = spark.createDataFrame([(n, i, True) for n, i in CORPUS[:1]], "law_name string, law_id string, has_main boolean")
    got = {r.text_id: r.a for r in citations.resolved(table, corpus).selectExpr("text_id", "transform(cited, c -> c.action) AS a").collect()}
    assert got == {0: ["link", "link"], 10: ["link", "plain"], 1: ["link"], 11: ["link"], 2: ["link"], 12: ["link"], 3: ["link"], 13: ["link"], 4: ["plain"], 14: ["plain"]}


def test_a_long_text_is_read_sentence_by_sentence(spark):
    own, other = "民事訴訟法", "刑事訴訟法"
    one = f"裁判所は、{art(12)}によるほか、{other}{art(58)}及び{art(7, 2)}の例による。" + "あ" * 310 + f"{art(9)}に従う。"
    times = 1500
    corpus = spark.createDataFrame([(n, i, True) for n, i in CORPUS[:2]], "law_name string, law_id string, has_main boolean")
    texts = spark.createDataFrame([(i, one * n, own, "X", "n", False) for i, n in ((1, 1), (2, times))], "text_id long, text string, law_name string, law_id string, node_id string, fragment boolean")
    decided = citations.resolved(texts, corpus).selectExpr("text_id", "inline(cited)").groupBy("text_id", "action", "target_law", "number").count().collect()
    got = {(r.text_id, r.action, r.target_law, r.number): r["count"] for r in decided}
    want = [("link", own, "12"), ("link", other, "58"), ("link", other, "7_2"), ("link", own, "9")]
    assert got == {(i, *w): n for i, n in ((1, 1), (2, times)) for w in want}
