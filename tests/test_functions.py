"""Scalar functions: fixed pairs of input and result."""

import pytest
from pyspark.sql import functions as F

from kasane.functions import links as L
from kasane.functions import names as N
from kasane.functions import numerals as K


def check(spark, function, pairs, kind="string"):
    rows = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(pairs)], f"i int, x {kind}")
    got = [r[0] for r in rows.select("i", function(F.col("x")).alias("y")).orderBy("i").select("y").collect()]
    assert got == [b for _, b in pairs]


def test_numerals(spark):
    check(spark, K.kanji_number, [("二十三", 23), ("百二", 102), ("一一", 11), ("千二百三十四", 1234), ("", 0), ("45", 45), ("１２", 12), ("十万", 10010), ("二万三", 20003), ("あ", 0), (None, None), ("百九十九", 199)])
    check(spark, lambda x: K.to_kanji(x), [(1, "一"), (10, "十"), (11, "十一"), (100, "百"), (1234, "千二百三十四"), (9009, "九千九"), (0, None), (10000, None)], "int")
    check(spark, K.digits, [("平成一一年", "平成11年"), ("〇八", "08")])
    check(spark, K.loose_int, [("2_2", 22), ("18_2", 182), ("１２", 12), ("x", None), ("", None), (" 7 ", 7), ("_2", None), (None, None)])


def test_amendment_keys(spark):
    check(spark, K.amendment_key, [("平成一一年七月一六日法律第八七号", "H11_L87"), ("令和3年法律第37号", "R3_L37"), ("H11_L87", "H11_L87"), ("某 法-1", "某_法_1")])
    check(spark, K.amendment_title, [("H11_L87", "平成11年法律第87号"), ("x", "x")])
    check(spark, K.amendment_key_of_path, [("附則/改正法/令和3年法律第37号/附則第1条.md", "R3_L37"), ("附則/第1条.md", None)])


def test_names(spark):
    check(spark, N.article_name, [("1", "第1条"), ("19_3", "第19条の3"), ("1_2_3", "第1の2の3条")])
    check(spark, N.localized_article, [("Article_3_2", "第3条の2"), ("73:76", "第73条から第76条まで"), ("Article_1", "第1条")])
    check(spark, N.main_article, [("laws/刑法/本文/第199条.md", 199), ("第3条の2#第1項", 3), ("附則第4条", 4), ("x", None)])
    check(spark, N.plain_article, [("第156条#第1項", 156), ("第3条の2", None), ("laws/民法/本文/第7条.md", 7)])
    check(spark, lambda x: N.sort_key(x)["main"], [("第3条の2.md", 3), ("総則", 99999)])
    for name, want in (("第1条の2.md", (1, 2, 0)), ("第638:640条.md", (638, 0, 640)), ("init_0_第3条の2.md", (3, 2, 0)), ("附則第1条.md", (1, 0, 0)), ("x.md", (0, 0, 0))):
        assert tuple(spark.createDataFrame([(name,)], "x string").select(N.contents_key(F.col("x")).alias("k")).first()["k"]) == want
    check(spark, N.safe_file_name, [(' a/b:c* ', "a_b_c_"), ("..x.", "x"), ("　法　", "法")])


@pytest.mark.parametrize(("number", "title", "chapter", "section", "old_chapter"), [(1, None, "第1章", "第1節", "第1章"), (100, None, "第100章", "第100節", "第10章の0"), (182, None, "第18章の2", "第182節", "第18章の2"), (22, "第二章の二", "第2章の2", "第22節", "第2章の2"), (42, "第四節の二", "第42章", "第4節の2", "第42章"), (110, None, "第110章", "第110節", "第11章の0")])
def test_chapters(spark, number, title, chapter, section, old_chapter):
    row = spark.createDataFrame([(number, title)], "n int, t string")
    n, t = F.col("n"), F.col("t")
    assert tuple(row.select(N.chapter_name(n, t), N.section_name(n, t), N.migrated_chapter_name(n, t)).first()) == (chapter, section, old_chapter)


def test_links(spark):
    check(spark, L.without_links, [("a [[x/y.md|第一条]] b [[z]]", "a 第一条 b z")])
    check(spark, L.target, [("a/b|c", "a/b"), ("a#h", "a"), ("a^b", "a"), ("#h", None), ("https://x", None), ("mailto:x", None), (" a ", "a")])
    check(spark, L.trimmed_lines, [("a  \nb　\n\n\n", "a\nb\n")])
    check(spark, L.repaired_front, [("---id: 1\nx", "---\nid: 1\nx"), ("---\nid: 1", "---\nid: 1")])
    check(spark, L.without_empty_headings, [("## \nx\n## t\n", "x\n## t\n")])


def test_front_matter(spark):
    row = spark.createDataFrame([("---\nid: 'a'\ntier: 1\nlist:\n  - x\n---\n\nbody --- more",)], "x string").select(L.front_matter(F.col("x")).alias("p")).select(L.simple_fields(F.col("p.raw_yaml")).alias("f"), "p.body").first()
    assert row["f"] == {"id": "a", "tier": "1", "list": ""} and row["body"] == "body --- more"
    assert spark.createDataFrame([("no front",)], "x string").select(L.front_matter(F.col("x"))["body"]).first()[0] == "no front"
