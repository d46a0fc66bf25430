"""Structure, integrity, snapshots, rewriting, catalogue, sources and the streaming log on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from kasane.operators import catalogue, explicit, integrity, rewrite, snapshots, structure, tree
from kasane.plans.components import connected_components
from kasane.sources import landing
from kasane.streaming import pending

TREE = {
    "tag": "Law",
    "attr": {},
    "children": [
        {
            "tag": "MainProvision",
            "children": [
                {
                    "tag": "Chapter",
                    "attr": {"Num": "2_2"},
                    "children": [
                        {"tag": "ChapterTitle", "children": ["第二章の二"]},
                        {"tag": "Section", "attr": {"Num": "1"}, "children": [{"tag": "Article", "attr": {"Num": "1"}, "children": [{"tag": "ArticleCaption", "children": ["(題)"]}, {"tag": "Paragraph", "children": [{"tag": "Sentence", "children": ["甲"]}, {"tag": "Item", "children": [{"tag": "Sentence", "attr": {"Function": "proviso"}, "children": ["乙"]}]}]}]}]},
                    ],
                },
                {"tag": "Chapter", "attr": {"Num": "3"}, "children": [{"tag": "Article", "attr": {"Num": "2"}, "children": []}, {"tag": "Article", "attr": {"Num": ""}}]},
                {"tag": "Article", "attr": {"Num": "3"}},
            ],
        },
        {"tag": "SupplProvision", "attr": {"AmendLawNum": "平成一一年法律第八七号"}, "children": [{"tag": "Article", "attr": {"Num": "1"}}]},
        {"tag": "SupplProvision", "children": [{"tag": "Paragraph", "children": [{"tag": "Sentence", "children": ["丙"]}]}]},
    ],
}


def test_tree(spark):
    laws = spark.createDataFrame([("L", json.dumps(TREE)), ("bad", "{"), ("none", None)], "law_id string, tree string")
    nodes = tree.flatten(laws).cache()
    assert nodes.select("law_id").distinct().collect() == [("L",)]
    rows = {(r.part, r.article_num): r for r in tree.articles(nodes).collect()}
    assert set(rows) == {("main", "1"), ("main", "2"), ("main", "3"), ("suppl", "1")}
    one, two, three = rows["main", "1"], rows["main", "2"], rows["main", "3"]
    assert (one.chapter_num, one.chapter_title, one.section_num, one.heading, one.has_proviso) == (22, "第二章の二", 1, "(題)", True)
    assert (two.chapter_num, two.section_num, three.chapter_num, three.has_proviso) == (3, None, None, False)
    texts = sorted((r.kind, r.text) for r in tree.passages(nodes).collect())
    assert texts == [("item", "乙"), ("paragraph", "丙"), ("paragraph", "甲乙")]
    assert [r.node_id for r in tree.provisions(nodes).collect()] == ["JPLAW:L#suppl#Provision"]
    assert tree.first_child(nodes, "Chapter", "Article").count() == 1
    top = nodes.where("tag = 'Chapter'").count()
    assert tree.descendants(nodes, "Chapter", "Chapter").count() == top


def test_structure(spark):
    rows = [("L", 1, "一", 1, None, "a", "1", 1), ("L", 1, None, 1, None, "b", "2", 2), ("L", 1, None, None, None, "c", "3", 3), ("L", None, None, None, None, "d", "4", 4)]
    articles = spark.createDataFrame(rows, "law_id string, chapter_num int, chapter_title string, section_num int, section_title string, node_id string, article_num string, pos int")
    one = structure.chapters(articles).collect()
    assert [(r.chapter_title, r.node_ids, r.section_count) for r in one] == [("一", ["a", "b", "c"], 1)]
    assert structure.containment(articles.union(articles)).count() == 5
    refs = spark.createDataFrame([("a", "b", "refers_to", "第二条", 0.9, "regex_v2", None), ("a", "external:x", "refers_to", "第一条", 0.9, "regex_v2", "external_ref")], landing.EDGES_V1)
    assert sorted(r.relation for r in structure.edges_v2(refs).collect()) == ["external", "internal"]
    assert structure.graph(refs, articles).count() == 7
    kinds = spark.createDataFrame([("民法", "main", 1, 6), ("民法", "main", 26, None), ("民法", "main", None, None), ("民法", "suppl", 1, 1), ("", "main", 1, 1)], "l string, p string, c int, s int")
    no = F.lit(None).cast("string")
    got = [r[0] for r in kinds.select(structure.parent(F.col("l"), F.col("p"), F.col("c"), no, F.col("s"), no)).collect()]
    assert got == ["[[laws/民法/節/第1章第6節]]", "[[laws/民法/章/第26章]]", "[[laws/民法/民法]]", "[[laws/民法/民法]]", None]


def test_broken_links(spark):
    files = spark.createDataFrame([("laws/x/a.md", "[[laws/x/b]] [[c|l]] [[laws/none]]\n[[https://x]] [[d]] [[top]]"), ("laws/x/c.md", ""), ("top.md", ""), ("laws/x/b.md", "")], "path string, text string")
    links = integrity.links_by_line(files)
    got = sorted((r.line_no, r.shown) for r in integrity.broken(links, files, ["laws"]).collect())
    assert got == [(1, "laws/none.md"), (2, "laws/x/d.md")]
    ignored = spark.createDataFrame([("none",)], "pattern string")
    left = integrity.not_ignored(integrity.broken(links, files, ["laws"]), ignored)
    assert [(r.shown, r.n, r.sources) for r in integrity.report(left).collect()] == [("laws/x/d.md", 1, ["laws/x/a.md:2"])]


def test_ranges(spark):
    files = spark.createDataFrame([("L", n) for n in ("第10:20条.md", "第10条から第20条まで.md", "第14条から第16条まで.md", "第15条から第17条まで.md", "第1条.md", "第1条から第900条まで.md")], "law_name string, name string")
    ranges = integrity.article_ranges(files)
    assert ranges.count() == 4 and "第10条から第20条まで.md" in {r.name for r in ranges.collect()}
    links = spark.createDataFrame([(1, "L", 15), (2, "L", 12), (3, "L", 500), (4, "L", 1000), (5, "M", 15), (6, "L", None)], "link_id int, law_name string, num int")
    assert sorted((r.link_id, r.start, r.end) for r in integrity.redirected(links, ranges).collect()) == [(1, 15, 17), (2, 10, 20), (3, 1, 900)]
    unresolved = links.withColumns({"source": F.concat(F.lit("s"), "link_id"), "from_main": F.lit(True)})
    assert sorted((r.law_name, r.num, r.referenced_by) for r in integrity.stubs(unresolved, ranges).collect()) == [("L", 1000, ["s4"]), ("M", 15, ["s5"])]


def test_snapshots(spark):
    a = spark.createDataFrame([("p", "1"), ("q", "2"), ("r", "3")], "path string, body string")
    b = spark.createDataFrame([("p", "1"), ("q", "x"), ("章/n", "4"), ("m", "5")], "path string, body string")
    assert sorted((r.path, r.status) for r in snapshots.file_diff(a, b).collect()) == [("m", "new"), ("p", "same"), ("q", "changed"), ("r", "missing"), ("章/n", "structure")]
    e = spark.createDataFrame([("a", "b")] * 3 + [("c", None)], "source string, target string")
    f = spark.createDataFrame([("a", "b")] + [("d", "e")] * 2 + [("c", None)], "source string, target string")
    diff = snapshots.multiset_diff(e, f, ["source", "target"])
    assert sorted((r.source, r.side, r.n) for r in diff.collect()) == [("a", "missing", 2), ("d", "new", 2)]
    same = snapshots.verdict(snapshots.file_diff(a, a), snapshots.multiset_diff(e, e, ["source", "target"])).first()
    assert same.compatible
    assert not snapshots.verdict(snapshots.file_diff(a, b), diff).first().compatible


def test_explicit_references(spark):
    texts = spark.createDataFrame([(1, "第三条第二項及び同条第四項", 5), (2, "前二条、次条第一項第二号", 2), (3, "同条の規定", 1), (4, "第三の二条と第三条の二", 1), (5, "第三条、第三条", 1), (6, None, 1)], "text_id int, text string, article int")
    available = spark.createDataFrame([("第3条",)], "article_name string")
    got = sorted((r.text_id, r.target_id, r.type, r.resolved) for r in explicit.references(texts, available).collect())
    assert got == [
        (1, "第3条#第2項", "absolute", True),
        (1, "第3条#第4項", "relative", True),
        (2, "第1条", "relative", False),
        (2, "第3条#第1項第2号", "relative", True),
        (3, "UNRESOLVED", "relative", False),
        (4, "第3条", "absolute", True),
        (4, "第3条の2", "absolute", False),
        (5, "第3条", "absolute", True),
    ]


def test_rewriting(spark):
    link = "[[laws/民法/本文/第27条.md|第二十七条]]"
    bodies = spark.createDataFrame([(1, "民法", f"この{link}と{link}"), (2, "民法", f"旧民法{link}及び{link}"), (3, "民法", "なし"), (4, "民法", f"{'あ' * 60}{link}")], "i int, law_name string, body string")
    got = {r.i: (r.body, r.n_unlinked, r.n_kept) for r in rewrite.unlinked(bodies).collect()}
    assert got == {1: ("この第二十七条と第二十七条", 2, 0), 2: (f"旧民法{link}及び{link}", 0, 2), 3: ("なし", 0, 0), 4: ("あ" * 60 + "第二十七条", 1, 0)}
    back = {r.i: r.body for r in rewrite.relinked(spark.createDataFrame([(1, "民法", "旧民法の例による第二十七条。第三条")], "i int, law_name string, body string")).collect()}
    assert back == {1: f"旧民法の例による{link}。第三条"}
    paths = spark.createDataFrame([("laws/x/suppl/Article_1.md",), ("laws/x/main/Article_3_2.md",), ("laws/x/x.md",)], "path string")
    assert [r.new_path for r in rewrite.localized_paths(paths).collect()] == ["laws/x/附則/附則第1条.md", "laws/x/本文/第3条の2.md", "laws/x/x.md"]


def test_catalogue(spark):
    laws = spark.createDataFrame([("1", "民法", "明治二十九年法律第八十九号", None, ["民事", "無"]), ("2", None, "", None, [])], "law_id string, law_name string, law_num string, promulgation_date string, classes array<string>")
    none = spark.createDataFrame([("2", ["特別"])], "law_id string, domains array<string>")
    assert {r.law_id: r.domain for r in catalogue.entries(laws, none).collect()} == {"1": ["その他", "民事法"], "2": ["特別"]}
    hits = spark.createDataFrame([("1", 10, 1, "other"), ("1", 11, 2, "民法 の一部"), ("2", 12, 1, "x")], "law_id string, hit_id int, ord int, title string")
    assert [tuple(r) for r in catalogue.best_hit(laws, hits).collect()] == [("1", 11, 2)]


def test_sources(spark, tmp_path):
    root = f"file://{tmp_path}"
    (tmp_path / "list.json").write_text(json.dumps({"laws": [{"law_info": {"law_id": "A", "law_num": "1"}, "revision_info": {"law_title": "甲法"}}, {"law_info": {"law_id": "B"}}]}))
    assert [tuple(r) for r in landing.law_list(spark, f"{root}/list.json").collect()] == [("A", "甲法", "1", ""), ("B", "", "", "")]
    (tmp_path / "trees").mkdir()
    (tmp_path / "trees/A.json").write_text(json.dumps({"law_full_text": TREE}))
    (tmp_path / "trees/B.json").write_text("{}")
    assert tree.flatten(landing.law_trees(spark, f"{root}/trees")).select("law_id").distinct().collect() == [("A",)]
    (tmp_path / "edges.jsonl").write_text('{"from":"a","to":"b"}\n\nbroken\n')
    assert [r["from"] for r in landing.edge_log(spark, f"{root}/edges.jsonl").where("`from` is not null").collect()] == ["a"]
    (tmp_path / "ignore.txt").write_text("# all\nabc # tail\n\nabc\n")
    assert [r.pattern for r in landing.ignore_patterns(spark, f"{root}/ignore.txt").collect()] == ["abc"]
    (tmp_path / "targets.yaml").write_text("targets:\n  - A # x\n  - 'B'\n")
    assert sorted(r.law_id for r in landing.target_list(spark, f"{root}/targets.yaml").collect()) == ["A", "B"]
    (tmp_path / "md/x").mkdir(parents=True)
    (tmp_path / "md/x/n.md").write_text("---\nid: 1\n---\n\nbody\n")
    row = landing.markdown(spark, f"{root}/md").first()
    assert row.fields == {"id": "1"} and row.body == "body" and row.path.endswith("md/x/n.md")
    (tmp_path / "rss.xml").write_text("<rss><channel><item><title>t</title><link>l</link></item></channel></rss>")
    assert [r.title for r in landing.search_hits(spark, f"{root}/rss.xml").collect()] == ["t"]
    (tmp_path / "dc.xml").write_text('<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><item><title>a</title><dc:creator>c</dc:creator><dc:date>1896</dc:date></item><item><title>b</title><dc:publisher>p</dc:publisher></item></channel></rss>')
    assert [(r.ord, r.title, r.creator, r.date, r.publisher) for r in landing.search_hits(spark, f"{root}/dc.xml").orderBy("ord").collect()] == [(0, "a", "c", "1896", None), (1, "b", None, None, "p")]
    with pytest.raises(Exception, match="no law_full_text for B"):
        landing.law_trees(spark, f"{root}/trees", strict=True).collect()
    assert landing.target_list(spark, f"{root}/none.yaml").count() == 0
    (tmp_path / "laws/民法/本文").mkdir(parents=True)
    (tmp_path / "laws/.git").mkdir()
    for name in ("民法/b.md", "民法/a.md", "民法/本文/第1条.md", ".git/x.md"):
        (tmp_path / "laws" / name).write_text("x")
    folders = catalogue.law_folders(landing.file_paths(spark, f"{root}/laws"))
    assert [(r.law_name, r.n_files, r.law_file.rsplit("/", 1)[1]) for r in folders.collect()] == [("民法", 3, "a.md")]
    laws = spark.createDataFrame([("1", "民法"), ("2", "刑法")], "law_id string, folder string")
    placed = catalogue.law_places(spark.createDataFrame([("1",), ("2",), ("3",), (None,)], "law_id string"), laws, folders)
    assert sorted((str(r.law_id), r.folder, r.law_file is not None) for r in placed.collect()) == [("1", "民法", True), ("2", "刑法", False), ("3", None, False), ("None", None, False)]
    landing.write_edges(landing.edge_log(spark, f"{root}/edges.jsonl").where("`from` is not null"), f"{root}/out")
    assert spark.read.text(f"{root}/out").first()[0] == '{"from":"a","to":"b"}'


def test_pending_stream(spark, tmp_path):
    (tmp_path / "log").mkdir()
    rows = [{"id": "1", "ts": "2026-01-01T00:00:00", "kind": "unknown"}, {"id": "1", "ts": "2026-01-01T00:00:01", "kind": "unknown"}, {"id": "2", "ts": "2026-01-01T00:00:02", "kind": "external_law"}]
    (tmp_path / "log/a.json").write_text("\n".join(map(json.dumps, rows)))
    once = pending.first_entries(pending.stream(spark, f"file://{tmp_path}/log"))
    query = once.select("id", "kind").writeStream.format("memory").queryName("pending_once").option("checkpointLocation", f"file://{tmp_path}/c").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r.id for r in spark.table("pending_once").collect()) == ["1", "2"]


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), (None, 1), (7, 8), (8, 6), (3, 2)] + [(100 + i, 101 + i) for i in range(30)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 6, 8: 6} | {100 + i: 100 for i in range(31)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
