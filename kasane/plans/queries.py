"""Queries of the engine's own operators over the derived statutes and the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kasane.functions import frontmatter as Y
from kasane.functions import links as L
from kasane.functions import names as N
from kasane.functions import numerals as K
from kasane.operators import catalogue, citations, explicit, incremental, integrity, nodes, renames, repair, rewrite, snapshots, structure, tree
from kasane.plans import statutes
from kasane.plans.staging import fresh_path, stage
from kasane.plans.statutes import table
from kasane.sources import readthrough

QUERIES: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citations.resolved(statutes.sentences(spark, sf_dir), statutes.corpus(spark))


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citations.edges(_decided(spark, sf_dir), statutes.corpus(spark))


@query
def q_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference edges of all sentences."""
    return _edges(spark, sf_dir).select("text_id", "ord", "from", "to", "evidence", "kind")


@query
def q_edges_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences with their links."""
    return citations.linked_text(_decided(spark, sf_dir))


@query
def q_scope_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of texts whose laws are named further before: boundaries, scopes and their ends, 300 characters of look-back, quotations, fragments, and bare citations before の規定に in them."""
    n, m = F.expr("o_orderkey % 900 + 1"), F.expr("o_custkey % 900 + 1")
    at = lambda x: F.concat(F.lit("第"), x, F.lit("条"))
    orders = table(spark, sf_dir, "orders").repartition(3 * spark.sparkContext.defaultParallelism, "o_orderkey").select("o_orderkey", "o_custkey", K.to_kanji(n).alias("n"), K.to_kanji(m).alias("m"))
    n, m = F.col("n"), F.col("m")
    pad = F.expr("repeat('あ', element_at(array(0, 100, 200, 293, 294, 400), int(o_custkey % 6) + 1))")
    own, other = F.lit("民事訴訟法"), F.lit("刑事訴訟法")
    parts = (
        (F.lit("これは旧"), other, at(n), F.lit("による。")),
        (F.lit("登録は特許法"), at(n), F.lit("、"), at(m), F.lit("の例による。")),
        (F.lit("登録は特許法"), at(n), F.lit("による。"), pad, at(m), F.lit("に従う。")),
        (F.lit("特許法の登録者"), pad, at(m), F.lit("に従う。")),
        (F.lit("特許法の「登録。」者"), at(m), F.lit("に従う。")),
        (other, at(n), F.lit("に従い、当該"), at(m), F.lit("を読む。")),
        (other, at(n), F.lit("及び"), pad, at(m), F.lit("の例による。")),
        (own, F.expr("element_at(array('', 'の', '、'), int(o_custkey % 3) + 1)"), at(n), F.lit("を削る。")),
        (pad, at(n), F.lit("を削る。")),
        (own, F.lit("い" * 70), at(n), F.lit("を削る。")),
        (F.lit("この法律"), at(n), F.lit("及び"), at(m), F.lit("を守る。")),
        (F.lit("改める前の"), own, at(n), F.lit("及び"), at(m), F.lit("の規定により定め、"), at(n), F.lit("の規定に従う。")),
        (own, at(n), F.lit("及び"), at(m), F.lit("の規定に従い、"), other, at(n), F.lit("の規定に従う。")),
        (own, F.expr("element_at(array('', 'の', '、'), int(o_custkey % 3) + 1)"), at(n), F.lit("の規定に従う。")),
        (own, at(n), F.lit("及び"), at(m), F.lit("の規定に従う。")),
    )
    text = F.coalesce(*(F.when(F.expr(f"o_orderkey % {len(parts)} = {i}"), F.concat(*p)) for i, p in enumerate(parts)))
    law_id = dict(statutes.LAWS)["民事訴訟法"]
    texts = orders.select(
        F.col("o_orderkey").alias("text_id"), text.alias("text"), own.alias("law_name"), F.lit(law_id).alias("law_id"), F.lit(f"JPLAW:{law_id}#main#0").alias("node_id"), F.expr("o_orderkey % 15 in (7, 8, 9, 11, 12, 13)").alias("fragment")
    )
    corpus = statutes.corpus(spark)
    return citations.edges(citations.resolved(texts, corpus), corpus).select("text_id", "ord", "to", "evidence")


@query
def q_edge_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference edges of the unified schema, counted by their kind and source law."""
    rows = structure.edges_v2(_edges(spark, sf_dir))
    return rows.groupBy("type", "relation", F.substring_index("source", "#", 1).alias("law")).agg(F.count("*").alias("n"), F.count_distinct("target").alias("targets"))


@query
def q_kanji_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as kanji and back."""
    n = F.expr("l_orderkey % 9999 + 1")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", K.kanji_number(K.to_kanji(n)).alias("parsed"))


@query
def q_kanji_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers written digit by digit, read as a number and as digits."""
    text = F.translate(F.expr("string(o_orderkey % 1000)"), "0123456789", "〇一二三四五六七八九")
    return table(spark, sf_dir, "orders").select("o_orderkey", K.kanji_number(text).alias("number"), K.digits(text).alias("digits"))


@query
def q_article_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article names by identifier, file and range."""
    rows = statutes.articles(spark, sf_dir)
    span = F.concat(F.expr("pos div 8 + 1"), F.lit(":"), F.expr("pos div 8 + 4"))
    return rows.select("pos", N.article_name(F.col("article_num")).alias("name"), N.localized_article(F.concat(F.lit("Article_"), "article_num"), F.expr("pos % 2 = 0")).alias("file"), N.localized_article(span).alias("span"))


@query
def q_article_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank of each article within its law."""
    from pyspark.sql import Window

    rows = statutes.articles(spark, sf_dir)
    key = N.sort_key(N.article_name(F.col("article_num")))
    return rows.select("pos", "law_name", F.row_number().over(Window.partitionBy("law_name").orderBy(key, "pos")).cast("long").alias("rank"), key["main"].alias("main"), key["sub"].alias("sub"))


@query
def q_amendment_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of amendment titles in kanji and in digits, and titles of keys."""
    year, number = F.expr("string(year(o_orderdate) - 1988)"), F.expr("string(o_orderkey % 300 + 1)")
    kanji = lambda x: F.translate(x, "0123456789", "〇一二三四五六七八九")
    title = F.when(F.expr("o_orderkey % 2 = 0"), F.concat(F.lit("平成"), kanji(year), F.lit("年六月一日法律第"), kanji(number), F.lit("号"))).otherwise(F.concat(F.lit("令和"), year, F.lit("年法律第"), number, F.lit("号")))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", title.alias("title")).withColumn("key", K.amendment_key(F.col("title")))
    path = F.concat(F.lit("附則/改正法/"), "title", F.lit("/附則第1条.md"))
    return rows.select("o_orderkey", "key", K.amendment_title(F.col("key")).alias("title"), K.amendment_key_of_path(path).alias("of_path"))


@query
def q_chapter_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapter and section names of the builder and of migrations."""
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", "p_size * 5 AS num", "if(p_partkey % 3 = 0, '第二章の二 節の三', '総則') AS title")
    n, t = F.col("num"), F.col("title")
    return rows.select("p_partkey", N.chapter_name(n, t).alias("chapter"), N.section_name(n, t).alias("section"), N.migrated_chapter_name(n, t).alias("old_chapter"), N.migrated_section_name(n, t).alias("old_section"))


@query
def q_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses as file names."""
    return table(spark, sf_dir, "pages").select("page_id", N.safe_file_name(F.concat(F.lit(" .."), "url", F.lit(". "))).alias("name"))


@query
def q_link_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What links in bodies name, and bodies without link marks."""
    content = F.concat("url", F.lit("|"), F.lit("label"))
    inner = F.expr("concat('laws/p', page_id, if(page_id % 2 = 0, '#h', ''), if(page_id % 3 = 0, '^b', ''), '|text')")
    body = F.concat(F.lit("a [["), inner, F.lit("]] b [[plain]]"))
    return table(spark, sf_dir, "pages").select("page_id", L.target(content).alias("web"), L.target(inner).alias("target"), L.without_links(body).alias("plain"), F.size(L.contents(body)).cast("long").alias("n_links"))


@query
def q_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containment edges of all chapters and sections."""
    return structure.containment(statutes.articles(spark, sf_dir))


@query
def q_chapter_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapters with their articles in order and the number of their sections."""
    rows = structure.chapters(statutes.articles(spark, sf_dir))
    return rows.select("law_id", "chapter_num", "chapter_title", F.array_join("article_nums", ",").alias("article_nums"), F.size("node_ids").cast("long").alias("n_articles"), "section_count")


@query
def q_section_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections with their articles in order."""
    rows = structure.sections(statutes.articles(spark, sf_dir))
    return rows.select("law_id", "chapter_num", "section_num", "section_title", F.array_join("node_ids", ",").alias("node_ids"))


@query
def q_structure_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapter and section nodes with their bodies."""
    rows = nodes.structure_nodes(statutes.articles(spark, sf_dir))
    return rows.select("id", "type", "parent", "path", "body", F.coalesce("section_count", F.lit(0)).alias("section_count"), F.array_join("article_ids", ",").alias("article_ids"), F.array_join("tags", ",").alias("tags"))


@query
def q_article_front(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Front matter of articles, supplements and fragments of amendments."""
    rows = statutes.articles(spark, sf_dir).selectExpr("*", "if(pos % 13 = 0, 'suppl', 'main') AS part", "pos % 26 = 0 AS fragment", "if(pos % 52 = 0, null, concat('平成', pos % 9 + 1, '年六月法律第', pos % 90 + 1, '号')) AS amend_law_num", "pos % 3 = 0 AS has_proviso")
    made = nodes.article_front(rows)
    return made.select("id", "type", "parent", F.array_join("tags", ",").alias("tags"), "has_proviso", "suppl_kind", "amendment_law_id", "amendment_law_title", F.col("amend_law.scope").alias("scope"), F.col("amend_law.parent_law_name").alias("parent_law_name"))


@query
def q_visible_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that a scan sees: hidden ones left out, under a prefix that exists, and under one that does not."""
    files = table(spark, sf_dir, "customer").selectExpr("concat('laws/', if(c_custkey % 7 = 0, '.git/', ''), 'x', c_nationkey, '/', if(c_custkey % 5 = 0, '.', ''), c_custkey, '.md') AS path")
    some = integrity.visible(files, "laws/x3").select("path", F.lit("prefix").alias("scan"))
    return some.union(integrity.visible(files, "none").select("path", F.lit("all").alias("scan")))


@query
def q_pending_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending links of one law and one kind."""
    rows = table(spark, sf_dir, "events").selectExpr("event_id AS id", "if(event_id % 2 = 0, 'external_law', 'amendment_self') AS kind", f"{statutes._pick('user_id % 8', 0)} AS src_law_name")
    return integrity.pending_of(rows, statutes.LAWS[1][0], "external_law")


@query
def q_redirect_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose links may be led to ranges."""
    files = table(spark, sf_dir, "part").selectExpr("p_partkey AS file_id", "p_brand AS law_name", "case p_partkey % 4 when 0 then concat(p_brand, '.md') when 1 then concat('第', p_partkey, ':9条.md') else concat('第', p_partkey, '条.md') end AS name", "if(p_partkey % 6 = 0, 'amendment', nullif('', '')) AS suppl_kind")
    return integrity.redirect_sources(files).select("file_id", "name")


@query
def q_amend_law(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested records of amending laws where they are missing."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "case o_orderkey % 3 when 0 then 'amendment' when 1 then 'initial' end AS suppl_kind", "if(o_orderkey % 9 = 0, null, concat('平成', o_orderkey % 9 + 1, '年五月法律第', o_custkey, '号')) AS amendment_law_title", "'L1' AS law_id", "o_orderstatus AS law_name",
        "if(o_orderkey % 12 = 0, named_struct('num', 'kept', 'normalized_id', 'k', 'scope', 'full', 'parent_law_id', 'x', 'parent_law_name', 'y'), null) AS amend_law",
    )
    return nodes.with_amend_law(rows).select("id", "changed", F.col("amend_law.normalized_id").alias("normalized_id"), F.col("amend_law.scope").alias("scope"), F.col("amend_law.parent_law_name").alias("parent_law_name"))


@query
def q_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links from articles to what they stand in."""
    c = F.col
    part = F.expr("if(pos % 13 = 0, 'suppl', 'main')")
    return statutes.articles(spark, sf_dir).select("pos", structure.parent(c("law_name"), part, c("chapter_num"), c("chapter_title"), c("section_num"), c("section_title")).alias("parent"))


@query
def q_resolved_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parents by the files that exist: section, else chapter, else law."""
    rows = statutes.articles(spark, sf_dir).selectExpr("pos", "law_name", "concat('第', chapter_num, '章') AS chapter_name", "concat('第', section_num, '節') AS section_name")
    suppliers = table(spark, sf_dir, "supplier")
    files = suppliers.selectExpr(f"{statutes._pick('s_suppkey % 8', 0)} AS law_name", "concat('第', s_suppkey % 12 + 1, '章') AS c", "concat('第', s_suppkey % 2 + 1, '節') AS s", "s_suppkey")
    chapter_files = files.where("s_suppkey % 5 <> 0").select("law_name", F.col("c").alias("name"))
    section_files = files.where("s_suppkey % 3 <> 0").select("law_name", F.concat("c", "s").alias("name"))
    return structure.resolved_parent(rows, section_files, chapter_files).select("pos", "new_parent", "resolution")


@query
def q_refs_in_chapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References between articles of one chapter, from part to part; articles are told by their positions, one for each node_id."""
    articles = statutes.articles(spark, sf_dir)
    edges = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("source"), F.col("l_suppkey").alias("target"), F.lit("refs").alias("type"))
    members = articles.select(structure.chapter_id(F.col("law_id"), F.col("chapter_num")).alias("group"), F.col("pos").alias("node"))
    return structure.references_within(edges, members).groupBy("group").agg(F.count("*").alias("n"), F.count_distinct("target").alias("targets"))


@query
def q_chapter_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of chapter 1 of one law, by its exact identifier and by containing it."""
    edges = structure.containment(statutes.articles(spark, sf_dir))
    chapter = "JPLAW:129AC0000000089#chapter#1"
    exact = structure.articles_of(edges, "chapter_contains_article", chapter).withColumn("how", F.lit("exact"))
    return exact.union(structure.articles_of(edges, "chapter_contains_article", chapter, substring=True).withColumn("how", F.lit("contains")))


@query
def q_chapter_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of every chapter."""
    rows = structure.chapter_index(structure.containment(statutes.articles(spark, sf_dir)))
    return rows.select("source", "chapter", "n_articles", F.array_join("articles", ",").alias("articles"))


@query
def q_toc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of contents of nations, whose customers are articles and amendments."""
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    files = rows.selectExpr("n_name AS law_name", "if(c_custkey % 4 = 0, concat('附則/改正法/H', c_custkey % 3 + 1, '_L1'), '本文') AS folder", "concat('第', c_custkey, '条.md') AS name")
    return structure.contents(files)


@query
def q_law_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table of contents of every nation's law: main part, amendments, supplements in force and initial ones."""
    folders = "array('本文', concat('附則/改正法/', if(c_custkey % 2 = 0, 'H', 'S'), c_custkey % 4 + 1, '_L', c_nationkey + 1), '附則', '附則/制定時附則', '附則/init_1')"
    files = table(spark, sf_dir, "customer").selectExpr("concat('法', c_nationkey) AS law_name", f"element_at({folders}, int(c_custkey % 5) + 1) AS folder", "concat('第', c_custkey, '条.md') AS name")
    return structure.law_pages(files)


@query
def q_corpus_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laws found by their folders, with the file that stands for each."""
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey AS k", "concat(if(p_partkey % 9 = 0, '.', ''), '法', p_partkey % 90) AS law")
    paths = rows.selectExpr("concat('/vault/laws/', law, '/', if(k % 4 = 0, concat('n', k % 7, '.md'), if(k % 4 = 1, concat('.h', k, '.md'), concat('本文/第', k, '条.md')))) AS path")
    return catalogue.law_folders(paths)


@query
def q_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How a run over targets ended, by its status."""
    runs = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS target", "if(o_orderstatus = 'F', o_orderpriority, null) AS error")
    return catalogue.run_report(runs)


@query
def q_graph_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References and containment as one table, counted."""
    rows = structure.graph(_edges(spark, sf_dir), statutes.articles(spark, sf_dir))
    return rows.groupBy("type", "relation").agg(F.count("*").alias("n"), F.count("evidence").alias("with_evidence"))


def _trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A law tree a conversation: each turn an article, every fifth without a number, every third in a section, every second with an item, the assistant's with a
    proviso; a supplement with an article and an amendment's without.
    """
    turns = table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", "role", "coalesce(text, '') AS text")
    node = lambda tag, attr, children: F.concat(F.lit('{"tag":"' + tag + '","attr":'), attr, F.lit(',"children":['), children, F.lit("]}"))
    no, plain = F.lit("{}"), lambda tag, text: F.lit(f'{{"tag":"{tag}","children":["{text}"]}}')
    quoted = F.regexp_extract(F.to_json(F.struct(F.col("text").alias("t"))), r'(?s)^\{"t":(.*)\}$', 1)
    sentence = node("Sentence", F.when(F.col("role") == "assistant", F.lit('{"Function":"proviso"}')).otherwise(no), quoted)
    item = F.when(F.expr("turn % 2 = 1"), F.concat(F.lit(","), node("Item", no, node("Sentence", no, F.concat(F.lit('"項目'), F.col("turn").cast("string"), F.lit('"')))))).otherwise("")
    number = F.concat(F.lit('{"Num":"'), F.expr("if(turn % 5 = 4, '', string(turn))"), F.lit('"}'))
    article = node("Article", number, F.concat(node("ArticleCaption", no, F.concat(F.lit('"'), "role", F.lit('"'))), F.lit(","), node("Paragraph", no, F.concat(sentence, item))))
    listed = turns.select("conv_id", "turn", article.alias("a")).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "a"))).alias("list"))
    joined = lambda keep: F.array_join(F.transform(F.filter("list", keep), lambda x: x["a"]), ",")
    own, inner = joined(lambda x: x["turn"] % 3 != 0), joined(lambda x: x["turn"] % 3 == 0)
    section = F.when(inner != "", F.concat(F.lit(","), node("Section", F.lit('{"Num":"3"}'), F.concat(plain("SectionTitle", "第三節"), F.lit(","), inner)))).otherwise("")
    chapter = node("Chapter", F.lit('{"Num":"2_2"}'), F.concat(plain("ChapterTitle", "第二章の二"), F.when(own != "", F.concat(F.lit(","), own)).otherwise(""), section))
    paragraph = lambda text: node("Paragraph", no, plain("Sentence", text))
    supplements = F.concat(node("SupplProvision", no, node("Article", F.lit('{"Num":"1"}'), paragraph("s1"))), F.lit(","), node("SupplProvision", F.lit('{"AmendLawNum":"平成二年法律第三号"}'), F.concat(paragraph("p1"), F.lit(","), paragraph("p2"))))
    return listed.select(F.col("conv_id").cast("string").alias("law_id"), node("Law", no, F.concat(node("MainProvision", no, chapter), F.lit(","), supplements)).alias("tree"))


@query
def q_tree_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each tag in every tree."""
    return tree.flatten(_trees(spark, sf_dir)).groupBy("law_id", "tag").agg(F.count("*").alias("n"))


@query
def q_tree_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with chapter, heading and proviso."""
    rows = tree.articles(stage(tree.flatten(_trees(spark, sf_dir)), "nodes"))
    return rows.select("law_id", "part", "article_num", "node_id", "heading", "chapter_num", "chapter_title", "section_num", "section_title", "has_proviso")


@query
def q_tree_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recursive query over VARIANT: rows, depth and descendants of each tag in every tree, and how many stand in a section or an article."""
    rows = tree.walked(_trees(spark, sf_dir))
    return rows.groupBy("law_id", "tag").agg(F.count("*").alias("n"), F.max("depth").alias("depth"), F.sum(F.expr("end_pos - pos")).alias("below"), F.count("section_pos").alias("in_section"), F.count("article_pos").alias("in_article"))


@query
def q_tree_provisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplements without articles."""
    return tree.provisions(stage(tree.walked(_trees(spark, sf_dir)), "nodes")).select("law_id", "node_id", "n_paragraphs")


@query
def q_tree_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of the paragraphs of every article."""
    rows = tree.passages(stage(tree.flatten(_trees(spark, sf_dir)), "nodes"))
    return rows.groupBy("law_id").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.struct("pos", "text"))).getField("text"), "|"), 256).alias("digest"), F.count("*").alias("n"))


@query
def q_frontmatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields read back from Markdown documents, and which required ones they lack; a null text is an empty body."""
    from kasane.sources.landing import document_text

    docs = table(spark, sf_dir, "documents")
    fields = F.map_filter(F.create_map(F.lit("doc_id"), F.col("doc_id").cast("string"), F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source")), lambda k, v: v.isNotNull())
    parts = L.front_matter(document_text(fields, F.coalesce("text", F.lit(""))))
    rows = docs.select("doc_id", parts.alias("x")).select("doc_id", L.simple_fields(F.col("x.raw_yaml")).alias("f"), "x.body")
    return rows.select("doc_id", F.try_element_at("f", F.lit("lang")).alias("lang"), F.try_element_at("f", F.lit("source")).alias("source"), F.array_join(L.missing_fields(F.col("f"), ["doc_id", "lang", "tier"]), ",").alias("missing"))


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with nested fields: the whole text as a value of any number of lines, a list, and for two in three an amending law with its laws."""
    law = "named_struct('title', concat('法: ', source, ' #', doc_id), 'n_chars', n_chars, 'laws', array(named_struct('id', lang, 'name', string(doc_id % 7)), named_struct('id', concat('- ', lang), 'name', 'yes')))"
    fields = f"named_struct('doc_id', doc_id, 'note', coalesce(text, ''), 'tags', array(lang, source, '1'), 'amend_law', if(doc_id % 3 = 0, null, {law}), 'empty', cast(array() AS array<string>))"
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.expr(f"to_json({fields})").alias("fields"), F.concat(F.lit("# "), "lang", F.lit("\n---\n"), "source").alias("body"))


@query
def q_nested_front(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested fields written as YAML, read back and taken from VARIANT; the whole is the same as before."""
    rows = _nested(spark, sf_dir).withColumn("x", Y.parsed(Y.document(F.col("fields"), F.col("body"))))
    one = lambda path, kind="string": F.try_variant_get("x.front", path, kind)
    return rows.select(
        "doc_id", (F.parse_json("fields").cast("string") == F.col("x.front").cast("string")).alias("same"), F.sha2(one("$.note"), 256).alias("note"), one("$.tags[1]").alias("tag"),
        one("$.amend_law.title").alias("title"), one("$.amend_law.n_chars", "bigint").alias("n_chars"), one("$.amend_law.laws[1].id").alias("law"), one("$.amend_law.laws[1].name").alias("name"), "x.body",
    )


@query
def q_amend_front(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lack an amending law get one; others stay as they are."""
    rows = _nested(spark, sf_dir)
    made = F.when(F.expr("doc_id % 2 = 0"), F.to_json(F.struct(F.col("lang").alias("title"), F.array("source").alias("laws"))))
    fields = F.to_json(F.from_json("fields", "doc_id bigint, amend_law struct<title: string>"))
    front = Y.parsed(Y.document(Y.added(fields, "amend_law", made), F.lit("")))
    one = lambda path: F.try_variant_get("x.front", path, "string")
    return rows.select("doc_id", front.alias("x")).select("doc_id", one("$.amend_law.title").alias("title"), one("$.amend_law.laws[0]").alias("law"))


def _page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wikilinks of pages: the addresses of their menus, kept as links to notes."""
    hrefs = F.regexp_extract_all("html", F.lit('href="/([^"]+)"'), F.lit(1))
    body = F.array_join(F.transform(hrefs, lambda h: F.concat(F.lit("[[notes/"), h, F.lit("|x]]"))), "\n")
    return table(spark, sf_dir, "pages").select(F.concat(F.lit("pages/"), "page_id", F.lit(".md")).alias("path"), body.alias("text"))


def _broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "pages").where("page_id % 3 = 0").select(F.explode(F.regexp_extract_all("html", F.lit('href="/([^"]+)"'), F.lit(1))).alias("w")).where("length(w) % 2 = 0")
    files = words.select(F.concat(F.lit("notes/"), "w", F.lit(".md")).alias("path"))
    return integrity.broken(integrity.links_by_line(_page_links(spark, sf_dir)), files, ["notes"])


@query
def q_html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages by line."""
    return integrity.links_by_line(_page_links(spark, sf_dir)).select("path", "line_no", "target")


@query
def q_broken_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links that lead to no file, without the ignored ones."""
    ignored = table(spark, sf_dir, "region").select(F.lower(F.substring("r_name", 1, 2)).alias("pattern"))
    return integrity.not_ignored(_broken(spark, sf_dir), ignored).select("path", "line_no", "shown")


@query
def q_broken_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred most frequent broken targets."""
    return integrity.report(_broken(spark, sf_dir)).select("shown", "n", F.size("sources").cast("long").alias("n_samples"))


@query
def q_broken_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of broken links as a Markdown text."""
    return integrity.report_markdown(_broken(spark, sf_dir))


def _ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "supplier").selectExpr(f"{statutes._pick('s_suppkey % 8', 0)} AS law_name", "concat('第', s_suppkey * 3, '条から第', s_suppkey * 3 + s_suppkey % 7, '条まで.md') AS name")
    return integrity.article_ranges(files)


def _article_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = statutes.line_items(spark, sf_dir).selectExpr("l_orderkey * 10 + l_linenumber AS link_id", f"{statutes._pick('l_partkey % 8', 0)} AS law_name", "concat('laws/x/本文/第', l_partkey, '条.md#第1項') AS target", "concat('s', l_suppkey % 20) AS source", "l_linenumber <> 3 AS from_main")
    return rows.withColumn("num", N.plain_article(F.col("target")))


@query
def q_range_redirect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best range of each link to a single article."""
    return integrity.redirected(_article_links(spark, sf_dir).select("link_id", "law_name", "num"), _ranges(spark, sf_dir)).select("link_id", "num", "start", "end")


@query
def q_stubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles that links name but neither a file nor a range holds."""
    held = statutes.articles(spark, sf_dir).where("pos % 2 = 0").selectExpr("law_name", "int(pos) AS num")
    unresolved = _article_links(spark, sf_dir).join(held, ["law_name", "num"], "left_anti")
    rows = integrity.stubs(unresolved, _ranges(spark, sf_dir))
    return rows.select("law_name", "num", F.array_join("referenced_by", ",").alias("referenced_by"), "n")


def _pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr("event_id", "concat('law', user_id % 40) AS law", "concat('p/', event_type, '.md') AS path", "concat('[[x', event_id % 50, ']]') AS link", "event_type AS anchor", "string(ts) AS ts")
    return rows.select(N.pending_id(F.col("law"), F.col("path"), F.col("link"), F.col("anchor")).alias("id"), "ts", "law", "event_id")


@query
def q_pending_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First entries of pending links that no event resolves."""
    log = _pending(spark, sf_dir).withColumn("ts", F.struct("ts", "event_id"))
    resolved = _pending(spark, sf_dir).where("event_id % 17 = 0").select("id").distinct()
    return integrity.pending_open(log, resolved).select("id", "law", "event_id")


@query
def q_pending_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first existing target of each pending link."""
    rows = table(spark, sf_dir, "events").selectExpr(
        "string(event_id) AS id", "if(event_id % 2 = 0, 'external_law', 'amendment_self') AS kind", f"{statutes._pick('user_id % 8', 0)} AS src_law_name", "int(event_id % 60 + 1) AS article", f"{statutes._pick('event_id % 8', 0)} AS external_law_name", "concat('H', event_id % 5 + 1, '_L1') AS amendment_key"
    )
    laws = statutes.corpus(spark).select("law_name")
    main = statutes.articles(spark, sf_dir).where("pos % 3 <> 0 and not contains(article_num, '_')").selectExpr("concat('laws/', law_name, '/本文/第', article_num, '条.md') AS path")
    own = statutes.articles(spark, sf_dir).where("not contains(article_num, '_')").selectExpr("concat('laws/', law_name, '/附則/改正法/H', pos % 5 + 1, '_L1/', if(pos % 2 = 0, '附則', ''), '第', article_num, '条.md') AS path")
    return integrity.pending_target(rows, main.union(own), laws).select("id", "target")


@query
def q_multiset_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences in both directions between the edges of two halves of the line items."""
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_linenumber", "concat('a', l_partkey % 500) AS source", "concat('b', l_suppkey % 50) AS target")
    return snapshots.multiset_diff(rows.where("l_linenumber % 2 = 0"), rows.where("l_linenumber % 2 = 1"), ["source", "target"])


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf_dir, "orders")
    path = "concat(case o_orderkey % 9 when 0 then '章/' when 1 then '本文/章/' else '本文/' end, o_orderkey, '.md') AS path"
    fields = "map('status', o_orderstatus, 'priority', {}, 'tags', string(o_orderkey % {})) AS fields"
    before = o.where("o_orderkey % 10 <> 0").selectExpr(path, "o_orderpriority AS body", fields.format("o_orderpriority", 3))
    after = o.where("o_orderkey % 11 <> 0").selectExpr(path, "case when o_orderkey % 13 = 0 then 'x' when o_orderkey % 4 = 0 then concat(o_orderpriority, ' \\t\\n\\n') when o_orderkey % 4 = 1 then concat(' ', o_orderpriority) else o_orderpriority end AS body", fields.format("if(o_orderkey % 13 = 0, 'x', o_orderpriority)", 4))
    return before, after


@query
def q_file_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of every file between two snapshots."""
    return snapshots.file_diff(*_snapshots(spark, sf_dir))


@query
def q_meta_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that differ between two snapshots."""
    return snapshots.field_diff(*_snapshots(spark, sf_dir))


@query
def q_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the second snapshot is compatible with the first."""
    return snapshots.verdict(snapshots.file_diff(*_snapshots(spark, sf_dir)), q_multiset_diff(spark, sf_dir))


@query
def q_targets_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of the nations on a target list."""
    laws = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_nationkey AS law_id")
    return catalogue.targeted(laws, table(spark, sf_dir, "nation").where("n_regionkey = 1").selectExpr("n_nationkey AS law_id")).select("c_custkey")


@query
def q_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue entries with domains from classes and overrides."""
    classes = "array('民事', '刑事', '税務', '労働', '無')"
    laws = table(spark, sf_dir, "part").selectExpr("string(p_partkey) AS law_id", "concat(' ', p_name, '?') AS law_name", "if(p_partkey % 9 = 0, null, p_brand) AS law_num", "string(null) AS promulgation_date", f"filter(array(element_at({classes}, int(p_size % 5) + 1), element_at({classes}, int(p_partkey % 5) + 1)), x -> p_partkey % 6 <> 0) AS classes")
    overrides = table(spark, sf_dir, "part").where("p_partkey % 50 = 0").selectExpr("string(p_partkey) AS law_id", "array('特別') AS domains")
    return catalogue.entries(laws, overrides).select("node_id", "law_num", "folder", F.array_join("domain", ",").alias("domain"))


def _searched(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Laws and the hits of their searches."""
    laws = table(spark, sf_dir, "orders").selectExpr("string(o_custkey % 100) AS law_id").distinct().selectExpr("law_id", "concat('第', law_id, '号') AS law_num", "concat('法', law_id) AS law_name")
    title = "case when o_orderkey % 29 = 0 then concat('x 第', o_custkey % 100, '号') when o_orderkey % 7 = 0 then concat('法', o_custkey % 100, ' 改正') else 'other' end AS title"
    return laws, table(spark, sf_dir, "orders").selectExpr("string(o_custkey % 100) AS law_id", "o_orderkey AS hit_id", "o_orderkey AS ord", title)


@query
def q_best_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best search hit of each law."""
    return catalogue.best_hit(*_searched(spark, sf_dir))


@query
def q_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laws with the record of their best hit; every fourth has no number and stays without."""
    laws, hits = _searched(spark, sf_dir)
    some = laws.withColumn("law_num", F.expr("if(int(law_id) % 4 = 0, '', law_num)"))
    rows = catalogue.enriched(some, hits)
    return rows.select("law_id", "law_num", "enriched", F.col("legislative_origin.hit_id").cast("string").alias("hit_id"), F.col("legislative_origin.title").alias("title"))


@query
def q_parent_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log of new parents."""
    new = "if(p_partkey % 11 = 0, null, concat('[[laws/法/章/第', p_size, '章]]'))"
    files = table(spark, sf_dir, "part").selectExpr("concat('laws/法/', p_partkey, '.md') AS path", f"{new} AS new_parent", f"case p_partkey % 3 when 0 then {new} when 1 then '[[laws/法/法]]' end AS parent")
    return rewrite.parent_changes(files)


def _renamed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Chains of five renames a family of files, every tenth a circle; and a file a customer with three links into them."""
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey div 6 AS g", "p_partkey % 6 AS v").distinct()
    chains = parts.where("v < 5 or g % 10 = 7").selectExpr("concat('laws/', g, '/v', v, '.md') AS old", "concat('laws/', g, '/v', (v + 1) % 6, '.md') AS new")
    link = "concat('laws/', c_custkey % 40, '/v', c_custkey % 6)"
    body = f"concat('a [[', {link}, '|', c_name, ']] b [[laws/', c_custkey % 30, '/v', c_custkey % 4, '.md#x|y]]\nc [[v', c_custkey % 3, ']] d [[https://e.f]]')"
    files = table(spark, sf_dir, "customer").selectExpr("c_custkey", "concat('laws/', c_custkey % 20, '/c', c_custkey, '.md') AS path", f"{body} AS body")
    own = parts.where("v = 5").selectExpr("-1L AS c_custkey", "concat('laws/', g, '/v', v, '.md') AS path", "'' AS body")
    return renames.followed(chains), files.unionByName(own)


@query
def q_rename_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each old name leads in the end."""
    return _renamed(spark, sf_dir)[0]


@query
def q_rename_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier names of each file."""
    return renames.aliases(_renamed(spark, sf_dir)[0]).select("name", F.array_join("aliases", ",").alias("aliases"))


@query
def q_renamed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies with their links under the last names."""
    ends, files = _renamed(spark, sf_dir)
    return renames.relocated(files, ends).where("c_custkey > 0").select("c_custkey", "path", "body", "n_changed")


@query
def q_rename_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links that lead nowhere before and after the renames."""
    ends, files = _renamed(spark, sf_dir)
    return renames.verified(files, stage(renames.relocated(files, ends), "relocated"), ["laws"])


def _runs(spark: SparkSession, sf_dir: str) -> tuple[str, list[dict[str, int]]]:
    """Three runs over files of orders: the first, one with files gone, changed and new, and one with nothing to do."""
    orders, folder = table(spark, sf_dir, "orders"), fresh_path(spark, "repaired")
    first = orders.selectExpr("concat('o/', o_orderkey, '.md') AS path", "concat(o_orderpriority, '  ') AS body")
    second = orders.where("o_orderkey % 10 <> 0").selectExpr("concat('o/', o_orderkey, '.md') AS path", "concat(o_orderpriority, if(o_orderkey % 7 = 0, '!', '  ')) AS body")
    second = second.union(orders.where("o_orderkey % 13 = 0").selectExpr("concat('n/', o_orderkey, '.md')", "o_orderstatus"))
    trimmed = lambda rows: rows.select("path", F.trim("body").alias("body"))
    return folder, [incremental.run(files, folder, trimmed) for files in (first, second, second)]


@query
def q_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repaired bodies after three runs, and the run that wrote each."""
    return incremental.current(spark, _runs(spark, sf_dir)[0])


@query
def q_incremental_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each run found, counted while it wrote."""
    counts = _runs(spark, sf_dir)[1]
    return spark.createDataFrame([(i, *(c[k] for k in incremental.COUNTS)) for i, c in enumerate(counts, 1)], "run int, new long, changed long, same long, deleted long")


@query
def q_read_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests answered by a log in which a third is missing and a third is broken, after what was fetched since was landed."""
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey AS k", "concat('laws/', p_partkey) AS request", "concat('{\"id\": ', p_partkey, ', \"name\": \"', p_name, '\"}') AS response")
    path = fresh_path(spark, "requests")
    before = parts.where("k % 3 < 2").selectExpr("md5(request) AS key", "request", "if(k % 3 = 0, response, left(response, 9)) AS response", "cast(null AS string) AS error", "1 AS run")
    before.write.parquet(path)
    found = readthrough.landed(parts.select("request"), path, parts.where("k % 5 > 0").select("request", "response"))
    return found.select("request", F.get_json_object("response", "$.id").alias("id"))


@query
def q_asked_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies with summaries from a client that fails on some prompts; asked twice, so that the second run finds the answers of the first."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.concat("c_name", F.lit(":"), "c_custkey").alias("request"))
    path = fresh_path(spark, "answers")

    def client(prompts):
        if any(p.endswith("7") for p in prompts):
            raise ValueError("no answer")
        return [p[::-1] for p in prompts]

    for _ in range(2):
        found = readthrough.asked(rows, path, client, waves=2)
    again = readthrough.log(spark, path).groupBy(F.col("request").alias("__request")).agg(F.count("*").alias("n_asked"))
    body = F.concat(F.lit("本文\n"), "request")
    both = found.join(again, F.col("request") == F.col("__request"))
    return both.select("c_custkey", F.when(F.col("response").isNull(), body).otherwise(repair.summarised(body, F.col("response"))).alias("body"), "n_asked")


@query
def q_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status and priority."""
    return rewrite.status_counts(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@query
def q_explicit_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absolute, relative and same-article references of generated sentences."""
    rows = statutes.line_items(spark, sf_dir)
    n = F.expr("l_partkey % 900 + 1")
    text = (
        F.when(F.expr("l_linenumber % 3 = 0"), F.concat(F.lit("第"), K.to_kanji(n), F.lit("条第二項及び同条第三項")))
        .when(F.expr("l_linenumber % 3 = 1"), F.lit("前三条の規定"))
        .otherwise(F.concat(F.lit("次条第一項、第"), n.cast("string"), F.lit("条")))
    )
    texts = rows.select(F.expr("l_orderkey * 10 + l_linenumber").alias("text_id"), text.alias("text"), F.expr("int(l_suppkey % 5 + 1)").alias("article"))
    available = statutes.articles(spark, sf_dir).selectExpr("concat('第', pos, '条') AS article_name")
    return explicit.references(texts, available).select("text_id", "target_id", "type", "original", "resolved")


@query
def q_unlink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies of amendments without their bare links."""
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber AS text_id", "'民法' AS law_name", "concat(if(l_linenumber % 2 = 0, '旧民法', 'この'), '[[laws/民法/本文/第', l_partkey, '条.md|第', l_partkey, '条]]の') AS body")
    return rewrite.unlinked(rows).select("text_id", "body", "n_unlinked", "n_kept")


@query
def q_relink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies of amendments with links where the law's name stands before in the sentence."""
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber AS text_id", "'民法' AS law_name", "concat('民法の一部。', if(l_linenumber % 2 = 0, '新民法の例による', '附則'), '第', l_partkey, '条') AS body")
    return rewrite.relinked(rows).select("text_id", "body", "n_linked")


@query
def q_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old and new paths of article files."""
    files = statutes.articles(spark, sf_dir).selectExpr("concat('laws/', law_name, if(pos % 3 = 0, '/suppl/', '/main/'), 'Article_', article_num, '.md') AS path")
    return rewrite.localized_paths(files)


@query
def q_initial_supplements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renamed folders of initial supplements."""
    folders = table(spark, sf_dir, "supplier").selectExpr("s_nationkey AS law_name", "case when s_suppkey % 3 = 0 then '制定時附則' when s_suppkey % 3 = 1 then 'init_0' else concat('init_', s_suppkey % 4) end AS name").distinct()
    return rewrite.initial_supplements(folders)


@query
def q_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata with missing fields and tags added."""
    rows = table(spark, sf_dir, "documents").selectExpr("doc_id", "if(doc_id % 3 = 0, null, lang) AS lang", "if(doc_id % 4 = 0, null, array(source)) AS tags", "source AS origin")
    out = rewrite.filled(rows, {"lang": F.lit("und")}, F.array(F.lit("doc"), F.col("origin")))
    return out.select("doc_id", "lang", F.array_join("tags", ",").alias("tags"), F.array_join("added_fields", ",").alias("added"), "changed")


@query
def q_supplement_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the supplements of laws."""
    rows = table(spark, sf_dir, "supplier").selectExpr("s_nationkey AS law_id", "s_suppkey AS pos", "if(s_suppkey % 2 = 0, concat('平成', s_suppkey % 30 + 1, '年法律第', s_suppkey, '号'), null) AS amend_law_num")
    return structure.supplement_names(rows).select("pos", "name")


@query
def q_localized_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers and numbers of articles in Japanese."""
    rows = statutes.articles(spark, sf_dir).withColumn("old", F.when(F.expr("pos % 3 = 0"), F.replace("node_id", F.lit("#main#"), F.lit("#suppl#"))).otherwise(F.col("node_id")))
    again = N.localized_id(N.localized_id(F.col("old")))
    return rows.select("pos", N.localized_id(F.col("old")).alias("id"), (again == N.localized_id(F.col("old"))).alias("stable"), N.localized_number(F.expr("if(pos % 5 = 0, 'Provision', concat(pos, ':', pos + 1))"), F.expr("pos % 3 = 0")).alias("span"))


@query
def q_node_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of nodes by path, with their laws."""
    path = "concat('corpus/laws/', law_name, case pos % 5 when 0 then concat('/', law_name, '.md') when 1 then '/本文/第1条.md' when 2 then '/附則/改正法/H1_L1/第1条.md' when 3 then '/附則/第1条.md' else '/x.md' end) AS path"
    rows = statutes.articles(spark, sf_dir).selectExpr("pos", path, "if(pos % 7 = 0, true, null) AS amended")
    return rows.select("pos", N.node_kind(F.col("path"), F.col("amended")).alias("kind"), N.law_of_path(F.col("path")).alias("law"))


@query
def q_full_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amendment titles with full dates in their long and short forms."""
    kanji = lambda x: F.translate(x, "0123456789", "〇一二三四五六七八九")
    title = F.concat(F.lit("昭和"), kanji(F.expr("string(o_orderkey % 60 + 1)")), F.lit("年三月一二日法律第"), K.to_kanji(F.expr("o_orderkey % 300 + 1")), F.lit("号"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.expr("o_orderkey % 5 = 0"), F.lit("某 法")).otherwise(title).alias("title"))
    return rows.select("o_orderkey", K.long_title(F.col("title")).alias("long"), K.short_title(F.col("title")).alias("short"))


@query
def q_taken_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies without their unresolved links, and how many were logged."""
    rows = statutes.line_items(spark, sf_dir).selectExpr("concat('p', l_orderkey, '_', l_linenumber) AS path", "'民法' AS law_name", "l_partkey AS k", "l_linenumber AS n")
    link = F.concat(F.lit("[[laws/少年法/本文/第"), "k", F.lit("条.md|第"), "k", F.lit("条]]"))
    bodies = rows.select("path", "law_name", F.concat(F.lit("少年法"), link, F.lit("と[[x|y]]、"), link).alias("body"))
    out, log = repair.taken_out(bodies, rows.where("n % 2 = 0").select("path", link.alias("original")))
    return out.join(log.groupBy("path").agg(F.count("*").alias("n_logged"), F.min("id").alias("id")), "path", "left").select("path", "body", "n_logged", "id")


@query
def q_put_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending links put back at their marker, their only place, or the place that fits."""
    rows = statutes.line_items(spark, sf_dir).selectExpr("concat('p', l_orderkey, '_', l_linenumber) AS path", "l_linenumber % 4 AS k", "concat('i', l_partkey) AS id")
    mark = repair.marker(F.col("id"))
    body = F.when(F.col("k") == 0, F.concat(F.lit("甲第1条"), mark, F.lit("乙第1条"))).when(F.col("k") == 1, F.lit("甲第1条乙")).when(F.col("k") == 2, F.lit("甲第1条乙第1条丙")).otherwise(F.lit("なし"))
    entries = rows.select("path", "id", F.lit("第1条").alias("anchor_text"), F.lit("乙").alias("context_before"), F.lit("").alias("context_after"), F.lit("laws/x.md").alias("target"))
    return repair.put_back(rows.select("path", body.alias("body")), entries)


@query
def q_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies with their references applied at the first place."""
    rows = statutes.line_items(spark, sf_dir).selectExpr("l_orderkey * 10 + l_linenumber AS text_id", "l_partkey AS n", "l_linenumber AS k")
    name = F.concat(F.lit("第"), "n", F.lit("条"))
    bodies = rows.select("text_id", F.concat(name, F.lit("と"), name, F.lit("と前条")).alias("body"))
    own = F.struct(F.lit(1).alias("ord"), name.alias("target_id"), name.alias("original"), F.expr("k % 2 = 0").alias("resolved"))
    former = F.struct(F.lit(2).alias("ord"), F.lit("UNRESOLVED").alias("target_id"), F.lit("前条").alias("original"), F.lit(True).alias("resolved"))
    refs = rows.select("text_id", F.inline(F.array(own, former)))
    return repair.applied(bodies, refs)


@query
def q_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress of summaries by nation, after a third of the bodies got one."""
    body = F.concat(F.lit("本文\n"), "c_name")
    rows = table(spark, sf_dir, "customer").select("c_nationkey", F.when(F.expr("c_custkey % 3 = 0"), repair.summarised(body, F.lit("要約 $1"))).otherwise(body).alias("body"))
    return repair.summary_progress(rows, "c_nationkey")


@query
def q_amendment_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments of every amending law."""
    rows = statutes.articles(spark, sf_dir).selectExpr("law_name", "node_id", "if(pos % 3 = 0, null, concat('H', pos % 11 + 1, '_L1')) AS amendment_key")
    return repair.amendment_books(rows).select("amendment_key", F.array_join("laws", ",").alias("laws"), "n", F.array_join("node_ids", ",").alias("node_ids"))


@query
def q_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why links are unresolved, and what kind of pending link they become."""
    rows = statutes.line_items(spark, sf_dir).selectExpr("l_orderkey * 10 + l_linenumber AS text_id", "concat(if(l_linenumber % 2 = 0, '少年法', '前の規定'), repeat('あ', int(l_partkey % 300)), 'は') AS context", "case l_linenumber % 3 when 0 then '同法' when 1 then '少年法' end AS name", "if(l_linenumber % 2 = 0, 'H1_L1', null) AS amendment")
    kind = repair.pending_kind(F.col("name"), F.col("amendment"))
    return rows.select("text_id", integrity.unresolved_reason(F.col("context")).alias("reason"), kind["kind"].alias("kind"), kind["reason"].alias("why"), kind["amendment_key"].alias("amendment_key"))


@query
def q_legacy_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths that still carry old names of initial supplements, with the display names of their files."""
    rows = table(spark, sf_dir, "part").selectExpr("concat('laws/x/', case p_partkey % 4 when 0 then concat('init_', p_partkey, '/第1条.md') when 1 then concat('init_', p_partkey, '.md') when 2 then concat('a_init_', p_partkey, '_第', p_partkey, '条.md') else '第1条.md' end) AS path")
    return integrity.legacy_names(rows).withColumn("display", N.initial_display(F.substring_index("path", "/", -1)))


@query
def q_canonical_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers that tell articles of amendments apart, and nodes raised to a tier."""
    rows = statutes.articles(spark, sf_dir).selectExpr("pos", "law_name", "concat('第', pos, '条') AS article", "concat('H', pos % 9 + 1, '_L1') AS amendment", "if(pos % 4 = 0, null, int(pos % 4)) AS tier")
    return rewrite.bumped(rows, 2).select("pos", integrity.canonical_id(F.col("law_name"), F.col("article"), F.col("amendment")).alias("canonical_id"), "tier")
