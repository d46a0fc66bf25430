"""Nodes as they are written out: front matter of articles, and chapters and sections with their lists of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kasane.functions import names as N
from kasane.functions.numerals import amendment_key
from kasane.operators.structure import chapter_id, parent, section_id


def _tags(law_name: Column, kind: Column) -> Column:
    return F.filter(F.array(F.nullif(law_name, F.lit("")), F.concat(F.lit("kind/"), kind)), lambda x: x.isNotNull())


def amend_law(amend_law_num: Column, law_id: Column, law_name: Column) -> Column:
    """The nested record of the amending law."""
    return F.struct(amend_law_num.alias("num"), amendment_key(amend_law_num).alias("normalized_id"), F.lit("partial").alias("scope"), law_id.alias("parent_law_id"), law_name.alias("parent_law_name"))


def article_front(articles: DataFrame) -> DataFrame:
    """``articles`` with the fields of their front matter; a field that would be left out is null.

    ``articles``: node_id, part (main, suppl), law_id, law_name, article_num, heading, fragment, amend_law_num, chapter_num,
    chapter_title, section_num, section_title, has_proviso. An amendment's fragment comes before its part in the type.
    """
    c = F.col
    kind = F.when(c("fragment"), "amendment_fragment").when(c("part") == "suppl", "supplement").otherwise("article")
    amended = c("fragment") & (F.coalesce(c("amend_law_num"), F.lit("")) != "")
    of_amended = lambda x: F.when(amended, x)
    return articles.select(
        c("node_id").alias("id"),
        kind.alias("type"),
        parent(c("law_name"), c("part"), c("chapter_num"), c("chapter_title"), c("section_num"), c("section_title")).alias("parent"),
        "law_id", "law_name", "part", "article_num", "heading",
        _tags(c("law_name"), kind).alias("tags"),
        "chapter_num", "chapter_title", "section_num", "section_title",
        F.when(c("has_proviso"), True).alias("has_proviso"),
        of_amended(F.lit("amendment")).alias("suppl_kind"),
        of_amended(amendment_key(c("amend_law_num"))).alias("amendment_law_id"),
        of_amended(c("amend_law_num")).alias("amendment_law_title"),
        of_amended(amend_law(c("amend_law_num"), c("law_id"), c("law_name"))).alias("amend_law"),
    )


def with_amend_law(documents: DataFrame) -> DataFrame:
    """Documents of amendments that lack it get ``amend_law``; others stay. ``documents``: suppl_kind, amendment_law_title, law_id, law_name, amend_law, ..."""
    lacking = (F.col("suppl_kind") == "amendment") & F.col("amend_law").isNull() & F.col("amendment_law_title").isNotNull()
    made = amend_law(F.col("amendment_law_title"), F.col("law_id"), F.col("law_name"))
    return documents.withColumn("changed", F.coalesce(lacking, F.lit(False))).withColumn("amend_law", F.when(F.col("changed"), made).otherwise(F.col("amend_law")))


def _titled(name: Column, title: Column) -> Column:
    return F.concat(name, F.when(title != "", F.concat(F.lit(" "), title)).otherwise(""))


def _article_lines(articles: str, headings: bool) -> Column:
    def line(x: Column) -> Column:
        name = N.article_name(x["article_num"])
        shown = _titled(name, F.coalesce(x["heading"], F.lit(""))) if headings else name
        return F.concat(F.lit("- [[laws/"), F.col("law_name"), F.lit("/本文/"), name, F.lit(".md|"), shown, F.lit("]]\n"))

    return F.array_join(F.transform(articles, line), "")


def _rolled(articles: DataFrame, *keys: str, title: str) -> DataFrame:
    """A row for each ``keys``: the first title by position and the articles in document order."""
    first = F.min_by(title, F.when(F.col(title).isNotNull(), F.col("pos"))).alias("title")
    return articles.groupBy("law_id", "law_name", *keys).agg(first, F.array_sort(F.collect_list(F.struct("pos", "article_num", "heading", "node_id"))).alias("articles"))


def structure_nodes(articles: DataFrame) -> DataFrame:
    """(id, type, parent, law_id, law_name, chapter_num, section_num, title, article_ids, article_nums, section_count, tags, path, body): a node for each chapter and section.

    ``articles``: law_id, law_name, chapter_num, chapter_title, section_num, section_title, node_id, article_num, heading, pos. A
    chapter lists its sections by number, then its articles with headings; a section lists its articles. The lists of a node are
    bounded by one law.
    """
    within = articles.where("chapter_num is not null")
    chapters = _rolled(within, "chapter_num", title="chapter_title").withColumn("name", N.chapter_name(F.col("chapter_num"), F.col("title")))
    of_chapter = chapters.select("law_id", "chapter_num", F.col("name").alias("chapter"), F.col("title").alias("chapter_title"))
    sections = _rolled(within.where("section_num is not null"), "chapter_num", "section_num", title="section_title").join(of_chapter, ["law_id", "chapter_num"])
    sections = sections.withColumn("name", N.section_name(F.col("section_num"), F.col("title")))
    label = _titled(F.col("name"), F.coalesce("title", F.lit("")))
    listed = F.concat(F.lit("- [[laws/"), F.col("law_name"), F.lit("/節/"), F.col("chapter"), F.col("name"), F.lit(".md|"), label, F.lit("]]\n"))
    by_chapter = sections.groupBy("law_id", "chapter_num").agg(F.array_sort(F.collect_list(F.struct("section_num", listed.alias("line")))).getField("line").alias("lines"))
    root = F.concat(F.lit("laws/"), F.col("law_name"), F.lit("/"))
    linked = lambda path: F.when(F.col("law_name") != "", F.concat(F.lit("[["), path, F.lit("]]")))
    ids = [F.col("articles.node_id").alias("article_ids"), F.col("articles.article_num").alias("article_nums")]

    joined = chapters.join(by_chapter, ["law_id", "chapter_num"], "left")
    head = F.concat(F.lit("# "), _titled(F.col("name"), F.coalesce("title", F.lit(""))), F.lit("\n\n"))
    inner = F.when(F.col("lines").isNotNull(), F.concat(F.lit("## この章の節\n\n"), F.array_join("lines", ""), F.lit("\n"))).otherwise("")
    one = joined.select(
        chapter_id(F.col("law_id"), F.col("chapter_num")).alias("id"), F.lit("chapter").alias("type"), linked(F.concat(root, F.col("law_name"))).alias("parent"), "law_id", "law_name", "chapter_num",
        F.lit(None).cast("int").alias("section_num"), "title", *ids, F.coalesce(F.size("lines"), F.lit(0)).alias("section_count"), _tags(F.col("law_name"), F.lit("chapter")).alias("tags"),
        F.concat(root, F.lit("章/"), F.col("name"), F.lit(".md")).alias("path"), F.concat(head, inner, F.lit("## この章の条文\n\n"), _article_lines("articles", True)).alias("body"),
    )
    head = F.concat(F.lit("# "), _titled(F.col("chapter"), F.coalesce("chapter_title", F.lit(""))), F.lit(" "), label, F.lit("\n\n"))
    two = sections.select(
        section_id(F.col("law_id"), F.col("chapter_num"), F.col("section_num")).alias("id"), F.lit("section").alias("type"), linked(F.concat(root, F.lit("章/"), F.col("chapter"))).alias("parent"), "law_id", "law_name", "chapter_num",
        "section_num", "title", *ids, F.lit(None).cast("int").alias("section_count"), _tags(F.col("law_name"), F.lit("section")).alias("tags"),
        F.concat(root, F.lit("節/"), F.col("chapter"), F.col("name"), F.lit(".md")).alias("path"), F.concat(head, F.lit("## この節の条文\n\n"), _article_lines("articles", False)).alias("body"),
    )
    return one.unionByName(two)
