"""Structure of a law: chapters and sections with their articles, containment, parents, tables of contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kasane.functions import names as N
from kasane.functions.numerals import amendment_key, amendment_title


def chapter_id(law_id: Column, chapter: Column) -> Column:
    return F.concat(F.lit("JPLAW:"), law_id, F.lit("#chapter#"), chapter.cast("string"))


def section_id(law_id: Column, chapter: Column, section: Column) -> Column:
    return F.concat(chapter_id(law_id, chapter), F.lit("#section#"), section.cast("string"))


def _in_order(*fields: str) -> list[Column]:
    """Lists of ``fields`` by position: one sorted collection, cut into its columns."""
    rows = F.array_sort(F.collect_list(F.struct("pos", *fields)))
    return [rows.getField(f).alias(f"{f}s") for f in fields]


def chapters(articles: DataFrame) -> DataFrame:
    """(law_id, chapter_num, chapter_title, node_ids, article_nums, section_count): a row per chapter, articles in document order, the first title.

    ``articles``: law_id, chapter_num, chapter_title, section_num, section_title, node_id, article_num, pos. Articles outside chapters are left out.
    """
    first = F.min_by("chapter_title", F.when(F.col("chapter_title").isNotNull(), F.col("pos"))).alias("chapter_title")
    return articles.where("chapter_num is not null").groupBy("law_id", "chapter_num").agg(first, *_in_order("node_id", "article_num"), F.count_distinct("section_num").alias("section_count"))


def sections(articles: DataFrame) -> DataFrame:
    """(law_id, chapter_num, section_num, section_title, node_ids, article_nums): a row per section of a chapter."""
    first = F.min_by("section_title", F.when(F.col("section_title").isNotNull(), F.col("pos"))).alias("section_title")
    return articles.where("chapter_num is not null and section_num is not null").groupBy("law_id", "chapter_num", "section_num").agg(first, *_in_order("node_id", "article_num"))


def containment(articles: DataFrame) -> DataFrame:
    """Edges (source, target, type, relation) from chapters and sections to their articles, each pair once."""
    kinds = F.array(
        F.struct(F.when(F.col("chapter_num").isNotNull(), chapter_id(F.col("law_id"), F.col("chapter_num"))).alias("source"), F.lit("chapter_contains_article").alias("relation")),
        F.struct(F.when(F.col("section_num").isNotNull(), section_id(F.col("law_id"), F.col("chapter_num"), F.col("section_num"))).alias("source"), F.lit("section_contains_article").alias("relation")),
    )
    rows = articles.select("node_id", F.explode(kinds).alias("x")).where("x.source is not null")
    return rows.select("x.source", F.col("node_id").alias("target"), F.lit("contains").alias("type"), "x.relation").dropDuplicates(["source", "target"])


def edges_v2(edges: DataFrame) -> DataFrame:
    """(source, target, type, relation, evidence, confidence) of reference edges."""
    relation = F.when(F.col("kind") == "external_ref", "external").otherwise("internal")
    return edges.select(F.col("from").alias("source"), F.col("to").alias("target"), F.lit("refs").alias("type"), relation.alias("relation"), "evidence", "confidence")


def graph(edges: DataFrame, articles: DataFrame) -> DataFrame:
    """References and containment as one edge table; containment has neither evidence nor confidence."""
    return edges_v2(edges).unionByName(containment(articles), allowMissingColumns=True)


def parent(law_name: Column, part: Column, chapter: Column, chapter_title: Column, section: Column, section_title: Column) -> Column:
    """Link to what an article stands in: its section, else its chapter, else the law; supplements always the law; no name, no link."""
    root = F.concat(F.lit("[[laws/"), law_name, F.lit("/"))
    chapter_part = N.chapter_name(chapter, chapter_title)
    inner = (
        F.when(part == "suppl", law_name)
        .when(section.isNotNull(), F.concat(F.lit("節/"), chapter_part, N.section_name(section, section_title)))
        .when(chapter.isNotNull(), F.concat(F.lit("章/"), chapter_part))
        .otherwise(law_name)
    )
    return F.when(law_name != "", F.concat(root, inner, F.lit("]]")))


def articles_of(edges: DataFrame, relation: str, source: str, substring: bool = False) -> DataFrame:
    """Targets of the containment edges of a source; ``substring`` also takes sources that only contain it, as older queries did."""
    match = F.col("source").contains(source) if substring else F.col("source") == source
    return edges.where((F.col("type") == "contains") & (F.col("relation") == relation) & match).select("source", "target")


def references_within(edges: DataFrame, members: DataFrame) -> DataFrame:
    """References whose two ends both are in ``members`` (group, node) of one group: (group, source, target).

    Nodes are of any type that both tables share; short keys make light joins. A task holds its part of the members, not all of them (a
    broadcast grows with the members in every executor), and streams its references past it: neither side is sorted.
    """
    refs = edges.where("type = 'refs'").select("source", "target")
    held = members.where("group is not null").select("group", "node").hint("shuffle_hash")
    one = refs.join(held.withColumnRenamed("node", "source"), "source")
    return one.join(held.withColumnRenamed("node", "target"), ["group", "target"]).select("group", "source", "target")


def chapter_index(edges: DataFrame) -> DataFrame:
    """(chapter, n_articles, articles): articles of each chapter of each law, by exact number."""
    rows = edges.where("type = 'contains' and relation = 'chapter_contains_article'")
    number = F.regexp_extract("source", r"#chapter#([0-9]+)$", 1).try_cast("int")
    return rows.withColumn("chapter", number).where("chapter is not null").groupBy("source", "chapter").agg(F.count("*").alias("n_articles"), F.sort_array(F.collect_list("target")).alias("articles"))


def resolved_parent(articles: DataFrame, section_files: DataFrame, chapter_files: DataFrame) -> DataFrame:
    """``articles`` with new_parent and resolution: the section's file, else the chapter's, else the law.

    articles: law_name, chapter_name, section_name (null where none); files: law_name and name.
    """
    s = section_files.select(F.col("law_name").alias("s_law"), F.col("name").alias("s_name")).distinct()
    c = chapter_files.select(F.col("law_name").alias("c_law"), F.col("name").alias("c_name")).distinct()
    rows = articles.join(s, F.expr("law_name = s_law and concat(chapter_name, section_name) = s_name"), "left").join(c, F.expr("law_name = c_law and chapter_name = c_name"), "left")
    to = lambda kind, name: F.concat(F.lit("[[laws/"), "law_name", F.lit(f"/{kind}/"), name, F.lit("]]"))
    law = F.concat(F.lit("[[laws/"), "law_name", F.lit("/"), "law_name", F.lit("]]"))
    return rows.withColumns(
        {
            "new_parent": F.when(F.col("s_name").isNotNull(), to("節", F.col("s_name"))).when(F.col("c_name").isNotNull(), to("章", F.col("c_name"))).otherwise(law),
            "resolution": F.when(F.col("s_name").isNotNull(), "section").when(F.col("c_name").isNotNull(), "chapter").otherwise("law"),
        }
    ).drop("s_law", "s_name", "c_law", "c_name")


def contents(files: DataFrame) -> DataFrame:
    """(law_name, folder, n_files, first_file, body): the table of contents of each folder of a law, articles in their order.

    ``files``: law_name, folder (本文, 附則/改正法/KEY, ...) and name (第1条.md). A folder of amendments is one line that leads to its first file.
    """
    key = N.contents_key(F.col("name"))
    rows = F.array_sort(F.collect_list(F.struct(key.alias("key"), "name")))
    stem = lambda x: F.regexp_replace(x, r"\.md$", "")
    grouped = files.groupBy("law_name", "folder").agg(rows.getField("name").alias("names"), F.count("*").alias("n_files"))
    line = F.transform("names", lambda x: F.concat(F.lit("- [["), "folder", F.lit("/"), x, F.lit("|"), stem(x), F.lit("]]")))
    amended = F.col("folder").startswith("附則/改正法/")
    label = F.substring_index("folder", "/", -1)
    single = F.concat(F.lit("- [["), "folder", F.lit("/"), F.element_at("names", 1), F.lit("|"), label, F.lit("]]"), F.when(F.col("n_files") > 1, F.concat(F.lit(" ("), F.col("n_files").cast("string"), F.lit("条)"))).otherwise(""))
    return grouped.select("law_name", "folder", "n_files", F.element_at("names", 1).alias("first_file"), F.when(amended, single).otherwise(F.array_join(line, "\n")).alias("body"))


def law_pages(files: DataFrame) -> DataFrame:
    """(law_name, page): the whole table of contents of each law, from the same ``files`` as ``contents``.

    In order: the main part with its count, amendments with theirs (each by the number of its law), supplements in force, initial
    supplements by number, folders that still have their old names (init_N) last. Other folders are not shown.
    """
    c = F.col
    label = F.substring_index("folder", "/", -1)
    amended = c("folder").startswith("附則/改正法/")
    old = F.regexp_extract("folder", "^附則/init_([0-9]+)$", 1).try_cast("int")
    named = F.regexp_extract("folder", "^附則/制定時附則([0-9]*)$", 1)
    initial = c("folder").rlike("^附則/制定時附則[0-9]*$")
    rank = F.when(c("folder") == "本文", 0).when(amended, 1).when(c("folder") == "附則", 2).when(initial, 3).when(old.isNotNull(), 4)
    number = F.when(initial, F.coalesce(named.try_cast("int"), F.lit(0))).when(old.isNotNull(), old).otherwise(0)
    title = amendment_title(label)
    body = F.when(amended, F.regexp_replace("body", r"\|[^\]|]*\]\]", F.concat(F.lit("|"), title, F.lit("]]")))).otherwise(c("body"))
    rows = contents(files).select("law_name", "folder", "n_files", rank.alias("rank"), number.alias("number"), F.when(initial, label).when(old > 0, F.concat(F.lit("制定時附則"), (old + 1).cast("string"))).otherwise("制定時附則").alias("named"), body.alias("body")).where("rank is not null")
    lines = F.array_join(F.array_sort(F.collect_list(F.struct("folder", "body"))).getField("body"), "\n")
    parts = rows.groupBy("law_name", "rank", "number", "named").agg(F.sum("n_files").alias("n"), F.count("*").alias("n_folders"), lines.alias("body"))
    heading = (
        F.when(c("rank") == 0, F.concat(F.lit("## 本則（全"), c("n").cast("string"), F.lit("条）")))
        .when(c("rank") == 1, F.concat(F.lit("## 附則（改正法: "), c("n_folders").cast("string"), F.lit("件）")))
        .when(c("rank") == 2, F.lit("### 現行附則"))
        .otherwise(F.concat(F.lit("### "), c("named"), F.lit("（全"), c("n").cast("string"), F.lit("条）")))
    )
    whole = F.array_sort(F.collect_list(F.struct("rank", "number", F.concat(heading, F.lit("\n\n"), "body").alias("part")))).getField("part")
    return parts.groupBy("law_name").agg(F.array_join(whole, "\n\n").alias("page"))


def supplement_names(supplements: DataFrame) -> DataFrame:
    """Supplements with ``name``: an amendment by its key, the others 制定時附則 and then numbered from 2 by position within the law."""
    from pyspark.sql import Window

    own = F.coalesce(F.col("amend_law_num"), F.lit("")) == ""
    n = F.row_number().over(Window.partitionBy("law_id", own).orderBy("pos"))
    initial = F.concat(F.lit("制定時附則"), F.when(n > 1, n.cast("string")).otherwise(""))
    return supplements.withColumn("name", F.when(own, initial).otherwise(amendment_key(F.col("amend_law_num"))))
