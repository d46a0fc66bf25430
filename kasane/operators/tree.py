"""Law trees: nested JSON ({tag, attr, children}) flattened once into rows, and what is read from the rows.

There are two walks with the same rows. ``flatten`` walks a law once in a Python task, fed by Arrow; ``walked`` is a recursive query over
VARIANT, a round for each level of depth, without Python. Every row carries the chapter and section that it stands in and the line of its ancestors. All else is
relational: what lies within a node names it in its line, so a subtree is read by one grouping, in proportion to the
nodes and their depth.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kasane.functions.numerals import loose_int
from kasane.plans.staging import stage

NODES = "law_id string, pos int, parent_pos int, end_pos int, depth int, part int, tag string, attr map<string,string>, text string, chapter_pos int, section_pos int, article_pos int, line array<struct<tag: string, pos: int>>"
_ARROW = pa.schema(
    [
        ("law_id", pa.string()),
        *((k, pa.int32()) for k in ("pos", "parent_pos", "end_pos", "depth", "part")),
        ("tag", pa.string()),
        ("attr", pa.map_(pa.string(), pa.string())),
        ("text", pa.string()),
        *((k, pa.int32()) for k in ("chapter_pos", "section_pos", "article_pos")),
        ("line", pa.list_(pa.struct([("tag", pa.string()), ("pos", pa.int32())]))),
    ]
)


def _walk(law_id: str | None, tree: dict) -> list[dict]:
    """Rows in preorder; text children are rows of tag #text. A chapter clears the section, a subsection stands for a section. The line ends with the node itself."""
    rows: list[dict] = []
    todo: list[tuple] = [(tree, None, 0, None, None, None, None, ())]
    while todo:
        node, up, depth, part, chapter, section, article, line = todo.pop()
        if node is None:  # all within the node ``up`` has been seen
            rows[up]["end_pos"] = len(rows) - 1
            continue
        pos = len(rows)
        row = {"law_id": law_id, "pos": pos, "parent_pos": up, "end_pos": pos, "depth": depth, "part": part, "attr": None, "text": None, "chapter_pos": chapter, "section_pos": section, "article_pos": article, "line": line}
        rows.append(row)
        if not isinstance(node, dict):
            row |= {"tag": "#text", "text": str(node)}
            continue
        tag = str(node.get("tag") or "")
        row |= {"tag": tag, "attr": [(str(k), str(v)) for k, v in (node.get("attr") or {}).items()]}
        if tag in ("MainProvision", "SupplProvision"):
            part, chapter, section, article = pos, None, None, None
        elif tag == "Chapter":
            chapter, section = pos, None
        elif tag in ("Section", "Subsection"):
            section = pos
        elif tag == "Article":
            article = pos
        line = (*line, {"tag": tag, "pos": pos})
        row |= {"part": part, "chapter_pos": chapter, "section_pos": section, "article_pos": article, "line": line}
        todo.append((None, pos, 0, None, None, None, None, ()))
        todo += [(c, pos, depth + 1, part, chapter, section, article, line) for c in reversed(node.get("children") or [])]
    return rows


def flatten(laws: DataFrame) -> DataFrame:
    """Node rows of ``laws`` (law_id, tree: JSON text). A null or unreadable tree has no rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for law_id, text in zip(batch.column("law_id").to_pylist(), batch.column("tree").to_pylist(), strict=True):
                try:
                    tree = json.loads(text or "null")
                except ValueError:
                    continue
                if isinstance(tree, dict):
                    yield pa.RecordBatch.from_pylist(_walk(law_id, tree), schema=_ARROW)

    return laws.select(F.col("law_id").cast("string"), F.col("tree").cast("string").alias("tree")).mapInArrow(work, NODES)


#: One level of a walk: a child knows its path, its tags from the root, and at which depth the context stands that it is in.
_RECURSIVE = """
WITH RECURSIVE walk AS (
  SELECT law_id, node, cast(array() AS array<int>) AS path, array(tag) AS tags, if(tag IN ('MainProvision', 'SupplProvision'), 0, null) AS part,
    if(tag = 'Chapter', 0, null) AS chapter, if(tag IN ('Section', 'Subsection'), 0, null) AS section, if(tag = 'Article', 0, null) AS article
  FROM (SELECT law_id, node, coalesce(try_variant_get(node, '$.tag', 'string'), '') AS tag FROM {laws} WHERE schema_of_variant(node) LIKE 'OBJECT%')
  UNION ALL
  SELECT law_id, node, path, array_append(tags, tag), if(is_part, depth, part),
    CASE WHEN is_part THEN null WHEN tag = 'Chapter' THEN depth ELSE chapter END,
    CASE WHEN is_part OR tag = 'Chapter' THEN null WHEN tag IN ('Section', 'Subsection') THEN depth ELSE section END,
    CASE WHEN is_part THEN null WHEN tag = 'Article' THEN depth ELSE article END
  FROM (SELECT *, tag IN ('MainProvision', 'SupplProvision') AS is_part, size(path) AS depth FROM (
    SELECT w.law_id, c.value AS node, array_append(w.path, c.pos) AS path, w.tags, w.part, w.chapter, w.section, w.article,
      if(schema_of_variant(c.value) LIKE 'OBJECT%', coalesce(try_variant_get(c.value, '$.tag', 'string'), ''), '#text') AS tag
    FROM walk AS w, LATERAL variant_explode(try_variant_get(w.node, '$.children', 'variant')) AS c))
)
SELECT law_id, path, size(path) AS depth, element_at(tags, -1) AS tag, tags, part, chapter, section, article,
  if(element_at(tags, -1) = '#text', null, coalesce(try_variant_get(node, '$.attr', 'map<string,string>'), map())) AS attr, if(element_at(tags, -1) = '#text', cast(node AS string), null) AS text
FROM walk"""


def walked(laws: DataFrame, most_depth: int = 1000) -> DataFrame:
    """The rows of ``flatten`` by a recursive query, staged; deeper trees than ``most_depth`` fail. ``laws``: law_id (each once), tree (JSON text).

    The recursion carries paths; places in preorder are their ranks within a law, and every ancestor's place is looked up by its path, a beginning of
    the row's own. A null or unreadable tree has no rows.
    """
    spark = laws.sparkSession
    given = laws.select(F.col("law_id").cast("string"), F.try_parse_json(F.col("tree").cast("string")).alias("node"))
    limits = {"spark.sql.cteRecursionRowLimit": "-1", "spark.sql.cteRecursionLevelLimit": str(most_depth)}
    before = {k: spark.conf.get(k) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        found = stage(spark.sql(_RECURSIVE, laws=given), "walk")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    placed = found.withColumn("pos", F.row_number().over(Window.partitionBy("law_id").orderBy("path")) - 1)
    placed = stage(placed, "places")
    names = placed.select("law_id", F.col("path").alias("up"), F.col("pos").alias("up_pos"))
    ups = placed.select("law_id", "path", F.col("pos").alias("of"), F.posexplode(F.transform(F.sequence(F.lit(0), "depth"), lambda k: F.slice("path", F.lit(1), k))).alias("k", "up"))
    ups = stage(ups.join(names, ["law_id", "up"]).select("law_id", "of", "k", "up_pos"), "ancestors")
    lines = ups.groupBy("law_id", F.col("of").alias("pos")).agg(F.array_sort(F.collect_list(F.struct("k", "up_pos"))).getField("up_pos").alias("ups"))
    ends = ups.groupBy("law_id", F.col("up_pos").alias("pos")).agg(F.max("of").alias("end_pos"))
    rows = placed.join(lines, ["law_id", "pos"]).join(ends, ["law_id", "pos"])
    at = lambda depth: F.get("ups", depth)
    is_text = F.col("tag") == "#text"
    line = F.zip_with("tags", "ups", lambda tag, pos: F.struct(tag.alias("tag"), pos.alias("pos")))
    return rows.select(
        "law_id", "pos", at(F.col("depth") - 1).alias("parent_pos"), "end_pos", "depth", at(F.col("part")).alias("part"), "tag", "attr", "text", at(F.col("chapter")).alias("chapter_pos"),
        at(F.col("section")).alias("section_pos"), at(F.col("article")).alias("article_pos"), F.when(is_text, F.slice(line, F.lit(1), F.col("depth"))).otherwise(line).alias("line"),
    )


def _tops(tag: str) -> Column:
    """The nodes of ``tag`` that a row stands in, itself included."""
    return F.explode(F.filter("line", lambda x: x["tag"] == tag)["pos"]).alias("top")


def _in_order() -> Column:
    return F.array_join(F.array_sort(F.collect_list(F.struct("pos", "text"))).getField("text"), "").alias("text")


def subtree_text(nodes: DataFrame, tag: str) -> DataFrame:
    """(law_id, pos, text): the whole text within each node of ``tag``, in document order; empty where there is none."""
    rows = nodes.where((F.col("tag") == tag) | (F.col("tag") == "#text"))
    return rows.select("law_id", _tops(tag), "pos", "text").groupBy("law_id", "top").agg(_in_order()).withColumnRenamed("top", "pos")


def first_child(nodes: DataFrame, parent_tag: str, child_tag: str) -> DataFrame:
    """(law_id, parent_pos, pos): the first direct child of ``child_tag`` of each node of ``parent_tag``."""
    p = nodes.where(F.col("tag") == parent_tag).select("law_id", F.col("pos").alias("parent_pos"))
    c = nodes.where(F.col("tag") == child_tag).groupBy("law_id", "parent_pos").agg(F.min("pos").alias("pos"))
    return p.join(c, ["law_id", "parent_pos"])


def descendants(nodes: DataFrame, tag: str, within: str) -> DataFrame:
    """(law_id, top, pos): nodes of ``tag`` within each node of ``within``, itself included."""
    return nodes.where(F.col("tag") == tag).select("law_id", _tops(within), "pos")


def _title(nodes: DataFrame, tag: str, name: str) -> DataFrame:
    """(law_id, parent_pos, name): text of the first child ``tag``, blank as null."""
    text = subtree_text(nodes, tag)
    first = nodes.where(F.col("tag") == tag).select("law_id", "pos", "parent_pos")
    rows = first.join(text, ["law_id", "pos"]).groupBy("law_id", "parent_pos").agg(F.min_by("text", "pos").alias(name))
    return rows.withColumn(name, F.nullif(F.regexp_replace(name, r"(?U)^\s+|\s+$", ""), F.lit("")))


def articles(nodes: DataFrame) -> DataFrame:
    """Article rows of the main part and of supplements, with their chapter, section, heading and whether a proviso stands in them.

    Columns: law_id, pos, part (main, suppl), amend_law_num, article_num, node_id, heading, chapter_num, chapter_title,
    section_num, section_title, has_proviso. Articles without a number are left out.
    """
    num = F.try_element_at("attr", F.lit("Num"))
    parts = nodes.where("tag in ('MainProvision', 'SupplProvision')").select("law_id", F.col("pos").alias("part_pos"), F.when(F.col("tag") == "MainProvision", "main").otherwise("suppl").alias("part"), F.try_element_at("attr", F.lit("AmendLawNum")).alias("amend_law_num"))
    rows = nodes.where("tag = 'Article'").select("law_id", "pos", F.col("part").alias("part_pos"), "chapter_pos", "section_pos", num.alias("article_num")).where("article_num <> ''")
    rows = rows.join(parts, ["law_id", "part_pos"])
    for kind, title, tags in (("chapter", "ChapterTitle", ["Chapter"]), ("section", "SectionTitle", ["Section", "Subsection"])):
        own = nodes.where(F.col("tag").isin(tags)).select("law_id", F.col("pos").alias(f"{kind}_pos"), loose_int(num).alias(f"{kind}_num"))
        named = _title(nodes, title, f"{kind}_title").withColumnRenamed("parent_pos", f"{kind}_pos")
        rows = rows.join(own, ["law_id", f"{kind}_pos"], "left").join(named, ["law_id", f"{kind}_pos"], "left")
    rows = rows.join(_title(nodes, "ArticleCaption", "heading").withColumnRenamed("parent_pos", "pos"), ["law_id", "pos"], "left")
    proviso = nodes.where("tag = 'Sentence' and try_element_at(attr, 'Function') = 'proviso' and article_pos is not null").select("law_id", F.col("article_pos").alias("pos"), F.lit(True).alias("p")).distinct()
    rows = rows.join(proviso, ["law_id", "pos"], "left")
    node_id = F.concat(F.lit("JPLAW:"), "law_id", F.lit("#"), "part", F.lit("#"), "article_num")
    return rows.select("law_id", "pos", "part", "amend_law_num", "article_num", node_id.alias("node_id"), "heading", "chapter_num", "chapter_title", "section_num", "section_title", F.coalesce("p", F.lit(False)).alias("has_proviso"))


def passages(nodes: DataFrame) -> DataFrame:
    """(law_id, article_pos, pos, kind, text): the text that citations are read from.

    Each paragraph gives the text of all its sentences, and each item its own once more, so a citation in an item counts twice.
    """
    texts = nodes.where("tag = '#text'").select("law_id", "line", "pos", "text", _tops("Sentence").alias("sentence"))
    blank = nodes.where("tag = 'Sentence'").select("law_id", "line", "pos", F.lit("").alias("text"), F.col("pos").alias("sentence"))
    out = []
    for kind in ("Paragraph", "Item"):
        tops = nodes.where(F.col("tag") == kind).select("law_id", "pos", "article_pos")
        said = texts.union(blank).select("law_id", "sentence", "pos", "text", _tops(kind)).where("top < sentence")
        whole = F.array_join(F.array_sort(F.collect_list(F.struct("sentence", "pos", "text"))).getField("text"), "").alias("text")
        text = said.groupBy("law_id", F.col("top").alias("pos")).agg(whole)
        out.append(text.join(tops, ["law_id", "pos"]).select("law_id", "article_pos", "pos", F.lit(kind.lower()).alias("kind"), "text"))
    return out[0].union(out[1])


def provisions(nodes: DataFrame) -> DataFrame:
    """(law_id, pos, node_id, n_paragraphs): supplements without articles, each a single node."""
    parts = nodes.where("tag = 'SupplProvision'").select("law_id", "pos", "end_pos")
    with_articles = nodes.where("tag = 'Article'").select("law_id", F.col("part").alias("pos")).distinct()
    paragraphs = nodes.where("tag = 'Paragraph'").groupBy("law_id", F.col("part").alias("pos")).agg(F.count("*").alias("n_paragraphs"))
    rows = parts.join(with_articles, ["law_id", "pos"], "left_anti").join(paragraphs, ["law_id", "pos"], "left")
    return rows.select("law_id", "pos", F.concat(F.lit("JPLAW:"), "law_id", F.lit("#suppl#Provision")).alias("node_id"), F.coalesce("n_paragraphs", F.lit(0).cast("long")).alias("n_paragraphs"))
