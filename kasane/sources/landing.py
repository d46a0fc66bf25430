"""Readers and writers: law lists and trees, search results, edge and pending logs, ignore patterns, Markdown documents.

Fetching stays outside Spark; what was fetched is landed as files, which these readers take with explicit schemas.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kasane.functions import frontmatter as Y
from kasane.functions import links as L

LAW_LIST = "laws array<struct<law_info: struct<law_id: string, law_num: string, promulgation_date: string>, revision_info: struct<law_title: string>>>"
EDGES_V1 = "`from` string, `to` string, type string, evidence string, confidence double, source string, kind string"
PENDING = (
    "id string, ts string, src_path string, src_law_name string, kind string, anchor_text string, original_wikilink string, replaced_with string, reason string, "
    "match_span struct<start: int, end: int>, context_before string, context_after string, hints map<string,string>, status string, resolved_ts string, resolved_target string"
)


def law_list(spark: SparkSession, path: str) -> DataFrame:
    """(law_id, law_name, law_num, promulgation_date) of landed law lists; missing fields are empty."""
    rows = spark.read.schema(LAW_LIST).json(path, multiLine=True).select(F.inline("laws"))
    fields = {"law_id": "law_info.law_id", "law_name": "revision_info.law_title", "law_num": "law_info.law_num", "promulgation_date": "law_info.promulgation_date"}
    return rows.select(*(F.coalesce(v, F.lit("")).alias(k) for k, v in fields.items()))


def law_trees(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(law_id, tree): the law_full_text of each landed response, one file a law, named by its identifier. Responses without one are left out, or fail where ``strict``."""
    rows = spark.read.text(path, wholetext=True).select(F.col("value"), F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1).alias("law_id"))
    tree = F.get_json_object("value", "$.law_full_text")
    if strict:
        tree = F.coalesce(tree, F.raise_error(F.concat(F.lit("no law_full_text for "), "law_id")))
    return rows.select("law_id", tree.alias("tree")).where("tree is not null")


_ITEM = ("title", "link", "guid", "description", "dc:creator", "dc:date", "dc:publisher", "dc:description")


def search_hits(spark: SparkSession, path: str) -> DataFrame:
    """(source, ord, title, link, guid, description, creator, date, publisher) of the items of landed RSS results, one file a search; ord is the place in the file."""
    schema = "channel struct<item: array<struct<" + ", ".join(f"`{k}`: string" for k in _ITEM) + ">>>"
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source"), F.from_xml("value", schema).alias("x"))
    items = rows.select("source", F.posexplode("x.channel.item").alias("ord", "item"))
    return items.select(
        "source", "ord", "item.title", "item.link", "item.guid", F.coalesce("item.description", "item.`dc:description`").alias("description"),
        F.col("item.`dc:creator`").alias("creator"), F.col("item.`dc:date`").alias("date"), F.col("item.`dc:publisher`").alias("publisher"),
    )


def file_paths(spark: SparkSession, root: str) -> DataFrame:
    """(path) of all files under a folder; their contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")


def cache_name(key):
    """File name of a landed response: its key's digest."""
    return F.concat(F.md5(key), F.lit(".json"))


def edge_log(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Edges of a JSON-lines file; broken lines are left out, or fail where ``strict``."""
    return spark.read.schema(EDGES_V1).json(path, mode="FAILFAST" if strict else "DROPMALFORMED")


def pending_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PENDING).json(path, mode="DROPMALFORMED").where("id is not null")


def ignore_patterns(spark: SparkSession, path: str) -> DataFrame:
    """(pattern): the lines of a file without comments and blanks."""
    return spark.read.text(path).select(F.trim(F.regexp_replace("value", "#.*", "")).alias("pattern")).where("pattern <> ''").distinct()


def markdown(spark: SparkSession, path: str) -> DataFrame:
    """(path, fields, body) of the Markdown files under a folder."""
    rows = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    parts = L.front_matter(F.col("value"))
    return rows.select(F.col("_metadata.file_path").alias("path"), parts.alias("x")).select("path", L.simple_fields(F.col("x.raw_yaml")).alias("fields"), "x.body")


def nested_markdown(spark: SparkSession, path: str) -> DataFrame:
    """(path, front, json, body) of the Markdown files under a folder: nested fields as VARIANT and as JSON text in their order, null where there are none or they cannot be read."""
    rows = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    return rows.select(F.col("_metadata.file_path").alias("path"), Y.parsed(F.col("value")).alias("x")).select("path", "x.*")


def _yaml_files(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(k, v) of the top-level entries of YAML files, read as ``kind``; a missing or empty file has none, and one that cannot be read fails."""
    try:
        texts = spark.read.text(path, wholetext=True)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        texts = spark.createDataFrame([], "value string")
    read = F.coalesce(Y.read(F.col("value")), F.raise_error(F.lit(f"no YAML in {path}")))
    return texts.select(F.explode(F.from_json(read, f"map<string, {kind}>")).alias("k", "v"))


def domain_overrides(spark: SparkSession, path: str) -> DataFrame:
    """(law_id, domains): hand-kept domains of laws, a YAML mapping of identifiers to lists; entries without any are left out."""
    return _yaml_files(spark, path, "array<string>").where("size(v) > 0").select(F.col("k").alias("law_id"), F.col("v").alias("domains"))


def class_map(spark: SparkSession, path: str) -> dict[str, str]:
    """The domain of each class, a YAML mapping of a few words; it goes into the plan as a constant."""
    return {r["k"]: r["v"] for r in _yaml_files(spark, path, "string").where("v is not null").collect()}


def target_list(spark: SparkSession, path: str) -> DataFrame:
    """(law_id): identifiers of a list in YAML, one ``- id`` a line, plain or under ``targets:``; an empty or missing file names none."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], "value string")
    rows = lines.select(F.regexp_extract("value", r"""^\s*-\s*["']?([^"'#\s]+)""", 1).alias("law_id"))
    return rows.where("law_id <> ''").distinct()


def document_text(fields, body):
    """A Markdown document: fields in order of their names between dashes, a blank line, the body."""
    lines = F.transform(F.array_sort(F.map_entries(fields)), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return F.concat(F.lit("---\n"), F.array_join(lines, "\n"), F.lit("\n---\n\n"), body)


def write_json_lines(rows: DataFrame, path: str, order: list[str] | None = None, hidden: tuple[str, ...] = ()) -> None:
    """Rows as JSON lines, repeated ones too; absent fields are left out.

    With ``order`` the lines stand in the order of these columns, over all files by their names: ranges of them are sorted side by side, and no task holds all.
    ``hidden`` columns order the lines and are not written. Edges, broken links and the differences of snapshots are written so.
    """
    if order:
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.drop(*hidden).write.json(path, ignoreNullFields=True)


def write_edges(edges: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Edges as JSON lines; columns of ``order`` that edges do not have themselves (a file and a place in it) are not written."""
    own = spark_columns(EDGES_V1)
    write_json_lines(edges, path, order, tuple(c for c in order or () if c not in own))


def spark_columns(schema: str) -> list[str]:
    return [c.split()[0].strip("`") for c in schema.split(",")]


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def write_nodes(nodes: DataFrame, path: str) -> None:
    """The canonical store of nodes: Parquet in a folder for each law."""
    nodes.write.partitionBy("law_name").parquet(path)


def write_mapping(mapping: DataFrame, path: str, files: DataFrame | None = None) -> None:
    """``mapping`` (old_path, new_path) as CSV by old path, with the bytes of each old file of ``files`` (path, length), 0 where there is none."""
    sizes = mapping.sparkSession.createDataFrame([], "path string, length long") if files is None else files.select("path", "length")
    rows = mapping.join(sizes, mapping["old_path"] == sizes["path"], "left").select("old_path", "new_path", F.coalesce("length", F.lit(0)).alias("bytes"))
    # The headings.
    rows.orderBy("old_path").toDF("旧パス", "新パス", "サイズ(bytes)").write.csv(path, header=True)


def law_index(laws: DataFrame) -> DataFrame:
    """One row: the map from identifier to folder."""
    return laws.groupBy().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("law_id", "folder")))).alias("index"))
