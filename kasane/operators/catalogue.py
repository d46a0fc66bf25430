"""The catalogue of laws: entries, domains, enrichment by search hits, targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kasane.functions import dictionaries as D
from kasane.functions.names import safe_file_name


def domains(classes: Column, override: Column, of_class: dict[str, str] | None = None) -> Column:
    """The override if there is one, else the sorted distinct domains of the classes (``of_class``: the map of a hand-kept file, else the known one); unknown classes count as その他."""
    table = F.create_map(*(F.lit(x) for kv in (of_class or D.DOMAINS).items() for x in kv))
    own = F.array_sort(F.array_distinct(F.transform(classes, lambda c: F.coalesce(F.try_element_at(table, c), F.lit(D.OTHER_DOMAIN)))))
    return F.when(F.size(override) > 0, override).otherwise(own)


def entries(laws: DataFrame, overrides: DataFrame, of_class: dict[str, str] | None = None) -> DataFrame:
    """Catalogue rows of ``laws`` (law_id, law_name, law_num, promulgation_date, classes): node_id, folder, title, domain, link. See ``landing.domain_overrides`` and ``class_map``."""
    rows = laws.join(overrides.select("law_id", F.col("domains").alias("__override")), "law_id", "left")
    return rows.select(
        F.concat(F.lit("JPLAW:"), "law_id").alias("node_id"), "law_id", F.coalesce("law_num", F.lit("")).alias("law_num"), F.coalesce("law_name", F.lit("")).alias("title"), safe_file_name(F.coalesce("law_name", F.lit(""))).alias("folder"),
        F.coalesce("promulgation_date", F.lit("")).alias("promulgation_date"), F.lit(0).alias("tier"), domains(F.coalesce("classes", F.array().cast("array<string>")), F.col("__override"), of_class).alias("domain"), F.concat(F.lit("https://laws.e-gov.go.jp/law/"), "law_id").alias("link"),
    )


def best_hit(laws: DataFrame, hits: DataFrame) -> DataFrame:
    """(law_id, hit_id, priority): the best search hit of each law; laws without a number or a hit are left out.

    First hits with the law's number in the title, then with its name as title, word or beginning, then any; ties by the
    order of hits. ``hits``: law_id, hit_id, ord, title.
    """
    own = laws.where("law_num <> ''").join(hits, "law_id")
    named = (F.col("law_name") != "") & ((F.col("title") == F.col("law_name")) | F.concat(F.lit(" "), "title", F.lit(" ")).contains(F.concat(F.lit(" "), "law_name", F.lit(" "))) | F.col("title").startswith(F.col("law_name")))
    priority = F.when(F.col("title").contains(F.col("law_num")), 1).when(named, 2).otherwise(3)
    return own.withColumn("priority", priority).groupBy("law_id").agg(F.min_by(F.struct("hit_id", "priority"), F.struct("priority", "ord")).alias("x")).select("law_id", "x.hit_id", "x.priority")


def enriched(laws: DataFrame, hits: DataFrame) -> DataFrame:
    """``laws`` with legislative_origin, the whole best hit of each as a record, and enriched; laws without a number or a hit have null and stay as they are."""
    best = best_hit(laws, hits).select("law_id", "hit_id").join(hits, ["law_id", "hit_id"])
    record = F.struct(*(c for c in best.columns if c not in ("law_id", "ord")))
    origin = best.groupBy("law_id").agg(F.min_by(record, "ord").alias("legislative_origin"))
    return laws.join(origin, "law_id", "left").withColumn("enriched", F.col("legislative_origin").isNotNull())


def targeted(laws: DataFrame, targets: DataFrame) -> DataFrame:
    """Laws that the target list names."""
    return laws.join(targets.select("law_id"), "law_id", "left_semi")


def law_folders(files: DataFrame) -> DataFrame:
    """(law_name, n_files, law_file): the laws that a corpus holds, by the folders under laws/ that are not hidden.

    ``files``: path. law_file: the first visible Markdown file that lies in the folder itself; null if there is none. A folder without files is not seen.
    """
    law = F.regexp_extract("path", r"(?:^|/)laws/([^/.][^/]*)/", 1)
    own = F.when(F.col("path").rlike(r"(?:^|/)laws/[^/]+/[^/.][^/]*\.md$"), F.col("path"))
    return files.select(law.alias("law_name"), own.alias("own")).where("law_name <> ''").groupBy("law_name").agg(F.count("*").alias("n_files"), F.min("own").alias("law_file"))


def law_places(ids: DataFrame, laws: DataFrame, folders: DataFrame) -> DataFrame:
    """``ids`` (law_id) with the folder and file of each law; null where ``laws`` (law_id, folder) or ``folders`` (see ``law_folders``) lack it."""
    placed = folders.select(F.col("law_name").alias("folder"), "law_file")
    return ids.join(laws.select("law_id", "folder"), "law_id", "left").join(placed, "folder", "left").select("law_id", "folder", "law_file")


def run_report(runs: DataFrame) -> DataFrame:
    """(status, error, n, first_target) of ``runs`` (target, error: null where it went well); one failure does not hide the others."""
    status = F.when(F.col("error").isNull(), "success").otherwise("failed")
    return runs.groupBy(status.alias("status"), "error").agg(F.count("*").alias("n"), F.min("target").alias("first_target"))
