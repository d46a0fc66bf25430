"""Repair of a corpus run by run: what a manifest has seen with the same content is neither repaired nor written again.

A folder holds ``bodies/run=N`` and ``manifest/run=N``, Parquet, N from 1. A run writes the bodies that are new or changed, then its manifest, which is what
makes it count: a run that was broken off before leaves bodies that nothing names, and the next run, of the same number, writes over them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kasane.plans.staging import stage

MANIFEST = "path string, digest string, rules string, status string, run int"
COUNTS = ("new", "changed", "same", "deleted")


def digest(body: Column) -> Column:
    return F.sha2(F.coalesce(body.cast("string"), F.lit("")).cast("binary"), 256)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The last word on each path: (path, digest, rules, status, run); deleted paths too. Empty before the first run."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)
    return rows.groupBy("path").agg(F.max_by(F.struct("digest", "rules", "status", "run"), "run").alias("x")).select("path", "x.*")


def compared(files: DataFrame, known: DataFrame, rules: str) -> DataFrame:
    """(path, digest, status): new, changed (the content, or the rules it was repaired by), same or deleted. Only paths and digests are shuffled."""
    now = files.groupBy("path").agg(F.max(digest(F.col("body"))).alias("digest"))
    old = known.where("status <> 'deleted'").select("path", F.col("digest").alias("__was"), F.col("rules").alias("__rules"))
    both = now.join(old, "path", "full")
    status = F.when(F.col("digest").isNull(), "deleted").when(F.col("__was").isNull(), "new").when((F.col("digest") == F.col("__was")) & (F.col("__rules") == rules), "same").otherwise("changed")
    return both.select("path", "digest", status.alias("status"))


def run(files: DataFrame, folder: str, repair: Callable[[DataFrame], DataFrame], rules: str = "1") -> dict[str, int]:
    """One run over ``files`` (path, body), each path once: how many are new, changed, same and deleted, counted while the manifest is written.

    ``repair`` takes and returns rows of (path, body), and sees new and changed ones alone; ``rules`` names its version: another one repairs everything anew. A null
    path is left out; a null body has the digest of an empty one. The result is read with ``current``.
    """
    spark = files.sparkSession
    known = manifest(spark, folder)
    number = (known.agg(F.max("run")).first()[0] or 0) + 1
    given = files.where("path is not null").select("path", F.col("body").cast("string").alias("body"))
    judged = stage(compared(given, known, rules), "compared")
    todo = given.join(judged.where("status in ('new', 'changed')").select("path"), "path", "left_semi")
    repair(todo).select("path", "body").write.mode("overwrite").parquet(f"{folder}/bodies/run={number}")
    seen = Observation()
    counted = judged.observe(seen, *(F.count_if(F.col("status") == s).alias(s) for s in COUNTS))
    news = counted.where("status <> 'same'").select("path", "digest", F.lit(rules).alias("rules"), "status", F.lit(number).alias("run"))
    news.write.mode("overwrite").parquet(f"{folder}/manifest/run={number}")
    return {s: seen.get[s] for s in COUNTS}


def current(spark: SparkSession, folder: str) -> DataFrame:
    """(path, body, run): the repaired body of each path that is not deleted, and the run that wrote it."""
    live = manifest(spark, folder).where("status <> 'deleted'").select("path", "run")
    bodies = spark.read.schema("path string, body string, run int").parquet(f"{folder}/bodies")
    return bodies.join(live, ["path", "run"]).select("path", "body", "run")
