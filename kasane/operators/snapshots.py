"""Differences between two snapshots of files, of edges and of metadata, and the verdict on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kasane.functions import links as L

#: Metadata fields whose change does not matter.
IGNORED = ["generated_at", "updated_at", "as_of", "tags", "parent"]


def file_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, status): missing, new, changed or same, from one full join on the path. New files in the folders 章 and 節 are ``structure``.

    ``before`` and ``after``: path (from the folder of the law) and body; bodies are compared by their digests, without blanks at
    the ends of lines and empty lines at the end.
    """
    digest = F.sha2(L.trimmed_lines(F.col("body")), 256)
    one = before.select("path", digest.alias("b"), F.lit(True).alias("in_before"))
    two = after.select("path", digest.alias("a"), F.lit(True).alias("in_after"))
    built = F.substring_index("path", "/", 1).isin("章", "節")
    status = (
        F.when(F.col("in_after").isNull(), "missing")
        .when(F.col("in_before").isNull() & built, "structure")
        .when(F.col("in_before").isNull(), "new")
        .when(F.col("a").eqNullSafe(F.col("b")), "same")
        .otherwise("changed")
    )
    return one.join(two, "path", "full_outer").select("path", status.alias("status"))


def multiset_diff(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of each side that the other lacks, with how many more there are: (*keys, side, n).

    One grouped sum of +1 and -1 does both directions of EXCEPT ALL in a single shuffle.
    """
    both = before.select(*keys, F.lit(1).alias("n")).unionByName(after.select(*keys, F.lit(-1).alias("n")))
    rows = both.groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0")
    return rows.select(*keys, F.when(F.col("n") > 0, "missing").otherwise("new").alias("side"), F.abs("n").alias("n"))


def field_diff(before: DataFrame, after: DataFrame, ignored: list[str] = IGNORED) -> DataFrame:
    """(path, field, before, after) of metadata maps that differ; ``before`` and ``after``: path and fields (map of strings)."""
    one = before.select("path", F.explode("fields").alias("field", "before"))
    two = after.select("path", F.explode("fields").alias("field", "after"))
    rows = one.join(two, ["path", "field"], "full_outer").where(~F.col("field").isin(ignored))
    both = before.select("path").intersect(after.select("path"))
    return rows.where(~F.col("before").eqNullSafe(F.col("after"))).join(both, "path", "left_semi")


def verdict(files: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: n_missing, n_changed, n_new, n_edges_missing, n_edges_new, compatible. New files do not break compatibility."""
    count = lambda name, *kinds: F.count_if(F.col("status").isin(*kinds)).alias(name)
    f = files.groupBy().agg(count("n_missing", "missing"), count("n_changed", "changed"), count("n_new", "new", "structure"))
    e = edges.groupBy().agg(*(F.coalesce(F.sum(F.when(F.col("side") == s, F.col("n"))), F.lit(0)).cast("long").alias(f"n_edges_{s}") for s in ("missing", "new")))
    return f.crossJoin(e).withColumn("compatible", F.expr("n_missing + n_changed + n_edges_missing + n_edges_new = 0"))
