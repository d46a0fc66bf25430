"""Rewriting of links in bodies, and migration of names and metadata: the new value beside the old, with a flag of change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kasane.functions import arrays as A
from kasane.functions import links as L
from kasane.functions import names as N
from kasane.functions.numerals import kanji_number
from kasane.operators.citations import CITATION, link_of

CONTEXT = 50


def unlinked(bodies: DataFrame) -> DataFrame:
    """``bodies`` (law_name, body) with bare links to the law's own main part as plain words: (…, body, n_unlinked, n_kept).

    A link is bare if no form of the law's name stands in the ``CONTEXT`` characters before it. Each link is judged and
    replaced at its own place.
    """
    pattern = F.concat(F.lit(r"\[\[laws/"), "law_name", F.lit(r"/本文/[^\]|]+\.md(?:\|[^\]]+)?\]\]"))
    hits, gaps = F.regexp_extract_all("body", pattern, F.lit(0)), F.split("body", pattern, -1)
    rows = bodies.withColumns({"__hits": hits, "__gaps": gaps})
    rows = rows.withColumn("__before", A.texts_before(F.col("__gaps"), F.col("__hits"), CONTEXT))
    bare = F.transform("__before", lambda x: ~L.without_links(x).contains(F.col("law_name")))
    rows = rows.withColumn("__bare", bare)
    words = lambda hit: F.regexp_replace(F.regexp_replace(L.without_links(hit), r"^.*/", ""), r"\.md$", "")
    shown = F.zip_with("__hits", "__bare", lambda hit, plain: F.when(plain, words(hit)).otherwise(hit))
    cut = F.size(F.filter("__bare", lambda x: x))
    return rows.select(*[c for c in bodies.columns if c != "body"], _between(F.col("__gaps"), shown).alias("body"), cut.alias("n_unlinked"), (F.size("__hits") - cut).alias("n_kept"))


def _between(gaps: Column, matches: Column) -> Column:
    """The gaps of a text with what stands between them now."""
    return F.array_join(F.zip_with(gaps, matches, lambda gap, x: F.concat(gap, F.coalesce(x, F.lit("")))), "")


def relinked(bodies: DataFrame) -> DataFrame:
    """``bodies`` with plain citations that follow the law's name in the same sentence as links: (…, body, n_linked).

    Looser than the builder: any form of the name anywhere before in the sentence opens the scope, whatever follows it.
    """
    plain = rf"(?<![\[|/第]){CITATION}(?![^\[\]]*\]\])"
    parts = [F.regexp_extract_all("body", F.lit(plain), F.lit(i)).alias(n) for i, n in enumerate(("raw", "main", "sub"))]
    rows = bodies.withColumns({"__gaps": F.split("body", plain, -1), "__m": F.arrays_zip(*parts)}).withColumn("__raw", F.col("__m")["raw"])
    # the sentence goes on over gaps without 。; the name stands in it if it was seen after the last 。, within a gap or across the citation before it
    width = F.length("law_name")
    ahead = lambda i: F.coalesce(F.concat(F.right(F.get("__gaps", i - 1), width), F.get("__raw", i - 1)), F.lit(""))
    read = lambda gap, i: L.without_links(F.substring_index(F.concat(ahead(i), gap), "。", -1))
    named = F.transform(F.slice("__gaps", 1, F.size("__raw")), lambda gap, i: F.when(read(gap, i).contains(F.col("law_name")), i).otherwise(-1))
    fresh = F.transform(F.slice("__gaps", 1, F.size("__raw")), lambda gap, i: F.when(gap.contains("。"), i).otherwise(-1))
    scoped = F.zip_with(A.running(named, F.greatest), A.running(fresh, F.greatest), lambda a, b: (a >= 0) & (a >= b))
    number = lambda m: F.concat(kanji_number(m["main"]).cast("string"), F.when(m["sub"] != "", F.concat(F.lit("_"), kanji_number(m["sub"]).cast("string"))).otherwise(""))
    rows = rows.withColumn("__scoped", scoped)
    shown = F.zip_with("__m", "__scoped", lambda m, s: F.when(s, link_of(F.col("law_name"), number(m), m["raw"])).otherwise(m["raw"]))
    return rows.select(*[c for c in bodies.columns if c != "body"], _between(F.col("__gaps"), shown).alias("body"), F.size(F.filter("__scoped", lambda x: x)).alias("n_linked"))


def localized_paths(files: DataFrame) -> DataFrame:
    """(old_path, new_path, changed) of ``files`` (path): article files and the folders of parts under their Japanese names."""
    name, folder = F.substring_index("path", "/", -1), F.regexp_replace("path", "[^/]*$", "")
    local = F.regexp_replace(F.regexp_replace(folder, "(^|/)main/", "$1本文/"), "(^|/)suppl/", "$1附則/")
    new_name = F.when(name.rlike(r"^Article_[0-9_:]+\.md$"), F.concat(N.localized_article(name, folder.rlike("(^|/)suppl/")), F.lit(".md"))).otherwise(name)
    new = F.concat(local, new_name)
    return files.select(F.col("path").alias("old_path"), new.alias("new_path"), (new != F.col("path")).alias("changed"))


def initial_supplements(folders: DataFrame) -> DataFrame:
    """(law_name, old, new) of folders init_0, init_1, ... as 制定時附則, 制定時附則2, ...; those whose new name exists already stay out."""
    n = F.regexp_extract("name", "^init_([0-9]+)$", 1).try_cast("int")
    new = F.concat(F.lit("制定時附則"), F.when(n > 0, (n + 1).cast("string")).otherwise(""))
    moves = folders.where(n.isNotNull()).select("law_name", F.col("name").alias("old"), new.alias("new"))
    return moves.join(folders.select("law_name", F.col("name").alias("new")), ["law_name", "new"], "left_anti").select("law_name", "old", "new")


def filled(rows: DataFrame, defaults: dict[str, Column], tags: Column | None = None) -> DataFrame:
    """Rows with missing fields filled from ``defaults``, ``tags`` added to the tags, and what was added: (…, added_fields, changed)."""
    missing = F.filter(F.array(*(F.when(F.col(k).isNull() & v.isNotNull(), F.lit(k)) for k, v in defaults.items())), lambda x: x.isNotNull())
    out = rows.withColumn("added_fields", missing)
    new_tags = F.coalesce(F.col("tags"), F.array().cast("array<string>")) if tags is not None else None
    changed = F.size("added_fields") > 0
    if tags is not None:
        changed = changed | (F.size(F.array_except(tags, new_tags)) > 0)
    out = out.withColumn("changed", changed)
    if tags is not None:
        out = out.withColumn("tags", F.array_union(new_tags, tags))
    return out.withColumns({k: F.coalesce(F.col(k), v) for k, v in defaults.items()})


def bumped(nodes: DataFrame, tier: int) -> DataFrame:
    """Nodes with their tier raised to ``tier`` where it is lower."""
    return nodes.withColumn("tier", F.greatest(F.coalesce("tier", F.lit(0)), F.lit(tier)))


def parent_changes(files: DataFrame) -> DataFrame:
    """The change log of a run that sets parents: (path, old_parent, new_parent, status), one row a file.

    ``files``: path, parent (what the file holds), new_parent (see ``structure.resolved_parent``). status: error where no parent was found,
    unchanged where the file holds it already, added where it held none, else changed. ``landing.append_log`` writes the rows.
    """
    status = F.when(F.col("new_parent").isNull(), "error").when(F.col("parent") == F.col("new_parent"), "unchanged").when(F.col("parent").isNull(), "added").otherwise("changed")
    return files.select("path", F.col("parent").alias("old_parent"), "new_parent", status.alias("status"))


def status_counts(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("n"))
