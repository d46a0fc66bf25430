"""Renames over the whole corpus: chains of old and new names followed to their ends, links in all bodies rewritten, and what leads nowhere counted before and after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kasane.functions import links as L
from kasane.operators import integrity
from kasane.plans.staging import release, sized, stage


def followed(renames: DataFrame) -> DataFrame:
    """(old, new, steps, status): where each name of ``renames`` (old, new) leads in the end, by pointer jumping.

    Each round replaces a name's successor by the successor's own, so chains of n renames take log2(n) rounds of one join over the names that
    are still open. A round in which none comes to its end leaves only names that run in a circle, or into one: they keep
    their name (steps 0, status cycle). Else status is renamed. Of several new names of one old name the smallest counts; null names and names that stay as they are
    are left out. Repeated rows count once; an empty table gives an empty result.
    """
    given = renames.where("old is not null and new is not null and old <> new").groupBy("old").agg(F.min("new").alias("new"))
    ends = stage(given.select("old", "new", F.lit(1).cast("long").alias("steps")), "renames")
    left = None
    while True:
        next_ = ends.select(F.col("old").alias("new"), F.col("new").alias("further"), F.col("steps").alias("more"))
        joined = ends.join(next_, "new", "left")
        open_ = joined.where("further is not null").count()
        if open_ == 0 or open_ == left:
            break
        moved = joined.select("old", F.coalesce("further", "new").alias("new"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"))
        before, ends, left = ends, stage(moved, "renames"), open_
        release(before)
    stuck = F.col("further").isNotNull()
    return joined.select("old", F.when(stuck, F.col("old")).otherwise(F.col("new")).alias("new"), F.when(stuck, 0).otherwise(F.col("steps")).alias("steps"), F.when(stuck, "cycle").otherwise("renamed").alias("status"))


def aliases(ends: DataFrame) -> DataFrame:
    """(name, aliases): the earlier names of each name that ``followed`` ends at, sorted; names in circles have none."""
    return ends.where("status = 'renamed'").groupBy(F.col("new").alias("name")).agg(F.sort_array(F.collect_set("old")).alias("aliases"))


def _moved(content: Column, new: Column) -> Column:
    """The content of a link with another path: heading, block and label stay, and the ending .md only where it stood."""
    rest = F.regexp_extract(content, r"(?s)^[^|#^]*(.*)$", 1)
    path = F.substring_index(F.substring_index(F.substring_index(content, "|", 1), "#", 1), "^", 1)
    return F.concat(F.when(F.trim(path).endswith(".md"), new).otherwise(F.regexp_replace(new, r"\.md$", "")), rest)


def relocated(files: DataFrame, ends: DataFrame) -> DataFrame:
    """``files`` (path, body, ...) under their new paths, with every link to a renamed file rewritten: (..., path, body, old_path, n_changed).

    A link is looked up as ``integrity.broken`` does: from the folder of its file, then from the root, with or without .md; a rewritten link
    names the path from the root. Only places that change are written anew. Links are light rows (path, place, content); they meet the names by a join, and bodies the changes by
    another, which is broadcast where the changes are few. A null body stays null; ``ends``: see ``followed``, of paths with .md.
    """
    names = sized(stage(ends.where("status = 'renamed'").select("old", "new"), "names")).withColumnsRenamed({"old": "__old", "new": "__new"})
    content = F.transform(L.contents(F.col("body")), lambda c: F.struct(c.alias("content"), L.target(c).alias("target")))
    places = files.select("path", F.posexplode(content).alias("at", "link")).where("link.target is not null")
    target = L.with_md(F.col("link.target"))
    tried = F.array(F.struct(F.lit(0).alias("rank"), F.concat(F.regexp_replace("path", "[^/]*$", ""), target).alias("key")), F.struct(F.lit(1).alias("rank"), target.alias("key")))
    each = places.select("path", "at", F.col("link.content").alias("content"), F.inline(tried))
    hits = each.join(names, each["key"] == names["__old"]).groupBy("path", "at").agg(F.min_by(_moved(F.col("content"), F.col("__new")), "rank").alias("content"))
    changes = hits.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("at", "content"))).alias("__changes"))
    rows = files.join(sized(stage(changes, "changes"), weight="size(__changes)"), "path", "left").join(names, files["path"] == names["__old"], "left")
    gaps = F.split("body", L.WHOLE, -1)
    written = F.transform(L.contents(F.col("body")), lambda c, i: F.concat(F.lit("[["), F.coalesce(F.try_element_at("__changes", i), c), F.lit("]]")))
    body = F.array_join(F.zip_with(gaps, written, lambda gap, link: F.concat(gap, F.coalesce(link, F.lit("")))), "")
    kept = [c for c in files.columns if c not in ("path", "body")]
    return rows.select(
        *kept, F.coalesce("__new", "path").alias("path"), F.when(F.col("__changes").isNull(), F.col("body")).otherwise(body).alias("body"), F.col("path").alias("old_path"),
        F.coalesce(F.size("__changes"), F.lit(0)).alias("n_changed"),
    )


def led_nowhere(files: DataFrame, top_folders: list[str]) -> DataFrame:
    """(n_links, n_broken): one row, over all bodies of ``files`` (path, body)."""
    links = integrity.links_by_line(files.select("path", F.col("body").alias("text")))
    broken = integrity.broken(links, files, top_folders)
    return links.agg(F.count("*").alias("n_links")).crossJoin(broken.agg(F.count("*").alias("n_broken")))


def verified(before: DataFrame, after: DataFrame, top_folders: list[str]) -> DataFrame:
    """(run, n_links, n_broken): before and after a run of ``relocated``; a run is sound if links are as many and no more lead nowhere."""
    parts = [led_nowhere(rows, top_folders).select(F.lit(name).alias("run"), "n_links", "n_broken") for name, rows in (("before", before), ("after", after))]
    return parts[0].union(parts[1])
