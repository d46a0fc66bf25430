"""Link integrity: links against files, ranges, stubs, and the log of pending links."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kasane.functions import dictionaries as D
from kasane.functions import links as L
from kasane.functions.automaton import contains_any

#: Width of the number buckets of the range join.
BUCKET = 64


def links_by_line(files: DataFrame) -> DataFrame:
    """(path, line_no, content, target): every wikilink of ``files`` (path, text) that names a path; lines count from 1."""
    lines = files.select("path", F.posexplode(F.split("text", "\n", -1)).alias("n", "line"))
    each = lines.select("path", (F.col("n") + 1).alias("line_no"), F.explode(L.contents(F.col("line"))).alias("content"))
    return each.withColumn("target", L.target(F.col("content"))).where("target is not null")


def broken(links: DataFrame, files: DataFrame, top_folders: list[str]) -> DataFrame:
    """The links that lead to no file, with ``shown`` (the path for a report).

    A target that begins with a top folder is a path from the root and nothing else; any other is tried from the
    folder of its source, then from the root. ``links``: path, target, ...; ``files``: path.
    """
    t = L.with_md(F.col("target"))
    rooted = F.substring_index("target", "/", 1).isin(top_folders)
    folder = F.regexp_replace("path", "[^/]*$", "")
    near = F.concat(folder, t)
    tried = F.when(rooted, F.array(t)).otherwise(F.array(near, t))
    known = files.select(F.col("path").alias("__file")).distinct()
    keyed = links.withColumns({"shown": F.when(rooted, t).otherwise(near), "__tried": tried})
    for i in (0, 1):  # a link that leads to no file fails at every path that is tried, so no row needs a name
        keyed = keyed.join(known, F.get("__tried", F.lit(i)) == known["__file"], "left_anti")
    return keyed.drop("__tried")


def visible(files: DataFrame, prefix: str | None = None) -> DataFrame:
    """``files`` (path, ...) without those in hidden folders or with hidden names; under ``prefix`` only, if any file is there, else all."""
    shown = files.where(~F.exists(F.split("path", "/"), lambda part: part.startswith(".")))
    inside = shown.where(F.col("path").startswith(f"{(prefix or '').rstrip('/')}/"))
    return shown if not prefix or inside.isEmpty() else inside


def not_ignored(links: DataFrame, patterns: DataFrame) -> DataFrame:
    """Links whose ``shown`` contains none of the ``patterns`` (pattern); null and empty ones count for nothing.

    The patterns are gathered when the plan is made and go to every task as automata, which read a path once however many they are.
    """
    words = [r[0] for r in patterns.select(F.col("pattern").cast("string")).distinct().toLocalIterator()]
    return links.where(~contains_any(links.sparkSession, F.col("shown"), [w for w in words if w]))


def report(links: DataFrame, limit: int = 100, samples: int = 5) -> DataFrame:
    """(shown, n, sources): the most frequent broken targets with up to ``samples`` sources, ties by target."""
    top = links.groupBy("shown").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "shown").limit(limit)
    places = links.join(F.broadcast(top.select("shown")), "shown", "left_semi").select("shown", F.concat_ws(":", "path", "line_no").alias("source")).distinct()
    ranked = places.withColumn("k", F.row_number().over(Window.partitionBy("shown").orderBy("source"))).where(F.col("k") <= samples)
    sources = ranked.groupBy("shown").agg(F.array_sort(F.collect_list("source")).alias("sources"))
    return top.join(F.broadcast(sources), "shown").select("shown", "n", "sources").orderBy(F.desc("n"), "shown")


def report_markdown(links: DataFrame, limit: int = 100, samples: int = 5) -> DataFrame:
    """(text): one row, the report of broken ``links`` (path, line_no, shown) as Markdown; of the targets the ``limit`` most frequent, as ``report`` orders them."""
    totals = links.agg(F.count("*").alias("n_links"), F.count_distinct("shown").alias("n_targets"))
    # The words of the report.
    source = lambda x: F.concat(F.lit("  - `"), F.regexp_replace(x, r":[^:]*$", ""), F.lit("` (L"), F.substring_index(x, ":", -1), F.lit(")\n"))
    more = F.when(F.col("n") > samples, F.concat(F.lit("  - ... 他 "), F.col("n") - samples, F.lit(" 件\n"))).otherwise("")
    section = F.concat(F.lit("### `"), "shown", F.lit("`\n\n- 参照数: "), "n", F.lit(f"\n- 参照元（最大{samples}件）:\n"), F.array_join(F.transform("sources", source), ""), more, F.lit("\n"))
    top = report(links, limit, samples).select((-F.col("n")).alias("rank"), "shown", section.alias("section"))
    parts = top.agg(F.array_join(F.array_sort(F.collect_list(F.struct("rank", "shown", "section"))).getField("section"), "").alias("sections"))
    head = F.concat(F.lit("# WikiLink整合性チェックレポート\n\n## サマリー\n\n- **空リンク総数**: "), "n_links", F.lit("\n- **ユニークなターゲット数**: "), "n_targets", F.lit("\n\n"))
    rest = F.when(F.col("n_targets") > limit, F.concat(F.lit("\n... 他 "), F.col("n_targets") - limit, F.lit(" ターゲット省略\n"))).otherwise("")
    full = F.concat(F.lit(f"## 空リンク一覧（ターゲット別）\n\n※ 上位{limit}件を表示\n\n"), "sections", rest)
    return totals.crossJoin(parts).select(F.concat(head, F.when(F.col("n_links") == 0, "空リンクはありません。\n").otherwise(full)).alias("text"))


def article_ranges(files: DataFrame) -> DataFrame:
    """(law_name, start, end, name): files of a range of articles, 第1条から第3条まで.md before the older 第1:3条.md."""
    new, old = r"^第([0-9]+)条から第([0-9]+)条まで\.md$", r"^第([0-9]+):([0-9]+)条\.md$"
    part = lambda i: F.coalesce(F.regexp_extract("name", new, i).try_cast("int"), F.regexp_extract("name", old, i).try_cast("int"))
    rows = files.select("law_name", part(1).alias("start"), part(2).alias("end"), "name").where("start is not null")
    return rows.groupBy("law_name", "start", "end").agg(F.max_by("name", F.col("name").rlike(new)).alias("name"))


def redirect_sources(files: DataFrame) -> DataFrame:
    """``files`` (law_name, name, suppl_kind, ...) whose links may lead to ranges: not the law's own file, not a range, not an amendment."""
    stem = F.regexp_replace("name", r"\.md$", "")
    return files.where((stem != F.col("law_name")) & ~stem.contains(":") & ~F.col("suppl_kind").eqNullSafe("amendment"))


def redirected(links: DataFrame, ranges: DataFrame) -> DataFrame:
    """``links`` (link_id, law_name, num) with the range that holds the number: the shortest, then the latest start; links in no range are left out.

    Ranges are laid into buckets of numbers, so the join is on (law, bucket) and grows with the hits alone; the best
    range of a link is an aggregate, which combines before the shuffle.
    """
    laid = ranges.withColumn("bucket", F.explode(F.expr(f"sequence(start div {BUCKET}, greatest(end, start) div {BUCKET})")))
    keyed = links.withColumn("bucket", F.expr(f"num div {BUCKET}"))
    hits = keyed.join(laid, ["law_name", "bucket"]).where("num between start and end")
    best = F.min_by(F.struct("start", "end", "name"), F.struct((F.col("end") - F.col("start")).alias("span"), (-F.col("start")).alias("late"), "name")).alias("best")
    return hits.groupBy("link_id", "law_name", "num").agg(best).select("link_id", "law_name", "num", "best.start", "best.end", "best.name")


def stubs(unresolved: DataFrame, ranges: DataFrame) -> DataFrame:
    """(law_name, num, referenced_by, n): articles that links of the main part name but no file or range holds, with their sources in order.

    ``unresolved``: link_id, law_name, num, source, from_main.
    """
    rows = unresolved.where("from_main and num is not null")
    covered = redirected(rows.select("link_id", "law_name", "num"), ranges).select("link_id").distinct()
    rest = rows.join(covered, "link_id", "left_anti")
    return rest.groupBy("law_name", "num").agg(F.array_sort(F.collect_set("source")).alias("referenced_by"), F.count("*").alias("n"))


def unresolved_reason(context: Column) -> Column:
    """external_law where another law's name stands in the 200 characters before a link, else missing_article."""
    names, near = D.longest_first(D.OTHER_LAWS), F.right(context, F.lit(200))
    last = reduce(or_, (near.contains(c) for c in sorted({n[-1] for n in names})))  # no name without one of these, and far cheaper to look for
    return F.when(last & near.rlike("|".join(names)), "external_law").otherwise("missing_article")


def pending_of(pending: DataFrame, law: str | None = None, kind: str | None = None) -> DataFrame:
    """Pending links of one law and of one kind, where they are given."""
    rows = pending if law is None else pending.where(F.col("src_law_name") == law)
    return rows if kind is None else rows.where(F.col("kind") == kind)


def pending_open(log: DataFrame, resolved: DataFrame) -> DataFrame:
    """The first entry of each pending id, without those that ``resolved`` (id) names."""
    first = log.groupBy("id").agg(F.min_by(F.struct(*[c for c in log.columns if c != "id"]), "ts").alias("x")).select("id", "x.*")
    return first.join(resolved.select("id"), "id", "left_anti")


def pending_target(pending: DataFrame, files: DataFrame, laws: DataFrame) -> DataFrame:
    """``pending`` (id, kind, src_law_name, article, external_law_name, amendment_key) with ``target``: the first candidate path that exists, else null.

    Another law is found by its exact name, then by names that contain it (``laws``: law_name, the catalogue).
    """
    file = F.concat(F.lit("第"), F.col("article").cast("string"), F.lit("条.md"))
    own = F.concat(F.lit("laws/"), "src_law_name", F.lit("/附則/改正法/"), "amendment_key", F.lit("/"))
    amended = F.filter(F.array(F.concat(own, F.lit("本文/"), file), F.concat(own, F.lit("附則"), file), F.concat(own, file)), lambda p: p.isNotNull())
    external = F.when(F.col("kind") == "external_law", F.array(F.concat(F.lit("laws/"), "external_law_name", F.lit("/本文/"), file)))
    ordered = pending.select("id", "kind", "external_law_name", file.alias("file"), F.posexplode_outer(F.coalesce(external, amended)).alias("ord", "path"))
    names = laws.select("law_name").distinct()
    asked = pending.where("kind = 'external_law' and external_law_name is not null").select("external_law_name").distinct()
    # names meet by the pairs of characters that they hold, so that the containment is tested within an equi join
    pairs = lambda name: F.expr(f"array_distinct(transform(sequence(1, greatest(1, length({name}) - 1)), i -> substring({name}, i, 2)))")
    grams = names.select("law_name", F.explode(F.when(F.length("law_name") > 1, F.concat(pairs("law_name"), F.split("law_name", ""))).otherwise(F.array("law_name"))).alias("gram"))
    wider = asked.withColumn("gram", F.substring("external_law_name", 1, 2)).join(grams.distinct(), "gram")
    wider = wider.where(F.col("law_name").contains(F.col("external_law_name")) & (F.col("law_name") != F.col("external_law_name"))).select("external_law_name", "law_name")
    more = pending.where("kind = 'external_law'").select("id", "external_law_name", file.alias("file")).join(wider, "external_law_name")
    more = more.select("id", F.lit(1).alias("ord"), F.concat(F.lit("laws/"), "law_name", F.lit("/本文/"), "file").alias("path"))
    tried = ordered.select("id", "ord", "path").union(more)
    hits = tried.join(files.select("path").distinct(), "path").groupBy("id").agg(F.min_by("path", F.struct("ord", "path")).alias("target"))
    return pending.join(hits, "id", "left")


def legacy_names(paths: DataFrame) -> DataFrame:
    """(path, category) of paths that still carry an initial supplement's old name: folders, files, files with the prefix in the middle."""
    stem = F.substring_index("path", "/", -1)
    kind = F.when(F.col("path").rlike(r"(^|/)init_[0-9]+/"), "folder").when(stem.rlike(r"^init_[0-9]+\.md$"), "file").when(stem.rlike(r"init_[0-9]+_"), "prefixed_file")
    return paths.select("path", kind.alias("category")).where("category is not null")


def canonical_id(law_name: Column, article: Column, amendment: Column) -> Column:
    """The identifier that tells articles of amendments apart."""
    return F.concat_ws("_", law_name, F.concat(F.lit("附則"), article), amendment)

