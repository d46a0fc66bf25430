"""Names of articles, chapters and sections, and what can be read from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def article_name(number: Column) -> Column:
    """1 → 第1条, 1_2 → 第1条の2, 1_2_3 → 第1の2の3条."""
    parts = F.split(number, "_")
    return (
        F.when(F.size(parts) == 1, F.concat(F.lit("第"), number, F.lit("条")))
        .when(F.size(parts) == 2, F.concat(F.lit("第"), parts[0], F.lit("条の"), parts[1]))
        .otherwise(F.concat(F.lit("第"), F.regexp_replace(number, "_", "の"), F.lit("条")))
    )


def localized_article(identifier: Column, supplement: Column | None = None) -> Column:
    """Article_3_2 or 3_2 → 第3条の2, 73:76 → 第73条から第76条まで; 附則 stands before where ``supplement`` holds."""
    stem = F.regexp_replace(F.regexp_replace(identifier, r"\.md", ""), "Article_", "")
    name = (
        F.when(stem.contains(":"), F.concat(F.lit("第"), F.substring_index(stem, ":", 1), F.lit("条から第"), F.regexp_replace(stem, "^[^:]*:", ""), F.lit("条まで")))
        .when(stem.contains("_"), F.concat(F.lit("第"), F.substring_index(stem, "_", 1), F.lit("条の"), F.regexp_replace(stem, "^[^_]*_", "")))
        .otherwise(F.concat(F.lit("第"), stem, F.lit("条")))
    )
    return name if supplement is None else F.concat(F.when(supplement, "附則").otherwise(""), name)


_ARTICLE = r"^(?:附則)?第([0-9]+)条(?:の([0-9]+))?$"


def article_numbers(name: Column) -> Column:
    """第3条の2 or 附則第3条の2 as (main, sub); null for other names, sub null without a branch."""
    main = F.regexp_extract(name, _ARTICLE, 1).try_cast("int")
    return F.when(main.isNotNull(), F.struct(main.alias("main"), F.regexp_extract(name, _ARTICLE, 2).try_cast("int").alias("sub")))


def _file_stem(target: Column) -> Column:
    return F.substring_index(F.regexp_replace(F.substring_index(target, "/", -1), r"\.md", ""), "#", 1)


def main_article(target: Column) -> Column:
    """Main article number of a link or path; a branch counts with its main number."""
    return article_numbers(_file_stem(target))["main"]


def plain_article(target: Column) -> Column:
    """Article number of a link or path to an article of the main part without a branch; else null."""
    return F.regexp_extract(_file_stem(target), r"^第([0-9]+)条$", 1).try_cast("int")


def sort_key(name: Column) -> Column:
    """(main, sub, name) to order articles by; names that are not articles come last."""
    n = article_numbers(F.regexp_replace(name, r"\.md", ""))
    return F.struct(F.coalesce(n["main"], F.lit(99999)).alias("main"), F.coalesce(n["sub"], F.lit(0)).alias("sub"), name.alias("name"))


def contents_key(name: Column) -> Column:
    """(main, sub, end of range) of a file name in a table of contents; zeros for other names."""
    p = r"第([0-9]+)(?:条の([0-9]+)|(?::|条から第)([0-9]+))?条?"
    part = [F.coalesce(F.regexp_extract(name, p, i).try_cast("int"), F.lit(0)) for i in (1, 2, 3)]
    return F.struct(part[0].alias("main"), part[1].alias("sub"), part[2].alias("range_end"))


def _branched(number: Column, sign: str) -> Column:
    return F.concat(F.lit("第"), F.floor(number / 10).cast("string"), F.lit(f"{sign}の"), (number % 10).cast("string"))


def _numbered(number: Column, sign: str) -> Column:
    return F.concat(F.lit("第"), number.cast("string"), F.lit(sign))


def chapter_name(number: Column, title: Column) -> Column:
    """第N章, or 第Nの章のM where the title says so or the number has three digits and does not end in 0."""
    branch = F.coalesce(title.contains("章の"), F.lit(False)) | ((number >= 100) & (number % 10 != 0))
    return F.when(branch, _branched(number, "章")).otherwise(_numbered(number, "章"))


def section_name(number: Column, title: Column) -> Column:
    """第N節, or 第N節のM where the title says so."""
    return F.when(F.coalesce(title.contains("節の"), F.lit(False)), _branched(number, "節")).otherwise(_numbered(number, "節"))


def migrated_chapter_name(number: Column, title: Column) -> Column:
    """As migrations name chapters: three digits always branch, a title only where the branch is not 0; null is empty."""
    by_title = F.coalesce(title.contains("章の"), F.lit(False)) & (number % 10 > 0)
    return F.when(number.isNull(), "").when((number >= 100) | by_title, _branched(number, "章")).otherwise(_numbered(number, "章"))


def migrated_section_name(number: Column, title: Column) -> Column:
    by_title = F.coalesce(title.contains("節の"), F.lit(False)) & (number % 10 > 0)
    return F.when(number.isNull(), "").when(by_title, _branched(number, "節")).otherwise(_numbered(number, "節"))


def variants(law: Column) -> Column:
    """The five ways a law's name is written."""
    return F.array(law, *(F.concat(F.lit(x), law) for x in ("新", "旧", "改正前の", "改正後の")))


def safe_file_name(name: Column) -> Column:
    """A name that file systems take: reserved characters become underscores; blanks, then dots, are cut from the ends."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(name, r'[\\/*?:"<>|]', "_"), r"(?U)^\s+|\s+$", ""), r"^\.+|\.+$", "")


def pending_id(law: Column, path: Column, link: Column, anchor: Column) -> Column:
    """Identifier of a pending link, the same whenever it is logged again."""
    return F.substring(F.sha1(F.concat_ws("|", law, path, link, anchor)), 1, 16)


def initial_display(name: Column) -> Column:
    """Display name of a file of an initial supplement: init_0_第10条の2.md → 第10条の2; without an article what follows the first underscore."""
    stem = F.regexp_replace(name, r"\.md", "")
    article = F.regexp_extract(stem, "第[0-9]+条(?:の[0-9]+)?", 0)
    return F.when(article != "", article).when(stem.contains("_"), F.regexp_replace(stem, "^[^_]*_", "")).otherwise(stem)


def localized_number(number: Column, supplement: Column) -> Column:
    """article_num in Japanese; numbers that already are stay, Provision is 附則, 附則 stands before articles of supplements."""
    mark = F.when(supplement, "附則").otherwise("")
    start, end = F.substring_index(number, ":", 1), F.substring_index(number, ":", -1)
    return (
        F.when(number.rlike("^(第|附則)") | (number == ""), number)
        .when(number == "Provision", "附則")
        .when(number.contains(":"), F.concat(mark, F.lit("第"), start, F.lit("条から"), mark, F.lit("第"), end, F.lit("条まで")))
        .when(number.contains("_"), F.concat(mark, F.lit("第"), F.substring_index(number, "_", 1), F.lit("条の"), F.regexp_replace(number, "^[^_]*_", "")))
        .otherwise(F.concat(mark, F.lit("第"), number, F.lit("条")))
    )


def localized_id(identifier: Column) -> Column:
    """JPLAW:X#main#3_2 → JPLAW:X#本文#第3条の2; identifiers that already are Japanese stay."""
    number, supplement = F.substring_index(identifier, "#", -1), identifier.contains("#suppl#")
    head = F.regexp_replace(F.regexp_replace(F.regexp_replace(identifier, "[^#]*$", ""), "#main#", "#本文#"), "#suppl#", "#附則#")
    return F.when(identifier.rlike("#(main|suppl)#"), F.concat(head, localized_number(number, supplement))).otherwise(identifier)


def law_of_path(path: Column) -> Column:
    """The folder after laws in a path; null without one."""
    parts = F.split(path, "/")
    at = F.array_position(parts, F.lit("laws"))
    return F.when(at > 0, F.try_element_at(parts, (at + 1).cast("int")))


def node_kind(path: Column, amended: Column) -> Column:
    """law, article, supplement or amendment_fragment by a file's path; ``amended``: whether its metadata names an amending law. Else null."""
    law = law_of_path(path)
    within = lambda name: F.array_contains(F.split(path, "/"), name)
    own = path.endswith(F.concat(F.lit("laws/"), law, F.lit("/"), law, F.lit(".md")))
    return F.when(own, "law").when(law.isNotNull() & within("本文"), "article").when(law.isNotNull() & within("附則"), F.when(F.coalesce(amended, F.lit(False)) | within("改正法"), "amendment_fragment").otherwise("supplement"))
