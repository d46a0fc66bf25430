"""Wikilinks and Markdown text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The forms of wikilinks.
DISPLAY = r"\[\[(?:[^\]|]+\|)?([^\]]+)\]\]"
WHOLE = r"\[\[([^\]]+)\]\]"


def without_links(text: Column) -> Column:
    """[[path|label]] and [[label]] as label."""
    return F.regexp_replace(text, DISPLAY, "$1")


def contents(text: Column) -> Column:
    """What stands inside each wikilink, in order."""
    return F.regexp_extract_all(text, F.lit(WHOLE), F.lit(1))


def target(content: Column) -> Column:
    """The path a link's content names: label, heading and block are cut off. Null for web and mail links and for blank paths."""
    path = F.trim(F.substring_index(F.substring_index(F.substring_index(content, "|", 1), "#", 1), "^", 1))
    return F.when(~content.rlike("^(https?://|mailto:)") & (path != ""), path)


def with_md(path: Column) -> Column:
    return F.when(path.endswith(".md"), path).otherwise(F.concat(path, F.lit(".md")))


def link(path: Column, label: Column) -> Column:
    return F.concat(F.lit("[["), path, F.lit("|"), label, F.lit("]]"))


def trimmed_lines(body: Column) -> Column:
    """A body with no blanks at line ends and one line feed at its end."""
    return F.concat(F.regexp_replace(F.regexp_replace(body, r"(?mU)[\s&&[^\n]]+$", ""), r"(?U)\s+$", ""), F.lit("\n"))


def without_empty_headings(body: Column) -> Column:
    return F.regexp_replace(body, r"(?m)^##[^\S\n]*\n", "")


def repaired_front(text: Column) -> Column:
    """A key glued to the opening dashes moves to a line of its own."""
    return F.regexp_replace(text, r"^-{3,}([A-Za-z_]\w*):", "---\n$1:")


def front_matter(text: Column) -> Column:
    """(raw_yaml, body) of a document that begins with ---; the first two --- anywhere are the borders. Without them raw_yaml is null."""
    parts = F.split(text, "---", 3)
    whole = text.startswith("---") & (F.size(parts) >= 3)
    return F.struct(F.when(whole, parts[1]).alias("raw_yaml"), F.when(whole, F.regexp_replace(parts[2], r"(?U)^\s+|\s+$", "")).otherwise(text).alias("body"))


def simple_fields(raw_yaml: Column) -> Column:
    """Top-level ``key: value`` lines of a block as a map of strings; nested lines are left out, of repeated keys the last counts."""
    lines = F.filter(F.split(F.coalesce(raw_yaml, F.lit("")), "\n"), lambda x: x.rlike(r"^[A-Za-z_]\w*:"))
    pairs = F.transform(lines, lambda x: F.struct(F.substring_index(x, ":", 1).alias("key"), F.regexp_replace(F.trim(F.regexp_replace(x, r"^[^:]*:", "")), "^(['\"])(.*)\\1$", "$2").alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def missing_fields(fields: Column, required: list[str]) -> Column:
    return F.filter(F.array(*map(F.lit, required)), lambda k: F.try_element_at(fields, k).isNull())
