"""The second reading of references: absolute with paragraph and item, relative (前条, 次二条), and 同条.

The three patterns are read from each text in its own row, as arrays: 同条 looks at the references of its text, so nothing
is joined or shuffled before the references of a text are reduced to the first of each.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kasane.functions import arrays as A
from kasane.functions.numerals import kanji_number

_N = "[〇一二三四五六七八九十百千0-9０-９]+"
ABSOLUTE = f"第({_N}(?:の{_N})?)条(?:第({_N})項)?(?:第({_N})号)?"
RELATIVE = f"([前次])([二三四五六七八九十])?条(?:第({_N})項)?(?:第({_N})号)?"
SAME = f"同条(?:第({_N})項)?"
SNIPPET = 20


def _matches(text: Column, pattern: str, groups: int, signs: tuple[str, ...]) -> Column:
    """Structs (ord, raw, at, p1..pn) of the matches of ``pattern``; at: code points before the match. Null of a null text.

    No match is without one of ``signs``, so texts that hold none of them are not searched.
    """
    lists = [F.regexp_extract_all(text, F.lit(pattern), F.lit(i)).alias(f"p{i}") for i in range(groups + 1)]

    def each(x: Column) -> Column:
        parts = F.arrays_zip(A.ends(x["gaps"], x["p0"]).alias("end"), *(x[f"p{i}"].alias(f"p{i}") for i in range(groups + 1)))
        named = lambda m: (m[f"p{i}"].alias(f"p{i}") for i in range(1, groups + 1))
        return F.transform(parts, lambda m, i: F.struct(i.alias("ord"), m["p0"].alias("raw"), (m["end"] - F.length(m["p0"])).alias("at"), *named(m)))

    none = F.array().cast(f"array<struct<ord: int, raw: string, at: int, {', '.join(f'p{i}: string' for i in range(1, groups + 1))}>>")
    return F.when(~reduce(or_, map(text.contains, signs)), none).otherwise(A.let(F.struct(F.split(text, pattern, -1).alias("gaps"), *lists), each))


def _snippet(m: Column) -> Column:
    lo = F.greatest(F.lit(0), m["at"] - SNIPPET)
    return F.translate(F.substr("text", lo + 1, m["at"] + F.length(m["raw"]) + SNIPPET - lo), "\n", " ")


def _paragraph(part: Column) -> Column:
    return F.when(part != "", F.concat(F.lit("#第"), kanji_number(part).cast("string"), F.lit("項"))).otherwise("")


def _article(main: Column, sub: Column | None = None) -> Column:
    name = F.concat(F.lit("第"), main.cast("string"), F.lit("条"))
    return name if sub is None else F.concat(name, F.when(sub != "", F.concat(F.lit("の"), kanji_number(sub).cast("string"))).otherwise(""))


def _reference(m: Column, type_: str, list_: Column, step: Column, article_name: Column, anchor: Column) -> Column:
    """A reference; they are ordered by list, ord, step. first: where its words first stand in the text."""
    return F.struct(
        list_.alias("list"), m["ord"].alias("ord"), step.alias("step"), F.lit(type_).alias("type"), m["raw"].alias("raw"),
        (F.instr("text", m["raw"]) - 1).alias("first"), article_name.alias("article_name"), anchor.alias("anchor"), _snippet(m).alias("snippet"),
    )


def _absolute(m: Column) -> Column:
    """A branch is read only before 条 (第三の二条), as this reader always did."""
    branch = m["p1"].contains("の")
    main, sub = F.substring_index(m["p1"], "の", 1), F.when(branch, F.substring_index(m["p1"], "の", -1)).otherwise("")
    return _reference(m, "absolute", F.lit(0), F.lit(0), _article(kanji_number(main), sub), _paragraph(m["p2"]))


def _relative(m: Column) -> Column:
    """前条 and 次条, or N of them (前二条), each a reference of its own; numbers below 1 are dropped."""
    n = F.when(m["p2"] == "", F.lit(1)).otherwise(kanji_number(m["p2"])).cast("int")
    back = m["p1"] == "前"
    item = F.when((m["p3"] != "") & (m["p4"] != ""), F.concat(F.lit("第"), kanji_number(m["p4"]).cast("string"), F.lit("号"))).otherwise("")
    number = lambda i: F.col("article") + F.when(back, -i).otherwise(i)
    steps = F.filter(F.sequence(F.lit(1), n), lambda i: number(i) > 0)
    return F.transform(steps, lambda i: _reference(m, "relative", F.when(back, 1).otherwise(2), i, _article(number(i)), F.concat(_paragraph(m["p3"]), item)))


def _same(m: Column) -> Column:
    """同条: the last reference in list order (absolute, then back, then forward) whose words first occur before it; else UNRESOLVED.

    ``least``: from the end of that list, the smallest first place so far, so it falls, and the last reference is found by halving.
    """
    start = F.struct(F.lit(0).alias("lo"), F.size("least").alias("hi"))

    def half(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        before = F.coalesce(F.get("least", mid) < m["at"], F.lit(True))
        return F.struct(F.when(before, acc["lo"]).otherwise(mid + 1).alias("lo"), F.when(before, mid).otherwise(acc["hi"]).alias("hi"))

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size("least") + 1)).cast("int"))
    at = F.aggregate(rounds, start, half, lambda acc: acc["lo"])  # places from the end of the list
    name = F.get("earlier", F.size("earlier") - 1 - at)["article_name"]
    return _reference(m, "relative", F.lit(3), F.lit(0), F.coalesce(name, F.lit("UNRESOLVED")), F.when(name.isNull(), "").otherwise(_paragraph(m["p1"])))


def found(texts: DataFrame) -> DataFrame:
    """All references of ``texts`` (text_id, text, article: the current number), as rows. A null text has none."""
    text = F.col("text")
    rows = texts.select("text_id", "text", "article", _matches(text, ABSOLUTE, 3, ("第",)).alias("absolute"), _matches(text, RELATIVE, 4, ("前", "次")).alias("relative"), _matches(text, SAME, 1, ("同条",)).alias("same"))
    earlier = F.array_sort(F.concat(F.transform("absolute", _absolute), F.flatten(F.transform("relative", _relative))))
    rows = rows.select("text_id", "text", "same", earlier.alias("earlier"))
    rows = rows.withColumn("least", A.running(F.reverse(F.col("earlier")["first"]), F.least))
    # outer, for else all is worked out a second time to drop empty lists first
    return rows.select("text_id", F.inline_outer(F.concat("earlier", F.transform("same", _same)))).where("type is not null")


def references(texts: DataFrame, available: DataFrame) -> DataFrame:
    """(text_id, target_id, type, original, snippet, resolved): all references, the first of each (target, words) in list order.

    ``available``: article_name of the articles that exist, the current law's.
    """
    every = found(texts)
    first = every.groupBy("text_id", F.concat("article_name", "anchor").alias("target_id"), F.col("raw").alias("original")).agg(F.min_by(F.struct("type", "snippet", "article_name"), F.struct("list", "ord", "step")).alias("x"))
    flags = available.select("article_name", F.lit(True).alias("found")).distinct()
    rows = first.select("text_id", "target_id", "original", "x.type", "x.snippet", "x.article_name").join(flags, "article_name", "left")
    return rows.select("text_id", "target_id", "type", "original", "snippet", F.coalesce("found", F.lit(False)).alias("resolved"))
