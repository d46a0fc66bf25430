"""Repair of bodies: links taken out and logged, put back when their target exists, references applied, summaries kept, amendments collected."""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kasane.functions import arrays as A
from kasane.functions import links as L
from kasane.functions.automaton import Dictionary
from kasane.functions.names import pending_id

MARK = "%%PENDING:"
SUMMARY = "## AI要約"
#: Names that point back and so name no law.
BACKWARD = ("同法", "附則", "旧法", "新法")
NEAR = 50


def pending_kind(name: Column, amendment: Column) -> Column:
    """(kind, reason) of a link that leads nowhere, by the law's name found before it and the amendment its file belongs to."""
    back = name.isin(*BACKWARD)
    kind = F.when(name.isNotNull() & ~back, "external_law").otherwise("unknown")
    reason = F.when(name.isNotNull() & ~back, "detected_external_law_name_in_context").when(back, "same_law_token").otherwise("unclassified")
    return F.struct(kind.alias("kind"), reason.alias("reason"), F.when(kind == "unknown", amendment).alias("amendment_key"))


def marker(identifier: Column) -> Column:
    return F.concat(F.lit(MARK + '{"id": "'), identifier, F.lit('"}%%'))


def taken_out(bodies: DataFrame, unresolved: DataFrame, marked: bool = False) -> tuple[DataFrame, DataFrame]:
    """``bodies`` (path, law_name, body) with unresolved links to other laws as plain words, and the log of what was taken out.

    ``unresolved``: path, original (the whole link). Every place of such a link in its file is replaced; ``marked``
    leaves a marker with the pending id behind each. Links of one file are replaced in one pass over its body.
    """
    shown = L.without_links(F.col("original"))
    log = unresolved.select("path", "original", shown.alias("anchor_text")).join(bodies.select("path", "law_name"), "path")
    log = log.withColumn("id", pending_id(F.col("law_name"), F.col("path"), F.col("original"), F.col("anchor_text")))
    new = F.concat("anchor_text", marker(F.col("id"))) if marked else F.col("anchor_text")
    own = log.distinct().groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("original", new.alias("new")))).alias("__new"))
    found = F.regexp_extract_all("body", F.lit(L.WHOLE), F.lit(0))
    changed = F.array_join(F.zip_with(F.split("body", L.WHOLE, -1), F.transform(found, lambda x: F.coalesce(F.try_element_at("__new", x), x)), lambda gap, x: F.concat(gap, F.coalesce(x, F.lit("")))), "")
    rows = bodies.join(own, "path", "left")
    return rows.select(*[c for c in bodies.columns if c != "body"], F.when(F.col("__new").isNull(), F.col("body")).otherwise(changed).alias("body")), log


def put_back(bodies: DataFrame, entries: DataFrame) -> DataFrame:
    """``bodies`` (path, body) with one pending link each put back: (path, id, body, method).

    ``entries``: path, id, anchor_text, context_before, context_after, target. The place is that of the marker with the
    words before it, else the only place of the words, else the first whose surroundings hold the end of the text that
    stood before, or the beginning of what stood after; method is marker, context, or null where none is found and the body stays.
    """
    rows = entries.join(bodies, "path")
    link = F.concat(F.lit("[["), "target", F.lit("|"), "anchor_text", F.lit("]]"))
    mark = marker(F.col("id"))
    with_words = F.concat("anchor_text", mark)
    marked = F.col("body").contains(mark)
    by_mark = F.replace("body", F.when(F.col("body").contains(with_words), with_words).otherwise(mark), link)
    gaps = F.split("body", F.concat(F.lit("\\Q"), "anchor_text", F.lit("\\E")), -1)
    before, after = F.right("context_before", F.lit(NEAR)), F.left("context_after", F.lit(NEAR))
    words = F.array_repeat("anchor_text", F.greatest(F.size(gaps) - 1, F.lit(0)))
    rows = rows.withColumns({"__gaps": gaps, "__words": words})
    rows = rows.withColumns({"__before": A.texts_before(F.col("__gaps"), F.col("__words"), 2 * NEAR), "__after": A.texts_after(F.col("__gaps"), F.col("__words"), 2 * NEAR)})
    near = lambda x: F.coalesce(x.contains(before) & (before != ""), F.lit(False))
    behind = lambda x: F.coalesce(x.contains(after) & (after != ""), F.lit(False))
    fitting = F.array_position(F.zip_with("__before", "__after", lambda b, a: near(b) | behind(a)), True)
    place = F.when(F.size("__gaps") == 2, 1).when(F.size("__gaps") > 2, F.nullif(fitting.cast("int"), F.lit(0)))
    rows = rows.withColumn("__place", place)
    part = lambda lo, n: F.call_function("array_join", F.slice("__gaps", lo, n), F.col("anchor_text"))
    by_place = F.concat(part(F.lit(1), F.col("__place")), link, part(F.col("__place") + 1, F.size("__gaps")))
    method = F.when(F.col("target").isNull(), None).when(marked, "marker").when(F.col("__place").isNotNull(), "context")
    return rows.withColumn("method", method).select("path", "id", F.when(F.col("method") == "marker", by_mark).when(F.col("method") == "context", by_place).otherwise(F.col("body")).alias("body"), "method")


_CLOSED = re.compile(r"[^\[\n]*\]\]")
_REFERENCES = "array<struct<ord: int, target_id: string, original: string, resolved: boolean>>"


def applied(bodies: DataFrame, references: DataFrame) -> DataFrame:
    """``bodies`` (text_id, body) with each resolved reference as a link at its first place: (text_id, body, n_applied, n_references).

    ``references``: text_id, target_id, original, resolved, ord. They are applied in order; words that already stand in a link are left. A body is read
    once by an automaton over its references' words, so time grows with its length and their number. A null body stays null. Words with
    brackets or line ends, empty ones, and those of bodies with single brackets in their links are applied one after the other, which takes a reading each.
    """
    own = references.groupBy("text_id").agg(F.array_sort(F.collect_list(F.struct("ord", "target_id", "original", "resolved"))).cast(_REFERENCES).alias("__refs"), F.count("*").alias("n_references"))
    rows = bodies.select("text_id", "body").join(own, "text_id", "left")

    @F.pandas_udf("body string, n int")
    def put(texts: pd.Series, refs: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([linked(t, [] if r is None else list(r)) for t, r in zip(texts, refs, strict=True)], columns=["body", "n"])

    done = rows.withColumn("__done", put("body", "__refs"))
    return done.select("text_id", F.col("__done.body").alias("body"), F.col("__done.n").alias("n_applied"), F.coalesce("n_references", F.lit(0).cast("long")).alias("n_references"))


def linked(body: str | None, references: list[dict]) -> tuple[str | None, int]:
    """A body with its references as links, and how many there are."""
    good = [(r["original"], r["target_id"]) for r in references if r["resolved"] and r["original"] is not None and r["target_id"] not in (None, "UNRESOLVED")]
    if body is None or not good:
        return body, 0
    if any(not w or set(w + t) & set("[]\n") for w, t in good):
        return _one_by_one(body, good)
    words = Dictionary({w: w for w, _ in good})
    places: dict[str, list[int]] = {}
    for start, _, w in words.found(body):
        places.setdefault(w, []).append(start)
    spans = _open_links(body)
    if spans is None:
        return _one_by_one(body, good)
    within = {w for w, at in places.items() for s in at if any(lo <= s and s + len(w) <= hi for lo, hi in _around(spans, s))}
    cut: list[tuple[int, int, str]] = []  # what is replaced, in order
    for w, target in good:
        if w in within:
            continue
        at = next((s for s in _left(places.get(w, []), cut, len(w))), None)
        if at is not None:
            bisect.insort(cut, (at, at + len(w), f"[[{target}]]"))
            within |= {x for _, _, x in words.found(target)}
    out, done = [], 0
    for lo, hi, new in cut:
        out += [body[done:lo], new]
        done = hi
    return "".join([*out, body[done:]]), len(cut)


def _open_links(body: str) -> list[tuple[int, int]] | None:
    """(begin, end) of what stands in each link; None where single brackets stand in or behind one, so that a link put there opens or closes others."""
    out = []
    for m in re.finditer(r"\[\[([^\]\n]*)", body):
        inner = m.start(1) + m[1].rfind("[") + 1
        if _CLOSED.match(body, inner):
            if inner > m.start(1) or not body.startswith("]]", m.end()):
                return None
            out.append((inner, m.end()))
    return out


def _around(spans: list[tuple[int, int]], at: int) -> list[tuple[int, int]]:
    k = bisect.bisect_right(spans, (at, 1 << 62))
    return spans[max(0, k - 1) : k]


def _left(places: list[int], cut: list[tuple[int, int, str]], size: int) -> Iterator[int]:
    """The places that nothing replaced overlaps, in order."""
    for s in places:
        k = bisect.bisect_left(cut, (s + size,))
        if not k or cut[k - 1][1] <= s:
            yield s


def _one_by_one(body: str, references: list[tuple[str, str]]) -> tuple[str, int]:
    n = 0
    for w, target in references:
        at = body.find(w)
        if at >= 0 and not re.search(r"\[\[[^\]\n]*" + re.escape(w) + r"[^\[\n]*\]\]", body):
            body, n = f"{body[:at]}[[{target}]]{body[at + len(w):]}", n + 1
    return body, n


def summarised(body: Column, summary: Column) -> Column:
    """A body with its summary section: an old one, up to the next heading, is replaced, else it is added at the end."""
    section = F.concat(F.lit(SUMMARY + "\n"), summary)
    old = rf"(?s){SUMMARY}\s*.*?(?=\n##|\z)"
    safe = F.regexp_replace(section, r"([\\$])", r"\\$1")
    return F.when(body.contains(SUMMARY), F.regexp_replace(body, F.lit(old), safe)).otherwise(F.concat(F.regexp_replace(body, r"(?U)\s+\z", ""), F.lit("\n\n"), section, F.lit("\n")))


def summary_progress(articles: DataFrame, *by: str) -> DataFrame:
    """(…, done, total, percent) of summarised articles."""
    done = F.count_if(F.col("body").contains(SUMMARY))
    return articles.groupBy(*by).agg(done.alias("done"), F.count("*").alias("total"), (F.floor(done * 100 / F.count("*"))).alias("percent"))


def amendment_books(fragments: DataFrame) -> DataFrame:
    """(amendment_key, laws, n, node_ids): the fragments of each amending law over all laws it changed. An extension: it was only designed before."""
    return fragments.where("amendment_key is not null").groupBy("amendment_key").agg(F.sort_array(F.collect_set("law_name")).alias("laws"), F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("law_name", "node_id"))).getField("node_id").alias("node_ids"))
