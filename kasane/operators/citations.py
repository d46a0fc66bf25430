"""Citations in statutory text: 第N条 and 第N条のM, resolved to the law they mean.

A text is read once, in an Arrow step: an automaton over the law names and the words that end a scope notes what stands last before each
citation. What it notes is a small struct a citation, an array a text; column expressions over these arrays decide where each citation leads, edges
are a filter over the decisions, and the rewritten text is the gaps between citations zipped with their links. No text is joined or shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kasane.functions import dictionaries as D
from kasane.functions.automaton import Dictionary
from kasane.functions.links import DISPLAY
from kasane.functions.numerals import kanji_number

_NUMBER = "[0-9一二三四五六七八九十百千]+"
CITATION = f"第({_NUMBER})条(?:の({_NUMBER}))?"
NEAR, FAR = 100, 300
#: Openings of texts (up to ``NEAR`` characters) remembered in a task.
HEADS = 10_000
CONFIDENCE, SOURCE = 0.9, "regex_v2"

_CITED, _SHOWN, _BRACKETS, _QUOTES = re.compile(CITATION), re.compile(DISPLAY), re.compile("（[^）]*）"), re.compile("「[^」]*」")
_BORDER = re.compile("。|\n{2,}")
_SELF = "|".join(D.longest_first(D.SELF_NAMES))
_LISTED = re.compile(rf"(?:{_SELF})第[一-龯〇-九0-9]+条(?:の[一-龯〇-九0-9]+)?[、，,]\s*$")
_NUMBERED = re.compile(r"([^\s。、「（）]{1,30}法)（([^）]{5,40}号)）$")
_BREAK = re.compile(f"^.*(?:{'|'.join(D.NAME_BREAKS)})")
_JOINTS = ("", "の", "、", "\n")


class Seen(NamedTuple):
    """What stands last in a sentence so far; places count from its beginning."""

    tail: str = ""
    length: int = 0
    #: (start, folder) of the last law name before 第 that may open a scope, and the place of the 第.
    scope: tuple[int, str, int] | None = None
    #: The place of the 第 behind the last name of another law.
    other: int = -1
    #: Start of the last word that ends a scope.
    reset: int = -1
    #: End of the last own name with its 第.
    own: int = -1


class Laws(NamedTuple):
    """The dictionaries of a run: names that always link, with their folders, names of other laws, and the laws that the corpus holds."""

    linked: Dictionary
    others: Dictionary
    words: Dictionary
    held: frozenset[str]
    longest: int


def laws(held: frozenset[str], linked: dict[str, str] = D.LINKED_LAWS, others: frozenset[str] = frozenset(D.OTHER_LAWS), resets: frozenset[str] = frozenset(D.RESETS)) -> Laws:
    """``linked``: name and folder; ``others``: names of other laws; ``resets``: words that end a scope. All may hold any number of words, and share some."""
    words = {w: (linked.get(w), w if w in others else None, w in resets) for w in {*linked, *others, *resets}}
    return Laws(Dictionary(linked), Dictionary(dict.fromkeys(others)), Dictionary(words), held, max(map(len, words)) + 2)


def variants(law: str | None) -> tuple[str, ...]:
    """The five ways a law's name is written."""
    return tuple(x + law for x in ("", "新", "旧", "改正前の", "改正後の")) if law else ()


@lru_cache(1000)
def _own(law: str | None) -> re.Pattern | None:
    return re.compile(f"(?:{'|'.join(map(re.escape, variants(law)))})[の、\n]?第") if law else None


def _further(seen: Seen, piece: str, law: str | None, fragment: bool, known: Laws) -> Seen:
    """The sentence read on by ``piece``. Only as much of it as a name can be long is kept."""
    if not piece:
        return seen
    text, old = seen.tail + piece, len(seen.tail)
    base, scope, other, reset, own = seen.length - old, seen.scope, seen.other, seen.reset, seen.own
    for start, end, (folder, name, resets) in known.words.found(text):
        if resets and end > old:
            reset = max(reset, base + start)
        if (folder or name) and old <= end < len(text) and text[end] == "第":
            other = base + end if name else other
            opened = [f for f in (folder, name if name in known.held else None) if f and law and f != law]
            if opened and (scope is None or base + start >= scope[0]):
                scope = (base + start, max(opened), base + end)
    if fragment and law:
        keep = max(known.longest, len(law) + 8)
        for m in _own(law).finditer(text):
            own = max(own, base + m.end()) if m.end() > old else own
    else:
        keep = known.longest
    return Seen(text[-keep:], seen.length + len(piece), scope, other, reset, own)


def _sentence(text: str, places: list[int], law: str | None, fragment: bool, known: Laws) -> Iterator[Seen]:
    """What is seen at each of ``places`` in a sentence, in order. Links are read as their labels; brackets closed before a place are passed over."""
    shown, at, cites = [], 0, []  # the sentence with labels for links; each place as (place there, what of an open link stands before it)
    where = size = 0
    for m in [*_SHOWN.finditer(text), None]:
        lo, hi = m.span() if m else (len(text), len(text))
        while where < len(places) and places[where] < hi or m is None and where < len(places):
            p = places[where]
            cites.append((size + min(p, lo) - at, text[lo:p] if p > lo else ""))
            where += 1
        shown.append(text[at:lo])
        size += lo - at
        if m:
            shown.append(m[1])
            size += len(m[1])
        at = hi
    whole = "".join(shown)
    closed = [m.span() for m in _BRACKETS.finditer(whole)]
    open_at = whole.find("（", closed[-1][1] if closed else 0)
    seen, done, k, before, inner = Seen(), 0, 0, None, None

    def read(to: int) -> None:
        nonlocal seen, done, k, before
        pieces = []
        while k < len(closed) and closed[k][1] <= to:
            pieces.append(whole[done : closed[k][0]])
            done, k = closed[k][1], k + 1
        if done <= open_at < to:
            before = _further(seen, "".join([*pieces, whole[done:open_at]]), law, fragment, known)
            seen, pieces, done = before, [], open_at
        pieces.append(whole[done:to])
        seen, done = _further(seen, "".join(pieces), law, fragment, known), to

    for p, extra in cites:
        while k < len(closed) and closed[k][1] <= p:
            read(closed[k][1])
        lo = closed[k][0] if k < len(closed) and closed[k][0] < p else None
        if lo is None:
            read(p)
            now, outside = seen, before if 0 <= open_at < p else None
        else:
            if done < lo:
                read(lo)
            if inner is None or inner[0] != lo:
                inner = (lo, lo, seen)
            inner = (lo, p, _further(inner[2], whole[inner[1] : p], law, fragment, known))
            now, outside = inner[2], seen
        if extra and outside is not None and "）" in extra:
            now, extra = outside, extra[extra.index("）") + 1 :]
        yield _further(now, _BRACKETS.sub("", extra), law, fragment, known) if extra else now


def _at_end(context: str, names: Dictionary, edge: bool = True) -> str | None:
    """Of ``names`` the first to begin that stands at the end of a context, save one of の、 or a line end: its value."""
    if not ("法" in context[-2:] or "律" in context[-2:]):
        return None
    ends = [len(context)] + ([len(context) - 1] if context[-1:] in tuple("の、\n\r\x85\u2028\u2029") else [])
    found = [(start, -size, value) for size in ends for start, value in names.at_end(context, size) if not edge or not start or context[start - 1] in D.BEFORE_NAME]
    return min(found, key=lambda x: x[:2], default=None)


def _number_before(near: str) -> str | None:
    """The law's name where the text before ends with 名法（…号）; conjunctions before the name are cut off."""
    m = _NUMBERED.search(near) if "）" in near[-2:] else None
    name = _BREAK.sub("", m[1]) if m else ""
    return name if len(name) >= 2 else None


def _names_other(far: str, known: Laws) -> bool:
    """Whether another law is named before, in a sentence that still goes on (full stops in brackets and quotations do not end it)."""
    last = {far[s:e]: s for s, e, _ in known.others.found(far)}
    return any("。" not in far[s:] or "。" not in _QUOTES.sub("", _BRACKETS.sub("", far[s:])) for s in last.values())


_NOTE = pa.struct(
    [("raw", pa.string()), ("main", pa.string()), ("sub", pa.string()), ("numbered", pa.string()), ("numbered_held", pa.bool_()), ("own_word", pa.bool_()), ("linked_end", pa.string()),
     ("other_end", pa.string()), ("other_end_held", pa.bool_()), ("last", pa.string()), ("scope", pa.string()), ("other_scope", pa.bool_()), ("in_parent", pa.bool_()), ("other_near", pa.bool_()), ("bare", pa.bool_())]
)
_NOTE_SQL = ", ".join(f"{f.name}: {'boolean' if pa.types.is_boolean(f.type) else 'string'}" for f in _NOTE)


def _about(far: str, tail: Seen, law: str | None, fragment: bool, known: Laws) -> dict:
    """What the rules ask of the text before one citation: of ``far``, the last characters, and of its sentence so far."""
    s, near = tail, far[-NEAR:]
    context = _BRACKETS.sub("", near) if "（" in near else near
    bare = context.rstrip()
    own_word = bare.endswith(tuple(D.SELF_NAMES))
    listed = bare.endswith(("、", "，", ",")) and _LISTED.search(_SHOWN.sub(r"\1", context)) is not None
    numbered, linked, other = _number_before(near), _at_end(context, known.linked), _at_end(context, known.others)
    other_name = context[other[0] : -other[1]] if other else None
    last = next((f for _, f in known.linked.at_end(s.tail)), None) or next((n for start, _ in known.others.at_end(s.tail) if (n := s.tail[start:]) == law or n in known.held), None)
    own_end = fragment and bool(law) and s.tail.endswith(tuple(v + j for v in variants(law) for j in _JOINTS))
    named = _at_end(context, known.linked, edge=False) is not None or bool(law) and context.endswith(tuple(v + j for v in variants(law) for j in _JOINTS)) or own_word
    return {
        "numbered": numbered, "numbered_held": numbered in known.held, "own_word": own_word or listed, "linked_end": linked and linked[2],
        "other_end": other_name, "other_end_held": other_name in known.held, "last": last, "scope": s.scope[1] if s.scope and s.reset <= s.scope[2] else None,
        "other_scope": 0 <= s.other and s.reset <= s.other, "in_parent": own_end or 0 <= s.own and s.reset < s.own, "other_near": _names_other(_SHOWN.sub(r"\1", far) if "[[" in far else far, known),
        "bare": fragment and not named,
    }


@lru_cache(HEADS)
def _opening(head: str, law: str | None, fragment: bool, known: Laws) -> dict | None:
    """The same of a first citation, by the short text before it; None where a link or an open bracket in it may go on behind the citation."""
    if "[[" in head or "（" in _BRACKETS.sub("", head):
        return None
    begin = max((m.end() for m in _BORDER.finditer(head)), default=0)
    (seen,) = _sentence(head[begin:], [len(head) - begin], law, fragment, known)
    return _about(head, seen, law, fragment, known)


def _note(m: re.Match, about: dict) -> dict:
    return {**about, "raw": m[0], "main": m[1], "sub": m[2], "bare": about["bare"] and m.string.startswith("の規定に", m.end())}


def notes(text: str, law: str | None, fragment: bool, known: Laws) -> list[dict]:
    """Of each citation what the rules ask of the text before it; a text takes time in proportion to its length. Short openings, which texts share, are remembered."""
    cites, out = list(_CITED.finditer(text)), []
    if cites and cites[0].start() <= NEAR and (about := _opening(text[: cites[0].start()], law, fragment, known)) is not None:
        out.append(_note(cites[0], about))
    if len(cites) == len(out):
        return out
    borders = [m.end() for m in _BORDER.finditer(text)]
    sentences: dict[int, list[re.Match]] = {}
    k = 0
    for m in cites[len(out) :]:
        while k < len(borders) and borders[k] <= m.start():
            k += 1
        sentences.setdefault(borders[k - 1] if k else 0, []).append(m)
    for begin, mine in sentences.items():
        seen = _sentence(text[begin : mine[-1].start()], [m.start() - begin for m in mine], law, fragment, known)
        out += [_note(m, _about(text[max(0, m.start() - FAR) : m.start()], s, law, fragment, known)) for m, s in zip(mine, seen, strict=True)]
    return out


def resolved(texts: DataFrame, corpus: DataFrame) -> DataFrame:
    """``texts`` (text_id, text, law_name, law_id, node_id, fragment) with ``cited``: for each citation in order raw, number, action
    (link, plain or external), target_law and own (whether it leads to the text's own law for want of another).

    In order: a law cited with its number; a self-reference; in fragments, a bare citation before の規定に; a linked
    name right before; another law's name right before; the sentence's scope; another law anywhere before in the
    sentence; in fragments, a citation outside the parent law's scope. Null texts have no citations. ``corpus``: law_name, law_id,
    has_main; the names of the laws that it holds in full, one each, are gathered when the plan is made and sent to the tasks.
    """
    held = frozenset(r[0] for r in corpus.where("has_main and law_name is not null").select("law_name").distinct().toLocalIterator())
    sent = texts.sparkSession.sparkContext.broadcast(laws(held))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = zip(batch.column("text").to_pylist(), batch.column("law_name").to_pylist(), batch.column("fragment").to_pylist(), strict=True)
            found = [notes(t, law, bool(f), sent.value) if t else [] for t, law, f in given]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(_NOTE))], [*batch.schema.names, "notes"])

    rows = texts.select("text_id", F.col("text").cast("string").alias("text"), "law_name", "law_id", "node_id", "fragment")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    noted = rows.mapInArrow(read, f"{kinds}, notes array<struct<{_NOTE_SQL}>>")
    reached = F.transform("notes", _reached)
    return noted.select(*rows.columns, F.transform(reached, _decided).alias("cited"))


def _reached(x: Column) -> Column:
    """A citation's notes with the law that a name right before it, or the scope of its sentence, leads to."""
    law = F.col("law_name")
    own_number = F.coalesce(x["numbered"] == law, F.lit(False))
    free, by_number = ~(own_number | x["own_word"]), x["numbered"].isNotNull() & ~own_number
    linked = F.coalesce(x["linked_end"], F.lit("刑法"))
    explicit = F.when(by_number & x["numbered_held"], x["numbered"]).when(~by_number & x["linked_end"].isNotNull() & (linked != law), linked)
    crossed = F.when(x["last"].isNotNull(), F.when(x["last"] != law, x["last"])).otherwise(x["scope"])
    other = F.when(free & x["other_end_held"], x["other_end"])
    return F.struct(x.alias("x"), free.alias("free"), by_number.alias("by_number"), explicit.alias("explicit"), F.coalesce(explicit, other, crossed).alias("law"))


def _decided(r: Column) -> Column:
    x, none = r["x"], r["law"].isNull()
    action = (
        F.when(r["by_number"] & ~x["numbered_held"], "external")
        .when(x["bare"], "plain")
        .when(r["explicit"].isNull() & r["free"] & x["other_end"].isNotNull() & ~x["other_end_held"], "plain")
        .when(none & r["free"] & (x["other_scope"] | x["other_near"]), "plain")
        .when(none & F.col("fragment") & ~x["own_word"] & ~x["in_parent"], "plain")
        .otherwise("link")
    )
    sub = F.when(x["sub"].isNotNull(), F.concat(F.lit("_"), kanji_number(x["sub"]).cast("string"))).otherwise("")
    number = F.concat(kanji_number(x["main"]).cast("string"), sub)
    return F.struct(
        x["raw"].alias("raw"), number.alias("number"), action.alias("action"), none.alias("own"),
        F.when(action == "external", x["numbered"]).when(action == "link", F.coalesce(r["law"], F.col("law_name"))).alias("target_law"),
    )


def edges(decided: DataFrame, corpus: DataFrame) -> DataFrame:
    """Edges (text_id, ord, from, to, type, evidence, confidence, source, kind) of ``resolved`` citations; self-edges and laws without identifier have none. Repeats stay.

    ``corpus``: law_name, law_id; of several identifiers of a name the smallest counts.
    """
    # outer, for else the decisions are made a second time to drop empty lists first; texts without citations go by their null action
    rows = decided.select("text_id", "law_id", "node_id", F.posexplode_outer("cited").alias("ord", "c")).select("text_id", "law_id", "node_id", "ord", "c.*").where("action <> 'plain'")
    ids = corpus.where("law_id <> ''").groupBy(F.col("law_name").alias("target_law")).agg(F.min("law_id").alias("target_law_id"))
    found = rows.join(F.broadcast(ids), "target_law", "left")  # a row a law, where a shuffle would bring all citations of one to one task
    law = F.when(F.col("own"), F.col("law_id")).otherwise(F.col("target_law_id"))
    to = F.when(F.col("action") == "external", F.concat(F.lit("external:"), "target_law", F.lit("#main#"), "number")).otherwise(F.concat(F.lit("JPLAW:"), law, F.lit("#main#"), "number"))
    return found.withColumn("to", to).where("`to` is not null and (action = 'external' or `to` <> node_id)").select(
        "text_id", "ord", F.col("node_id").alias("from"), "to", F.lit("refers_to").alias("type"), F.col("raw").alias("evidence"), F.lit(CONFIDENCE).alias("confidence"), F.lit(SOURCE).alias("source"),
        F.when(F.col("action") == "external", "external_ref").alias("kind"),
    )


def link_of(law: Column, number: Column, raw: Column) -> Column:
    name = F.concat(F.lit("第"), F.substring_index(number, "_", 1), F.lit("条"), F.when(number.contains("_"), F.concat(F.lit("の"), F.substring_index(number, "_", -1))).otherwise(""))
    return F.concat(F.lit("[[laws/"), law, F.lit("/本文/"), name, F.lit(".md|"), raw, F.lit("]]"))


def linked_text(decided: DataFrame) -> DataFrame:
    """(text_id, text): each text of ``resolved`` with its links, put together in its row."""
    shown = F.transform("cited", lambda c: F.when(c["action"] == "link", link_of(c["target_law"], c["number"], c["raw"])).otherwise(c["raw"]))
    whole = F.array_join(F.zip_with(F.split("text", CITATION, -1), shown, lambda gap, x: F.concat(gap, F.coalesce(x, F.lit("")))), "")
    return decided.select("text_id", whole.alias("text"))
