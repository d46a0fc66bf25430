"""Document fingerprints from closed syncmers, with DataFrame functions only.

A closed syncmer is a k-mer of bytes whose smallest inner s-mer stands at its first or last place. Whether a k-mer is
one follows from its own bytes, so a passage has the same anchors wherever it stands and whatever surrounds it. A text is read with
``K`` - 1 zero bytes in front, so that a text of one character has k-mers too.

A fingerprint is the ``ANCHORS`` anchors of smallest hash, each with its first place, as a sorted array of numbers: the hash in the
high 32 bits, the place in bytes in the low ones. Two fingerprints are compared by place: an anchor of both counts
if its shift from one text to the other is none, or is that of another anchor too.

An edited text keeps the anchors of the parts that it is made of; only the k-mers across the seam are read for it.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 16
S = 5
#: Anchors that a fingerprint holds at most: those of smallest hash among all of the text.
ANCHORS = 64
#: Bytes of text whose s-mers are held at once.
PIECE = 4096
PLACE_BITS = 32
_PLACE = (1 << PLACE_BITS) - 1

#: Bytes of texts of neighbouring ids that one task orders, and how many such ranges there may be.
RANGE_BYTES = 1 << 22
MOST_RANGES = 1 << 15


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _anchors(piece: Column, at: Column) -> Column:
    """Packed anchors of the k-mers of a piece of bytes that begins at byte ``at`` of its text; a piece has ``K`` bytes or more."""
    inner = K - S + 1
    hashes = F.transform(F.sequence(F.lit(1), F.length(piece) - (S - 1)), lambda i: F.xxhash64(F.substring(piece, i, F.lit(S))))

    def closed(h: Column) -> Column:
        edge = lambda i: F.least(F.element_at(h, i), F.element_at(h, i + (inner - 1)))
        starts = F.filter(F.sequence(F.lit(1), F.size(h) - (inner - 1)), lambda i: (edge(i) <= F.element_at(h, i + inner // 2)) & (edge(i) <= F.array_min(F.slice(h, i, F.lit(inner)))))
        return F.transform(starts, lambda i: _packed(F.xxhash64(F.substring(piece, i, F.lit(K))), at + i - 1))

    return _let(hashes, closed)


def _packed(kmer: Column, place: Column) -> Column:
    return kmer.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(place.cast("long"))


def sketch(packed: Column, anchors: int = ANCHORS) -> Column:
    """The fingerprint of a text with these anchors: the first place of each of the ``anchors`` smallest hashes."""
    new = lambda x: F.filter(x, lambda a, i: (i == 0) | (F.shiftright(a, PLACE_BITS) != F.shiftright(F.get(x, i - 1), PLACE_BITS)))
    return F.slice(_let(F.sort_array(packed), new), 1, anchors)


def all_anchors(text: Column) -> Column:
    """All anchors of a text in order of place, as packed numbers; a null or empty text has none. Long texts are read piece by piece."""

    def pieces(padded: Column) -> Column:
        starts = F.sequence(F.lit(0), F.length(padded) - K, F.lit(PIECE))
        return F.transform(starts, lambda lo: _let(F.substring(padded, lo + 1, F.lit(PIECE + K - 1)), lambda piece: _anchors(piece, lo)))

    padded = F.concat(F.unhex(F.lit("00" * (K - 1))), text.cast("binary"))
    return F.when(F.length(text) > 0, F.flatten(_let(padded, pieces))).otherwise(F.array().cast("array<bigint>"))


def joined_anchors(head: Column, head_anchors: Column, tail: Column, tail_anchors: Column) -> Column:
    """All anchors of ``head`` followed by ``tail``, in no order, from those of texts that begin so: only the k-mers across the seam are read.

    A k-mer of the padded head lies before the seam if it begins before the last byte of the head; of the tail those with no padding count.
    """
    at, size = F.octet_length(head), F.octet_length(tail)
    place = lambda a: a.bitwiseAND(F.lit(_PLACE))
    before = F.filter(head_anchors, lambda a: place(a) < at)
    after = F.transform(F.filter(tail_anchors, lambda a: (place(a) >= K - 1) & (place(a) < size)), lambda a: a + at)
    # the last K - 1 bytes before the seam, padding included, and the first K - 1 behind it
    left = F.concat(F.unhex(F.lit("00" * (K - 1))), head.cast("binary"))
    seam = F.concat(F.substring(left, at + 1, F.lit(K - 1)), F.substring(tail.cast("binary"), F.lit(1), F.lit(K - 1)))
    across = F.when(size > 0, _let(seam, lambda x: _anchors(x, at))).otherwise(F.array().cast("array<bigint>"))
    return F.concat(before, across, after)


def written(found: Column) -> Column:
    """A fingerprint as a string: 16 hexadecimal digits an anchor, smallest hash first."""
    return F.lower(F.array_join(F.transform(found, lambda a: F.lpad(F.hex(a), 16, "0")), ""))


def likeness(a: Column, b: Column, anchors: int = ANCHORS) -> Column:
    """0 to 1: the share of anchors that two fingerprints have in common at fitting places, among the smallest of both; two empty ones are alike.

    The smallest hashes of both texts together are a fair sample of all their anchors, so the share estimates that of the texts.
    """
    hashes = lambda x: F.transform(x, lambda y: F.shiftright(y, PLACE_BITS))

    def shift(ha: Column, hb: Column, h: Column) -> Column:
        place = lambda x, names: F.element_at(x, F.array_position(names, h).cast("int"))
        return place(b, hb).bitwiseAND(F.lit(_PLACE)) - place(a, ha).bitwiseAND(F.lit(_PLACE))

    fitting = lambda s: F.size(F.filter(s, lambda x: (x == 0) | (F.size(F.filter(s, lambda y: y == x)) > 1)))

    def share(h: Column) -> Column:
        ha, hb = h["a"], h["b"]

        def of(sample: Column) -> Column:
            common = F.array_intersect(sample, F.array_intersect(ha, hb))
            return _let(F.transform(common, lambda x: shift(ha, hb, x)), fitting) / F.size(sample)

        return _let(F.slice(F.sort_array(F.array_union(ha, hb)), 1, anchors), of)

    return F.when(a == b, F.lit(1.0)).otherwise(_let(F.struct(hashes(a).alias("a"), hashes(b).alias("b")), share))


def _range_of(value: Column, borders: Column, n: int) -> Column:
    """How many of the sorted ``borders`` (n of them) are smaller than ``value``, by halving."""
    halves = F.sequence(F.lit(1), F.lit(max(1, n.bit_length())))

    def half(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        less = F.coalesce(F.get(borders, mid) < value, F.lit(False))
        done = acc["lo"] >= acc["hi"]
        return F.struct(F.when(done | ~less, acc["lo"]).otherwise(mid + 1).alias("lo"), F.when(done | less, acc["hi"]).otherwise(mid).alias("hi"))

    return F.aggregate(halves, F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi")), half, lambda acc: acc["lo"])


def _constant(values: list, kind: str) -> Column:
    """A constant array, written as text so that the plan holds one literal however long it is."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _with_next(docs: DataFrame, anchors: int) -> DataFrame:
    """(doc_id, text, found, own, next_text, next_found, following): each row with its anchors and fingerprint, and those of the next row with its text.

    The next row is that of the next doc_id in descending order, null ids last, equal ids by text; after the last comes the first.
    Ids are cut into ranges of about ``RANGE_BYTES`` of texts, which are ordered side by side. The first row of a range is also sent to
    the range before it, as the neighbour of its last row, and the first of all to the last range. Texts are shuffled once; the driver holds
    three numbers for each of at most ``MOST_RANGES`` ranges. Rows of one id stand in one range.
    """
    size = docs.agg(F.sum(F.octet_length("text") + 64).alias("n"), F.count("doc_id").alias("named")).first()
    n, cuts = min(MOST_RANGES, max(1, ceil((size["n"] or 0) / RANGE_BYTES))), []
    if n > 1 and size["named"]:
        steps = _constant([i / n for i in range(1, n)], "double")
        cuts = sorted(set(docs.agg(F.percentile_approx("doc_id", steps, max(10_000, 10 * n)).alias("cuts")).first()["cuts"]))
    # A range holds the ids above one cut, up to the next; null ids are a range of their own, below all others.
    number = _range_of(F.col("doc_id"), _constant(cuts, "bigint"), len(cuts)) if cuts else F.lit(0)
    ranged = docs.withColumn("range", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(number))
    heads = {r["range"]: r["head"] for r in ranged.groupBy("range").agg(F.max("doc_id").alias("head")).collect()}
    order = sorted(heads, reverse=True)
    before = {r: order[i - 1] for i, r in enumerate(order)}  # that of the first range is the last one
    every, at = range(-1, len(cuts) + 1), F.col("range") + 1
    is_head = F.col("doc_id").isNull() | (F.col("doc_id") == F.get(_constant([heads.get(r) or 0 for r in every], "bigint"), at))
    guest = F.struct(F.get(_constant([before.get(r, 0) for r in every], "int"), at).alias("range"), F.lit(1).alias("guest"))
    own = F.struct(F.col("range").alias("range"), F.lit(0).alias("guest"))
    sent = ranged.select("doc_id", "text", F.inline(F.when(is_head, F.array(own, guest)).otherwise(F.array(own))))
    dealt = sent.repartitionByRange(n, "range").withColumn("found", all_anchors(F.col("text"))).withColumn("own", sketch(F.col("found"), anchors))
    window = Window.partitionBy("range").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    ordered = dealt.select("*", *(F.lead(name).over(window).alias(new) for name, new in (("text", "next_text"), ("found", "next_found"), ("own", "following"))))
    return ordered.where("guest = 0").drop("guest", "range")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", anchors: int = ANCHORS) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next): one row for every row of ``docs``.

    The edited text is the text with its last floor(n_chars / 2) code points replaced by as many first ones of the next text (all, if it has
    fewer); the next text is that of the next doc_id, descending, after the last the first. Null ids come last, rows of one id by text; a single row is its own
    next. A null text is empty: an empty text has an empty fingerprint, which is like another empty one (1) and no other (0). Repeated rows are
    each returned; an empty table gives an empty result. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    parts = _with_next(rows, anchors).withColumns({"head": F.substring("text", F.lit(1), n - half), "tail": F.substring("next_text", F.lit(1), half)})
    other = sketch(joined_anchors(F.col("head"), F.col("found"), F.col("tail"), F.col("next_found")), anchors)
    made = parts.select("doc_id", n.cast("long").alias("n_chars"), F.concat("head", "tail").alias("edited"), "own", "following", other.alias("other"))
    return made.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("own")).alias("fingerprint"),
        written(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other"), anchors).alias("near_edited"),
        likeness(F.col("own"), F.col("following"), anchors).alias("near_next"),
    )
