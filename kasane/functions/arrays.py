"""Arrays within a row, in time that grows with them and not with their square."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Each value joined with all before it, by doubling: round d joins to each the result that ends 2^d places before, so n values take log2(n) rounds."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int"))

    def further(now: Column, d: Column) -> Column:
        before = lambda i: F.get(now, i - F.pow(F.lit(2), d).cast("int"))
        return F.transform(now, lambda x, i: F.when(before(i).isNull(), x).otherwise(join(before(i), x)))

    return F.aggregate(rounds, values, further)


def running_sums(values: Column) -> Column:
    return running(values, lambda a, b: a + b)


def ends(gaps: Column, matches: Column) -> Column:
    """Code points up to the end of each match, of a text split into ``gaps`` by ``matches``."""
    return running_sums(F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda gap, match: F.length(gap) + F.length(match)))


def texts_before(gaps: Column, matches: Column, width: int) -> Column:
    """The ``width`` code points before each match, fewer at the beginning of the text; no match is empty.

    Every piece (a gap with its match) holds a code point at least, so the last ``width`` pieces are enough, cut to that width each.
    """
    tails = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda gap, match: F.right(F.concat(gap, match), F.lit(width)))
    return let(
        F.struct(gaps.alias("gaps"), tails.alias("tails")),
        lambda x: F.transform(
            x["tails"],
            lambda _, i: F.right(F.concat(F.array_join(F.slice(x["tails"], F.greatest(i - width, F.lit(0)) + 1, F.least(i, F.lit(width))), ""), F.right(F.get(x["gaps"], i), F.lit(width))), F.lit(width)),
        ),
    )


def texts_after(gaps: Column, matches: Column, width: int) -> Column:
    """The ``width`` code points behind each match, fewer at the end of the text."""
    heads = F.zip_with(matches, F.slice(gaps, 2, F.size(matches)), lambda match, gap: F.left(F.concat(match, gap), F.lit(width)))
    return let(
        F.struct(gaps.alias("gaps"), heads.alias("heads")),
        lambda x: F.transform(x["heads"], lambda _, i: F.left(F.concat(F.left(F.get(x["gaps"], i + 1), F.lit(width)), F.array_join(F.slice(x["heads"], i + 2, F.lit(width)), "")), F.lit(width))),
    )
