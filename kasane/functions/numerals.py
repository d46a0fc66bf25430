"""Kanji numerals and amendment keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numerals and era names.
DIGITS = {"〇": 0, "零": 0, "一": 1, "壱": 1, "二": 2, "弐": 2, "三": 3, "参": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9}
UNITS = {"十": 10, "百": 100, "千": 1000, "万": 10000}
ERAS = {"明治": "M", "大正": "T", "昭和": "S", "平成": "H", "令和": "R"}
_KANJI, _PLAIN = "".join(DIGITS), "".join(map(str, DIGITS.values()))


def digits(text: Column) -> Column:
    """Each kanji digit as an ASCII digit, all else kept."""
    return F.translate(text, _KANJI, _PLAIN)


def kanji_number(text: Column) -> Column:
    """A numeral as a long. ASCII and full-width digits alone are read as they are; with a unit sign (十百千万) each unit
    multiplies the one digit before it and the products are added; else the digits are read side by side. Other
    characters are ignored; an empty numeral is 0, null is null.
    """
    ascii_text = F.translate(text, "０１２３４５６７８９", "0123456789")
    values, units = (F.expr("map(" + ", ".join(f"'{k}', {v}" for k, v in x.items()) + ")") for x in (DIGITS, UNITS))
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("now"))

    def step(acc: Column, c: Column) -> Column:
        digit, unit = F.try_element_at(values, c), F.try_element_at(units, c)
        added = acc["sum"] + F.greatest(acc["now"], F.lit(1)) * unit
        return (
            F.when(digit.isNotNull(), F.struct(acc["sum"].alias("sum"), digit.cast("long").alias("now")))
            .when(unit.isNotNull(), F.struct(added.alias("sum"), F.lit(0).cast("long").alias("now")))
            .otherwise(acc)
        )

    positional = F.aggregate(F.split(text, ""), start, step, lambda acc: acc["sum"] + acc["now"])
    side_by_side = F.regexp_replace(digits(F.regexp_replace(text, f"[^{_KANJI}]", "")), "^$", "0").try_cast("long")
    return F.when(ascii_text.rlike("^[0-9]+$"), ascii_text.try_cast("long")).when(text.rlike(f"[{''.join(UNITS)}]"), positional).otherwise(side_by_side)


def to_kanji(number: Column) -> Column:
    """The positional numeral of 1 to 9999, the form statutes use (二十三, 百二); other numbers give null."""

    def place(unit: int, sign: str) -> Column:
        d = F.floor(number / unit) % 10
        one = F.translate(d.cast("string"), "123456789", "一二三四五六七八九")
        return F.when(d == 0, "").when((d == 1) & F.lit(bool(sign)), sign).otherwise(F.concat(one, F.lit(sign)))

    return F.when((number >= 1) & (number <= 9999), F.concat(place(1000, "千"), place(100, "百"), place(10, "十"), place(1, "")))


def loose_int(text: Column) -> Column:
    """An integer as tolerant parsers read it: full-width digits, and underscores between digits (2_2 is 22); else null."""
    plain = F.translate(F.trim(text), "０１２３４５６７８９", "0123456789")
    return F.when(plain.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), F.regexp_replace(plain, "_", "")).try_cast("long")


_ERA = "|".join(ERAS)


def amendment_key(title: Column) -> Column:
    """平成一一年…法律第八七号 or 平成11年…法律第87号 as H11_L87. A key stays; any other title has its non-word characters made underscores."""
    codes = F.create_map(*(F.lit(x) for kv in ERAS.items() for x in kv))

    def made(number: str) -> Column:
        p = f"({_ERA})({number})年.*法律第({number})号"
        part = [F.regexp_extract(title, p, i) for i in (1, 2, 3)]
        return F.when(part[0] != "", F.concat(F.element_at(codes, F.nullif(part[0], F.lit(""))), digits(part[1]), F.lit("_L"), digits(part[2])))

    kept = F.when(title.rlike(r"^[MTSHR][0-9]+_L[0-9]+$"), title)
    return F.coalesce(kept, made("[〇一二三四五六七八九]+"), made("[0-9]+"), F.regexp_replace(title, r"(?U)[^\w]", "_"))


def amendment_title(key: Column) -> Column:
    """H11_L87 as 平成11年法律第87号; anything else stays."""
    names = F.create_map(*(F.lit(x) for k, v in ERAS.items() for x in (v, k)))
    p = r"^([MTSHR])([0-9]+)_L([0-9]+)$"
    part = [F.regexp_extract(key, p, i) for i in (1, 2, 3)]
    return F.when(part[0] == "", key).otherwise(F.concat(F.element_at(names, F.nullif(part[0], F.lit(""))), part[1], F.lit("年法律第"), part[2], F.lit("号")))


def amendment_key_of_path(path: Column) -> Column:
    """The key of the segment after 改正法 in a path; null without one."""
    parts = F.split(path, "/")
    at = F.array_position(parts, F.lit("改正法"))
    return F.when(at > 0, amendment_key(F.try_element_at(parts, (at + 1).cast("int"))))


_FULL = f"^({_ERA})([〇一二三四五六七八九十百千]+)年[〇一二三四五六七八九十百千]+月[〇一二三四五六七八九十百千]+日法律第([〇一二三四五六七八九十百千]+)号"


def _full_title(title: Column) -> tuple[Column, Column, Column]:
    part = [F.regexp_extract(title, _FULL, i) for i in (1, 2, 3)]
    return F.nullif(part[0], F.lit("")), kanji_number(part[1]).cast("string"), kanji_number(part[2]).cast("string")


def long_title(title: Column) -> Column:
    """A title with its full date, 昭和一六年三月一二日法律第六一号, as 昭和16年法律第61号; any other stays."""
    era, year, number = _full_title(title)
    return F.when(era.isNull(), title).otherwise(F.concat(era, year, F.lit("年法律第"), number, F.lit("号")))


def short_title(title: Column) -> Column:
    """The same as S16_L61; any other title with its non-word characters as underscores."""
    codes = F.create_map(*(F.lit(x) for kv in ERAS.items() for x in kv))
    era, year, number = _full_title(title)
    return F.when(era.isNull(), F.regexp_replace(title, r"(?U)[^\w]", "_")).otherwise(F.concat(F.element_at(codes, era), year, F.lit("_L"), number))
