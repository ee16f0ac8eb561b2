"""Attribute values in base units, as Column expressions."""

from __future__ import annotations

from itertools import chain

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Each spelling of a unit, its dimension and its factor to the base unit.
UNITS = {
    "мм": ("m", 0.001), "mm": ("m", 0.001),
    "см": ("m", 0.01), "cm": ("m", 0.01),
    "дм": ("m", 0.1),
    "м": ("m", 1.0), "m": ("m", 1.0), "метр": ("m", 1.0), "метров": ("m", 1.0), "метра": ("m", 1.0),
    "км": ("m", 1000.0),
    "вт": ("w", 1.0), "w": ("w", 1.0), "ватт": ("w", 1.0),
    "квт": ("w", 1000.0), "kw": ("w", 1000.0),
    "мвт": ("w", 1000000.0), "mw": ("w", 1000000.0),
    "мг": ("g", 0.001),
    "г": ("g", 1.0), "g": ("g", 1.0), "грамм": ("g", 1.0),
    "кг": ("g", 1000.0), "kg": ("g", 1000.0),
    "т": ("g", 1000000.0),
    "мл": ("l", 0.001), "ml": ("l", 0.001),
    "л": ("l", 1.0), "l": ("l", 1.0), "литр": ("l", 1.0),
    "м3": ("l", 1000.0),
    "в": ("v", 1.0), "v": ("v", 1.0), "вольт": ("v", 1.0),
    "кв": ("v", 1000.0), "kv": ("v", 1000.0),
    "а": ("a", 1.0), "a": ("a", 1.0), "ампер": ("a", 1.0),
    "ма": ("a", 0.001),
    "па": ("pa", 1.0), "pa": ("pa", 1.0),
    "кпа": ("pa", 1000.0),
    "мпа": ("pa", 1000000.0), "mpa": ("pa", 1000000.0),
    "бар": ("pa", 100000.0), "bar": ("pa", 100000.0),
    "атм": ("pa", 101325.0),
    "с": ("s", 1.0), "сек": ("s", 1.0), "s": ("s", 1.0),
    "мин": ("s", 60.0), "min": ("s", 60.0),
    "ч": ("s", 3600.0), "час": ("s", 3600.0), "h": ("s", 3600.0),
    "шт": ("pcs", 1.0), "штук": ("pcs", 1.0), "штука": ("pcs", 1.0), "штуки": ("pcs", 1.0), "штуку": ("pcs", 1.0), "штукой": ("pcs", 1.0), "pcs": ("pcs", 1.0), "pc": ("pcs", 1.0), "пр": ("pcs", 1.0), "пред": ("pcs", 1.0), "предмет": ("pcs", 1.0), "предметов": ("pcs", 1.0), "предмета": ("pcs", 1.0),
}
# Number words.
WORDS = {
    "ноль": 0.0, "один": 1.0, "одна": 1.0, "одно": 1.0, "два": 2.0, "две": 2.0, "три": 3.0, "четыре": 4.0,
    "пять": 5.0, "шесть": 6.0, "семь": 7.0, "восемь": 8.0, "девять": 9.0, "десять": 10.0, "одиннадцать": 11.0, "двенадцать": 12.0,
    "сто": 100.0, "тысяча": 1000.0,
}


def _map(pairs: dict) -> Column:
    return F.create_map(*map(F.lit, chain.from_iterable(pairs.items())))


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Unicode compatibility composition, which Spark has no function for."""
    return texts.str.normalize("NFKC")


def canon_string(c: Column | str, unicode: bool = True) -> Column:
    """Composed, lower case, without punctuation, one blank between words. unicode=False skips the Python step for
    columns that are composed already."""
    t = F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
    t = F.replace(F.replace(nfkc(t) if unicode else t, F.lit("ё"), F.lit("е")), F.lit("Ё"), F.lit("Е"))
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(t), r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))


def canon_numeric(c: Column | str, hint: Column | str | None = None, unicode: bool = False) -> Column:
    """struct(value, dimension) of a text such as "1.5 kW", in base units; null if it holds no number. A number word
    counts pieces, a sign isn't read, and hint is the unit where the text names none. A unit that isn't known leaves
    the number as it is, without a dimension."""
    t = F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
    t = F.trim(F.lower(F.replace(F.replace(nfkc(t) if unicode else t, F.lit("ё"), F.lit("е")), F.lit("Ё"), F.lit("Е"))))
    number = F.nullif(F.regexp_extract(t, r"([0-9]+(?:[.,][0-9]+)?)\s*([a-zа-я]+)?", 1), F.lit(""))
    unit = F.regexp_extract(t, r"([0-9]+(?:[.,][0-9]+)?)\s*([a-zа-я]+)?", 2)
    if hint is not None:
        unit = F.when(unit == "", F.replace(canon_string(hint, unicode), F.lit(" "), F.lit(""))).otherwise(unit)
    factor, dimension = F.try_element_at(_map({u: f for u, (_, f) in UNITS.items()}), unit), F.try_element_at(_map({u: d for u, (d, _) in UNITS.items()}), unit)
    word = F.try_element_at(_map(WORDS), t)
    value = F.replace(number, F.lit(","), F.lit(".")).try_cast("double") * F.coalesce(factor, F.lit(1.0))
    pair = lambda v, d: F.struct(v.alias("value"), d.alias("dimension"))
    return F.when(word.isNotNull(), pair(word, F.lit("pcs"))).when(number.isNotNull(), pair(value, F.coalesce(dimension, F.lit(""))))


def canon_number(c: Column | str, hint: str | None = None) -> Column:
    """struct(value, dimension) of a numeric column; the sign stays."""
    dimension, factor = UNITS.get((hint or "").lower().replace(" ", ""), ("", 1.0))
    v = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(v.isNotNull(), F.struct((v * factor).alias("value"), F.lit(dimension).alias("dimension")))


def compare_key(c: Column | str, hint: Column | str | None = None) -> Column:
    """A text's number in base units as text, else its canonical string: equal for values that compare equal."""
    return F.coalesce(F.round(canon_numeric(c, hint)["value"], 6).cast("string"), canon_string(c, unicode=False))


def is_count_key(key: Column | str) -> Column:
    """Whether an attribute counts pieces (only used by the optional 3 % tolerance)."""
    return F.lower(key).rlike("количество|предмет|_шт|штук|_pcs|items_count")


def tolerance_of(key: Column | str, counts: bool = False) -> Column:
    """The ratio up to which numbers agree; 1.03 for counts if that rule is switched on."""
    return F.when(is_count_key(key) & F.lit(counts), 1.03).otherwise(1.15)


def bucket(value: Column | str, tolerance: Column | str) -> Column:
    """A value on the grid of its tolerance: below 1 it is relative (a grid that moves with the value, at least 1
    wide), from 1 absolute, and without one the value has two digits. Halves go to the even neighbour."""
    v, t = (F.col(x) if isinstance(x, str) else x for x in (value, tolerance))
    grid = F.when(t < 1, F.greatest(F.lit(1.0), F.abs(v) * t)).otherwise(t)
    return F.when(t > 0, F.rint(v / grid) * grid).otherwise(F.bround(v, 2))
