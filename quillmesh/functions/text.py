"""Text functions as Column expressions. Nulls are empty texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word lists and patterns of the data format.
STOP_WORDS = (
    "и в на с по для из от до за к не или но а о у же бы ли ни то это как что так все уже он она они мы вы его её их мой ваш наш свой "
    "быть мочь также еще ещё при через the a an and or for in on with of to is are was were be been being "
    "артикул товар шт штук упак упаковка набор"
).split()
LEGAL_SUFFIXES = (" llc", " inc", " ltd", " gmbh", " ооо", " оао", " зао", " ип")
KEEP = "a-zA-Zа-яА-ЯёЁ0-9"
UNITS_IN_NAMES = "мм|см|м|мг|г|кг|мл|л|вт|квт|гб|тб|мб|шт|мач|мп|гц|mm|cm|kg|ml|gb|tb|mb|w|kw|hz|fps"
STRIPPED_UNITS = r"мм|см|м|мг|г|кг|мл|л|вт|квт|гб|тб|мб|шт|штук|мач|мп|гц|предмет\w*|ступен\w*|секци\w*|луч\w*|звень\w*|mm|cm|kg|ml|gb|tb|mb|w|kw|hz|pcs|pc"
CONTRADICTIONS = (
    r"но не\s+\w+", r"не является\b", r"другой тип\b", r"отличается\b", r"не совпадает\b", r"разный\b", r"разные\b", r"разного\b",
    r"не подходит\b", r"не соответствует\b", r"не относится\b", r"другая категория\b", r"другой размер\b", r"другой диаметр\b",
)
YEARS = ("2024", "2025", "2026")


def _text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def squeeze(c: Column | str) -> Column:
    """White space runs become one blank, none at the ends."""
    return F.trim(F.regexp_replace(_text(c), r"(?U)\s+", " "))


def normalize_text(c: Column | str) -> Column:
    """Lower case; characters beyond letters of the two alphabets, digits, / and - become blanks."""
    return squeeze(F.regexp_replace(F.lower(_text(c)), rf"(?U)[^{KEEP}\s/\-]", " "))


def normalize_brand(c: Column | str) -> Column:
    """Lower case without legal suffixes (each at most once, in their order) and without other characters."""
    b = F.trim(F.lower(_text(c)))
    for suffix in LEGAL_SUFFIXES:
        b = F.trim(F.regexp_replace(b, f"{suffix}$", ""))  # one reference to b: nested conditions would grow threefold each
    return F.trim(F.regexp_replace(b, rf"(?U)[^{KEEP}\s/\-]", ""))


def strip_numbers(c: Column | str) -> Column:
    """Without dimensions, numbers with units and numbers that stand alone; model codes stay."""
    t = F.regexp_replace(_text(c), r"(?U)\b\d+\s*[xхXХ×]\s*\d+(?:\s*[xхXХ×]\s*\d+)*\b", "")
    t = F.regexp_replace(t, rf"(?iU)\d+(?:[.,]\d+)?\s*(?:{STRIPPED_UNITS})\b", "")
    return squeeze(F.regexp_replace(t, rf"(?U)(?<![{KEEP}])\d+(?:[.,]\d+)?(?![{KEEP}\-])", ""))


def tokenize(c: Column | str, lemma=lambda w: w) -> Column:
    """Tokens of two characters or more: numbers and codes as they are, words as their lemma (a Column function; the
    default leaves them) unless it is a stop word."""
    words = F.filter(F.split(normalize_text(c), " "), lambda w: F.length(w) >= 2)
    code = lambda w: w.rlike("^[0-9]+$") | w.rlike("[0-9]") & w.rlike("[a-zа-яё]")
    return F.filter(F.transform(words, lambda w: F.when(code(w), w).otherwise(lemma(w))), lambda w: code(w) | ~w.isin(STOP_WORDS) & (F.length(w) >= 2))


def words_only(tokens: Column | str) -> Column:
    """Tokens that aren't numbers."""
    return F.filter(tokens, lambda w: ~w.rlike("^[0-9]+$"))


def numeric_attrs(c: Column | str) -> Column:
    """Map of unit to value, the first of each unit. Normalising comes first, so a decimal mark splits its number."""
    pattern = F.lit(rf"(?iU)(\d+(?:[.,]\d+)?)\s*({UNITS_IN_NAMES})\b")
    t = normalize_text(c)
    values, units = F.regexp_extract_all(t, pattern, 1), F.regexp_extract_all(t, pattern, 2)
    pairs = F.arrays_zip(units.alias("unit"), F.transform(values, lambda v: v.cast("double")).alias("value"))
    first = F.filter(pairs, lambda p, k: F.array_position(units, p["unit"]) == k + 1)
    return F.map_from_entries(first)


def token_overlap(a: Column | str, b: Column | str) -> Column:
    """Jaccard similarity; 0 if either is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(0.0)


def same_brand(x: Column, y: Column) -> Column:
    """brand_match of brands that are normalised already: where pairs are many, normalise each side once."""
    return F.when((x == "") | (y == ""), 0.0).when(x == y, 1.0).when(F.contains(x, y) | F.contains(y, x), 0.5).otherwise(0.0)


def brand_match(a: Column | str, b: Column | str) -> Column:
    """1 for equal brands, 0.5 where one holds the other, else 0; unknown brands match nothing."""
    return same_brand(normalize_brand(a), normalize_brand(b))


def price_ratio(a: Column | str, b: Column | str) -> Column:
    """The larger over the smaller; 1 unless both are positive."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.when((a > 0) & (b > 0), F.greatest(a / b, b / a)).otherwise(1.0)


def head_noun(c: Column | str, lemma=lambda w: w) -> Column:
    """The first word without digits whose lemma has three characters or more; null if none has."""
    words = F.filter(F.split(normalize_text(c), " "), lambda w: (F.length(w) >= 2) & ~w.rlike("[0-9]"))
    return F.get(F.filter(F.transform(words, lemma), lambda w: F.length(w) >= 3), F.lit(0))


def safe_float(c: Column | str) -> Column:
    """A number without blanks; null if it is none."""
    return F.replace(F.replace(_cast(c), F.lit(" "), F.lit("")), F.lit(" "), F.lit("")).try_cast("double")


def _cast(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def contradicts(reason: Column | str) -> Column:
    """Whether a reason names a difference."""
    return F.lower(_text(reason)).rlike(r"(?U)\b(?:" + "|".join(CONTRADICTIONS) + ")")


def key_hint(key: Column | str) -> Column:
    """The unit at the end of a key, after an underscore; '' if none."""
    return F.regexp_extract(F.lower(_text(key)), r"_([a-zа-я]+)$", 1)


def json_inside(c: Column | str) -> Column:
    """From the first opening bracket or brace to the last closing one; null if there is none."""
    return F.nullif(F.regexp_extract(_text(c), r"(?s)([\[{].*[\]}])", 1), F.lit(""))


def full_url(c: Column | str) -> Column:
    """An address with its scheme."""
    u = F.trim(_text(c))
    return F.when(u == "", "").when(F.startswith(u, F.lit("//")), F.concat(F.lit("https:"), u)).when(F.startswith(u, F.lit("http")), u).otherwise(F.concat(F.lit("https://"), u))


def image_url(c: Column | str, size: str = "c246x328", large: str = "c516x688") -> Column:
    """The address of the large image."""
    return F.replace(full_url(c), F.lit(f"/{size}/"), F.lit(f"/{large}/"))


def name_numbers(c: Column | str) -> Column:
    """Distinct numbers of two to four digits that are no recent year."""
    found = F.array_distinct(F.regexp_extract_all(_text(c), F.lit(r"([0-9]+)"), 1))
    return F.filter(found, lambda n: F.length(n).between(2, 4) & ~n.isin(*YEARS))


def numbers_match(name: Column | str, other: Column | str) -> Column:
    """Whether a number of the name is in the other text; true if the name has none."""
    own = name_numbers(name)
    return (F.size(own) == 0) | F.arrays_overlap(own, F.regexp_extract_all(_text(other), F.lit(r"([0-9]+)"), 1))


def number_matches(name: Column | str, other: Column | str) -> Column:
    """Distinct numbers that both texts have."""
    numbers = lambda c: F.regexp_extract_all(_text(c), F.lit(r"([0-9]+)"), 1)
    return F.size(F.array_intersect(numbers(name), numbers(other)))


def better_reading(name: Column | str, first: Column | str, second: Column | str) -> Column:
    """The first reading if its numbers fit or there is no second; else the second if its numbers fit or more do."""
    a, b = _text(first), _text(second)
    return F.when((a == "") | numbers_match(name, a) | (b == ""), a).when(numbers_match(name, b) | (number_matches(name, b) > number_matches(name, a)), b).otherwise(a)


def format_attrs(attrs: Column | str) -> Column:
    """[*Label=raw, ...] of an array of (label, raw, priority); a star marks the first priority."""
    part = lambda a: F.concat(F.when(a["priority"] <= 1, "*").otherwise(""), a["label"], F.lit("="), a["raw"])
    return F.when(F.size(attrs) > 0, F.concat(F.lit("["), F.array_join(F.transform(attrs, part), ", "), F.lit("]"))).otherwise("")
