"""Column expressions that turn messy text into numbers and flags.

All of them are built-in Spark expressions (whole-stage codegen, no Python),
NULL-propagating, and never raise under ANSI mode: parses go through a
numeric-shape regex and ``try_cast``, so ``'abc'``, ``''``, ``'nan'`` and
``'inf'`` all become NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# optional sign, digits with optional fraction (or a bare fraction), optional exponent
NUMERIC_SHAPE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN is not a missing value inside Spark; make it one."""
    return F.nanvl(_c(c).cast("double"), F.lit(None).cast("double"))


def to_number(c: str | Column) -> Column:
    """Text -> double; anything that is not a plain decimal number -> NULL."""
    s = F.trim(_c(c).cast("string"))
    return F.when(s.rlike(NUMERIC_SHAPE), s.try_cast("double"))


def _strip(c: str | Column, *tokens: str) -> Column:
    s = _c(c).cast("string")
    for t in tokens:
        s = F.replace(s, F.lit(t), F.lit(""))
    return s


def currency_to_number(c: str | Column) -> Column:
    """Remove literal ``$`` and ``,`` then parse (``'$10,300'`` -> 10300)."""
    return to_number(_strip(c, "$", ","))


def thousands_to_number(c: str | Column) -> Column:
    """C6 (flight price): remove ``,`` then parse (``'25,612'`` -> 25612)."""
    return to_number(_strip(c, ","))


def unit_to_number(c: str | Column, unit: str = "mi.") -> Column:
    """Remove the unit suffix and ``,`` then parse (``'51,000 mi.'``)."""
    return to_number(_strip(c, unit, ","))


def regex_strip_to_number(c: str | Column, pattern: str = r"[$,]") -> Column:
    """Remove every match of ``pattern`` then parse."""
    return to_number(F.regexp_replace(_c(c).cast("string"), pattern, ""))


def fill_text(c: str | Column, value: str = "No") -> Column:
    """Missing -> ``value``, then trimmed."""
    return F.trim(F.coalesce(_c(c).cast("string"), F.lit(value)))


def contains_flag(c: str | Column, pattern: str, missing: str) -> Column:
    """1.0 when the lower-cased text (missing -> ``missing``) matches the
    regex ``pattern`` anywhere, else 0.0."""
    s = F.lower(F.coalesce(_c(c).cast("string"), F.lit(missing)))
    return s.rlike(pattern).cast("double")


# Indicator patterns of the used-car cleaning
ACCIDENT_REPORTED = "accident|damage"
ACCIDENT_NONE = "none"
TRANS_AUTOMATIC = "automatic|a/t|cvt|dual shift|at|auto|speed a/t"
TRANS_MANUAL = "manual|m/t|mt|speed m/t"

# Colour keywords in their required order (first substring hit wins)
COLOUR_KEYWORDS = [
    ("black", "black"), ("white", "white"), ("blue", "blue"), ("red", "red"),
    ("silver", "silver"), ("gray", "gray"), ("grey", "gray"), ("green", "green"),
    ("brown", "brown"), ("beige", "beige"), ("yellow", "yellow"), ("gold", "gold"),
    ("orange", "orange"), ("purple", "purple"), ("charcoal", "gray"), ("bronze", "brown"),
    ("ebony", "black"), ("tan", "brown"),
]


def simplify_colour(c: str | Column) -> Column:
    """C11: lower-cased colour text -> one of 13 colour names or ``other``;
    keywords are tried in ``COLOUR_KEYWORDS`` order."""
    s = F.lower(F.coalesce(_c(c).cast("string"), F.lit("other")))
    out = F.lit("other")
    for key, value in reversed(COLOUR_KEYWORDS):
        out = F.when(s.contains(key), F.lit(value)).otherwise(out)
    return out


def extract_number(c: str | Column, pattern: str) -> Column:
    """First capture group of ``pattern`` as a double; no match -> NULL."""
    s = F.regexp_extract(_c(c).cast("string"), pattern, 1)
    return to_number(F.nullif(s, F.lit("")))


# Engine text patterns
HP_PATTERN = r"(\d+\.?\d*)\s*HP"
LITRES_PATTERN = r"(\d+\.?\d*)\s*(?:L|Liter)"


def engine_hp(c: str | Column) -> Column:
    """Horsepower written as ``<number> HP``."""
    return extract_number(c, HP_PATTERN)


def engine_litres(c: str | Column) -> Column:
    """C13 + C14: displacement ``<number> L``/``Liter``; 0.0 when the text
    mentions 'electric' in any case (hybrids included)."""
    txt = _c(c).cast("string")
    return F.when(F.lower(txt).contains("electric"), F.lit(0.0)).otherwise(
        extract_number(txt, LITRES_PATTERN))


def age_from_year(c: str | Column, base_year: int = 2026) -> Column:
    """``base_year - year``."""
    return F.lit(base_year) - _c(c)
