"""Years of birth and death in names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shapes of years in names that can decide, in the order in which they are tried; fixed values. Y is a year, A a word for "about".
_Y, _A, _DASH = r"([0-9]{2,4}(?:\?|\s+or\s+[0-9]{1,4})?)", r"(?:approximately|ca\.|circa)", r"\s*[-–—]"
PATTERNS = (
    rf"{_Y}{_DASH}\s*{_A}\s+{_Y}",
    rf"{_A}\s+{_Y}{_DASH}\s*{_Y}",
    rf"{_Y}{_DASH}\s*{_Y}",
    rf"[-–—]\s*{_A}\s+{_Y}",
    rf"[-–—]\s*{_Y}",
    rf"{_A}\s+{_Y}{_DASH}",
    rf"{_Y}{_DASH}",
    rf"(?:b\.|born)\s+(?:{_A}\s+)?{_Y}|(?:d\.|died)\s+(?:{_A}\s+)?{_Y}",
    rf"{_A}\s+{_Y}",
    rf"(?:fl\.|floruit)\s+{_Y}",
)
_TWO = {0, 1, 2}
_WORDS = 7


def _year(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, "[0-9]+", 0), F.lit("")).cast("int")


def birth_death(name: Column, mode: str = "compat") -> Column:
    """Struct (birth, death) of the first pattern found in the name.

    With mode="compat" a single year is assigned by what else the name holds: "born" or "b." make it the birth, else "died",
    "d." or a hyphen the death, else "fl." or "floruit" the birth, else nothing; a year found behind "d." is not read.
    With mode="fixed" the pattern itself decides: a year before a dash is the birth, one behind a dash or "d." the death, and
    one behind "b.", "fl." or alone behind "about" the birth. Null, and names without years, give two nulls.
    """
    low = F.lower(name)
    nothing = F.struct(F.lit(None).cast("int").alias("birth"), F.lit(None).cast("int").alias("death"))
    pair = lambda b, d: F.struct(b.alias("birth"), d.alias("death"))
    none = F.lit(None).cast("int")
    out = None
    for k, p in enumerate(PATTERNS):
        one = F.nullif(_year(F.regexp_extract(name, p, 1)), F.lit(0))
        if k in _TWO:
            found = pair(one, F.nullif(_year(F.regexp_extract(name, p, 2)), F.lit(0)))
        elif mode == "fixed":
            found = pair(none, one) if k in (3, 4) else pair(one, _year(F.regexp_extract(name, p, 2))) if k == _WORDS else pair(one, none)
        else:
            found = F.when(low.contains("born") | low.contains("b."), pair(one, none)).when(low.contains("died") | low.contains("d.") | low.contains("-"), pair(none, one)).when(low.contains("fl.") | low.contains("floruit"), pair(one, none)).otherwise(nothing)
        out = F.when(name.rlike(p), found) if out is None else out.when(name.rlike(p), found)
    return out.otherwise(nothing)


def has_years(years: Column) -> Column:
    return years["birth"].isNotNull() | years["death"].isNotNull()


def has_both_years(years: Column) -> Column:
    return years["birth"].isNotNull() & years["death"].isNotNull()


def name_without_years(name: Column) -> Column:
    """The name without years, emptied brackets and a trailing comma."""
    for p in PATTERNS:
        name = F.regexp_replace(name, p, "")
    name = F.regexp_replace(name, r"\([\s\p{Z}]*[0-9?]*[\s\p{Z}]*\)", "")
    name = F.regexp_replace(name, r"[\s\p{Z},]+$", "")
    return F.trim(F.regexp_replace(name, r"[\s\p{Z}]+", " "))
