"""Text, pair and number functions as Spark columns."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any kind, in a form that Java's and RE2's regular expressions read alike.
SPACES = r"[\t\n\x0B\f\r\p{Z}]+"
# What stands for true in a label; fixed values.
TRUE_WORDS = ("true", "yes", "t", "y", "1", "match")


def normalize_text(c: Column) -> Column:
    """Outer white space removed, inner runs as one space, letter case kept. Null and empty give null."""
    return F.nullif(F.trim(F.regexp_replace(c, SPACES, " ")), F.lit(""))


def trimmed(c: Column) -> Column:
    """Without outer white space of any kind; empty gives null."""
    return F.nullif(F.regexp_replace(c, f"^{SPACES}|{SPACES}$", ""), F.lit(""))


def ascii_form(c: Column) -> Column:
    """One question mark for each character outside ASCII, so that engines that count bytes and engines that count characters agree."""
    return F.regexp_replace(c, r"[^\x00-\x7F]", "?")


def hash_key(c: Column) -> Column:
    """Identity of a string: md5 of its normalized, lower-cased form."""
    return F.md5(F.lower(normalize_text(c)))


def truthy(c: Column) -> Column:
    """True for the words of TRUE_WORDS in any case; null stays null."""
    return F.lower(F.trim(F.regexp_replace(c, SPACES, " "))).isin(*TRUE_WORDS)


def pair_id(a: Column, b: Column) -> Column:
    """The same for either order of the two ids."""
    return F.concat_ws("|", F.least(a, b), F.greatest(a, b))


def levenshtein_similarity(a: Column, b: Column) -> Column:
    """1 - distance / longer length; 1 for two empty texts, null if either is null."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when(longer == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longer)


def similar_enough(a: Column, b: Column, least: float = 0.3) -> Column:
    """Whether two names are at least so similar; false for two empty ones."""
    return F.coalesce((F.greatest(F.length(a), F.length(b)) > 0) & (levenshtein_similarity(a, b) >= least), F.lit(False))


def sorted_tokens(c: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(c, SPACES), lambda t: t != "")), " ")


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a word of bits at a time (Hyyrö's bit-parallel method)."""
    places: dict[str, int] = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def token_sort_similarity(a: Column, b: Column) -> Column:
    """2 * LCS / total length of the texts with sorted tokens (indel similarity); 1 for two empty texts. Arrow batches."""

    @F.pandas_udf("double")
    def indel(x: pd.Series, y: pd.Series) -> pd.Series:
        seen: dict[tuple[str, str], float] = {}
        out = []
        for p in zip(x, y, strict=True):
            if p[0] is None or p[1] is None:
                out.append(None)
                continue
            if p not in seen:
                whole = len(p[0]) + len(p[1])
                seen[p] = 2 * common_subsequence(*p) / whole if whole else 1.0
            out.append(seen[p])
        return pd.Series(out, dtype="float64")

    return indel(sorted_tokens(a), sorted_tokens(b))


def jaro_winkler(a: str, b: str, scale: float = 0.1) -> float:
    """Jaro similarity raised by the common start of up to four letters, where it is above 0.7."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken = [False] * len(b)
    from_a = []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == x:
                taken[j] = True
                from_a.append(x)
                break
    m = len(from_a)
    if not m:
        return 0.0
    from_b = [y for y, t in zip(b, taken, strict=True) if t]
    swapped = sum(x != y for x, y in zip(from_a, from_b, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    start = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return jaro + min(start, 4) * scale * (1 - jaro) if jaro > 0.7 else jaro


def jaro_winkler_similarity(a: Column, b: Column) -> Column:
    """Null if either is null. Arrow batches."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else jaro_winkler(p, q) for p, q in zip(x, y, strict=True)], dtype="float64")

    return run(a, b)


def harmonic(x: Column, y: Column) -> Column:
    return F.when((x > 0) & (y > 0), F.try_divide(2 * x * y, x + y)).otherwise(0.0)


def capped_ratio(x: Column, y: Column, most: float = 10.0) -> Column:
    return F.when(y > 0, F.least(F.try_divide(x, y), F.lit(most))).otherwise(0.0)


def finite(c: Column) -> Column:
    """NaN as 0 and infinities as +-1e10."""
    return F.when(F.isnan(c), 0.0).when(c == float("inf"), 1e10).when(c == float("-inf"), -1e10).otherwise(c)


def tenth(c: Column) -> Column:
    """Rounded to tenths, half to even."""
    return F.bround(c * 10) / 10


def name_uuid(c: Column) -> Column:
    """Version 5 UUID of a text in the DNS namespace."""
    digest = F.sha1(F.concat(F.unhex(F.lit("6ba7b8109dad11d180b400c04fd430c8")), F.encode(c, "UTF-8")))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    part = lambda a, n: F.substring(digest, a, n)
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two float arrays; 0 if either is empty or of length 0, null if either is null or their sizes differ."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(F.size(a) == F.size(b), F.coalesce(F.try_divide(dot(a, b), norm), F.lit(0.0)))


def percent(share: Column, digits: int = 2) -> Column:
    """A share as text, such as 12.50 %; null stays null."""
    return F.concat(F.format_number(share * 100, digits), F.lit(" %"))
