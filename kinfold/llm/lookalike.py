"""One consistent form for text that looks the same: embedded DuckDB SQL over the Arrow batches of each partition."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.operators.skew import lookup_join
from kinfold.scratch import Scratch

# Letters of other scripts that look like Latin ones; fixed values.
CYRILLIC = "АВЕЅІЈКМНОРСТУХҮԌԚԜӀаеіѕјорсухһԁԛԝүѵӏ"
CYRILLIC_AS = "ABESIJKMHOPCTYXYGQWIaeisjopcyxhdqwyvl"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαινορυϲϳ"
GREEK_AS = "ABEZHIKMNOPTYXaivopucj"
ARMENIAN = "ՕՍօոսհց"
ARMENIAN_AS = "OUonuhg"
# Composed letters of other scripts that look like composed Latin ones; fixed values.
COMPOSED = "ЁёЇїЀѐӐӑӒӓӖӗӦӧӮӯΆΈΉΊΌΎΪΫάίόϊύϋ"
COMPOSED_AS = "ËëÏïÈèĂăÄäĔĕÖöȲȳÁÉHÍÓÝÏŸáíóïúü"
# Invisible characters, apart from the ranges of bidirectional marks and variation selectors; fixed values.
INVISIBLE = r"[\x{00AD}\x{034F}\x{061C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180E}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{FE00}-\x{FE0F}\x{FEFF}\x{FFF9}-\x{FFFB}\x{E0000}-\x{E007F}\x{E0100}-\x{E01EF}]"
SPACES = r"[\x{0009}-\x{000D}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


# Kinds of compatibility decomposition (Unicode data) whose two sides look the same; superscripts, circles and fractions look different.
_SAME_LOOK = ("<font>", "<wide>", "<narrow>", "<small>", "<square>", "<compat>", "<initial>", "<medial>", "<final>", "<isolated>")


@lru_cache(maxsize=1)
def width_forms() -> tuple[str, str, list[tuple[str, str]]]:
    """Compatibility forms of width, type face, ligatures and the like, of all code points: (characters, their one-letter forms, longer forms)."""
    one, by, longer = [], [], []
    for point in range(0xA0, sys.maxunicode + 1):
        c = chr(point)
        if not unicodedata.decomposition(c).startswith(_SAME_LOOK):
            continue
        form = unicodedata.normalize("NFKC", c)
        # forms with a space show a mark alone; a long s does not look like an s
        if form == c or " " in form or point in (0x17F, 0xFB05):
            continue
        if len(form) == 1:
            one.append(c)
            by.append(form)
        else:
            longer.append((c, form))
    return "".join(one), "".join(by), longer


def _class(characters: str) -> str:
    """A regular expression for any of the characters, as ranges."""
    points = sorted(map(ord, characters))
    starts = [p for i, p in enumerate(points) if not i or points[i - 1] != p - 1]
    ends = [p for i, p in enumerate(points) if i + 1 == len(points) or points[i + 1] != p + 1]
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in zip(starts, ends, strict=True)) + "]"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def normal_form_sql(column: str) -> str:
    """DuckDB expression: compatibility forms, invisible characters and spaces, look-alike letters, composition."""
    one, by, longer = width_forms()
    x = f"regexp_replace({column}, {_quoted(INVISIBLE)}, '', 'g')"
    x = f"regexp_replace({x}, {_quoted(SPACES)}, ' ', 'g')"
    # the long tables are for the few texts with such a character
    longer_map = f"MAP {{{', '.join(f'{_quoted(a)}: {_quoted(b)}' for a, b in longer)}}}"
    widths = [(a, b) for a, b in zip(one, by, strict=True) if "\uff00" <= a <= "\uffff"]
    faces = [(a, b) for a, b in zip(one, by, strict=True) if not "\uff00" <= a <= "\uffff"]
    table = lambda pairs, k: _quoted("".join(p[k] for p in pairs))
    long = f"translate({x}, {table(faces, 0)}, {table(faces, 1)})"
    long = f"array_to_string(list_transform(string_split({long}, ''), lambda c: coalesce({longer_map}[c], c)), '')"
    x = f"CASE WHEN regexp_matches({column}, {_quoted(_class(''.join(a for a, _ in faces + longer)))}) THEN {long} ELSE {x} END"
    x = f"translate({x}, {_quoted(''.join(a for a, _ in widths) + CYRILLIC + GREEK + ARMENIAN)}, {_quoted(''.join(b for _, b in widths) + CYRILLIC_AS + GREEK_AS + ARMENIAN_AS)})"
    x = f"translate(nfc_normalize({x}), {_quoted(COMPOSED)}, {_quoted(COMPOSED_AS)})"
    # plain text needs no more than its spaces
    plain = f"translate({column}, {_quoted(chr(9) + chr(10) + chr(11) + chr(12) + chr(13))}, '     ')"
    return f"CASE WHEN regexp_matches({column}, '[^\\x00-\\x7F]') THEN {x} ELSE {plain} END"


def normalize_text(df: DataFrame, column: str, output: str, memory: str = "256MB") -> DataFrame:
    """Adds `output`, the consistent form of `column`, computed by DuckDB inside the Arrow partitions.

    Width, composition, invisible characters, kinds of space and look-alike letters of other scripts no longer differ;
    letter case, accents, punctuation and spelling do. Null stays null, empty stays empty; an existing column named like
    `output` is replaced.
    """
    df = df.drop(output) if output in df.columns else df
    schema = T.StructType([*df.schema.fields, T.StructField(output, T.StringType())])
    position = df.columns.index(column)
    sql = f"SELECT {normal_form_sql('x')} AS y FROM batch"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        with duckdb.connect(config={"threads": 1, "memory_limit": memory, "preserve_insertion_order": True}) as db:
            for b in batches:
                db.register("batch", pa.table({"x": b.column(position).cast(pa.large_string())}))
                y = db.sql(sql).to_arrow_table().column("y")
                db.unregister("batch")
                y = pa.concat_arrays(y.chunks) if y.num_chunks else pa.array([], pa.string())
                yield pa.RecordBatch.from_arrays([*b.columns, y.cast(pa.string())], names=[*b.schema.names, output])

    return df.mapInArrow(run, schema)


def lookalike_forms(values: DataFrame, group: list[str], key: str, value: str) -> DataFrame:
    """(group..., key, form): the consistent form of each key's value; repeated rows count once."""
    return normalize_text(values.where(F.col(key).isNotNull()).groupBy(*group, key).agg(F.min(value).alias("__value")), "__value", "form").drop("__value")


def lookalike_groups(values: DataFrame, group: list[str], key: str, value: str) -> DataFrame:
    """(group..., key, group_key, copies): the smallest key of those whose values look the same, and how many keys these are.

    The form for scale: one row a key, however many look the same. Null and empty forms are left out.
    """
    scratch = Scratch(values.sparkSession, "lookalike")
    forms = scratch.save(lookalike_forms(values, group, key, value).where("form <> ''"))
    heads = forms.groupBy(*group, "form").agg(F.min(key).alias("group_key"), F.count(F.lit(1)).alias("copies"))
    return lookup_join(forms, heads, [*group, "form"], key).select(*group, key, "group_key", "copies")


def lookalike_pairs(values: DataFrame, group: list[str], key: str, value: str) -> DataFrame:
    """(group..., key1, key2), key1 < key2, for keys whose values look the same.

    Null and empty forms match nothing. Forms are reduced to digests that several keys share before the join, which
    compares the forms themselves; no group is collected.
    """
    scratch = Scratch(values.sparkSession, "lookalike")
    forms = scratch.save(lookalike_forms(values, group, key, value).where("form <> ''").withColumn("digest", F.xxhash64("form")))
    shared = forms.groupBy(*group, "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    several = scratch.save(forms.join(shared, [*group, "digest"], "left_semi"))
    one, two = several.withColumnRenamed(key, "key1"), several.withColumnRenamed(key, "key2")
    return one.join(two, [*group, "digest", "form"]).where("key1 < key2").select(*group, "key1", "key2")
