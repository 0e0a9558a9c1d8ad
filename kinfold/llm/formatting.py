"""Duplicates hidden by formatting: dictionary-encoded parts, compact integer tuples, one group per tuple."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.operators.skew import lookup_join
from kinfold.scratch import Scratch


def canonical(c: Column) -> Column:
    """Letters and digits only, without letter case; the sharp s, of which the upper case is SS, is ss."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "ß", "ss"), r"[^\p{L}\p{N}]+", "")


def formatting_groups(values: DataFrame, group: list[str], key: str, value: str, split_when: Column, separator: str = "|", only_repeated: bool = False) -> DataFrame:
    """(group..., key, group_key, copies): every key with the smallest key of the values that differ from its own in formatting only.

    Values are the same if they agree in all letters and digits, disregarding case; where `split_when` holds, the parts
    between `separator` may come in any order and empty parts do not count. `copies` is the number of keys in the group.
    Rows repeated unchanged count once; several values of one key count by the smallest. Values that are null or have no
    letter or digit come out with null group_key and copies 0. With `only_repeated`, keys without a copy are left out.
    Parts are canonicalised once per distinct part, given an integer, and records are compared as sorted integer
    tuples under a row number, so that keys and texts are moved once. An empty table gives an empty result.
    """
    scratch = Scratch(values.sparkSession, "formatting")
    single = values.where(F.col(key).isNotNull()).groupBy(*group, key).agg(F.min(value).alias("__value"))
    single = scratch.save(single.withColumn("__row", F.monotonically_increasing_id()))
    pieces = F.when(split_when, F.split("__value", "\\" + separator if separator in "|.*+?^$()[]{}\\" else separator)).otherwise(F.array("__value"))
    # a trimmed part is what repeats among records; its canonical form is computed once per distinct part
    parts = single.select("__row", F.explode(pieces).alias("__part")).withColumn("__part", F.trim("__part")).where("length(__part) > 0")
    forms = scratch.save(parts.select("__part").distinct().select("__part", canonical(F.col("__part")).alias("__form")).where("__form <> ''").withColumn("__n", F.monotonically_increasing_id()))
    numbered = forms.groupBy("__form").agg(F.min("__n").alias("__id"))
    dictionary = scratch.save(lookup_join(forms.select("__part", "__form"), numbered, ["__form"], "__part", how="inner").select("__part", "__id"))
    coded = lookup_join(parts, dictionary, ["__part"], "__row", how="inner")
    tuples = coded.groupBy("__row").agg(F.array_sort(F.collect_list("__id")).alias("__tuple")).join(single.select("__row", *group), "__row")
    tuples = scratch.save(tuples)
    groups = tuples.groupBy(*group, "__tuple").agg(F.min("__row").alias("__group"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    several = scratch.save(lookup_join(tuples, groups, [*group, "__tuple"], "__row", how="inner").select("__row", "__group", "copies").join(single.select("__row", *group, key), "__row"))
    smallest = several.groupBy("__group").agg(F.min(key).alias("group_key"))
    found = lookup_join(several, smallest, ["__group"], "__row").select("__row", *group, key, "group_key", "copies")
    if only_repeated:
        return found.drop("__row")
    has = tuples.select("__row", F.lit(True).alias("__has"))
    rest = single.select("__row", *group, key).join(found.select("__row"), "__row", "left_anti").join(has, "__row", "left")
    rest = rest.select(*group, key, F.when(F.col("__has"), F.col(key)).alias("group_key"), F.when(F.col("__has"), 1).otherwise(0).cast("bigint").alias("copies"))
    return found.drop("__row").unionByName(rest)
