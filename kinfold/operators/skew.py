"""Joins and rankings that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A key is hot from this share of the rows on, so there are at most 1 / HOT_SHARE hot keys to broadcast.
HOT_SHARE = 1 / 200
_SPREAD = 4096


def lookup_join(big: DataFrame, small: DataFrame, key: list[str], scatter: str, how: str = "left", hot_share: float = HOT_SHARE) -> DataFrame:
    """Adds the columns of `small` (unique by `key`) to each row of `big`, without putting a hot key into one task.

    Keys with at least `hot_share` of the rows of `big` are found by a pre-aggregated count; there are at most
    1 / hot_share of them, so their rows of `small` are broadcast whatever the size of the data. All other rows are
    joined by shuffle; rows of hot keys pass that shuffle scattered by the column `scatter`.
    Null keys match nothing: they are kept with nulls for how="left" and left out for how="inner".
    Columns of `small` other than the key must not occur in `big`.
    """
    values = [c for c in small.columns if c not in key]
    counts = big.where(_all_present(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n").alias("__total"))
    hot_keys = counts.crossJoin(F.broadcast(total)).where(F.col("__n") >= F.col("__total") * hot_share).select(*key)
    small = small.where(_all_present(key))
    hot = small.join(F.broadcast(hot_keys), key, "inner").select(*key, F.struct(F.lit(1).alias("__one"), *values).alias("__hot"))
    scattered = F.pmod(F.xxhash64(F.col(scatter)), F.lit(_SPREAD)).cast("int") + 1
    marked = big.join(F.broadcast(hot), key, "left").withColumn(
        "__salt", F.when(F.col("__hot").isNotNull() | ~_all_present(key), scattered).otherwise(F.lit(0))
    )
    # null keys would all hash alike: give them a salt as well, which matches nothing
    rest = small.select(*key, F.lit(0).alias("__salt"), F.struct(F.lit(1).alias("__one"), *values).alias("__found"))
    joined = marked.join(rest, [*key, "__salt"], "left").withColumn("__found", F.coalesce("__hot", "__found"))
    if how == "inner":
        joined = joined.where(F.col("__found").isNotNull())
    return joined.select(*[F.col(c) for c in big.columns], *[F.col(f"__found.{c}").alias(c) for c in values])


def _all_present(key: list[str]) -> Column:
    out = F.lit(True)
    for k in key:
        out = out & F.col(k).isNotNull()
    return out


def ranked(df: DataFrame, group: list[str], order: list[str], rank: str = "rank", running: tuple[str, str] | None = None, rows_per_bucket: int = 50_000, total: int | None = None) -> DataFrame:
    """Ranks the rows of each group from 0 on, in an order given by a hash of `order`, without a task per group.

    Each group is cut into ranges of the hash; only counts and sums of the ranges are accumulated over the whole group,
    and rows are ranked within their range. The number of ranges follows the number of rows, so a range holds about
    `rows_per_bucket` rows even if one group holds all rows. `running=(column, name)` adds the sum of the column over
    the rows before. `order` must identify a row; ties of the hash are broken by it.
    """
    n = df.count() if total is None else total
    buckets = max(1, -(-n // rows_per_bucket))
    keyed = df.withColumn("__h", F.xxhash64(*order)).withColumn("__b", F.pmod(F.shiftrightunsigned(F.col("__h"), 20), F.lit(buckets)))
    add = running[0] if running else None
    sums = keyed.groupBy(*group, "__b").agg(F.count(F.lit(1)).alias("__n"), (F.sum(add) if add else F.lit(0)).alias("__s"))
    before = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)],
        F.col("__b").alias("__bb"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n0"),
        F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__s0"),
    )
    same = F.col("__b") == F.col("__bb")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    inside = Window.partitionBy(*group, "__b").orderBy("__h", *order)
    out = keyed.withColumn("__r", F.row_number().over(inside) - 1)
    if add:
        out = out.withColumn("__c", F.coalesce(F.sum(add).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = out.join(offsets, same, "inner").withColumn(rank, F.col("__n0") + F.col("__r"))
    if add:
        out = out.withColumn(running[1], F.col("__s0") + F.col("__c"))
    return out.select(*df.columns, rank, *([running[1]] if running else []))
