"""Nearest-neighbour hot-deck imputation: missing cells are copied from the closest records of the same block."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.operators.skew import lookup_join
from kinfold.scratch import Scratch

#: Ranges of a block's values for its median.
RANGES = 64

# Texts that state no value once everything but letters and digits is left out; fixed values.
VACUOUS = ("", "na", "nan", "nil", "null", "none", "sn", "sl", "slsn", "slsnsd", "nd", "sd", "unknown", "notavailable", "notapplicable", "notgiven", "notstated", "notspecified", "unspecified", "unstated", "unidentified", "undetermined", "missing", "empty", "nodata", "novalue", "tbd")

# Words of longer texts without a statement: such a text has a word of denial and one of what is denied, and no word besides these.
_DENIAL = "no|not|none|nor|without|lacking|missing|unknown|unidentified|unspecified|unstated|undetermined|unassigned|unavailable|unrecorded"
_DENIED = "places?|publications?|publishers?|publishing|published|distributions?|distributors?|manufacture|manufacturers?|production|producers?|printers?|printing|imprints?|provisions?|dates?|names?|locations?|subjects?|headings?|topics?|terms?|keywords?|descriptors?|statements?|information|details|entry|entries|identified|identifiable|assigned|given|stated|specified|available|known|determined|provided|supplied|found|recorded|indicated|applicable|present|listed|entered"
_FILLING = "of|and|or|the|a|an|any|for|in|on|to|is|are|was|were|has|have|been|yet|here|this|item|record"
_DENYING = rf"^(?=.*\b({_DENIAL})\b)(?=.*\b({_DENIED})\b)(({_DENIAL}|{_DENIED}|{_FILLING})( |$))+$"


def states_nothing(c: Column) -> Column:
    """True for null and for texts such as "-", "N/A", "[s.n.]", "unknown" or "[Publisher not identified]"."""
    words = F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))
    return F.coalesce(F.replace(words, F.lit(" "), F.lit("")).isin(*VACUOUS) | words.rlike(_DENYING), F.lit(True))


def hot_deck(df: DataFrame, record: str, target: str, levels: list[list[str | Column]], weight: str | None = None, numeric: bool = False) -> DataFrame:
    """(record, value, filled, donors, donor_level) for every record.

    A record without `target` gets the value of its closest donors. Closeness is by agreement on observed features:
    `levels` lists the feature sets from the strictest to the widest block, and donors of the first level that has any
    are the closest. The donors' majority value by weight is copied (the smallest value where several weigh the same),
    or with numeric=True their weighted lower median. `donors` counts the donors behind a filled value (0 where nothing
    was filled) and `donor_level` is the number of the level. A null feature matches nothing. Records without donor keep null.

    Donors are aggregated by block and value before anything is joined, so a block with a third of all records costs one
    row for each distinct value in it; records of such a block are spread over tasks for the lookup.
    """
    scratch = Scratch(df.sparkSession, "hot-deck")
    base = _base(df, record, target, levels, weight, scratch)
    out = base.select("__record", "__value").join(_votes(base, levels, numeric), "__record", "left")
    filled = F.col("__v").isNotNull()
    return out.select(F.col("__record").alias(record), F.coalesce("__value", "__v").alias("value"), filled.alias("filled"), F.coalesce("__n", F.lit(0).cast("bigint")).alias("donors"), F.col("__level").alias("donor_level"))


def _base(df: DataFrame, record: str, target: str, levels: list[list[str | Column]], weight: str | None, scratch: Scratch) -> DataFrame:
    """Record, value, weight and the features of all levels, saved once: every level reads them."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    return scratch.save(df.select(F.col(record).alias("__record"), F.col(target).alias("__value"), w.alias("__w"), *[_feature(f).alias(f"__f{i}_{j}") for i, level in enumerate(levels) for j, f in enumerate(level)]))


def _votes(base: DataFrame, levels: list[list[str | Column]], numeric: bool, first: int = 0) -> DataFrame:
    """(__record, __level, __v, __n) of the records without a value: the first level with donors from `first` on, their value and their number."""
    hits = None
    for i, level in list(enumerate(levels))[first:]:
        keys = [f"__f{i}_{j}" for j in range(len(level))]
        donors = base.where(F.col("__value").isNotNull() & _present(keys)).groupBy(*keys, "__value").agg(F.sum("__w").alias("__w"), F.count(F.lit(1)).alias("__n"))
        if numeric:
            chosen = _weighted_median(donors, keys)
        else:
            # the smallest among the values of the highest weight
            best = donors.groupBy(*keys).agg(F.max("__w").alias("__top"), F.sum("__n").alias("__all"))
            chosen = donors.join(best, keys).where("__w = __top").groupBy(*keys).agg(F.min("__value").alias("__v"), F.first("__all").alias("__n"))
        lacking = base.where(F.col("__value").isNull()).select("__record", *keys)
        hit = lookup_join(lacking, chosen, keys, "__record", how="inner").select("__record", F.lit(i).alias("__level"), "__v", "__n")
        hits = hit if hits is None else hits.unionByName(hit)
    return hits.groupBy("__record").agg(F.min_by(F.struct("__level", "__v", "__n"), "__level").alias("h")).select("__record", "h.*")


def _present(keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def nearest_hot_deck(df: DataFrame, record: str, target: str, block: list[str], categories: dict[str, float], numbers: dict[str, tuple[float, float]] | None = None, whole_block: bool = False, weight: str | None = None, numeric: bool = False) -> DataFrame:
    """(record, value, filled, donors, distance, donor) for every record: a nearest-neighbour hot-deck within hash blocks.

    Donors of a record without `target` are the records of the same `block` that have one. Their distance is the sum of the weights of
    the mixed features they differ in: `categories` by feature name; `numbers` as (weight, width): in the same bin of `width` 0,
    in the same bin of four times the width half the weight, else all of it. A feature that either lacks counts as different.
    The donors at the smallest distance are the closest, all of them; their majority value by `weight` is copied (the smallest of
    equally heavy ones), or with numeric=True their weighted lower median. With whole_block=True all donors of the block vote.
    `donor` is the closest donor that holds the value copied (the smallest of several) and `distance` its distance; `donors` counts
    those that voted. Records with a value or without a donor have null there; a null block has no donors.

    No two records are compared: every set of features that can agree is a hash block of its own, visited in the order of its distance,
    with donors aggregated by block and value beforehand. So a block with a third of all records costs one row for each of its
    distinct feature values.
    """
    options: list[list[tuple[Column | None, float]]] = [[(F.col(c), 0.0), (None, w)] for c, w in categories.items()]
    options += [[(bin_of(F.col(c), width), 0.0), (bin_of(F.col(c), 4 * width), w / 2), (None, w)] for c, (w, width) in (numbers or {}).items()]
    ways = sorted(product(*options), key=lambda x: sum(cost for _, cost in x))
    levels: list[list[str | Column]] = [[*block, *[c for c, _ in way if c is not None]] for way in ways]
    distances = [sum(cost for _, cost in way) for way in ways]
    scratch = Scratch(df.sparkSession, "hot-deck")
    base = _base(df, record, target, levels, weight, scratch)
    # the last level is the whole block
    votes = scratch.save(_votes(base, levels, numeric, first=len(levels) - 1 if whole_block else 0))
    lacking = scratch.save(base.where(F.col("__value").isNull()).drop("__value", "__w").join(votes.select("__record", F.col("__v").alias("__value")), "__record"))
    hits = None
    for i, level in enumerate(levels):
        keys = [f"__f{i}_{j}" for j in range(len(level))]
        donors = base.where(F.col("__value").isNotNull() & _present(keys)).groupBy(*keys, "__value").agg(F.min("__record").alias("__donor"))
        hit = lookup_join(lacking.select("__record", *keys, "__value"), donors, [*keys, "__value"], "__record", how="inner").select("__record", F.lit(i).alias("__at"), F.lit(distances[i]).alias("distance"), "__donor")
        hits = hit if hits is None else hits.unionByName(hit)
    found = hits.groupBy("__record").agg(F.min_by(F.struct("distance", F.col("__donor").alias("donor")), "__at").alias("h")).select("__record", "h.*")
    out = base.select("__record", "__value").join(votes, "__record", "left").join(found, "__record", "left")
    return out.select(F.col("__record").alias(record), F.coalesce("__value", "__v").alias("value"), F.col("__v").isNotNull().alias("filled"), F.coalesce("__n", F.lit(0).cast("bigint")).alias("donors"), "distance", "donor")


def _feature(f: str | Column) -> Column:
    return F.col(f) if isinstance(f, str) else f


def _weighted_median(donors: DataFrame, keys: list[str]) -> DataFrame:
    """The smallest value up to which at least half of the weight lies.

    Values of a block are cut into ranges by approximate quantiles; weights are summed by range, and only the range that holds the
    median is sorted, so a block of a third of all records is in no task as a whole. The result is exact.
    """
    whole = donors.groupBy(*keys).agg(F.sum("__w").alias("__all"), F.sum("__n").alias("__n"), F.percentile_approx("__value", [i / RANGES for i in range(1, RANGES)], 1_000).alias("__bounds"))
    placed = lookup_join(donors.drop("__n"), whole, keys, "__value", how="inner").withColumn("__range", F.size(F.filter("__bounds", lambda x: x < F.col("__value"))))
    per = placed.groupBy(*keys, "__range").agg(F.sum("__w").alias("__sum"), F.first("__all").alias("__whole"))
    # at most RANGES rows a block
    upto = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumn("__upto", F.sum("__sum").over(upto)).where(F.col("__upto") * 2 >= F.col("__whole"))
    middle = per.groupBy(*keys).agg(F.min(F.struct("__range", (F.col("__upto") - F.col("__sum")).alias("__before"))).alias("m")).select(*keys, "m.*")
    inside = placed.drop("__bounds").join(middle, [*keys, "__range"])
    along = Window.partitionBy(*keys).orderBy("__value").rowsBetween(Window.unboundedPreceding, 0)
    summed = inside.withColumn("__so_far", F.col("__before") + F.sum("__w").over(along))
    return summed.where(F.col("__so_far") * 2 >= F.col("__all")).groupBy(*keys).agg(F.min("__value").alias("__v"), F.first("__n").alias("__n"))


def bin_of(c: Column, width: float) -> Column:
    """A numeric feature as the number of its bin, so that near values block together."""
    return F.floor(c / F.lit(width))
