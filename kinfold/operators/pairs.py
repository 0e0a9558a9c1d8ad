"""Record pairs: labels, prefilters and the features of a pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.text import capped_ratio, harmonic, levenshtein_similarity, pair_id, similar_enough, token_sort_similarity, truthy
from kinfold.functions.years import birth_death, has_years

# Names of the features, in their order; fixed values.
FEATURES = (
    "person_cosine", "title_cosine", "provision_cosine", "subjects_cosine", "composite_cosine", "person_levenshtein", "person_jaro_winkler",
    "person_title_harmonic", "person_provision_harmonic", "person_subjects_harmonic", "title_subjects_harmonic", "title_provision_harmonic", "provision_subjects_harmonic",
    "person_subjects_product", "composite_subjects_ratio", "birth_year_match", "death_year_match", "has_birth_death_years",
)
_HARMONIC = (("person", "title"), ("person", "provision"), ("person", "subjects"), ("title", "subjects"), ("title", "provision"), ("provision", "subjects"))
_TEXTS = ("person", "title", "provision", "subjects", "composite")


def ground_truth(labels: DataFrame, left: str, right: str, match: str, order: list[str] | None = None) -> DataFrame:
    """(left_id, right_id, match) with left_id <= right_id, one row a pair; the last by `order` wins, a match where nothing orders them. Rows without both ids or a label are left out."""
    a, b = F.trim(left), F.trim(right)
    rows = labels.select(F.least(a, b).alias("left_id"), F.greatest(a, b).alias("right_id"), truthy(F.col(match)).alias("match"), *(order or []))
    rows = rows.where((F.trim(F.coalesce(a, F.lit(""))) != "") & (F.trim(F.coalesce(b, F.lit(""))) != "") & F.col("match").isNotNull())
    return rows.groupBy("left_id", "right_id").agg(F.max_by("match", F.struct(*(order or []), "match")).alias("match"))


def with_years(records: DataFrame, person: str = "person") -> DataFrame:
    """Adds `years` (birth, death) of each record's person, so that a pair need not search names again."""
    return records.withColumn("years", birth_death(F.col(person)))


def with_records(pairs: DataFrame, records: DataFrame, record: str) -> DataFrame:
    """Both records' columns as left_* and right_*; pairs of which a record is unknown are left out."""
    side = lambda s: records.select(F.col(record).alias(f"{s}_id"), *[F.col(c).alias(f"{s}_{c}") for c in records.columns if c != record])
    return pairs.join(side("left"), "left_id").join(side("right"), "right_id")


def label_of(pairs: DataFrame, truth: DataFrame, one: str, two: str) -> DataFrame:
    """Adds `match` from the ground truth whichever order the pair is in."""
    keyed = pairs.withColumn("left_id", F.least(one, two)).withColumn("right_id", F.greatest(one, two))
    return keyed.join(truth, ["left_id", "right_id"], "left").drop("left_id", "right_id")


def prefilter(least_person: float = 0.3, years: bool = False) -> Column:
    """With years=True the records bring their years (`with_years`). true, false or null (undecided) for a row of `with_records`: the same dated person; equal composites; persons too unlike. Null texts decide nothing."""
    same_person = (F.col("left_person") == F.col("right_person")) & has_years(F.col("left_years") if years else birth_death(F.col("left_person")))
    unlike = F.col("left_person").isNotNull() & F.col("right_person").isNotNull() & ~similar_enough(F.col("left_person"), F.col("right_person"), least_person)
    return F.when(same_person, True).when(F.col("left_composite") == F.col("right_composite"), True).when(unlike, False)


def similarities(pairs: DataFrame, token_sort: bool = True) -> DataFrame:
    """Adds <field>_sim for the texts of a pair: 1 for equal texts, null if either is missing.

    Persons are compared by edit distance, the other fields by token-sort similarity (with token_sort=False by edit
    distance as well, which needs no Python). Equal texts do not reach the Python stage.
    """
    out = pairs
    for f in _TEXTS:
        a, b = F.col(f"left_{f}"), F.col(f"right_{f}")
        differ = a.isNotNull() & b.isNotNull() & (a != b)
        if f == "person" or not token_sort:
            sim = levenshtein_similarity(a, b)
        else:
            sim = token_sort_similarity(F.when(differ, a), F.when(differ, b))
        out = out.withColumn(f"__{f}", sim).withColumn(f"{f}_sim", F.when(a == b, 1.0).when(differ, F.col(f"__{f}"))).drop(f"__{f}")
    return out


def pair_features(pairs: DataFrame, token_sort: bool = True) -> DataFrame:
    """The 18 features of each pair; records may bring their years (`with_years`). A missing side makes a similarity, and all that uses it, 0."""
    df = similarities(pairs, token_sort)
    jaro = token_sort_similarity(F.col("left_person"), F.col("right_person")) if token_sort else F.col("person_sim")
    df = df.withColumn("__jaro", jaro)
    for s in ("left", "right"):
        df = df.withColumn(f"__{s}", F.col(f"{s}_years") if f"{s}_years" in pairs.columns else birth_death(F.col(f"{s}_person")))
    sim = lambda f: F.coalesce(F.col(f"{f}_sim"), F.lit(0.0))
    both = lambda f, g: F.col(f"{f}_sim").isNotNull() & F.col(f"{g}_sim").isNotNull()
    year = lambda y: F.coalesce((F.col(f"__left.{y}") == F.col(f"__right.{y}")).cast("double"), F.lit(0.0))
    columns = {
        **{f"{f}_cosine": sim(f) for f in _TEXTS},
        "person_levenshtein": sim("person"),
        "person_jaro_winkler": F.coalesce("__jaro", F.lit(0.0)),
        **{f"{a}_{b}_harmonic": F.when(both(a, b), harmonic(sim(a), sim(b))).otherwise(0.0) for a, b in _HARMONIC},
        "person_subjects_product": F.when(both("person", "subjects"), sim("person") * sim("subjects")).otherwise(0.0),
        "composite_subjects_ratio": F.when(both("composite", "subjects"), capped_ratio(sim("composite"), sim("subjects"))).otherwise(0.0),
        "birth_year_match": year("birth"),
        "death_year_match": year("death"),
        "has_birth_death_years": (has_years(F.col("__left")) & has_years(F.col("__right"))).cast("double"),
    }
    keep = [c for c in pairs.columns if not c.startswith(("left_", "right_")) or c in ("left_id", "right_id")]
    return df.select(*keep, pair_id(F.col("left_id"), F.col("right_id")).alias("pair_id"), *[columns[f].alias(f) for f in FEATURES])
