"""Candidates classified and clustered, reports on the results, and upkeep of the index, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.functions.text import trimmed
from kinfold.operators import classify, graph, ingest, knn, pairs, quality
from kinfold.plans import imputation_queries as imputation
from kinfold.plans import ingest_queries as base
from kinfold.plans import matching_queries as matching
from kinfold.plans.tables import table
from kinfold.scratch import Scratch

#: Members that a cluster must have to be kept; candidates whose probability makes an edge.
LEAST_MEMBERS, EDGE = 3, 0.9
#: Stages in the order of a run; fixed values.
STAGES = ("signup", "login", "view", "click", "purchase")
#: The confusion counts that a run is compared with; fixed values.
EXPECTED = {"tn": 11596, "fp": 43, "fn": 46, "tp": 11575}
NOTHING = "[no value]"


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "candidate_pairs").select(trimmed(F.col("record1_id")).alias("a"), trimmed(F.col("record2_id")).alias("b"))
    return p.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.least("a", "b").alias("left_id"), F.greatest("a", "b").alias("right_id")).distinct()


def _candidate_features(spark: SparkSession, d: str) -> DataFrame:
    both = pairs.with_records(_candidates(spark, d), matching._record_texts(spark, d, plain=True), "record_id")
    return Scratch(spark, "candidate-features").save(pairs.pair_features(both, token_sort=False))


def candidate_features(spark: SparkSession, d: str) -> DataFrame:
    """The features of every candidate pair whose records are known."""
    return _candidate_features(spark, d).select("pair_id", *[F.round(f, 6).alias(f) for f in pairs.FEATURES])


def _classified(spark: SparkSession, d: str) -> DataFrame:
    return classify.score(_candidate_features(spark, d), matching.WEIGHTS, matching.INTERCEPT, matching.THRESHOLD).withColumn("probability", F.round("probability", 9))


def classified_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Every candidate pair with the probability of a match and the decision."""
    return _classified(spark, d).select("pair_id", F.round("probability", 6).alias("probability"), "prediction")


def candidate_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Clusters of the candidates that are matches, of at least so many members."""
    scored = _classified(spark, d)
    edges = graph.build_edges(scored, "left_id", "right_id", "probability", EDGE)
    return quality.large_enough(graph.connected_components(edges, "src", "dst"), "component", LEAST_MEMBERS)


def entity_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The members of the cluster of one entity: the smallest id that has a match."""
    groups = Scratch(spark, "lookup").save(matching.connected_components(spark, d))
    asked = groups.agg(F.min("id").alias("id"))
    return quality.cluster_of(groups, "id", "component", asked)


def pr_area(spark: SparkSession, d: str) -> DataFrame:
    a = classify.precision_recall_area(matching._scored(spark, d))
    return a.select("points", F.round("area", 6).alias("area"), F.round("mean_precision", 6).alias("mean_precision"))


def misclassified_stats(spark: SparkSession, d: str) -> DataFrame:
    s = matching._scored(spark, d)
    wrong = classify.misclassified(s).groupBy("kind").agg(F.count(F.lit(1)).alias("pairs"), F.round(F.avg("probability"), 6).alias("mean_probability"))
    total = s.agg(F.count(F.lit(1)).alias("all"))
    return wrong.crossJoin(F.broadcast(total)).select("kind", "pairs", "mean_probability", F.round(F.col("pairs") / F.col("all"), 6).alias("share"))


def confusion_expected(spark: SparkSession, d: str) -> DataFrame:
    """The counts of the decision beside the expected ones, with their differences."""
    return classify.against_expected(classify.confusion(matching._scored(spark, d)), EXPECTED)


def coefficient_importance(spark: SparkSession, d: str) -> DataFrame:
    model = spark.createDataFrame([*matching.WEIGHTS.items(), ("intercept", matching.INTERCEPT)], "feature string, coefficient double")
    return classify.coefficient_importance(model).select("feature", *[F.round(c, 6).alias(c) for c in ("importance", "share", "largest", "smallest", "mean", "std")])


def selected_features(spark: SparkSession, d: str) -> DataFrame:
    """The five features that go best with the label, with their statistics, joined by name."""
    f = matching._features(spark, d)
    best = quality.label_correlations(f, pairs.FEATURES, "label").withColumn("importance", F.round("importance", 6)).orderBy(F.desc("importance"), "feature").limit(5)
    return best.join(quality.describe(f, pairs.FEATURES), "feature").select("feature", "importance", F.round("mean", 6).alias("mean"), F.round("q50", 6).alias("q50"))


def feature_ranges(spark: SparkSession, d: str) -> DataFrame:
    return quality.ranges(matching._features(spark, d), pairs.FEATURES).select("feature", *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std")])


def imputed_counts(spark: SparkSession, d: str) -> DataFrame:
    """Missing and filled cells of each field."""
    f = imputation.p4_filled(spark, d)
    return f.groupBy("field_type").agg(F.count_if(F.col("filled") | F.col("hash").isNull()).alias("missing"), F.count_if("filled").alias("imputed"))


def objects_with_defaults(spark: SparkSession, d: str) -> DataFrame:
    """Every hash of a field with its text or a placeholder, and its vector or one of zeros."""
    keys = table(spark, d, "field_hash_mapping").where("hash IS NOT NULL").select("hash", "field_type").distinct()
    strings = table(spark, d, "unique_strings_by_field").where("hash IS NOT NULL").groupBy("hash", "field_type").agg(F.min("value").alias("value"))
    vectors = table(spark, d, "vectors").where("v IS NOT NULL AND size(v) = 64").groupBy("hash", F.col("field").alias("field_type")).agg(F.min("v").alias("v"))
    o = ingest.with_defaults(keys, strings, vectors, ["hash", "field_type"], NOTHING, 64)
    return o.select("hash", "field_type", "value", F.size("v").alias("dimensions"), F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + F.abs(x)), 4).alias("weight"))


def merged_objects(spark: SparkSession, d: str) -> DataFrame:
    """What the first index run wrote, with what the others wrote put over it by key."""
    rows = table(spark, d, "unique_strings_by_field").where("hash IS NOT NULL").select("hash", "field_type", "value", "frequency", "index_run").distinct()
    first = rows.agg(F.min("index_run")).first()[0]
    old, new = rows.where(F.col("index_run") <= F.lit(first)), rows.where(F.col("index_run") > F.lit(first))
    return ingest.merge_by_key(old, new, ["hash", "field_type"], ["index_run", "frequency"]).select("hash", "field_type", "frequency", "index_run")


def table_inspection(spark: SparkSession, d: str) -> DataFrame:
    """What the delivered table holds, column by column."""
    return quality.inspect(table(spark, d, "catalog_records").select("personid", *ingest.FIELDS))


def stage_report(spark: SparkSession, d: str) -> DataFrame:
    """Events as stages in their fixed order, unknown ones last."""
    e = table(spark, d, "events").groupBy(F.col("event_type").alias("stage")).agg(F.count(F.lit(1)).alias("records"))
    return quality.in_stage_order(e, "stage", STAGES)


def ranked_field_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Fields by their number of values, the largest first."""
    t = table(spark, d, "field_hash_mapping").where("hash IS NOT NULL").select("hash", "field_type", "n", "batch_no").distinct().groupBy("field_type").agg(F.sum("n").alias("total"), F.count_distinct("hash").alias("distinct_values"))
    return quality.placed(t, "total", "field_type")


def imputation_cross_field(spark: SparkSession, d: str) -> DataFrame:
    """For every composite vector the person value whose own vector is nearest, from the 20 nearest of at least 0.3: how a record without a person finds one."""
    top = knn.exact_top_k(matching._vectors(spark, d, "composite"), matching._vectors(spark, d, "person"), "id", "v", 20).where(F.col("similarity") >= 0.3)
    best = top.where("rank = 1")
    return best.select(F.col("query").alias("composite"), F.col("item").alias("person"), F.round("similarity", 6).alias("similarity"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        candidate_features, classified_candidates, candidate_clusters, entity_lookup, pr_area, misclassified_stats, confusion_expected, coefficient_importance, selected_features, feature_ranges,
        imputed_counts, objects_with_defaults, merged_objects, table_inspection, stage_report, ranked_field_statistics, imputation_cross_field,
    )
}

# ---- SQL ----

_PAIRS = f"truth AS (SELECT DISTINCT least(l, r) AS left_id, greatest(l, r) AS right_id, NULL::INT AS label FROM (SELECT {base._T('record1_id')} AS l, {base._T('record2_id')} AS r FROM candidate_pairs) WHERE l IS NOT NULL AND r IS NOT NULL AND l <> r)"
_FEATURES, _SCORED = (x.replace(matching._TRUTH, _PAIRS) for x in (matching._FEATURES, matching._SCORED))
_MATCHED = (
    _SCORED.replace("WITH ", "WITH RECURSIVE ", 1)[:-1]
    + f", near AS (SELECT string_split(pair_id, '|')[1] AS node, string_split(pair_id, '|')[2] AS other FROM scored WHERE probability >= {EDGE} UNION SELECT string_split(pair_id, '|')[2], string_split(pair_id, '|')[1] FROM scored WHERE probability >= {EDGE}), "
    + matching._reached("groups", "near")
)
_MODEL = ", ".join(f"('{f}', {w}::DOUBLE)" for f, w in matching.WEIGHTS.items())
_INSPECTED = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values, min(length({c})) AS shortest, max(length({c})) AS longest FROM catalog_records" for c in ("personid", *ingest.FIELDS))

SQL: dict[str, str] = {
    "candidate_features": _FEATURES + "SELECT pair_id, " + ", ".join(f"round({f}, 6) AS {f}" for f in pairs.FEATURES) + " FROM features",
    "classified_candidates": _SCORED + "SELECT pair_id, round(probability, 6) AS probability, prediction FROM scored",
    "candidate_clusters": _MATCHED + f" SELECT id, component FROM groups QUALIFY count(*) OVER (PARTITION BY component) >= {LEAST_MEMBERS}",
    "entity_lookup": matching._GRAPH + "SELECT g.id, g.component FROM groups g WHERE g.component = (SELECT arg_min(component, id) FROM groups)",
    "pr_area": matching._CURVE[:-1]
    + """, points AS (SELECT threshold, tp / (tp + fp) AS precision, coalesce(tp / nullif(p, 0), 0) AS recall FROM curve),
  steps AS (SELECT *, recall - lag(recall, 1, 0) OVER w AS width, precision + lag(precision, 1, 1) OVER w AS height FROM points WINDOW w AS (ORDER BY threshold DESC))
  SELECT count(*) AS points, round(sum(width * height / 2), 6) AS area, round(avg(precision), 6) AS mean_precision FROM steps""",
    "misclassified_stats": matching._SCORED + "SELECT CASE WHEN label = 1 THEN 'false_negative' ELSE 'false_positive' END AS kind, count(*) AS pairs, round(avg(probability), 6) AS mean_probability, round(count(*) / (SELECT count(*) FROM scored), 6) AS share FROM scored WHERE label <> prediction GROUP BY 1",
    "confusion_expected": matching._COUNTS + " UNION ALL ".join(f"SELECT '{c}' AS cell, {n}::BIGINT AS expected, {c} AS actual, {c} - {n}::BIGINT AS difference FROM counts" for c, n in EXPECTED.items()),
    "coefficient_importance": f"WITH m AS (SELECT f AS feature, abs(c) AS importance FROM (VALUES {_MODEL}) x(f, c)) SELECT feature, round(importance, 6) AS importance, round(importance / sum(importance) OVER (), 6) AS share, round(max(importance) OVER (), 6) AS largest, round(min(importance) OVER (), 6) AS smallest, round(avg(importance) OVER (), 6) AS mean, round(stddev_pop(importance) OVER (), 6) AS std FROM m",
    "selected_features": matching._IMPORTANCE[:-1] + ", best AS (SELECT feature, round(importance, 6) AS importance FROM importance ORDER BY round(importance, 6) DESC, feature LIMIT 5) SELECT b.feature, b.importance, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS q50 FROM best b JOIN long l ON l.feature = b.feature GROUP BY b.feature, b.importance",
    "feature_ranges": matching._LONG + "SELECT coalesce(feature, 'all') AS feature, round(min(value), 6) AS min, round(max(value), 6) AS max, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM long GROUP BY GROUPING SETS ((feature), ())",
    "imputed_counts": imputation._CELLS + "SELECT field_type, count(*) AS missing, count(*) FILTER (EXISTS (SELECT 1 FROM met m WHERE m.record_id = c.record_id AND m.field_type = c.field_type)) AS imputed FROM cells c WHERE hash IS NULL GROUP BY field_type",
    "objects_with_defaults": f"""WITH keys AS (SELECT DISTINCT hash, field_type FROM field_hash_mapping WHERE hash IS NOT NULL),
  s AS (SELECT hash, field_type, min(value) AS value FROM unique_strings_by_field WHERE hash IS NOT NULL GROUP BY ALL),
  v AS (SELECT hash, field AS field_type, min(v)::DOUBLE[] AS v FROM vectors WHERE v IS NOT NULL AND len(v) = 64 GROUP BY ALL)
  SELECT k.hash, k.field_type, coalesce(s.value, '{NOTHING}') AS value, 64 AS dimensions, round(coalesce(list_sum(list_transform(v.v, lambda x: abs(x))), 0), 4) AS weight
  FROM keys k LEFT JOIN s ON s.hash = k.hash AND s.field_type = k.field_type LEFT JOIN v ON v.hash = k.hash AND v.field_type = k.field_type""",
    "merged_objects": "SELECT hash, field_type, frequency, index_run FROM (SELECT *, row_number() OVER (PARTITION BY hash, field_type ORDER BY index_run DESC, frequency DESC NULLS LAST) AS place FROM (SELECT DISTINCT hash, field_type, frequency, index_run FROM unique_strings_by_field WHERE hash IS NOT NULL)) WHERE place = 1",
    "table_inspection": _INSPECTED,
    "stage_report": "SELECT stage, records, row_number() OVER (ORDER BY CASE stage " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(STAGES)) + " ELSE 99 END, stage) AS place FROM (SELECT event_type AS stage, count(*) AS records FROM events GROUP BY event_type)",
    "ranked_field_statistics": "SELECT *, row_number() OVER (ORDER BY total DESC, field_type) AS place FROM (SELECT field_type, sum(n)::BIGINT AS total, count(DISTINCT hash) AS distinct_values FROM (SELECT DISTINCT hash, field_type, n, batch_no FROM field_hash_mapping WHERE hash IS NOT NULL) GROUP BY field_type)",
    "imputation_cross_field": matching._TOP.format(items=matching._VECTORS.format("person"), queries=matching._VECTORS.format("composite"), k=20) + "SELECT query AS composite, item AS person, round(similarity, 6) AS similarity FROM top WHERE rank = 1 AND similarity >= 0.3",
}
