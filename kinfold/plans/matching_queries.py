"""Neighbours, pairs, features, classification, graph and report queries, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.functions.text import ascii_form, capped_ratio, normalize_text, trimmed
from kinfold.operators import classify, graph, ingest, knn, pairs, quality
from kinfold.plans import ingest_queries as base
from kinfold.plans.tables import table
from kinfold.scratch import Scratch
from kinfold.sources.embedder import embed_strings

#: Weights of the scoring query, by hand; the training query fits its own.
WEIGHTS, INTERCEPT, THRESHOLD = {"person_levenshtein": 6.0, "birth_year_match": 2.0, "death_year_match": 1.0, "composite_cosine": 1.5, "person_title_harmonic": 0.5}, -4.0, 0.55
LEAST_EDGE = 0.9
#: Candidates of a person vector: so many nearest at most, of at least this similarity; as the pipeline's defaults.
NEIGHBOURS, LEAST_SIMILAR = 200, 0.3

# ---- neighbours ----


def _items(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("v"), "label")


def knn_topk(spark: SparkSession, d: str) -> DataFrame:
    x = _items(spark, d)
    return knn.exact_top_k(x, x, "id", "v", 20).select("query", "item", F.round("similarity", 6).alias("similarity"), "rank")


def _vectors(spark: SparkSession, d: str, field: str) -> DataFrame:
    return table(spark, d, "vectors").where((F.col("field") == field) & F.col("v").isNotNull()).groupBy(F.col("hash").alias("id")).agg(F.min("v").alias("v"))


def knn_candidates(spark: SparkSession, d: str) -> DataFrame:
    x = _vectors(spark, d, "person")
    return knn.candidates(knn.exact_top_k(x, x, "id", "v", NEIGHBOURS), LEAST_SIMILAR).withColumn("similarity", F.round("similarity", 6))


def candidate_records(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "record_field_hashes").select("record_id", "person").distinct().where("person IS NOT NULL")
    return knn.record_candidates(knn_candidates(spark, d), r, "record_id", "person")


def candidate_records_all(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "record_field_hashes").select("record_id", "person").distinct().where("person IS NOT NULL")
    return knn.record_candidates(knn_candidates(spark, d), r, "record_id", "person", every=True)


def _subject_neighbours(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Nearest composites with subjects of the composites whose records have none."""
    r = table(spark, d, "record_field_hashes").select("record_id", "composite", "subjects").distinct()
    x = _vectors(spark, d, "composite")
    values = r.where("composite IS NOT NULL AND subjects IS NOT NULL").groupBy(F.col("composite").alias("item")).agg(F.min("subjects").alias("value"))
    queries = x.join(r.where("subjects IS NULL").select(F.col("composite").alias("id")), "id", "left_semi")
    items = x.join(values.select(F.col("item").alias("id")), "id", "left_semi")
    return knn.exact_top_k(queries, items, "id", "v", 10), values


def imputation_nearest(spark: SparkSession, d: str) -> DataFrame:
    top, values = _subject_neighbours(spark, d)
    return knn.impute_nearest(top, values, 0.3).withColumn("similarity", F.round("similarity", 6))


def _label_means(spark: SparkSession, d: str, weighted: bool) -> DataFrame:
    x = _items(spark, d)
    return knn.impute_vector(knn.exact_top_k(x, x, "id", "v", 10), x, "id", "v", 0.3, weighted).withColumn("value", F.round("value", 6))


def imputation_average_vector(spark: SparkSession, d: str) -> DataFrame:
    return _label_means(spark, d, False)


def imputation_weighted_vector(spark: SparkSession, d: str) -> DataFrame:
    return _label_means(spark, d, True)


def embedded_strings(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "unique_strings_by_field").where("field_type = 'title'").select("hash", "value").distinct()
    return embed_strings(x, "hash", "value").select("hash", F.size("v").alias("dimensions"))


def vector_components(spark: SparkSession, d: str) -> DataFrame:
    return quality.principal_components(_items(spark, d), "id", "v")


# ---- pairs and features ----


def _record_texts(spark: SparkSession, d: str, plain: bool) -> DataFrame:
    form = (lambda f: ascii_form(normalize_text(F.col(f)))) if plain else (lambda f: normalize_text(F.col(f)))
    texts = base.records(spark, d).select("record_id", *[form(f).alias(f) for f in ("person", "title", "provision", "subjects", "composite")])
    return Scratch(spark, "records").save(pairs.with_years(texts))


def _truth(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labelled_pairs").select(trimmed(F.col("left_id")).alias("left_id"), trimmed(F.col("right_id")).alias("right_id"), "is_match")
    return pairs.ground_truth(labels, "left_id", "right_id", "is_match")


def _pairs(spark: SparkSession, d: str, plain: bool = True) -> DataFrame:
    return pairs.with_records(_truth(spark, d).withColumn("label", F.col("match").cast("int")).drop("match"), _record_texts(spark, d, plain), "record_id")


def ground_truth(spark: SparkSession, d: str) -> DataFrame:
    return _truth(spark, d)


def prefilter_decisions(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select("left_id", "right_id", "label", pairs.prefilter(years=True).alias("decision"))


def _features(spark: SparkSession, d: str) -> DataFrame:
    """Saved once for each query: what is made of them reads them several times."""
    return Scratch(spark, "features").save(pairs.pair_features(_pairs(spark, d), token_sort=False))


def pair_features_sql(spark: SparkSession, d: str) -> DataFrame:
    """The features with edit distance throughout, on ASCII forms."""
    return _features(spark, d).select("pair_id", "label", *[F.round(f, 6).alias(f) for f in pairs.FEATURES])


def pair_features(spark: SparkSession, d: str) -> DataFrame:
    """The features with token-sort similarities."""
    return pairs.pair_features(_pairs(spark, d, plain=False))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return classify.score(_features(spark, d), WEIGHTS, INTERCEPT, THRESHOLD).withColumn("probability", F.round("probability", 9))


def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    return classify.stratified_split(_features(spark, d).select("pair_id", "label"), "pair_id", "label")


def split_sizes(spark: SparkSession, d: str) -> DataFrame:
    return stratified_split(spark, d).groupBy("label", "part").agg(F.count(F.lit(1)).alias("n"))


def standardized_features(spark: SparkSession, d: str) -> DataFrame:
    scaled = classify.standardize(_features(spark, d).select("pair_id", *pairs.FEATURES), pairs.FEATURES)
    return scaled.select("pair_id", *[F.round(f, 6).alias(f) for f in pairs.FEATURES])


def score_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("pair_id", "label", F.round("probability", 6).alias("probability"), "prediction")


def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    return classify.confusion(_scored(spark, d))


def classification_metrics(spark: SparkSession, d: str) -> DataFrame:
    m = classify.metrics(classify.confusion(_scored(spark, d)))
    return m.select("tp", "fp", "tn", "fn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "accuracy", "fpr", "fnr")])


def roc_curve(spark: SparkSession, d: str) -> DataFrame:
    return classify.roc_curve(_scored(spark, d)).select("threshold", F.round("tpr", 6).alias("tpr"), F.round("fpr", 6).alias("fpr"))


def pr_curve(spark: SparkSession, d: str) -> DataFrame:
    return classify.precision_recall_curve(_scored(spark, d)).select("threshold", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


def roc_auc(spark: SparkSession, d: str) -> DataFrame:
    return classify.roc_auc(_scored(spark, d)).select(F.round("auc", 6).alias("auc"))


def threshold_marker(spark: SparkSession, d: str) -> DataFrame:
    return classify.threshold_marker(roc_curve(spark, d), THRESHOLD)


def misclassified(spark: SparkSession, d: str) -> DataFrame:
    return classify.misclassified(_scored(spark, d)).select("pair_id", "label", "prediction", "kind")


def logistic_train(spark: SparkSession, d: str) -> DataFrame:
    coefficients, intercept = classify.train_logistic(_features(spark, d), pairs.FEATURES, "label")
    return spark.createDataFrame([*zip(pairs.FEATURES, coefficients, strict=True), ("intercept", intercept)], "feature string, coefficient double")


def rfe_select(spark: SparkSession, d: str) -> DataFrame:
    df = _features(spark, d).select("label", *pairs.FEATURES)
    return spark.createDataFrame(classify.select_features(df, pairs.FEATURES, "label", step=1), "feature string, rank int")


def importance_share(spark: SparkSession, d: str) -> DataFrame:
    imp = quality.label_correlations(_features(spark, d), pairs.FEATURES, "label")
    return quality.share_of_total(imp, "importance").select("feature", F.round("importance", 6).alias("importance"), F.round("share", 6).alias("share"))


# ---- feature statistics ----


def feature_describe(spark: SparkSession, d: str) -> DataFrame:
    x = quality.describe(_features(spark, d), pairs.FEATURES)
    return x.select("feature", "count", *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


def feature_correlation(spark: SparkSession, d: str) -> DataFrame:
    return quality.correlations(_features(spark, d), pairs.FEATURES).withColumn("r", F.round("r", 6))


def correlated_pairs(spark: SparkSession, d: str) -> DataFrame:
    return feature_correlation(spark, d).where(F.abs("r") > 0.8)


def label_correlation(spark: SparkSession, d: str) -> DataFrame:
    return quality.label_correlations(_features(spark, d), pairs.FEATURES, "label").withColumn("importance", F.round("importance", 6))


def constant_features(spark: SparkSession, d: str) -> DataFrame:
    return quality.constant_features(_features(spark, d).withColumn("constant_one", F.lit(1.0)), [*pairs.FEATURES, "constant_one"])


def low_variance(spark: SparkSession, d: str) -> DataFrame:
    return quality.low_variance(_features(spark, d).withColumn("constant_one", F.lit(1.0)), [*pairs.FEATURES, "constant_one"])


def non_finite(spark: SparkSession, d: str) -> DataFrame:
    return quality.non_finite(_features(spark, d), pairs.FEATURES)


def outlier_rows(spark: SparkSession, d: str) -> DataFrame:
    return quality.outliers(_features(spark, d), "pair_id", pairs.FEATURES)


def duplicate_vectors(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicate_share(_features(spark, d).select(*[F.round(f, 6).alias(f) for f in pairs.FEATURES]), list(pairs.FEATURES))


# ---- graph ----


def _edges(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "candidate_pairs").select(trimmed(F.col("record1_id")).alias("a"), trimmed(F.col("record2_id")).alias("b"), "similarity")
    return graph.build_edges(p, "a", "b", "similarity", LEAST_EDGE)


def build_edges(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d)


def transitive_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.transitive_edges(_edges(spark, d), 0.85).withColumn("weight", F.round("weight", 6))


def connected_components(spark: SparkSession, d: str) -> DataFrame:
    return graph.connected_components(_edges(spark, d), "src", "dst")


def split_oversize(spark: SparkSession, d: str) -> DataFrame:
    e = _edges(spark, d)
    return graph.split_oversize(graph.connected_components(e, "src", "dst"), e, 10, 0.93)


def degree_distribution(spark: SparkSession, d: str) -> DataFrame:
    return graph.degrees(_edges(spark, d)).groupBy("degree").agg(F.count(F.lit(1)).alias("nodes"))


def weight_histogram(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "candidate_pairs").where("similarity IS NOT NULL").select(F.bround(F.col("similarity").cast("decimal(12,6)") * 10, 0).cast("int").alias("tenths"))
    return w.groupBy("tenths").agg(F.count(F.lit(1)).alias("n"))


def graph_stats(spark: SparkSession, d: str) -> DataFrame:
    s = graph.graph_statistics(_edges(spark, d))
    return s.select("nodes", "edges", "components", *[F.round(c, 9).alias(c) for c in ("density", "average_degree", "average_clustering")])


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    return quality.cluster_sizes(connected_components(spark, d), "component")


def cluster_stats(spark: SparkSession, d: str) -> DataFrame:
    s = quality.cluster_statistics(_sizes(spark, d))
    return s.select("clusters", "members", "smallest", "largest", *[F.round(c, 6).alias(c) for c in ("mean", "std", "q10", "q25", "median", "q75", "q90")], "singletons")


def cluster_size_buckets(spark: SparkSession, d: str) -> DataFrame:
    return quality.size_buckets(_sizes(spark, d))


def largest_clusters(spark: SparkSession, d: str) -> DataFrame:
    """The ten largest."""
    return quality.largest_clusters(_sizes(spark, d), "component")


def anomalous_clusters(spark: SparkSession, d: str) -> DataFrame:
    return _sizes(spark, d).where("size > 50")


def resolve_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Each record belongs to its component and to the bibs it is linked with; one cluster is left for each."""
    e = _edges(spark, d)
    bib = lambda c: F.substring_index(c, "#", 1)
    m = graph.symmetric(e)
    memberships = m.select(F.col("node").alias("id"), bib("other").alias("cluster")).unionByName(m.select(F.col("node").alias("id"), bib("node").alias("cluster"))).distinct()
    return graph.resolve_conflicts(memberships, e)


def adjacency_export(spark: SparkSession, d: str) -> DataFrame:
    """Neighbours with their weights in ten-thousandths."""
    a = graph.adjacency(_edges(spark, d))
    return a.select("node", F.array_join(F.transform(F.map_entries("neighbours"), lambda e: F.concat(e["key"], F.lit(":"), F.floor(e["value"] * 10_000).cast("string"))), ",").alias("neighbours"))


def label_propagation(spark: SparkSession, d: str) -> DataFrame:
    return graph.label_propagation(_edges(spark, d))


def louvain(spark: SparkSession, d: str) -> DataFrame:
    return graph.louvain(_edges(spark, d))


def hierarchical(spark: SparkSession, d: str) -> DataFrame:
    return graph.hierarchical(_edges(spark, d), 0.9)


# ---- reports ----


def data_quality(spark: SparkSession, d: str) -> DataFrame:
    c = base.record_cells(spark, d)
    out = c.where("hash IS NOT NULL").groupBy("field").agg(F.count(F.lit(1)).alias("total"), F.count_distinct("hash").alias("distinct_values"))
    return out.withColumn("unique_percent", F.round(100 * F.col("distinct_values") / F.col("total"), 6))


def stage_throughput(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("one", F.lit(1))
    return quality.throughput(e, "event_type", "one", "ts", "ts").withColumn("per_second", F.round("per_second", 9))


def trailing_batch_mean(spark: SparkSession, d: str) -> DataFrame:
    return quality.trailing_mean(table(spark, d, "events").select("event_id", "user_id", "ts", "value"), "user_id", ["ts", "event_id"], "value").select("event_id", F.round("trailing_mean", 6).alias("trailing_mean"))


def rate_limit_window(spark: SparkSession, d: str) -> DataFrame:
    return quality.rate_window(table(spark, d, "events").select("event_id", "event_type", "ts", "value"), "event_type", "ts", "value").select("event_id", F.round("within_window", 4).alias("within_window"), "events_within")


def interaction_ratios(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d).select("pair_id", F.round(capped_ratio(F.col("composite_cosine"), F.col("subjects_cosine")), 6).alias("ratio"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        knn_topk, knn_candidates, candidate_records, candidate_records_all, imputation_nearest, imputation_average_vector, imputation_weighted_vector, embedded_strings, vector_components,
        ground_truth, prefilter_decisions, pair_features_sql, pair_features, stratified_split, split_sizes, standardized_features, score_pairs, confusion_matrix, classification_metrics, roc_curve, pr_curve, roc_auc,
        threshold_marker, misclassified, logistic_train, rfe_select, importance_share, feature_describe, feature_correlation, correlated_pairs, label_correlation, constant_features, low_variance, non_finite,
        outlier_rows, duplicate_vectors, build_edges, transitive_edges, connected_components, split_oversize, degree_distribution, weight_histogram, graph_stats, cluster_stats, cluster_size_buckets,
        largest_clusters, anomalous_clusters, resolve_conflicts, adjacency_export, label_propagation, louvain, hierarchical, data_quality, stage_throughput, trailing_batch_mean, rate_limit_window, interaction_ratios,
    )
}

# ---- SQL ----

_TOP = """WITH x AS ({items}), q AS ({queries}),
top AS (SELECT * FROM (SELECT q.id AS query, x.id AS item, list_cosine_similarity(q.v, x.v) AS similarity,
  row_number() OVER (PARTITION BY q.id ORDER BY round(list_cosine_similarity(q.v, x.v), 12) DESC, x.id) AS rank FROM q, x) WHERE rank <= {k}) """
_EMBEDDINGS = "SELECT vec_id::VARCHAR AS id, embedding::DOUBLE[] AS v FROM embeddings"
_VECTORS = "SELECT hash AS id, min(v)::DOUBLE[] AS v FROM vectors WHERE field = '{0}' AND v IS NOT NULL GROUP BY hash"
_PERSON_TOP = _TOP.format(items=_VECTORS.format("person"), queries="SELECT * FROM x", k=200)
_CANDIDATES = _PERSON_TOP[:-1] + ", found AS (SELECT query AS hash1, item AS hash2, round(similarity, 6) AS similarity FROM top WHERE similarity >= 0.3 AND query <> item), people AS (SELECT DISTINCT record_id, person FROM record_field_hashes WHERE person IS NOT NULL) "
_SUBJECTS = _TOP.format(
    items=f"SELECT * FROM ({_VECTORS.format('composite')}) WHERE id IN (SELECT composite FROM record_field_hashes WHERE subjects IS NOT NULL)",
    queries=f"SELECT * FROM ({_VECTORS.format('composite')}) WHERE id IN (SELECT composite FROM record_field_hashes WHERE subjects IS NULL)",
    k=10,
)
_MEANS = _TOP.format(items=_EMBEDDINGS, queries="SELECT * FROM x", k=10)[:-1] + ", long AS (SELECT query, similarity AS w, unnest(x.v) AS x, generate_subscripts(x.v, 1) - 1 AS position FROM top JOIN x ON x.id = top.item WHERE similarity >= 0.3) "

_TEXT_FIELDS = ("person", "title", "provision", "subjects", "composite")
_TRUTH = f"truth AS (SELECT left_id, right_id, max(m) AS label FROM (SELECT least(l, r) AS left_id, greatest(l, r) AS right_id, (lower(trim(regexp_replace(is_match, '{base._SPACE}', ' ', 'g'))) IN ({', '.join(repr(w) for w in base.TRUE_WORDS)}))::INT AS m FROM (SELECT {base._T('left_id')} AS l, {base._T('right_id')} AS r, is_match FROM labelled_pairs) WHERE l IS NOT NULL AND r IS NOT NULL AND is_match IS NOT NULL) GROUP BY ALL)"
_LEFT_YEARS, _RIGHT_YEARS = base._years_sql("left_person", False), base._years_sql("right_person", False)
_SIDES = (
    f"WITH {base.RECORDS_SQL}, {_TRUTH}, texts AS (SELECT record_id, {', '.join(f'{base._ASCII(base._N(f))} AS {f}' for f in _TEXT_FIELDS)} FROM latest), "
    + f"raw AS (SELECT t.*, {', '.join(f'{s}.{f} AS {n}_{f}' for s, n in (('a', 'left'), ('b', 'right')) for f in _TEXT_FIELDS)} FROM truth t JOIN texts a ON a.record_id = t.left_id JOIN texts b ON b.record_id = t.right_id), "
    + f"sides AS (SELECT *, {_LEFT_YEARS[0]} AS left_birth, {_LEFT_YEARS[1]} AS left_death, {_RIGHT_YEARS[0]} AS right_birth, {_RIGHT_YEARS[1]} AS right_death FROM raw) "
)
_SIMS = ", sims AS (SELECT *, " + ", ".join(f"CASE WHEN left_{f} = right_{f} THEN 1.0 ELSE {base.SIMILARITY_SQL.format(a=f'left_{f}', b=f'right_{f}')} END::DOUBLE AS {f}_sim" for f in _TEXT_FIELDS) + " FROM sides)"
_H = lambda a, b: f"CASE WHEN {a}_sim > 0 AND {b}_sim > 0 THEN 2 * {a}_sim * {b}_sim / ({a}_sim + {b}_sim) ELSE 0.0 END"
_FEATURE_SQL = {
    **{f"{f}_cosine": f"coalesce({f}_sim, 0.0)" for f in _TEXT_FIELDS},
    "person_levenshtein": "coalesce(person_sim, 0.0)",
    "person_jaro_winkler": "coalesce(person_sim, 0.0)",
    **{f"{a}_{b}_harmonic": _H(a, b) for a, b in pairs._HARMONIC},
    "person_subjects_product": "coalesce(person_sim * subjects_sim, 0.0)",
    "composite_subjects_ratio": "CASE WHEN composite_sim IS NOT NULL AND subjects_sim > 0 THEN least(composite_sim / subjects_sim, 10.0) ELSE 0.0 END",
    "birth_year_match": "coalesce((left_birth = right_birth)::INT, 0)::DOUBLE",
    "death_year_match": "coalesce((left_death = right_death)::INT, 0)::DOUBLE",
    "has_birth_death_years": "((left_birth IS NOT NULL OR left_death IS NOT NULL) AND (right_birth IS NOT NULL OR right_death IS NOT NULL))::INT::DOUBLE",
}
_FEATURES = _SIDES[:-1] + _SIMS + ", features AS (SELECT left_id || '|' || right_id AS pair_id, label, " + ", ".join(f"({_FEATURE_SQL[f]})::DOUBLE AS {f}" for f in pairs.FEATURES) + " FROM sims) "
_Z = " + ".join(f"{w} * {f}" for f, w in WEIGHTS.items())
_SCORED = _FEATURES[:-1] + f", probable AS (SELECT pair_id, label, 1 / (1 + exp(-({INTERCEPT} + {_Z}))) AS p FROM features), scored AS (SELECT pair_id, label, round(p, 9) AS probability, (p >= {THRESHOLD})::INT AS prediction FROM probable) "
_COUNTS = _SCORED[:-1] + ", counts AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp, count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM scored) "
_CURVE = _SCORED[:-1] + ", curve AS (SELECT DISTINCT probability AS threshold, sum(label) OVER w AS tp, sum(1 - label) OVER w AS fp, sum(label) OVER () AS p, sum(1 - label) OVER () AS n FROM scored WINDOW w AS (ORDER BY probability DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) "
_LONG = _FEATURES[:-1] + ", long AS (" + " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS value, label FROM features" for f in pairs.FEATURES) + ") "
_R = "CASE WHEN stddev_pop({a}) > 1e-12 AND stddev_pop({b}) > 1e-12 THEN covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) ELSE 0.0 END"
_CORRELATIONS = _FEATURES[:-1] + ", correlation AS (" + " UNION ALL ".join(f"SELECT '{a}' AS feature1, '{b}' AS feature2, round({_R.format(a=a, b=b)}, 6) AS r FROM features" for i, a in enumerate(pairs.FEATURES) for b in pairs.FEATURES[i + 1 :]) + ") "
_IMPORTANCE = _LONG[:-1] + f", importance AS (SELECT feature, abs({_R.format(a='value', b='label')}) AS importance FROM long GROUP BY feature) "

_EDGES = f"edges AS (SELECT least(a, b) AS src, greatest(a, b) AS dst, max(similarity) AS weight FROM (SELECT {base._T('record1_id')} AS a, {base._T('record2_id')} AS b, similarity FROM candidate_pairs) WHERE a <> b AND similarity >= {LEAST_EDGE} GROUP BY ALL), near AS (SELECT src AS node, dst AS other, weight FROM edges UNION ALL SELECT dst, src, weight FROM edges)"


def _reached(name: str, near: str) -> str:
    return f"{name}_r(id, other) AS (SELECT node, node FROM {near} UNION SELECT n.other, r.other FROM {name}_r r JOIN {near} n ON n.node = r.id WHERE r.other < n.other), {name} AS (SELECT id, min(other) AS component FROM {name}_r GROUP BY id)"


_GRAPH = f"WITH RECURSIVE {_EDGES}, {_reached('groups', 'near')} "
_SIZE = _GRAPH[:-1] + ", sizes AS (SELECT component, count(*) AS size FROM groups GROUP BY component) "
_CUBE = ", ".join(f"round(quantile_cont(size, {q}), 6) AS {n}" for q, n in ((0.1, "q10"), (0.25, "q25"), (0.5, "median"), (0.75, "q75"), (0.9, "q90")))

SQL: dict[str, str] = {
    "knn_topk": _TOP.format(items=_EMBEDDINGS, queries="SELECT * FROM x", k=20) + "SELECT query, item, round(similarity, 6) AS similarity, rank FROM top",
    "knn_candidates": _CANDIDATES + "SELECT hash1, hash2, similarity FROM found",
    "candidate_records": _CANDIDATES + "SELECT a.record_id AS record1_id, hash1 AS record1_hash, hash2 AS record2_hash, similarity, b.record2_id FROM found JOIN people a ON a.person = hash1 LEFT JOIN (SELECT person, min(record_id) AS record2_id FROM people GROUP BY person) b ON b.person = hash2",
    "candidate_records_all": _CANDIDATES + "SELECT a.record_id AS record1_id, hash1 AS record1_hash, hash2 AS record2_hash, similarity, b.record_id AS record2_id FROM found JOIN people a ON a.person = hash1 JOIN people b ON b.person = hash2",
    "imputation_nearest": _SUBJECTS[:-1] + """, value AS (SELECT composite, min(subjects) AS value FROM record_field_hashes WHERE subjects IS NOT NULL GROUP BY composite),
  votes AS (SELECT query, value, count(*) AS votes, min(rank) AS rank, max(similarity) AS similarity FROM top JOIN value ON composite = item WHERE similarity >= 0.3 GROUP BY ALL)
  SELECT query, value, votes, round(similarity, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY votes DESC, rank) AS place FROM votes) WHERE place = 1""",
    "imputation_average_vector": _MEANS + "SELECT query, position, round(avg(x), 6) AS value FROM long GROUP BY ALL",
    "imputation_weighted_vector": _MEANS + "SELECT query, position, round(sum(w * x) / sum(w), 6) AS value FROM long GROUP BY ALL",
    "embedded_strings": "SELECT DISTINCT hash, 64 AS dimensions FROM (SELECT DISTINCT hash, value FROM unique_strings_by_field WHERE field_type = 'title' AND value IS NOT NULL)",
    "ground_truth": f"WITH {_TRUTH} SELECT left_id, right_id, label = 1 AS match FROM truth",
    "prefilter_decisions": _SIDES + f"SELECT left_id, right_id, label, CASE WHEN left_person = right_person AND (left_birth IS NOT NULL OR left_death IS NOT NULL) THEN true WHEN left_composite = right_composite THEN true WHEN left_person IS NOT NULL AND right_person IS NOT NULL AND NOT coalesce({base.SIMILARITY_SQL.format(a='left_person', b='right_person')} >= 0.3, false) THEN false END AS decision FROM sides",
    "pair_features_sql": _FEATURES + "SELECT pair_id, label, " + ", ".join(f"round({f}, 6) AS {f}" for f in pairs.FEATURES) + " FROM features",
    "split_sizes": _FEATURES + "SELECT label, part, n FROM (SELECT label, 'train' AS part, floor(count(*) * 0.7)::BIGINT AS n FROM features GROUP BY label UNION ALL SELECT label, 'test', count(*) - floor(count(*) * 0.7)::BIGINT FROM features GROUP BY label) WHERE n > 0",
    "standardized_features": _FEATURES + "SELECT pair_id, " + ", ".join(f"round(({f} - avg({f}) OVER ()) / CASE WHEN stddev_pop({f}) OVER () > 1e-12 THEN stddev_pop({f}) OVER () ELSE 1.0 END, 6) AS {f}" for f in pairs.FEATURES) + " FROM features",
    "score_pairs": _SCORED + "SELECT pair_id, label, round(probability, 6) AS probability, prediction FROM scored",
    "confusion_matrix": _COUNTS + "SELECT * FROM counts",
    "classification_metrics": _COUNTS[:-1] + ", m AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall FROM counts) SELECT tp, fp, tn, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 6) AS f1, round(coalesce((tp + tn) / nullif(tp + fp + tn + fn, 0), 0), 6) AS accuracy, round(coalesce(fp / nullif(fp + tn, 0), 0), 6) AS fpr, round(coalesce(fn / nullif(fn + tp, 0), 0), 6) AS fnr FROM m",
    "roc_curve": _CURVE + "SELECT threshold, round(coalesce(tp / nullif(p, 0), 0), 6) AS tpr, round(coalesce(fp / nullif(n, 0), 0), 6) AS fpr FROM curve",
    "pr_curve": _CURVE + "SELECT threshold, round(tp / (tp + fp), 6) AS precision, round(coalesce(tp / nullif(p, 0), 0), 6) AS recall FROM curve",
    "roc_auc": _SCORED + "SELECT round(coalesce(avg(CASE WHEN a.probability > b.probability THEN 1.0 WHEN a.probability = b.probability THEN 0.5 ELSE 0.0 END), 0), 6) AS auc FROM scored a JOIN scored b ON a.label = 1 AND b.label = 0",
    "threshold_marker": _CURVE + f"SELECT threshold, round(coalesce(tp / nullif(p, 0), 0), 6) AS tpr, round(coalesce(fp / nullif(n, 0), 0), 6) AS fpr FROM curve ORDER BY abs(threshold - {THRESHOLD}), threshold LIMIT 1",
    "misclassified": _SCORED + "SELECT pair_id, label, prediction, CASE WHEN label = 1 THEN 'false_negative' ELSE 'false_positive' END AS kind FROM scored WHERE label <> prediction",
    "importance_share": _IMPORTANCE + "SELECT feature, round(importance, 6) AS importance, round(coalesce(importance / nullif(sum(importance) OVER (), 0), 0), 6) AS share FROM importance",
    "feature_describe": _LONG + "SELECT feature, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75, round(max(value), 6) AS max FROM long GROUP BY feature",
    "feature_correlation": _CORRELATIONS + "SELECT * FROM correlation",
    "correlated_pairs": _CORRELATIONS + "SELECT * FROM correlation WHERE abs(r) > 0.8",
    "label_correlation": _IMPORTANCE + "SELECT feature, round(importance, 6) AS importance FROM importance",
    "constant_features": _LONG + "SELECT feature FROM (SELECT feature, value FROM long UNION ALL SELECT 'constant_one', 1.0 FROM features) GROUP BY feature HAVING min(value) = max(value)",
    "low_variance": _LONG + "SELECT feature, stddev_pop(value) AS std, max(value) - min(value) AS range FROM (SELECT feature, value FROM long UNION ALL SELECT 'constant_one', 1.0 FROM features) GROUP BY feature HAVING stddev_pop(value) < 0.01 AND max(value) - min(value) < 0.1",
    "non_finite": _LONG + "SELECT feature, count(*) FILTER (isnan(value)) AS nan_values, count(*) FILTER (isinf(value)) AS infinite_values FROM long GROUP BY feature",
    "outlier_rows": _FEATURES[:-1] + ", z AS (SELECT pair_id, " + " + ".join(f"coalesce((abs({f} - avg({f}) OVER ()) > 3 * nullif(CASE WHEN stddev_samp({f}) OVER () > 1e-12 THEN stddev_samp({f}) OVER () END, 0))::INT, 0)" for f in pairs.FEATURES) + " AS outlying FROM features) SELECT pair_id, outlying FROM z WHERE outlying > 0",
    "duplicate_vectors": _FEATURES + "SELECT sum(n)::BIGINT AS rows, count(*) AS distinct_rows, round(1 - count(*) / sum(n), 6) AS duplicate_share FROM (SELECT count(*) AS n FROM (SELECT " + ", ".join(f"round({f}, 6) AS {f}" for f in pairs.FEATURES) + " FROM features) GROUP BY " + ", ".join(pairs.FEATURES) + ")",
    "build_edges": f"WITH {_EDGES} SELECT src, dst, weight FROM edges",
    "transitive_edges": f"WITH {_EDGES} SELECT x.other AS src, y.other AS dst, round(max(x.weight * y.weight), 6) AS weight FROM near x JOIN near y ON x.node = y.node AND x.other < y.other LEFT JOIN edges e ON e.src = x.other AND e.dst = y.other WHERE x.weight * y.weight >= 0.85 AND e.src IS NULL GROUP BY ALL",
    "connected_components": _GRAPH + "SELECT id, component FROM groups",
    "split_oversize": _SIZE[:-1] + f", large AS (SELECT g.id FROM groups g JOIN sizes s USING (component) WHERE s.size > 10), inner_near AS (SELECT n.* FROM near n JOIN large l ON l.id = n.node WHERE n.weight >= 0.93), {_reached('parts', 'inner_near')} SELECT g.id, CASE WHEN l.id IS NULL THEN g.component ELSE coalesce(p.component, g.id) END AS component FROM groups g LEFT JOIN large l ON l.id = g.id LEFT JOIN parts p ON p.id = g.id",
    "degree_distribution": f"WITH {_EDGES} SELECT degree, count(*) AS nodes FROM (SELECT node, count(*) AS degree FROM near GROUP BY node) GROUP BY degree",
    "weight_histogram": "SELECT round_even(similarity::DECIMAL(12, 6) * 10, 0)::INT AS tenths, count(*) AS n FROM candidate_pairs WHERE similarity IS NOT NULL GROUP BY ALL",
    "graph_stats": _SIZE[:-1] + """, degree AS (SELECT node, count(*) AS k FROM near GROUP BY node),
  closed AS (SELECT x.node, count(*) AS t FROM near x JOIN near y ON x.node = y.node AND x.other < y.other JOIN edges e ON e.src = x.other AND e.dst = y.other GROUP BY x.node),
  c AS (SELECT avg(CASE WHEN k > 1 THEN 2 * coalesce(t, 0) / (k * (k - 1)) ELSE 0.0 END) AS a FROM degree LEFT JOIN closed USING (node)), n AS (SELECT count(*) AS nodes FROM degree), m AS (SELECT count(*) AS edges FROM edges), g AS (SELECT count(*) AS components FROM sizes)
  SELECT nodes, edges, components, round(coalesce(2 * edges / nullif(nodes * (nodes - 1), 0), 0), 9) AS density, round(coalesce(2 * edges / nullif(nodes, 0), 0), 9) AS average_degree, round(coalesce(a, 0), 9) AS average_clustering FROM n, m, g, c""",
    "cluster_stats": _SIZE + f"SELECT count(*) AS clusters, sum(size)::BIGINT AS members, min(size) AS smallest, max(size) AS largest, round(avg(size), 6) AS mean, round(stddev_pop(size), 6) AS std, {_CUBE}, count(*) FILTER (size = 1) AS singletons FROM sizes",
    "cluster_size_buckets": _SIZE + "SELECT CASE WHEN size <= 1 THEN '1' WHEN size <= 5 THEN '2-5' WHEN size <= 10 THEN '6-10' WHEN size <= 20 THEN '11-20' WHEN size <= 50 THEN '21-50' ELSE '51+' END AS bucket, count(*) AS clusters, sum(size)::BIGINT AS members FROM sizes GROUP BY ALL",
    "largest_clusters": _SIZE + "SELECT component, size FROM sizes ORDER BY size DESC, component LIMIT 10",
    "anomalous_clusters": _SIZE + "SELECT component, size FROM sizes WHERE size > 50",
    "resolve_conflicts": f"WITH {_EDGES}, m AS (SELECT node AS id, string_split(other, '#')[1] AS cluster FROM near UNION SELECT node, string_split(node, '#')[1] FROM near), several AS (SELECT id FROM m GROUP BY id HAVING count(*) > 1), pull AS (SELECT n.node AS id, m.cluster, round(avg(n.weight), 12) AS pull FROM near n JOIN several s ON s.id = n.node JOIN m ON m.id = n.other GROUP BY ALL) SELECT id, cluster FROM (SELECT m.id, m.cluster, row_number() OVER (PARTITION BY m.id ORDER BY coalesce(p.pull, 0) DESC, m.cluster) AS place FROM m LEFT JOIN pull p ON p.id = m.id AND p.cluster = m.cluster) WHERE place = 1",
    "adjacency_export": f"WITH {_EDGES} SELECT node, string_agg(other || ':' || floor(weight * 10000)::BIGINT, ',' ORDER BY other) AS neighbours FROM near GROUP BY node",
    "data_quality": base._RECORD_CELLS + "SELECT field, count(*) AS total, count(DISTINCT hash) AS distinct_values, round(100 * count(DISTINCT hash) / count(*), 6) AS unique_percent FROM cells WHERE hash IS NOT NULL GROUP BY field",
    "stage_throughput": "SELECT event_type, count(*) AS records, epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6 AS seconds, round(coalesce(count(*) / nullif((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 0), 0), 9) AS per_second FROM events GROUP BY event_type",
    "trailing_batch_mean": "SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS trailing_mean FROM events",
    "rate_limit_window": "SELECT event_id, round(sum(value) OVER w, 4) AS within_window, count(*) OVER w AS events_within FROM events WINDOW w AS (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 60000000 PRECEDING AND CURRENT ROW)",
    "interaction_ratios": _FEATURES + "SELECT pair_id, round(CASE WHEN subjects_cosine > 0 THEN least(composite_cosine / subjects_cosine, 10.0) ELSE 0.0 END, 6) AS ratio FROM features",
}
