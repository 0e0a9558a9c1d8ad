"""Lookups, checks and small reports, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.functions.text import ascii_form, cosine, jaro_winkler_similarity
from kinfold.operators import graph, ingest, pairs, quality
from kinfold.plans import ingest_queries as base
from kinfold.plans import matching_queries as matching
from kinfold.plans.tables import table


def candidate_lookup(spark: SparkSession, d: str) -> DataFrame:
    """All candidates of the record that has most of them."""
    p = table(spark, d, "candidate_pairs").where("record1_id IS NOT NULL")
    top = p.groupBy("record1_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "record1_id").first()
    return p.where(F.col("record1_id") == F.lit(top["record1_id"] if top else None)).select("record1_id", "record2_id", "record1_hash", "record2_hash", F.round("similarity", 6).alias("similarity"))


def vector_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The vector of the smallest (hash, field) by its keys: both filters reach the scan."""
    v = table(spark, d, "vectors").where("v IS NOT NULL")
    first = v.agg(F.min(F.struct("hash", "field")).alias("k")).first()["k"]
    found = v.where((F.col("hash") == first["hash"]) & (F.col("field") == first["field"])) if first else v.limit(0)
    return found.groupBy("hash", "field").agg(F.min("v").alias("v")).select("hash", "field", F.size("v").alias("dimensions"), F.array_join(F.transform("v", lambda x: F.format_string("%.4f", x.cast("double"))), " ").alias("vector"))


def index_completion(spark: SparkSession, d: str) -> DataFrame:
    """Share of each field's strings that have a vector, and whether at least 90 % do."""
    r = base.index_reconciliation(spark, d).where(F.col("field").isin(*ingest.EMBEDDED))
    share = F.coalesce(F.try_divide(F.col("embedded"), F.col("indexed")), F.lit(0.0))
    return r.select("field", "indexed", "embedded", (F.col("indexed") - F.col("embedded")).alias("missing"), F.round(share, 6).alias("share"), (share >= 0.9).alias("complete"))


def entity_coverage(spark: SparkSession, d: str) -> DataFrame:
    clustered = matching.connected_components(spark, d).agg(F.count(F.lit(1)).alias("clustered"))
    total = table(spark, d, "record_field_hashes").agg(F.count_distinct("record_id").alias("records"))
    return clustered.crossJoin(F.broadcast(total)).select("clustered", "records", F.round(F.coalesce(F.try_divide("clustered", "records"), F.lit(0.0)), 6).alias("coverage"))


def size_histogram(spark: SparkSession, d: str) -> DataFrame:
    return quality.cluster_sizes(matching.connected_components(spark, d), "component").groupBy("size").agg(F.count(F.lit(1)).alias("clusters")).orderBy("size")


def label_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    """Positives and negatives as delivered, as canonical pairs, and as pairs of known records."""
    count = lambda df, c, s: df.agg(F.count_if(F.col(c) == 1).alias("positives"), F.count_if(F.col(c) == 0).alias("negatives")).select(F.lit(s).alias("source"), "positives", "negatives")
    raw = table(spark, d, "labelled_pairs").select(base.truthy(F.col("is_match")).cast("int").alias("m"))
    truth = matching.ground_truth(spark, d).select("left_id", "right_id", F.col("match").cast("int").alias("m"))
    known = pairs.with_records(truth, base.records(spark, d).select("record_id", "person"), "record_id")
    return count(raw, "m", "delivered").unionByName(count(truth, "m", "canonical")).unionByName(count(known, "m", "known"))


def class_distribution(spark: SparkSession, d: str) -> DataFrame:
    t = matching.ground_truth(spark, d).groupBy("match").agg(F.count(F.lit(1)).alias("n"))
    return quality.share_of_total(t, "n").select("match", "n", F.round("share", 6).alias("share"))


def confusion_differences(spark: SparkSession, d: str) -> DataFrame:
    """Counts at the two usual thresholds side by side."""
    s = matching._scored(spark, d)
    at = lambda t: matching.classify.confusion(s.withColumn("prediction", (F.col("probability") >= t).cast("int")))
    long = lambda df, n: df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("cell"), F.col(c).alias(n)) for c in ("tp", "fp", "tn", "fn")])).alias("x")).select("x.*")
    return long(at(0.55), "at_55").join(long(at(0.90), "at_90"), "cell").withColumn("difference", F.col("at_90") - F.col("at_55"))


def prefilter_summary(spark: SparkSession, d: str) -> DataFrame:
    return matching.prefilter_decisions(spark, d).groupBy("decision", "label").agg(F.count(F.lit(1)).alias("n"))


def top_importance(spark: SparkSession, d: str) -> DataFrame:
    """The five features that go with the label most."""
    return matching.label_correlation(spark, d).orderBy(F.desc("importance"), "feature").limit(5)


def batch_staleness(spark: SparkSession, d: str) -> DataFrame:
    """Batches whose last change is over 24 hours before the newest."""
    b = table(spark, d, "catalog_records").groupBy("batch_no").agg(F.max("changed_at").alias("last"), F.count(F.lit(1)).alias("rows"))
    newest = b.agg(F.max("last").alias("newest"))
    hours = (F.unix_micros("newest") - F.unix_micros("last")) / 3.6e9
    return b.crossJoin(F.broadcast(newest)).select("batch_no", "rows", F.date_format("last", "yyyy-MM-dd HH:mm:ss").alias("last_change"), (hours > 24).alias("stale"))


def cluster_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges with both ends in a cluster of more than five members."""
    groups = matching.connected_components(spark, d)
    large = quality.cluster_sizes(groups, "component").where("size > 5")
    members = groups.join(large, "component", "left_semi").select("id")
    e = matching._edges(spark, d)
    return e.join(members.toDF("src"), "src", "left_semi").join(members.toDF("dst"), "dst", "left_semi").select("src", "dst")


def processed_keys(spark: SparkSession, d: str) -> DataFrame:
    """Set operations over the hashes of records and of the index: in either, both, or one only."""
    r = table(spark, d, "record_field_hashes").where("person IS NOT NULL").select(F.col("person").alias("hash"))
    v = table(spark, d, "vectors").where("field = 'person' AND v IS NOT NULL").select("hash")
    n = lambda df, s: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(s).alias("set"), "n")
    return n(r.union(v).distinct(), "union").unionByName(n(r.intersect(v), "intersection")).unionByName(n(r.exceptAll(v).distinct().join(v, "hash", "left_anti"), "records_only")).unionByName(n(v.distinct().join(r, "hash", "left_anti"), "vectors_only"))


def hash_field_map(spark: SparkSession, d: str) -> DataFrame:
    """Each hash with its fields and counts in one cell, as the nested export has it."""
    c = base.field_hash_counts(spark, d)
    entries = F.array_sort(F.collect_list(F.struct("field", "n")))
    return c.groupBy("hash").agg(F.array_join(F.transform(entries, lambda e: F.concat(e["field"], F.lit("="), e["n"].cast("string"))), ",").alias("fields"))


def value_lengths(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "unique_strings_by_field").where("value IS NOT NULL").select("hash", "field_type", "value").distinct()
    return x.groupBy("field_type").agg(F.count(F.lit(1)).alias("n"), F.min(F.length("value")).alias("shortest"), F.max(F.length("value")).alias("longest"), F.round(F.avg(F.length("value")), 6).alias("mean"))


def jaro_winkler_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The true Jaro-Winkler similarity, as an additional feature, on ASCII forms."""
    a, b = ascii_form(F.col("a")), ascii_form(F.col("b"))
    return base._label_texts(spark, d).select("l", "r", F.round(jaro_winkler_similarity(a, b), 6).alias("similarity"))


def cosine_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The true cosine of composite vectors of labelled pairs, as an additional feature."""
    v = table(spark, d, "vectors").where("field = 'composite' AND v IS NOT NULL").groupBy("hash").agg(F.min("v").alias("v"))
    r = table(spark, d, "record_field_hashes").where("composite IS NOT NULL").select("record_id", F.col("composite").alias("hash")).distinct().join(v, "hash")
    side = lambda s: r.select(F.col("record_id").alias(f"{s}_id"), F.col("v").alias(f"{s}_v"))
    p = matching.ground_truth(spark, d).join(side("left"), "left_id").join(side("right"), "right_id")
    return p.select("left_id", "right_id", "match", F.round(cosine(F.col("left_v"), F.col("right_v")), 6).alias("cosine"))


def candidate_labels(spark: SparkSession, d: str) -> DataFrame:
    """Candidates with the label of their pair, whichever way round it was labelled."""
    t = lambda c: base.trimmed(F.col(c)).alias(c)
    c = table(spark, d, "candidate_pairs").select(t("record1_id"), t("record2_id")).where("record1_id IS NOT NULL AND record2_id IS NOT NULL").distinct()
    return pairs.label_of(c, matching.ground_truth(spark, d), "record1_id", "record2_id").groupBy("match").agg(F.count(F.lit(1)).alias("n"))


def transitive_components(spark: SparkSession, d: str) -> DataFrame:
    """Closing wedges changes no component: components with and without the closing edges."""
    e = matching._edges(spark, d)
    closed = e.unionByName(graph.transitive_edges(e, 0.85))
    n = lambda x, s: graph.connected_components(x, "src", "dst").agg(F.count_distinct("component").alias("components"), F.count(F.lit(1)).alias("nodes")).select(F.lit(s).alias("graph"), "components", "nodes")
    return n(e, "edges").unionByName(n(closed, "closed"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        candidate_lookup, vector_lookup, index_completion, entity_coverage, size_histogram, label_diagnostics, class_distribution, confusion_differences, prefilter_summary, top_importance, batch_staleness,
        cluster_edges, processed_keys, hash_field_map, value_lengths, jaro_winkler_pairs, cosine_pairs, candidate_labels, transitive_components,
    )
}

_M = matching
_LABEL = f"(lower(trim(regexp_replace(is_match, '{base._SPACE}', ' ', 'g'))) IN ({', '.join(repr(w) for w in base.TRUE_WORDS)}))"

SQL: dict[str, str] = {
    "candidate_lookup": "SELECT record1_id, record2_id, record1_hash, record2_hash, round(similarity, 6) AS similarity FROM candidate_pairs WHERE record1_id = (SELECT record1_id FROM candidate_pairs WHERE record1_id IS NOT NULL GROUP BY record1_id ORDER BY count(*) DESC, record1_id LIMIT 1)",
    "vector_lookup": "SELECT hash, field, len(min(v)) AS dimensions, array_to_string(list_transform(min(v), lambda x: printf('%.4f', x::DOUBLE)), ' ') AS vector FROM vectors WHERE v IS NOT NULL GROUP BY ALL ORDER BY hash, field LIMIT 1",
    "index_completion": f"WITH r AS ({base.SQL['index_reconciliation']}) SELECT field, indexed, embedded, indexed - embedded AS missing, round(coalesce(embedded / nullif(indexed, 0), 0), 6) AS share, coalesce(embedded / nullif(indexed, 0), 0) >= 0.9 AS complete FROM r WHERE field <> 'roles'",
    "entity_coverage": _M._GRAPH + "SELECT clustered, records, round(clustered / records, 6) AS coverage FROM (SELECT count(*) AS clustered FROM groups), (SELECT count(DISTINCT record_id) AS records FROM record_field_hashes)",
    "size_histogram": _M._SIZE + "SELECT size, count(*) AS clusters FROM sizes GROUP BY size",
    "label_diagnostics": f"WITH {base.RECORDS_SQL}, {_M._TRUTH} SELECT 'delivered' AS source, count(*) FILTER ({_LABEL}) AS positives, count(*) FILTER (NOT {_LABEL}) AS negatives FROM labelled_pairs UNION ALL SELECT 'canonical', count(*) FILTER (label = 1), count(*) FILTER (label = 0) FROM truth UNION ALL SELECT 'known', count(*) FILTER (label = 1), count(*) FILTER (label = 0) FROM truth WHERE left_id IN (SELECT record_id FROM latest) AND right_id IN (SELECT record_id FROM latest)",
    "class_distribution": f"WITH {_M._TRUTH} SELECT label = 1 AS match, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM truth GROUP BY label",
    "confusion_differences": _M._SCORED[:-1] + ", c AS (" + " UNION ALL ".join(f"SELECT '{n}' AS cell, count(*) FILTER (label = {y} AND (probability >= 0.55) = {p}) AS at_55, count(*) FILTER (label = {y} AND (probability >= 0.90) = {p}) AS at_90 FROM scored" for n, y, p in (("tp", 1, "true"), ("fp", 0, "true"), ("tn", 0, "false"), ("fn", 1, "false"))) + ") SELECT cell, at_55, at_90, at_90 - at_55 AS difference FROM c",
    "prefilter_summary": f"SELECT decision, label, count(*) AS n FROM ({_M.SQL['prefilter_decisions']}) GROUP BY ALL",
    "top_importance": _M._IMPORTANCE + "SELECT feature, round(importance, 6) AS importance FROM importance ORDER BY round(importance, 6) DESC, feature LIMIT 5",
    "batch_staleness": "WITH b AS (SELECT batch_no, max(changed_at) AS last, count(*) AS rows FROM catalog_records GROUP BY batch_no) SELECT batch_no, rows, strftime(last, '%Y-%m-%d %H:%M:%S') AS last_change, (epoch_us((SELECT max(last) FROM b)) - epoch_us(last)) / 3.6e9 > 24 AS stale FROM b",
    "cluster_edges": _M._SIZE + "SELECT e.src, e.dst FROM edges e JOIN groups g ON g.id = e.src JOIN sizes s ON s.component = g.component WHERE s.size > 5",
    "processed_keys": "WITH r AS (SELECT DISTINCT person AS hash FROM record_field_hashes WHERE person IS NOT NULL), v AS (SELECT DISTINCT hash FROM vectors WHERE field = 'person' AND v IS NOT NULL) SELECT 'union' AS set, count(*) AS n FROM (FROM r UNION FROM v) UNION ALL SELECT 'intersection', count(*) FROM (FROM r INTERSECT FROM v) UNION ALL SELECT 'records_only', count(*) FROM (FROM r EXCEPT FROM v) UNION ALL SELECT 'vectors_only', count(*) FROM (FROM v EXCEPT FROM r)",
    "hash_field_map": base._CELLS + "SELECT hash, string_agg(field || '=' || n, ',' ORDER BY field) AS fields FROM (SELECT hash, field, count(*) AS n FROM cells WHERE hash IS NOT NULL GROUP BY ALL) GROUP BY hash",
    "value_lengths": "SELECT field_type, count(*) AS n, min(length(value))::INT AS shortest, max(length(value))::INT AS longest, round(avg(length(value)), 6) AS mean FROM (SELECT DISTINCT hash, field_type, value FROM unique_strings_by_field WHERE value IS NOT NULL) GROUP BY field_type",
    "jaro_winkler_pairs": base._LABEL_TEXTS + "SELECT l, r, round(jaro_winkler_similarity(a, b), 6) AS similarity FROM sides",
    "cosine_pairs": f"WITH {_M._TRUTH}, v AS (SELECT hash, min(v)::DOUBLE[] AS v FROM vectors WHERE field = 'composite' AND v IS NOT NULL GROUP BY hash), r AS (SELECT DISTINCT record_id, v.v FROM record_field_hashes JOIN v ON v.hash = composite) SELECT left_id, right_id, label = 1 AS match, round(list_cosine_similarity(a.v, b.v), 6) AS cosine FROM truth JOIN r a ON a.record_id = left_id JOIN r b ON b.record_id = right_id",
    "candidate_labels": f"WITH {_M._TRUTH}, c AS (SELECT DISTINCT a, b FROM (SELECT {base._T('record1_id')} AS a, {base._T('record2_id')} AS b FROM candidate_pairs) WHERE a IS NOT NULL AND b IS NOT NULL) SELECT label = 1 AS match, count(*) AS n FROM c LEFT JOIN truth ON left_id = least(a, b) AND right_id = greatest(a, b) GROUP BY ALL",
    "transitive_components": _M._SIZE + "SELECT unnest(['edges', 'closed']) AS graph, components, nodes FROM (SELECT count(*) AS components, sum(size)::BIGINT AS nodes FROM sizes)",
}
