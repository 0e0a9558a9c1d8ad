"""The training-data queries pN_... and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.components import match_groups
from kinfold.llm.formatting import formatting_groups
from kinfold.llm.lookalike import lookalike_forms, lookalike_groups, lookalike_pairs
from kinfold.llm.mixing import mix
from kinfold.llm.names import name_entities, name_pairs
from kinfold.llm.neighbours import top_k
from kinfold.llm.packing import container_report, pack
from kinfold.llm.splitting import split_documents
from kinfold.llm.terms import banded, term_counts
from kinfold.llm.tokens import VOCABULARY, with_sizes
from kinfold.operators.knn import exact_top_k
from kinfold.operators.pairs import ground_truth
from kinfold.plans.tables import table
from kinfold.scratch import Scratch

#: Tokens of a container, of a piece and of the overlap between pieces.
CAPACITY, LIMIT, OVERLAP = 2048, 512, 64


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return match_groups(table(spark, d, "candidate_pairs")).select("record_id", "group_id")


def p1_group_sizes(spark: SparkSession, d: str) -> DataFrame:
    groups = match_groups(table(spark, d, "candidate_pairs"))
    return groups.groupBy("group_size").agg(F.countDistinct("group_id").alias("groups"), F.count(F.lit(1)).alias("records"))


def _statements(spark: SparkSession, d: str, only_repeated: bool = False) -> DataFrame:
    strings = table(spark, d, "unique_strings_by_field").where(F.col("field_type").isin("composite", "provision"))
    return formatting_groups(strings, ["field_type"], "hash", "value", F.col("field_type") == "composite", only_repeated=only_repeated)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _statements(spark, d, only_repeated=True).select("field_type", "hash", F.col("group_key").alias("group_hash"))


def p2_statements(spark: SparkSession, d: str) -> DataFrame:
    """One hash for each statement and the number of hashes it was stored under."""
    return _statements(spark, d).where("hash = group_key").select("field_type", "hash", "copies")


def _persons(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "unique_strings_by_field").where("field_type = 'person'").select("hash", "value")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return name_pairs(_persons(spark, d), "hash", "value").toDF("hash1", "hash2")


def p3_entities(spark: SparkSession, d: str) -> DataFrame:
    return name_entities(_persons(spark, d), "hash", "value")


def _looks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "unique_strings_by_field").where(F.col("field_type").isin("person", "title")).select("hash", "value", "field_type")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = lookalike_pairs(_looks(spark, d), ["field_type"], "hash", "value")
    return pairs.select("field_type", F.col("key1").alias("hash1"), F.col("key2").alias("hash2"))


def p5_forms(spark: SparkSession, d: str) -> DataFrame:
    return lookalike_forms(_looks(spark, d), ["field_type"], "hash", "value")


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    """Each hash with the smallest hash of those that look the same."""
    return lookalike_groups(_looks(spark, d), ["field_type"], "hash", "value").where("copies > 1").select("field_type", "hash", F.col("group_key").alias("group_hash"), "copies")


def _terms(spark: SparkSession, d: str) -> DataFrame:
    fields = F.col("field_type").isin("roles", "provision", "subjects")
    strings = table(spark, d, "unique_strings_by_field").where(fields)
    # a value's occurrences: its counts over all index runs, each run's row once
    values = strings.select("hash", "field_type", "value", "frequency", "index_run").groupBy("hash", "field_type", "index_run").agg(F.min("value").alias("value"), F.max("frequency").alias("frequency")).groupBy("hash", "field_type").agg(F.min("value").alias("value"), F.sum("frequency").alias("frequency"))
    held = table(spark, d, "field_hash_mapping").where(fields & F.col("hash").isNotNull()).groupBy("hash", "field_type", "batch_no").agg(F.max("n").alias("n")).groupBy("hash", "field_type").agg(F.sum("n").alias("records"))
    counts = term_counts(values.join(held, ["hash", "field_type"], "left"), "field_type", "value", "frequency", "records")
    return banded(counts, held.groupBy("field_type").agg(F.sum("records").alias("total")), "field_type")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _terms(spark, d).where("band <> 'usable'").select("field_type", "term", "band")


def p6_terms(spark: SparkSession, d: str) -> DataFrame:
    return _terms(spark, d).select("field_type", "term", "occurrences", "records", "band")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    near = top_k(table(spark, d, "vectors"), "field", "hash", "v", k=5, floor=0.9)
    return near.select("field", F.least("hash", "neighbour").alias("hash1"), F.greatest("hash", "neighbour").alias("hash2")).distinct()


def p7_nearest(spark: SparkSession, d: str) -> DataFrame:
    """The 5 most similar vectors of every 20th vector, against all, however far."""
    vectors = table(spark, d, "vectors").withColumn("asked", F.pmod(F.crc32("hash"), F.lit(20)) == 0)
    near = top_k(vectors, "field", "hash", "v", k=5, query="asked")
    return near.select("field", "hash", "neighbour", F.round("cosine", 6).alias("cosine"))


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    return pack(table(spark, d, "documents"), CAPACITY)


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return container_report(p8_packed(spark, d), CAPACITY)


def p9_mixed(spark: SparkSession, d: str) -> DataFrame:
    return mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def p10_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split_documents(table(spark, d, "documents"), LIMIT, OVERLAP)


def p3_checked(spark: SparkSession, d: str) -> DataFrame:
    """One row: whether at least 0.97 of the labelled matches between different names are linked, or all but one, and no labelled others."""
    entities = Scratch(spark, "checked").save(p3_entities(spark, d))
    person = table(spark, d, "record_field_hashes").where("person IS NOT NULL").groupBy("record_id").agg(F.max("person").alias("hash")).join(entities, "hash")
    side = lambda s: person.select(F.col("record_id").alias(f"{s}_id"), F.col("hash").alias(s), F.col("entity").alias(f"{s}_entity"))
    truth = ground_truth(table(spark, d, "labelled_pairs"), "left_id", "right_id", "is_match")
    both = truth.join(side("left"), "left_id").join(side("right"), "right_id").where("left <> right")
    linked = F.col("left_entity") == F.col("right_entity")
    counts = both.agg(F.count_if("match").alias("matches"), F.count_if(F.col("match") & linked).alias("found"), F.count_if(~F.col("match") & linked).alias("wrong"))
    return counts.select(((F.col("found") >= 0.97 * F.col("matches")) | (F.col("matches") - F.col("found") <= 1)).alias("matches_found"), (F.col("wrong") == 0).alias("others_apart"))


def p7_recall(spark: SparkSession, d: str) -> DataFrame:
    """One row a field: whether p7_nearest has at least 0.95 of the true neighbours, found by blocked brute force for the same vectors."""
    near = Scratch(spark, "recall").save(p7_nearest(spark, d))
    true = None
    usable = table(spark, d, "vectors").where("v IS NOT NULL").groupBy("field", F.col("hash").alias("id")).agg(F.min("v").alias("v"))
    for f in ("person", "composite"):
        x = usable.where(F.col("field") == f).select("id", "v")
        top = exact_top_k(x.where(F.pmod(F.crc32("id"), F.lit(20)) == 0), x, "id", "v", 6).where("query <> item").select(F.lit(f).alias("field"), F.col("query").alias("hash"), F.col("item").alias("neighbour"), F.round("similarity", 6).alias("cosine"))
        true = top if true is None else true.unionByName(top)
    # a copy of the vector may take the place of an equally similar one, so places are compared by their cosine
    kth = near.groupBy("field", "hash").agg(F.array_sort(F.collect_list("cosine")).alias("found"))
    want = true.groupBy("field", "hash").agg(F.slice(F.sort_array(F.collect_list("cosine"), asc=False), 1, 5).alias("true"))
    hits = F.aggregate("true", F.lit(0), lambda n, c: n + F.exists(F.coalesce("found", F.array().cast("array<double>")), lambda x: F.abs(x - c) < 2e-6).cast("int"))
    return want.join(kth, ["field", "hash"], "left").groupBy("field").agg((F.sum(hits) >= 0.95 * F.sum(F.size("true"))).alias("recall_reached"))


def p8_checked(spark: SparkSession, d: str) -> DataFrame:
    """One row: nothing lost, no container over its capacity, only longer texts split, and at most a twentieth of the room unused."""
    packed = Scratch(spark, "checked").save(p8_packed(spark, d))
    docs = packed.groupBy("doc_id").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("pieces"))
    split = docs.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.max((F.col("pieces") > 1) & (F.col("tokens") <= CAPACITY)), F.lit(False)).alias("split_needlessly"))
    whole = table(spark, d, "documents").agg(F.count(F.lit(1)).alias("all"))
    r = container_report(packed, CAPACITY).crossJoin(split).crossJoin(whole)  # one row each
    return r.select((F.col("documents") == F.col("all")).alias("all_packed"), (F.col("fullest") <= CAPACITY).alias("within_capacity"), (~F.col("split_needlessly")).alias("split_only_if_longer"), (F.col("containers") <= 1 + 1.05 * F.col("lower_bound")).alias("well_filled"))


def p9_checked(spark: SparkSession, d: str) -> DataFrame:
    """One row a target: whether its share of all tokens is met within a fiftieth or half the largest document of the sources, and no document is used too often."""
    mixture = Scratch(spark, "checked").save(p9_mixed(spark, d))
    uses = mixture.groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("uses"), F.sum("n_tokens").alias("tokens")).groupBy("source").agg(F.max("uses").alias("most"), F.sum("tokens").alias("tokens"))
    targets = table(spark, d, "mix_targets").groupBy("source").agg(F.min(F.struct("target_share", "max_repeats")).alias("t")).select("source", "t.*")
    rows = targets.join(uses, "source", "left")
    largest = with_sizes(table(spark, d, "documents").join(F.broadcast(targets.select("source")), "source"), ["source"], "text", "n_tokens", VOCABULARY).agg(F.max("n_tokens").alias("one"))
    all_ = rows.agg(F.sum("tokens").alias("all"), F.sum(F.when(F.col("tokens").isNotNull(), F.col("target_share"))).alias("shared"))
    tokens = F.coalesce(F.col("tokens"), F.lit(0))
    due = F.when(F.col("tokens").isNotNull(), F.col("target_share") / F.col("shared")).otherwise(0.0)
    return rows.crossJoin(F.broadcast(all_)).crossJoin(F.broadcast(largest)).select("source", (F.abs(tokens - due * F.col("all")) <= F.greatest(0.02 * F.col("all"), F.col("one") / 2)).alias("share_met"), (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("repeats_kept"))


def p10_checked(spark: SparkSession, d: str) -> DataFrame:
    """One row: pieces within the limit, texts restored from their pieces, the overlap kept."""
    pieces = p10_pieces(spark, d).select("doc_id", "piece_no", "n_tokens", "overlap_chars", F.substring("piece", F.col("overlap_chars") + 1, F.length("piece")).alias("own"))
    per = pieces.groupBy("doc_id").agg(F.max("n_tokens").alias("most"), F.min(F.when(F.col("piece_no") > 1, F.col("overlap_chars"))).alias("least_overlap"), F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_no", "own"))), lambda x: x["own"]), "")).alias("restored"))
    both = table(spark, d, "documents").select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("whole")).join(per, "doc_id", "left")
    return both.agg((F.max("most") <= LIMIT).alias("within_limit"), F.min(F.coalesce(F.col("restored") == F.col("whole"), F.lit(False))).alias("restored"), F.coalesce(F.min("least_overlap") > 0, F.lit(True)).alias("overlapping"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p1_found, p1_group_sizes, p2_found, p2_statements, p3_found, p3_entities, p3_checked, p5_found, p5_forms, p5_groups, p6_found, p6_terms, p7_found, p7_nearest, p7_recall, p8_packed, p8_report, p8_checked, p9_mixed, p9_shares, p9_checked, p10_pieces, p10_checked)
}
