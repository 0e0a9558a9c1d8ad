"""Filling missing statements from the other records of the same bibliographic record."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.operators.hotdeck import nearest_hot_deck, states_nothing
from kinfold.plans.tables import table

FIELDS = ("provision", "subjects")


def _cells(spark: SparkSession, d: str) -> DataFrame:
    """(record_id, field_type, bib, title, other, hash or null): one row for each record and field; `other` is the hash in the other field. Rows delivered again count once."""
    records = table(spark, d, "record_field_hashes").select("record_id", "batch_no", "title", *FIELDS).where("record_id IS NOT NULL").groupBy("record_id").agg(F.max_by(F.struct("title", *FIELDS), F.struct(F.coalesce("batch_no", F.lit(-1)), *FIELDS, "title")).alias("r")).select("record_id", "r.*")
    cells = F.array(*[F.struct(F.lit(f).alias("field_type"), F.col(f).alias("hash"), F.col(o).alias("other")) for f, o in (FIELDS, FIELDS[::-1])])
    long = records.select("record_id", "title", F.substring_index("record_id", "#", 1).alias("bib"), F.explode(cells).alias("c")).select("record_id", "bib", "title", "c.*")
    # hashes of texts that state nothing: distinct ones are few, but their number has no bound, so this is a join
    empty = table(spark, d, "unique_strings_by_field").where(F.col("field_type").isin(*FIELDS) & F.col("value").isNotNull() & states_nothing(F.col("value"))).select("hash", "field_type").distinct()
    marked = long.join(empty.withColumn("nothing", F.lit(True)), ["hash", "field_type"], "left")
    return marked.select("record_id", "bib", "title", "other", "field_type", F.when(F.col("nothing").isNull(), F.col("hash")).alias("hash"), F.concat_ws("\t", "field_type", "record_id").alias("cell"))


def _filled(spark: SparkSession, d: str, whole_block: bool) -> DataFrame:
    """The closest agents have the same title and the same statement in the other field; a title counts twice."""
    out = nearest_hot_deck(_cells(spark, d), "cell", "hash", ["field_type", "bib"], {"title": 2.0, "other": 1.0}, whole_block=whole_block)
    after = lambda c: F.expr(f"substring({c}, instr({c}, '\t') + 1)")
    return out.select(F.substring_index("cell", "\t", 1).alias("field_type"), after("cell").alias("record_id"), F.col("value").alias("hash"), "filled", "donors", "distance", after("donor").alias("donor"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """All agents of the bib that have a value are donors and vote; a cell counts as filled by the closest one that holds what they voted for."""
    return _filled(spark, d, whole_block=True).where("filled AND donor IS NOT NULL").select("record_id", "field_type", "hash")


def p4_filled(spark: SparkSession, d: str) -> DataFrame:
    """Every cell, filled from the closest agents of the bib."""
    return _filled(spark, d, whole_block=False).select("record_id", "field_type", "hash", "filled", "donors", "distance", "donor")


def p4_similarities(spark: SparkSession, d: str) -> DataFrame:
    """Matches without a similarity get the median of the closest matches: of the same first person, found in the same week or month, within the batch."""
    p = table(spark, d, "candidate_pairs").where("record1_id IS NOT NULL AND record2_id IS NOT NULL").select("record1_id", "record2_id", "record1_hash", "record2_hash", "batch_no", "similarity", F.unix_timestamp("found_at").alias("at")).distinct()
    p = p.withColumn("pair", F.concat_ws("\t", "record1_id", "record2_id", F.coalesce(F.col("similarity").cast("string"), F.lit("")), F.coalesce(F.col("at").cast("string"), F.lit("")), "record1_hash", "record2_hash"))
    out = nearest_hot_deck(p, "pair", "similarity", ["batch_no"], {"record1_hash": 2.0}, {"at": (1.0, 604_800.0)}, numeric=True)
    part = F.split("pair", "\t")
    return out.where("filled").select(part[0].alias("record1_id"), part[1].alias("record2_id"), F.round("value", 6).alias("similarity"), "donors", "distance")


# Texts without a provision or subject as they stand in the tables; fixed values, apart from the operator's own words.
PLACEHOLDERS = ("", "[s.n.]", "[S.l. : s.n.]", "[Place of publication and publisher not identified]", "-", "--", "?", "NULL", "(null)", "null", "unknown", "N/A", "n/a", "n.a.", "nan", "NaN", "None", "none", "No subject headings assigned")

_CELLS = f"""
WITH records AS (SELECT DISTINCT ON (record_id) record_id, title, provision, subjects FROM record_field_hashes WHERE record_id IS NOT NULL
  ORDER BY record_id, coalesce(batch_no, -1) DESC, provision DESC NULLS LAST, subjects DESC NULLS LAST, title DESC NULLS LAST),
long AS (SELECT record_id, title, 'provision' AS field_type, provision AS hash, subjects AS other FROM records UNION ALL SELECT record_id, title, 'subjects', subjects, provision FROM records),
nothing AS (SELECT DISTINCT hash, field_type FROM unique_strings_by_field WHERE field_type IN ('provision', 'subjects') AND trim(value) IN ({", ".join(f"'{v}'" for v in PLACEHOLDERS)})),
cells AS (SELECT l.record_id, l.field_type, l.title, l.other, string_split(l.record_id, '#')[1] AS bib, CASE WHEN n.hash IS NULL THEN l.hash END AS hash
  FROM long l LEFT JOIN nothing n ON n.hash = l.hash AND n.field_type = l.field_type),
met AS (SELECT c.record_id, c.field_type, d.record_id AS donor, d.hash,
    CASE WHEN d.title = c.title THEN 0 ELSE 2 END + CASE WHEN d.other = c.other THEN 0 ELSE 1 END AS distance
  FROM cells c JOIN cells d ON d.bib = c.bib AND d.field_type = c.field_type WHERE c.hash IS NULL AND d.hash IS NOT NULL)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p4_found, p4_filled, p4_similarities)}
SQL: dict[str, str] = {
    "p4_found": _CELLS
    + """SELECT record_id, field_type, hash FROM (SELECT record_id, field_type, hash, row_number() OVER (PARTITION BY record_id, field_type ORDER BY count(*) DESC, hash) AS place
  FROM met GROUP BY record_id, field_type, hash) WHERE place = 1""",
    "p4_filled": _CELLS
    + """, near AS (SELECT * FROM met QUALIFY distance = min(distance) OVER (PARTITION BY record_id, field_type)),
voted AS (SELECT record_id, field_type, hash, min(donor) AS donor, min(distance) AS distance, sum(count(*)) OVER (PARTITION BY record_id, field_type)::BIGINT AS donors,
    row_number() OVER (PARTITION BY record_id, field_type ORDER BY count(*) DESC, hash) AS place FROM near GROUP BY record_id, field_type, hash)
SELECT c.record_id, c.field_type, coalesce(c.hash, v.hash) AS hash, v.hash IS NOT NULL AS filled, coalesce(v.donors, 0) AS donors, v.distance::DOUBLE AS distance, v.donor
FROM cells c LEFT JOIN voted v ON v.record_id = c.record_id AND v.field_type = c.field_type AND v.place = 1""",
    "p4_similarities": """
WITH p AS (SELECT DISTINCT record1_id, record2_id, record1_hash, record2_hash, batch_no, similarity, epoch(found_at)::BIGINT AS at FROM candidate_pairs WHERE record1_id IS NOT NULL AND record2_id IS NOT NULL),
lacking AS (SELECT *, row_number() OVER () AS n FROM p WHERE similarity IS NULL),
met AS (SELECT l.n, d.similarity, CASE WHEN d.record1_hash = l.record1_hash THEN 0 ELSE 2 END
    + CASE WHEN d.at // 604800 = l.at // 604800 THEN 0 WHEN d.at // 2419200 = l.at // 2419200 THEN 0.5 ELSE 1 END AS distance
  FROM lacking l JOIN p d ON d.batch_no = l.batch_no WHERE d.similarity IS NOT NULL),
near AS (SELECT * FROM met QUALIFY distance = min(distance) OVER (PARTITION BY n)),
ranked AS (SELECT n, distance, similarity, row_number() OVER (PARTITION BY n ORDER BY similarity) AS place, count(*) OVER (PARTITION BY n) AS donors FROM near)
SELECT l.record1_id, l.record2_id, round(r.similarity, 6) AS similarity, r.donors, r.distance::DOUBLE AS distance
FROM ranked r JOIN lacking l ON l.n = r.n WHERE r.place = (r.donors + 1) // 2""",
}
