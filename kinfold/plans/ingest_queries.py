"""Dictionary, statistics and checks of the catalogue rows, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.functions.text import SPACES, TRUE_WORDS, ascii_form, hash_key, levenshtein_similarity, name_uuid, normalize_text, pair_id, similar_enough, sorted_tokens, token_sort_similarity, trimmed, truthy
from kinfold.functions.years import PATTERNS, birth_death, has_both_years, has_years, name_without_years
from kinfold.operators import ingest
from kinfold.plans.tables import table

#: Order of arrival, and order of validity, of catalogue rows.
ARRIVAL, VALIDITY = ["batch_no", "changed_at"], ["changed_at", "batch_no"]


def rows(spark: SparkSession, d: str) -> DataFrame:
    return ingest.valid_records(table(spark, d, "catalog_records"), "personid").withColumnRenamed("personid", "record_id")


def cells(spark: SparkSession, d: str) -> DataFrame:
    return ingest.cells(rows(spark, d), "record_id", ARRIVAL)


def records(spark: SparkSession, d: str) -> DataFrame:
    return ingest.latest_records(rows(spark, d), "record_id", VALIDITY)


def record_cells(spark: SparkSession, d: str) -> DataFrame:
    return ingest.cells(records(spark, d), "record_id")


def string_dictionary(spark: SparkSession, d: str) -> DataFrame:
    return ingest.string_dictionary(cells(spark, d), ARRIVAL)


def string_counts(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).where("hash IS NOT NULL").groupBy("hash").agg(F.count(F.lit(1)).alias("n"))


def field_hash_counts(spark: SparkSession, d: str) -> DataFrame:
    return ingest.field_hash_counts(cells(spark, d))


def field_statistics(spark: SparkSession, d: str) -> DataFrame:
    return ingest.field_statistics(ingest.field_hash_counts(record_cells(spark, d)))


def multi_field_hashes(spark: SparkSession, d: str) -> DataFrame:
    return ingest.multi_field_hashes(field_hash_counts(spark, d))


def record_last_write(spark: SparkSession, d: str) -> DataFrame:
    return ingest.record_fields(record_cells(spark, d), "record_id")


def person_lookup(spark: SparkSession, d: str) -> DataFrame:
    return record_cells(spark, d).where("field = 'person' AND hash IS NOT NULL").select("record_id", F.col("hash").alias("person_h"))


def null_profile(spark: SparkSession, d: str) -> DataFrame:
    return ingest.null_profile(record_cells(spark, d))


def modal_hash_share(spark: SparkSession, d: str) -> DataFrame:
    return ingest.modal_hashes(record_cells(spark, d))


def missing_fields(spark: SparkSession, d: str) -> DataFrame:
    return ingest.missing_fields(record_cells(spark, d), "record_id").select("record_id", F.array_join("missing", ",").alias("missing"))


def missing_counts(spark: SparkSession, d: str) -> DataFrame:
    missing = ingest.missing_fields(record_cells(spark, d), "record_id")
    return missing.select(F.explode("missing").alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("records"))


def _mapping(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "field_hash_mapping").where("hash IS NOT NULL").select(F.col("field_type").alias("field"), "hash", "n", "batch_no").distinct()


def _rebuilt(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "record_field_hashes").distinct()
    long = r.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("hash")) for f in ingest.FIELDS])).alias("c")).select("c.*").where("hash IS NOT NULL")
    return long.groupBy("hash", "field").agg(F.count(F.lit(1)).alias("n"))


def mapping_rebuild_diff(spark: SparkSession, d: str) -> DataFrame:
    return ingest.mapping_differences(_mapping(spark, d).select("hash", "field").distinct(), _rebuilt(spark, d).select("hash", "field"))


def index_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    count = lambda df: df.select("hash", "field").distinct().groupBy("field").agg(F.count(F.lit(1)).alias("n"))
    indexed = table(spark, d, "unique_strings_by_field").select("hash", F.col("field_type").alias("field"))
    vectors = table(spark, d, "vectors").where("v IS NOT NULL").select("hash", "field")
    return ingest.reconcile({"expected": count(_rebuilt(spark, d)), "mapped": count(_mapping(spark, d)), "indexed": count(indexed), "embedded": count(vectors)})


def resume_antijoin(spark: SparkSession, d: str) -> DataFrame:
    todo = table(spark, d, "unique_strings_by_field").where(F.col("field_type").isin("person", "composite")).select("hash", F.col("field_type").alias("field")).distinct()
    return ingest.unprocessed(todo, table(spark, d, "vectors").where("v IS NOT NULL").select("hash", "field"), ["hash", "field"])


def hash_trace(spark: SparkSession, d: str) -> DataFrame:
    """Where the most frequent person string occurs."""
    r = table(spark, d, "record_field_hashes").where("person IS NOT NULL")
    top = r.groupBy("person").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "person").first()
    value = F.lit(top["person"] if top else None)
    stages = {"records": (r, "person"), "strings": (table(spark, d, "unique_strings_by_field"), "hash"), "mapping": (table(spark, d, "field_hash_mapping"), "hash"), "vectors": (table(spark, d, "vectors"), "hash"), "candidates_left": (table(spark, d, "candidate_pairs"), "record1_hash"), "candidates_right": (table(spark, d, "candidate_pairs"), "record2_hash")}
    return ingest.trace_hash(stages, value)


def embeddable_hashes(spark: SparkSession, d: str) -> DataFrame:
    return field_hash_counts(spark, d).where(F.col("field").isin(*ingest.EMBEDDED)).select("hash").distinct()


def indexed_objects(spark: SparkSession, d: str) -> DataFrame:
    """What an index holds: vectors with their strings and frequencies, one object for each (hash, field)."""
    vectors = table(spark, d, "vectors").where("v IS NOT NULL").groupBy("hash", "field").agg(F.min("v").alias("v"))
    strings = table(spark, d, "unique_strings_by_field").groupBy("hash", F.col("field_type").alias("field")).agg(F.min("value").alias("value"))
    counts = _mapping(spark, d).groupBy("hash", "field").agg(F.sum("n").alias("frequency"))
    out = vectors.join(strings, ["hash", "field"]).join(counts, ["hash", "field"])
    return out.select("hash", "field", "value", "frequency", F.size("v").alias("dimensions"), name_uuid(F.concat_ws("_", "hash", "field")).alias("object_id"))


def normalized_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "unique_strings_by_field").select("hash", "value").distinct().select("hash", normalize_text(F.col("value")).alias("normalized"), hash_key(F.col("value")).alias("key"))


def document_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Texts that agree in all but white space and case, with their copies."""
    docs = table(spark, d, "documents").select("doc_id", hash_key(F.col("text")).alias("key")).where("key IS NOT NULL")
    return docs.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_doc")).where("copies > 1")


def truthy_labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labelled_pairs").groupBy(F.lower(F.trim(F.regexp_replace("is_match", SPACES, " "))).alias("word"), truthy(F.col("is_match")).alias("match")).agg(F.count(F.lit(1)).alias("n"))


def pair_canonical(spark: SparkSession, d: str) -> DataFrame:
    a, b = trimmed(F.col("left_id")), trimmed(F.col("right_id"))
    return table(spark, d, "labelled_pairs").select(pair_id(a, b).alias("pair_id")).distinct()


def _persons(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "unique_strings_by_field").where("field_type = 'person'").select("hash", "value").distinct()


def birth_death_years(spark: SparkSession, d: str) -> DataFrame:
    return _persons(spark, d).withColumn("y", birth_death(F.col("value"))).select("hash", "y.birth", "y.death")


def birth_death_fixed(spark: SparkSession, d: str) -> DataFrame:
    return _persons(spark, d).withColumn("y", birth_death(F.col("value"), "fixed")).select("hash", "y.birth", "y.death")


def year_presence(spark: SparkSession, d: str) -> DataFrame:
    y = _persons(spark, d).withColumn("y", birth_death(F.col("value")))
    share = lambda c: F.round(F.avg(c.cast("double")), 6)
    return y.agg(F.count(F.lit(1)).alias("names"), share(F.col("y.birth").isNotNull()).alias("birth"), share(F.col("y.death").isNotNull()).alias("death"), share(has_years(F.col("y"))).alias("either"), share(has_both_years(F.col("y"))).alias("both"))


def names_without_years(spark: SparkSession, d: str) -> DataFrame:
    return _persons(spark, d).select("hash", name_without_years(F.col("value")).alias("name"))


def most_frequent_strings(spark: SparkSession, d: str) -> DataFrame:
    """The 20 strings that occur most often."""
    return string_dictionary(spark, d).select("hash", "n").orderBy(F.desc("n"), "hash").limit(20)


def _label_texts(spark: SparkSession, d: str) -> DataFrame:
    p = person_text(spark, d)
    pairs = table(spark, d, "labelled_pairs").select(trimmed(F.col("left_id")).alias("l"), trimmed(F.col("right_id")).alias("r")).where("l IS NOT NULL AND r IS NOT NULL").distinct()
    return pairs.join(p.toDF("l", "a"), "l").join(p.toDF("r", "b"), "r")


def person_text(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).select("record_id", normalize_text(F.col("person")).alias("person"))


def levenshtein_pairs(spark: SparkSession, d: str) -> DataFrame:
    """On ASCII forms, where the two engines count alike."""
    a, b = ascii_form(F.col("a")), ascii_form(F.col("b"))
    return _label_texts(spark, d).select("l", "r", F.round(levenshtein_similarity(a, b), 6).alias("similarity"), similar_enough(a, b).alias("similar"))


def token_sort_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _label_texts(spark, d).select("l", "r", sorted_tokens(F.col("a")).alias("sorted_left"), F.round(token_sort_similarity(F.col("a"), F.col("b")), 6).alias("similarity"))


# ---- SQL ----

_SPACE = r"[\t\n\x0B\f\r\p{Z}]+"
_N = lambda c: f"nullif(trim(regexp_replace({c}, '{_SPACE}', ' ', 'g')), '')"
_T = lambda c: f"nullif(regexp_replace({c}, '^{_SPACE}|{_SPACE}$', '', 'g'), '')"
ROWS_SQL = "valid AS (SELECT trim(personid) AS record_id, composite, person, roles, title, provision, subjects, batch_no, changed_at FROM catalog_records WHERE personid IS NOT NULL AND trim(personid) NOT IN ('', 'unknown'))"
RECORDS_SQL = ROWS_SQL + ", latest AS (SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY changed_at DESC NULLS LAST, batch_no DESC NULLS LAST, composite DESC NULLS LAST, person DESC NULLS LAST, roles DESC NULLS LAST, title DESC NULLS LAST, provision DESC NULLS LAST, subjects DESC NULLS LAST) AS place FROM valid) WHERE place = 1)"


def _cells_sql(source: str, name: str = "cells", keep: str = ", batch_no, changed_at") -> str:
    parts = " UNION ALL ".join(f"SELECT record_id{keep}, '{f}' AS field, {_N(f)} AS value FROM {source}" for f in ingest.FIELDS)
    return f"{name} AS (SELECT *, md5(lower(value)) AS hash FROM ({parts}))"


_CELLS = f"WITH {ROWS_SQL}, {_cells_sql('valid')} "
_RECORD_CELLS = f"WITH {RECORDS_SQL}, {_cells_sql('latest')} "
_MODAL = "modal AS (SELECT field, hash, n, records FROM (SELECT c.*, r.records, row_number() OVER (PARTITION BY c.field ORDER BY n DESC, hash) AS place FROM (SELECT field, hash, count(*) AS n FROM cells WHERE hash IS NOT NULL GROUP BY ALL) c JOIN (SELECT field, count(*) AS records FROM cells GROUP BY field) r ON r.field = c.field) WHERE place = 1)"
_MISSING = _RECORD_CELLS[:-1] + f", {_MODAL}, missing AS (SELECT record_id, field FROM cells WHERE value IS NULL OR lower(value) IN ({', '.join(repr(w) for w in ingest.NULL_WORDS)}) OR hash IN (SELECT hash FROM modal WHERE n > records * 0.15)) "
_REBUILT = "WITH rebuilt AS (SELECT field, hash, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{f}' AS field, {f} AS hash FROM (SELECT DISTINCT * FROM record_field_hashes)" for f in ingest.FIELDS) + ") WHERE hash IS NOT NULL GROUP BY ALL), mapped AS (SELECT DISTINCT field_type AS field, hash FROM field_hash_mapping WHERE hash IS NOT NULL) "
_PERSON_ROWS = "WITH persons AS (SELECT DISTINCT hash, value FROM unique_strings_by_field WHERE field_type = 'person') "


def _years_sql(name: str, fixed: bool) -> tuple[str, str]:
    year = lambda p, g: f"nullif(CAST(nullif(regexp_extract(regexp_extract({name}, '{p}', {g}), '[0-9]+'), '') AS INTEGER), 0)"
    birth, death = "CASE", "CASE"
    for k, p in enumerate(PATTERNS):
        hit = f" WHEN regexp_matches({name}, '{p}') THEN "
        one, two = year(p, 1), year(p, 2) if k < 3 or k == 7 else "NULL"
        if k < 3:
            b, d = one, two
        elif fixed:
            b, d = ("NULL", one) if k in (3, 4) else (one, two if k == 7 else "NULL")
        else:
            low = f"lower({name})"
            born, died, flourished = f"contains({low}, 'born') OR contains({low}, 'b.')", f"contains({low}, 'died') OR contains({low}, 'd.') OR contains({low}, '-')", f"contains({low}, 'fl.') OR contains({low}, 'floruit')"
            b = f"CASE WHEN {born} THEN {one} WHEN {died} THEN NULL WHEN {flourished} THEN {one} END"
            d = f"CASE WHEN {born} THEN NULL WHEN {died} THEN {one} END"
        birth, death = birth + hit + b, death + hit + d
    return birth + " END", death + " END"


_BIRTH, _DEATH = _years_sql("value", False)
_BIRTH_FIXED, _DEATH_FIXED = _years_sql("value", True)
_YEARS = _PERSON_ROWS[:-1] + f", years AS (SELECT hash, {_BIRTH} AS birth, {_DEATH} AS death FROM persons) "


def _without_years_sql(c: str) -> str:
    for p in PATTERNS:
        c = f"regexp_replace({c}, '{p}', '', 'g')"
    c = rf"regexp_replace({c}, '\([\s\p{{Z}}]*[0-9?]*[\s\p{{Z}}]*\)', '', 'g')"
    c = rf"regexp_replace({c}, '[\s\p{{Z}},]+$', '', 'g')"
    return rf"trim(regexp_replace({c}, '[\s\p{{Z}}]+', ' ', 'g'))"


_ASCII = lambda c: rf"regexp_replace({c}, '[^\x00-\x7F]', '?', 'g')"
_LABEL_TEXTS = f"WITH {RECORDS_SQL}, texts AS (SELECT record_id, {_N('person')} AS person FROM latest), pairs AS (SELECT DISTINCT l, r FROM (SELECT {_T('left_id')} AS l, {_T('right_id')} AS r FROM labelled_pairs) WHERE l IS NOT NULL AND r IS NOT NULL), sides AS (SELECT l, r, {_ASCII('x.person')} AS a, {_ASCII('y.person')} AS b FROM pairs JOIN texts x ON x.record_id = l JOIN texts y ON y.record_id = r) "
SIMILARITY_SQL = "CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL WHEN greatest(length({a}), length({b})) = 0 THEN 1.0 ELSE 1 - levenshtein({a}, {b}) / greatest(length({a}), length({b})) END"
_SIM = SIMILARITY_SQL.format(a="a", b="b")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        string_dictionary, string_counts, field_hash_counts, field_statistics, multi_field_hashes, record_last_write, person_lookup, null_profile, modal_hash_share, missing_fields, missing_counts,
        mapping_rebuild_diff, index_reconciliation, resume_antijoin, hash_trace, embeddable_hashes, indexed_objects, normalized_text, document_duplicates, truthy_labels, pair_canonical,
        birth_death_years, birth_death_fixed, year_presence, names_without_years, most_frequent_strings, levenshtein_pairs, token_sort_pairs,
    )
}

SQL: dict[str, str] = {
    "string_dictionary": _CELLS + "SELECT hash, arg_min(value, {'a': batch_no, 'b': changed_at, 'c': value}) AS value, count(*) AS n, count(DISTINCT field) AS n_fields FROM cells WHERE hash IS NOT NULL GROUP BY hash",
    "string_counts": _CELLS + "SELECT hash, count(*) AS n FROM cells WHERE hash IS NOT NULL GROUP BY hash",
    "field_hash_counts": _CELLS + "SELECT hash, field, count(*) AS n FROM cells WHERE hash IS NOT NULL GROUP BY ALL",
    "field_statistics": _RECORD_CELLS + "SELECT field, count(*) AS total_occurrences, count(DISTINCT hash) AS unique_values FROM cells WHERE hash IS NOT NULL GROUP BY field",
    "multi_field_hashes": _CELLS + "SELECT hash, count(DISTINCT field) AS n_fields, count(*) AS n FROM cells WHERE hash IS NOT NULL GROUP BY hash HAVING count(DISTINCT field) > 1",
    "record_last_write": _RECORD_CELLS + "SELECT record_id, " + ", ".join(f"max(CASE WHEN field = '{f}' THEN hash END) AS {f}_h" for f in ingest.FIELDS) + " FROM cells GROUP BY record_id",
    "person_lookup": _RECORD_CELLS + "SELECT record_id, hash AS person_h FROM cells WHERE field = 'person' AND hash IS NOT NULL",
    "null_profile": _RECORD_CELLS + "SELECT field, count(*) AS total, count(*) FILTER (hash IS NULL) AS missing, count(DISTINCT hash) AS distinct_values, round(1 - count(*) FILTER (hash IS NULL) / count(*), 6) AS present_share FROM cells GROUP BY field",
    "modal_hash_share": _RECORD_CELLS[:-1] + f", {_MODAL} SELECT field, hash, n, records, round(n / records, 6) AS share FROM modal",
    "missing_fields": _MISSING + "SELECT record_id, string_agg(field, ',' ORDER BY field) AS missing FROM missing GROUP BY record_id",
    "missing_counts": _MISSING + "SELECT field, count(*) AS records FROM missing GROUP BY field",
    "mapping_rebuild_diff": _REBUILT + "SELECT hash, field, 'added' AS change FROM (SELECT hash, field FROM rebuilt EXCEPT SELECT hash, field FROM mapped) UNION ALL SELECT hash, field, 'removed' FROM (SELECT hash, field FROM mapped EXCEPT SELECT hash, field FROM rebuilt)",
    "index_reconciliation": _REBUILT + """, e AS (SELECT field, count(*) AS n FROM rebuilt GROUP BY field), m AS (SELECT field, count(*) AS n FROM mapped GROUP BY field),
  i AS (SELECT field_type AS field, count(DISTINCT hash) AS n FROM unique_strings_by_field GROUP BY ALL), v AS (SELECT field, count(DISTINCT hash) AS n FROM vectors WHERE v IS NOT NULL GROUP BY ALL),
  f AS (SELECT field FROM e UNION SELECT field FROM m UNION SELECT field FROM i UNION SELECT field FROM v)
  SELECT f.field, coalesce(e.n, 0) AS expected, coalesce(m.n, 0) AS mapped, coalesce(i.n, 0) AS indexed, coalesce(v.n, 0) AS embedded, coalesce(m.n, 0) - coalesce(e.n, 0) AS mapped_difference, coalesce(i.n, 0) - coalesce(e.n, 0) AS indexed_difference, coalesce(v.n, 0) - coalesce(e.n, 0) AS embedded_difference
  FROM f LEFT JOIN e USING (field) LEFT JOIN m USING (field) LEFT JOIN i USING (field) LEFT JOIN v USING (field)""",
    "resume_antijoin": "SELECT hash, field_type AS field FROM unique_strings_by_field WHERE field_type IN ('person', 'composite') EXCEPT SELECT hash, field FROM vectors WHERE v IS NOT NULL",
    "hash_trace": "WITH top AS (SELECT person AS h FROM record_field_hashes WHERE person IS NOT NULL GROUP BY person ORDER BY count(*) DESC, person LIMIT 1) " + " UNION ALL ".join(f"SELECT '{s}' AS stage, count(*) AS rows FROM {t}, top WHERE {c} = h" for s, t, c in (("records", "record_field_hashes", "person"), ("strings", "unique_strings_by_field", "hash"), ("mapping", "field_hash_mapping", "hash"), ("vectors", "vectors", "hash"), ("candidates_left", "candidate_pairs", "record1_hash"), ("candidates_right", "candidate_pairs", "record2_hash"))),
    "embeddable_hashes": _CELLS + "SELECT DISTINCT hash FROM cells WHERE hash IS NOT NULL AND field <> 'roles'",
    "indexed_objects": """WITH v AS (SELECT hash, field, min(v) AS v FROM vectors WHERE v IS NOT NULL GROUP BY ALL), s AS (SELECT hash, field_type AS field, min(value) AS value FROM unique_strings_by_field GROUP BY ALL),
  c AS (SELECT hash, field, sum(n)::BIGINT AS frequency FROM (SELECT DISTINCT field_type AS field, hash, n, batch_no FROM field_hash_mapping) GROUP BY ALL),
  o AS (SELECT v.hash, v.field, s.value, c.frequency, len(v.v) AS dimensions, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(v.hash || '_' || v.field)) AS d FROM v JOIN s ON s.hash = v.hash AND s.field = v.field JOIN c ON c.hash = v.hash AND c.field = v.field)
  SELECT hash, field, value, frequency, dimensions, d[1:8] || '-' || d[9:12] || '-5' || d[14:16] || '-' || '89ab'[(strpos('0123456789abcdef', d[17]) - 1) % 4 + 1] || d[18:20] || '-' || d[21:32] AS object_id FROM o""",
    "normalized_text": f"SELECT hash, {_N('value')} AS normalized, md5(lower({_N('value')})) AS key FROM (SELECT DISTINCT hash, value FROM unique_strings_by_field)",
    "document_duplicates": f"SELECT md5(lower({_N('text')})) AS key, count(*) AS copies, min(doc_id) AS first_doc FROM documents WHERE {_N('text')} IS NOT NULL GROUP BY ALL HAVING count(*) > 1",
    "truthy_labels": f"SELECT lower(trim(regexp_replace(is_match, '{_SPACE}', ' ', 'g'))) AS word, lower(trim(regexp_replace(is_match, '{_SPACE}', ' ', 'g'))) IN ({', '.join(repr(w) for w in TRUE_WORDS)}) AS match, count(*) AS n FROM labelled_pairs GROUP BY ALL",
    "pair_canonical": f"SELECT DISTINCT concat_ws('|', least(l, r), greatest(l, r)) AS pair_id FROM (SELECT {_T('left_id')} AS l, {_T('right_id')} AS r FROM labelled_pairs)",
    "birth_death_years": _YEARS + "SELECT hash, birth, death FROM years",
    "birth_death_fixed": _PERSON_ROWS + f"SELECT hash, {_BIRTH_FIXED} AS birth, {_DEATH_FIXED} AS death FROM persons",
    "year_presence": _YEARS + "SELECT count(*) AS names, round(avg((birth IS NOT NULL)::INT), 6) AS birth, round(avg((death IS NOT NULL)::INT), 6) AS death, round(avg((birth IS NOT NULL OR death IS NOT NULL)::INT), 6) AS either, round(avg((birth IS NOT NULL AND death IS NOT NULL)::INT), 6) AS both FROM years",
    "names_without_years": _PERSON_ROWS + f"SELECT hash, {_without_years_sql('value')} AS name FROM persons",
    "most_frequent_strings": _CELLS + "SELECT hash, count(*) AS n FROM cells WHERE hash IS NOT NULL GROUP BY hash ORDER BY n DESC, hash LIMIT 20",
    "levenshtein_pairs": _LABEL_TEXTS + f"SELECT l, r, round({_SIM}, 6) AS similarity, coalesce(greatest(length(a), length(b)) > 0 AND {_SIM} >= 0.3, false) AS similar FROM sides",
}
