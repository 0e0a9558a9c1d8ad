"""Texts without a statement, against lists of their own."""

from compare import same
from pyspark.sql import functions as F

from kinfold.operators import hotdeck
from kinfold.plans import imputation_queries

# The placeholders of the test data, as written there; kept apart from the operator's words.
PLACEHOLDERS = ("[s.n.]", "[Place of publication and publisher not identified]", "-", "NULL", "unknown", "N/A", "nan", "No subject headings assigned", "?", "(null)", "none", "--", "n.a.")

FILLED = f"""
WITH records AS (SELECT DISTINCT ON (record_id) record_id, provision, subjects FROM record_field_hashes WHERE record_id IS NOT NULL
  ORDER BY record_id, coalesce(batch_no, -1) DESC, provision DESC NULLS LAST, subjects DESC NULLS LAST, title DESC NULLS LAST),
cells AS (SELECT record_id, split_part(record_id, '#', 1) AS bib, f AS field_type, CASE WHEN h NOT IN (
    SELECT hash FROM unique_strings_by_field u WHERE u.field_type = f AND u.hash IS NOT NULL AND u.value IN ({", ".join(f"'{p}'" for p in PLACEHOLDERS)})) THEN h END AS hash
  FROM (SELECT record_id, 'provision' AS f, provision AS h FROM records UNION ALL SELECT record_id, 'subjects', subjects FROM records)),
counts AS (SELECT bib, field_type, hash, count(*) AS n FROM cells WHERE hash IS NOT NULL GROUP BY ALL),
donors AS (SELECT bib, field_type, hash, row_number() OVER (PARTITION BY bib, field_type ORDER BY n DESC, hash) AS place FROM counts)
SELECT c.record_id, c.field_type, d.hash FROM cells c JOIN donors d ON d.bib = c.bib AND d.field_type = c.field_type AND d.place = 1 WHERE c.hash IS NULL
"""


def test_denials(spark):
    nothing = [*PLACEHOLDERS, "no subjects", "Publisher not given", "[S.l. : s.n.]", "Without place or date", "place unknown", "Subject heading unassigned", "NOT  STATED"]
    stated = ["Botany", "No man's land", "Unknown soldiers", "Missing persons", "Publishers and publishing", "Names", "[Place not identified] : Heath, 1850", "London : publisher not identified", "Notes", "Not"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(nothing + stated)], "i int, t string")
    got = [r.t for r in df.where(hotdeck.states_nothing(F.col("t"))).orderBy("i").collect()]
    assert got == nothing


def test_filled_against_placeholders(spark, data, duck):
    same(imputation_queries.p4_found(spark, data), duck, FILLED)
