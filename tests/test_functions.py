import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinfold.functions import text as tx
from kinfold.functions import years as yr


def values(spark, column, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_normalization(spark):
    rows = [("  Mark   Twain ", None), ("MARK TWAIN", None), ("a  b", None), (None, None), ("", None), (" \t\n", None)]
    assert values(spark, tx.normalize_text(F.col("a")), rows) == ["Mark Twain", "MARK TWAIN", "a b", None, None, None]
    keys = values(spark, tx.hash_key(F.col("a")), rows)
    assert keys[0] == keys[1] and keys[2] != keys[0] and keys[3:] == [None, None, None]


COMPAT = [
    ("Twain, Mark, 1835-1910", 1835, 1910), ("Smith, John, 1900-", None, 1900), ("Smith, John, 1900–", None, None), ("Doe, Jane, b. 1900", 1900, None), ("Doe, Jane, d. 1980", None, None),
    ("Doe, Jane, -1980", None, 1980), ("Webb., J., 1900-", 1900, None), ("Ed. Smith, 1900-", None, 1900), ("Born, Max, 1882-", 1882, None), ("X, ca. 1900", None, None), ("X, fl. 1500", 1500, None),
    ("X, fl. 1500-1550", 1500, 1550), ("X, 1850 or 1851-1900", 1850, 1900), ("X, ca. 1200-ca. 1280", 1200, 1280), ("Euclid, 565 - approximately 665", 565, 665), ("Report 2001-12-05", 2001, 12),
    ("12345-67890", 2345, 6789), ("Plain Name", None, None), (None, None, None), ("", None, None),
]


def test_years_compat(spark):
    got = values(spark, yr.birth_death(F.col("a")), [(n, None) for n, _, _ in COMPAT])
    assert [(r["birth"], r["death"]) for r in got] == [(b, d) for _, b, d in COMPAT]


def test_years_fixed(spark):
    names = ["Smith, John, 1900-", "Doe, Jane, d. 1980", "Doe, Jane, -1980", "Webb., J., 1900-", "X, ca. 1900", "X, fl. 1500", "Twain, Mark, 1835-1910"]
    got = values(spark, yr.birth_death(F.col("a"), "fixed"), [(n, None) for n in names])
    assert [(r["birth"], r["death"]) for r in got] == [(1900, None), (None, 1980), (None, 1980), (1900, None), (1900, None), (1500, None), (1835, 1910)]


def test_name_without_years(spark):
    rows = [("Twain, Mark, 1835-1910", None), ("Smith, John (1900-1980)", None), ("Doe, Jane, b. 1900", None), ("Plain Name", None)]
    assert values(spark, yr.name_without_years(F.col("a")), rows) == ["Twain, Mark", "Smith, John", "Doe, Jane", "Plain Name"]


def test_similarities(spark):
    rows = [("kitten", "sitting"), ("", ""), (None, "x"), ("é", "e")]
    got = values(spark, tx.levenshtein_similarity(F.col("a"), F.col("b")), rows)
    assert got[0] == pytest.approx(1 - 3 / 7) and got[1:] == [1.0, None, 0.0]
    assert values(spark, tx.similar_enough(F.col("a"), F.col("b")), rows) == [True, False, False, False]
    got = values(spark, tx.token_sort_similarity(F.col("a"), F.col("b")), [("Twain Mark", "Mark Twain"), ("abc", "abd"), ("", ""), (None, "x")])
    assert got[:3] == [1.0, pytest.approx(4 / 6), 1.0] and got[3] is None


def test_numbers(spark):
    f = lambda c: spark.range(1).select(c).first()[0]
    lit = F.lit
    assert f(tx.harmonic(lit(0.5), lit(1.0))) == pytest.approx(2 / 3) and f(tx.harmonic(lit(0.0), lit(1.0))) == 0
    assert f(tx.capped_ratio(lit(1.0), lit(0.05))) == 10 and f(tx.capped_ratio(lit(0.4), lit(0.0))) == 0
    assert f(tx.finite(lit(float("nan")))) == 0 and f(tx.finite(lit(float("-inf")))) == -1e10
    assert f(tx.tenth(lit(0.25))) == 0.2
    assert f(tx.percent(lit(0.125))) == "12.50 %" and f(tx.percent(lit(None).cast("double"))) is None
    assert f(tx.cosine(F.array(lit(1.0), lit(0.0)), F.array(lit(1.0), lit(1.0)))) == pytest.approx(2**-0.5)
    assert f(tx.cosine(F.array(lit(0.0), lit(0.0)), F.array(lit(1.0), lit(1.0)))) == 0


def test_uuid(spark):
    words = ["a", "hash_person", "ü"]
    assert values(spark, tx.name_uuid(F.col("a")), [(w, None) for w in words]) == [str(uuid.uuid5(uuid.NAMESPACE_DNS, w)) for w in words]


def test_labels_and_pairs(spark):
    rows = [(" TRUE", "x"), ("match", "x"), ("f", "x"), (None, "x"), ("1", "x")]
    assert values(spark, tx.truthy(F.col("a")), rows) == [True, True, False, None, True]
    assert values(spark, tx.pair_id(F.col("a"), F.col("b")), [("b", "a"), ("a", "b")]) == ["a|b", "a|b"]


@settings(max_examples=200, deadline=None)
@given(st.text("abcd", max_size=12), st.text("abcd", max_size=12))
def test_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert tx.common_subsequence(a, b) == table[-1][-1]


def test_jaro_winkler():
    assert tx.jaro_winkler("MARTHA", "MARHTA") == pytest.approx(0.9611, abs=1e-4)
    assert tx.jaro_winkler("DIXON", "DICKSONX") == pytest.approx(0.8133, abs=1e-4)
    assert tx.jaro_winkler("", "") == 1 and tx.jaro_winkler("a", "") == 0 and tx.jaro_winkler("abc", "xyz") == 0
