from pyspark.sql import functions as F

from kinfold.llm.formatting import formatting_groups


def groups(spark, rows, **more):
    df = spark.createDataFrame(rows, "field_type string, hash string, value string").withColumn("copies", F.lit(9)).withColumn("__row", F.lit(1))
    return {(r.field_type, r.hash): (r.group_key, r.copies) for r in formatting_groups(df, ["field_type"], "hash", "value", F.col("field_type") == "composite", **more).collect()}


ROWS = [
    ("composite", "h1", "A b | C, d | "), ("composite", "h2", "c-D|AB"), ("composite", "h3", "ab | cd | cd"), ("composite", "h4", "abcd"),
    ("provision", "h1", "A b | C, d"), ("provision", "h5", "c d | a b"), ("provision", "h6", "AB CD."), ("provision", "h6", "AB CD."),
    ("composite", "n1", None), ("composite", "n2", ""), ("composite", "n3", " | -- |"), ("provision", None, "x"), ("provision", "s1", "Straße"), ("provision", "s2", "STRASSE"),
]


def test_groups(spark):
    got = groups(spark, ROWS)
    assert got[("composite", "h1")] == got[("composite", "h2")] == ("h1", 2)
    assert got[("composite", "h3")] == ("h3", 1) and got[("composite", "h4")] == ("h4", 1)
    assert got[("provision", "h1")] == got[("provision", "h6")] == ("h1", 2) and got[("provision", "h5")] == ("h5", 1)
    assert got[("composite", "n1")] == got[("composite", "n2")] == got[("composite", "n3")] == (None, 0)
    assert got[("provision", "s1")] == got[("provision", "s2")] == ("s1", 2)
    assert len(got) == 12
    assert groups(spark, ROWS, only_repeated=True) == {k: v for k, v in got.items() if v[1] > 1}


def test_empty_hot_and_long(spark):
    assert groups(spark, []) == {}
    rows = [("composite", f"k{i:05}", "Same | Thing" if i % 3 else f"v{i}") for i in range(3000)] + [("composite", "long1", "x" * 300_000 + "|b"), ("composite", "long2", "B|" + "X" * 300_000)]
    got = groups(spark, rows)
    assert got["composite", "k00002"] == ("k00001", 2000) and got["composite", "k00003"] == ("k00003", 1) and got["composite", "long2"] == ("long1", 2)
